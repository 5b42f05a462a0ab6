"""Document fingerprints: a threshold-scaled sketch of word shingles. Only DataFrame functions.

A text's shingles are its runs of ``words`` consecutive words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; a text of fewer
words is one shingle). A shingle's hash is the first 64 bits of its md5. The sketch keeps every hash below
``2^64 / scale``, and the smallest hash where none is (short texts). Its size follows the text's, so a short text is
still found in a long one: ``containment`` compares very unequal texts, which sketches of a fixed size cannot. Sketches merge:
``merge`` of two sketches is the sketch of the union of their shingles, exactly, in any order and grouping.

``likeness`` (share of common hashes among all) and ``containment`` (share of the first's hashes that the second has)
estimate the same figures of the full sets; equal sketches have likeness 1, also empty ones.

``with_neighbours`` finds each row's next row in descending order of the id without bringing rows of the table to one task:
the keys alone are ordered over range partitions, and the partitions' first keys are stitched; texts then meet by key
in two joins over one shuffle of the texts.

Defined results: null text counts as empty (empty sketch, n_chars 0); rows of one id are in order of a hash of id and text, a null id
comes last; rows that repeat id and text are each other's next rows; a single row is its own next; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rawfold.llm.common import ascii_lower, materialize, text_or_empty

HEX = 16  # hexadecimal digits of a hash


def _below(scale: int) -> str:
    """The smallest hash that is not kept, as hexadecimal text ('g' is above every digit)."""
    return "g" if scale <= 1 else f"{(1 << 64) // scale:016x}"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), r"[\x20\x09-\x0D]+"), "")


def add_sketch(df: DataFrame, text: str, name: str, *, words: int = 5, scale: int = 8) -> DataFrame:
    """``df`` with the sketch of the column ``text`` as ``name``: its hashes as hexadecimal text, ascending, end to end."""
    w, hashes = f"__w_{name}", f"__h_{name}"
    starts = F.sequence(F.lit(1), F.greatest(F.size(w) - F.lit(words - 1), F.lit(1)))
    every = F.transform(starts, lambda i: F.substring(F.md5(F.array_join(F.slice(F.col(w), i, words), " ")), 1, HEX))
    low = F.filter(F.col(hashes), lambda h: h < F.lit(_below(scale)))
    df = df.withColumn(w, _words(F.col(text)))
    df = df.withColumn(hashes, F.when(F.size(w) > 0, every).otherwise(F.array().cast("array<string>"))).drop(w)
    return df.withColumn(name, F.when(F.size(low) > 0, F.array_join(F.array_sort(F.array_distinct(low)), ""))
                         .otherwise(F.coalesce(F.array_min(hashes), F.lit("")))).drop(hashes)


def hashes_of(sketch: Column) -> Column:
    """The sketch's hashes as an array."""
    n = (F.length(sketch) / HEX).cast("int")
    each = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substr(sketch, i * HEX + 1, F.lit(HEX)))
    return F.when(n > 0, each).otherwise(F.array().cast("array<string>"))


def likeness(a: Column, b: Column) -> Column:
    """Share of common hashes among all hashes of two arrays; 1 for two empty ones."""
    common = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - common
    return F.when(every > 0, common / every).otherwise(F.lit(1.0))


def containment(a: Column, b: Column) -> Column:
    """Share of the hashes of ``a`` that ``b`` has; 1 for an empty ``a``."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).otherwise(F.lit(1.0))


def merge(a: Column, b: Column, *, scale: int = 8) -> Column:
    """Hashes of the sketch of the union of both shingle sets."""
    every = F.array_sort(F.array_union(a, b))
    low = F.filter(every, lambda h: h < F.lit(_below(scale)))
    return F.when(F.size(low) > 0, low).otherwise(F.slice(every, 1, 1))


def _pairs(keys: DataFrame, parts: int) -> DataFrame:
    """(k, id, n, c) -> (k, id, next, m, times): the key of each key's next row, and for how many of its rows.

    ``m`` is a third of the row's characters. Of c equal rows, c - 1 are followed by an equal one."""
    order = [F.col("id").desc_nulls_last(), F.col("k")]
    ranged = materialize(keys.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                         .withColumns({"pid": F.spark_partition_id(), "at": F.monotonically_increasing_id()}),
                         "fingerprint-keys")
    inside = Window.partitionBy("pid").orderBy("at")
    # one row a partition: the first key of the next one that holds rows, or of the first one
    firsts = ranged.groupBy("pid").agg(F.min_by("k", "at").alias("first"))
    all_parts = Window.orderBy("pid")
    follow = firsts.select(F.col("pid").alias("p"), F.coalesce(
        F.lead("first").over(all_parts),
        F.first("first").over(all_parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("follow"))
    near = ranged.withColumn("next", F.lead("k").over(inside)).join(follow, F.col("pid") == F.col("p"))
    m = F.floor(F.col("n") / 3).cast("int")
    other = near.select("k", "id", F.coalesce("next", "follow").alias("next"), m.alias("m"), F.lit(1).cast("long").alias("times"))
    same = ranged.filter("c > 1").select("k", "id", F.col("k").alias("next"), m.alias("m"), (F.col("c") - 1).alias("times"))
    return other.unionByName(same)


def with_neighbours(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    scale: int = 8) -> DataFrame:
    """One row per document: ``id, text, sketch``, and of the next row in descending id ``head`` (its first third of
    ``char_length(text)`` characters, or all) and ``next_sketch``."""
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    key = F.unhex(F.md5(F.concat(F.coalesce(F.concat(F.lit("="), F.col("id").cast("string")), F.lit("")), F.lit("\n"), F.col("text"))))
    rows = rows.withColumn("k", key)
    keys = rows.groupBy("k").agg(F.first("id").alias("id"), F.first(F.char_length("text")).cast("long").alias("n"),
                                 F.count(F.lit(1)).alias("c"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = materialize(_pairs(keys, parts), "fingerprint-pairs")
    # one row a key; both joins below use the same columns of it, so they read one shuffle
    base = (add_sketch(rows, "text", "sketch", words=words, scale=scale).withColumn("sketch", F.unhex("sketch"))
            .groupBy("k").agg(F.first("text").alias("text"), F.first("sketch").alias("sketch")))
    sent = (base.select(F.col("k").alias("next"), F.col("text").alias("t"), F.col("sketch").alias("next_sketch"))
            .join(pairs, "next")
            .select(F.col("k").alias("to"), "id", "times", F.substr(F.col("t"), F.lit(1), F.col("m")).alias("head"), "next_sketch"))
    out = base.join(sent, F.col("k") == F.col("to"))
    out = out.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int"))))
    return out.select("id", "text", "head", *[F.lower(F.hex(c)).alias(c) for c in ("sketch", "next_sketch")])


def fingerprint_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                       scale: int = 8) -> DataFrame:
    """Per document its fingerprint, that of its edited text (the last third replaced by the next document's beginning),
    and the likeness of its fingerprint to that and to the next document's."""
    d = with_neighbours(docs, id_col=id_col, text_col=text_col, words=words, scale=scale)
    n = F.char_length("text")
    d = d.withColumn("edited", F.concat(F.substr(F.col("text"), F.lit(1), n - F.floor(n / 3).cast("int")), F.col("head")))
    d = d.select("id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "sketch", "next_sketch", "edited")
    d = add_sketch(d, "edited", "edited_sketch", words=words, scale=scale).drop("edited")
    d = d.withColumns({c + "_h": hashes_of(F.col(c)) for c in ("sketch", "next_sketch", "edited_sketch")})
    return d.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", F.col("sketch").alias("fingerprint"),
                    F.col("edited_sketch").alias("edited_fingerprint"),
                    likeness(F.col("sketch_h"), F.col("edited_sketch_h")).alias("near_edited"),
                    likeness(F.col("sketch_h"), F.col("next_sketch_h")).alias("near_next"))
