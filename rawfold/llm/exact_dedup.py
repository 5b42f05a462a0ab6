"""Exact deduplication: 128-bit content hash, smallest stable id, bytes compared inside groups.

Only DataFrame functions. The plan:

1. hash -> (rows, id that stays) for hashes of two rows and more: a partial aggregate, so a hash that
   holds a third of all rows ships one row per map task. It is written to the shared folder, so that both sides
   of the next join are plain shuffles, whose large partitions AQE splits. Groups grow with the documents, so
   that join is a merge join at every size;
2. the rows join these groups on the hash and are written once; only rows of groups keep their text;
3. bytes are compared with the text of the row that stays. A group is dealt over
   ``ceil(rows / salt_rows)`` salts and its one reference text is repeated once per salt, so no task
   holds a large group;
4. rows whose bytes differ (a collision of the hash) are grouped again by their whole text.

Defined results: a null text counts as empty, so nulls and empty texts are copies of each other; a
null id sorts after every other id and stays only if its group has no other; rows that repeat both id
and text all count in ``group_size`` and carry the same verdict; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawfold.llm.common import ascii_lower, checkpointed, materialize, text_or_empty


def content_hash(text: Column) -> Column:
    """128-bit content hash as 16 bytes."""
    return F.unhex(F.md5(text))


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", stays: str = "smallest",
                normalize: Callable[[Column], Column] = ascii_lower,
                hash_fn: Callable[[Column], Column] = content_hash, salt_rows: int = 256) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``stays`` names the row of a group that is kept: the one with the "smallest" or the "largest" id.
    """
    if stays not in ("smallest", "largest"):
        raise ValueError(f"stays is 'smallest' or 'largest', not {stays!r}")
    best = F.min if stays == "smallest" else F.max
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), normalize(text_or_empty(text_col)).alias("norm"))
    rows = rows.withColumn("h", hash_fn(F.col("norm")))

    groups = materialize(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), best("id").alias("keep"))
                         .filter("n > 1"), "exact-dedup-groups")
    marked = (rows.withColumn("sha", F.sha2("norm", 256)).join(groups.hint("merge"), "h", "left")
              .withColumn("norm", F.when(F.col("n") > 1, F.col("norm")))
              .withColumn("keep", F.when(F.col("n") > 1, F.col("keep")).otherwise(F.col("id")))
              .withColumn("n", F.coalesce("n", F.lit(1))))
    marked = materialize(marked, "exact-dedup")

    many = (marked.filter("n > 1")
            .withColumn("salts", F.ceil(F.col("n") / F.lit(salt_rows)).cast("int"))
            .withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int")))
    reference = (many.filter(F.col("id").eqNullSafe(F.col("keep"))).groupBy("h", "salts")
                 .agg(F.min("norm").alias("ref"))
                 .select("h", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "ref"))
    # an own shuffle by (hash, salt), so that the hash alone never decides the task
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    compared = (many.repartition(parts, "h", "salt").join(reference.repartition(parts, "h", "salt"), ["h", "salt"])
                .withColumn("same", F.col("norm") == F.col("ref"))
                .select("id", "h", "n", "keep", "sha", "same",
                        F.when(~F.col("same"), F.col("norm")).alias("norm")))
    compared = materialize(compared, "exact-dedup-compared")

    single = marked.filter("n = 1").select("id", "keep", "n", "sha")
    same = compared.filter("same").select("id", "h", "keep", "n", "sha")

    # collisions: none in practice; grouped by the text itself, whatever their number
    other = compared.filter("not same")
    regrouped = checkpointed(other.groupBy("h", "norm").agg(F.count(F.lit(1)).alias("n2"), best("id").alias("keep2")))
    if not regrouped.isEmpty():
        lost = regrouped.groupBy("h").agg(F.sum("n2").alias("lost"))
        same = same.join(lost, "h", "left").withColumn("n", F.col("n") - F.coalesce("lost", F.lit(0))).drop("lost")
        again = (other.drop("n", "keep").join(regrouped, ["h", "norm"])
                 .select("id", "h", F.col("keep2").alias("keep"), F.col("n2").alias("n"), "sha"))
        same = same.unionByName(again)
    return single.unionByName(same.drop("h")).select(
        F.col("id").alias(id_col), F.col("keep").alias("keep_id"), F.col("n").cast("long").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"), F.col("sha").alias("text_sha256"))
