"""Fill-in-middle: a text is cut at two unit borders and written with the middle last.

Units are ``[A-Za-z]+|[^A-Za-z]``. One full match of ``(unit)*`` by the regex library keeps every repetition of the
group, so ``match.ends(1)`` is the list of all unit ends: its length is n and its entries are both cut offsets; nothing
is iterated. Quantifiers are possessive: there is one way to match, so no way back is remembered.

Cuts and form are drawn from sha256 of ``<seed>:<id>``, so a row's result depends on nothing but its id and text:
reruns and lost executors agree. ``psm`` is ``<P>prefix<S>suffix<M>middle``, ``spm`` is ``<S>suffix<P>prefix<M>middle``.
A text that is empty or holds a mark stays ``plain``; a mark's ``<`` is nowhere else in it, so a mark cannot arise
across the border of a piece, and the first of each mark in the output is the one that was written: ``restore`` is exact.

Defined results: null text counts as empty (plain, n 0), null id as the empty id; repeated rows each get the same
result; an empty table gives an empty result; other columns are ignored. A row's working memory is some 100 bytes a unit.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawfold.llm.common import bounded_batches, text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_UNITS = regex.compile(r"([A-Za-z]++|[^A-Za-z])*+")
_DRAWN = ("h1", "h2", "h3", "h4")


def unit_ends(text: str) -> list[int]:
    """The end offset (code points) of every unit."""
    return _UNITS.fullmatch(text).ends(1)


def draws(id_col: str, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the first four 8-digit groups of sha256 of ``<seed>:<id>``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(h) for i, h in enumerate(_DRAWN)]


def cut(text: str, h: tuple[int, int, int, int], *, fim_percent: int = 90, spm_percent: int = 20) -> tuple:
    """``(n, form, prefix_chars, middle_chars, output)`` of one text; the two lengths are None for plain."""
    ends = unit_ends(text)
    n = len(ends)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h[2] % 100 >= fim_percent:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = (ends[low - 1] if low else 0), (ends[high - 1] if high else 0)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm_percent:
        return n, "spm", a, b - a, "".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", a, b - a, "".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def fill_in_middle(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
                   fim_percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """One row per document: ``<id>, n, form, prefix_chars, middle_chars, output``."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"), *draws(id_col, seed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for b in batches:
            drawn = zip(*(b.column(h).to_pylist() for h in _DRAWN))
            done = [cut(t.as_py(), h, fim_percent=fim_percent, spm_percent=spm_percent)
                    for t, h in zip(b.column("text"), drawn)]
            columns = zip(*done) if done else [()] * len(types)
            yield pa.RecordBatch.from_arrays([b.column("id"), *[pa.array(c, t) for c, t in zip(columns, types)]],
                                             ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    schema = T.StructType([rows.schema["id"], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
                           T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
                           T.StructField("output", T.StringType())])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def restore(output: Column, form: Column) -> Column:
    """The exact text, from output and form alone."""
    def between(left: str, right: str) -> Column:
        rest = F.substr(output, F.locate(left, output) + F.lit(len(left)))
        return F.substring_index(rest, right, 1)

    middle = F.substr(output, F.locate(MIDDLE, output) + F.lit(len(MIDDLE)))
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fim_digest(formatted: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """Lengths and digests; ``restored_sha256`` is of the text rebuilt from output and form."""
    return formatted.select(id_col, "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                            F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
