"""Clustering by several columns alike: the interleaved bits of their ranks (a Z curve) order the rows of a table.

Sorting by (a, b, c) lets a reader skip row groups by ``a`` alone. Along a Z curve neighbours are near in every column, so
that a filter on any of them skips most row groups.

A column's rank is its place among the quantiles of a sample: the ``SAMPLE`` rows that come first by a hash of all their
columns, the same on every run and few enough for the driver. The sample decides only how well rows are placed; every row is
written. Places are found by a tree of comparisons, seven for a value, in generated code.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS, SAMPLE, _PREFIX = 7, 8192, 64


class Interleaved(tuple):
    """Columns to cluster a table by along a Z curve; a plain sequence of columns is sorted by one after the other."""


def _sortable(df: DataFrame, name: str) -> Column:
    """The column as a number or short text of the same order. Texts equal in their first 64 characters share a place."""
    c, t = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c.cast("timestamp").cast("double")
    if isinstance(t, T.StringType):
        return F.substring(c, 1, _PREFIX)
    if isinstance(t, T.BooleanType):
        return c.cast("int")
    if isinstance(t, T.NumericType):
        return c
    raise ValueError(f"{name}: columns of type {t.simpleString()} have no place on a curve")


def bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS, sample: int = SAMPLE) -> list[list]:
    """For each column the ``2 ** bits - 1`` values that cut its sampled values into parts of one size; empty without values."""
    hashable = [f"`{f.name}`" for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    few = df.select(*[_sortable(df, c).alias(f"c{i}") for i, c in enumerate(columns)], F.xxhash64(*hashable).alias("h"))
    rows = few.orderBy("h").limit(sample).collect()  # sample rows at most, of short values
    out = []
    for i in range(len(columns)):
        values = sorted(v for r in rows if (v := r[f"c{i}"]) is not None and not (isinstance(v, float) and math.isnan(v)))
        out.append([values[len(values) * k >> bits] for k in range(1, 1 << bits)] if values else [])
    return out


def place(value: Column, cuts: Sequence) -> Column:
    """How many of the sorted ``cuts`` are not above the value, by halving; 0 for null."""
    def among(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value < F.lit(cuts[mid]), among(lo, mid)).otherwise(among(mid + 1, hi))
    return F.when(value.isNull(), F.lit(0)).otherwise(among(0, len(cuts))).cast("long")


def curve(df: DataFrame, columns: Sequence[str], bits: int = BITS, sample: int = SAMPLE) -> DataFrame:
    """``df`` and ``__z``: the bits of the columns' places, interleaved, those of the first column leading. At most eight columns."""
    if not 0 < len(columns) * bits < 64:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not fit into 63")
    cuts = bounds(df, columns, bits, sample)
    places = df.withColumns({f"__z{i}": place(_sortable(df, c), own) for i, (c, own) in enumerate(zip(columns, cuts))})
    n, z = len(columns), F.lit(0).cast("long")
    for i in range(n):
        for b in range(bits):
            bit = F.shiftright(F.col(f"__z{i}"), b).bitwiseAND(F.lit(1).cast("long"))
            z = z.bitwiseOR(F.shiftleft(bit, b * n + n - 1 - i))
    return places.withColumn("__z", z).drop(*[f"__z{i}" for i in range(n)])
