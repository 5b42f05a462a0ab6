"""Parts by time: the finest of day, month, year and all by which a table has at most so many parts.

A part's name is its day cut at a hyphen (``2024-01-05``, ``2024-01``, ``2024``, ``all``; ``null`` without a date), so the parts a manifest
names say without any reading how many there would be at a coarser grain. A load adds those of its own rows: one partial
aggregate over one column, of which the driver gets one name more than the bound at most.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAINS = ("day", "month", "year", "all")
NO_DATE = "null"


def period(column: str, grain: str) -> Column:
    """The name of the part that a row's date belongs to."""
    if grain not in GRAINS:
        raise ValueError(f"a grain is one of {GRAINS}, not {grain!r}")
    name = F.to_date(F.col(column)).cast("string")
    for _ in range(min(GRAINS.index(grain), 2)):
        name = F.regexp_replace(name, "-[^-]*$", "")
    if grain == "all":
        name = F.when(name.isNotNull(), F.lit("all"))
    return F.coalesce(name, F.lit(NO_DATE))


def coarsened(names: Iterable[str], now: str, grain: str) -> set[str]:
    """The names of parts of grain ``now`` at a grain that is as coarse or coarser."""
    steps, out = GRAINS.index(grain) - GRAINS.index(now), set()
    for n in names:
        if n == NO_DATE or not steps:
            out.add(n)
        else:
            out.add("all" if grain == "all" else n.rsplit("-", steps)[0])
    return out


def choose_grain(rows: DataFrame, column: str, most: int, there: Iterable[str] = (), now: str = "day") -> str:
    """The finest grain, not finer than ``now``, at which the parts that are there (of grain ``now``) and those of ``rows`` are at most
    ``most``. Two parts ("all" and that of rows without a date) are the least, so ``most`` is 2 or more."""
    if most < 2:
        raise ValueError("at least two parts: rows with a date and rows without")
    there = list(there)
    for grain in GRAINS[GRAINS.index(now):]:
        names = coarsened(there, now, grain)
        if len(names) <= most:
            new = rows.select(period(column, grain).alias("p")).distinct().limit(most + 1).collect()  # names, by the bound
            if len(names.union(r["p"] for r in new)) <= most:
                return grain
    return GRAINS[-1]
