"""Type and value conversions: time zones, typed key defaults, numeric casts, nested extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawfold.config import Settings

NUMERIC = T.DecimalType(38, 9)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_wallclock(col, settings: Settings, dtype: T.DataType | None = None) -> Column:
    """UTC timestamp -> wall-clock ``timestamp_ntz`` in ``settings.to_timezone`` (DST aware).

    Raw columns are UTC instants. ``timestamp_ntz`` input is read as UTC wall clock; ``timestamp``
    (LTZ) input is first rendered in the session zone, which the engine pins to UTC. With the flag
    off the column passes through unchanged.
    """
    c = _c(col)
    if not settings.timezone_conversion:
        return c
    if isinstance(dtype, T.StringType):
        c = F.to_timestamp_ntz(c)
    elif not isinstance(dtype, T.TimestampNTZType):
        c = c.cast(T.TimestampNTZType())
    return F.convert_timezone(F.lit("UTC"), F.lit(settings.to_timezone), c)


def typed_default(col, default, dtype: T.DataType | None = None) -> Column:
    """``coalesce(col, default)`` with the default typed like the key.

    A string default (``'N/A'``) on a numeric column makes the key a string key, so the column is
    cast to string first; a numeric default on a string column stays a string (``'0'``). Without
    this, ANSI coercion would turn ``coalesce(bigint, 'N/A')`` into a failing bigint cast.
    """
    c = _c(col)
    if isinstance(default, str):
        if dtype is not None and not isinstance(dtype, T.StringType):
            c = c.cast(T.StringType())
        return F.coalesce(c, F.lit(default))
    if dtype is not None and isinstance(dtype, T.StringType):
        return F.coalesce(c, F.lit(str(default)))
    if dtype is not None:
        return F.coalesce(c, F.lit(default).cast(dtype))
    return F.coalesce(c, F.lit(default))


def to_numeric(col) -> Column:
    """``cast(x as numeric)``: decimal(38, 9)."""
    return _c(col).cast(NUMERIC)


def millis_to_ts(col) -> Column:
    """Epoch milliseconds -> ``timestamp_ntz`` (UTC wall clock)."""
    return F.timestamp_millis(_c(col).cast("long")).cast(T.TimestampNTZType())


def extract_nested(path: str, dtype: str | None = None) -> Column:
    """Typed field of an exploded element: ``CAST(element.field AS type)``; ``numeric`` = decimal."""
    c = F.col(path)
    if dtype is None:
        return c
    if dtype.lower() in ("numeric", "decimal"):
        return c.cast(NUMERIC)
    return c.cast(dtype)
