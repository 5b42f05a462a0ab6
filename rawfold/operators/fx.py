"""Currency conversion: left join of daily exchange rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawfold.config import Settings
from rawfold.functions.convert import NUMERIC

FX_RATE = "fx_rate"
FX_CURRENCY = "fx_currency_code"


class MissingRates(ValueError):
    """Currency conversion is on and there are no rates to convert with."""


def fx_left_join(df: DataFrame, fx: DataFrame | None, date_col: Column | str, currency_col: Column | str,
                 settings: Settings, *, rate_name: str = FX_RATE, code_name: str = FX_CURRENCY) -> DataFrame:
    """``LEFT JOIN fx ON date(date_col) = fx.date AND currency_col = fx.to_currency_code``.

    Adds ``fx_rate = coalesce(value, 1)`` and ``fx_currency_code = coalesce(from_currency_code,
    currency)``. Rates are unique per (date, from, to), so a currency with two ``from`` codes
    yields two rows, as in the source SQL. With currency conversion off: rate 1 (a decimal), own currency. With it
    on and no rates: ``MissingRates``, never a silent 1.

    Which side is sent where is left to Spark: AQE broadcasts the rates if their measured size is below its bound and
    splits a hot (date, currency) otherwise. No job runs here.
    """
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    cur = F.col(currency_col) if isinstance(currency_col, str) else currency_col
    if not settings.currency_conversion:
        return df.withColumns({rate_name: F.lit(1).cast(NUMERIC), code_name: cur})
    if fx is None:
        raise MissingRates("currency conversion is on but there are no exchange rates")
    rates = fx.select(F.col("date").alias("__fx_date"), F.col("to_currency_code").alias("__fx_to"),
                      F.col("from_currency_code").alias("__fx_from"), F.col("value").alias("__fx_value"))
    j = df.join(rates, (F.to_date(d) == rates["__fx_date"]) & (cur == rates["__fx_to"]), "left")
    return (j.withColumns({rate_name: F.coalesce(F.col("__fx_value"), F.lit(1)),
                           code_name: F.coalesce(F.col("__fx_from"), cur)})
            .drop("__fx_date", "__fx_to", "__fx_from", "__fx_value"))
