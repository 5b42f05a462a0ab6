"""Data checks whose failing rows are kept (``store_failures``), plus the run-audit record."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawfold.config import BATCH_RUNTIME


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count (partial aggregate, skew-safe)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where any of ``columns`` is NULL."""
    cond = None
    for c in columns:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return df.filter(cond)


def check_recency(df: DataFrame, ts_col: str, as_of: dt.datetime, days: int,
                  group_by: Sequence[str] = ()) -> DataFrame:
    """Groups whose newest ``ts_col`` is older than ``as_of - days`` (an explicit as-of time)."""
    limit = F.lit(as_of - dt.timedelta(days=days)).cast(df.schema[ts_col].dataType)
    agg = df.groupBy(*group_by).agg(F.max(ts_col).alias("latest"))
    return agg.filter(F.col("latest").isNull() | (F.col("latest") < limit))


def store_failures(failures: DataFrame, path: str) -> None:
    failures.write.mode("overwrite").parquet(path)


def run_record(spark: SparkSession, dataset: str, df: DataFrame, run_id: str, status: str = "success") -> DataFrame:
    """One audit row per dataset: rows and newest batch, computed by one aggregate over ``df``."""
    agg = df.agg(F.count(F.lit(1)).alias("row_count"), F.max(BATCH_RUNTIME).alias("max_batch_runtime"))
    return agg.select(F.lit(run_id).alias("run_id"), F.lit(dataset).alias("dataset"), "row_count",
                      "max_batch_runtime", F.lit(status).alias("status"))
