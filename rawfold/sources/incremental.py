"""Incremental loads: high watermark, lookback, merge by rank, and the versioned table on disk.

* The watermark (``max(_daton_batch_runtime)`` of the target) is computed first, in one small job
  that reads a single column, and passed on as a literal so it reaches every raw scan as a
  pushed-down filter (a scalar subquery would stay a runtime filter).
* The filter is inclusive (``>=``), so the last batch is read again; the merge is idempotent.
* Written rows carry their rank (hidden columns ``__rk``, ``__ro``): the merge compares versions of the same
  rank key in the same order the full build ranks them, so incremental loads equal a full build.
* Parquet has no MERGE: ``versions`` keeps a table as immutable folders and delete sets under numbered manifests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawfold.config import BATCH_RUNTIME
from rawfold.sources.clustering import Interleaved, curve
from rawfold.sources.versions import (  # noqa: F401 - the table format is part of this module's interface
    HIDDEN, PART, RANK_KEY, RANK_ORDER, Manifest, commit_parts, commit_version, read_current, read_manifest,
)


# --- watermark ----------------------------------------------------------------------------------------

def high_watermark(target: DataFrame | None, column: str = BATCH_RUNTIME) -> int | None:
    """``max(column)`` of the target, or None when there is no target yet."""
    if target is None:
        return None
    return target.agg(F.max(column).alias("w")).first()["w"]


def watermark_value(watermark: int | None, lookback_ms: int = 0) -> int:
    """``coalesce(max(..) - lookback, 0)``: only a missing maximum becomes 0."""
    return 0 if watermark is None else int(watermark) - int(lookback_ms)


def watermark_filter(watermark: int | None, lookback_ms: int = 0, column: str = BATCH_RUNTIME) -> Column:
    """``column >= <literal>``; for full loads use no filter at all."""
    return F.col(column) >= F.lit(watermark_value(watermark, lookback_ms))


def relation_filter(watermark, lookback_ms: int = 0, column: str = BATCH_RUNTIME):
    """Filter of a relation by its name: the same for all from one number (None: no filter), its own from a mapping of relation to
    number (none for a relation that has none yet). Each is a literal in its arm of the union."""
    def of(name: str) -> Column | None:
        w = watermark.get(name) if isinstance(watermark, dict) else watermark
        return None if w is None else watermark_filter(w, lookback_ms, column)
    return of


def newest_by_relation(arms: Sequence[tuple[str, DataFrame]], watermark=None, lookback_ms: int = 0,
                       column: str = BATCH_RUNTIME) -> dict[str, int]:
    """``max(column)`` of each relation, of the rows its filter leaves: one column of the load. Taken before the load itself, so a
    batch that lands in between is read again by the next."""
    where = relation_filter(watermark, lookback_ms, column)
    found = None
    for name, df in arms:
        cond = where(name)
        one = (df if cond is None else df.filter(cond)).select(F.lit(name).alias("r"), F.col(column).cast("long").alias("w"))
        found = one if found is None else found.unionByName(one)
    if found is None:
        return {}
    rows = found.groupBy("r").agg(F.max("w").alias("w")).collect()  # one row a relation
    return {r["r"]: r["w"] for r in rows if r["w"] is not None}


def watermark_subquery_sql(target_view: str, lookback_ms: int = 0, column: str = BATCH_RUNTIME) -> str:
    """The same predicate as SQL text with an uncorrelated scalar subquery."""
    if lookback_ms:
        return (f"{column} >= (SELECT coalesce(max({column}) - {int(lookback_ms)}, 0) "
                f"FROM {target_view})")
    return f"{column} >= (SELECT coalesce(max({column}), 0) FROM {target_view})"


# --- merging ------------------------------------------------------------------------------------------

def merge_by_key(target: DataFrame | None, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert: every target row whose key occurs in ``updates`` is replaced by the update rows.

    For keys with several update rows (``dense_rank`` datasets) all of them are inserted, so a key
    is replaced as a whole. Implemented as ``target LEFT ANTI JOIN keys(updates) UNION ALL updates``; AQE sends the
    keys everywhere only if their measured size is below its bound.
    """
    if target is None:
        return updates
    ukeys = updates.select(*[F.col(k).alias(f"__mk_{k}") for k in keys])
    cond = [target[k].eqNullSafe(ukeys[f"__mk_{k}"]) for k in keys]
    kept = target.join(ukeys, cond, "left_anti")
    return kept.unionByName(updates, allowMissingColumns=True)


def merge_sides(target: DataFrame, updates: DataFrame, *, ties: bool, reread: bool) -> tuple[DataFrame, DataFrame]:
    """Target rows that the updates replace, and the update rows that count; both sides carry ``__rk`` and ``__ro``.

    All rows of one rank key and side share their rank order (they are that side's newest). The newer side wins. Where
    both are equal: with ``reread`` (batch loads read the last batch again) the updates hold every such row and
    replace the target's; without (a stream reads each file once) rows of a tie are joined together, and a
    ``row_number`` dataset takes one side's.
    """
    newest_u = updates.groupBy(F.col(RANK_KEY).alias("__k")).agg(F.max(RANK_ORDER).alias("__u"))
    newest_t = (target.join(newest_u.select("__k"), F.col(RANK_KEY) == F.col("__k"), "left_semi")
                .groupBy(F.col(RANK_KEY).alias("__k")).agg(F.max(RANK_ORDER).alias("__t")))
    older = F.col(RANK_ORDER) < F.col("__u")
    replaced = older if ties and not reread else older | (F.col(RANK_ORDER) == F.col("__u"))
    gone = target.join(newest_u, F.col(RANK_KEY) == F.col("__k")).filter(replaced).drop("__k", "__u")
    new = (updates.join(newest_t, F.col(RANK_KEY) == F.col("__k"), "left")
           .filter(F.col("__t").isNull() | (F.col(RANK_ORDER) >= F.col("__t"))).drop("__k", "__t"))
    return gone, new


def merge_ranked(target: DataFrame | None, updates: DataFrame, *, ties: bool, reread: bool) -> DataFrame:
    """Keep-latest over all target rows and updates (see ``merge_sides``)."""
    if target is None:
        return updates
    gone, new = merge_sides(target, updates, ties=ties, reread=reread)
    gone = gone.select(F.col(RANK_KEY).alias("__g")).distinct()  # a key goes with all its rows
    kept = target.join(gone, F.col(RANK_KEY) == F.col("__g"), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


# --- layout -------------------------------------------------------------------------------------------

def layout_for_write(df: DataFrame, cluster_by: Sequence[str] = (), partition_by: str | None = None,
                     partitions: int | None = None) -> DataFrame:
    """Cluster rows for writing: range-partition on (partition column, cluster keys, row hash), sort within.

    Range partitioning (sampled bounds) spreads a hot date over several tasks by its cluster keys,
    where hashing on the date alone would send the whole day to one task; the row hash last splits rows that are equal
    in all of these (null ids that default to 0). Each task then writes a few contiguous, sorted date folders.
    ``Interleaved`` keys are laid out along a Z curve instead, within each partition value.
    """
    if isinstance(cluster_by, Interleaved) and cluster_by:
        n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        first = [partition_by] if partition_by else []
        placed = curve(df, [c for c in cluster_by if c != partition_by])
        hashable = [f"`{f.name}`" for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
        return (placed.repartitionByRange(n, *first, "__z", F.xxhash64(*hashable))
                .sortWithinPartitions(*first, "__z", *[F.col(f"`{c}`") for c in cluster_by]).drop("__z"))
    by = ([partition_by] if partition_by else []) + [c for c in cluster_by if c != partition_by]
    if not by:
        return df
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashable = [f"`{f.name}`" for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return df.repartitionByRange(n, *by, F.xxhash64(*hashable)).sortWithinPartitions(*by)


def write_table(df: DataFrame, path: str, *, partition_by: str | None = None,
                cluster_by: Sequence[str] = (), partitions: int | None = None, mode: str = "overwrite") -> None:
    w = layout_for_write(df, cluster_by, partition_by, partitions).write.mode(mode)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
