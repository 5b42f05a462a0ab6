"""Run the enabled datasets: rates first (every rate join reads them), then the rest.

Per dataset: discover relations -> read the current manifest -> watermark (one small job, or one number for each
relation from the manifest) -> build the plan -> write the updates to the shared folder (cuts lineage; a lost executor re-runs
only the write stage) -> find the rows they replace by the key index -> write new rows and delete set -> next
manifest -> compact what is due -> checks -> audit row. A dataset that fails is recorded with its error, the datasets that
need it are skipped, the others run, and the run raises at the end.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawfold.config import Settings
from rawfold.operators.fx import MissingRates
from rawfold.operators.quality import check_not_null, check_recency, check_unique, run_record, store_failures
from rawfold.plans.builder import build, number, parents, rank_keys, tiebreak_of
from rawfold.plans.specs import SPECS, DatasetSpec, is_enabled, merge_keys
from rawfold.session import pin_engine_conf, scratch_path
from rawfold.sources.clustering import Interleaved
from rawfold.sources.granularity import choose_grain, period
from rawfold.sources.incremental import high_watermark, merge_sides, newest_by_relation
from rawfold.sources.versions import (
    ATT, HIDDEN, PART, RANK_KEY, RANK_ORDER, CommitConflict, Manifest, _delete, commit_load, commit_parts, compact, drop_attempt,
    new_attempt, read_candidates, read_current, read_folders, read_manifest, read_parts, write_attempt, write_deletes,
)
from rawfold.sources.relations import discover

AUDIT = "run_id string, dataset string, row_count long, max_batch_runtime long, status string"


class DuplicateRates(ValueError):
    """Two relations hold the same rate key and the policy is "fail"."""


class RunFailed(RuntimeError):
    """Some datasets failed; the audit rows say which."""


# --- parts --------------------------------------------------------------------------------------------

def _time_column(spec: DatasetSpec, settings: Settings) -> str | None:
    """The column whose date is a row's part; None for parts by hash."""
    return None if spec.seq_by else settings.partition_by.get(spec.name, spec.partition_by)


def part_column(spec: DatasetSpec, settings: Settings, n_parts: int, grain: str = "day") -> Column:
    """The part a row belongs to: its day (or month, year), or a hash of its rank key; of its parent where rows are numbered, so
    that a parent's rows share a part."""
    by = _time_column(spec, settings)
    if by:
        return period(by, grain)
    key = F.col(spec.seq_by).cast("string") if spec.seq_by else F.col(RANK_KEY)
    return F.pmod(F.xxhash64(key), F.lit(n_parts)).cast("string")


def _part_of_key(spec: DatasetSpec, settings: Settings) -> bool:
    """Whether a row's part follows from its rank key."""
    return not spec.seq_by and not _time_column(spec, settings)


def _grain(spec: DatasetSpec, settings: Settings, updates: DataFrame, old: Manifest | None) -> str:
    """The grain of parts by time once the updates are in."""
    by, now = _time_column(spec, settings), old.grain if old else "day"
    if not by:
        return now
    return choose_grain(updates, by, settings.max_parts, {f.part for f in old.folders} if old else (), now)


def _lay_out(spark: SparkSession, spec: DatasetSpec, base: str, old: Manifest, grain: str, settings: Settings) -> Manifest:
    """All live rows in parts of a coarser grain, as a version of its own. At most three times in a table's life."""
    rows = read_folders(spark, base, old, old.folders)
    return commit_parts(spark, base, rows, old, None, part=part_column(spec, settings, old.n_parts, grain), n_parts=old.n_parts,
                        cluster_by=_cluster_by(spec, settings), epoch=old.epoch, keys=old.keys, watermarks=old.watermarks,
                        grain=grain, retain=settings.retain_versions)


def merge_into(spark: SparkSession, spec: DatasetSpec, base: str, updates: DataFrame, settings: Settings, *,
               reread: bool, epoch: int | None = None, full: bool = False, watermarks: dict | None = None,
               before_switch: Callable[[], None] | None = None) -> Manifest:
    """Merge staged updates (with rank columns) into the table at ``base``: their rows are written, what they replace is named in a delete
    set. Merged again if another writer has committed the same keys meanwhile."""
    for left in reversed(range(settings.commit_attempts)):
        try:
            m = _merge_once(spark, spec, base, updates, settings, reread=reread, epoch=epoch, full=full, watermarks=watermarks,
                            before_switch=before_switch)
            break
        except CommitConflict:
            if not left:
                raise
    done = compact(spark, base, fan=settings.compact_fan, smallest=settings.compact_smallest, cluster_by=_cluster_by(spec, settings),
                   retain=settings.retain_versions)
    return done or m


def _cluster_by(spec: DatasetSpec, settings: Settings) -> tuple:
    if spec.name in settings.interleave:
        return Interleaved(settings.interleave[spec.name])
    return tuple(spec.cluster_by or merge_keys(spec, settings))


def _stored(settings: Settings) -> str:
    """The way of numbering rows that are written already."""
    return "counted" if settings.seq_strategy == "split" else settings.seq_strategy


def _merge_once(spark: SparkSession, spec: DatasetSpec, base: str, updates: DataFrame, settings: Settings, *, reread: bool,
                epoch: int | None, full: bool, watermarks: dict | None, before_switch) -> Manifest:
    old = read_manifest(spark, base)
    common = dict(epoch=epoch, watermarks=watermarks, retain=settings.retain_versions, before_switch=before_switch)
    if epoch is not None and old is not None and old.epoch is not None and old.epoch >= epoch:
        return old
    keys = (RANK_KEY, spec.seq_by) if spec.seq_by else (RANK_KEY,)
    if full or old is None or not old.folders:
        n_parts = settings.target_parts if old is None or full else old.n_parts
        rows = number(updates.drop("_seq_id"), spec, settings, _stored(settings)) if spec.seq_by else updates
        grain = _grain(spec, settings, updates, None)
        return commit_parts(spark, base, rows, old, None, part=part_column(spec, settings, n_parts, grain), n_parts=n_parts,
                            cluster_by=_cluster_by(spec, settings), keys=keys, grain=grain, **common)
    grain = _grain(spec, settings, updates, old)
    if grain != old.grain:
        old = _lay_out(spark, spec, base, old, grain, settings)
    attempt, path = new_attempt(), scratch_path(spark, f"hits-{spec.name}")
    part = part_column(spec, settings, old.n_parts, old.grain)
    sought = updates.select(RANK_KEY, (part if _part_of_key(spec, settings) else F.lit(None).cast("string")).alias(PART))
    try:
        gone, new, whole = None, updates, []
        hits = read_candidates(spark, base, old, sought)
        if hits is not None:
            hits.select(*keys, RANK_ORDER, ATT, PART).join(updates.select(RANK_KEY), RANK_KEY, "left_semi").write.parquet(path)
            hits = spark.read.parquet(path)
            gone, new = merge_sides(hits, updates, ties=spec.latest is not None and spec.latest.ties, reread=reread)
        if spec.seq_by:
            gone, new, whole = _renumber(spark, base, old, hits, gone, updates, new, keys, spec, settings)
        folders = write_attempt(spark, base, attempt, new, part=part, cluster_by=_cluster_by(spec, settings))
        dead = {} if gone is None else write_deletes(spark, base, attempt, gone, keys)
        return commit_load(spark, base, old, attempt, new, folders, dead, keys=sought, whole_parts=whole, **common)
    except BaseException:
        drop_attempt(spark, base, attempt)
        raise
    finally:
        _delete(spark, [path])


def _renumber(spark: SparkSession, base: str, old: Manifest, hits: DataFrame | None, gone: DataFrame | None, updates: DataFrame,
              new: DataFrame, keys: tuple, spec: DatasetSpec, settings: Settings) -> tuple[DataFrame, DataFrame | None, list[str]]:
    """Rows of every parent that lost or gained a row, numbered; what they replace; the parts they lie in. Other parents keep
    their rows."""
    by = spec.seq_by
    moved = updates.select(F.col(by).alias("__p"))
    moved = (moved if hits is None else moved.unionByName(hits.select(F.col(by).alias("__p")))).distinct()
    part = part_column(spec, settings, old.n_parts, old.grain).alias("p")
    whole = sorted(r["p"] for r in moved.select(F.col("__p").alias(by)).select(part).distinct().collect())  # at most one row a part
    there = read_parts(spark, base, old, whole, placed=True)
    if there is None:
        return gone, number(new.drop("_seq_id"), spec, settings, _stored(settings)), whole
    there = there.join(moved, F.col(by).eqNullSafe(F.col("__p")), "left_semi")
    alive = there
    if gone is not None:
        dead = gone.select(*[F.col(c).alias(f"__g{i}") for i, c in enumerate((ATT, PART, *keys))]).distinct()
        same = [there[c].eqNullSafe(dead[f"__g{i}"]) for i, c in enumerate((ATT, PART, *keys))]
        alive = there.join(dead, same, "left_anti")
    rows = alive.drop(ATT, PART, "_seq_id").unionByName(new.drop("_seq_id"), allowMissingColumns=True)
    return there.select(ATT, PART, *keys), number(rows, spec, settings, _stored(settings)), whole


# --- running ------------------------------------------------------------------------------------------

def relations_of(spec: DatasetSpec, source, settings: Settings, shared=None) -> list:
    """Relations by the spec's patterns or the run's overrides; rates are looked for in their own source if there is one."""
    pattern, exclude = settings.patterns.get(spec.name, (spec.pattern, spec.exclude_pattern))
    return discover(shared if shared is not None and spec.kind == "per_arm_rates" else source, pattern, exclude)


def _lookback(spec: DatasetSpec, settings: Settings) -> int:
    return settings.lookback_ms.get(spec.name, settings.fx_lookback_ms if spec.kind == "per_arm_rates" else 0)


class _Staging:
    """Newest parents of one (pattern, rank) written once and read by every dataset built from them."""

    def __init__(self, spark: SparkSession, shared_by: dict):
        self.spark, self.shared_by, self.written = spark, shared_by, {}

    @staticmethod
    def key(spec: DatasetSpec, settings: Settings) -> tuple | None:
        lt = spec.latest
        if lt is None or lt.stage != "parent" or spec.kind == "per_arm_rates":
            return None
        patterns = settings.patterns.get(spec.name, (spec.pattern, spec.exclude_pattern))
        return (*patterns, rank_keys(spec, settings), lt.order, lt.ties, () if lt.ties else tiebreak_of(spec))

    def get(self, spec: DatasetSpec, relations, settings: Settings, watermark, lookback: int) -> DataFrame | None:
        key = self.key(spec, settings)
        if key is None or self.shared_by.get(key, 0) < 2:
            return None
        own = (key, tuple(sorted(watermark.items())) if isinstance(watermark, dict) else watermark, lookback)
        if own not in self.written:
            path = scratch_path(self.spark, "parents")
            parents(spec, relations, settings, watermark=watermark, lookback_ms=lookback).write.parquet(path)
            self.written[own] = path
        return self.spark.read.parquet(self.written[own])

    def clean(self) -> None:
        _delete(self.spark, list(self.written.values()))


def run_dataset(spark: SparkSession, spec: DatasetSpec, source, out_dir: str, settings: Settings, *,
                fx: DataFrame | None = None, shared=None, staging: _Staging | None = None) -> DataFrame | None:
    relations = relations_of(spec, source, settings, shared)
    if not relations:
        return None
    base = f"{out_dir.rstrip('/')}/{spec.name}"
    w, lookback, newest = None, _lookback(spec, settings), None
    if settings.watermark == "relation":
        m = None if settings.full_refresh else read_manifest(spark, base)
        w = m.watermarks if m and m.folders else None
        newest = newest_by_relation([(r.name, r.load()) for r in relations], w, lookback)
    elif not settings.full_refresh:
        w = high_watermark(read_current(spark, base))
    staged = staging.get(spec, relations, settings, w, lookback) if staging else None
    updates = build(spec, relations, settings, fx=fx, watermark=w, lookback_ms=lookback, carry_rank=True,
                    seq_strategy="later", staged=staged)
    path = scratch_path(spark, f"updates-{spec.name}")
    try:
        updates.write.parquet(path)
        updates = spark.read.parquet(path)
        if spec.kind == "per_arm_rates" and settings.rates_policy == "fail":
            twice = check_unique(updates, list(spec.merge_keys)).count()
            if twice:
                raise DuplicateRates(f"{twice} rate keys are held by more than one relation")
        merge_into(spark, spec, base, updates, settings, reread=True, full=settings.full_refresh, watermarks=newest)
    finally:
        _delete(spark, [path])
    written = read_current(spark, base)
    return written if written is not None else spark.createDataFrame([], updates.schema).drop(*HIDDEN)


def run_checks(spark: SparkSession, spec: DatasetSpec, df: DataFrame, out_dir: str, settings: Settings | None = None) -> dict[str, int]:
    """Checks on a written dataset; failing rows are stored under ``_failures/<dataset>/<check>/version=<n>``, so those of
    earlier versions stay.

    Not-null on the merge keys for every dataset; uniqueness where one row per key is the contract
    (the rates, and ``row_number`` datasets; ``dense_rank`` datasets keep ties by design); recency where the settings name it.
    """
    settings, keys = settings or Settings(), list(merge_keys(spec))
    checks = {"not_null_keys": check_not_null(df, keys)}
    if spec.kind == "per_arm_rates" or (spec.latest is not None and not spec.latest.ties):
        checks["unique_keys"] = check_unique(df, keys)
    if spec.name in settings.recency:
        column, days, *group = settings.recency[spec.name]
        as_of = settings.as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        checks["recency"] = check_recency(df, column, as_of, days, tuple(group[0]) if group else ())
    m = read_manifest(spark, f"{out_dir.rstrip('/')}/{spec.name}")
    counts = {}
    for name, failing in checks.items():
        path = f"{out_dir.rstrip('/')}/_failures/{spec.name}/{name}/version={m.version if m else 0}"
        store_failures(failing, path)
        counts[name] = spark.read.parquet(path).count()
    return counts


def run_all(spark: SparkSession, source, out_dir: str, settings: Settings | None = None,
            only: Iterable[str] | None = None, *, shared=None) -> DataFrame:
    """Build every enabled dataset; returns this run's audit rows, read back from ``_run_audit``.

    ``shared`` is where the exchange rates are, if not among the raw tables. With currency conversion on, a dataset that
    joins rates fails if there are none.
    """
    settings = settings or Settings()
    pin_engine_conf(spark)
    wanted = set(only) if only else None
    ordered = [s for s in sorted(SPECS, key=lambda s: s.kind != "per_arm_rates")
               if is_enabled(s, settings) and (not wanted or s.name in wanted or s.kind == "per_arm_rates")]
    keys = [_Staging.key(s, settings) for s in ordered]
    staging = _Staging(spark, {k: keys.count(k) for k in keys})
    fx, rates_failed, audits, failed_sets = None, None, [], []
    path = f"{out_dir.rstrip('/')}/_run_audit"
    try:
        for spec in ordered:
            try:
                if spec.fx is not None and rates_failed:
                    raise MissingRates(f"skipped: {rates_failed}")
                result = run_dataset(spark, spec, source, out_dir, settings, fx=fx, shared=shared, staging=staging)
                if result is None:
                    continue
                failed = run_checks(spark, spec, result, out_dir, settings)
                if spec.kind == "per_arm_rates":
                    rates = result.select("date", "from_currency_code", "to_currency_code", "value")
                    fx = None if rates.isEmpty() else rates  # an empty table is as good as none: MissingRates
                status = "success" if not any(failed.values()) else "checks_failed:" + ",".join(
                    f"{k}={v}" for k, v in failed.items() if v)
                audits.append(tuple(run_record(spark, spec.name, result, settings.run_id, status=status).first()))
            except Exception as e:  # noqa: BLE001 - recorded, and raised at the end of the run
                failed_sets.append((spec.name, e))
                audits.append((settings.run_id, spec.name, None, None, f"error: {type(e).__name__}: {str(e)[:300]}"))
                if spec.kind == "per_arm_rates":
                    rates_failed = f"{spec.name} failed"
    finally:
        staging.clean()
    audit = spark.createDataFrame(audits, AUDIT)  # one row a dataset
    if audits:
        audit.coalesce(1).write.mode("append").parquet(path)
    if failed_sets:
        raise RunFailed("; ".join(f"{n}: {type(e).__name__}: {str(e)[:200]}" for n, e in failed_sets)) from failed_sets[0][1]
    return audit
