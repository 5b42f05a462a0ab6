"""Merge-on-read tables: bytes written, key index, interleaved writers, compaction."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rawfold.config import Settings
from rawfold.plans.builder import build
from rawfold.plans.runner import merge_into, part_column, run_dataset
from rawfold.plans.specs import BY_NAME
from rawfold.sources import versions
from rawfold.sources.incremental import newest_by_relation
from rawfold.sources.relations import MappingSource
from rawfold.sources.versions import candidate_files, compact, read_candidates, read_current, read_manifest, to_compact

SPEC = BY_NAME["ShopifyLocations"]
SCHEMA = ("id long, created_at timestamp_ntz, updated_at timestamp_ntz, v string, _daton_user_id string, "
          "_daton_batch_runtime long, _daton_batch_id long")
T = dt.datetime(2024, 1, 1)
NAME = "`lake`.`raw`.`Acme_us_shopify_1_locations`"


def loads(spark, ids, batch, v="v"):
    """Rank-carrying updates of one load."""
    raw = spark.createDataFrame([(i, T, T, f"{v}{i}", "u", batch, 0) for i in ids], SCHEMA)
    out = build(SPEC, [(NAME, raw)], Settings(), include_audit=False, carry_rank=True)
    return spark.createDataFrame(out.collect(), out.schema)


def rows(spark, base):
    return sorted((r["id"], r["v"]) for r in read_current(spark, base).collect())


def data_bytes(base, but=()):
    return {p: p.stat().st_size for p in Path(base).rglob("*") if p.is_file() and p.suffix != ".crc" and p not in but}


def test_a_load_of_one_percent_writes_bytes_of_its_own_size(spark, tmp_path):
    base, settings = str(tmp_path / "t"), Settings(target_parts=4)
    merge_into(spark, SPEC, base, loads(spark, range(40_000), 100), settings, reread=True)
    before = data_bytes(base)
    merge_into(spark, SPEC, base, loads(spark, range(0, 40_000, 100), 200, "new"), settings, reread=True)
    written = data_bytes(base, before)
    whole = sum(s for p, s in before.items() if "/data/" in str(p))
    assert sum(s for p, s in written.items() if "/data/" in str(p) or "/deletes/" in str(p)) < 0.1 * whole
    assert set(before) <= set(data_bytes(base)) | {p for p in before if "_versions" in str(p)}
    want = sorted((i, f"{'new' if i % 100 == 0 else 'v'}{i}") for i in range(40_000))
    assert rows(spark, base) == want
    compact(spark, base, fan=2, smallest=1 << 30)
    m = read_manifest(spark, base)
    assert len(m.folders) == 4 and not any(f.deletes for f in m.folders) and rows(spark, base) == want


def test_only_files_that_may_hold_the_keys_are_read(spark, tmp_path):
    base, settings = str(tmp_path / "t"), Settings(target_parts=4, compact_fan=99)
    for k in range(5):
        merge_into(spark, SPEC, base, loads(spark, range(1000 * k, 1000 * k + 1000), 100 + k), settings, reread=False)
    m = read_manifest(spark, base)
    sought = loads(spark, [2500, 2501], 900)
    keys = sought.select("__rk", part_column(SPEC, settings, 4).alias("__part"))
    found = candidate_files(spark, base, m.folders, keys)
    every = {(f.attempt, f.part) for f in m.folders}
    assert len(every) == 20 and len({(a, p) for a, p, _ in found}) <= 4
    df = read_candidates(spark, base, m, keys)
    assert {r["id"] for r in df.join(sought.select("__rk"), "__rk", "left_semi").collect()} == {2500, 2501}  # no false negative
    assert sorted(f.rsplit("/", 1)[1] for f in df.inputFiles()) == sorted(f for _, _, f in found)
    assert candidate_files(spark, base, m.folders, loads(spark, [10 ** 9], 1).select("__rk", F.lit(None).alias("__part"))) == []


def test_no_key_is_missed_by_the_filters(spark, tmp_path):
    base, settings = str(tmp_path / "t"), Settings(target_parts=1, compact_fan=99)
    merge_into(spark, SPEC, base, loads(spark, range(0, 60_000, 2), 100), settings, reread=True)
    m = read_manifest(spark, base)
    files = spark.read.parquet(f"{base}/index/{m.folders[0].attempt}/files")
    assert files.agg(F.max("blocks")).first()[0] > 1  # more than one bitmap a file
    there = read_current(spark, base, hidden=True).select("__rk")
    for some in (there.sample(0.002, seed=1), there.orderBy("__rk").limit(3)):
        found = {f for _, _, f in candidate_files(spark, base, m.folders, some.withColumn("__part", F.lit("0")))}
        holds = {r["f"] for r in spark.read.parquet(f"{base}/data").select("__rk", F.col("_metadata.file_name").alias("f"))
                 .join(some, "__rk", "left_semi").select("f").distinct().collect()}
        assert holds <= found
    absent = loads(spark, range(1, 4001, 2), 100).select("__rk").withColumn("__part", F.lit("0"))
    one_by_one = sum(bool(candidate_files(spark, base, m.folders, absent.filter(F.col("__rk") == r["__rk"]))) for r in absent.limit(12).collect())
    assert one_by_one <= 4  # a few in a hundred pass a filter


@pytest.mark.parametrize("other,again", [((7, 8), 1), ((3, 4), 2)])
def test_two_interleaved_writers_lose_no_row(spark, tmp_path, monkeypatch, other, again):
    """The second writer commits between the first one's merge and its commit: of other keys (put on top) or of the same (merged
    again)."""
    from rawfold.plans import runner
    base, settings = str(tmp_path / "t"), Settings(target_parts=2)
    merge_into(spark, SPEC, base, loads(spark, range(10), 100), settings, reread=True)
    calls, merges, real = [], [], runner._merge_once
    monkeypatch.setattr(runner, "_merge_once", lambda *a, **k: merges.append(1) or real(*a, **k))

    def second():
        if not calls:
            calls.append(1)
            real(spark, SPEC, base, loads(spark, other, 300, "second"), settings, reread=True, epoch=None, full=False,
                 watermarks={"b": 300}, before_switch=None)

    merge_into(spark, SPEC, base, loads(spark, (3, 5, 11), 200, "first"), settings, reread=True, before_switch=second,
               watermarks={"a": 200})
    want = {i: f"v{i}" for i in range(10)} | {i: f"first{i}" for i in (3, 5, 11)} | {i: f"second{i}" for i in other}
    assert rows(spark, base) == sorted(want.items())
    m = read_manifest(spark, base)
    assert len(merges) == again and m.version >= 3 and m.watermarks == {"a": 200, "b": 300}


def test_two_first_writers(spark, tmp_path):
    base, settings, calls = str(tmp_path / "t"), Settings(target_parts=2), []

    def second():
        if not calls:
            calls.append(1)
            merge_into(spark, SPEC, base, loads(spark, (1, 2), 300, "second"), settings, reread=True)

    merge_into(spark, SPEC, base, loads(spark, (2, 3), 200, "first"), settings, reread=True, before_switch=second)
    assert rows(spark, base) == [(1, "second1"), (2, "second2"), (3, "first3")]


def test_a_manifest_is_never_replaced(spark, tmp_path):
    path = str(tmp_path / "v" / "1.json")
    assert versions._put_if_absent(spark, path, "one") and not versions._put_if_absent(spark, path, "two")
    assert spark.read.text(path).first()[0] == "one"
    assert [p.name for p in (tmp_path / "v").iterdir() if not p.name.startswith(".")] == ["1.json"]


def test_compaction_gives_way_to_a_load_of_its_folders(spark, tmp_path):
    base, settings = str(tmp_path / "t"), Settings(target_parts=1, compact_fan=99)
    merge_into(spark, SPEC, base, loads(spark, range(9), 100), settings, reread=True)
    merge_into(spark, SPEC, base, loads(spark, (1,), 200, "b"), settings, reread=True)
    load = lambda i: lambda: merge_into(spark, SPEC, base, loads(spark, (i,), 300 + i, "c"), settings, reread=True)
    assert compact(spark, base, fan=1, smallest=1 << 30, before_switch=load(2)) is None  # key 2 died in a folder being rewritten
    assert compact(spark, base, fan=1, smallest=1 << 30, before_switch=load(50)) is not None  # a new key: both stand
    want = {i: f"v{i}" for i in range(9)} | {1: "b1", 2: "c2", 50: "c50"}
    assert rows(spark, base) == sorted(want.items())
    data = {p.name for p in (tmp_path / "t" / "data").iterdir()}
    for _ in range(3):  # versions that name the old folders are retired
        merge_into(spark, SPEC, base, loads(spark, (60,), 400, "d"), settings, reread=True)
    assert len(data - {p.name for p in (tmp_path / "t" / "data").iterdir()}) >= 2


def test_size_tiers(spark):
    f = lambda a, size, dead=0: versions.Folder(a, "0", 100, size, dead)
    m = versions.Manifest(1, 1, (f("big", 5000), f("a", 9), f("b", 9), f("c", 10)))
    assert to_compact(m, fan=4, smallest=10) == []
    assert {x.attempt for x in to_compact(versions.Manifest(1, 1, (*m.folders, f("d", 3))), fan=4, smallest=10)} == {"a", "b", "c", "d"}
    assert [x.attempt for x in to_compact(versions.Manifest(1, 1, (f("big", 5000, 40), f("a", 9))), fan=4, smallest=10)] == ["big"]


LATE = {"Acme_us_shopify_1_locations": [[(1, 3000), (2, 3000)], [(1, 4000)], []],
        "Zest_ca_shopify_22_locations": [[(3, 1000)], [(3, 2000), (4, 2000)], [(5, 2500)]]}


@pytest.mark.parametrize("kind,found", [("relation", {1: 4000, 2: 3000, 3: 2000, 4: 2000, 5: 2500}), ("global", {1: 4000, 2: 3000, 3: 1000})])
def test_late_batches_of_a_store(spark, tmp_path, kind, found):
    """One watermark a relation loads the batches of a store that lags behind another; one maximum does not (as the source)."""
    raw = {t: [] for t in LATE}
    for step in range(3):
        for t, batches in LATE.items():
            raw[t] += [(i, T, T, f"{i}@{b}", "u", b, 0) for i, b in batches[step]]
        source = MappingSource(spark, {t: spark.createDataFrame(r, SCHEMA) for t, r in raw.items()}, database="lake", schema="raw")
        run_dataset(spark, SPEC, source, str(tmp_path), Settings(target_parts=2, watermark=kind))
    got = {r["id"]: r["_daton_batch_runtime"] for r in read_current(spark, f"{tmp_path}/ShopifyLocations").collect()}
    assert got == found
    if kind == "relation":
        assert read_manifest(spark, f"{tmp_path}/ShopifyLocations").watermarks == {f"`lake`.`raw`.`{t}`": w for t, w in zip(LATE, (4000, 2500))}


def test_each_relation_has_its_own_pushed_filter(spark, tmp_path):
    arms = []
    for name, batch in (("a", 3000), ("b", 1000), ("new", 1)):
        spark.createDataFrame([(1, T, T, "x", "u", batch, 0)], SCHEMA).write.parquet(str(tmp_path / name))
        arms.append((name, spark.read.parquet(str(tmp_path / name))))
    marks = newest_by_relation(arms[:2])
    assert marks == {"a": 3000, "b": 1000}
    plan = build(SPEC, arms, Settings(), watermark=marks, lookback_ms=10)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_daton_batch_runtime,2990)" in plan and "GreaterThanOrEqual(_daton_batch_runtime,990)" in plan
    assert newest_by_relation(arms, marks) == {"a": 3000, "b": 1000, "new": 1}
    with pytest.raises(ValueError):
        Settings(watermark="store")


def test_new_columns_and_wider_numbers_are_read_a_new_kind_is_an_error(spark, tmp_path):
    base, settings = str(tmp_path / "t"), Settings(target_parts=1, compact_fan=99)
    one = loads(spark, (1,), 100).withColumn("n", F.lit(5).cast("int"))
    merge_into(spark, SPEC, base, one, settings, reread=True)
    merge_into(spark, SPEC, base, loads(spark, (2,), 200).withColumns({"n": F.lit(6).cast("long"), "extra": F.lit("x")}), settings, reread=True)
    assert sorted((r["id"], r["n"], r["extra"]) for r in read_current(spark, base).collect()) == [(1, 5, None), (2, 6, "x")]
    with pytest.raises(TypeError, match="full_refresh"):
        merge_into(spark, SPEC, base, loads(spark, (3,), 300).withColumn("n", F.lit("seven")), settings, reread=True)
    assert read_current(spark, base).count() == 2  # and nothing was committed
