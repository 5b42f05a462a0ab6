from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rawfold.sources.incremental import (
    commit_parts, commit_version, high_watermark, merge_by_key, merge_ranked, read_current, read_manifest, watermark_value,
    write_table,
)


def test_watermark_value_follows_coalesce_semantics():
    assert watermark_value(None) == 0 and watermark_value(None, 30) == 0
    assert watermark_value(100, 30) == 70 and watermark_value(10, 30) == -20


def test_merge_twice_equals_merge_once(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 1)], "k long, v string, b long")
    upd = spark.createDataFrame([(2, "B", 2), (2, "B2", 2), (4, "d", 2)], "k long, v string, b long")
    once = merge_by_key(target, upd, ["k"])
    twice = merge_by_key(once, upd, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert sorted(r.v for r in once.collect()) == ["B", "B2", "a", "c", "d"]


def test_versioned_commit_and_watermark(spark, tmp_path):
    base = str(tmp_path / "ds")
    assert read_current(spark, base) is None
    df = spark.createDataFrame([(1, 5, "2024-01-01"), (2, 9, "2024-01-02")], "k long, _daton_batch_runtime long, d string")
    commit_version(spark, base, df, partition_by="d", cluster_by=["k"])
    cur = read_current(spark, base)
    assert high_watermark(cur) == 9 and cur.count() == 2 and cur.columns == df.columns
    merged = merge_by_key(cur, df.filter(F.col("k") == 2).withColumn("_daton_batch_runtime", F.lit(11)), ["k"])
    commit_version(spark, base, merged, partition_by="d")
    assert high_watermark(read_current(spark, base)) == 11


def _files(base):
    return {str(p) for p in Path(base).rglob("*.parquet")}


def _commit(spark, base, rows, touched, **kw):
    df = spark.createDataFrame(rows, "k long, p string")
    return commit_parts(spark, base, df, read_manifest(spark, base), touched, part=F.col("p"), n_parts=4, cluster_by=["k"], **kw)


def test_untouched_parts_keep_their_files(spark, tmp_path):
    base = str(tmp_path / "ds")
    _commit(spark, base, [(1, "a"), (2, "b")], None)
    first = _files(base)
    _commit(spark, base, [(3, "b"), (4, "c")], ["b", "c"])
    assert {f for f in first if "__part=a" in f} <= _files(base)
    assert sorted(map(tuple, read_current(spark, base).collect())) == [(1, "a"), (3, "b"), (4, "c")]


def test_crash_between_write_and_switch_leaves_the_old_version(spark, tmp_path):
    base = str(tmp_path / "ds")
    _commit(spark, base, [(1, "a")], None)

    def crash():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        _commit(spark, base, [(9, "a")], ["a"], before_switch=crash)
    assert [tuple(r) for r in read_current(spark, base).collect()] == [(1, "a")]
    _commit(spark, base, [(2, "a")], ["a"])  # the next run goes over what was left
    assert [tuple(r) for r in read_current(spark, base).collect()] == [(2, "a")]


def test_old_versions_are_removed_but_folders_in_use_are_not(spark, tmp_path):
    base = str(tmp_path / "ds")
    _commit(spark, base, [(1, "a"), (2, "b")], None)
    for i in range(4):
        _commit(spark, base, [(10 + i, "b")], ["b"], retain=2)
    assert len([p for p in (tmp_path / "ds" / "_versions").iterdir() if p.suffix == ".json" and not p.name.startswith(".")]) == 2
    assert sorted(map(tuple, read_current(spark, base).collect())) == [(1, "a"), (13, "b")]
    assert len([f for f in _files(base) if "__part=b" in f]) == 2  # of the two versions kept


def test_only_a_missing_path_means_no_target(spark, tmp_path):
    assert read_manifest(spark, str(tmp_path / "none")) is None
    with pytest.raises(Exception):  # noqa: B017 - an unreadable store is not an empty one
        read_manifest(spark, "nosuchfs://store/ds")


def test_a_hot_null_id_is_written_by_several_tasks(spark, tmp_path):
    rows = [(0, f"v{i}") for i in range(4000)] + [(i, "x") for i in range(1, 50)]
    df = spark.createDataFrame(rows, "order_id long, v string")
    write_table(df, str(tmp_path / "t"), cluster_by=["order_id"], partitions=8)
    back = spark.read.parquet(str(tmp_path / "t")).withColumn("f", F.input_file_name())
    assert back.filter("order_id = 0").select("f").distinct().count() > 3 and back.count() == len(rows)


def test_merge_ranked_sides(spark):
    schema = "__rk string, __ro struct<b:long>, v string"
    t = spark.createDataFrame([("a", (5,), "t"), ("b", (9,), "t"), ("c", (7,), "t1"), ("c", (7,), "t2"), ("d", (1,), "t")], schema)
    u = spark.createDataFrame([("a", (6,), "u"), ("b", (8,), "u"), ("c", (7,), "u"), ("e", (1,), "u")], schema)
    rows = lambda **kw: sorted((r["__rk"], r.v) for r in merge_ranked(t, u, **kw).collect())
    assert rows(ties=True, reread=True) == [("a", "u"), ("b", "t"), ("c", "u"), ("d", "t"), ("e", "u")]
    assert rows(ties=True, reread=False) == [("a", "u"), ("b", "t"), ("c", "t1"), ("c", "t2"), ("c", "u"), ("d", "t"), ("e", "u")]
    assert rows(ties=False, reread=False) == [("a", "u"), ("b", "t"), ("c", "u"), ("d", "t"), ("e", "u")]
