"""Tables along a Z curve: row groups a filter reads, places of values, tables of a run."""

import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rawfold.config import Settings
from rawfold.plans.builder import build
from rawfold.plans.runner import merge_into
from rawfold.plans.specs import BY_NAME
from rawfold.sources.clustering import Interleaved, bounds, curve, place
from rawfold.sources.incremental import layout_for_write, write_table
from rawfold.sources.versions import compact, read_current

DAY = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def table(spark):
    """Three independent columns; a third of all rows has one customer."""
    n = 120_000
    h = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(10_000))
    return spark.range(n).select(
        "id", F.when(F.col("id") % 3 == 0, 77).otherwise(h(1)).alias("customer"), h(2).alias("subscription"),
        (F.lit(DAY).cast("timestamp_ntz") + F.make_dt_interval(hours=(h(3) / 10).cast("int"))).alias("at"),
        F.concat(F.lit("s"), F.lpad(h(4).cast("string"), 5, "0")).alias("status"))


def groups_read(path, column, low, high):
    """(row groups whose footer may hold a value of the range, all row groups)."""
    hit = total = 0
    for f in Path(path).rglob("*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = next(i for i in range(meta.num_columns) if meta.schema.column(i).name == column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            total += 1
            hit += s.min <= high and s.max >= low
    return hit, total


@pytest.mark.parametrize("column,low,high", [("subscription", 4_000, 4_200), ("status", "s03000", "s03300")])
def test_filters_on_later_columns_read_at_most_half_of_the_row_groups_of_a_sort(table, tmp_path, column, low, high):
    keys = ("customer", "subscription", "status")
    write_table(table, str(tmp_path / "sorted"), cluster_by=keys, partitions=128)
    write_table(table, str(tmp_path / "curve"), cluster_by=Interleaved(keys), partitions=128)
    plain, all_plain = groups_read(tmp_path / "sorted", column, low, high)
    curved, all_curved = groups_read(tmp_path / "curve", column, low, high)
    assert all_plain > 100 and all_curved > 100 and 2 * curved <= plain, (curved, plain)
    back = table.sparkSession.read.parquet(str(tmp_path / "curve"))
    assert back.columns == table.columns and back.exceptAll(table).isEmpty() and back.count() == table.count()


def test_a_hot_value_is_spread_over_tasks(table):
    out = layout_for_write(table, Interleaved(("customer", "subscription", "status")), partitions=32)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 120_000 and max(sizes) < 3 * 120_000 / 32


@pytest.mark.parametrize("column", ["customer", "at", "status"])
def test_places_follow_the_order_of_values(table, column):
    cuts = bounds(table, [column])[0]
    assert len(cuts) == 127 and cuts == sorted(cuts) and bounds(table.repartition(7), [column])[0] == cuts
    from rawfold.sources.clustering import _sortable
    d = table.limit(2_000).select(F.col(column).alias("v"), place(_sortable(table, column), cuts).alias("p"))
    got = sorted((r["v"], r["p"]) for r in d.collect())
    assert [p for _, p in got] == sorted(p for _, p in got) and got[0][1] < 10 and got[-1][1] > 117


def test_interleaved_bits_equal_a_plain_loop(spark):
    d = spark.createDataFrame([(i, (i * 7) % 64, None if i % 9 == 0 else float(i % 5)) for i in range(64)], "a int, b int, c double")
    cuts = bounds(d, ["a", "b", "c"], bits=3)
    for r in curve(d, ["a", "b", "c"], bits=3).collect():
        ranks = [0 if v is None else sum(cut <= v for cut in own) for v, own in zip((r["a"], r["b"], r["c"]), cuts)]
        z = 0
        for b in (2, 1, 0):
            for rank in ranks:
                z = z << 1 | rank >> b & 1
        assert r["__z"] == z


def test_nulls_nan_empty_tables_and_columns_without_an_order(spark, tmp_path):
    d = spark.createDataFrame([(None, float("nan"), None), (1, None, True), (2, 5.0, False), (2, 5.0, False)], "a int, b double, c boolean")
    for i, rows in enumerate((d, d.limit(0))):
        write_table(rows, str(tmp_path / str(i)), cluster_by=Interleaved(("a", "b", "c")))
        assert spark.read.schema(d.schema).parquet(str(tmp_path / str(i))).count() == rows.count()
    with pytest.raises(ValueError, match="no place"):
        curve(d.withColumn("m", F.array("a")), ["m"])
    with pytest.raises(ValueError, match="do not fit"):
        curve(d, ["a"] * 10)


def test_a_run_with_interleaved_folders_merges_and_compacts_to_the_same_rows(spark, tmp_path):
    spec = BY_NAME["ShopifyLocations"]
    name = "`lake`.`raw`.`Acme_us_shopify_1_locations`"
    schema = ("id long, created_at timestamp_ntz, updated_at timestamp_ntz, v string, _daton_user_id string, "
              "_daton_batch_runtime long, _daton_batch_id long")

    def load(ids, batch):
        raw = spark.createDataFrame([(i, DAY, DAY + dt.timedelta(hours=i % 50), f"{batch}-{i}", "u", batch, 0) for i in ids], schema)
        out = build(spec, [(name, raw)], Settings(), include_audit=False, carry_rank=True)
        return spark.createDataFrame(out.collect(), out.schema)
    settings = {True: Settings(target_parts=2, interleave={spec.name: ("updated_at", "v")}), False: Settings(target_parts=2)}
    for on, s in settings.items():
        for ids, batch in ((range(500), 100), (range(0, 500, 10), 200), (range(495, 520), 300)):
            merge_into(spark, spec, str(tmp_path / str(on)), load(ids, batch), s, reread=True)
    compact(spark, str(tmp_path / "True"), fan=2, smallest=1 << 30, cluster_by=Interleaved(("updated_at", "v")))
    a, b = (sorted((r["id"], r["v"]) for r in read_current(spark, str(tmp_path / str(on))).collect()) for on in (True, False))
    assert a == b and len(a) == 520
