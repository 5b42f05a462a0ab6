"""What decides how much a task holds: narrow aggregates, rows dealt out before they grow, many partitions to begin with."""

from rawfold.session import ENGINE_CONF, pin_engine_conf
from rawfold.sources import driver_tables as dt

from paths import SF_SMALL


def test_lines_are_collected_before_they_are_nested(spark):
    plan = dt.nested_orders(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    collected = [line for line in plan.splitlines() if "collect_list" in line]
    assert collected and not any("VAT" in line or "shop_money" in line for line in collected)


def test_records_are_dealt_out_before_they_grow(spark):
    for _, arm in dt.entity_arms(spark, SF_SMALL, "fulfillment_orders", ("destination", "line_items")):
        assert arm.rdd.getNumPartitions() == dt.SPREAD_PARTS


def test_shuffles_begin_with_many_partitions_and_are_merged(spark):
    pin_engine_conf(spark)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert int(spark.conf.get(key)) == int(ENGINE_CONF[key]) >= 400
    few = spark.range(10_000).groupBy("id").count()
    assert few.rdd.getNumPartitions() < 100
