"""Physical-plan properties of the flagship dataset (what a 100 TB run relies on)."""

from rawfold.plans.registry import QUERIES
from rawfold.sources import driver_tables

from paths import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan(spark):
    df = QUERIES["ShopifyOrders"](spark, SF_SMALL)
    plan = _plan(df)
    assert "partial_max" in plan and "dense_rank" not in plan  # keep-latest pre-aggregates (the windows are the rates')
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # the max-per-key branch reads only the columns it needs
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
    df.collect()
    assert "BroadcastHashJoin" in _plan(df)  # small rates: AQE broadcasts them from their measured size


def test_nested_dataset_ranks_parents_before_unnesting(spark):
    plan = _plan(QUERIES["ShopifyOrdersLineItems"](spark, SF_SMALL))
    gen = plan.index("Generate explode")
    assert gen < plan.index("partial_max")  # printed top-down: the explode sits above the keep-latest join


def test_row_number_dataset_limits_each_key_before_the_shuffle(spark):
    plan = _plan(QUERIES["ShopifyInventoryItems"](spark, SF_SMALL))
    assert plan.count("WindowGroupLimit") >= 2 and "SortAggregate" not in plan


def test_no_job_runs_while_a_query_is_built(spark, monkeypatch):
    """Exceptions, all documented: watermarks, staged writes, and counting the parents of numbered datasets."""
    tables = {t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("orders", "lineitem", "customer", "part")}
    monkeypatch.setattr(driver_tables, "read", lambda s, d, name: tables[name])  # reading a file's schema is a job
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    for name in ("ShopifyOrders", "fx_left_join", "ShopifyOrdersLineItems", "ShopifyTransactions", "latest_row_number"):
        QUERIES[name](spark, SF_SMALL)
    assert set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before
