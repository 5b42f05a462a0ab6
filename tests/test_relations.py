from pyspark.sql import functions as F

from rawfold.plans.specs import BY_NAME
from rawfold.sources.relations import MappingSource, discover, matches, union_relations


def test_like_patterns_follow_the_source_excludes():
    o = BY_NAME["ShopifyOrders"]
    assert matches("Acme_us_shopify_1_orders", o.pattern, o.exclude_pattern)
    assert not matches("Acme_us_shopify_1_draft_orders", o.pattern, o.exclude_pattern)
    assert not matches("Acme_us_shopify_1_fulfillment_orders", o.pattern, o.exclude_pattern)
    t = BY_NAME["ShopifyTransactions"]
    assert matches("a_shopify_2_balance_transactions", t.pattern, t.exclude_pattern)  # picked up, as in the source
    assert not matches("a_shopify_2_tender_transactions", t.pattern, t.exclude_pattern)
    e = BY_NAME["ShopifyEvents"]
    assert matches("a_shopify_events_2024", e.pattern, e.exclude_pattern)
    assert not matches("a_shopify_fulfillment_events", e.pattern, e.exclude_pattern)
    assert matches("X_SHOPIFY_1_ORDERS", o.pattern, o.exclude_pattern)  # case-insensitive
    # ``_`` is LIKE's one-character wildcard, ``%`` any run; the match is anchored at both ends
    assert matches("a_shopifyX1Yorders", "%shopify_1_orders") and not matches("a_shopify_1_orders_x", "%shopify_1_orders")


def test_union_by_name_superset_types_and_where(spark):
    a = spark.createDataFrame([(1, "x", 10)], "id long, name string, _daton_batch_runtime long")
    b = spark.createDataFrame([("7", 20, 3.5)], "id string, _daton_batch_runtime long, extra double")
    u = union_relations([("r.a", a), ("r.b", b)], exclude=["extra", "nested.field"],
                        where=F.col("_daton_batch_runtime") >= 0)
    assert u.schema["id"].dataType.simpleString() == "string"  # bigint vs string -> string, never a failing cast
    rows = {r["_dbt_source_relation"]: r.asDict() for r in u.collect()}
    assert rows["r.b"]["name"] is None and rows["r.a"]["id"] == "1"
    assert "extra" not in u.columns
    assert u.filter(F.col("_daton_batch_runtime") >= 15).count() == 1


def test_watermark_reaches_every_scan(spark, tmp_path):
    for n in ("a_shopify_1_orders", "b_shopify_2_orders"):
        spark.createDataFrame([(1, 5), (2, 50)], "id long, _daton_batch_runtime long").write.parquet(str(tmp_path / n))
    src = MappingSource(spark, {n: str(tmp_path / n) for n in ("a_shopify_1_orders", "b_shopify_2_orders")})
    rels = discover(src, "%shopify%orders")
    u = union_relations(rels, where=F.col("_daton_batch_runtime") >= F.lit(10))
    plan = u._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: [IsNotNull(_daton_batch_runtime), GreaterThanOrEqual(_daton_batch_runtime,10)]") == 2
    assert u.count() == 2


def test_scope_by_source_keeps_equal_ids_of_two_stores(spark):
    from rawfold.config import Settings
    from rawfold.plans.builder import build
    from rawfold.plans.specs import BY_NAME
    a = spark.createDataFrame([(1, 10, 1), (1, 20, 2)], "id long, _daton_batch_runtime long, _daton_batch_id long")
    b = spark.createDataFrame([(1, 15, 3)], "id long, _daton_batch_runtime long, _daton_batch_id long")
    arms = [("`d`.`raw`.`A_x_shopify_1_carrier_services`", a), ("`d`.`raw`.`B_y_shopify_2_carrier_services`", b)]
    spec = BY_NAME["ShopifyCarrierServices"]
    shared = build(spec, arms, Settings(), include_audit=False)
    scoped = build(spec, arms, Settings(scope_by_source=True), include_audit=False)
    assert sorted(r._daton_batch_runtime for r in shared.collect()) == [20]
    assert sorted(r._daton_batch_runtime for r in scoped.collect()) == [15, 20]
