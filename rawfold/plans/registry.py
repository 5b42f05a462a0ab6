"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

They run the library's operators over raw tables derived from the given tables
(``rawfold.sources.driver_tables``); ``rawfold.plans.oracle`` holds the DuckDB twin of each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawfold.config import BATCH_ID, BATCH_RUNTIME, SOURCE_RELATION, USER_ID, Settings
from rawfold.operators.fx import fx_left_join
from rawfold.operators.latest import keep_latest
from rawfold.operators.nested import unnest_chain
from rawfold.plans.builder import build
from rawfold.plans.runner import merge_into
from rawfold.plans.specs import BY_NAME, SPECS
from rawfold.session import pin_engine_conf
from rawfold.sources import driver_tables as dt
from rawfold.sources.relations import union_relations
from rawfold.sources.versions import PART, read_current, read_folders

SETTINGS = Settings()
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_engine_conf(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


def rates(spark: SparkSession, d: str) -> DataFrame:
    return build(BY_NAME["ExchangeRates"], dt.rate_arms(spark, d), SETTINGS, include_audit=False)


def dataset(name: str, arms, spark: SparkSession, d: str, **kw) -> DataFrame:
    spec = BY_NAME[name]
    fx = rates(spark, d) if spec.fx is not None else None
    return build(spec, arms, SETTINGS, fx=fx, include_audit=False, **kw)


@query("ShopifyOrders")
def shopify_orders(spark, d):
    """Flagship: current state of every order across stores (union, keep-latest, tz, FX, lineage)."""
    return dataset("ShopifyOrders", dt.order_arms(spark, d), spark, d)


@query("ExchangeRates")
def exchange_rates(spark, d):
    """Daily rates: newest load per (date, from, to) inside each relation, then UNION ALL."""
    return rates(spark, d)


@query("dedup_then_union")
def dedup_then_union(spark, d):
    return rates(spark, d)


@query("union_relations")
def union_rel(spark, d):
    return union_relations(dt.order_arms(spark, d))


@query("union_then_dedup")
def union_then_dedup(spark, d):
    u = union_relations(dt.order_arms(spark, d))
    return keep_latest(u, [F.coalesce("id", F.lit(0))], [BATCH_RUNTIME], ties=True)


@query("latest_dense_rank")
def latest_dense_rank(spark, d):
    return union_then_dedup(spark, d)


@query("latest_row_number")
def latest_row_number(spark, d):
    u = union_relations(dt.order_arms(spark, d))
    return keep_latest(u, [F.coalesce("id", F.lit(0))], [BATCH_RUNTIME], ties=False,
                       tiebreak=[BATCH_ID, SOURCE_RELATION, USER_ID])


@query("fx_left_join")
def fx_join(spark, d):
    u = union_relations(dt.order_arms(spark, d)).select(
        "id", "created_at", "currency", BATCH_RUNTIME, BATCH_ID, SOURCE_RELATION)
    return fx_left_join(u, rates(spark, d), "created_at", "currency", SETTINGS)


@query("explode_outer_items")
def explode_outer_items(spark, d):
    f = unnest_chain(dt.nested_orders(spark, d), ["line_items"])
    return f.select("id", BATCH_RUNTIME, F.col("line_items.id").alias("line_items_id"),
                    F.col("line_items.sku").alias("line_items_sku"),
                    F.col("line_items.quantity").alias("line_items_quantity"))


@query("ShopifyOrdersLineItems")
def shopify_orders_line_items(spark, d):
    return dataset("ShopifyOrdersLineItems", dt.nested_arms(spark, d), spark, d)


# ---- relation names and lineage expressions -------------------------------------------------------
from rawfold.functions.convert import extract_nested, millis_to_ts, to_numeric, to_wallclock, typed_default  # noqa: E402
from rawfold.functions.lineage import brand, integration_id, integration_id_tokens, store_token  # noqa: E402
from rawfold.operators.latest import seq_id as seq_id_op  # noqa: E402
from rawfold.operators.nested import drop_nested_fields, prefixed, struct_star  # noqa: E402
from rawfold.operators.quality import check_not_null, check_recency, check_unique, run_record  # noqa: E402
from rawfold.session import scratch_path  # noqa: E402
from rawfold.sources.clustering import Interleaved  # noqa: E402
from rawfold.sources.incremental import (  # noqa: E402
    high_watermark, merge_by_key, watermark_filter, watermark_subquery_sql, write_table,
)
from rawfold.sources.relations import match_relations  # noqa: E402

CUT = "1998-01-01 00:00:00"
CUT_DATE = "1998-01-01"
RECENCY_AS_OF = "2001-11-04 00:00:00"


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


@query("relation_match")
def relation_match(spark, d):
    """Relations per entity by LIKE pattern minus exclude pattern (case-insensitive)."""
    names = dt.relation_names(spark, d)
    out = None
    for s in SPECS:
        m = match_relations(names, s.pattern, s.exclude_pattern).select(
            F.lit(s.name).alias("entity"), "relation", "table_name")
        out = m if out is None else out.unionByName(m)
    return out


@query("relation_match_schemas")
def relation_match_schemas(spark, d):
    """Order relations of every schema that matches a pattern, as rows of an information schema."""
    parts = F.split(F.translate("relation", "`", ""), r"\.")
    names = dt.relation_names(spark, d).withColumn("table_schema", F.concat(F.get(parts, 1), F.lit("_"), F.substring(F.lower("table_name"), 1, 1)))
    return match_relations(names, "%shopify%orders%", "%draft%", schema_pattern="raw_a%").select("table_schema", "relation", "table_name")


@query("merge_on_read")
def merge_on_read(spark, d):
    """Orders loaded up to a cut, then the rest: read through delete sets, the rows of one build over all."""
    base, spec = scratch_path(spark, "merge_on_read"), BY_NAME["ShopifyOrders"]
    arms = dt.order_arms(spark, d)
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    for old in (True, False):
        some = [(n, df.filter((F.col("updated_at") < cut) if old else (F.col("updated_at") >= cut))) for n, df in arms]
        updates = build(spec, some, SETTINGS.with_(currency_conversion=False), include_audit=False, carry_rank=True)
        path = scratch_path(spark, "merge_on_read_updates")
        updates.write.parquet(path)
        merge_into(spark, spec, base, spark.read.parquet(path), SETTINGS, reread=True)
    return read_current(spark, base).select("order_id", SOURCE_RELATION, BATCH_RUNTIME, BATCH_ID)


@query("brand_from_source")
def brand_from_source(spark, d):
    return dt.relation_names(spark, d).select("relation", brand("relation").alias("brand"))


@query("integration_id")
def integration_id_q(spark, d):
    return dt.relation_names(spark, d).select(
        "relation", integration_id("relation").alias("_daton_sourceversion_integration_id"))


@query("integration_id_tokens")
def integration_id_tokens_q(spark, d):
    return dt.relation_names(spark, d).select(
        "relation", integration_id_tokens("relation").alias("_daton_sourceversion_integration_id"))


@query("store_token")
def store_token_q(spark, d):
    return dt.relation_names(spark, d).select("relation", store_token("relation").alias("store"))


# ---- union, projection, defaults, conversions ---------------------------------------------------
def _union(spark, d, **kw):
    return union_relations(dt.order_arms(spark, d), **kw)


@query("union_exclude")
def union_exclude(spark, d):
    return _union(spark, d, exclude=["total_price", "financial_status"])


@query("union_nested_types")
def union_nested_types(spark, d):
    """Stores whose nested items differ in type: an array of (long id, price), an array of (text id, decimal price, note), one object."""
    u = union_relations(dt.mixed_item_arms(spark, d))
    x = unnest_chain(u, ["items"])
    return x.select("order_id", SOURCE_RELATION, F.col("items.id").alias("item_id"), F.col("items.price").alias("price"),
                    F.col("items.note").alias("note"))


@query("star_except")
def star_except(spark, d):
    u = _union(spark, d)
    rest = [c for c in u.columns if c not in ("id", "created_at", "updated_at", SOURCE_RELATION, USER_ID,
                                              BATCH_RUNTIME, BATCH_ID)]
    return u.select(brand().alias("brand"), F.coalesce("id", F.lit(0)).alias("order_id"), *rest)


@query("null_defaults")
def null_defaults(spark, d):
    u = _union(spark, d)
    types = dict((f.name, f.dataType) for f in u.schema.fields)
    return u.select(typed_default("id", 0, types["id"]).alias("order_id"),
                    typed_default("email", "N/A", types["email"]).alias("email"),
                    typed_default("id", "N/A", types["id"]).alias("id_text"),
                    SOURCE_RELATION, BATCH_RUNTIME, BATCH_ID)


@query("audit_columns")
def audit_columns_q(spark, d):
    return _union(spark, d).select("id", BATCH_RUNTIME, BATCH_ID, brand().alias("brand"),
                                   integration_id().alias("_daton_sourceversion_integration_id"),
                                   F.lit(SETTINGS.run_id).alias("_run_id"))


@query("coalesce_numeric")
def coalesce_numeric(spark, d):
    r = dt.raw_rates(spark, d)
    return r.select("date", "from_currency_code", "to_currency_code", "value_bn", BATCH_RUNTIME,
                    F.coalesce("value", to_numeric("value_bn")).alias("value"))


@query("tz_convert")
def tz_convert(spark, d):
    e = dt.read(spark, d, "events")
    moved = F.timestamp_add("MONTH", (F.col("event_id") % 12).cast("int"), F.col("ts"))
    return e.select("event_id", moved.alias("ts_utc"),
                    to_wallclock(moved, SETTINGS, e.schema["ts"].dataType).alias("ts_local"))


@query("millis_to_ts")
def millis_to_ts_q(spark, d):
    return dt.order_versions(spark, d).select("id", BATCH_RUNTIME, millis_to_ts(BATCH_RUNTIME).alias("batch_ts"))


# ---- incremental loads -----------------------------------------------------------------------------
def _loaded(u):
    return u.filter(F.col("updated_at") < _ts(CUT))


@query("watermark_max")
def watermark_max(spark, d):
    u = _union(spark, d)
    return _loaded(u).agg(F.coalesce(F.max(BATCH_RUNTIME), F.lit(0)).alias("watermark"))


@query("incremental_watermark")
def incremental_watermark(spark, d):
    """Watermark read once (one small job), then applied as a literal pushed into every arm."""
    w = high_watermark(_loaded(_union(spark, d)))
    return union_relations(dt.order_arms(spark, d), where=watermark_filter(w))


@query("scalar_subquery_filter")
def scalar_subquery_filter(spark, d):
    """The same filter as an uncorrelated scalar subquery in Spark SQL."""
    u = _union(spark, d)
    return spark.sql(f"SELECT * FROM {{u}} WHERE {watermark_subquery_sql('{t}')}",
                     u=u, t=_loaded(u))


@query("incremental_lookback")
def incremental_lookback(spark, d):
    target = rates(spark, d).filter(F.col("date") < F.lit(CUT_DATE).cast("date"))
    w = high_watermark(target)
    return build(BY_NAME["ExchangeRates"], dt.rate_arms(spark, d), SETTINGS, include_audit=False,
                 watermark=w, lookback_ms=SETTINGS.fx_lookback_ms)


def _state(u):
    return keep_latest(u, [F.coalesce("id", F.lit(0))], [BATCH_RUNTIME]).select(
        F.coalesce("id", F.lit(0)).alias("order_id"), "updated_at", "total_price", SOURCE_RELATION,
        BATCH_RUNTIME, BATCH_ID)


@query("merge_upsert")
def merge_upsert(spark, d):
    """Full load of the rows before the cut, then one incremental load merged by key."""
    u = _union(spark, d)
    target = _state(_loaded(u))
    w = high_watermark(target)
    updates = _state(u.filter(watermark_filter(w)))
    return merge_by_key(target, updates, ["order_id"])


@query("partition_by_date")
def partition_by_date(spark, d):
    """Write date-partitioned, clustered by key; count rows per partition read back."""
    path = scratch_path(spark, "partition_by_date")
    df = _union(spark, d).withColumn("created_date", F.to_date("created_at"))
    write_table(df, path, partition_by="created_date", cluster_by=["id"])
    back = spark.read.parquet(path)
    return back.groupBy("created_date").agg(F.count(F.lit(1)).alias("row_count"))


@query("partition_granularity")
def partition_granularity(spark, d):
    """Orders merged into parts by time: days at first, months once the days are more than the bound; rows by part."""
    base, spec = scratch_path(spark, "partition_granularity"), BY_NAME["ShopifyOrders"]
    settings = SETTINGS.with_(currency_conversion=False, timezone_conversion=False, partition_by={spec.name: "updated_at"}, max_parts=400)
    arms = dt.order_arms(spark, d)
    cut = F.lit("1993-01-01 00:00:00").cast("timestamp_ntz")
    for old in (True, False):
        some = [(n, df.filter((F.col("updated_at") < cut) if old else (F.col("updated_at") >= cut))) for n, df in arms]
        path = scratch_path(spark, "partition_granularity_updates")
        build(spec, some, settings, include_audit=False, carry_rank=True).write.parquet(path)
        m = merge_into(spark, spec, base, spark.read.parquet(path), settings, reread=True)
    rows = read_folders(spark, base, m, m.folders, placed=True)
    return rows.groupBy(F.col(PART).alias("part")).agg(
        F.count(F.lit(1)).alias("row_count"), F.min("order_id").alias("min_order_id"), F.max("order_id").alias("max_order_id"))


@query("cluster_interleaved")
def cluster_interleaved(spark, d):
    """Write along a Z curve over three columns; what a filter on the second one reads back, by store and day."""
    path = scratch_path(spark, "cluster_interleaved")
    write_table(_union(spark, d), path, cluster_by=Interleaved(("id", "updated_at", "total_price")))
    recent = spark.read.parquet(path).filter(F.col("updated_at") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    return (recent.groupBy(SOURCE_RELATION, F.to_date("updated_at").alias("updated_date"))
            .agg(F.count(F.lit(1)).alias("row_count"), F.min("id").alias("min_id"), F.max("id").alias("max_id")))


@query("run_audit")
def run_audit(spark, d):
    return run_record(spark, "ShopifyOrders", shopify_orders(spark, d), SETTINGS.run_id)


# ---- keep-latest variants ----------------------------------------------------------------------------
@query("latest_multi_order")
def latest_multi_order(spark, d):
    return keep_latest(_union(spark, d), [F.coalesce("id", F.lit(0))], ["updated_at", BATCH_RUNTIME, BATCH_ID])


@query("latest_composite_key")
def latest_composite_key(spark, d):
    return keep_latest(_union(spark, d), [F.coalesce("id", F.lit(0)), F.coalesce(USER_ID, F.lit("N/A"))],
                       [BATCH_RUNTIME])


@query("seq_id")
def seq_id_q(spark, d):
    return seq_id_op(_union(spark, d), [F.coalesce("id", F.lit(0))], [BATCH_RUNTIME],
                     tiebreak=[BATCH_ID, SOURCE_RELATION, USER_ID, "name"], strategy=SETTINGS.seq_strategy)


# ---- nested data -----------------------------------------------------------------------------------
def _nested(spark, d, steps):
    return unnest_chain(dt.nested_orders(spark, d), steps)


TAX_CHAIN = ["line_items", ("line_items", "tax_lines"), ("tax_lines", "price_set"), ("price_set", "shop_money")]


@query("explode_chain")
def explode_chain(spark, d):
    f = _nested(spark, d, TAX_CHAIN)
    return f.select("id", BATCH_RUNTIME, F.col("line_items.id").alias("line_items_id"),
                    F.col("tax_lines.title").alias("title"), F.col("shop_money.amount").alias("shop_money_amount"),
                    F.col("shop_money.currency_code").alias("shop_money_currency_code"))


@query("explode_siblings")
def explode_siblings(spark, d):
    f = _nested(spark, d, TAX_CHAIN + [("price_set", "presentment_money")])
    return f.select("id", BATCH_RUNTIME, F.col("line_items.id").alias("line_items_id"),
                    F.col("shop_money.amount").alias("shop_money_amount"),
                    F.col("shop_money.currency_code").alias("shop_money_currency_code"),
                    F.col("presentment_money.amount").alias("presentment_money_amount"),
                    F.col("presentment_money.currency_code").alias("presentment_money_currency_code"))


@query("filter_before_latest")
def filter_before_latest(spark, d):
    """WHERE on the unnested child before the rank: older batches reappear for those orders."""
    f = _nested(spark, d, ["line_items", ("line_items", "tax_lines")]).filter(F.col("tax_lines.price").isNotNull())
    f = keep_latest(f, [F.coalesce("id", F.lit(0))], [BATCH_RUNTIME])
    return f.select(F.coalesce("id", F.lit(0)).alias("order_id"), BATCH_RUNTIME,
                    F.col("line_items.id").alias("line_items_id"), F.col("tax_lines.price").alias("tax_price"))


@query("struct_star")
def struct_star_q(spark, d):
    f = _nested(spark, d, ["line_items"])
    star = struct_star(f, "line_items", ["tax_lines", "discount_allocations", "properties"],
                       taken=["order_id", BATCH_RUNTIME])
    return f.select(F.col("id").alias("order_id"), BATCH_RUNTIME, *[c.alias(n) for n, c in star])


@query("drop_nested_fields")
def drop_nested_fields_q(spark, d):
    f = drop_nested_fields(dt.nested_orders(spark, d), "line_items", ["tax_lines", "discount_allocations", "properties"])
    f = unnest_chain(f, ["line_items"])
    return f.select(F.col("id").alias("order_id"), BATCH_RUNTIME, "line_items.*")


@query("flatten_prefixed")
def flatten_prefixed(spark, d):
    f = _nested(spark, d, ["line_items", "shipping_address"])
    cols = prefixed(f, "line_items", ["product_id", "sku", "quantity"]) + prefixed(f, "shipping_address", ["city", "zip"])
    return f.select(F.col("id").alias("order_id"), *[c.alias(n) for n, c in cols])


@query("extract_nested")
def extract_nested_q(spark, d):
    f = _nested(spark, d, ["line_items", "billing_address"])
    return f.select(F.col("id").alias("order_id"), extract_nested("line_items.id", "string").alias("line_items_id"),
                    extract_nested("line_items.price", "numeric").cast("double").alias("line_items_price"),
                    extract_nested("billing_address.city", "string").alias("billing_address_city"))


@query("latest_after_explode")
def latest_after_explode(spark, d):
    f = keep_latest(_nested(spark, d, ["line_items"]), [F.coalesce("id", F.lit(0)), F.col("line_items.sku")],
                    [BATCH_RUNTIME])
    return f.select(F.coalesce("id", F.lit(0)).alias("order_id"), F.col("line_items.sku").alias("sku"),
                    F.col("line_items.id").alias("line_items_id"), BATCH_RUNTIME)


@query("latest_by_content")
def latest_by_content(spark, d):
    """Aliases first, then a row_number over every output attribute."""
    f = _nested(spark, d, ["line_items", ("line_items", "tax_lines")])
    c = f.select(F.coalesce("id", F.lit(0)).alias("order_id"), F.col("line_items.sku").alias("line_items_sku"),
                 F.coalesce("tax_lines.title", F.lit("")).alias("title"),
                 F.coalesce("tax_lines.rate", F.lit(0.0)).alias("rate"), BATCH_RUNTIME, BATCH_ID)
    return keep_latest(c, ["order_id", "line_items_sku", "title", "rate"], [BATCH_RUNTIME, BATCH_ID], ties=False)


# ---- data checks -----------------------------------------------------------------------------------
@query("check_unique")
def check_unique_q(spark, d):
    return check_unique(rates(spark, d), ["date", "from_currency_code", "to_currency_code"])


@query("check_not_null")
def check_not_null_q(spark, d):
    return check_not_null(_union(spark, d), ["id", "email"])


@query("check_recency")
def check_recency_q(spark, d):
    import datetime as _dt
    as_of = _dt.datetime.fromisoformat(RECENCY_AS_OF)
    return check_recency(_union(spark, d), "updated_at", as_of, 365, group_by=["email"])


# ---- spec-built order datasets over the nested raw orders -----------------------------------------
def _nested_dataset(name):
    def run(spark, d):
        return dataset(name, dt.nested_arms(spark, d), spark, d)
    run.__doc__ = f"The {name} staging dataset built from its spec."
    return run


for _name in ("ShopifyOrdersAddresses", "ShopifyOrdersNoteAttributes", "ShopifyOrdersLineItemsProperties",
              "ShopifyOrdersLineItemsTaxLines", "ShopifyOrdersDiscountAllocations", "ShopifyOrdersShippingLines",
              "ShopifyOrdersShippingLinesTaxLines", "ShopifyOrdersShippingLinesDiscountAllocations",
              "ShopifyOrdersDiscountApplications", "ShopifyOrdersFulfillments", "ShopifyOrdersCustomer"):
    query(_name)(_nested_dataset(_name))


# ---- spec-built flat datasets over customers loaded three times ------------------------------------
FLAT_ENTITIES = {
    "ShopifyLocations": "locations", "ShopifyInventoryItems": "inventory_items",
    "ShopifyInventoryLevels": "inventory_levels", "ShopifyCustomerAddress": "customer_address",
    "ShopifyGiftCards": "gift_cards", "ShopifyPolicies": "policies",
    "ShopifyFulfillmentEvents": "fulfillment_events", "ShopifyTenderTransactions": "tender_transactions",
    "ShopifyAbandonedCheckouts": "abandoned_checkouts", "ShopifyShop": "shop",
    "ShopifyCollects": "collects", "ShopifyProductMetafields": "product_metafields",
    "ShopifyCustomCollections": "custom_collections", "ShopifyPriceRules": "price_rules",
    "ShopifyEvents": "events", "ShopifyDisputes": "disputes", "ShopifyCarrierServices": "carrier_services",
    "ShopifyBalanceTransactions": "balance_transactions", "ShopifySmartCollections": "smart_collections",
}


def _flat_dataset(name, entity):
    def run(spark, d):
        return dataset(name, dt.flat_arms(spark, d, entity), spark, d)
    run.__doc__ = f"The {name} staging dataset built from its spec over flat raw records."
    return run


for _name, _entity in FLAT_ENTITIES.items():
    query(_name)(_flat_dataset(_name, _entity))


# ---- spec-built datasets over flat records with nested columns -------------------------------------
ENTITY_NESTED = {
    "ShopifyCustomers": ("customers", ("default_address",)),
    "ShopifyTransactions": ("transactions", ("receipt",)),
    "ShopifyPayouts": ("payouts", ("summary",)),
    "ShopifyCountries": ("countries", ("provinces",)),
    "ShopifyFulfillmentOrders": ("fulfillment_orders", ("destination", "line_items")),
}


def _entity_dataset(name, entity, nested):
    def run(spark, d):
        arms = dt.entity_arms(spark, d, entity, nested)
        if name == "ShopifyFulfillmentOrders":  # raw fulfillment orders carry fulfill_at
            arms = [(r, df.withColumn("fulfill_at", F.col("updated_at"))) for r, df in arms]
        return dataset(name, arms, spark, d)
    run.__doc__ = f"The {name} staging dataset built from its spec over records with nested columns."
    return run


for _ds, (_ent, _cols) in ENTITY_NESTED.items():
    query(_ds)(_entity_dataset(_ds, _ent, _cols))


@query("ShopifyProducts")
def shopify_products(spark, d):
    """Products with variants -> presentment prices -> price, from ``part``."""
    return dataset("ShopifyProducts", dt.product_arms(spark, d), spark, d)


def _refund_dataset(name):
    def run(spark, d):
        return dataset(name, dt.refund_arms(spark, d), spark, d)
    run.__doc__ = f"The {name} staging dataset built from its spec over raw refunds (returned line items)."
    return run


for _name in ("ShopifyRefundsLineItems", "ShopifyRefundsLineItemsTax", "ShopifyRefundsOrderAdjustments",
              "ShopifyRefundsTransactions"):
    query(_name)(_refund_dataset(_name))
