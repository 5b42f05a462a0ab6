"""Raw connector-shaped tables derived from the driver's TPC-H style tables.

The staging recipe reads append-only raw tables in which every load (batch) re-emits a record.
These builders derive such tables from the given tables with plain DataFrame operations, so their
size grows with the input:

* ``order_versions``  - one raw order row per ``lineitem`` row (batch = ship date in epoch ms),
  split into two store relations by supplier parity; store B lacks the ``tags`` column.
* ``nested_orders``   - one raw order per (order, ship date) with nested ``line_items``
  (tax lines -> price sets -> money arrays, discount allocations, properties), a struct
  ``shipping_address``, an array ``billing_address`` and ``note_attributes``; orders without
  items get one version with a NULL ``line_items`` array.
* ``rate_arms``       - daily exchange rates for codes C0..C3 (two ``from`` codes for C1, value only
  as text for C3), two loads per key, in two relations (the second repeats C0).

Every expression here has a twin in ``rawfold.plans.oracle`` (DuckDB SQL) so results can be compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed relation names of the derived raw tables.
ORDERS_A = "`lake`.`raw`.`Acme_us_shopify_1_orders`"
ORDERS_B = "`lake`.`raw`.`Zest_ca_shopify_22_orders`"
RATES_A = "`lake`.`shared`.`daton_exchange_rates`"
RATES_B = "`lake`.`shared`.`backup_exchange_rates`"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _cur(custkey: Column) -> Column:
    return F.concat(F.lit("C"), _s(custkey % 5))


def _order_fields() -> list[Column]:
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    return [
        F.when(ok % 97 == 0, F.lit(None).cast("long")).otherwise(ok).alias("id"),
        F.concat(F.lit("#"), _s(ok)).alias("name"),
        F.when(ck % 7 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("c"), _s(ck), F.lit("@shop.test"))).alias("email"),
        _cur(ck).alias("currency"),
        F.col("o_orderstatus").alias("financial_status"),
        F.col("o_totalprice").alias("total_price"),
        F.col("o_orderpriority").alias("tags"),
        F.col("o_orderdate").alias("created_at"),
    ]


def _epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat raw order rows, one per line item (``arm`` = store 0/1)."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate")
    o = read(spark, sf_dir, "orders")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return j.select(
        *_order_fields(),
        F.col("l_shipdate").alias("updated_at"),
        F.concat(F.lit("u"), _s(F.col("l_suppkey") % 10)).alias("_daton_user_id"),
        _epoch_ms(F.col("l_shipdate")).alias("_daton_batch_runtime"),
        F.col("l_linenumber").cast("long").alias("_daton_batch_id"),
        (F.col("l_suppkey") % 2).alias("arm"),
    )


def order_arms(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    v = order_versions(spark, sf_dir)
    return [(ORDERS_A, v.filter(F.col("arm") == 0).drop("arm")),
            (ORDERS_B, v.filter(F.col("arm") == 1).drop("arm", "tags"))]


def _money(amount: Column, code: Column) -> Column:
    return F.struct(amount.alias("amount"), code.alias("currency_code"))


def _when_array(cond: Column, element: Column) -> Column:
    """``[element]`` when ``cond`` else ``[]`` (same element type, stays in generated code)."""
    return F.slice(F.array(element), 1, F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def nested_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders with nested arrays, one version per (order, ship date).

    One shuffle: ``orders LEFT JOIN lineitem`` on the order key, then an aggregate per
    (order, ship date) that reuses the join's hash partitioning on the order key.
    """
    li = read(spark, sf_dir, "lineitem")
    o = read(spark, sf_dir, "orders")
    j = o.join(li, o["o_orderkey"] == li["l_orderkey"], "left")
    cur = _cur(F.col("o_custkey"))
    order_cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    # the lines are collected as they are; the nested item is made of them afterwards
    line = F.struct("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                    "l_returnflag", "l_linestatus")
    g = j.groupBy(*order_cols, "l_shipdate").agg(
        F.count("l_orderkey").alias("n_items"),
        F.collect_list(F.when(F.col("l_orderkey").isNotNull(), line)).alias("lines"))

    def item(x: Column) -> Column:
        tax_amt = x["l_extendedprice"] * x["l_tax"]
        disc_amt = x["l_extendedprice"] * x["l_discount"]
        tax_line = F.struct(
            F.lit("VAT").alias("title"), x["l_tax"].alias("rate"), tax_amt.alias("price"),
            F.array(F.struct(F.array(_money(tax_amt, F.lit("USD"))).alias("shop_money"),
                             F.array(_money(tax_amt, cur), _money(tax_amt, F.lit("USD"))).alias("presentment_money"))
                    ).alias("price_set"))
        allocation = F.struct(
            disc_amt.alias("amount"), (x["l_linenumber"] - 1).cast("long").alias("discount_application_index"),
            F.array(F.struct(F.array(_money(disc_amt, F.lit("USD"))).alias("shop_money"),
                             F.array(_money(disc_amt, cur)).alias("presentment_money"))).alias("amount_set"))
        return F.struct(
            (F.col("o_orderkey") * 10 + x["l_linenumber"]).alias("id"),
            x["l_partkey"].alias("product_id"),
            x["l_suppkey"].alias("variant_id"),
            F.concat(F.lit("SKU-"), _s(x["l_partkey"])).alias("sku"),
            F.concat(F.lit("item-"), _s(x["l_linenumber"])).alias("name"),
            x["l_quantity"].alias("quantity"),
            x["l_extendedprice"].alias("price"),
            _when_array(x["l_tax"] > 0, tax_line).alias("tax_lines"),
            _when_array(x["l_discount"] > 0, allocation).alias("discount_allocations"),
            F.array(F.struct(F.lit("returnflag").alias("name"), x["l_returnflag"].alias("value")),
                    F.struct(F.lit("linestatus").alias("name"), x["l_linestatus"].alias("value"))).alias("properties"))

    items = F.when(F.col("n_items") > 0, F.transform("lines", item))
    ck = F.col("o_custkey")
    addr = F.struct(
        F.concat(_s(F.col("o_orderkey")), F.lit(" Main St")).alias("address1"),
        F.lit(None).cast("string").alias("address2"),
        F.concat(F.lit("City"), _s(ck % 50)).alias("city"),
        F.lpad(_s(ck % 100000), 5, "0").alias("zip"),
        F.concat(F.lit("P"), _s(ck % 13)).alias("province"),
        F.concat(F.lit("N"), _s(ck % 25)).alias("country"),
        F.concat(F.lit("Cust"), _s(ck)).alias("last_name"))
    shipped = F.coalesce(F.col("l_shipdate"), F.col("o_orderdate"))
    ok, st = F.col("o_orderkey"), F.col("o_orderstatus")
    price_text = F.concat(_s(ok % 100), F.lit("."), F.lpad(_s(ck % 100), 2, "0"))
    ship_tax = F.struct(price_text.alias("price"), F.lit("0.10").alias("rate"), F.lit("Ship VAT").alias("title"),
                        F.lit(None).cast("string").alias("channel_liable"))
    ship_disc = F.struct(price_text.alias("amount"), F.lit(0).cast("long").alias("discount_application_index"))
    shipping = F.struct(
        (ok * 10 + 1).alias("id"), F.lit("Standard").alias("title"), price_text.alias("price"),
        _when_array(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), ship_tax).alias("tax_lines"),
        _when_array(st == "F", ship_disc).alias("discount_allocations"))

    def application(value: str, method: str) -> Column:  # the two of an order differ in their last fields only
        return F.struct(
            F.lit("line_item").alias("target_type"),
            F.when(ck % 3 == 0, F.lit(None).cast("string")).otherwise(F.lit("discount_code")).alias("type"),
            F.lit("percentage").alias("value_type"), F.lit(value).alias("value"),
            F.lit(method).alias("allocation_method"))

    applications = F.array(application("10.0", "across"), application("10.0", "each"), application("5.0", "each"))
    fulfillment = F.struct(
        (ok * 10 + 2).alias("id"), ok.alias("order_id"), F.concat(F.lit("#"), _s(ok), F.lit(".1")).alias("name"),
        F.lit("success").alias("status"), F.lit("r").alias("receipt"), F.lit("gid").alias("admin_graphql_api_id"),
        items.alias("line_items"))
    customer = F.struct(
        F.when(ck % 7 == 0, F.lit(None).cast("long")).otherwise(ck).alias("id"),
        F.col("o_orderdate").alias("created_at"), shipped.alias("updated_at"),
        F.concat(F.lit("F"), _s(ck)).alias("first_name"), F.concat(F.lit("L"), _s(ck)).alias("last_name"),
        F.lit("regular").alias("state"),
        F.array(F.struct((ck * 10).alias("id"), ck.alias("customer_id"),
                         F.concat(F.lit("555-"), F.lpad(_s(ck % 10000), 4, "0")).alias("phone"),
                         F.concat(F.lit("City"), _s(ck % 50)).alias("city"))).alias("default_address"))
    return g.select(
        *_order_fields(),
        shipped.alias("updated_at"),
        items.alias("line_items"),
        addr.alias("shipping_address"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.array(addr)).alias("billing_address"),
        F.array(F.struct(F.lit("priority").alias("name"), F.col("o_orderpriority").alias("value")),
                F.struct(F.lit("status").alias("name"), F.col("o_orderstatus").alias("value"))).alias("note_attributes"),
        F.array(shipping).alias("shipping_lines"),
        F.slice(applications, 1, F.when(st == "O", F.lit(3)).otherwise(F.lit(0))).alias("discount_applications"),
        _when_array(st == "F", fulfillment).alias("fulfillments"),
        F.array(customer).alias("customer"),
        F.concat(F.lit("u"), _s(ck % 10)).alias("_daton_user_id"),
        _epoch_ms(shipped).alias("_daton_batch_runtime"),
        F.col("n_items").alias("_daton_batch_id"),
    )


def nested_arms(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    return [(ORDERS_A, nested_orders(spark, sf_dir))]


ENTITY_RATES_FROM, ENTITY_RATE_DAYS = "2021-02-27", 130


def raw_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw daily rates (``arm`` 0 = main relation; C0 rows are repeated in relation 1).

    Days: those of the orders, and the days of the flat entities (one per customer, ``ENTITY_RATE_DAYS`` in all)."""
    days = read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))
    more = read(spark, sf_dir, "customer").select(F.date_add(
        F.lit(ENTITY_RATES_FROM).cast("date"), (F.col("c_custkey") % ENTITY_RATE_DAYS).cast("int")).alias("d"))
    d = days.unionByName(more).distinct()
    x = (d.select("d", F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("k"))
          .select("d", "k", F.explode(F.when(F.col("k") == 1, F.array(F.lit("USD"), F.lit("EUR")))
                                      .otherwise(F.array(F.lit("USD")))).alias("f"))
          .select("d", "k", "f", F.explode(F.array(F.lit(0), F.lit(1))).alias("v")))
    k, v, day = F.col("k"), F.col("v"), F.dayofmonth("d")
    value = (k + 1).cast("double") + day.cast("double") / F.lit(100.0) + v.cast("double") / F.lit(1000.0)
    return x.select(
        F.col("d").alias("date"), F.col("f").alias("from_currency_code"),
        F.concat(F.lit("C"), _s(k)).alias("to_currency_code"),
        F.when(k == 3, F.lit(None).cast("double")).otherwise(value).alias("value"),
        F.concat(_s(k + 1), F.lit("."), F.lpad(_s(day), 2, "0"), _s(v)).alias("value_bn"),
        F.lit("fx").alias("_daton_user_id"),
        (_epoch_ms(F.col("d")) + v * 3600000).alias("_daton_batch_runtime"),
        v.cast("long").alias("_daton_batch_id"),
        k.alias("k"),
    )


def rate_arms(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    r = raw_rates(spark, sf_dir)
    return [(RATES_A, r.drop("k")), (RATES_B, r.filter(F.col("k") == 0).drop("k"))]


# Fixed suffixes of the derived relation names (entity part of a connector table name).
RELATION_SUFFIXES = ("orders", "draft_orders", "fulfillment_orders", "transactions", "tender_transactions",
                     "balance_transactions", "events", "fulfillment_events", "refunds", "abandoned_checkouts",
                     "products", "customers", "exchange_rates", "carrier_services", "collects", "countries",
                     "custom_collections", "customer_address", "disputes", "gift_cards", "inventory_items",
                     "inventory_levels", "locations", "payouts", "policies", "price_rules", "product_metafields", "shop",
                     "smart_collections")


def relation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One connector relation name per customer: ``<segment>_n<nation>_shopify_<k>_<entity>``.

    Every 13th customer gets a short name without separators (edge cases of token positions).
    """
    c = read(spark, sf_dir, "customer")
    ck = F.col("c_custkey")
    suffix = F.element_at(F.array(*[F.lit(s) for s in RELATION_SUFFIXES]), (ck % len(RELATION_SUFFIXES) + 1).cast("int"))
    full = F.concat(F.col("c_mktsegment"), F.lit("_n"), _s(F.col("c_nationkey")), F.lit("_shopify_"), _s(ck % 7),
                    F.lit("_"), suffix)
    short = F.concat(F.lower(F.col("c_mktsegment")), F.lit("shop"), suffix)
    table = F.when(ck % 13 == 0, short).otherwise(full)
    return c.select(ck.alias("c_custkey"), table.alias("table_name"),
                    F.concat(F.lit("`lake`.`raw`.`"), table, F.lit("`")).alias("relation"))


MIXED_RELATIONS = tuple(f"`lake`.`raw`.`{t}`" for t in ("Acme_us_shopify_1_carts", "Solo_uk_shopify_9_carts", "Zest_ca_shopify_22_carts"))


def mixed_item_arms(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    """Carts of three stores by ``l_suppkey % 3`` whose ``items`` differ in type: an array of (long id, double price); a single
    object (the line of least number) with a decimal price; an array of (text id ``L<n>``, double price, note)."""
    li = read(spark, sf_dir, "lineitem")
    number, price = F.col("l_linenumber").cast("long"), F.col("l_extendedprice")
    item = [F.struct(number.alias("id"), price.cast("double").alias("price")),
            F.struct(number.cast("int").alias("id"), price.cast("decimal(18,2)").alias("price")),
            F.struct(F.concat(F.lit("L"), _s(number)).alias("id"), price.cast("double").alias("price"), F.col("l_returnflag").alias("note"))]
    arms = []
    for k, name in enumerate(MIXED_RELATIONS):
        rows = li.filter(F.col("l_suppkey") % 3 == k).groupBy(F.col("l_orderkey").cast("long").alias("order_id"))
        items = F.min_by(item[1], F.struct("l_linenumber", "l_suppkey", "l_extendedprice")) if k == 1 else F.collect_list(item[k])
        arms.append((name, rows.agg(items.alias("items"))))
    return arms


FLAT_BATCH0_MS = 1_614_556_800_000  # 2021-03-01 00:00:00 UTC, first load of the flat entities
SPREAD_PARTS = 64


def flat_versions(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Flat raw records (one per customer), loaded three times (``arm`` = store 0/1 by nation parity).

    ``spread`` deals the customers out before their rows grow: a small file is one task, however wide and many they become.
    Their number is given, since Spark would merge parts of so few bytes."""
    c = read(spark, sf_dir, "customer")
    if spread:
        c = c.repartition(SPREAD_PARTS, "c_custkey", "c_name")
    x = c.select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("v"))
    ck, v = F.col("c_custkey"), F.col("v")
    created = F.timestamp_add("HOUR", (ck % 2000).cast("int"), F.lit("2021-03-01 00:00:00").cast("timestamp_ntz"))
    updated = F.timestamp_add("DAY", ((ck + v) % 3).cast("int"), created)
    return x.select(
        F.when(ck % 11 == 0, F.lit(None).cast("long")).otherwise(ck).alias("id"),
        F.when(ck % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("title"),
        F.col("c_name").alias("name"),
        _cur(ck).alias("currency"),
        F.col("c_acctbal").alias("balance"),
        (ck % 300).alias("inventory_item_id"),
        F.when(F.col("c_nationkey") == 0, F.lit(None).cast("long"))
         .otherwise(F.col("c_nationkey").cast("long")).alias("location_id"),
        F.col("c_nationkey").cast("long").alias("fulfillment_id"),
        created.alias("created_at"),
        updated.alias("updated_at"),
        updated.alias("processed_at"),
        updated.alias("happened_at"),
        F.when(v == 2, updated).alias("completed_at"),
        F.when(v == 1, updated).alias("disabled_at"),
        F.timestamp_add("DAY", F.lit(2), created).alias("estimated_delivery_at"),
        F.timestamp_add("HOUR", F.lit(6), created).alias("published_at"),
        created.alias("starts_at"),
        F.timestamp_add("DAY", F.lit(30), created).alias("ends_at"),
        F.timestamp_add("DAY", F.lit(7), updated).alias("evidence_due_by"),
        F.when(v >= 1, updated).alias("evidence_sent_on"),
        F.when(v == 2, updated).alias("finalized_on"),
        created.alias("initiated_at"),
        F.concat(F.lit("u"), _s(v)).alias("_daton_user_id"),
        (F.lit(FLAT_BATCH0_MS) + v * 86400000).alias("_daton_batch_runtime"),
        ck.alias("_daton_batch_id"),
        (F.col("c_nationkey") % 2).alias("arm"),
    )


def flat_relation(store: str, entity: str) -> str:
    return f"`lake`.`raw`.`{store}_shopify_{'1' if store == 'Acme_us' else '22'}_{entity}`"


def flat_arms(spark: SparkSession, sf_dir: str, entity: str) -> list[tuple[str, DataFrame]]:
    """The flat records as two store relations of ``entity``; the second store lacks ``balance``."""
    v = flat_versions(spark, sf_dir)
    return [(flat_relation("Acme_us", entity), v.filter(F.col("arm") == 0).drop("arm")),
            (flat_relation("Zest_ca", entity), v.filter(F.col("arm") == 1).drop("arm", "balance"))]


def _nested_entity_columns() -> dict[str, Column]:
    """Nested columns of the flat entities, derived from the flat record (customer key, nation key)."""
    ck, nk = F.col("_daton_batch_id"), F.col("fulfillment_id")
    amount = F.concat(_s(ck % 1000), F.lit("."), F.lpad(_s(nk), 2, "0"))
    return {
        "default_address": F.array(F.struct(
            (ck * 10).alias("id"), ck.alias("customer_id"), F.concat(F.lit("F"), _s(ck)).alias("first_name"),
            F.concat(F.lit("L"), _s(ck)).alias("last_name"),
            F.when(ck % 4 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("555-"), _s(ck))).alias("phone"),
            F.concat(F.lit("City"), _s(ck % 50)).alias("city"), F.lit(True).alias("default"))),
        "receipt": F.array(F.struct(amount.alias("fee_amount"), F.lit("manual").alias("gateway"))),
        "summary": F.array(F.struct(*[amount.alias(f"{k}_{m}_amount") for k in (
            "adjustments", "charges", "refunds", "reserved_funds", "retried_payouts") for m in ("fee", "gross")])),
        "provinces": F.array(*[F.struct(
            F.concat(F.lit("P"), _s(nk), F.lit(f"-{i}")).alias("id"), nk.cast("long").alias("country_id"),
            F.concat(F.lit("Province "), _s(nk), F.lit(f"-{i}")).alias("name"),
            F.concat(F.lit("P"), _s(nk)).alias("code"), (nk * 10 + i).cast("long").alias("shipping_zone_id"),
            F.lit(0.05 * (i + 1)).alias("tax"), F.lit(5 * (i + 1)).cast("long").alias("tax_percentage"),
            F.lit("GST").alias("tax_name"), F.lit("normal").alias("tax_type")) for i in range(2)]),
        "destination": F.array(F.struct(
            (ck * 10 + 3).alias("id"), F.concat(_s(ck), F.lit(" Main St")).alias("address1"),
            F.lit(None).cast("string").alias("address2"), F.concat(F.lit("City"), _s(ck % 50)).alias("city"),
            F.concat(F.lit("N"), _s(nk)).alias("country"), F.concat(F.lit("c"), _s(ck), F.lit("@shop.test")).alias("email"),
            F.concat(F.lit("F"), _s(ck)).alias("first_name"), F.concat(F.lit("L"), _s(ck)).alias("last_name"),
            F.lit(None).cast("string").alias("phone"), F.concat(F.lit("P"), _s(nk)).alias("province"),
            F.lpad(_s(ck % 100000), 5, "0").alias("zip"))),
        "line_items": F.array(*[F.struct(
            F.concat(_s(ck), F.lit(f"-{i}")).alias("id"), nk.cast("long").alias("shop_id"),
            ck.alias("fulfillment_order_id"), F.lit(i + 1).cast("long").alias("quantity"),
            (ck * 10 + i).alias("line_item_id"), (ck % 300).alias("inventory_item_id"),
            F.lit(i).cast("long").alias("fulfillable_quantity"), (ck * 100 + i).alias("variant_id")) for i in range(2)]),
    }


def entity_arms(spark: SparkSession, sf_dir: str, entity: str, nested: tuple[str, ...]) -> list[tuple[str, DataFrame]]:
    """Flat records plus the named nested columns, as the two store relations of ``entity``."""
    cols = _nested_entity_columns()
    v = flat_versions(spark, sf_dir, spread=True)
    v = v.select("*", F.to_date("created_at").alias("date"), *[cols[n].alias(n) for n in nested])
    return [(flat_relation("Acme_us", entity), v.filter(F.col("arm") == 0).drop("arm")),
            (flat_relation("Zest_ca", entity), v.filter(F.col("arm") == 1).drop("arm", "balance"))]


PRODUCT_BATCH0_MS = 1_622_505_600_000  # 2021-06-01 00:00:00 UTC


def product_arms(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    """Raw products from ``part``, loaded twice; two variants, each with two presentment prices."""
    p = read(spark, sf_dir, "part")
    x = p.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("v"))
    pk, v, size = F.col("p_partkey"), F.col("v"), F.col("p_size")
    created = F.timestamp_add("HOUR", (pk % 1000).cast("int"), F.lit("2021-06-01 00:00:00").cast("timestamp_ntz"))
    updated = F.timestamp_add("DAY", v.cast("int"), created)

    def variant(i: int) -> Column:
        price = F.concat(_s(pk % 100), F.lit("."), F.lit(f"{i * 25:02d}"))
        return F.struct(
            (pk * 10 + i).alias("id"), pk.alias("product_id"), F.concat(F.lit("Size "), _s(size + i)).alias("title"),
            price.alias("price"),
            F.when((pk % 5 == 0) & F.lit(i == 1), F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("SKU-"), _s(pk), F.lit(f"-{i}"))).alias("sku"),
            F.lit(i + 1).cast("long").alias("position"), F.lit("deny").alias("inventory_policy"),
            F.lit("manual").alias("fulfillment_service"), F.lit("shopify").alias("inventory_management"),
            created.alias("created_at"), updated.alias("updated_at"), F.lit(True).alias("taxable"),
            F.lit(None).cast("string").alias("barcode"), (size * 10 + i).cast("long").alias("grams"),
            F.lit(None).cast("long").alias("image_id"), (size.cast("double") / F.lit(10.0)).alias("weight"),
            F.lit("kg").alias("weight_unit"), (pk * 10 + i).alias("inventory_item_id"),
            (pk % 50 + i).alias("inventory_quantity"), (pk % 50).alias("old_inventory_quantity"),
            F.lit(True).alias("requires_shipping"), F.concat(F.lit("gid://v/"), _s(pk * 10 + i)).alias("admin_graphql_api_id"),
            F.array(F.struct(F.array(_money(price, F.lit("USD"))).alias("price")),
                    F.struct(F.array(_money(price, F.lit("EUR"))).alias("price"))).alias("presentment_prices"))

    out = x.select(
        F.when(pk % 13 == 0, F.lit(None).cast("long")).otherwise(pk).alias("id"),
        F.col("p_name").alias("title"), F.col("p_brand").alias("vendor"), F.col("p_type").alias("product_type"),
        F.lit("active").alias("status"), created.alias("created_at"), updated.alias("updated_at"),
        F.array(variant(0), variant(1)).alias("variants"), F.array(F.lit("Size")).alias("options"),
        F.array(F.concat(F.lit("img"), _s(pk))).alias("images"),
        F.struct(F.concat(F.lit("img"), _s(pk)).alias("src")).alias("image"),
        F.concat(F.lit("u"), _s(v)).alias("_daton_user_id"),
        (F.lit(PRODUCT_BATCH0_MS) + v * 86400000).alias("_daton_batch_runtime"),
        pk.alias("_daton_batch_id"), (pk % 2).alias("arm"))
    return [(flat_relation("Acme_us", "products"), out.filter(F.col("arm") == 0).drop("arm")),
            (flat_relation("Zest_ca", "products"), out.filter(F.col("arm") == 1).drop("arm", "vendor"))]


def refund_arms(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    """Raw refunds: returned line items grouped per (order, ship date), one version per ship date."""
    li = read(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    ok, ln, pk = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    cur = _cur(F.col("o_custkey"))
    amount = F.concat(_s(ln), F.lit("."), F.lpad(_s(pk % 100), 2, "0"))
    money_set = F.struct(F.array(_money(amount, F.lit("USD"))).alias("shop_money"),
                         F.array(_money(amount, cur)).alias("presentment_money"))
    item_id = ok * 10 + ln
    refund_line = F.struct(
        item_id.alias("id"), F.col("l_quantity").cast("long").alias("quantity"),
        F.array(F.struct(item_id.alias("id"), F.col("l_suppkey").alias("variant_id"), pk.alias("product_id"),
                         F.concat(F.lit("SKU-"), _s(pk)).alias("sku"), amount.alias("total_discount"),
                         F.lit(False).alias("gift_card"),
                         F.array(F.struct(F.lit("VAT").alias("title"), F.array(money_set).alias("price_set"))
                                 ).alias("tax_lines"))).alias("line_item"),
        F.array(money_set).alias("subtotal_set"), F.array(money_set).alias("total_tax_set"),
        F.lit("no_restock").alias("restock_type"))
    adjustment = F.struct(
        item_id.alias("id"), ok.alias("refund_id"), ok.alias("order_id"), F.lit("refund_discrepancy").alias("kind"),
        F.lit("Refund discrepancy").alias("reason"), F.array(money_set).alias("amount_set"),
        F.array(money_set).alias("tax_amount_set"))
    txn = F.struct(item_id.alias("id"), ok.alias("order_id"), F.col("l_shipdate").alias("created_at"),
                   cur.alias("currency"), F.lit("refund").alias("kind"), amount.alias("amount"))
    g = j.groupBy("l_orderkey", "o_custkey", "l_shipdate").agg(
        F.count(F.lit(1)).alias("n"), F.collect_list(refund_line).alias("refund_line_items"),
        F.collect_list(F.when(F.col("l_discount") > 0.05, adjustment)).alias("order_adjustments"),
        F.collect_list(txn).alias("transactions"))
    out = g.select(
        F.when(ok % 97 == 0, F.lit(None).cast("long")).otherwise(ok).alias("id"), ok.alias("order_id"),
        F.concat(F.lit("refund "), _s(ok)).alias("note"), F.col("l_shipdate").alias("created_at"),
        F.timestamp_add("DAY", F.lit(1), F.col("l_shipdate")).alias("processed_at"),
        "refund_line_items", "order_adjustments", "transactions",
        F.concat(F.lit("u"), _s(F.col("o_custkey") % 10)).alias("_daton_user_id"),
        _epoch_ms(F.col("l_shipdate")).alias("_daton_batch_runtime"), F.col("n").alias("_daton_batch_id"))
    return [(flat_relation("Acme_us", "refunds"), out)]
