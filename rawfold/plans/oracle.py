"""DuckDB SQL twins of the registered queries (the correctness oracle).

The CTEs below rebuild the derived raw tables of ``rawfold.sources.driver_tables`` with the same
expressions; each query then states the staging semantics directly in SQL (UNION ALL BY NAME,
LEFT JOIN LATERAL unnest, QUALIFY ...), independent of the Spark implementation.
"""

from __future__ import annotations

from rawfold.sources.driver_tables import (
    ENTITY_RATE_DAYS, ENTITY_RATES_FROM, FLAT_BATCH0_MS, MIXED_RELATIONS, ORDERS_A, ORDERS_B, PRODUCT_BATCH0_MS, RATES_A, RATES_B, RELATION_SUFFIXES, flat_relation,
)

from rawfold.plans.specs import SPECS

TZ = "America/Chicago"


def tz(col: str) -> str:
    return f"timezone('{TZ}', timezone('UTC', {col}))"


def table_of(rel: str = "_dbt_source_relation") -> str:
    return f"replace(string_split({rel}, '.')[3], '`', '')"


def brand(rel: str = "_dbt_source_relation") -> str:
    return f"replace(string_split(string_split({rel}, '.')[3], '_')[1], '`', '')"


# ``||`` (not DuckDB's NULL-skipping concat) so a missing token makes the id NULL, as in Spark.
def integration_id(rel: str = "_dbt_source_relation") -> str:
    t = table_of(rel)
    return f"(string_split(lower({t}), '_shopify')[1] || '_' || regexp_replace({t}, '[^0-9]', '', 'g'))"


def integration_tokens(rel: str = "_dbt_source_relation") -> str:
    t = f"lower({table_of(rel)})"
    return f"(string_split({t}, '_')[1] || '_' || string_split({t}, '_')[2])"


ORDER_FIELDS = """
    CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderkey END AS id,
    concat('#', CAST(o_orderkey AS VARCHAR)) AS name,
    CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE concat('c', CAST(o_custkey AS VARCHAR), '@shop.test') END AS email,
    concat('C', CAST(o_custkey % 5 AS VARCHAR)) AS currency,
    o_orderstatus AS financial_status,
    o_totalprice AS total_price,
    o_orderpriority AS tags,
    o_orderdate AS created_at"""

OV = f"""ov AS (
  SELECT {ORDER_FIELDS},
    l_shipdate AS updated_at,
    concat('u', CAST(l_suppkey % 10 AS VARCHAR)) AS _daton_user_id,
    epoch_ms(l_shipdate) AS _daton_batch_runtime,
    CAST(l_linenumber AS BIGINT) AS _daton_batch_id,
    l_suppkey % 2 AS arm
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

U = f"""u AS (
  SELECT '{ORDERS_A}' AS _dbt_source_relation, * EXCLUDE (arm) FROM ov WHERE arm = 0
  UNION ALL BY NAME
  SELECT '{ORDERS_B}' AS _dbt_source_relation, * EXCLUDE (arm, tags) FROM ov WHERE arm = 1)"""

CUR = "concat('C', CAST(o_custkey % 5 AS VARCHAR))"
TAX = "l_extendedprice * l_tax"
DISC = "l_extendedprice * l_discount"
ADDR = """{'address1': concat(CAST(o_orderkey AS VARCHAR), ' Main St'), 'address2': CAST(NULL AS VARCHAR),
      'city': concat('City', CAST(o_custkey % 50 AS VARCHAR)), 'zip': lpad(CAST(o_custkey % 100000 AS VARCHAR), 5, '0'),
      'province': concat('P', CAST(o_custkey % 13 AS VARCHAR)), 'country': concat('N', CAST(o_custkey % 25 AS VARCHAR)),
      'last_name': concat('Cust', CAST(o_custkey AS VARCHAR))}"""

PRICE_TEXT = "concat(CAST(o_orderkey % 100 AS VARCHAR), '.', lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0'))"

APPLICATION = """{{'target_type': 'line_item',
        'type': CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE 'discount_code' END,
        'value_type': 'percentage', 'value': '{}', 'allocation_method': '{}'}}"""

NESTED = f"""lx AS (SELECT l.*, o.o_custkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
ver AS (
  SELECT l_orderkey, l_shipdate, count(*) AS n_items, list({{
    'id': l_orderkey * 10 + l_linenumber, 'product_id': l_partkey, 'variant_id': l_suppkey,
    'sku': concat('SKU-', CAST(l_partkey AS VARCHAR)), 'name': concat('item-', CAST(l_linenumber AS VARCHAR)),
    'quantity': l_quantity, 'price': l_extendedprice,
    'tax_lines': CASE WHEN l_tax > 0 THEN [{{'title': 'VAT', 'rate': l_tax, 'price': {TAX},
        'price_set': [{{'shop_money': [{{'amount': {TAX}, 'currency_code': 'USD'}}],
                        'presentment_money': [{{'amount': {TAX}, 'currency_code': {CUR}}},
                                              {{'amount': {TAX}, 'currency_code': 'USD'}}]}}]}}] ELSE [] END,
    'discount_allocations': CASE WHEN l_discount > 0 THEN [{{'amount': {DISC},
        'discount_application_index': CAST(l_linenumber - 1 AS BIGINT),
        'amount_set': [{{'shop_money': [{{'amount': {DISC}, 'currency_code': 'USD'}}],
                         'presentment_money': [{{'amount': {DISC}, 'currency_code': {CUR}}}]}}]}}] ELSE [] END,
    'properties': [{{'name': 'returnflag', 'value': l_returnflag}}, {{'name': 'linestatus', 'value': l_linestatus}}]
  }}) AS line_items
  FROM lx GROUP BY l_orderkey, l_shipdate),
no AS (
  SELECT {ORDER_FIELDS},
    coalesce(l_shipdate, o_orderdate) AS updated_at,
    line_items,
    {ADDR} AS shipping_address,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE [{ADDR}] END AS billing_address,
    [{{'name': 'priority', 'value': o_orderpriority}}, {{'name': 'status', 'value': o_orderstatus}}] AS note_attributes,
    [{{'id': o_orderkey * 10 + 1, 'title': 'Standard', 'price': {PRICE_TEXT},
       'tax_lines': CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
           THEN [{{'price': {PRICE_TEXT}, 'rate': '0.10', 'title': 'Ship VAT', 'channel_liable': CAST(NULL AS VARCHAR)}}]
           ELSE [] END,
       'discount_allocations': CASE WHEN o_orderstatus = 'F'
           THEN [{{'amount': {PRICE_TEXT}, 'discount_application_index': CAST(0 AS BIGINT)}}] ELSE [] END}}] AS shipping_lines,
    CASE WHEN o_orderstatus = 'O' THEN [{APPLICATION.format('10.0', 'across')}, {APPLICATION.format('10.0', 'each')},
        {APPLICATION.format('5.0', 'each')}] ELSE [] END AS discount_applications,
    CASE WHEN o_orderstatus = 'F' THEN [{{'id': o_orderkey * 10 + 2, 'order_id': o_orderkey,
        'name': concat('#', CAST(o_orderkey AS VARCHAR), '.1'), 'status': 'success', 'receipt': 'r',
        'admin_graphql_api_id': 'gid', 'line_items': line_items}}] ELSE [] END AS fulfillments,
    [{{'id': CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey END, 'created_at': o_orderdate,
       'updated_at': coalesce(l_shipdate, o_orderdate), 'first_name': concat('F', CAST(o_custkey AS VARCHAR)),
       'last_name': concat('L', CAST(o_custkey AS VARCHAR)), 'state': 'regular',
       'default_address': [{{'id': o_custkey * 10, 'customer_id': o_custkey,
           'phone': concat('555-', lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0')),
           'city': concat('City', CAST(o_custkey % 50 AS VARCHAR))}}]}}] AS customer,
    concat('u', CAST(o_custkey % 10 AS VARCHAR)) AS _daton_user_id,
    epoch_ms(coalesce(l_shipdate, o_orderdate)) AS _daton_batch_runtime,
    coalesce(n_items, 0) AS _daton_batch_id,
    '{ORDERS_A}' AS _dbt_source_relation
  FROM orders LEFT JOIN ver ON o_orderkey = ver.l_orderkey)"""

RR = f"""rr AS (
  SELECT d AS date, f AS from_currency_code, concat('C', CAST(k AS VARCHAR)) AS to_currency_code,
    CASE WHEN k = 3 THEN NULL ELSE CAST(k + 1 AS DOUBLE) + CAST(day(d) AS DOUBLE) / 100.0 + CAST(v AS DOUBLE) / 1000.0 END AS value,
    concat(CAST(k + 1 AS VARCHAR), '.', lpad(CAST(day(d) AS VARCHAR), 2, '0'), CAST(v AS VARCHAR)) AS value_bn,
    'fx' AS _daton_user_id,
    epoch_ms(CAST(d AS TIMESTAMP)) + v * 3600000 AS _daton_batch_runtime,
    CAST(v AS BIGINT) AS _daton_batch_id, k
  FROM (SELECT d, k, f, unnest([0, 1]) AS v FROM (
          SELECT d, k, unnest(CASE WHEN k = 1 THEN ['USD', 'EUR'] ELSE ['USD'] END) AS f FROM (
            SELECT d, unnest([0, 1, 2, 3]) AS k FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders
              UNION SELECT CAST(DATE '{ENTITY_RATES_FROM}' + CAST(c_custkey % {ENTITY_RATE_DAYS} AS INTEGER) AS DATE) FROM customer)))))"""

FXA = f"""fxa AS (
  SELECT '{RATES_A}' AS _dbt_source_relation, * EXCLUDE (k) FROM rr
  UNION ALL
  SELECT '{RATES_B}' AS _dbt_source_relation, * EXCLUDE (k) FROM rr WHERE k = 0)"""

FX = f"""{RR},
{FXA},
fx AS (
  SELECT date, from_currency_code, to_currency_code, coalesce(value, CAST(value_bn AS DECIMAL(38,9))) AS value,
    _daton_user_id, _daton_batch_runtime, _daton_batch_id
  FROM fxa
  QUALIFY row_number() OVER (PARTITION BY _dbt_source_relation, date, from_currency_code, to_currency_code
                             ORDER BY _daton_batch_runtime DESC, _daton_batch_id DESC) = 1)"""

LINEAGE = f"""a._dbt_source_relation, a._daton_user_id, a._daton_batch_runtime, a._daton_batch_id,
    {integration_id('a._dbt_source_relation')} AS _daton_sourceversion_integration_id"""

FXCOLS = "coalesce(b.value, 1) AS fx_rate, coalesce(b.from_currency_code, a.currency) AS fx_currency_code"


def nested_from(*steps: str, base: str = "no") -> str:
    """``FROM <base> a`` + one LEFT JOIN LATERAL unnest per ``"<list expr> AS <alias>"`` step.

    The element of step ``x`` is ``x.v`` (an empty or NULL list still yields one row).
    """
    out = [f"FROM {base} a"]
    for s in steps:
        src, alias = s.split(" AS ")
        out.append(f"LEFT JOIN LATERAL (SELECT unnest({src}) AS v) AS {alias} ON TRUE")
    return "\n  ".join(out)


SQL: dict[str, str] = {}

ORDERS_BODY = f"""SELECT {brand('a._dbt_source_relation')} AS brand, coalesce(a.id, 0) AS order_id,
    {tz('a.created_at')} AS created_at, {tz('a.updated_at')} AS updated_at,
    a.name, a.email, a.currency, a.financial_status, a.total_price, a.tags,
    {FXCOLS}, {LINEAGE}
FROM u a LEFT JOIN fx b ON CAST(a.created_at AS DATE) = b.date AND a.currency = b.to_currency_code
QUALIFY dense_rank() OVER (PARTITION BY coalesce(a.id, 0) ORDER BY a._daton_batch_runtime DESC) = 1"""
SQL["ShopifyOrders"] = f"WITH {OV}, {U}, {FX}\n{ORDERS_BODY}"

SQL["ExchangeRates"] = f"""WITH {FX} SELECT * FROM fx"""
SQL["dedup_then_union"] = SQL["ExchangeRates"]

SQL["union_relations"] = f"""WITH {OV}, {U} SELECT * FROM u"""

SQL["union_then_dedup"] = f"""WITH {OV}, {U}
SELECT * FROM u QUALIFY dense_rank() OVER (PARTITION BY coalesce(id, 0) ORDER BY _daton_batch_runtime DESC) = 1"""

SQL["latest_dense_rank"] = SQL["union_then_dedup"]

SQL["latest_row_number"] = f"""WITH {OV}, {U}
SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY coalesce(id, 0)
    ORDER BY _daton_batch_runtime DESC, _daton_batch_id DESC, _dbt_source_relation DESC, _daton_user_id DESC) = 1"""

SQL["fx_left_join"] = f"""WITH {OV}, {U}, {FX}
SELECT a.id, a.created_at, a.currency, a._daton_batch_runtime, a._daton_batch_id, a._dbt_source_relation, {FXCOLS}
FROM u a LEFT JOIN fx b ON CAST(a.created_at AS DATE) = b.date AND a.currency = b.to_currency_code"""

SQL["explode_outer_items"] = f"""WITH {NESTED}
SELECT a.id, a._daton_batch_runtime, line_items.v.id AS line_items_id, line_items.v.sku AS line_items_sku,
    line_items.v.quantity AS line_items_quantity
{nested_from('a.line_items AS line_items')}"""

SQL["ShopifyOrdersLineItems"] = f"""WITH {NESTED}, {FX}
SELECT {brand('a._dbt_source_relation')} AS brand, coalesce(a.id, 0) AS order_id,
    {tz('a.created_at')} AS order_created_at, {tz('a.updated_at')} AS order_updated_at, a.tags AS order_tags,
    coalesce(CAST(line_items.v.id AS VARCHAR), 'N/A') AS line_items_id, CAST(line_items.v.name AS VARCHAR) AS line_items_name,
    line_items.v.product_id, line_items.v.variant_id, line_items.v.sku, line_items.v.quantity, line_items.v.price,
    a.currency, {FXCOLS}, {LINEAGE}
{nested_from('a.line_items AS line_items')}
LEFT JOIN fx b ON CAST(a.created_at AS DATE) = b.date AND a.currency = b.to_currency_code
QUALIFY dense_rank() OVER (PARTITION BY coalesce(a.id, 0) ORDER BY a._daton_batch_runtime DESC) = 1"""

_SUF = ", ".join(f"'{x}'" for x in RELATION_SUFFIXES)
NAMES = f"""names AS (
  SELECT c_custkey, tn AS table_name, concat('`lake`.`raw`.`', tn, '`') AS relation FROM (
    SELECT c_custkey, CASE WHEN c_custkey % 13 = 0
        THEN concat(lower(c_mktsegment), 'shop', [{_SUF}][c_custkey % {len(RELATION_SUFFIXES)} + 1])
        ELSE concat(c_mktsegment, '_n', CAST(c_nationkey AS VARCHAR), '_shopify_', CAST(c_custkey % 7 AS VARCHAR), '_',
                    [{_SUF}][c_custkey % {len(RELATION_SUFFIXES)} + 1]) END AS tn
    FROM customer))"""
CUT = "TIMESTAMP '1998-01-01 00:00:00'"
CUT_DATE = "DATE '1998-01-01'"
LOOKBACK_MS = 2592000000


def _match(entity, pattern, exclude):
    cond = f"table_name ILIKE '{pattern}'" + (f" AND NOT table_name ILIKE '{exclude}'" if exclude else "")
    return f"SELECT '{entity}' AS entity, relation, table_name FROM names WHERE {cond}"


SQL["relation_match"] = f"""WITH {NAMES}
{' UNION ALL '.join(_match(s.name, s.pattern, s.exclude_pattern) for s in SPECS)}"""

SQL["relation_match_schemas"] = f"""WITH {NAMES}, s AS (SELECT *, 'raw_' || lower(table_name)[1] AS table_schema FROM names)
SELECT table_schema, relation, table_name FROM s
WHERE table_name ILIKE '%shopify%orders%' AND NOT table_name ILIKE '%draft%' AND table_schema ILIKE 'raw_a%'"""

SQL["brand_from_source"] = f"WITH {NAMES} SELECT relation, {brand('relation')} AS brand FROM names"
SQL["integration_id"] = (f"WITH {NAMES} SELECT relation, {integration_id('relation')} "
                         f"AS _daton_sourceversion_integration_id FROM names")
SQL["integration_id_tokens"] = (f"WITH {NAMES} SELECT relation, {integration_tokens('relation')} "
                                f"AS _daton_sourceversion_integration_id FROM names")
SQL["store_token"] = f"WITH {NAMES} SELECT relation, list_reverse(string_split(relation, '_'))[4] AS store FROM names"

SQL["merge_on_read"] = f"""WITH {OV}, {U}
SELECT coalesce(id, 0) AS order_id, _dbt_source_relation, _daton_batch_runtime, _daton_batch_id FROM u
QUALIFY dense_rank() OVER (PARTITION BY coalesce(id, 0) ORDER BY _daton_batch_runtime DESC) = 1"""
SQL["union_nested_types"] = f"""
SELECT l_orderkey::BIGINT AS order_id, '{MIXED_RELATIONS[0]}' AS _dbt_source_relation, l_linenumber::VARCHAR AS item_id,
    l_extendedprice::DOUBLE AS price, NULL::VARCHAR AS note FROM lineitem WHERE l_suppkey % 3 = 0
UNION ALL SELECT l_orderkey::BIGINT, '{MIXED_RELATIONS[1]}', l_linenumber::VARCHAR, l_extendedprice::DECIMAL(18, 2)::DOUBLE, NULL FROM lineitem
    WHERE l_suppkey % 3 = 1 QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_extendedprice) = 1
UNION ALL SELECT l_orderkey::BIGINT, '{MIXED_RELATIONS[2]}', 'L' || l_linenumber::VARCHAR, l_extendedprice::DOUBLE, l_returnflag FROM lineitem
    WHERE l_suppkey % 3 = 2"""

SQL["union_exclude"] = f"WITH {OV}, {U} SELECT * EXCLUDE (total_price, financial_status) FROM u"
SQL["star_except"] = f"""WITH {OV}, {U}
SELECT {brand()} AS brand, coalesce(id, 0) AS order_id,
    * EXCLUDE (id, created_at, updated_at, _dbt_source_relation, _daton_user_id, _daton_batch_runtime, _daton_batch_id)
FROM u"""
SQL["null_defaults"] = f"""WITH {OV}, {U}
SELECT coalesce(id, 0) AS order_id, coalesce(email, 'N/A') AS email, coalesce(CAST(id AS VARCHAR), 'N/A') AS id_text,
    _dbt_source_relation, _daton_batch_runtime, _daton_batch_id
FROM u"""
SQL["audit_columns"] = f"""WITH {OV}, {U}
SELECT id, _daton_batch_runtime, _daton_batch_id, {brand()} AS brand,
    {integration_id()} AS _daton_sourceversion_integration_id, 'manual' AS _run_id
FROM u"""
SQL["coalesce_numeric"] = f"""WITH {RR}
SELECT date, from_currency_code, to_currency_code, value_bn, _daton_batch_runtime,
    coalesce(value, CAST(value_bn AS DECIMAL(38,9))) AS value
FROM rr"""
SQL["tz_convert"] = f"""SELECT event_id, ts + to_months(CAST(event_id % 12 AS INTEGER)) AS ts_utc,
    {tz('ts + to_months(CAST(event_id % 12 AS INTEGER))')} AS ts_local
FROM events"""
SQL["millis_to_ts"] = f"""WITH {OV}
SELECT id, _daton_batch_runtime, epoch_ms(_daton_batch_runtime) AS batch_ts FROM ov"""
SQL["watermark_max"] = f"""WITH {OV}, {U}
SELECT coalesce(max(_daton_batch_runtime), 0) AS watermark FROM u WHERE updated_at < {CUT}"""
SQL["incremental_watermark"] = f"""WITH {OV}, {U}
SELECT * FROM u
WHERE _daton_batch_runtime >= (SELECT coalesce(max(_daton_batch_runtime), 0) FROM u WHERE updated_at < {CUT})"""
SQL["scalar_subquery_filter"] = SQL["incremental_watermark"]
SQL["incremental_lookback"] = f"""WITH {FX},
fresh AS (
  SELECT * FROM fxa WHERE _daton_batch_runtime >= (
    SELECT coalesce(max(_daton_batch_runtime) - {LOOKBACK_MS}, 0) FROM fx WHERE date < {CUT_DATE}))
SELECT date, from_currency_code, to_currency_code, coalesce(value, CAST(value_bn AS DECIMAL(38,9))) AS value,
    _daton_user_id, _daton_batch_runtime, _daton_batch_id
FROM fresh
QUALIFY row_number() OVER (PARTITION BY _dbt_source_relation, date, from_currency_code, to_currency_code
                           ORDER BY _daton_batch_runtime DESC, _daton_batch_id DESC) = 1"""

_STATE_COLS = "coalesce(id, 0) AS order_id, updated_at, total_price, _dbt_source_relation, _daton_batch_runtime, _daton_batch_id"
SQL["merge_upsert"] = f"""WITH {OV}, {U},
target AS (
  SELECT {_STATE_COLS} FROM u WHERE updated_at < {CUT}
  QUALIFY dense_rank() OVER (PARTITION BY coalesce(id, 0) ORDER BY _daton_batch_runtime DESC) = 1),
upd AS (
  SELECT {_STATE_COLS} FROM u
  WHERE _daton_batch_runtime >= (SELECT coalesce(max(_daton_batch_runtime), 0) FROM target)
  QUALIFY dense_rank() OVER (PARTITION BY coalesce(id, 0) ORDER BY _daton_batch_runtime DESC) = 1)
SELECT * FROM target WHERE order_id NOT IN (SELECT order_id FROM upd)
UNION ALL
SELECT * FROM upd"""
SQL["partition_by_date"] = f"""WITH {OV}, {U}
SELECT CAST(created_at AS DATE) AS created_date, count(*) AS row_count FROM u GROUP BY 1"""
SQL["partition_granularity"] = f"""WITH {OV}, {U}, newest AS (
  SELECT coalesce(id, 0) AS order_id, updated_at FROM u
  QUALIFY dense_rank() OVER (PARTITION BY coalesce(id, 0) ORDER BY _daton_batch_runtime DESC) = 1)
SELECT coalesce(strftime(updated_at, '%Y-%m'), 'null') AS part, count(*) AS row_count, min(order_id) AS min_order_id,
    max(order_id) AS max_order_id FROM newest GROUP BY 1"""
SQL["cluster_interleaved"] = f"""WITH {OV}, {U}
SELECT _dbt_source_relation, CAST(updated_at AS DATE) AS updated_date, count(*) AS row_count, min(id) AS min_id, max(id) AS max_id
FROM u WHERE updated_at >= DATE '1997-01-01' GROUP BY 1, 2"""
SQL["run_audit"] = f"""WITH {OV}, {U}, {FX}, staged AS ({ORDERS_BODY})
SELECT 'manual' AS run_id, 'ShopifyOrders' AS dataset, count(*) AS row_count,
    max(_daton_batch_runtime) AS max_batch_runtime, 'success' AS status FROM staged"""

SQL["latest_multi_order"] = f"""WITH {OV}, {U}
SELECT * FROM u QUALIFY dense_rank() OVER (PARTITION BY coalesce(id, 0)
    ORDER BY updated_at DESC, _daton_batch_runtime DESC, _daton_batch_id DESC) = 1"""
SQL["latest_composite_key"] = f"""WITH {OV}, {U}
SELECT * FROM u QUALIFY dense_rank() OVER (PARTITION BY coalesce(id, 0), coalesce(_daton_user_id, 'N/A')
    ORDER BY _daton_batch_runtime DESC) = 1"""
SQL["seq_id"] = f"""WITH {OV}, {U}
SELECT *, row_number() OVER (PARTITION BY coalesce(id, 0)
    ORDER BY _daton_batch_runtime DESC, _daton_batch_id, _dbt_source_relation, _daton_user_id, name) AS _seq_id
FROM u"""

SQL["explode_chain"] = f"""WITH {NESTED}
SELECT a.id, a._daton_batch_runtime, line_items.v.id AS line_items_id, tax_lines.v.title AS title,
    shop_money.v.amount AS shop_money_amount, shop_money.v.currency_code AS shop_money_currency_code
{nested_from('a.line_items AS line_items', 'line_items.v.tax_lines AS tax_lines', 'tax_lines.v.price_set AS price_set',
             'price_set.v.shop_money AS shop_money')}"""
SQL["explode_siblings"] = f"""WITH {NESTED}
SELECT a.id, a._daton_batch_runtime, line_items.v.id AS line_items_id,
    shop_money.v.amount AS shop_money_amount, shop_money.v.currency_code AS shop_money_currency_code,
    presentment_money.v.amount AS presentment_money_amount,
    presentment_money.v.currency_code AS presentment_money_currency_code
{nested_from('a.line_items AS line_items', 'line_items.v.tax_lines AS tax_lines', 'tax_lines.v.price_set AS price_set',
             'price_set.v.shop_money AS shop_money', 'price_set.v.presentment_money AS presentment_money')}"""
SQL["filter_before_latest"] = f"""WITH {NESTED}
SELECT coalesce(a.id, 0) AS order_id, a._daton_batch_runtime, line_items.v.id AS line_items_id,
    tax_lines.v.price AS tax_price
{nested_from('a.line_items AS line_items', 'line_items.v.tax_lines AS tax_lines')}
WHERE tax_lines.v.price IS NOT NULL
QUALIFY dense_rank() OVER (PARTITION BY coalesce(a.id, 0) ORDER BY a._daton_batch_runtime DESC) = 1"""
SQL["struct_star"] = f"""WITH {NESTED}
SELECT a.id AS order_id, a._daton_batch_runtime, line_items.v.id AS id, line_items.v.product_id AS product_id,
    line_items.v.variant_id AS variant_id, line_items.v.sku AS sku, line_items.v.name AS name,
    line_items.v.quantity AS quantity, line_items.v.price AS price
{nested_from('a.line_items AS line_items')}"""
SQL["drop_nested_fields"] = SQL["struct_star"]
SQL["flatten_prefixed"] = f"""WITH {NESTED}
SELECT a.id AS order_id, line_items.v.product_id AS line_items_product_id, line_items.v.sku AS line_items_sku,
    line_items.v.quantity AS line_items_quantity, a.shipping_address.city AS shipping_address_city,
    a.shipping_address.zip AS shipping_address_zip
{nested_from('a.line_items AS line_items')}"""
SQL["extract_nested"] = f"""WITH {NESTED}
SELECT a.id AS order_id, CAST(line_items.v.id AS VARCHAR) AS line_items_id,
    CAST(CAST(line_items.v.price AS DECIMAL(38,9)) AS DOUBLE) AS line_items_price,
    CAST(billing_address.v.city AS VARCHAR) AS billing_address_city
{nested_from('a.line_items AS line_items', 'a.billing_address AS billing_address')}"""
SQL["latest_after_explode"] = f"""WITH {NESTED}
SELECT coalesce(a.id, 0) AS order_id, line_items.v.sku AS sku, line_items.v.id AS line_items_id, a._daton_batch_runtime
{nested_from('a.line_items AS line_items')}
QUALIFY dense_rank() OVER (PARTITION BY coalesce(a.id, 0), line_items.v.sku ORDER BY a._daton_batch_runtime DESC) = 1"""
SQL["latest_by_content"] = f"""WITH {NESTED},
c AS (
  SELECT coalesce(a.id, 0) AS order_id, line_items.v.sku AS line_items_sku, coalesce(tax_lines.v.title, '') AS title,
      coalesce(tax_lines.v.rate, 0) AS rate, a._daton_batch_runtime, a._daton_batch_id
  {nested_from('a.line_items AS line_items', 'line_items.v.tax_lines AS tax_lines')})
SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY order_id, line_items_sku, title, rate
    ORDER BY _daton_batch_runtime DESC, _daton_batch_id DESC) = 1"""

SQL["check_unique"] = f"""WITH {FX}
SELECT date, from_currency_code, to_currency_code, count(*) AS n_records FROM fx
GROUP BY date, from_currency_code, to_currency_code HAVING count(*) > 1"""
SQL["check_not_null"] = f"""WITH {OV}, {U} SELECT * FROM u WHERE id IS NULL OR email IS NULL"""
SQL["check_recency"] = f"""WITH {OV}, {U}
SELECT email, max(updated_at) AS latest FROM u GROUP BY email
HAVING max(updated_at) IS NULL OR max(updated_at) < TIMESTAMP '2001-11-04 00:00:00' - INTERVAL 365 DAY"""


def _addr(prefix: str, src: str) -> str:
    return ",\n    ".join(f"CAST({src}.{f} AS VARCHAR) AS {prefix}_{f}"
                           for f in ("address1", "city", "zip", "province", "country", "last_name", "address2"))


ORDER_HEAD = f"{brand('a._dbt_source_relation')} AS brand, coalesce(a.id, 0) AS order_id"
FX_ON_RAW = "LEFT JOIN fx b ON CAST(a.created_at AS DATE) = b.date AND a.currency = b.to_currency_code"
LATEST_ORDER = "QUALIFY dense_rank() OVER (PARTITION BY coalesce(a.id, 0) ORDER BY a._daton_batch_runtime DESC) = 1"

SQL["ShopifyOrdersAddresses"] = f"""WITH {NESTED}
SELECT {ORDER_HEAD}, {tz('a.created_at')} AS created_at, {tz('a.updated_at')} AS updated_at,
    {_addr('billing_address', 'billing_address.v')},
    {_addr('shipping_address', 'a.shipping_address')},
    coalesce(a.email, 'N/A') AS email, {LINEAGE}
{nested_from('a.billing_address AS billing_address')}
{LATEST_ORDER}"""

SQL["ShopifyOrdersNoteAttributes"] = f"""WITH {NESTED}
SELECT {ORDER_HEAD}, {tz('a.created_at')} AS created_at, {tz('a.updated_at')} AS updated_at,
    coalesce(note_attributes.v.name, 'N/A') AS name, note_attributes.v.value AS value, {LINEAGE}
{nested_from('a.note_attributes AS note_attributes')}
QUALIFY dense_rank() OVER (PARTITION BY coalesce(a.id, 0), CAST(note_attributes.v.name AS VARCHAR)
                           ORDER BY a._daton_batch_runtime DESC) = 1"""

SQL["ShopifyOrdersLineItemsProperties"] = f"""WITH {NESTED}
SELECT {ORDER_HEAD}, {tz('a.created_at')} AS created_at, {tz('a.updated_at')} AS updated_at,
    coalesce(CAST(line_items.v.id AS VARCHAR), 'N/A') AS line_items_id,
    CAST(line_items.v.product_id AS VARCHAR) AS product_id, CAST(line_items.v.sku AS VARCHAR) AS sku,
    CAST(line_items.v.variant_id AS VARCHAR) AS variant_id,
    coalesce(properties.v.name, 'N/A') AS name, properties.v.value AS value, {LINEAGE}
{nested_from('a.line_items AS line_items', 'line_items.v.properties AS properties')}
QUALIFY dense_rank() OVER (PARTITION BY coalesce(a.id, 0), a.name ORDER BY a._daton_batch_runtime DESC) = 1"""

SQL["ShopifyOrdersLineItemsTaxLines"] = f"""WITH {NESTED}, {FX},
s AS (
  SELECT {ORDER_HEAD}, {tz('a.created_at')} AS created_at, {tz('a.updated_at')} AS updated_at,
      CAST(line_items.v.id AS VARCHAR) AS line_items_id, CAST(line_items.v.product_id AS VARCHAR) AS product_id,
      CAST(line_items.v.sku AS VARCHAR) AS sku, CAST(line_items.v.variant_id AS VARCHAR) AS variant_id,
      coalesce(tax_lines.v.title, 'N/A') AS title, tax_lines.v.rate AS rate, tax_lines.v.price AS price,
      shop_money.v.amount AS shop_money_amount, shop_money.v.currency_code AS shop_money_currency_code,
      presentment_money.v.amount AS presentment_money_amount,
      presentment_money.v.currency_code AS presentment_money_currency_code,
      {FXCOLS}, {LINEAGE}
  {nested_from('a.line_items AS line_items', 'line_items.v.tax_lines AS tax_lines', 'tax_lines.v.price_set AS price_set',
               'price_set.v.shop_money AS shop_money', 'price_set.v.presentment_money AS presentment_money')}
  {FX_ON_RAW}
  {LATEST_ORDER})
SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY _daton_batch_runtime DESC, line_items_id NULLS FIRST,
    title NULLS FIRST, shop_money_amount NULLS FIRST, presentment_money_currency_code NULLS FIRST,
    fx_currency_code NULLS FIRST, fx_rate NULLS FIRST) AS _seq_id
FROM s"""

SQL["ShopifyOrdersDiscountAllocations"] = f"""WITH {NESTED}, {FX}
SELECT {ORDER_HEAD}, {tz('a.created_at')} AS created_at, {tz('a.updated_at')} AS updated_at,
    coalesce(line_items.v.id, 0) AS line_items_id, line_items.v.product_id AS line_items_product_id,
    line_items.v.sku AS line_items_sku, discount_allocations.v.amount AS amount,
    coalesce(discount_allocations.v.discount_application_index, 0) AS discount_application_index,
    shop_money.v.amount AS shop_money_amount, shop_money.v.currency_code AS shop_money_currency_code,
    presentment_money.v.amount AS presentment_money_amount,
    presentment_money.v.currency_code AS presentment_money_currency_code,
    {FXCOLS}, {LINEAGE}
{nested_from('a.line_items AS line_items', 'line_items.v.discount_allocations AS discount_allocations',
             'discount_allocations.v.amount_set AS amount_set', 'amount_set.v.shop_money AS shop_money',
             'amount_set.v.presentment_money AS presentment_money')}
{FX_ON_RAW}
{LATEST_ORDER}"""


# ---- flat entities: customers loaded three times, two stores ----------------------------------------
FV = f"""fv AS (
  SELECT CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey END AS id,
    CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_mktsegment END AS title,
    c_name AS name, concat('C', CAST(c_custkey % 5 AS VARCHAR)) AS currency, c_acctbal AS balance,
    c_custkey % 300 AS inventory_item_id,
    CASE WHEN c_nationkey = 0 THEN NULL ELSE CAST(c_nationkey AS BIGINT) END AS location_id,
    CAST(c_nationkey AS BIGINT) AS fulfillment_id,
    created_at, updated_at, updated_at AS processed_at, updated_at AS happened_at,
    CASE WHEN v = 2 THEN updated_at END AS completed_at,
    CASE WHEN v = 1 THEN updated_at END AS disabled_at,
    created_at + to_days(2) AS estimated_delivery_at,
    created_at + to_hours(6) AS published_at,
    created_at AS starts_at,
    created_at + to_days(30) AS ends_at,
    updated_at + to_days(7) AS evidence_due_by,
    CASE WHEN v >= 1 THEN updated_at END AS evidence_sent_on,
    CASE WHEN v = 2 THEN updated_at END AS finalized_on,
    created_at AS initiated_at,
    concat('u', CAST(v AS VARCHAR)) AS _daton_user_id,
    {FLAT_BATCH0_MS} + v * 86400000 AS _daton_batch_runtime,
    c_custkey AS _daton_batch_id,
    c_nationkey % 2 AS arm
  FROM (SELECT *, created_at + to_days(CAST((c_custkey + v) % 3 AS BIGINT)) AS updated_at
        FROM (SELECT *, TIMESTAMP '2021-03-01 00:00:00' + to_hours(CAST(c_custkey % 2000 AS BIGINT)) AS created_at
              FROM customer, (SELECT unnest([0, 1, 2]) AS v))))"""


def flat_union(entity: str) -> str:
    return f"""{FV},
u AS (
  SELECT '{flat_relation('Acme_us', entity)}' AS _dbt_source_relation, * EXCLUDE (arm) FROM fv WHERE arm = 0
  UNION ALL BY NAME
  SELECT '{flat_relation('Zest_ca', entity)}' AS _dbt_source_relation, * EXCLUDE (arm, balance) FROM fv WHERE arm = 1)"""


DATON_COLS = "_dbt_source_relation, _daton_user_id, _daton_batch_runtime, _daton_batch_id"


def flat_dataset(entity: str, key_col: str | None, key_default, tz_cols: tuple, partition: str, *,
                 ties: bool = True, order: str = "_daton_batch_runtime DESC", fx: str | None = None) -> str:
    """A flat staging dataset: key default, converted timestamps, every other column, newest load per key.

    ``fx`` = ``"raw:<col>"`` joins rates on the unconverted column after the rank (QUALIFY after the
    join), ``"out:<col>"`` on the converted output column of the ranked derived table.
    """
    head = []
    if key_col:
        if key_default is None:
            head.append(f"{key_col}")
        elif isinstance(key_default, str):
            head.append(f"coalesce(CAST({key_col} AS VARCHAR), '{key_default}') AS {key_col}")
        else:
            head.append(f"coalesce({key_col}, {key_default}) AS {key_col}")
    head += [f"{tz(c)} AS {c}" for c in tz_cols]
    excl = ", ".join(([key_col] if key_col else []) + list(tz_cols) + DATON_COLS.split(", "))
    rank = "dense_rank()" if ties else "row_number()"
    tie = "" if ties else ", _daton_batch_id DESC, _dbt_source_relation DESC"
    b = f"""SELECT {brand()} AS brand, {', '.join(head + [f'* EXCLUDE ({excl})'])}, {DATON_COLS},
    {integration_id()} AS _daton_sourceversion_integration_id, updated_at AS __raw_updated_at
  FROM u QUALIFY {rank} OVER (PARTITION BY {partition} ORDER BY {order}{tie}) = 1"""
    if fx is None:
        return f"WITH {flat_union(entity)}, b AS ({b}) SELECT * EXCLUDE (__raw_updated_at) FROM b"
    where, col = fx.split(":")
    on = f"CAST(a.{'__raw_' + col if where == 'raw' else col} AS DATE)"
    return f"""WITH {flat_union(entity)}, {FX}, b AS ({b})
SELECT a.* EXCLUDE (__raw_updated_at), {FXCOLS}
FROM b a LEFT JOIN fx b ON {on} = b.date AND a.currency = b.to_currency_code"""


SQL["ShopifyLocations"] = flat_dataset("locations", "id", 0, ("created_at", "updated_at"), "coalesce(id, 0)")
SQL["ShopifyInventoryItems"] = flat_dataset("inventory_items", "id", 0, ("created_at", "updated_at"),
                                            "coalesce(id, 0)", ties=False)
SQL["ShopifyInventoryLevels"] = f"""WITH {flat_union('inventory_levels')}
SELECT {brand()} AS brand, coalesce(inventory_item_id, 0) AS inventory_item_id, coalesce(location_id, 0) AS location_id,
    {tz('updated_at')} AS updated_at, * EXCLUDE (inventory_item_id, location_id, updated_at, {DATON_COLS}),
    {DATON_COLS}, {integration_id()} AS _daton_sourceversion_integration_id
FROM u QUALIFY dense_rank() OVER (PARTITION BY coalesce(inventory_item_id, 0), coalesce(location_id, 0)
    ORDER BY updated_at DESC, _daton_batch_runtime DESC, _daton_batch_id DESC) = 1"""
SQL["ShopifyCustomerAddress"] = flat_dataset("customer_address", None, None, (), "id", ties=False)
SQL["ShopifyGiftCards"] = flat_dataset("gift_cards", "id", "N/A", ("created_at", "updated_at", "disabled_at"), "id",
                                       fx="out:updated_at")
SQL["ShopifyPolicies"] = flat_dataset("policies", "title", "N/A", ("created_at", "updated_at"),
                                      "coalesce(title, 'N/A')")
SQL["ShopifyFulfillmentEvents"] = flat_dataset(
    "fulfillment_events", "id", "N/A", ("happened_at", "created_at", "updated_at", "estimated_delivery_at"),
    "id, fulfillment_id", ties=False)
SQL["ShopifyTenderTransactions"] = flat_dataset("tender_transactions", "id", None, ("processed_at",), "id",
                                                fx="out:processed_at")
SQL["ShopifyAbandonedCheckouts"] = flat_dataset("abandoned_checkouts", "id", "N/A",
                                                ("created_at", "updated_at", "completed_at"), "id", ties=False,
                                                fx="out:updated_at")
SQL["ShopifyShop"] = f"""WITH {flat_union('shop')}, {FX}
SELECT {brand('a._dbt_source_relation')} AS brand, {tz('a.created_at')} AS created_at, {tz('a.updated_at')} AS updated_at,
    a.* EXCLUDE (created_at, updated_at, {DATON_COLS}), {FXCOLS},
    a._dbt_source_relation, a._daton_user_id, a._daton_batch_runtime, a._daton_batch_id,
    {integration_id('a._dbt_source_relation')} AS _daton_sourceversion_integration_id
FROM u a LEFT JOIN fx b ON CAST(a.updated_at AS DATE) = b.date AND a.currency = b.to_currency_code
QUALIFY dense_rank() OVER (PARTITION BY a.id ORDER BY a._daton_batch_runtime DESC) = 1"""


# ---- the rest of the order family -------------------------------------------------------------------
SQL["ShopifyOrdersShippingLines"] = f"""WITH {NESTED}, {FX}
SELECT {ORDER_HEAD}, {tz('a.created_at')} AS created_at, {tz('a.updated_at')} AS updated_at,
    coalesce(shipping_lines.v.id, 0) AS shipping_lines_id, shipping_lines.v.title AS title, shipping_lines.v.price AS price,
    {FXCOLS}, {LINEAGE}
{nested_from('a.shipping_lines AS shipping_lines')}
{FX_ON_RAW}
{LATEST_ORDER}"""

SQL["ShopifyOrdersShippingLinesTaxLines"] = f"""WITH {NESTED}, {FX},
s AS (
  SELECT {brand('a._dbt_source_relation')} AS brand, CAST(a.id AS DECIMAL(38,9)) AS order_id,
      {tz('a.created_at')} AS created_at, {tz('a.updated_at')} AS updated_at,
      coalesce(CAST(shipping_lines.v.id AS DECIMAL(38,9)), 0) AS shipping_lines_id,
      coalesce(CAST(tax_lines.v.price AS DECIMAL(38,9)), 0) AS shipping_lines_tax_lines_price,
      coalesce(CAST(tax_lines.v.rate AS DECIMAL(38,9)), 0) AS shipping_lines_tax_lines_rate,
      coalesce(CAST(tax_lines.v.title AS VARCHAR), '') AS shipping_lines_tax_lines_title,
      CAST(tax_lines.v.channel_liable AS VARCHAR) AS shipping_lines_tax_lines_channel_liable,
      {FXCOLS},
      a._dbt_source_relation, a._daton_user_id, a._daton_batch_runtime, a._daton_batch_id,
      {integration_tokens('a._dbt_source_relation')} AS _daton_sourceversion_integration_id
  {nested_from('a.shipping_lines AS shipping_lines', 'shipping_lines.v.tax_lines AS tax_lines')}
  {FX_ON_RAW}
  WHERE CAST(tax_lines.v.price AS DECIMAL(38,9)) IS NOT NULL)
SELECT * FROM s
QUALIFY row_number() OVER (PARTITION BY order_id, shipping_lines_id, shipping_lines_tax_lines_price,
    shipping_lines_tax_lines_rate, shipping_lines_tax_lines_title, shipping_lines_tax_lines_channel_liable
    ORDER BY _daton_batch_runtime DESC, _daton_batch_id DESC, fx_currency_code DESC NULLS LAST,
             fx_rate DESC NULLS LAST, _dbt_source_relation DESC, _daton_user_id DESC) = 1"""

SQL["ShopifyOrdersShippingLinesDiscountAllocations"] = f"""WITH {NESTED}, {FX}
SELECT {brand('a._dbt_source_relation')} AS brand, CAST(a.id AS DECIMAL(38,9)) AS order_id,
    {tz('a.created_at')} AS created_at, {tz('a.updated_at')} AS updated_at,
    coalesce(CAST(shipping_lines.v.id AS DECIMAL(38,9)), 0) AS shipping_lines_id,
    CAST(discount_allocations.v.amount AS DECIMAL(38,9)) AS shipping_lines_discount_amount,
    coalesce(discount_allocations.v.discount_application_index, 0) AS discount_application_index,
    shipping_lines.v.title AS title, shipping_lines.v.price AS price,
    {FXCOLS},
    a._dbt_source_relation, a._daton_user_id, a._daton_batch_runtime, a._daton_batch_id,
    {integration_tokens('a._dbt_source_relation')} AS _daton_sourceversion_integration_id
{nested_from('a.shipping_lines AS shipping_lines', 'shipping_lines.v.discount_allocations AS discount_allocations')}
{FX_ON_RAW}
WHERE CAST(discount_allocations.v.amount AS DECIMAL(38,9)) IS NOT NULL
QUALIFY dense_rank() OVER (PARTITION BY a.id ORDER BY a._daton_batch_runtime DESC) = 1"""

SQL["ShopifyOrdersDiscountApplications"] = f"""WITH {NESTED}, {FX},
s AS (
  SELECT {ORDER_HEAD}, {tz('a.created_at')} AS order_created_at, {tz('a.updated_at')} AS order_updated_at,
      discount_applications.v.value AS value, discount_applications.v.allocation_method AS allocation_method,
      coalesce(discount_applications.v.target_type, 'N/A') AS target_type,
      coalesce(discount_applications.v.type, 'N/A') AS type,
      coalesce(discount_applications.v.value_type, 'N/A') AS value_type,
      {FXCOLS}, {LINEAGE}
  {nested_from('a.discount_applications AS discount_applications')}
  {FX_ON_RAW}
  {LATEST_ORDER})
SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY _daton_batch_runtime DESC, target_type NULLS FIRST,
    type NULLS FIRST, value_type NULLS FIRST, fx_currency_code NULLS FIRST, fx_rate NULLS FIRST,
    value NULLS FIRST, allocation_method NULLS FIRST) AS _seq_id
FROM s"""

SQL["ShopifyOrdersFulfillments"] = f"""WITH {NESTED}, {FX}
SELECT {ORDER_HEAD}, {tz('a.created_at')} AS order_created_at, {tz('a.updated_at')} AS order_updated_at,
    coalesce(CAST(fulfillments.v.id AS VARCHAR), 'N/A') AS fulfillments_id,
    CAST(fulfillments.v.order_id AS VARCHAR) AS fulfillments_order_id,
    CAST(fulfillments.v.name AS VARCHAR) AS fulfillments_name, fulfillments.v.status AS status,
    coalesce(CAST(line_items.v.id AS VARCHAR), 'N/A') AS line_items_id, CAST(line_items.v.name AS VARCHAR) AS line_items_name,
    line_items.v.product_id, line_items.v.variant_id, line_items.v.sku, line_items.v.quantity, line_items.v.price,
    {FXCOLS}, {LINEAGE}
{nested_from('a.fulfillments AS fulfillments', 'fulfillments.v.line_items AS line_items')}
{FX_ON_RAW}
{LATEST_ORDER}"""

SQL["ShopifyOrdersCustomer"] = f"""WITH {NESTED}, {FX}
SELECT {ORDER_HEAD}, {tz('a.created_at')} AS order_created_at, {tz('a.updated_at')} AS order_updated_at,
    customer.v.state AS state, coalesce(customer.v.id, 0) AS customer_id,
    customer.v.first_name AS customer_first_name, customer.v.last_name AS customer_last_name,
    {tz('customer.v.created_at')} AS created_at, {tz('customer.v.updated_at')} AS updated_at,
    default_address.v.id AS default_address_id, default_address.v.customer_id AS default_customer_id,
    default_address.v.phone AS default_phone, default_address.v.city AS city, {LINEAGE}
{nested_from('a.customer AS customer', 'customer.v.default_address AS default_address')}
{FX_ON_RAW}
QUALIFY dense_rank() OVER (PARTITION BY coalesce(a.id, 0), coalesce(customer.v.id, 0)
    ORDER BY a._daton_batch_runtime DESC, a._daton_batch_id DESC) = 1"""

SQL["ShopifyCollects"] = flat_dataset("collects", "id", "N/A", ("created_at", "updated_at"), "id")
SQL["ShopifyProductMetafields"] = flat_dataset("product_metafields", "id", "N/A", ("created_at", "updated_at"), "id")
SQL["ShopifyCustomCollections"] = flat_dataset("custom_collections", "id", "N/A", ("updated_at", "published_at"), "id")
SQL["ShopifyPriceRules"] = flat_dataset("price_rules", "id", "N/A", ("starts_at", "ends_at", "created_at", "updated_at"),
                                        "id")
SQL["ShopifyEvents"] = flat_dataset("events", "id", "N/A", ("created_at",), "id")
SQL["ShopifyDisputes"] = flat_dataset("disputes", "id", "N/A",
                                      ("evidence_due_by", "evidence_sent_on", "finalized_on", "initiated_at"), "id",
                                      fx="out:finalized_on")
SQL["ShopifyCarrierServices"] = flat_dataset("carrier_services", None, None, (), "id")
SQL["ShopifyBalanceTransactions"] = flat_dataset("balance_transactions", "id", "N/A", ("processed_at",), "id",
                                                 fx="out:processed_at")
SQL["ShopifySmartCollections"] = f"""WITH {flat_union('smart_collections')}
SELECT {brand()} AS brand, id, {tz('updated_at')} AS updated_at, * EXCLUDE (id, updated_at, {DATON_COLS}),
    {DATON_COLS}, {integration_id()} AS _daton_sourceversion_integration_id, 1 AS row_num
FROM u QUALIFY dense_rank() OVER (PARTITION BY id ORDER BY _daton_batch_runtime DESC) = 1"""


# ---- nested columns on the flat records (customer key = _daton_batch_id, nation = fulfillment_id) ----
_AMT = "concat(CAST(_daton_batch_id % 1000 AS VARCHAR), '.', lpad(CAST(fulfillment_id AS VARCHAR), 2, '0'))"
_SUMMARY = ", ".join(f"'{k}_{m}_amount': {_AMT}" for k in ("adjustments", "charges", "refunds", "reserved_funds",
                                                            "retried_payouts") for m in ("fee", "gross"))
ENTITY_NESTED = {
    "default_address": """[{'id': _daton_batch_id * 10, 'customer_id': _daton_batch_id,
        'first_name': concat('F', CAST(_daton_batch_id AS VARCHAR)), 'last_name': concat('L', CAST(_daton_batch_id AS VARCHAR)),
        'phone': CASE WHEN _daton_batch_id % 4 = 0 THEN NULL ELSE concat('555-', CAST(_daton_batch_id AS VARCHAR)) END,
        'city': concat('City', CAST(_daton_batch_id % 50 AS VARCHAR)), 'default': true}]""",
    "receipt": f"[{{'fee_amount': {_AMT}, 'gateway': 'manual'}}]",
    "summary": f"[{{{_SUMMARY}}}]",
    "provinces": "[" + ", ".join(f"""{{'id': concat('P', CAST(fulfillment_id AS VARCHAR), '-{i}'), 'country_id': fulfillment_id,
        'name': concat('Province ', CAST(fulfillment_id AS VARCHAR), '-{i}'), 'code': concat('P', CAST(fulfillment_id AS VARCHAR)),
        'shipping_zone_id': fulfillment_id * 10 + {i}, 'tax': CAST({0.05 * (i + 1)!r} AS DOUBLE),
        'tax_percentage': CAST({5 * (i + 1)} AS BIGINT), 'tax_name': 'GST', 'tax_type': 'normal'}}""" for i in range(2)) + "]",
    "destination": """[{'id': _daton_batch_id * 10 + 3, 'address1': concat(CAST(_daton_batch_id AS VARCHAR), ' Main St'),
        'address2': CAST(NULL AS VARCHAR), 'city': concat('City', CAST(_daton_batch_id % 50 AS VARCHAR)),
        'country': concat('N', CAST(fulfillment_id AS VARCHAR)), 'email': concat('c', CAST(_daton_batch_id AS VARCHAR), '@shop.test'),
        'first_name': concat('F', CAST(_daton_batch_id AS VARCHAR)), 'last_name': concat('L', CAST(_daton_batch_id AS VARCHAR)),
        'phone': CAST(NULL AS VARCHAR), 'province': concat('P', CAST(fulfillment_id AS VARCHAR)),
        'zip': lpad(CAST(_daton_batch_id % 100000 AS VARCHAR), 5, '0')}]""",
    "line_items": "[" + ", ".join(f"""{{'id': concat(CAST(_daton_batch_id AS VARCHAR), '-{i}'), 'shop_id': fulfillment_id,
        'fulfillment_order_id': _daton_batch_id, 'quantity': CAST({i + 1} AS BIGINT), 'line_item_id': _daton_batch_id * 10 + {i},
        'inventory_item_id': _daton_batch_id % 300, 'fulfillable_quantity': CAST({i} AS BIGINT),
        'variant_id': _daton_batch_id * 100 + {i}}}""" for i in range(2)) + "]",
}


def entity_union(entity: str, nested: tuple[str, ...]) -> str:
    extra = ", ".join(f"{ENTITY_NESTED[n]} AS {n}" for n in nested)
    return f"""{FV},
ev AS (SELECT *, CAST(created_at AS DATE) AS date, {extra}{", updated_at AS fulfill_at" if entity == "fulfillment_orders" else ""} FROM fv),
u AS (
  SELECT '{flat_relation('Acme_us', entity)}' AS _dbt_source_relation, * EXCLUDE (arm) FROM ev WHERE arm = 0
  UNION ALL BY NAME
  SELECT '{flat_relation('Zest_ca', entity)}' AS _dbt_source_relation, * EXCLUDE (arm, balance) FROM ev WHERE arm = 1)"""


def entity_from(*steps: str) -> str:
    return nested_from(*steps, base="u")


LIN_U = f"""a._dbt_source_relation, a._daton_user_id, a._daton_batch_runtime, a._daton_batch_id,
    {integration_id('a._dbt_source_relation')} AS _daton_sourceversion_integration_id"""

SQL["ShopifyCustomers"] = f"""WITH {entity_union('customers', ('default_address',))}, {FX},
b AS (
  SELECT {brand('a._dbt_source_relation')} AS brand, coalesce(a.id, 0) AS customer_id,
      {tz('a.created_at')} AS created_at, {tz('a.updated_at')} AS updated_at,
      a.* EXCLUDE (id, created_at, updated_at, default_address, {DATON_COLS}),
      default_address.v.id AS default_address_id, default_address.v.customer_id AS default_address_customer_id,
      default_address.v.first_name AS default_address_first_name, default_address.v.last_name AS default_address_last_name,
      default_address.v.phone AS default_address_phone, default_address.v.city AS city, default_address.v."default" AS "default",
      {LIN_U}
  {entity_from('a.default_address AS default_address')}
  QUALIFY dense_rank() OVER (PARTITION BY coalesce(a.id, 0) ORDER BY a._daton_batch_runtime DESC) = 1)
SELECT a.*, {FXCOLS} FROM b a LEFT JOIN fx b ON CAST(a.created_at AS DATE) = b.date AND a.currency = b.to_currency_code"""

SQL["ShopifyTransactions"] = f"""WITH {entity_union('transactions', ('receipt',))}, {FX},
b AS (
  SELECT {brand('a._dbt_source_relation')} AS brand, coalesce(a.id, 0) AS transactions_id,
      {tz('a.created_at')} AS created_at, {tz('a.processed_at')} AS processed_at,
      a.* EXCLUDE (id, created_at, processed_at, receipt, {DATON_COLS}),
      receipt.v.fee_amount AS receipt_fee_amount, {LIN_U}
  {entity_from('a.receipt AS receipt')}
  QUALIFY row_number() OVER (PARTITION BY coalesce(a.id, 0)
      ORDER BY a._daton_batch_runtime DESC, a._daton_batch_id DESC) = 1)
SELECT a.*, {FXCOLS} FROM b a LEFT JOIN fx b ON CAST(a.processed_at AS DATE) = b.date AND a.currency = b.to_currency_code"""

_SUMMARY_COLS = ", ".join(f"summary.v.{k}_{m}_amount AS summary_{k}_{m}_amount" for k in (
    "adjustments", "charges", "refunds", "reserved_funds", "retried_payouts") for m in ("fee", "gross"))
SQL["ShopifyPayouts"] = f"""WITH {entity_union('payouts', ('summary',))}, {FX},
b AS (
  SELECT {brand('a._dbt_source_relation')} AS brand, coalesce(CAST(a.id AS VARCHAR), 'N/A') AS id,
      a.* EXCLUDE (id, summary, {DATON_COLS}), {_SUMMARY_COLS}, {LIN_U}
  {entity_from('a.summary AS summary')}
  QUALIFY dense_rank() OVER (PARTITION BY a.date ORDER BY a._daton_batch_runtime DESC) = 1)
SELECT a.*, {FXCOLS} FROM b a LEFT JOIN fx b ON CAST(a.date AS DATE) = b.date AND a.currency = b.to_currency_code"""

_PROV = ", ".join(f"provinces.v.{f} AS provinces_{f}" for f in (
    "country_id", "name", "code", "shipping_zone_id", "tax", "tax_percentage", "tax_name", "tax_type"))
SQL["ShopifyCountries"] = f"""WITH {entity_union('countries', ('provinces',))}
SELECT {brand('a._dbt_source_relation')} AS brand, a.* EXCLUDE (provinces, {DATON_COLS}),
    coalesce(provinces.v.id, 'N/A') AS provinces_id, {_PROV}, {LIN_U}
{entity_from('a.provinces AS provinces')}
QUALIFY dense_rank() OVER (PARTITION BY a.id, provinces.v.id ORDER BY a._daton_batch_runtime DESC) = 1"""

_DEST = ", ".join(f"destination.v.{f} AS destination_{f}" for f in (
    "id", "address1", "address2", "city", "country", "email", "first_name", "last_name", "phone", "province", "zip"))
_FLI = ", ".join(f"line_items.v.{f} AS line_items_{f}" for f in (
    "shop_id", "fulfillment_order_id", "quantity", "line_item_id", "inventory_item_id", "fulfillable_quantity",
    "variant_id"))
SQL["ShopifyFulfillmentOrders"] = f"""WITH {entity_union('fulfillment_orders', ('destination', 'line_items'))}
SELECT {brand('a._dbt_source_relation')} AS brand, coalesce(CAST(a.id AS VARCHAR), 'N/A') AS id,
    {tz('a.fulfill_at')} AS fulfill_at, {tz('a.created_at')} AS created_at, {tz('a.updated_at')} AS updated_at,
    a.* EXCLUDE (id, fulfill_at, created_at, updated_at, destination, line_items, {DATON_COLS}),
    {_DEST}, coalesce(line_items.v.id, 'N/A') AS line_items_id, {_FLI}, {LIN_U}
{entity_from('a.destination AS destination', 'a.line_items AS line_items')}
QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY a._daton_batch_runtime DESC, a._daton_batch_id DESC,
                                                     line_items.v.id DESC) = 1"""


# ---- products (from part) ------------------------------------------------------------------------------
def _variant(i: int) -> str:
    price = f"concat(CAST(p_partkey % 100 AS VARCHAR), '.', '{i * 25:02d}')"
    return f"""{{'id': p_partkey * 10 + {i}, 'product_id': p_partkey,
      'title': concat('Size ', CAST(p_size + {i} AS VARCHAR)), 'price': {price},
      'sku': CASE WHEN p_partkey % 5 = 0 AND {i} = 1 THEN NULL ELSE concat('SKU-', CAST(p_partkey AS VARCHAR), '-{i}') END,
      'position': CAST({i + 1} AS BIGINT), 'inventory_policy': 'deny', 'fulfillment_service': 'manual',
      'inventory_management': 'shopify', 'created_at': created_at, 'updated_at': updated_at, 'taxable': true,
      'barcode': CAST(NULL AS VARCHAR), 'grams': CAST(p_size * 10 + {i} AS BIGINT), 'image_id': CAST(NULL AS BIGINT),
      'weight': CAST(p_size AS DOUBLE) / 10.0, 'weight_unit': 'kg', 'inventory_item_id': p_partkey * 10 + {i},
      'inventory_quantity': p_partkey % 50 + {i}, 'old_inventory_quantity': p_partkey % 50, 'requires_shipping': true,
      'admin_graphql_api_id': concat('gid://v/', CAST(p_partkey * 10 + {i} AS VARCHAR)),
      'presentment_prices': [{{'price': [{{'amount': {price}, 'currency_code': 'USD'}}]}},
                             {{'price': [{{'amount': {price}, 'currency_code': 'EUR'}}]}}]}}"""


PRODUCTS = f"""pv AS (
  SELECT CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_partkey END AS id, p_name AS title, p_brand AS vendor,
    p_type AS product_type, 'active' AS status, created_at, updated_at,
    [{_variant(0)}, {_variant(1)}] AS variants, ['Size'] AS options, [concat('img', CAST(p_partkey AS VARCHAR))] AS images,
    {{'src': concat('img', CAST(p_partkey AS VARCHAR))}} AS image,
    concat('u', CAST(v AS VARCHAR)) AS _daton_user_id, {PRODUCT_BATCH0_MS} + v * 86400000 AS _daton_batch_runtime,
    p_partkey AS _daton_batch_id, p_partkey % 2 AS arm
  FROM (SELECT *, created_at + to_days(CAST(v AS BIGINT)) AS updated_at
        FROM (SELECT *, TIMESTAMP '2021-06-01 00:00:00' + to_hours(CAST(p_partkey % 1000 AS BIGINT)) AS created_at
              FROM part, (SELECT unnest([0, 1]) AS v)))),
u AS (
  SELECT '{flat_relation('Acme_us', 'products')}' AS _dbt_source_relation, * EXCLUDE (arm) FROM pv WHERE arm = 0
  UNION ALL BY NAME
  SELECT '{flat_relation('Zest_ca', 'products')}' AS _dbt_source_relation, * EXCLUDE (arm, vendor) FROM pv WHERE arm = 1)"""

_VARIANT_FIELDS = ("position", "inventory_policy", "fulfillment_service", "inventory_management", "created_at",
                   "updated_at", "taxable", "barcode", "grams", "image_id", "weight", "weight_unit", "inventory_item_id",
                   "inventory_quantity", "old_inventory_quantity", "requires_shipping", "admin_graphql_api_id")
SQL["ShopifyProducts"] = f"""WITH {PRODUCTS}
SELECT {brand('a._dbt_source_relation')} AS brand, coalesce(a.id, 0) AS product_id,
    {tz('a.created_at')} AS product_created_at, {tz('a.updated_at')} AS product_updated_at,
    a.* EXCLUDE (id, created_at, updated_at, variants, options, images, image, {DATON_COLS}),
    coalesce(variants.v.id, 0) AS variants_id, variants.v.product_id AS variants_product_id,
    variants.v.title AS variants_title, variants.v.price AS variants_price,
    coalesce(variants.v.sku, 'N/A') AS variants_sku,
    {', '.join(f'variants.v."{f}" AS variants_{f}' for f in _VARIANT_FIELDS)},
    price.v.amount AS price_amount, price.v.currency_code AS price_currency_code, {LIN_U}
{nested_from('a.variants AS variants', 'variants.v.presentment_prices AS presentment_prices',
             'presentment_prices.v.price AS price', base='u')}
QUALIFY dense_rank() OVER (PARTITION BY coalesce(a.id, 0) ORDER BY a._daton_batch_runtime DESC) = 1"""


# ---- refunds (returned line items) -----------------------------------------------------------------------
_RAMT = "concat(CAST(l_linenumber AS VARCHAR), '.', lpad(CAST(l_partkey % 100 AS VARCHAR), 2, '0'))"
_RCUR = "concat('C', CAST(o_custkey % 5 AS VARCHAR))"
_MSET = (f"{{'shop_money': [{{'amount': {_RAMT}, 'currency_code': 'USD'}}], "
         f"'presentment_money': [{{'amount': {_RAMT}, 'currency_code': {_RCUR}}}]}}")
REFUNDS = f"""rx AS (SELECT l.*, o.o_custkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
             WHERE l.l_returnflag = 'R'),
rg AS (
  SELECT l_orderkey, o_custkey, l_shipdate, count(*) AS n,
    list({{'id': l_orderkey * 10 + l_linenumber, 'quantity': CAST(trunc(l_quantity) AS BIGINT),
           'line_item': [{{'id': l_orderkey * 10 + l_linenumber, 'variant_id': l_suppkey, 'product_id': l_partkey,
                           'sku': concat('SKU-', CAST(l_partkey AS VARCHAR)), 'total_discount': {_RAMT}, 'gift_card': false,
                           'tax_lines': [{{'title': 'VAT', 'price_set': [{_MSET}]}}]}}],
           'subtotal_set': [{_MSET}], 'total_tax_set': [{_MSET}], 'restock_type': 'no_restock'}}) AS refund_line_items,
    coalesce(list({{'id': l_orderkey * 10 + l_linenumber, 'refund_id': l_orderkey, 'order_id': l_orderkey,
           'kind': 'refund_discrepancy', 'reason': 'Refund discrepancy', 'amount_set': [{_MSET}],
           'tax_amount_set': [{_MSET}]}}) FILTER (WHERE l_discount > 0.05), []) AS order_adjustments,
    list({{'id': l_orderkey * 10 + l_linenumber, 'order_id': l_orderkey, 'created_at': l_shipdate,
           'currency': {_RCUR}, 'kind': 'refund', 'amount': {_RAMT}}}) AS transactions
  FROM rx GROUP BY l_orderkey, o_custkey, l_shipdate),
rf AS (
  SELECT CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_orderkey END AS id, l_orderkey AS order_id,
    concat('refund ', CAST(l_orderkey AS VARCHAR)) AS note, l_shipdate AS created_at, l_shipdate + to_days(1) AS processed_at,
    refund_line_items, order_adjustments, transactions, concat('u', CAST(o_custkey % 10 AS VARCHAR)) AS _daton_user_id,
    epoch_ms(l_shipdate) AS _daton_batch_runtime, n AS _daton_batch_id,
    '{flat_relation('Acme_us', 'refunds')}' AS _dbt_source_relation
  FROM rg)"""

_B_LIN = f"""b._dbt_source_relation, b._daton_user_id, b._daton_batch_runtime, b._daton_batch_id,
    {integration_id('b._dbt_source_relation')} AS _daton_sourceversion_integration_id"""
_DAT = "a._dbt_source_relation, a._daton_user_id, a._daton_batch_runtime, a._daton_batch_id"


def _fx_cols(cur: str) -> str:
    return f"coalesce(x.value, 1) AS fx_rate, coalesce(x.from_currency_code, {cur}) AS fx_currency_code"


SQL["ShopifyRefundsLineItems"] = f"""WITH {REFUNDS}, {FX},
b AS (
  SELECT {tz('a.created_at')} AS created_at, {tz('a.processed_at')} AS processed_at, coalesce(a.id, 0) AS refund_id,
    a.order_id, a.note, coalesce(refund_line_items.v.id, 0) AS refund_line_items_id,
    refund_line_items.v.quantity AS refund_line_items_quantity, refund_line_items.v.restock_type AS restock_type,
    line_item.v.id AS refund_line_items_line_item_id, coalesce(line_item.v.variant_id, 0) AS variant_id,
    line_item.v.product_id AS product_id, line_item.v.sku AS sku, line_item.v.total_discount AS total_discount,
    line_item.v.gift_card AS gift_card,
    shop_money.v.amount AS shop_money_amount, shop_money.v.currency_code AS shop_money_currency_code,
    presentment_money.v.amount AS presentment_money_amount,
    presentment_money.v.currency_code AS presentment_money_currency_code, {_DAT}
  {nested_from('a.refund_line_items AS refund_line_items', 'refund_line_items.v.line_item AS line_item',
               'refund_line_items.v.subtotal_set AS subtotal_set', 'subtotal_set.v.shop_money AS shop_money',
               'subtotal_set.v.presentment_money AS presentment_money', base='rf')}
  QUALIFY row_number() OVER (PARTITION BY coalesce(a.id, 0), CAST(refund_line_items.v.id AS VARCHAR)
      ORDER BY a._daton_batch_runtime DESC, a._daton_batch_id DESC, line_item.v.product_id DESC NULLS LAST,
               line_item.v.variant_id DESC NULLS LAST, refund_line_items.v.quantity DESC NULLS LAST,
               shop_money.v.amount DESC NULLS LAST, presentment_money.v.amount DESC NULLS LAST) = 1)
SELECT {brand('b._dbt_source_relation')} AS brand, b.* EXCLUDE (_dbt_source_relation, _daton_user_id,
    _daton_batch_runtime, _daton_batch_id), {_fx_cols('b.presentment_money_currency_code')}, {_B_LIN}
FROM b LEFT JOIN fx x ON CAST(b.created_at AS DATE) = x.date AND b.presentment_money_currency_code = x.to_currency_code"""

SQL["ShopifyRefundsLineItemsTax"] = f"""WITH {REFUNDS}, {FX},
b AS (
  SELECT {tz('a.created_at')} AS created_at, {tz('a.processed_at')} AS processed_at, coalesce(a.id, 0) AS refund_id,
    a.order_id, coalesce(refund_line_items.v.id, 0) AS refund_line_items_id,
    refund_line_items.v.quantity AS refund_line_items_quantity, line_item.v.id AS refund_line_items_line_item_id,
    line_item.v.id AS id, line_item.v.variant_id AS variant_id, line_item.v.product_id AS product_id,
    line_item.v.sku AS sku, coalesce(tax_lines.v.title, 'N/A') AS title,
    shop_money.v.amount AS shop_money_amount, shop_money.v.currency_code AS shop_money_currency_code,
    presentment_money.v.amount AS presentment_money_amount,
    presentment_money.v.currency_code AS presentment_money_currency_code, {_DAT}
  {nested_from('a.refund_line_items AS refund_line_items', 'refund_line_items.v.line_item AS line_item',
               'line_item.v.tax_lines AS tax_lines', 'tax_lines.v.price_set AS price_set',
               'price_set.v.shop_money AS shop_money', 'price_set.v.presentment_money AS presentment_money', base='rf')}
  QUALIFY dense_rank() OVER (PARTITION BY coalesce(a.id, 0) ORDER BY a._daton_batch_runtime DESC) = 1),
c AS (
  SELECT {brand('b._dbt_source_relation')} AS brand, b.* EXCLUDE (_dbt_source_relation, _daton_user_id,
      _daton_batch_runtime, _daton_batch_id), {_fx_cols('b.presentment_money_currency_code')}, {_B_LIN}, 1 AS row_num
  FROM b LEFT JOIN fx x ON CAST(b.created_at AS DATE) = x.date AND b.presentment_money_currency_code = x.to_currency_code)
SELECT *, row_number() OVER (PARTITION BY refund_id ORDER BY _daton_batch_runtime DESC, refund_line_items_id NULLS FIRST,
    title NULLS FIRST, shop_money_amount NULLS FIRST, presentment_money_currency_code NULLS FIRST, product_id NULLS FIRST,
    variant_id NULLS FIRST, fx_currency_code NULLS FIRST, fx_rate NULLS FIRST) AS _seq_id
FROM c"""

SQL["ShopifyRefundsOrderAdjustments"] = f"""WITH {REFUNDS}, {FX},
b AS (
  SELECT {tz('a.created_at')} AS created_at, {tz('a.processed_at')} AS processed_at, coalesce(a.id, 0) AS refund_id,
    a.note, coalesce(order_adjustments.v.id, 0) AS order_adjustments_id,
    order_adjustments.v.refund_id AS order_adjustments_refund_id, order_adjustments.v.order_id AS order_id,
    order_adjustments.v.kind AS kind, order_adjustments.v.reason AS reason,
    order_adjustments.v.tax_amount_set AS tax_amount_set,
    shop_money.v.amount AS amount_set_shop_money_amount, shop_money.v.currency_code AS amount_set_shop_money_currency_code,
    presentment_money.v.amount AS amount_set_presentment_money_amount,
    presentment_money.v.currency_code AS amount_set_presentment_money_currency_code, {_DAT}
  {nested_from('a.order_adjustments AS order_adjustments', 'order_adjustments.v.amount_set AS amount_set',
               'amount_set.v.shop_money AS shop_money', 'amount_set.v.presentment_money AS presentment_money', base='rf')}
  QUALIFY row_number() OVER (PARTITION BY coalesce(a.id, 0), a.order_id, CAST(order_adjustments.v.id AS VARCHAR)
      ORDER BY a._daton_batch_runtime DESC, a._daton_batch_id DESC, shop_money.v.amount DESC NULLS LAST,
               presentment_money.v.amount DESC NULLS LAST, order_adjustments.v.kind DESC NULLS LAST) = 1),
c AS (
  SELECT {brand('b._dbt_source_relation')} AS brand, coalesce(b.order_id, 0) AS order_id,
      b.* EXCLUDE (tax_amount_set, order_id, _dbt_source_relation, _daton_user_id, _daton_batch_runtime, _daton_batch_id),
      tsm.v.amount AS tax_amount_set_shop_money_amount, tsm.v.currency_code AS tax_amount_set_shop_money_currency_code,
      tpm.v.amount AS tax_amount_set_presentment_money_amount,
      tpm.v.currency_code AS tax_amount_set_presentment_money_currency_code,
      {_fx_cols('b.amount_set_presentment_money_currency_code')}, {_B_LIN}, 1 AS row_num
  FROM b LEFT JOIN LATERAL (SELECT unnest(b.tax_amount_set) AS v) AS tas ON TRUE
    LEFT JOIN LATERAL (SELECT unnest(tas.v.shop_money) AS v) AS tsm ON TRUE
    LEFT JOIN LATERAL (SELECT unnest(tas.v.presentment_money) AS v) AS tpm ON TRUE
    LEFT JOIN fx x ON CAST(b.created_at AS DATE) = x.date AND b.amount_set_presentment_money_currency_code = x.to_currency_code)
SELECT *, row_number() OVER (PARTITION BY refund_id ORDER BY _daton_batch_runtime DESC, order_adjustments_id NULLS FIRST,
    amount_set_shop_money_amount NULLS FIRST, tax_amount_set_shop_money_amount NULLS FIRST,
    tax_amount_set_presentment_money_amount NULLS FIRST, fx_currency_code NULLS FIRST, fx_rate NULLS FIRST,
    note NULLS FIRST) AS _seq_id
FROM c"""

SQL["ShopifyRefundsTransactions"] = f"""WITH {REFUNDS}, {FX},
b AS (
  SELECT {tz('a.created_at')} AS refund_created_at, {tz('a.processed_at')} AS refund_processed_at,
    coalesce(a.id, 0) AS refund_id, coalesce(transactions.v.id, 0) AS transactions_id,
    transactions.v.order_id AS order_id, transactions.v.created_at AS created_at, transactions.v.currency AS currency,
    transactions.v.kind AS kind, transactions.v.amount AS amount, {_DAT}
  {nested_from('a.transactions AS transactions', base='rf')}
  QUALIFY dense_rank() OVER (PARTITION BY a.id ORDER BY a._daton_batch_runtime DESC) = 1),
c AS (
  SELECT {brand('b._dbt_source_relation')} AS brand, coalesce(b.order_id, 0) AS order_id,
      b.* EXCLUDE (order_id, _dbt_source_relation, _daton_user_id, _daton_batch_runtime, _daton_batch_id),
      {_fx_cols('b.currency')}, {_B_LIN}, 1 AS row_num
  FROM b LEFT JOIN fx x ON CAST(b.created_at AS DATE) = x.date AND b.currency = x.to_currency_code)
SELECT *, row_number() OVER (PARTITION BY refund_id ORDER BY _daton_batch_runtime DESC, transactions_id NULLS FIRST,
    amount NULLS FIRST, fx_currency_code NULLS FIRST, fx_rate NULLS FIRST) AS _seq_id
FROM c"""
