"""Numbered datasets: what is shuffled with the parents, and what stays on disk beside the rows written."""

import datetime as dt
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from rawfold import Settings
from rawfold.operators.latest import keep_latest, seq_id
from rawfold.plans import builder
from rawfold.plans.specs import BY_NAME

SPEC = BY_NAME["ShopifyOrdersLineItemsTaxLines"]
MONEY = "array<struct<amount: double, currency_code: string>>"
RAW = f"""id long, name string, currency string, created_at timestamp_ntz, updated_at timestamp_ntz,
    line_items array<struct<id: long, product_id: long, variant_id: long, sku: string, name: string,
        tax_lines: array<struct<title: string, rate: double, price: double,
                                price_set: array<struct<shop_money: {MONEY}, presentment_money: {MONEY}>>>>,
        discount_allocations: array<struct<amount: double>>, properties: array<struct<name: string, value: string>>>>,
    _daton_user_id string, _daton_batch_runtime long, _daton_batch_id long"""
RATES = "date date, from_currency_code string, to_currency_code string, value double"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _item(i, taxes=1):
    money = [(float(i), "USD")]
    return (i, i, i, f"s{i}", f"n{i}", [("VAT", 0.1, float(i), [(money, money * 2)])] * taxes, [(1.0,)], [("p", "v")])


def _raw(spark):
    day = dt.datetime(2024, 5, 1)
    rows = [(k, f"o{k}", "USD", day, day, items, "u", batch, 1)
            for k in (None, 0, 1, 2, 3) for batch, items in ((10, [_item(1), _item(2)]), (20, [_item(3)]), (20, None), (15, [_item(4, 0)]))]
    return spark.createDataFrame(rows, RAW).repartition(3)


def _build(spark, **kw):
    fx = spark.createDataFrame([], RATES)
    return builder.build(SPEC, [("`lake`.`raw`.`Acme_us_shopify_1_orders`", _raw(spark))], Settings(), fx=fx, include_audit=False, **kw)


@pytest.mark.parametrize("large", [100, 1_000_000])
def test_split_keeps_the_same_rows(spark, large):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, *range(30)]), rnd.choice([None, 1, 2, 3]), rnd.randint(0, 3), i) for i in range(2000)]
    rows += [(5, 9, 0, 10_000 + i) for i in range(500)]  # a key whose newest batch is large
    df = spark.createDataFrame(rows, "k long, b long, c long, i long").repartition(5)
    keys = [F.coalesce("k", F.lit(0))]
    out = keep_latest(df, keys, ["b", "c"], strategy="split", large=large)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, keep_latest(df, keys, ["b", "c"]).collect()), key=str)
    plan = _plan(out)
    assert "WindowGroupLimit" in plan and "Partial" in plan  # older rows go before the shuffle
    assert ("partial_max" in plan) == (large == 100)  # the large key is joined, so that its rows can be split


def test_null_keys_are_one_group_of_the_split(spark):
    df = spark.createDataFrame([(None, 1, i) for i in range(50)] + [(None, 0, 90), (1, 5, 91), (1, 4, 92)], "k long, b long, i long")
    for large in (10, 1000):
        got = sorted(r.i for r in keep_latest(df, ["k"], ["b"], strategy="split", large=large).collect())
        assert got == [*range(50), 91]


def test_parents_are_shuffled_once_without_older_versions_and_unread_fields(spark, monkeypatch):
    monkeypatch.setattr(builder, "seq_id", lambda df, *a, **kw: df)
    plan = _plan(_build(spark))
    assert "partial_max" not in plan and "WindowGroupLimit" in plan and "Partial" in plan
    raw = _raw(spark)
    assert builder.unread_fields(raw, SPEC, "line_items") == ["name", "discount_allocations", "properties"]
    left = builder._narrowed(raw, SPEC).schema["line_items"].dataType.elementType.fieldNames()
    assert left == ["id", "product_id", "variant_id", "sku", "tax_lines"]


def test_rows_and_numbers_are_those_of_the_plain_plan(spark):
    split = _build(spark)
    plain = _build(spark, seq_strategy="window")
    assert split.columns == plain.columns and split.dtypes == plain.dtypes
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))
    assert split.count() == 5 * (2 + 1)  # of each order the newest batch: a tax line with two amounts, and a row without lines


def test_a_column_that_is_read_whole_keeps_its_fields(spark):
    raw = _raw(spark)
    for name in ("ShopifyOrdersLineItems", "ShopifyOrdersLineItemsProperties"):
        unread = builder.unread_fields(raw, BY_NAME[name], "line_items")
        assert set(unread).isdisjoint({"id", "product_id", "sku", "variant_id"})
    assert builder.unread_fields(raw, SPEC, "absent") == []
    assert builder.unread_fields(raw, SPEC, "name") == []


def _shuffles(spark):
    """Ids of the shuffles that have files on this machine."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return set(re.findall(r"/shuffle_(\d+)_", files))


def test_shuffles_below_the_numbering_are_removed_once_its_rows_are_written(spark):
    before = _shuffles(spark)
    df = spark.range(20_000).groupBy((F.col("id") % 997).alias("p")).agg(F.max("id").alias("b"))
    out = seq_id(df, ["p"], ["b"])
    until = time.time() + 20
    while len(left := _shuffles(spark) - before) > 1 and time.time() < until:
        time.sleep(0.2)
    assert len(left) <= 1  # of the count of parents
    assert out.count() == 997
