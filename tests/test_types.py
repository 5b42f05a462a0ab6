"""Common types of columns that differ between relations, and the casts pushed into nested values."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawfold.sources.relations import CatalogSource, discover, union_relations
from rawfold.sources.types import common_type, convert, readable


def t(text):
    return T._parse_datatype_string(text)


def both(a, b):
    return common_type([t(a), t(b)]).simpleString()


def test_common_types(spark):
    assert both("array<struct<id:bigint>>", "array<struct<id:string>>") == "array<struct<id:string>>"
    assert both("array<struct<id:bigint>>", "struct<id:int,x:double>") == "array<struct<id:bigint,x:double>>"
    assert both("struct<a:int,B:string>", "struct<b:string,c:date>") == "struct<a:int,B:string,c:date>"
    assert both("array<int>", "bigint") == "array<bigint>" and both("map<string,int>", "map<string,string>") == "map<string,string>"
    assert both("struct<a:int>", "string") == "string" and both("array<decimal(10,2)>", "array<float>") == "array<double>"
    assert both("date", "timestamp_ntz") == "timestamp_ntz" and both("boolean", "bigint") == "string"
    assert both("void", "struct<a:int>") == "struct<a:int>" and both("array<void>", "array<struct<a:int>>") == "array<struct<a:int>>"


def test_union_is_the_same_type_in_any_order_of_arms(spark):
    a, b, c = "array<struct<id:bigint,tax:array<struct<rate:int>>>>", "struct<id:string,tax:struct<rate:double,title:string>>", "array<struct<ID:int>>"
    kinds = {common_type([t(x) for x in arms]).simpleString().lower() for arms in ((a, b, c), (c, b, a), (b, a, c))}
    assert len(kinds) == 1 and "rate:double" in kinds.pop()


def test_probed_cases_give_widened_rows(spark):
    """An array of structs with a bigint id, one with a text id, and a single struct."""
    a = spark.createDataFrame([(1, [(10,), (11,)]), (2, None), (3, [])], "k long, items array<struct<id:bigint>>")
    b = spark.createDataFrame([(4, [("x7",), None])], "k long, items array<struct<id:string>>")
    c = spark.createDataFrame([(5, (9, "n")), (6, None)], "k int, items struct<id:int,note:string>")
    u = union_relations([("a", a), ("b", b), ("c", c)])
    assert u.schema["items"].dataType.simpleString() == "array<struct<id:string,note:string>>"
    got = {r["k"]: r["items"] and [x and tuple(x) for x in r["items"]] for r in u.collect()}
    assert got == {1: [("10", None), ("11", None)], 2: None, 3: [], 4: [("x7", None), None], 5: [("9", "n")], 6: None}


def test_nested_orders_and_refunds_of_two_stores_stack_and_unnest(spark):
    """One store wraps line items and their tax lines in arrays, the other sends objects; the explode chain gives the same rows."""
    from rawfold.operators.nested import unnest_chain
    a = spark.createDataFrame([(1, [(7, [(1.5,), (2.5,)])])], "id long, refund_line_items array<struct<q:bigint,tax_lines:array<struct<price:double>>>>")
    b = spark.createDataFrame([(2, ("7x", ("3.5",)))], "id long, refund_line_items struct<q:string,tax_lines:struct<price:string>>")
    x = unnest_chain(union_relations([("a", a), ("b", b)]), ["refund_line_items", ("refund_line_items", "tax_lines")])
    got = sorted(tuple(r) for r in x.select("id", F.col("refund_line_items.q"), F.col("tax_lines.price")).collect())
    assert got == [(1, "7", "1.5"), (1, "7", "2.5"), (2, "7x", "3.5")]


def test_nested_value_against_text_is_json(spark):
    a = spark.createDataFrame([((1, "x"),), (None,)], "v struct<a:int,b:string>")
    b = spark.createDataFrame([("plain",)], "v string")
    assert [r["v"] for r in union_relations([("a", a), ("b", b)]).collect()] == ['{"a":1,"b":"x"}', None, "plain"]


def test_maps_and_untouched_parts(spark):
    d = spark.createDataFrame([({"a": 1},)], "m map<string,int>")
    to = t("map<string,bigint>")
    assert d.select(convert(F.col("m"), d.schema["m"].dataType, to).alias("m")).schema["m"].dataType == to
    same = t("array<struct<a:int>>")
    assert convert(F.col("x"), same, same)._jc.toString() == "x"  # nothing to rebuild


def test_readable():
    assert readable(t("int"), t("bigint")) and not readable(t("bigint"), t("string")) and not readable(t("bigint"), t("int"))
    assert readable(t("array<struct<a:int>>"), t("array<struct<a:bigint,b:string>>"))


def test_relations_of_all_schemas_that_match(spark):
    for s in ("acme_raw", "zest_raw", "other"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {s}")
        spark.range(1).write.mode("overwrite").saveAsTable(f"{s}.x_us_shopify_1_orders")
    try:
        found = discover(CatalogSource(spark, "%_RAW", "lake"), "%shopify%orders")
        assert [r.name for r in found] == [f"`lake`.`{s}`.`x_us_shopify_1_orders`" for s in ("acme_raw", "zest_raw")]
        assert found[0].load().count() == 1
        assert [r.name for r in discover(CatalogSource(spark, "other"), "%orders")] == ["`spark_catalog`.`other`.`x_us_shopify_1_orders`"]
    finally:
        for s in ("acme_raw", "zest_raw", "other"):
            spark.sql(f"DROP DATABASE {s} CASCADE")
