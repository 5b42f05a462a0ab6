import datetime as dt

import pytest
from pyspark.sql import functions as F

from rawfold.config import Settings
from rawfold.functions.convert import millis_to_ts, to_wallclock, typed_default
from rawfold.functions.lineage import brand, integration_id, integration_id_tokens, store_token
from rawfold.operators.fx import MissingRates, fx_left_join


def test_timezone_conversion_is_dst_aware_and_flagged(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 7, 0),), (dt.datetime(2024, 3, 10, 9, 0),),
                                (dt.datetime(2024, 11, 3, 7, 0),)], "ts timestamp_ntz")
    s = Settings()
    got = [r[0] for r in df.select(to_wallclock("ts", s, df.schema["ts"].dataType)).collect()]
    assert got == [dt.datetime(2024, 3, 10, 1, 0), dt.datetime(2024, 3, 10, 4, 0), dt.datetime(2024, 11, 3, 1, 0)]
    off = [r[0] for r in df.select(to_wallclock("ts", s.with_(timezone_conversion=False))).collect()]
    assert off[0] == dt.datetime(2024, 3, 10, 7, 0)


def test_typed_defaults_never_fail_on_mixed_types(spark):
    df = spark.createDataFrame([(None, None), (5, "a")], "id long, s string")
    t = dict((f.name, f.dataType) for f in df.schema.fields)
    rows = df.select(typed_default("id", "N/A", t["id"]).alias("a"), typed_default("id", 0, t["id"]).alias("b"),
                     typed_default("s", 0, t["s"]).alias("c")).collect()
    assert [tuple(r) for r in rows] == [("N/A", 0, "0"), ("5", 5, "a")]
    assert df.select(millis_to_ts(F.lit(0))).first()[0] == dt.datetime(1970, 1, 1)


def test_lineage_expressions(spark):
    df = spark.createDataFrame([("`db`.`raw`.`Acme_us_shopify_12_orders_3`",), ("short",)], "r string")
    rows = df.select(brand("r"), integration_id("r"), integration_id_tokens("r"), store_token("r")).collect()
    assert tuple(rows[0]) == ("Acme", "acme_us_123", "acme_us", "shopify")
    assert tuple(rows[1]) == (None, None, None, None)


def test_fx_join_fans_out_defaults_and_flag(spark):
    facts = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 23, 0), "C1"), (2, dt.datetime(2024, 1, 2), "C9")],
                                  "id long, ts timestamp_ntz, cur string")
    fx = spark.createDataFrame([(dt.date(2024, 1, 2), "USD", "C1", 2.0), (dt.date(2024, 1, 2), "EUR", "C1", 3.0)],
                               "date date, from_currency_code string, to_currency_code string, value double")
    out = fx_left_join(facts, fx, "ts", "cur", Settings())
    rows = sorted((r.id, r.fx_rate, r.fx_currency_code) for r in out.collect())
    assert rows == [(1, 2.0, "USD"), (1, 3.0, "EUR"), (2, 1.0, "C9")]
    off = fx_left_join(facts, None, "ts", "cur", Settings(currency_conversion=False))
    assert sorted((r.id, r.fx_rate) for r in off.collect()) == [(1, 1), (2, 1)]
    assert off.schema["fx_rate"].dataType.simpleString() == "decimal(38,9)"
    with pytest.raises(MissingRates):
        fx_left_join(facts, None, "ts", "cur", Settings())
