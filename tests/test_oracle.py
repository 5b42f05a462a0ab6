"""Registered queries equal their DuckDB twins on the smallest driver tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from rawfold.plans.registry import QUERIES
from rawfold.plans.specs import SPECS
from tools.oracle_check import TABLES, rows_of

from paths import SF_SMALL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0 and "order_id" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql()[name])
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    assert srows, "a comparison of nothing with nothing proves nothing"
    if "fx_rate" in df.columns and name != "ShopifyShop":
        assert any(r["fx_rate"] not in (None, 1) for r in df.collect()), "no rate was joined"
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, srows) == rows_of(dcols, drows)


def test_fixtures_show_both_sides(spark):
    stale = QUERIES["check_recency"](spark, SF_SMALL).count()
    groups = QUERIES["union_relations"](spark, SF_SMALL).select("email").distinct().count()
    assert 0 < stale < groups
    assert {r["entity"] for r in QUERIES["relation_match"](spark, SF_SMALL).select("entity").distinct().collect()} == {
        s.name for s in SPECS}
    seq = QUERIES["ShopifyOrdersDiscountApplications"](spark, SF_SMALL)
    assert seq.groupBy("order_id").count().filter("count >= 2").count() > 0
    fan = QUERIES["ShopifyGiftCards"](spark, SF_SMALL).filter("fx_currency_code = 'EUR'")
    assert not fan.isEmpty()
