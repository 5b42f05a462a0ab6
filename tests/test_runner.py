"""End to end: run_all twice (full, then incremental after new loads) equals one full build."""

import datetime as dtm

import pytest
from pyspark.sql import functions as F

from rawfold.config import Settings
from rawfold.plans.builder import build
from rawfold.plans.runner import RunFailed, run_all
from rawfold.plans.specs import BY_NAME
from rawfold.sources import driver_tables as dt
from rawfold.sources.incremental import read_current
from rawfold.sources.relations import MappingSource

from paths import SF_SMALL

DROP = ("_last_updated", "_run_id")


def _write_orders(v, root, mode):
    paths = {}
    for name, arm, drop in (("Acme_us_shopify_1_orders", 0, ["arm"]), ("Zest_ca_shopify_22_orders", 1, ["arm", "tags"])):
        path = f"{root}/{name}"
        v.filter(F.col("arm") == arm).drop(*drop).write.mode(mode).parquet(path)
        paths[name] = path
    return paths


def test_full_then_incremental_equals_full_load(spark, tmp_path):
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    root, out = str(tmp_path / "raw"), str(tmp_path / "staging")
    v = dt.order_versions(spark, SF_SMALL)
    paths = _write_orders(v.filter(F.col("updated_at") < cut), root, "overwrite")
    rates_path, backup_path = f"{root}/daton_exchange_rates", f"{root}/backup_exchange_rates"
    raw_rates = dt.raw_rates(spark, SF_SMALL)
    raw_rates.drop("k").write.parquet(rates_path)
    raw_rates.filter(F.col("k") == 0).drop("k").write.parquet(backup_path)
    tables = {**paths, "daton_exchange_rates": rates_path, "backup_exchange_rates": backup_path,
              "Acme_us_shopify_1_draft_orders": paths["Acme_us_shopify_1_orders"]}
    source = MappingSource(spark, tables, database="lake", schema="raw")

    audit1 = {r.dataset: r for r in run_all(spark, source, out, Settings(), only=["ShopifyOrders"]).collect()}
    assert set(audit1) == {"ExchangeRates", "ShopifyOrders"}
    # the C0 rates arrive from two relations: by default the newest load wins, so the rate key is unique
    assert audit1["ShopifyOrders"].status == audit1["ExchangeRates"].status == "success"
    _write_orders(v.filter(F.col("updated_at") >= cut), root, "append")
    run_all(spark, source, out, Settings(), only=["ShopifyOrders"])

    got = read_current(spark, f"{out}/ShopifyOrders").drop(*DROP)
    relations = [(f"`lake`.`raw`.`{n}`", spark.read.parquet(p)) for n, p in sorted(paths.items())]
    rates = read_current(spark, f"{out}/ExchangeRates").select("date", "from_currency_code", "to_currency_code", "value")
    want = build(BY_NAME["ShopifyOrders"], relations, Settings(), fx=rates, include_audit=False)
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert want.select(cols).exceptAll(got.select(cols)).count() == 0
    # the draft-orders table was excluded by pattern
    assert got.filter(F.col("_dbt_source_relation").contains("draft")).count() == 0


LOC = ("id long, created_at timestamp_ntz, updated_at timestamp_ntz, currency string, _daton_user_id string, "
       "_daton_batch_runtime long, _daton_batch_id long")
RATE = ("date date, from_currency_code string, to_currency_code string, value double, _daton_user_id string, "
        "_daton_batch_runtime long, _daton_batch_id long")
NOW, DAY = dtm.datetime(2024, 3, 10, 12), dtm.date(2024, 3, 10)
BOTH = {"ShopifyGiftCards": True}


def gift_cards(spark):
    rows = [(1, NOW, NOW, "C1", "u", 100, 0), (2, NOW, NOW, "C9", "u", 100, 0)]
    return spark.createDataFrame(rows, LOC).withColumn(
        "disabled_at", F.lit(None).cast("timestamp_ntz"))


def rates_table(spark, *rows):
    return spark.createDataFrame([(DAY, "USD", "C1", v, "u", b, 0) for v, b in rows], RATE)


def test_rates_are_found_in_their_own_schema(spark, tmp_path):
    source = MappingSource(spark, {"Acme_us_shopify_1_gift_cards": gift_cards(spark)})
    shared = MappingSource(spark, {"daton_exchange_rates": rates_table(spark, (2.0, 1), (2.5, 2))}, schema="shared")
    run_all(spark, source, str(tmp_path / "a"), Settings(enabled=BOTH), only=["ShopifyGiftCards"], shared=shared)
    got = {r["id"]: r["fx_rate"] for r in read_current(spark, str(tmp_path / "a" / "ShopifyGiftCards")).collect()}
    assert got == {"1": 2.5, "2": 1.0}


def test_missing_rates_fail_the_datasets_that_need_them_and_no_other(spark, tmp_path):
    out = str(tmp_path / "a")
    loc = spark.createDataFrame([(1, NOW, NOW, "C1", "u", 100, 0)], LOC)
    source = MappingSource(spark, {"Acme_us_shopify_1_gift_cards": gift_cards(spark), "Acme_us_shopify_1_locations": loc})
    with pytest.raises(RunFailed, match="ShopifyGiftCards: MissingRates"):
        run_all(spark, source, out, Settings(enabled=BOTH), only=["ShopifyGiftCards", "ShopifyLocations"])
    audit = {r.dataset: r.status for r in spark.read.parquet(f"{out}/_run_audit").collect()}
    assert audit["ShopifyGiftCards"].startswith("error: MissingRates") and audit["ShopifyLocations"] == "success"
    assert read_current(spark, f"{out}/ShopifyLocations").count() == 1
    off = run_all(spark, source, str(tmp_path / "b"), Settings(enabled=BOTH, currency_conversion=False), only=["ShopifyGiftCards"])
    assert [r.status for r in off.collect()] == ["success"]
    assert {r["fx_rate"] for r in read_current(spark, str(tmp_path / "b" / "ShopifyGiftCards")).collect()} == {1}


@pytest.mark.parametrize("policy,rates", [("newest", [3.0]), ("keep", [2.0, 3.0])])
def test_rate_keys_of_two_relations(spark, tmp_path, policy, rates):
    source = MappingSource(spark, {"Acme_us_shopify_1_gift_cards": gift_cards(spark),
                                   "a_exchange_rates": rates_table(spark, (2.0, 1)), "b_exchange_rates": rates_table(spark, (3.0, 2))})
    run_all(spark, source, str(tmp_path), Settings(enabled=BOTH, rates_policy=policy), only=["ShopifyGiftCards"])
    got = read_current(spark, str(tmp_path / "ShopifyGiftCards")).filter("id = '1'").collect()
    assert sorted(r["fx_rate"] for r in got) == rates


def test_failing_rates_skip_their_dependants(spark, tmp_path):
    source = MappingSource(spark, {"Acme_us_shopify_1_gift_cards": gift_cards(spark),
                                   "a_exchange_rates": rates_table(spark, (2.0, 1)), "b_exchange_rates": rates_table(spark, (3.0, 2))})
    with pytest.raises(RunFailed, match="DuplicateRates"):
        run_all(spark, source, str(tmp_path), Settings(enabled=BOTH, rates_policy="fail"), only=["ShopifyGiftCards"])
    audit = {r.dataset: r.status for r in spark.read.parquet(f"{tmp_path}/_run_audit").collect()}
    assert "skipped" in audit["ShopifyGiftCards"] and "DuplicateRates" in audit["ExchangeRates"]
    with pytest.raises(ValueError):
        Settings(rates_policy="first")


def test_pattern_override_and_lookback(spark, tmp_path):
    old = spark.createDataFrame([(1, NOW, NOW, "C1", "u", 100, 0)], LOC)
    late = spark.createDataFrame([(1, NOW, NOW, "C1", "u", 100, 0), (2, NOW, NOW, "C1", "u", 60, 0)], LOC)
    settings = Settings(patterns={"ShopifyLocations": ("%places", "%old%")})
    for tables in ({"acme_places": old, "acme_old_places": late}, {"acme_places": late}):
        run_all(spark, MappingSource(spark, tables), str(tmp_path), settings, only=["ShopifyLocations"])
    base = str(tmp_path / "ShopifyLocations")
    assert {r["id"] for r in read_current(spark, base).collect()} == {1}  # the late batch lies before the watermark
    run_all(spark, MappingSource(spark, {"acme_places": late}), str(tmp_path),
            settings.with_(lookback_ms={"ShopifyLocations": 50}), only=["ShopifyLocations"])
    assert {r["id"] for r in read_current(spark, base).collect()} == {1, 2}


def test_order_parents_are_staged_once_and_scratch_is_removed(spark, tmp_path):
    from rawfold.plans import runner
    raw = dt.nested_orders(spark, SF_SMALL)
    source = MappingSource(spark, {"Acme_us_shopify_1_orders": raw}, database="lake", schema="raw")
    rates = dt.raw_rates(spark, SF_SMALL).drop("k")
    calls, real = [], runner.parents
    scratch, made = runner.scratch_path, []
    try:
        runner.parents = lambda *a, **k: calls.append(1) or real(*a, **k)
        runner.scratch_path = lambda s, n: made.append(scratch(s, n)) or made[-1]
        run_all(spark, source, str(tmp_path), only=["ShopifyOrders", "ShopifyOrdersLineItems"],
                shared=MappingSource(spark, {"x_exchange_rates": rates}))
    finally:
        runner.parents, runner.scratch_path = real, scratch
    assert len(calls) == 1 and made
    import os
    assert not any(os.path.exists(p.removeprefix("file:")) for p in made)
    want = build(BY_NAME["ShopifyOrdersLineItems"], [("`lake`.`raw`.`Acme_us_shopify_1_orders`", raw)], Settings(),
                 fx=read_current(spark, str(tmp_path / "ExchangeRates")).select(
                     "date", "from_currency_code", "to_currency_code", "value"), include_audit=False)
    got = read_current(spark, str(tmp_path / "ShopifyOrdersLineItems")).drop(*DROP)
    cols = sorted(want.columns)
    assert got.select(cols).exceptAll(want.select(cols)).isEmpty() and want.select(cols).exceptAll(got.select(cols)).isEmpty()


def test_empty_rates_are_missing_rates(spark, tmp_path):
    source = MappingSource(spark, {"Acme_us_shopify_1_gift_cards": gift_cards(spark), "a_exchange_rates": rates_table(spark)})
    with pytest.raises(RunFailed, match="ShopifyGiftCards: MissingRates"):
        run_all(spark, source, str(tmp_path), Settings(enabled=BOTH), only=["ShopifyGiftCards"])


def test_failing_rows_of_this_run_and_the_one_before_are_stored(spark, tmp_path):
    """Two relations hold a rate key: with "keep" it fails the uniqueness check; the next run's rows come beside the last one's."""
    settings = Settings(enabled=BOTH, rates_policy="keep")
    for newest in (2, 3):
        source = MappingSource(spark, {"a_exchange_rates": rates_table(spark, (2.0, 1)), "b_exchange_rates": rates_table(spark, (3.0, newest))})
        audit = run_all(spark, source, str(tmp_path), settings, only=["ExchangeRates"]).collect()
        assert [r.status for r in audit] == ["checks_failed:unique_keys=1"]
    stored = spark.read.parquet(f"{tmp_path}/_failures/ExchangeRates/unique_keys").collect()
    assert len(stored) == 2 and len({r["version"] for r in stored}) == 2 and {r["n_records"] for r in stored} == {2}


def test_full_refresh_drops_what_the_raw_tables_no_longer_hold(spark, tmp_path):
    loc = lambda *ids: {"Acme_us_shopify_1_locations": spark.createDataFrame([(i, NOW, NOW, "C1", "u", 100, 0) for i in ids], LOC)}
    ids = lambda: {r["id"] for r in read_current(spark, f"{tmp_path}/ShopifyLocations").collect()}
    run_all(spark, MappingSource(spark, loc(1, 2)), str(tmp_path), only=["ShopifyLocations"])
    run_all(spark, MappingSource(spark, loc(2, 3)), str(tmp_path), only=["ShopifyLocations"])
    assert ids() == {1, 2, 3}
    run_all(spark, MappingSource(spark, loc(2, 3)), str(tmp_path), Settings(full_refresh=True), only=["ShopifyLocations"])
    assert ids() == {2, 3}


@pytest.mark.parametrize("days,status", [(400, "success"), (3, "checks_failed:recency=1")])
def test_recency_is_checked_in_the_run(spark, tmp_path, days, status):
    loc = spark.createDataFrame([(1, NOW, NOW, "C1", "u", 100, 0)], LOC)
    settings = Settings(recency={"ShopifyLocations": ("updated_at", days, ("brand",))}, as_of=dtm.datetime(2024, 5, 1))
    audit = run_all(spark, MappingSource(spark, {"Acme_us_shopify_1_locations": loc}), str(tmp_path), settings, only=["ShopifyLocations"])
    assert [r.status for r in audit.collect()] == [status]


def test_staged_parents_are_removed_when_a_run_is_interrupted(spark, tmp_path, monkeypatch):
    from rawfold.plans import runner
    cleaned = []
    monkeypatch.setattr(runner._Staging, "clean", lambda self: cleaned.append(1))
    monkeypatch.setattr(runner, "run_checks", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    loc = spark.createDataFrame([(1, NOW, NOW, "C1", "u", 100, 0)], LOC)
    with pytest.raises(KeyboardInterrupt):
        run_all(spark, MappingSource(spark, {"Acme_us_shopify_1_locations": loc}), str(tmp_path), only=["ShopifyLocations"])
    assert cleaned
