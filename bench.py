"""Benchmark the headline staging queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
(default 8). Each query is fully computed with the ``noop`` sink (every column, no collect), once
to warm up and then ``$BENCH_RUNS`` times (default 3); the median is reported. Prints one JSON line.

The raw tables that the queries read are derived from the given tables and written as parquet once, before the clock runs, so the
times are those of the queries. ``fixture`` holds the seconds of writing each; with ``BENCH_FIXTURES=derive`` the queries derive
them in their own plan, as in rounds 1 and 2, and ``fixture`` is the time of that alone.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "ShopifyOrders",                     # union + keep-latest (dense) + tz + FX join + lineage
    "ExchangeRates",                     # per-relation row_number dedup + UNION ALL
    "union_then_dedup",                  # union by name + keep-latest
    "latest_row_number",                 # keep-latest, one row per key
    "fx_left_join",                      # left join of daily rates with fan-out
    "ShopifyOrdersLineItems",            # nested orders: explode + keep-latest + FX
    "ShopifyOrdersLineItemsTaxLines",    # five-level explode chain + siblings + _seq_id
    "merge_upsert",                      # watermark + incremental load + merge by key
)

#: raw table -> the headline queries that derive it
FIXTURE_OF = {
    "order_versions": ("ShopifyOrders", "union_then_dedup", "latest_row_number", "fx_left_join", "merge_upsert"),
    "nested_orders": ("ShopifyOrdersLineItems", "ShopifyOrdersLineItemsTaxLines"),
    "raw_rates": ("ExchangeRates",),
}


def written(spark, driver_tables, name: str, sf_dir: str) -> float:
    """Write a raw table to the shared folder and let the queries read it from there; seconds that took."""
    from rawfold.session import scratch_path
    t0, path = time.perf_counter(), scratch_path(spark, f"bench-{name}")
    getattr(driver_tables, name)(spark, sf_dir).write.parquet(path)
    setattr(driver_tables, name, lambda spark, sf_dir: spark.read.parquet(path))
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    from rawfold.plans.registry import QUERIES
    from rawfold.sources import driver_tables
    from rawfold.session import build_session

    fixture_makers = {name: getattr(driver_tables, name) for name in FIXTURE_OF}
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", app="rawfold-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})

    def median_of(make) -> float:
        def once() -> float:
            t0 = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        once()
        return round(statistics.median(once() for _ in range(runs)), 3)

    derive = os.environ.get("BENCH_FIXTURES") == "derive"
    if derive:
        fixtures = {name: median_of(lambda make=make: make(spark, sf_dir)) for name, make in fixture_makers.items()}
    else:
        fixtures = {name: written(spark, driver_tables, name, sf_dir) for name in fixture_makers}
    times = {name: median_of(lambda name=name: QUERIES[name](spark, sf_dir)) for name in HEADLINE}
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "sum_median_query_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "runs": runs, "fixtures": "derived" if derive else "written", "fixture": fixtures,
                      "fixture_of": {q: f for f, qs in FIXTURE_OF.items() for q in qs}}))
    spark.stop()


if __name__ == "__main__":
    main()
