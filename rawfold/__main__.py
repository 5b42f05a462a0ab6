"""Command line: build every enabled staging dataset.

    python -m rawfold --out s3://bucket/staging --catalog-schema raw
    python -m rawfold --out /data/staging --table Acme_us_shopify_1_orders=/raw/acme_orders \\
        --table daton_exchange_rates=/raw/rates --only ShopifyOrders --enable ShopifyPayouts
"""

from __future__ import annotations

import argparse

from rawfold.config import RATES_POLICIES, Settings
from rawfold.plans.runner import run_all
from rawfold.session import build_session
from rawfold.sources.relations import CatalogSource, MappingSource


def _pairs(items: list[str]) -> dict[str, str]:
    return dict(x.split("=", 1) for x in items)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="rawfold", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    p.add_argument("--out", required=True, help="staging root (one versioned folder per dataset)")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--catalog-schema", help="raw tables registered in this catalog schema")
    src.add_argument("--table", action="append", default=[], help="raw table as name=parquet_path (repeatable)")
    p.add_argument("--only", action="append", help="dataset name to build (repeatable; rates always run)")
    p.add_argument("--enable", action="append", default=[], help="switch a dataset on (repeatable)")
    p.add_argument("--disable", action="append", default=[], help="switch a dataset off (repeatable)")
    p.add_argument("--full-refresh", action="store_true")
    p.add_argument("--to-timezone", default=Settings().to_timezone)
    p.add_argument("--no-timezone-conversion", action="store_true")
    p.add_argument("--no-currency-conversion", action="store_true")
    p.add_argument("--scope-by-source", action="store_true")
    p.add_argument("--master", default=None, help="Spark master (default: the one of spark-submit or the session)")
    p.add_argument("--shared-schema", help="catalog schema of the exchange rates (default: that of the raw tables)")
    p.add_argument("--shared-table", action="append", default=[], help="exchange-rate table as name=parquet_path (repeatable)")
    p.add_argument("--pattern", action="append", default=[], help="dataset=pattern[,exclude pattern] (repeatable)")
    p.add_argument("--lookback-ms", action="append", default=[], help="dataset=milliseconds (repeatable)")
    p.add_argument("--partition-by", action="append", default=[], help="dataset=column (repeatable)")
    p.add_argument("--rates-policy", choices=RATES_POLICIES, default="newest")
    a = p.parse_args(argv)

    spark = build_session(a.master)
    enabled = {**{n: True for n in a.enable}, **{n: False for n in a.disable}}
    settings = Settings(to_timezone=a.to_timezone, timezone_conversion=not a.no_timezone_conversion,
                        currency_conversion=not a.no_currency_conversion, enabled=enabled,
                        full_refresh=a.full_refresh, scope_by_source=a.scope_by_source, rates_policy=a.rates_policy,
                        patterns={k: tuple((v + ",").split(",")[:2]) for k, v in _pairs(a.pattern).items()},
                        lookback_ms={k: int(v) for k, v in _pairs(a.lookback_ms).items()},
                        partition_by=_pairs(a.partition_by))
    if a.catalog_schema:
        source = CatalogSource(spark, a.catalog_schema)
    else:
        source = MappingSource(spark, _pairs(a.table))
    shared = None
    if a.shared_schema:
        shared = CatalogSource(spark, a.shared_schema)
    elif a.shared_table:
        shared = MappingSource(spark, _pairs(a.shared_table))
    run_all(spark, source, a.out, settings, only=a.only, shared=shared).show(100, truncate=False)


if __name__ == "__main__":
    main()
