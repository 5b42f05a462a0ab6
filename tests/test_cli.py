from pyspark.sql import functions as F

from rawfold.__main__ import main
from rawfold.sources import driver_tables as dt
from rawfold.sources.incremental import read_current

from paths import SF_SMALL


def test_cli_builds_enabled_datasets(spark, tmp_path, capsys):
    v = dt.flat_versions(spark, SF_SMALL)
    v.filter(F.col("arm") == 0).drop("arm").write.parquet(str(tmp_path / "loc"))
    dt.raw_rates(spark, SF_SMALL).drop("k").write.parquet(str(tmp_path / "fx"))
    main(["--out", str(tmp_path / "out"), "--table", f"Acme_us_shopify_1_locations={tmp_path / 'loc'}",
          "--table", f"daton_exchange_rates={tmp_path / 'fx'}", "--disable", "ShopifyInventoryItems"])
    out = capsys.readouterr().out
    assert "ShopifyLocations" in out and "ExchangeRates" in out
    assert read_current(spark, str(tmp_path / "out" / "ShopifyLocations")).count() > 0
