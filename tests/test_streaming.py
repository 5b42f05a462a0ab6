from pyspark.sql import functions as F

from rawfold.plans.specs import BY_NAME
from rawfold.sources import driver_tables as dt
from rawfold.sources.incremental import read_current
from rawfold.streaming import stage_stream

from paths import SF_SMALL


def test_available_now_stream_stages_and_merges(spark, tmp_path):
    raw = str(tmp_path / "raw")
    v = dt.order_versions(spark, SF_SMALL).drop("arm")
    first = v.filter(F.col("updated_at") < F.lit("1998-01-01").cast("timestamp_ntz"))
    first.write.parquet(raw)
    spec = BY_NAME["ShopifyLocations"]  # flat dataset with row keys; no rates needed
    q = stage_stream(spark, spec, raw, dt.ORDERS_A, str(tmp_path / "out"), checkpoint=str(tmp_path / "ck"))
    q.awaitTermination()
    n1 = read_current(spark, str(tmp_path / "out")).count()
    v.filter(F.col("updated_at") >= F.lit("1998-01-01").cast("timestamp_ntz")).write.mode("append").parquet(raw)
    q = stage_stream(spark, spec, raw, dt.ORDERS_A, str(tmp_path / "out"), checkpoint=str(tmp_path / "ck"))
    q.awaitTermination()
    out = read_current(spark, str(tmp_path / "out"))
    full = v.groupBy(F.coalesce("id", F.lit(0)).alias("k")).agg(F.max("_daton_batch_runtime").alias("m"))
    assert n1 > 0
    # after both runs every key holds only its newest batch
    got = out.groupBy(F.col("id").alias("k")).agg(F.max("_daton_batch_runtime").alias("m"),
                                                  F.min("_daton_batch_runtime").alias("lo"))
    assert got.filter(F.col("m") != F.col("lo")).count() == 0
    assert got.join(full, "k").filter(got["m"] != full["m"]).count() == 0
    assert got.count() == full.count()
