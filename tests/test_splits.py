"""A task that reads holds the rows it shuffles: splits are small, however large a file is."""

from pyspark.sql import functions as F

from rawfold.session import pin_engine_conf


def test_files_are_read_in_small_splits(spark, tmp_path):
    path = str(tmp_path / "one")
    rows = spark.range(0, 3_000_000, 1, 1).select("id", F.xxhash64("id").alias("a"), F.xxhash64("a").alias("b"))
    rows.write.option("parquet.block.size", 4 << 20).parquet(path)
    key = "spark.sql.files.maxPartitionBytes"
    was = spark.conf.get(key)
    try:
        spark.conf.set(key, "1g")
        spark.conf.set("spark.sql.files.openCostInBytes", "1g")  # as on a machine of few cores and large files
        assert spark.read.parquet(path).rdd.getNumPartitions() == 1
        pin_engine_conf(spark)
        assert spark.read.parquet(path).rdd.getNumPartitions() >= 3
    finally:
        spark.conf.set(key, was)
        spark.conf.unset("spark.sql.files.openCostInBytes")
