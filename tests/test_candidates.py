"""Keys meet the files that may hold them: those of their part alone where it is known."""

from pyspark.sql import functions as F

from rawfold.sources.versions import _in_range

KEYS = "__rk string, __kp string"
FILES = "__att string, p string, file string, lo string, hi string, blocks long"


def test_keys_meet_the_files_of_their_part(spark):
    keys = spark.createDataFrame([("a", "0"), ("m", "1"), ("z", "2"), ("m", None), (None, "0"), ("m", "9"), ("c", None)], KEYS)
    files = spark.createDataFrame([("x", "0", "f0", "a", "c", 1), ("x", "0", "f1", "b", "m", 1), ("x", "1", "f2", "m", "m", 1),
                                   ("y", "1", "f3", "n", "z", 1), ("y", "2", "f4", None, None, 1)], FILES)
    found = sorted(tuple(r) for r in _in_range(keys, files).select(F.coalesce("__rk", F.lit("")), F.coalesce("__kp", F.lit("any")), "file").collect())
    assert found == [("a", "0", "f0"), ("c", "any", "f0"), ("c", "any", "f1"), ("m", "1", "f2"), ("m", "any", "f1"), ("m", "any", "f2")]


def test_keys_of_a_known_part_are_not_paired_with_all_files(spark):
    keys = spark.range(1000).select(F.col("id").cast("string").alias("__rk"), (F.col("id") % 4).cast("string").alias("__kp"))
    files = spark.createDataFrame([("x", str(i % 4), f"f{i}", "0", "9", 1) for i in range(8)], FILES)
    plan = _in_range(keys.filter(F.col("__kp").isNotNull()), files)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan
