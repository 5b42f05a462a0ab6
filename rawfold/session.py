"""Session helpers: the configuration the staging jobs assume, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the engine relies on. Raw timestamps are UTC instants, so the session time zone is UTC;
# AQE re-plans joins at runtime (size-checked broadcast, skew splitting, partition coalescing). It merges partitions but never
# adds any, and unnesting makes rows many times their shuffled bytes: shuffles begin with many partitions, merged up to 8 MB.
# For so many partitions a task holds, in memory, all rows it shuffles, some ten times their bytes on disk: files are read in small splits,
# so that it need not spill them.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "600",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.caseSensitive": "false",
}


def build_session(master: str | None = None, app: str = "rawfold", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with the engine's settings.

    ``master`` None leaves it to ``spark-submit`` or the defaults, and shuffle partitions stay the session's own
    (AQE merges partitions but never adds any) unless given; a local master defaults to 8 of them.
    """
    b = (SparkSession.builder.appName(app)
         .config("spark.ui.enabled", "false")
         # checkpoints are removed once no plan references them
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if master:
        b = b.master(master)
        if shuffle_partitions is None and master.startswith("local"):
            shuffle_partitions = 8
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**ENGINE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_engine_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the engine needs to an existing session."""
    for k, v in ENGINE_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Only a local master may leave it unset (tests): a folder of our own is chosen then. On a
    cluster a machine's temporary folder would not be seen by the others, so that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir is not set: master {master} needs a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="rawfold-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder (never a machine-local temp dir on a cluster)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of every query that ends inside, instead of when the driver's garbage happens to be collected.
    For queries whose result is written: nothing reads their shuffles again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, was)
