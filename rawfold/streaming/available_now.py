"""Run a dataset spec over a growing raw folder with Structured Streaming.

The source has no streaming operators; its incremental load is a batch high-watermark. Here the
file source's own checkpoint tracks which raw files were read, and every micro-batch is staged and
merged into the target with the same rank rules as the batch code (``foreachBatch``), so files in any
order and any number a trigger give the rows of one build over all of them. ``Trigger.AvailableNow`` processes what is
there and stops, like a scheduled run. A manifest names the micro-batch that made it, so one that is replayed after a crash
is not merged twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rawfold.config import Settings
from rawfold.plans.builder import build
from rawfold.plans.runner import merge_into
from rawfold.plans.spec import DatasetSpec
from rawfold.session import pin_engine_conf, scratch_path
from rawfold.sources.versions import _delete, read_manifest


def stage_stream(spark: SparkSession, spec: DatasetSpec, raw_path: str, relation: str, target: str,
                 settings: Settings | None = None, *, fx: DataFrame | None = None,
                 checkpoint: str | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Stage new parquet files of one raw relation into ``target`` (versioned), micro-batch by micro-batch.

    ``checkpoint`` is where the stream remembers what it has read (default: beside the target, so that a later run
    resumes)."""
    settings = settings or Settings()
    pin_engine_conf(spark)
    schema = spark.read.parquet(raw_path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(raw_path)

    def stage(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        done = read_manifest(session, target)
        if done is not None and done.epoch is not None and done.epoch >= epoch:
            return
        updates = build(spec, [(relation, batch)], settings, fx=fx, carry_rank=True, seq_strategy="later")
        path = scratch_path(session, f"stream-{spec.name}")
        try:
            updates.write.parquet(path)
            merge_into(session, spec, target, session.read.parquet(path), settings, reread=False, epoch=epoch)
        finally:
            _delete(session, [path])

    ckpt = checkpoint or f"{target.rstrip('/')}/_stream"
    return (stream.writeStream.foreachBatch(stage).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())
