"""Incremental runs as a Structured Streaming query over the landing folder.

New JSONL files under ``landing_dir`` are picked up by the file source
(``readStream.format("text")``); each micro-batch is one run:

1. bronze rows get ONE load time for the whole batch, ``current_timestamp()``
   in the streaming plan, which Structured Streaming pins to the batch
   timestamp kept in its offset log (the same value when a batch is
   replayed), and the file each line came from (``_metadata.file_path``);
2. they are written to bronze under their own ``load_date/load_batch``
   partition, named by stream and epoch, with dynamic partition overwrite, so a
   replayed batch replaces its rows rather than adding them again (exactly-once
   bronze), and streams that share a bronze location (or one that started again
   from a new checkpoint) leave each other's rows alone;
3. silver tables are built from the batch (one parse, persisted for the
   fan-out); bad records go to ``<bronze>_quarantine`` under the same batch,
   the rest is upserted into catalog tables by key (idempotent for unique
   keys when a batch is replayed).

The streaming checkpoint records which files were consumed, so a restarted
query continues where it stopped. ``trigger(availableNow=True)`` processes
what has landed and stops, which is how a scheduled run uses it.
"""

from __future__ import annotations

from typing import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.run import upsert_all_tables
from ..plans.silver import silver_tables
from ..sources.bronze import BATCH, append_bronze, batch_id
from ..spec import JobSpec


def batch_runner(spec: JobSpec, bronze_target: str, only: str | None = None,
                 partition_by: Mapping[str, list[str]] | None = None, stream: str | None = None):
    """The per-micro-batch run; ``batch`` holds bronze columns already.

    ``stream`` names the stream that writes. The default is the id of the query,
    which its checkpoint keeps over restarts.
    """
    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        name = stream or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
        own = batch_id(None, name, epoch_id)
        rows = batch.persist(StorageLevel.MEMORY_AND_DISK)   # read the new files once
        try:
            append_bronze(rows, bronze_target, batch=own)
            res = silver_tables(rows.select("raw_json"), spec, only=only, reuse="persist", quarantine=True)
            try:
                (res.quarantine.withColumn(BATCH, F.lit(own)).write.mode("overwrite")
                 .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(f"{bronze_target}_quarantine"))
                upsert_all_tables(spark, spec, res.tables, partition_by=partition_by)
            finally:
                res.release()
        finally:
            rows.unpersist()
    return run


def stream_landing(spark: SparkSession, spec: JobSpec, landing_dir: str, bronze_target: str,
                   checkpoint: str, only: str | None = None, available_now: bool = True,
                   max_files_per_trigger: int | None = None,
                   partition_by: Mapping[str, list[str]] | None = None) -> StreamingQuery:
    """Start the landing -> bronze -> silver stream; returns the running query.

    ``partition_by`` keeps chosen silver tables partitioned (by columns
    fixed per key, e.g. a record date), so each batch rewrites only the
    partitions it touches.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    bronze = reader.load(landing_dir).select(
        F.col("value").alias("raw_json"),
        F.current_timestamp().alias("load_timestamp"),   # the batch timestamp: stable on replay
        F.col("_metadata.file_path").alias("source_file"))
    w = (bronze.writeStream.foreachBatch(batch_runner(spec, bronze_target, only, partition_by))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
