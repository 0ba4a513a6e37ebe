"""Landing text and the bronze table.

Bronze is append-only with exactly three columns:
``raw_json STRING, load_timestamp TIMESTAMP, source_file STRING``.
``load_timestamp`` is one literal per run (not ``current_timestamp()``, which
a lazy frame would re-evaluate per action). Bronze is written partitioned by
``load_date`` so that a load-time backfill prunes whole directories.
"""

from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import PARQUET_CODEC, TEXT_LEVEL
from ..spec import parse_instant, ts_lit

BRONZE_SCHEMA = T.StructType([
    T.StructField("raw_json", T.StringType()),
    T.StructField("load_timestamp", T.TimestampType()),
    T.StructField("source_file", T.StringType()),
])
PARTITION = "load_date"
# Fixed value: records in one landed text file.
LANDING_ROWS = 500_000


def write_landing(records: DataFrame, path: str, column: str = "raw_json", by: str | None = None) -> str:
    """Records -> JSONL text files at ``path`` (one record per line, gzip), overwriting that path.

    A gzip file is read by one task, so no file holds more than ``LANDING_ROWS`` records.
    With ``by``, a column of the records, those of each of its values are a landing of
    their own, at ``path/by=value``, all written in one pass.
    """
    w = records.select(F.col(column).alias("value"), *([by] if by else [])).write.mode("overwrite")
    (w.partitionBy(*([by] if by else [])).option("compression", "gzip").option("maxRecordsPerFile", LANDING_ROWS).text(path))
    return path


def annotate(text: DataFrame, load_ts: datetime | str, source: str | Column | None = None,
             column: str = "value") -> DataFrame:
    """Text lines -> bronze rows with one literal load time.

    ``source`` is a name for all rows or a column; ``None`` records each line's own
    file (``input_file_name``).
    """
    ts = ts_lit(load_ts)
    src = F.input_file_name() if source is None else source if isinstance(source, Column) else F.lit(source)
    return text.select(F.col(column).alias("raw_json"),
                       ts.cast("timestamp").alias("load_timestamp"),
                       src.alias("source_file"))


def bronze_from_text(spark: SparkSession, path: str, load_ts: datetime | str,
                     source: str | None = None) -> DataFrame:
    """Read landed JSONL (one record per line) as bronze rows."""
    text = spark.read.text(path)
    return annotate(text, load_ts, path if source is None else source)


BATCH = "load_batch"


def batch_id(load_ts: datetime | str | None, source: str, epoch: int | None = None) -> str:
    """Who wrote a batch, and which of its batches it is.

    A run is named by its load time and the place it loads from, so the same run
    repeated has the same batch, and another landing loaded at the same time has
    one of its own. A micro-batch is named by its stream and epoch: a replay has the
    same batch, another stream (or the same one from a new checkpoint) does not.
    """
    parts = []
    if load_ts is not None:
        t = parse_instant(load_ts) if isinstance(load_ts, str) else load_ts
        parts.append(str(int((t.replace(tzinfo=None) - datetime(1970, 1, 1)).total_seconds() * 1_000_000)))
    parts.append(hashlib.sha256(source.rstrip("/").encode()).hexdigest()[:16])
    if epoch is not None:
        parts.append(str(epoch))
    return "-".join(parts)


def append_bronze(bronze: DataFrame, target: str, mode: str = "append", as_table: bool = False,
                  batch: str | None = None) -> None:
    """Append bronze rows, partitioned by load date, to a path or a catalog table.

    ``mode="overwrite"`` is the full-refresh variant. The three-column shape
    is enforced; no schema merging. With ``batch`` (see ``batch_id``) the rows go
    to their own ``load_date/load_batch`` partition, replaced with dynamic
    partition overwrite, so a replayed batch or a repeated run rewrites its rows
    instead of adding them twice, and no other writer's. Either every write to a location names its batch or
    none does (the partition depth differs); runs and streams do.
    """
    rows = bronze.select(*[F.col(f.name).cast(f.dataType) for f in BRONZE_SCHEMA.fields])
    rows = rows.withColumn(PARTITION, F.to_date("load_timestamp"))
    if batch is not None:
        rows = rows.withColumn(BATCH, F.lit(batch))
        w = (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(PARTITION, BATCH))
    else:
        w = rows.write.mode(mode).partitionBy(PARTITION)
    w = w.option("compression", PARQUET_CODEC).options(**TEXT_LEVEL)
    if as_table:
        w.saveAsTable(target)
    else:
        w.parquet(target)


def read_bronze(spark: SparkSession, target: str, as_table: bool = False, batch: str | None = None) -> DataFrame:
    """Bronze rows from a path or catalog table, or of one ``batch`` only (a partition filter).

    The ``load_date`` partition column is kept so that a load-time filter
    (``operators.backfill.load_window``) can prune directories.
    """
    rows = spark.table(target) if as_table else spark.read.parquet(target)
    return rows if batch is None else rows.where(F.col(BATCH) == batch)


def exists(spark: SparkSession, target: str, as_table: bool = False) -> bool:
    """Whether a bronze/silver target exists (catalog table or a readable path)."""
    if as_table:
        return spark.catalog.tableExists(target)
    try:
        spark.read.parquet(target).schema  # noqa: B018 - metadata only, no job
        return True
    except AnalysisException as e:      # only absence: a refused or broken path is an error
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def in_memory_bronze(records: DataFrame, load_ts: datetime | str, source: str) -> DataFrame:
    """Bronze rows straight from a records frame (no landing write)."""
    return annotate(records, load_ts, source, column="raw_json")
