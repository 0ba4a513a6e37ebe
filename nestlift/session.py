"""Session helpers: a local session for tests/bench, and the shared scratch folder.

Library code never creates a session; it takes the caller's. Scratch data
(landing files, staged parses, upsert versions) goes under the folder the
cluster names in ``spark.checkpoint.dir``. Only when that setting is unset (a
local test run) do we pick a folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | None = None, app: str = "nestlift",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A local[N] session configured the way tests and bench.py expect."""
    n = cores or int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="nestlift-local-")
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("NESTLIFT_DRIVER_MEMORY", "16g"))
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoint"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared scratch root (``spark.checkpoint.dir``).

    Read from the session. Only a ``local[...]`` session without the setting
    (tests) gets a folder under the system temp folder; on a cluster the
    setting is required, since a machine-local folder would not survive the
    loss of that machine.
    """
    conf = spark.sparkContext.getConf()
    local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
    d = conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises on some versions
            d = None
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not local:
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage (HDFS/S3/...): "
                               "scratch data must survive the loss of any single machine")
        d = tempfile.mkdtemp(prefix="nestlift-checkpoint-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh, never reused path under the shared scratch root."""
    return f"{shared_dir(spark)}/nestlift/{kind}/{uuid.uuid4().hex}"


def more_tasks(spark: SparkSession, rows: int, per_task: int) -> int | None:
    """Tasks that take ``per_task`` rows each, or None if the session's shuffle partitions are enough."""
    tasks = -(-rows // per_task)
    return tasks if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


# Codec of the Parquet files written here. Records repeat their field names and stored rows
# repeat from load to load, so what a run writes weighs more than the seconds it takes to pack it.
PARQUET_CODEC = "zstd"
# Fixed value: how hard zstd packs files that may hold JSON text (write option); it takes a tenth less space than at level 3.
TEXT_LEVEL = {"parquet.compression.codec.zstd.level": "9"}


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through the Hadoop file system it lives on."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def rename_path(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder a name that is not taken, on the same file system."""
    p, new = spark._jvm.org.apache.hadoop.fs.Path(path), spark._jvm.org.apache.hadoop.fs.Path(to)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(new):
        raise FileExistsError(f"{to} already exists")
    if not fs.rename(p, new):
        raise OSError(f"{path} could not be renamed to {to}")


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def make_path(spark: SparkSession, path: str) -> None:
    """Make a folder and those above it, if they are not there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def replace_path(spark: SparkSession, path: str, to: str) -> None:
    """Put a folder in the place of another (which need not be there), on the same file system."""
    delete_path(spark, to)
    make_path(spark, to.rpartition("/")[0])
    rename_path(spark, path, to)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file's content, or None if it is not there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small text file."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


MAX_SHUFFLE_PARTITIONS = 40_000


def cluster_conf(input_bytes: int, cores: int, partition_bytes: int = 256 << 20,
                 shuffled_share: float = 0.3) -> dict[str, str]:
    """Settings for a cluster run sized to the input.

    Scans split files at ``partition_bytes``. Shuffle partitions follow the
    bytes that are shuffled (``shuffled_share`` of the input: keys and pruned
    columns), about 1 GB each, at least 2 per core and at most
    ``MAX_SHUFFLE_PARTITIONS``: the driver keeps a map status per map task and
    partition, so beyond that partitions grow (and spill) rather than multiply.
    AQE coalesces small ones and splits skewed ones at run time.
    """
    shuffled = int(input_bytes * shuffled_share)
    parts = min(MAX_SHUFFLE_PARTITIONS, max(2 * cores, -(-shuffled // (1 << 30))))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": f"{partition_bytes // (1 << 20)}m",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{partition_bytes // (1 << 20)}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
