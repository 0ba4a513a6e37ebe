"""Helpers shared by the corpus operators: staging on shared storage, words, samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestlift.session import delete_path, scratch_path

# a word is a run of characters other than space and the control characters tab..carriage return
WORD = r"[^\x20\x09-\x0D]+"


_STAGED: list[str] = []


def stage(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts lineage (a lost executor does not repeat the work above it), gives the
    planner the real size for its broadcast decision, and keeps values that a
    re-run could order differently (ranks) fixed. The files stay until the
    surrounding ``scratch`` ends, or for the caller to clean up.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{kind}")
    df.write.parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what was staged inside, once its results are written elsewhere."""
    mark = len(_STAGED)
    try:
        yield
    finally:
        for path in _STAGED[mark:]:
            delete_path(spark, path)
        del _STAGED[mark:]


def each(column: pa.Array) -> Iterator:
    """The values of a column one by one: long texts are not all held as Python strings at once."""
    return (x.as_py() for x in column)


_CACHE: dict[object, object] = {}


def worker_cache(key: object, make: Callable[[], object]) -> object:
    """What a Python worker keeps between batches: one operator's caches at a time.

    Workers outlive stages, so without this each stage of a pipeline would add its
    caches, and the memory that Arrow keeps of its batches, to those of the stages before.
    """
    if key not in _CACHE:
        _CACHE.clear()
        pa.default_memory_pool().release_unused()
        _CACHE[key] = make()
    return _CACHE[key]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text (0 for NULL)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(id_col: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n``: the train / held-out split."""
    return F.crc32(id_col.cast("string").cast("binary")) % n


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column,
                    per_class: int, max_chars: int, seed: int = 7) -> DataFrame:
    """At most ``per_class`` labelled training documents of each class.

    The ids are the first by seeded hash among the labelled ones (a top-k, not a
    sort of everything), so the sample does not depend on partitioning. Its size
    is bounded by ``2 * per_class`` rows of ``max_chars`` characters; only ids
    are broadcast, and of an id with several texts the one of least hash is used
    (chosen in each task first). NULL ids and labels other than 0 and 1 are left out; a
    document labelled twice is used with its first label by value.
    """
    spread = F.xxhash64(F.lit(seed), F.col("doc_id"))
    base = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("y"))
            .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & train))
    ids = None
    for y in (0, 1):
        part = base.where(F.col("y") == y).dropDuplicates().orderBy(spread, "doc_id").limit(per_class)
        ids = part if ids is None else ids.unionByName(part)
    ids = ids.groupBy("doc_id").agg(F.min("y").alias("y"))
    small = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(
        F.col("text").isNotNull() & (F.length("text") <= max_chars))
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "text", "y")).alias("row")
    return small.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(least).select("doc_id", "row.text", "row.y")
