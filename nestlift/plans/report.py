"""Row and column counts of produced tables, and a summary of stored silver tables."""

from __future__ import annotations

from functools import reduce
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table, rows, cols)`` for every frame, computed as ONE union job.

    Each count is an ungrouped aggregate (partial count per task, one row
    per table after the shuffle), not one driver action per table.
    """
    parts = [df.groupBy().agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("cols"))
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def summary(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """``(table, rows, cols, schema)`` of stored tables (path or catalog name)."""
    frames = {}
    for name, where in paths.items():
        frames[name] = spark.table(where) if "/" not in where else spark.read.parquet(where)
    counts = table_counts(frames)
    schemas = spark.createDataFrame([(n, df.schema.simpleString()) for n, df in frames.items()],
                                    "table STRING, schema STRING")
    return counts.join(schemas, "table")


def preview(spark: SparkSession, paths: Mapping[str, str], n: int = 10) -> DataFrame:
    """``(table, row)``: up to ``n`` rows of each stored table as JSON text (the sample view).

    The limit is the feature here (a preview); each table contributes at most
    ``n`` rows, so the result stays small whatever the table sizes.
    """
    parts = []
    for name, where in paths.items():
        df = spark.table(where) if "/" not in where else spark.read.parquet(where)
        parts.append(df.limit(n).select(F.lit(name).alias("table"),
                                         F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
                                         .alias("row")))
    return reduce(DataFrame.unionByName, parts)
