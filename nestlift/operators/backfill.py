"""Backfill selection: which bronze rows and which tables to rebuild.

``load_window`` keeps bronze rows whose *load* time lies in ``[start, end]``,
both ends inclusive, with typed bounds, so the predicate reaches the Parquet
scan; when bronze is partitioned by ``load_date`` the matching date range
also prunes whole directories. A bronze frame without the load-time column
is returned unfiltered.

``latest_by`` keeps, of records loaded more than once, the last row.
"""

from __future__ import annotations

from datetime import datetime

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import quote
from ..session import PARQUET_CODEC, scratch_path
from ..sources.bronze import PARTITION
from ..spec import parse_instant, ts_lit

LOAD_COLUMN = "load_timestamp"
# Fixed value: keys that came several times, up to which they are broadcast.
FEW_KEYS = 100_000


def _ts(v: datetime | str) -> datetime:
    return parse_instant(v) if isinstance(v, str) else v


def load_window(bronze: DataFrame, start: datetime | str, end: datetime | str,
                column: str = LOAD_COLUMN) -> DataFrame:
    if column not in bronze.columns:
        return bronze.drop(PARTITION) if PARTITION in bronze.columns else bronze
    s, e = _ts(start), _ts(end)
    c = F.col(column)
    if bronze.schema[column].dataType.typeName() == "timestamp_ntz":
        cond = c.between(F.lit(s.isoformat(sep=" ")).cast("timestamp_ntz"),
                         F.lit(e.isoformat(sep=" ")).cast("timestamp_ntz"))
    else:
        cond = c.between(ts_lit(s), ts_lit(e))
    if PARTITION in bronze.columns:
        cond = cond & F.col(PARTITION).between(F.lit(s.date()), F.lit(e.date()))
        return bronze.filter(cond).drop(PARTITION)
    return bronze.filter(cond)


def latest_by(bronze: DataFrame, keys: list[str] | tuple[str, ...], column: str = "raw_json",
              load: str = LOAD_COLUMN, source: str = "source_file", scratch: str | None = None) -> DataFrame:
    """Of each record key the last bronze row, one only.

    Last in total order: by load time, then source (a file, or the window, page and
    position of a record from landed pages), then text, so copies of a key within
    one load resolve too, the same way on every run. Rows without the key (or
    malformed) and rows of frames without a load time pass unchanged.

    Keys are counted with their last place, a partial (map-side) aggregate, and those that
    came several times are written to ``scratch`` (the caller's to delete), so their number is
    known. Without any, the rows pass as they are; a few are broadcast, so that rows of the other
    keys stay where they are; more are joined to the rows in one shuffle, which settles ties too.
    """
    if load not in bronze.columns:
        return bronze
    shape = T.StructType([T.StructField(k, T.StringType()) for k in keys])
    names = [f"__nl_key{i}" for i in range(len(keys))]
    parsed = bronze.withColumn("__nl_keys", F.from_json(F.col(quote(column)), shape))
    rows = parsed.select("*", *[F.col("__nl_keys")[k].alias(n) for k, n in zip(keys, names)]).drop("__nl_keys")
    whole = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])
    order = [load, *([source] if source in bronze.columns else [])]
    place = F.struct(*[F.col(quote(c)).alias(f"o{i}") for i, c in enumerate(order)])
    keyed = rows.where(whole)
    counted = (keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("__nl_n"), F.max(place).alias("__nl_last"))
               .where("__nl_n > 1").drop("__nl_n"))
    spark = bronze.sparkSession
    scratch = scratch or scratch_path(spark, "several")
    counted.write.parquet(scratch, compression=PARQUET_CODEC)
    several = spark.read.schema(counted.schema).parquet(scratch)
    n = several.count()
    if not n:
        return bronze
    cols, last = [F.col(quote(c)) for c in bronze.columns], F.col("__nl_last")
    row = F.max_by(F.struct(*cols), F.col(quote(column))).alias("__nl_row")
    whole_rows = []
    if n <= FEW_KEYS:
        several = F.broadcast(several)
        whole_rows.append(keyed.join(several, names, "left_anti").select(*cols))
    kept = keyed.join(several, names, "inner" if whole_rows else "left").where(last.isNull() | place.eqNullSafe(last))
    whole_rows += [kept.groupBy(*names).agg(row).select("__nl_row.*"), rows.where(~whole).select(*cols)]
    return reduce(DataFrame.unionByName, whole_rows)
