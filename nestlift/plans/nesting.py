"""Nested JSON records built from the flat test tables, in Spark.

The engine's input is nested records (one JSON object per line). The test
data is flat, so every query first nests flat rows into records, then runs
the operator under test; the oracle reads the flat tables, so nesting and
unnesting must give the flat rows back.

A parent is one record, whatever the number of its children: a JSON record is
one value, so its size is the fixture's, not something to cut by row counts.

Child rows are dealt out by key once and packed where they arrive. Packing them in
the scan first would sort every scan task's rows (an object aggregate falls back
to sorting), which spills once a split holds millions of them, and saves no byte:
a packed row is as long as its elements. What follows from a row's own columns
(prices) is worked out behind that shuffle, while packing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import to_json_text
from ..session import more_tasks


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Fixed value: flat child rows that one task packs. With more rows than the session's
# shuffle partitions hold at that size, tasks multiply instead of growing (and spilling).
ROWS_PER_TASK = 250_000


def pack_tasks(rows: DataFrame) -> int | None:
    """Tasks that packing these rows takes, or None if the session's shuffle partitions are enough."""
    return more_tasks(rows.sparkSession, rows.count(), ROWS_PER_TASK)


def nest(parent: DataFrame, child: DataFrame, keys: list[str], field: str,
         elements: list[Column] | None = None, scalar: Column | None = None, tasks: int | None = None) -> DataFrame:
    """Parent rows plus ``field``: the matching child rows as an array.

    Elements are ``struct(*elements)`` (default: all non-key child columns),
    or the single ``scalar`` expression. Parents without children keep a
    NULL ``field`` (dropped from JSON text, i.e. the key is absent). Children with
    a NULL key have no parent. ``tasks`` as ``pack_tasks`` of the flat rows says.
    """
    elems = elements or [F.col(c) for c in child.columns if c not in keys]
    value = scalar if scalar is not None else F.struct(*elems)
    dealt = child.dropna(subset=keys).repartition(*([tasks] if tasks else []), *keys)
    packed = dealt.groupBy(*keys).agg(F.collect_list(value).alias(field))
    return parent.join(packed, keys, "left").select(*[F.col(f"`{c}`") for c in parent.columns], F.col(field))


def as_records(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One JSON text per row, as bronze ``raw_json``; columns to ``keep`` stay beside it, not in it."""
    return df.select(to_json_text(F.struct(*[F.col(c) for c in df.columns if c not in keep])).alias("raw_json"), *keep)


# ----------------------------------------------------------------- FX-O
LINE_FIELDS = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
ORDER_FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                "o_orderpriority"]


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with ``lines`` (array of line structs) and ``partkeys`` (array of BIGINT)."""
    orders = table(spark, sf_dir, "orders").select(*ORDER_FIELDS)
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), *LINE_FIELDS)
    with_lines = nest(orders, lines, ["o_orderkey"], "lines",
                      elements=[F.col(c) for c in LINE_FIELDS], tasks=pack_tasks(lines))
    return with_lines.withColumn("partkeys", F.transform("lines", lambda x: x["l_partkey"]))


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX-O: order + lines[] records."""
    return as_records(order_rows(spark, sf_dir))


# ----------------------------------------------------------------- FX-C / FX-N
def line_prices() -> Column:
    """A line's prices, from its own columns: listed, after discount, after tax."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    steps = (F.col("l_extendedprice"), net, net * (1 + F.col("l_tax")))
    return F.array(*[F.struct(F.lit(i).alias("step"), F.col("l_returnflag").alias("flag"), c.alias("price"))
                     for i, c in enumerate(steps)])


def customer_rows(spark: SparkSession, sf_dir: str, prices: bool = True) -> DataFrame:
    """Customer + ``orders[]`` + ``lines[]`` (+ ``prices[]`` per line).

    ``prices`` is a fixed array built from one line's own columns (no
    grouping), making the path orders -> lines -> prices three levels deep.
    """
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                  "c_acctbal", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select(*ORDER_FIELDS)
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), *LINE_FIELDS)
    line_elems = [F.col(c) for c in LINE_FIELDS]
    if prices:
        line_elems.append(line_prices().alias("prices"))
    tasks = pack_tasks(li)
    orders_nested = nest(orders, li, ["o_orderkey"], "lines", elements=line_elems, tasks=tasks)
    o = orders_nested.withColumnRenamed("o_custkey", "c_custkey")
    order_elems = [F.col(c) for c in o.columns if c != "c_custkey"]
    return nest(cust, o, ["c_custkey"], "orders", elements=order_elems, tasks=tasks)


def customer_records(spark: SparkSession, sf_dir: str, prices: bool = True) -> DataFrame:
    return as_records(customer_rows(spark, sf_dir, prices))


# ----------------------------------------------------------------- FX-V
def conversation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX-V: one record per conversation with ``turns[]`` of (turn, role, text)."""
    conv = table(spark, sf_dir, "conversations")
    ids = conv.select("conv_id").distinct()
    return as_records(nest(ids, conv, ["conv_id"], "turns",
                           elements=[F.col("turn"), F.col("role"), F.col("text")]))


# ----------------------------------------------------------------- FX-E
def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX-E: one record per event; ``props`` stays a JSON *string* field."""
    ev = table(spark, sf_dir, "events")
    return as_records(ev.select("event_id", "ts", "user_id", "event_type", "value", "props"))


# ----------------------------------------------------------------- envelopes
def event_envelopes(spark: SparkSession, sf_dir: str, start: str, end: str, days: int,
                    page_size: int, data_key: str = "events",
                    pages_key: str = "totalHits") -> DataFrame:
    """Events in ``[start, end]`` landed as paged responses.

    ``(window_start, page, body)`` with body ``{"totalHits": n, "<data_key>": [...]}``.
    Window ``w`` has ``n_w`` events and ``ceil(n_w / page_size)`` pages; event
    ``e`` sits on page ``1 + e.event_id mod pages(w)``, so pages hold about
    ``page_size`` records each however large the window.
    """
    from ..sources.landing import _bounds, date_windows, window_index
    from ..spec import ts_lit

    s, e = _bounds(start, end)
    ev = table(spark, sf_dir, "events")
    ev = ev.filter(F.col("ts").cast("timestamp").between(ts_lit(s), ts_lit(e)))
    ev = ev.withColumn("window", window_index(F.col("ts"), s, days))
    wc = ev.groupBy("window").agg(F.count(F.lit(1)).alias("__nl_hits"))
    wins = date_windows(spark, s, e, days).join(wc, "window")
    npages = F.greatest(F.ceil(F.col("__nl_hits") / F.lit(page_size)), F.lit(1))
    rec = F.struct("event_id", "ts", "user_id", "event_type", "value", "props")
    paged = (ev.join(wins, "window")
             .withColumn("page", (F.pmod(F.col("event_id"), npages) + 1).cast("int"))
             .groupBy("window_start", "page")
             .agg(F.max("__nl_hits").alias(pages_key), F.collect_list(rec).alias(data_key)))
    return paged.select("window_start", "page",
                        to_json_text(F.struct(pages_key, data_key)).alias("body"))
