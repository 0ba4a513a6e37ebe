"""The query catalogue: one Spark query per operator, each with its SQL oracle.

Every query reads the flat test tables at ``sf_dir``, nests them into
records in Spark (``nesting``), runs the operator under test over *all*
rows, and returns a DataFrame. The matching SQL reads the flat tables
directly, so nesting + operator must give the flat answer back. Output
timestamps are ``TIMESTAMP_NTZ`` (wall clock), like the tables' own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import infer_schema, parse
from ..functions.types import shape_to_struct
from ..operators.backfill import load_window
from ..operators.enforce import drift, enforce, enforce_strings
from ..operators.upsert import MERGE_ROWS, Scope, conflicts, merge_frames, read_partitioned, upsert_partitioned, upsert_path
from ..session import PARQUET_CODEC, make_path, more_tasks, scratch_path
from ..sources import landing
from ..sources.bronze import append_bronze, bronze_from_text, in_memory_bronze, read_bronze, write_landing
from . import nesting, specs
from .report import preview, summary, table_counts
from .run import IncompleteLanding, backfill, ingest, ingest_pages, upsert_all
from .silver import silver_tables

LOAD_TS = "2024-02-01T00:00:00Z"
# The request range and paging of the events source.
EV_START, EV_END, EV_DAYS, EV_PAGE = "2024-01-01T00:00:00.000Z", "2024-01-30T23:59:59.999Z", 7, 100
# The upsert split. Target: before SPLIT_HI; source: from SPLIT_LO.
SPLIT_LO, SPLIT_HI = "1998-01-01", "1999-01-01"


def ntz(df: DataFrame) -> DataFrame:
    """Zoned TIMESTAMP columns -> TIMESTAMP_NTZ (same wall clock in the session zone)."""
    return df.select(*[F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


_FIXTURES = {
    "fx-o": nesting.order_records,
    "fx-n": nesting.customer_records,
    "fx-v": nesting.conversation_records,
    "fx-e": nesting.event_records,
}
_LANDED: dict[tuple[str, str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str, fixture: str) -> DataFrame:
    """Bronze holding one fixture's records for ``sf_dir``, landed once per application.

    Silver always starts from stored bronze, as in a real run: landing
    happens once, and every silver job (probes, parse, unnest) scans the
    stored Parquet instead of re-running the nesting shuffles.
    """
    key = (spark.sparkContext.applicationId, sf_dir, fixture)
    path = _LANDED.get(key)
    if path is None:
        path = scratch_path(spark, "bronze")
        append_bronze(in_memory_bronze(_FIXTURES[fixture](spark, sf_dir), LOAD_TS, fixture), path)
        _LANDED[key] = path
    return read_bronze(spark, path)


def _orders_silver(spark, sf_dir, only=None, reuse=None):
    return silver_tables(landed(spark, sf_dir, "fx-o"), specs.spec(specs.ORDERS),
                         only=only, reuse=reuse)


def _customers_silver(spark, sf_dir, only=None, reuse=None):
    return silver_tables(landed(spark, sf_dir, "fx-n"), specs.spec(specs.CUSTOMERS),
                         only=only, reuse=reuse)


def _orders_parsed(spark, sf_dir) -> DataFrame:
    sp = specs.spec(specs.ORDERS)
    return parse(landed(spark, sf_dir, "fx-o"), shape_to_struct(sp.full_schema))


def _main_cols(df: DataFrame) -> DataFrame:
    return ntz(df.select(*nesting.ORDER_FIELDS))


# ------------------------------------------------------------------ parse / enforce
def q_parse_declared(spark, sf_dir):
    return _main_cols(_orders_parsed(spark, sf_dir))


def q_parse_inferred(spark, sf_dir):
    recs = landed(spark, sf_dir, "fx-o")
    return parse(recs, infer_schema(recs)).select(*nesting.ORDER_FIELDS)


def q_complex_to_json(spark, sf_dir):
    main = _orders_silver(spark, sf_dir, only="orders_main").tables["orders_main"]
    return main.select("o_orderkey", F.json_array_length("lines").cast("bigint").alias("n_lines"))


TYPED = {"o_orderkey": "long", "o_custkey": "double", "o_orderstatus": "string",
         "o_totalprice": "currency", "o_orderdate": "date", "o_orderpriority": " String "}


def q_enforce_typed(spark, sf_dir):
    return enforce(_orders_parsed(spark, sf_dir), TYPED)


MISSING = {"o_orderkey": "int", "o_comment": "string", "o_clerk": "datetime",
           "o_shippriority": "long", "o_flag": "boolean", "o_rate": "float",
           "o_fee": "currency", "o_day": "date", "o_tags": "array<string>"}


def q_enforce_missing(spark, sf_dir):
    return ntz(enforce(_orders_parsed(spark, sf_dir), MISSING))


def q_enforce_order(spark, sf_dir):
    return enforce(_orders_parsed(spark, sf_dir),
                   {"o_orderpriority": "string", "o_orderkey": "int", "o_orderstatus": "string"})


def q_enforce_string(spark, sf_dir):
    return enforce_strings(_orders_parsed(spark, sf_dir), ["o_orderkey", "o_orderstatus", "o_comment"])


DRIFT_DECL = {"o_orderkey": "int", "o_orderstatus": "string", "o_comment": "string",
              "o_clerk": "string"}


def q_schema_drift(spark, sf_dir):
    recs = landed(spark, sf_dir, "fx-o")
    return drift(spark, [("orders_main", infer_schema(recs), DRIFT_DECL)])


def q_schema_drift_nested(spark, sf_dir):
    """Drift of every table of the three-level records, against schemas inferred from the data."""
    sp = specs.spec({**specs.CUSTOMERS, "full_schema": None})
    res = silver_tables(landed(spark, sf_dir, "fx-n"), sp, reuse=None)
    return res.drift(sp)


# ------------------------------------------------------------------ unnest
def q_unnest_1(spark, sf_dir):
    return ntz(_orders_silver(spark, sf_dir, only="order_lines").tables["order_lines"])


def q_unnest_sliced(spark, sf_dir):
    """The order lines, arrays of more than two elements opened in slices."""
    res = silver_tables(landed(spark, sf_dir, "fx-o"), specs.spec(specs.ORDERS), only="order_lines", slice_rows=2)
    return ntz(res.tables["order_lines"])


def q_unnest_scalar(spark, sf_dir):
    return _orders_silver(spark, sf_dir, only="order_partkeys").tables["order_partkeys"]


def q_unnest_empty(spark, sf_dir):
    res = _orders_silver(spark, sf_dir, only="orders_main,order_lines")
    main, lines = res.tables["orders_main"], res.tables["order_lines"]
    # child keys de-duplicated map-side first (an order with many lines is one row per task)
    return main.select("o_orderkey").join(lines.select("o_orderkey").distinct(), "o_orderkey", "left_anti")


def q_unnest_2(spark, sf_dir):
    res = _customers_silver(spark, sf_dir, only="customer_order_lines")
    return ntz(res.tables["customer_order_lines"])


def q_unnest_3(spark, sf_dir):
    res = _customers_silver(spark, sf_dir, only="customer_order_line_prices")
    return ntz(res.tables["customer_order_line_prices"])


def q_unnest_text(spark, sf_dir):
    sp = specs.spec(specs.CONVERSATIONS)
    res = silver_tables(landed(spark, sf_dir, "fx-v"), sp,
                        only="conversation_turns", reuse=None)
    return res.tables["conversation_turns"]


def q_parse_string_column(spark, sf_dir):
    sp = specs.spec(specs.EVENTS)
    res = silver_tables(landed(spark, sf_dir, "fx-e"), sp,
                        only="event_props", reuse=None)
    return res.tables["event_props"]


def q_fan_out(spark, sf_dir):
    return table_counts(_orders_silver(spark, sf_dir, reuse="stage").tables)


def q_table_select(spark, sf_dir):
    res = _orders_silver(spark, sf_dir, only=" order_partkeys, ,no_such_table,")
    return table_counts(res.tables)


def q_table_counts(spark, sf_dir):
    return table_counts(_customers_silver(spark, sf_dir, reuse="stage").tables)


# ------------------------------------------------------------------ landing
def _envelopes(spark, sf_dir, days=EV_DAYS):
    """Landed page responses of the events source (written once per application)."""
    key = (spark.sparkContext.applicationId, sf_dir, f"envelopes-{days}")
    path = _LANDED.get(key)
    if path is None:
        path = scratch_path(spark, "envelopes")
        nesting.event_envelopes(spark, sf_dir, EV_START, EV_END, days, EV_PAGE).write.parquet(path)
        _LANDED[key] = path
    return spark.read.parquet(path)


EVENT_SHAPE = {"event_id": "BIGINT", "ts": "TIMESTAMP", "user_id": "BIGINT",
               "event_type": "STRING", "value": "DOUBLE", "props": "STRING"}


def _event_rows(recs: DataFrame, keep=()) -> DataFrame:
    sp = specs.spec(specs.EVENTS)
    return ntz(enforce(parse(recs, shape_to_struct(EVENT_SHAPE), keep=keep),
                       {**{k: "string" for k in keep}, **sp.main_schema}))


def q_window_coverage(spark, sf_dir):
    ev = nesting.table(spark, sf_dir, "events")
    return ntz(landing.window_coverage(ev, "ts", EV_START, EV_END, EV_DAYS))


def q_expected_pages(spark, sf_dir):
    env = _envelopes(spark, sf_dir, days=1)
    return ntz(landing.expected_pages(env, "totalHits", EV_PAGE))


def q_envelope_flatten(spark, sf_dir):
    return _event_rows(landing.records(_envelopes(spark, sf_dir), "events"))


def q_page_concat(spark, sf_dir):
    recs = landing.records(_envelopes(spark, sf_dir), "events")
    rows = parse(recs, shape_to_struct({"event_id": "BIGINT"}), keep=("window_start", "page"))
    return ntz(rows.select("window_start", "page", "event_id"))


def q_record_ordinal(spark, sf_dir):
    """Every landed record's place in the fetch order (window, page, position), without a global sort."""
    shape = f"totalHits BIGINT, events ARRAY<STRUCT<{', '.join(f'{k}: {t}' for k, t in EVENT_SHAPE.items())}>>"
    env = _envelopes(spark, sf_dir).withColumn("body", F.from_json("body", shape))
    env = env.withColumn("body", F.to_json(F.struct("body.totalHits", F.array_sort("body.events").alias("events"))))
    recs = landing.ordered_records(env, "events")
    rows = parse(recs, shape_to_struct({"event_id": "BIGINT"}), keep=("window_start", "page", "position", "ordinal"))
    return ntz(rows.select("window_start", "page", "position", "ordinal", "event_id"))


def q_page_drift(spark, sf_dir):
    """Every window moved twice while it was fetched: the second page starts with the two last records
    of the first, and from the third page on three records fewer are announced."""
    shape = f"totalHits BIGINT, events ARRAY<STRUCT<{', '.join(f'{k}: {t}' for k, t in EVENT_SHAPE.items())}>>"
    env = _envelopes(spark, sf_dir).withColumn("b", F.from_json("body", shape)).withColumn("e", F.array_sort("b.events"))
    first = env.where("page = 1").select(F.col("window_start").alias("w"), F.slice("e", -2, 2).alias("tail")).where("size(e) > 1")
    moved = env.join(first, (F.col("page") == 2) & (F.col("window_start") == F.col("w")), "left")
    events = F.when(F.col("tail").isNotNull(), F.concat("tail", "e")).otherwise(F.col("e"))
    total = F.col("b.totalHits") - F.when(F.col("page") > 2, 3).otherwise(0)
    return ntz(landing.page_drift(moved.select("window_start", "page", F.to_json(F.struct(
        total.alias("totalHits"), events.alias("events"))).alias("body")), "events", "totalHits"))


def q_page_completeness(spark, sf_dir):
    env = _envelopes(spark, sf_dir)
    hits = F.from_json("body", "totalHits BIGINT")["totalHits"]
    last = F.greatest(F.ceil(hits / F.lit(EV_PAGE)), F.lit(1))
    lost = (F.col("page") == last) & (last > 1)  # the last page of a multi-page window never landed
    return ntz(landing.page_report(env.filter(~lost), "events", "totalHits", EV_PAGE))


def q_pages_ingest(spark, sf_dir):
    """Landed pages gate, flatten and load: a complete landing loads; one with a lost page is refused."""
    sp = specs.spec(specs.EVENTS)
    env = _envelopes(spark, sf_dir)
    bronze, root = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    lost = env.filter(F.col("page") != 2)          # every window's second page never landed
    try:
        ingest_pages(spark, sp, lost, LOAD_TS, bronze, root, only="events_main")
        raise AssertionError("an incomplete landing was loaded")
    except IncompleteLanding:
        pass
    run = ingest_pages(spark, sp, env, LOAD_TS, bronze, root, only="events_main")
    return ntz(spark.read.parquet(run.versions["events_main"]))


def q_landing_roundtrip(spark, sf_dir):
    path = write_landing(nesting.event_records(spark, sf_dir), scratch_path(spark, "landing"))
    bronze = bronze_from_text(spark, path, LOAD_TS)
    return _event_rows(bronze)


def _events_bronze(spark, sf_dir):
    """Event records as bronze whose load time is the event time (for load-time filters)."""
    ev = nesting.table(spark, sf_dir, "events")
    rec = nesting.as_records(ev.select("event_id", "ts", "user_id", "event_type", "value", "props"))
    rec = rec.withColumn("__ts", F.get_json_object("raw_json", "$.ts").cast("timestamp"))
    return rec.select("raw_json", F.col("__ts").alias("load_timestamp"),
                      F.lit("events").alias("source_file"))


def q_bronze_append(spark, sf_dir):
    target = scratch_path(spark, "bronze")
    ev = nesting.table(spark, sf_dir, "events")
    cut = F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    for name, cond, ts in (("batch-a", cut, "2024-02-01T00:00:00Z"),
                           ("batch-b", ~cut, "2024-02-02T00:00:00Z")):
        recs = nesting.as_records(ev.filter(cond))
        append_bronze(in_memory_bronze(recs, ts, name), target)
    b = read_bronze(spark, target)
    return b.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))


def q_backfill_filter(spark, sf_dir):
    target = scratch_path(spark, "bronze")
    append_bronze(_events_bronze(spark, sf_dir), target)
    b = load_window(read_bronze(spark, target), "2024-01-08T00:00:00Z", "2024-01-14T23:59:59.999999Z")
    return parse(b, shape_to_struct({"event_id": "BIGINT"}))


def q_backfill_no_column(spark, sf_dir):
    b = _events_bronze(spark, sf_dir).drop("load_timestamp")
    b = load_window(b, "2024-01-08T00:00:00Z", "2024-01-14T23:59:59.999999Z")
    return parse(b, shape_to_struct({"event_id": "BIGINT"}))


# ------------------------------------------------------------------ upsert
def _split(df: DataFrame, col: str):
    c = F.col(col).cast("timestamp_ntz")
    target = df.filter(c < F.lit(SPLIT_HI).cast("timestamp_ntz"))
    source = df.filter(c >= F.lit(SPLIT_LO).cast("timestamp_ntz"))
    return target, source


def _main_typed(spark, sf_dir):
    """Typed main table; staged, since the upsert queries read it twice (target and source)."""
    return _main_cols(_orders_silver(spark, sf_dir, only="orders_main", reuse="stage").tables["orders_main"])


def q_upsert_create(spark, sf_dir):
    path = upsert_path(spark, None, _main_typed(spark, sf_dir), ["o_orderkey"], scratch_path(spark, "silver"))
    return spark.read.parquet(path)


def q_upsert_main(spark, sf_dir):
    target, source = _split(_main_typed(spark, sf_dir), "o_orderdate")
    source = source.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    v1 = upsert_path(spark, None, target, ["o_orderkey"], scratch_path(spark, "silver"))
    v2 = upsert_path(spark, v1, source, ["o_orderkey"], scratch_path(spark, "silver"))
    return spark.read.parquet(v2)


def q_upsert_child(spark, sf_dir):
    sp = specs.spec(specs.ORDERS)
    lines = ntz(_orders_silver(spark, sf_dir, only="order_lines", reuse="stage").tables["order_lines"])
    target, source = _split(lines, "l_shipdate")
    source = source.withColumn("l_quantity", F.col("l_quantity") + 1)
    keys = sp.child("order_lines").merge_keys
    v1 = upsert_path(spark, None, target, keys, scratch_path(spark, "silver"))
    v2 = upsert_path(spark, v1, source, keys, scratch_path(spark, "silver"))
    return spark.read.parquet(v2)


def q_upsert_partitioned(spark, sf_dir):
    """Child upsert into a table partitioned by ship year: only touched years are rewritten."""
    sp = specs.spec(specs.ORDERS)
    lines = ntz(_orders_silver(spark, sf_dir, only="order_lines", reuse="stage").tables["order_lines"])
    lines = lines.withColumn("ship_year", F.year("l_shipdate"))   # fixed per key (l_shipdate is in it)
    target, source = _split(lines, "l_shipdate")
    source = source.withColumn("l_quantity", F.col("l_quantity") + 1)
    keys = sp.child("order_lines").merge_keys
    path = scratch_path(spark, "silver")
    upsert_partitioned(spark, path, target, keys, ["ship_year"], exists=False)
    upsert_partitioned(spark, path, source, keys, ["ship_year"], fixed_partitions=True)
    return read_partitioned(spark, path).drop("ship_year")


def q_upsert_partitioned_null(spark, sf_dir):
    """Upsert over more than a thousand touched partitions, one of them the NULL partition."""
    main = _main_typed(spark, sf_dir)
    main = main.withColumn("bucket", F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey") % 1201))
    target, source = _split(main, "o_orderdate")
    source = source.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    path = scratch_path(spark, "silver")
    upsert_partitioned(spark, path, target, ["o_orderkey"], ["bucket"], exists=False)
    upsert_partitioned(spark, path, source, ["o_orderkey"], ["bucket"], fixed_partitions=True)
    return read_partitioned(spark, path)


def _two_line_loads(spark, sf_dir):
    """Order lines stored in full, and a later load of every third order: an order whose key is a multiple
    of nine comes without lines, the others without their second line and with a new quantity of the third."""
    lines = ntz(_orders_silver(spark, sf_dir, only="order_lines", reuse="stage").tables["order_lines"])
    lines = lines.withColumn("ship_year", F.year("l_shipdate"))
    key = F.col("o_orderkey")
    parents = nesting.table(spark, sf_dir, "orders").select("o_orderkey").where(key % 3 == 0)
    load = (lines.where((key % 3 == 0) & (key % 9 != 0) & (F.col("l_linenumber") != 2))
            .withColumn("l_quantity", F.col("l_quantity") + F.when(F.col("l_linenumber") == 3, 1).otherwise(0)))
    return lines, load, parents


def q_upsert_children_replaced(spark, sf_dir):
    """Loaded orders' lines are replaced as a whole, across partitions; other orders keep theirs."""
    lines, load, parents = _two_line_loads(spark, sf_dir)
    keys = specs.spec(specs.ORDERS).child("order_lines").merge_keys
    path = scratch_path(spark, "silver")
    upsert_partitioned(spark, path, lines, keys, ["ship_year"], exists=False)
    upsert_partitioned(spark, path, load, keys, ["ship_year"], fixed_partitions=True, scope=Scope(["o_orderkey"], parents))
    return read_partitioned(spark, path).drop("ship_year")


def q_upsert_changes(spark, sf_dir):
    """What each of three loads did to the lines: plain upsert, the same again, and with replaced children."""
    lines, load, parents = _two_line_loads(spark, sf_dir)
    keys = specs.spec(specs.ORDERS).child("order_lines").merge_keys
    path, told = scratch_path(spark, "silver"), []
    whole = scratch_path(spark, "silver")
    for name, rows, scope in (("create", lines.where("o_orderkey % 5 <> 0"), None), ("load", load, None), ("again", load, None),
                              ("replace", load, Scope(["o_orderkey"], parents))):
        by_part: dict[str, int] = {}
        by_version: dict[str, int] = {}
        upsert_partitioned(spark, path, rows, keys, ["ship_year"], exists=name != "create", fixed_partitions=True,
                           scope=scope, changes=by_part)
        whole = upsert_path(spark, None if name == "create" else whole, rows, keys, whole if name == "create"
                            else scratch_path(spark, "silver"), scope=scope, changes=by_version)
        told += [(name, kind, n, by_version[kind]) for kind, n in by_part.items()]
    return spark.createDataFrame(told, "load string, change string, partitioned long, versioned long")


def q_upsert_null_key(spark, sf_dir):
    main = _main_typed(spark, sf_dir)
    main = main.select(F.when(F.col("o_orderstatus") == "P", F.lit(None))
                       .otherwise(F.col("o_orderkey")).alias("o_key"), "o_orderkey", "o_totalprice",
                       "o_orderdate")
    target, source = _split(main, "o_orderdate")
    source = source.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return merge_frames(target, source, ["o_key"]).drop("o_orderdate")


def q_merge_conflicts(spark, sf_dir):
    lines = ntz(_orders_silver(spark, sf_dir, only="order_lines", reuse="stage").tables["order_lines"])
    target, source = _split(lines, "l_shipdate")
    return conflicts(target, source, ["o_orderkey", "l_linenumber"])


TWO_LOADS = ("2024-02-01T00:00:00Z", "2024-02-02T00:00:00Z")


def _order_loads(spark, sf_dir):
    """The orders as two overlapping loads (split on order date); the second one changes its records."""
    path, nested = scratch_path(spark, "orders"), nesting.order_rows(spark, sf_dir)
    nested.write.parquet(path, compression=PARQUET_CODEC)       # both loads read it: nested once
    rows = spark.read.schema(nested.schema).parquet(path)
    first, second = _in_load()
    price, lines = _changed()
    return (nesting.as_records(rows.filter(first)),
            nesting.as_records(rows.filter(second).withColumn("o_totalprice", price).withColumn("lines", lines)))


def _in_load() -> tuple[Column, Column]:
    """Whether an order is in the first, and in the second load."""
    day = F.col("o_orderdate")
    return day < F.lit(SPLIT_HI).cast("timestamp_ntz"), day >= F.lit(SPLIT_LO).cast("timestamp_ntz")


def _changed() -> tuple[Column, Column]:
    """The price and the lines that an order has in the second load."""
    return F.col("o_totalprice") * 2, F.transform("lines", lambda x: x.withField("l_quantity", x["l_quantity"] + 1))


def _land_order_loads(spark, sf_dir) -> list[str]:
    """The loads of ``_order_loads``, landed: the orders are nested once and both landings are written in one pass."""
    first, second = _in_load()
    loads = F.array_compact(F.array(F.when(first, F.lit(0)), F.when(second, F.lit(1))))
    rows = nesting.order_rows(spark, sf_dir).withColumn("load", F.explode(loads))
    for name, value in zip(("o_totalprice", "lines"), _changed()):
        rows = rows.withColumn(name, F.when(F.col("load") == 1, value).otherwise(F.col(name)))
    path = write_landing(nesting.as_records(rows, keep=("load",)), scratch_path(spark, "landing"), by="load")
    texts = [f"{path}/load={i}" for i in range(len(TWO_LOADS))]
    for text in texts:
        make_path(spark, text)      # a load without orders landed nothing
    return texts


def _main_with_lines(main: DataFrame, lines: DataFrame) -> DataFrame:
    own = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity"]
    lines, tasks = lines.select("o_orderkey", *own), more_tasks(main.sparkSession, lines.count(), MERGE_ROWS)
    if tasks:
        lines = lines.repartition(tasks, "o_orderkey")
    return ntz(main.select("o_orderkey", "o_totalprice").join(lines, "o_orderkey", "left").select("o_orderkey", "o_totalprice", *own))


def q_silver_summary(spark, sf_dir):
    """Two overlapping loads upserted into versioned silver, then summarised."""
    sp = specs.spec(specs.ORDERS)
    root = scratch_path(spark, "silver")
    current: dict[str, str | None] = {}
    for i, (part, ts) in enumerate(zip(_order_loads(spark, sf_dir), TWO_LOADS)):
        res = silver_tables(in_memory_bronze(part, ts, f"load-{i}"), sp, only="orders_main, order_lines")
        current = upsert_all(spark, sp, res.tables, current, root)
        res.release()
    return summary(spark, current)


def q_preview(spark, sf_dir):
    """The sample view: up to ten rows of each stored table (the limit is the feature)."""
    root = scratch_path(spark, "silver")
    tables = _orders_silver(spark, sf_dir, only="orders_main, order_lines", reuse="stage").tables
    stored = upsert_all(spark, specs.spec(specs.ORDERS), tables, {}, root)
    return preview(spark, stored, n=10).groupBy("table").agg(F.count(F.lit(1)).alias("rows"))


def q_incremental_run(spark, sf_dir):
    """Two incremental runs, the second with changed records: main by version, lines by partition."""
    sp = specs.spec(specs.ORDERS)
    bronze, root = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    current: dict[str, str | None] = {}
    for text, ts in zip(_land_order_loads(spark, sf_dir), TWO_LOADS):
        current = ingest(spark, sp, text, ts, bronze, root, current, only="orders_main, order_lines",
                         partition_by={"order_lines": ["l_linenumber"]}).versions
    return _main_with_lines(spark.read.parquet(current["orders_main"]), read_partitioned(spark, current["order_lines"]))


def q_ingest_rerun(spark, sf_dir):
    """One load ingested twice with the same load time: as if once, in bronze and in silver."""
    sp = specs.spec(specs.ORDERS)
    bronze, root = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    text = write_landing(landed(spark, sf_dir, "fx-o"), scratch_path(spark, "landing"))
    run = None
    for _ in range(2):
        run = ingest(spark, sp, text, LOAD_TS, bronze, root, run.versions if run else None, only="orders_main")
    stored = read_bronze(spark, bronze).agg(F.count(F.lit(1)).alias("bronze_rows"))
    return _main_cols(spark.read.parquet(run.versions["orders_main"])).join(stored, how="cross")


def q_bronze_two_landings(spark, sf_dir):
    """Two landings ingested with one load time, the first of them twice: each is there once, record by record."""
    sp = specs.spec(specs.ORDERS)
    bronze, root = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    recs = landed(spark, sf_dir, "fx-o")
    even = F.get_json_object("raw_json", "$.o_orderkey").cast("long") % 2 == 0
    one, two = (write_landing(recs.where(c), scratch_path(spark, "landing")) for c in (even, ~even))
    current: dict[str, str | None] = {}
    for text in (one, two, one):
        current = ingest(spark, sp, text, LOAD_TS, bronze, root, current, only="orders_main").versions
    shape = shape_to_struct({"o_orderkey": "BIGINT", "o_custkey": "BIGINT"})
    stored = (parse(read_bronze(spark, bronze), shape, keep=("source_file",))
              .select("o_orderkey", "o_custkey", F.when(F.col("source_file") == one, "first").otherwise("second").alias("landing")))
    main = spark.read.parquet(current["orders_main"]).select(F.col("o_orderkey").alias("key"), "o_totalprice")
    return stored.join(main, stored["o_orderkey"] == main["key"], "full").drop("key")


def q_run_resumed(spark, sf_dir):
    """A run that reached only its first table, repeated with ``resume``: the first is not written again."""
    sp = specs.spec(specs.ORDERS)
    bronze, root = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    text = write_landing(landed(spark, sf_dir, "fx-o"), scratch_path(spark, "landing"))
    parts = {"orders_main": ["o_orderstatus"], "order_lines": ["l_linenumber"]}
    first = ingest(spark, sp, text, LOAD_TS, bronze, root, only="orders_main", partition_by=parts)
    run = ingest(spark, sp, text, LOAD_TS, bronze, root, first.versions, only="orders_main, order_lines", partition_by=parts, resume=True)
    main, lines = (read_partitioned(spark, run.versions[t]) for t in ("orders_main", "order_lines"))
    return _main_with_lines(main, lines).withColumn("written", F.lit(",".join(sorted(run.rows))))


def q_backfill_rebuild(spark, sf_dir):
    """Rebuild one table from the bronze rows of one load-time range."""
    sp = specs.spec(specs.ORDERS)
    bronze, root = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    for part, ts in zip(_order_loads(spark, sf_dir), TWO_LOADS):
        append_bronze(in_memory_bronze(part, ts, "orders"), bronze)
    run = backfill(spark, sp, bronze, "2024-02-02T00:00:00Z", "2024-02-02T23:59:59Z", root,
                   only="order_lines")
    return ntz(spark.read.parquet(run.versions["order_lines"]))


def q_backfill_two_loads(spark, sf_dir):
    """Rebuild over two loads of changed records: the last load of each record wins."""
    sp = specs.spec(specs.ORDERS)
    bronze, root = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    for part, ts in zip(_order_loads(spark, sf_dir), TWO_LOADS):
        append_bronze(in_memory_bronze(part, ts, "orders"), bronze)
    run = backfill(spark, sp, bronze, *TWO_LOADS, root, only="orders_main, order_lines")
    return _main_with_lines(*[spark.read.parquet(run.versions[t]) for t in ("orders_main", "order_lines")])


def q_backfill_ties(spark, sf_dir):
    """Rebuild over a load in which keys come several times, from three sources and twice from one of them."""
    sp = specs.spec(specs.ORDERS)
    bronze, root = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    rows, key = nesting.order_rows(spark, sf_dir).select(*nesting.ORDER_FIELDS), F.col("o_orderkey")
    priced = lambda cond, factor: nesting.as_records(
        rows.where(cond).withColumn("o_totalprice", F.col("o_totalprice") * factor))
    for recs, ts, name in ((priced(key > 0, 1), TWO_LOADS[0], "z"), (priced(key % 7 == 0, 4), TWO_LOADS[0], "a"),
                           (priced(key % 3 == 0, 2), TWO_LOADS[1], "b"), (priced(key % 5 == 0, 3), TWO_LOADS[1], "c"),
                           (priced(key % 10 == 0, 3), TWO_LOADS[1], "c")):
        append_bronze(in_memory_bronze(recs, ts, name), bronze)
    run = backfill(spark, sp, bronze, *TWO_LOADS, root, only="orders_main")
    return spark.read.parquet(run.versions["orders_main"]).select("o_orderkey", "o_custkey", "o_totalprice")


LOSSY = {**specs.ORDERS,
         "data_schema": {**specs.ORDERS["data_schema"], "o_orderstatus": "boolean", "o_orderpriority": "int"},
         "nested_tables": [{**specs.ORDERS["nested_tables"][0], "data_schema": {
             **specs.LINE_SCHEMA, "l_returnflag": "boolean", "l_linestatus": "date"}}]}


def q_cast_losses(spark, sf_dir):
    """Two loads under a declaration that does not fit: the values each one lost to casts, per column."""
    sp, told = specs.spec(LOSSY), None
    bronze, root, run = scratch_path(spark, "bronze"), scratch_path(spark, "silver"), None
    for i, (text, ts) in enumerate(zip(_land_order_loads(spark, sf_dir), TWO_LOADS)):
        run = ingest(spark, sp, text, ts, bronze, root, run.versions if run else None, only="orders_main, order_lines",
                     partition_by={"order_lines": ["l_linenumber"]})
        own = run.cast_losses(spark).where("lost > 0").withColumn("load", F.lit(i + 1))
        told = own if told is None else told.unionByName(own)
    return told


def q_quarantine(spark, sf_dir):
    """A load of which every tenth line is cut short: the rest loads, the cut lines are set aside."""
    sp = specs.spec(specs.EVENTS)
    recs = nesting.event_records(spark, sf_dir)
    event = F.get_json_object("raw_json", "$.event_id").cast("long")
    cut = recs.withColumn("raw_json", F.when(event % 10 == 0, F.expr("left(raw_json, length(raw_json) - 5)"))
                          .otherwise(F.col("raw_json")))
    text = write_landing(cut, scratch_path(spark, "landing"))
    run = ingest(spark, specs.spec({**specs.EVENTS, "full_schema": EVENT_SHAPE}), text, LOAD_TS,
                 scratch_path(spark, "bronze"), scratch_path(spark, "silver"), only=sp.main_table)
    bad = spark.read.parquet(run.quarantine)
    return (spark.read.parquet(run.versions[sp.main_table]).select("event_id", F.lit("loaded").alias("outcome"))
            .unionByName(bad.select(F.regexp_extract("raw_json", r'"event_id":(\d+)', 1).cast("long").alias("event_id"),
                                    F.col("reason").alias("outcome"))))


def q_landing_gate(spark, sf_dir):
    """A landing with one window, pages, records and totals lost, and one page landed twice."""
    env = _envelopes(spark, sf_dir)
    page, day = F.col("page"), F.to_date("window_start")
    w0, w1, w4 = (day == F.lit(d).cast("date") for d in ("2024-01-01", "2024-01-08", "2024-01-29"))
    kept = env.filter(~w1 & ~(w0 & (page == 2)))
    body = (F.when(w0 & (page == 3), F.regexp_replace("body", r'(?s)"events":.*', '"events":[]}'))
            .when(w0 & (page == 4), F.expr("left(body, length(body) - 3)"))
            .when(w4, F.regexp_replace("body", r'"totalHits":\d+,', "")).otherwise(F.col("body")))
    hurt = kept.withColumn("body", body)
    hurt = hurt.unionByName(hurt.filter(w0 & (page == 5)))
    return ntz(landing.gate(hurt, specs.spec(specs.EVENTS)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_declared": q_parse_declared,
    "parse_inferred": q_parse_inferred,
    "complex_to_json": q_complex_to_json,
    "enforce_typed": q_enforce_typed,
    "enforce_missing": q_enforce_missing,
    "enforce_order": q_enforce_order,
    "enforce_string": q_enforce_string,
    "schema_drift": q_schema_drift,
    "schema_drift_nested": q_schema_drift_nested,
    "unnest_1": q_unnest_1,
    "unnest_sliced": q_unnest_sliced,
    "unnest_scalar": q_unnest_scalar,
    "unnest_empty": q_unnest_empty,
    "unnest_2": q_unnest_2,
    "unnest_3": q_unnest_3,
    "unnest_text": q_unnest_text,
    "parse_string_column": q_parse_string_column,
    "fan_out": q_fan_out,
    "table_select": q_table_select,
    "table_counts": q_table_counts,
    "window_coverage": q_window_coverage,
    "expected_pages": q_expected_pages,
    "envelope_flatten": q_envelope_flatten,
    "page_concat": q_page_concat,
    "record_ordinal": q_record_ordinal,
    "page_drift": q_page_drift,
    "page_completeness": q_page_completeness,
    "pages_ingest": q_pages_ingest,
    "landing_roundtrip": q_landing_roundtrip,
    "bronze_append": q_bronze_append,
    "backfill_filter": q_backfill_filter,
    "backfill_no_column": q_backfill_no_column,
    "upsert_create": q_upsert_create,
    "upsert_main": q_upsert_main,
    "upsert_child": q_upsert_child,
    "upsert_partitioned": q_upsert_partitioned,
    "upsert_partitioned_null": q_upsert_partitioned_null,
    "upsert_children_replaced": q_upsert_children_replaced,
    "upsert_changes": q_upsert_changes,
    "upsert_null_key": q_upsert_null_key,
    "merge_conflicts": q_merge_conflicts,
    "silver_summary": q_silver_summary,
    "incremental_run": q_incremental_run,
    "backfill_rebuild": q_backfill_rebuild,
    "backfill_two_loads": q_backfill_two_loads,
    "ingest_rerun": q_ingest_rerun,
    "bronze_two_landings": q_bronze_two_landings,
    "run_resumed": q_run_resumed,
    "backfill_ties": q_backfill_ties,
    "cast_losses": q_cast_losses,
    "quarantine": q_quarantine,
    "landing_gate": q_landing_gate,
    "preview": q_preview,
}
