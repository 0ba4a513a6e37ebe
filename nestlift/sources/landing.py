"""Landed pages: flatten envelopes into records, and audit what arrived.

An *envelope* is one landed page response, a JSON object holding a hit
total and an array of records, e.g. ``{"totalHits": 2345, "events": [...]}``.
The envelope frame carries the page's coordinates as columns:
``window_start TIMESTAMP, page INT, body STRING``.

* ``records``          envelopes -> one row per record, bag semantics (S6, S7)
* ``ordered_records``  the same with each record's place in the fetch order of the whole landing
* ``page_drift``       records served twice or likely lost because the source moved between two pages
* ``date_windows``     the request windows a date range is split into (S1)
* ``window_coverage``  records per window, empty windows, records in the holes (S1)
* ``expected_pages``   pages each window should have, from its hit total (S2)
* ``page_report``      expected vs landed pages: missing, received, unexpected (S8)
* ``gate``             windows and pages against the request range: anything not as announced (S1, S2, S8)

Every input is a distributed frame; only window/page *counts* (bounded by
the date range and page size) are ever small.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..spec import JobSpec, parse_instant, ts_lit

DAY_US = 86_400 * 1_000_000


def records(envelopes: DataFrame, data_key: str, body: str = "body",
            meta: tuple[str, ...] = ("window_start", "page")) -> DataFrame:
    """One ``raw_json`` row per record of every envelope; absent key -> no rows.

    Records are re-read as text, so nested objects stay JSON text (numbers
    normalised by the JSON writer). ``position`` is the record's index in
    its page, so (window, page, position) is the fetch order.
    """
    st = T.StructType([T.StructField(data_key, T.ArrayType(T.StringType()))])
    arr = F.from_json(F.col(body), st)[data_key]
    return (envelopes.select(*meta, F.posexplode(arr).alias("position", "raw_json")))


def ordered_records(envelopes: DataFrame, data_key: str, body: str = "body",
                    window: str = "window_start", page: str = "page") -> DataFrame:
    """``records`` with ``ordinal``: the record's place, from 1 and without gaps, in the fetch order of the whole landing.

    The order is window, page, position in the page; pages of one window and number
    with different bodies follow each other by a hash of the body, and copies of one
    body share their ordinals (``gate`` refuses both). A distributed prefix sum: records
    are counted per page, pages are added up within their window and windows among
    themselves, and a page's records number on from there. So only counts are ordered,
    one row per page within a window and one row per window; records are not sorted.
    """
    st = T.StructType([T.StructField(data_key, T.ArrayType(T.StringType()))])
    pages = envelopes.select(window, page, F.from_json(F.col(body), st)[data_key].alias("__nl_arr"), F.xxhash64(body).alias("__nl_body"))
    at = [window, page, "__nl_body"]
    counts = pages.groupBy(*at).agg(F.coalesce(F.max(F.array_size("__nl_arr")), F.lit(0)).cast("long").alias("__nl_n"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    windows = (counts.groupBy(window).agg(F.sum("__nl_n").alias("__nl_n"))
               .select(F.col(window).alias("__nl_window"), F.sum("__nl_n").over(before.orderBy(window)).alias("__nl_before")))
    starts = (counts.withColumn("__nl_in", F.sum("__nl_n").over(before.partitionBy(window).orderBy(page, "__nl_body")))
              .join(windows, F.col(window).eqNullSafe(F.col("__nl_window")))
              .select(*[F.col(c).alias(f"__nl_s{i}") for i, c in enumerate(at)],
                      (F.coalesce("__nl_in", F.lit(0)) + F.coalesce("__nl_before", F.lit(0))).alias("__nl_start")))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__nl_s{i}")) for i, c in enumerate(at)])
    return (pages.join(starts, same).select(window, page, "__nl_start", F.posexplode("__nl_arr").alias("position", "raw_json"))
            .withColumn("ordinal", F.col("__nl_start") + F.col("position") + 1).drop("__nl_start"))


def page_drift(envelopes: DataFrame, data_key: str, pages_key: str, body: str = "body",
               window: str = "window_start", page: str = "page") -> DataFrame:
    """Neighbouring pages between which the source moved: window, page, next_page, served_twice, lost.

    Pages are numbered by offset, so a record added in front while a window is being
    fetched moves the last record of a page to the next one, where it is served
    again; a record removed moves one up, past the request, and it is lost.
    ``served_twice`` counts records of a page that the next one holds too (by a 128-bit
    hash of their text, NULLs left out; copies within a page count as often as they pair
    up). ``lost`` is by how many the announced total fell between the two pages. Pairs
    of pages with neither are left out, as are totals that are missing. Hashes meet by
    window, page and hash, one shuffle, no text in it.
    """
    st = T.StructType([T.StructField(data_key, T.ArrayType(T.StringType())), T.StructField(pages_key, T.LongType())])
    parsed = envelopes.select(window, page, F.from_json(F.col(body), st).alias("b"))
    recs = (parsed.select(window, page, F.explode(f"b.{data_key}").alias("r")).where(F.col("r").isNotNull())
            .groupBy(window, page, F.xxhash64("r").alias("h1"), F.xxhash64(F.lit("record"), "r").alias("h2"))
            .agg(F.count(F.lit(1)).alias("n")))
    again = recs.select(window, (F.col(page) - 1).alias(page), "h1", "h2", F.col("n").alias("m"))
    twice = (recs.join(again, [window, page, "h1", "h2"]).groupBy(window, page)
             .agg(F.sum(F.least("n", "m")).cast("long").alias("served_twice")))
    totals = parsed.groupBy(window, page).agg(F.min(f"b.{pages_key}").alias("t"))
    after = totals.select(window, (F.col(page) - 1).alias(page), F.col("t").alias("u"))
    fell = totals.join(after, [window, page]).where("u < t").select(window, page, (F.col("t") - F.col("u")).alias("lost"))
    zero = F.lit(0).cast("long")
    return (twice.join(fell, [window, page], "full")
            .select(window, page, (F.col(page) + 1).alias("next_page"), F.coalesce("served_twice", zero).alias("served_twice"),
                    F.coalesce("lost", zero).alias("lost")))


def _bounds(start: datetime | str, end: datetime | str) -> tuple[datetime, datetime]:
    s = parse_instant(start) if isinstance(start, str) else start
    e = parse_instant(end) if isinstance(end, str) else end
    return s, e


def window_count(start: datetime | str, end: datetime | str, days: int) -> int:
    """Number of request windows: start, start+n, ... while <= end."""
    s, e = _bounds(start, end)
    if days <= 0:
        raise ValueError("interval must be > 0 days")
    span = (e - s) // timedelta(days=days)
    return int(span) + 1 if e >= s else 0


def date_windows(spark: SparkSession, start: datetime | str, end: datetime | str,
                 days: int) -> DataFrame:
    """``(window, window_start, window_end)``; end = min(next start - 1 s, range end).

    Derived from parameters only: its size is the window count, not data.
    """
    s, e = _bounds(start, end)
    n = window_count(s, e, days)
    step = F.make_dt_interval(F.col("id") * F.lit(days))
    ws = ts_lit(s) + step
    nxt = ts_lit(s) + F.make_dt_interval(
        (F.col("id") + 1) * F.lit(days))
    we = F.least(nxt - F.expr("INTERVAL 1 SECOND"), ts_lit(e))
    return spark.range(n).select(F.col("id").alias("window"), ws.alias("window_start"),
                                 we.alias("window_end"))


def window_index(ts, start: datetime, days: int):
    """0-based request-window number of a timestamp (half-open windows)."""
    t = F.unix_micros(ts.cast("timestamp"))
    s = F.unix_micros(ts_lit(start))
    return F.floor((t - s) / F.lit(days * DAY_US))


def window_coverage(recs: DataFrame, ts_col: str, start: datetime | str, end: datetime | str,
                    days: int) -> DataFrame:
    """Per request window: records inside it, and those in the 1-second hole after its end.

    Windows are half-open ``[start + k*n, start + (k+1)*n)`` clipped to the
    range; ``in_gap`` counts records after the window's closed end
    (``next start - 1 s``) that a closed-window fetch would have missed.
    Empty windows appear with 0. One partial aggregate over the records;
    the per-window rows (bounded by the range) are joined.
    """
    s, e = _bounds(start, end)
    spark = recs.sparkSession
    wins = date_windows(spark, s, e, days)
    ts = F.col(ts_col).cast("timestamp")
    inside = recs.select(ts.alias("__nl_ts")).filter(
        F.col("__nl_ts").between(ts_lit(s), ts_lit(e)))
    idx = window_index(F.col("__nl_ts"), s, days)
    closed_end = (ts_lit(s)
                  + F.make_dt_interval((idx + 1) * F.lit(days))
                  - F.expr("INTERVAL 1 SECOND"))
    counts = (inside.select(idx.alias("window"), (F.col("__nl_ts") > closed_end).alias("__nl_gap"))
              .groupBy("window")
              .agg(F.count(F.lit(1)).alias("records"),
                   F.count_if(F.col("__nl_gap")).alias("in_gap")))
    return (wins.join(counts, "window", "left")
            .select("window", "window_start", "window_end",
                    F.coalesce("records", F.lit(0)).alias("records"),
                    F.coalesce("in_gap", F.lit(0)).alias("in_gap")))


def hits(envelopes: DataFrame, pages_key: str, body: str = "body",
         window: str = "window_start") -> DataFrame:
    """``(window, hits)``: the largest total any landed page of the window reports.

    A page without the total key counts as 0 hits (only page 1 expected).
    """
    st = T.StructType([T.StructField(pages_key, T.LongType())])
    h = F.coalesce(F.from_json(F.col(body), st)[pages_key], F.lit(0))
    return envelopes.groupBy(window).agg(F.max(h).alias("hits"))


PAGE_CHUNK = 1_000_000


def expected_pages(envelopes: DataFrame, pages_key: str, page_size: int, body: str = "body",
                   window: str = "window_start") -> DataFrame:
    """``(window, page)`` for pages 1..max(ceil(hits / size), 1) of every landed window.

    Pages are generated in two steps so that no window, however large,
    produces all its page rows in one task: first one row per chunk of
    ``PAGE_CHUNK`` pages, spread over tasks by (window, chunk), then the
    pages of each chunk.
    """
    h = hits(envelopes, pages_key, body, window)
    n = F.greatest(F.ceil(F.col("hits") / F.lit(page_size)), F.lit(1)).cast("long")
    chunks = h.select(window, n.alias("__nl_n"),
                      F.explode(F.sequence(F.lit(0).cast("long"),
                                           F.floor((n - 1) / F.lit(PAGE_CHUNK)).cast("long")))
                      .alias("__nl_c"))
    first = F.col("__nl_c") * F.lit(PAGE_CHUNK) + 1
    last = F.least((F.col("__nl_c") + 1) * F.lit(PAGE_CHUNK), F.col("__nl_n"))
    return (chunks.repartition(window, "__nl_c")
            .select(window, F.explode(F.sequence(first, last)).alias("page"))
            .select(window, F.col("page").cast("int").alias("page")))


def page_report(envelopes: DataFrame, data_key: str, pages_key: str, page_size: int,
                body: str = "body", window: str = "window_start") -> DataFrame:
    """Expected vs landed pages: ``(window, page, status, records)``.

    status is ``received``, ``missing`` (expected, never landed: a silently
    dropped page) or ``unexpected`` (landed beyond the hit total).
    """
    exp = expected_pages(envelopes, pages_key, page_size, body, window).withColumn("__nl_exp", F.lit(True))
    st = T.StructType([T.StructField(data_key, T.ArrayType(T.StringType()))])
    arr = F.from_json(F.col(body), st)[data_key]
    n_rec = F.when(arr.isNull(), F.lit(0)).otherwise(F.size(arr))
    landed = envelopes.groupBy(window, "page").agg(F.sum(n_rec).alias("__nl_n"))
    j = exp.join(landed, [window, "page"], "full_outer")
    status = (F.when(F.col("__nl_n").isNull(), F.lit("missing"))
              .when(F.col("__nl_exp").isNull(), F.lit("unexpected"))
              .otherwise(F.lit("received")))
    return j.select(window, "page", status.alias("status"),
                    F.coalesce(F.col("__nl_n"), F.lit(0)).cast("bigint").alias("records"))


def gate(envelopes: DataFrame, spec: JobSpec, body: str = "body", window: str = "window_start") -> DataFrame:
    """What landed against what was announced: ``(window, page, status, records, received, hits)``.

    One row per expected or landed page, and one (page NULL) per request window
    of the spec's date range of which nothing landed. Statuses:

    * ``received``        landed once, with records (or an empty window's page 1)
    * ``missing_window``  no page of the window landed
    * ``missing``         the window's hit total calls for the page, which never landed
    * ``empty``           it landed without records although the total calls for some
    * ``corrupt``         its text is not a JSON object with the record array
    * ``no_total``        it landed without a hit total, and no page of its window has one
    * ``duplicate``       it landed more than once
    * ``unexpected``      it is beyond the hit total, or outside the request windows
    * ``short``           all pages landed, but with fewer records than hits (on the last page)

    ``received`` and ``hits`` are the window's. Each envelope is parsed once, into
    a few numbers; what follows works on one row per page.
    """
    st = T.StructType([T.StructField(spec.pages_key, T.LongType()),
                       T.StructField(spec.data_key, T.ArrayType(T.StringType())),
                       T.StructField("__nl_bad", T.StringType())])
    rec = F.from_json(F.col(body), st, {"columnNameOfCorruptRecord": "__nl_bad"})
    landed = (envelopes.select(F.col(window).alias("window"), F.col("page").cast("long").alias("page"), rec.alias("r"))
              .select("window", "page", F.col("r")[spec.pages_key].alias("total"),
                      F.when(F.col("r")["__nl_bad"].isNull(), F.size(F.col("r")[spec.data_key])).alias("n"))
              .groupBy("window", "page")
              .agg(F.max("total").alias("total"), F.count(F.lit(1)).alias("copies"),
                   F.sum(F.when(F.col("n") >= 0, F.col("n"))).alias("n"),
                   F.count_if(F.col("n").isNull() | (F.col("n") < 0)).alias("bad")))
    per_window = landed.groupBy("window").agg(F.max("total").alias("hits"), F.sum("n").alias("received"),
                                              F.max("page").alias("last_landed"), F.count(F.lit(1)).alias("n_landed"))
    if spec.start and spec.end:
        wins = date_windows(envelopes.sparkSession, spec.start, spec.end, spec.interval_days).select(
            F.col("window_start").cast(envelopes.schema[window].dataType).alias("window"), F.lit(True).alias("asked"))
        per_window = per_window.join(wins, "window", "full_outer")
    else:
        per_window = per_window.withColumn("asked", F.lit(True))
    pages = F.greatest(F.ceil(F.coalesce("hits", F.lit(0)) / F.lit(spec.page_size)), F.lit(1)).cast("long")
    per_window = per_window.withColumn("pages", F.when(F.col("asked"), pages).otherwise(0))
    # page numbers in chunks, so that no window, however large, makes all its rows in one task
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("pages") - 1) / F.lit(PAGE_CHUNK)).cast("long")))
    first = F.col("c") * F.lit(PAGE_CHUNK) + 1
    expected = (per_window.where("pages > 0 AND last_landed IS NOT NULL").select("window", "pages", chunk.alias("c"))
                .repartition("window", "c")
                .select("window", F.explode(F.sequence(first, F.least(first + PAGE_CHUNK - 1, F.col("pages")))).alias("page"),
                        F.lit(True).alias("expected")))
    every = expected.join(landed, ["window", "page"], "full_outer").join(per_window, "window")
    absent = per_window.where("last_landed IS NULL").select(
        "window", F.lit(None).cast("long").alias("page"), F.lit("missing_window").alias("status"),
        F.lit(0).cast("long").alias("records"), F.lit(0).cast("long").alias("received"), "hits")
    n = F.coalesce("n", F.lit(0))
    status = (F.when(F.col("copies").isNull(), "missing").when(F.col("bad") > 0, "corrupt")
              .when(F.col("copies") > 1, "duplicate").when(F.col("hits").isNull(), "no_total")
              .when(F.col("expected").isNull(), "unexpected").when((n == 0) & (F.col("hits") > 0), "empty")
              .when((F.col("page") == F.col("pages")) & (F.coalesce("received", F.lit(0)) < F.col("hits"))
                    & (F.col("n_landed") >= F.col("pages")), "short").otherwise("received"))
    rows = every.select("window", "page", status.alias("status"), n.cast("long").alias("records"),
                        F.coalesce("received", F.lit(0)).cast("long").alias("received"), "hits")
    return rows.unionByName(absent).withColumn("page", F.col("page").cast("int")).withColumnRenamed("window", window)
