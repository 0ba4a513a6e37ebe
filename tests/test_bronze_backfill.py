import datetime as dt

from pyspark.sql import functions as F

from nestlift.operators.backfill import load_window
from nestlift.sources.bronze import append_bronze, bronze_from_text, read_bronze, write_landing
from nestlift.session import scratch_path


def test_landing_bronze_roundtrip_and_append(spark, records):
    recs = records('{"a": 1}', '{"a": 2}')
    path = write_landing(recs, scratch_path(spark, "landing"))
    b = bronze_from_text(spark, path, "2024-02-01T10:00:00Z")
    assert b.columns == ["raw_json", "load_timestamp", "source_file"]
    rows = b.collect()
    assert sorted(r.raw_json for r in rows) == ['{"a": 1}', '{"a": 2}']
    assert {r.load_timestamp for r in rows} == {dt.datetime(2024, 2, 1, 10)}   # one literal per run
    target = scratch_path(spark, "bronze")
    append_bronze(b, target)
    append_bronze(bronze_from_text(spark, path, "2024-02-03T00:00:00Z"), target)
    assert read_bronze(spark, target).count() == 4          # append keeps both loads


def test_load_window_inclusive_and_pruned(spark, records):
    recs = records('{"a": 1}')
    target = scratch_path(spark, "bronze")
    for ts in ("2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z", "2024-01-03T00:00:00Z"):
        append_bronze(recs.select("raw_json", F.lit(ts).cast("timestamp").alias("load_timestamp"),
                                  F.lit("x").alias("source_file")), target)
    got = load_window(read_bronze(spark, target), "2024-01-02T00:00:00Z", "2024-01-03T00:00:00Z")
    assert got.count() == 2
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "load_date" in plan


def test_load_window_without_column(spark, records):
    df = records('{"a": 1}')
    assert load_window(df, "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z").count() == 1


def test_landed_and_stored_text_is_packed(spark, records, monkeypatch):
    from nestlift.sources import bronze
    monkeypatch.setattr(bronze, "LANDING_ROWS", 3)
    recs = records(*[f'{{"a": {i}}}' for i in range(7)]).coalesce(1)
    path = write_landing(recs, scratch_path(spark, "landing"))
    files = [r.path for r in spark.read.format("binaryFile").load(path).select("path").collect()]
    assert len(files) == 3 and all(f.endswith(".gz") for f in files)       # no file for one task to read whole
    target = scratch_path(spark, "bronze")
    append_bronze(bronze_from_text(spark, path, "2024-02-01T10:00:00Z"), target)
    stored = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(target).select("path").collect()
    assert all(r.path.endswith(".zstd.parquet") for r in stored if r.path.endswith(".parquet"))
    assert read_bronze(spark, target).count() == 7


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_last_copies_are_found_in_one_pass_over_the_texts(spark, monkeypatch):
    from nestlift.operators import backfill
    rows = [('{"k": 1, "v": "a"}', 1, "x"), ('{"k": 1, "v": "b"}', 2, "x"), ('{"k": 1, "v": "c"}', 2, "w"),     # last source
            ('{"k": 2, "v": "a"}', 1, "x"), ('{"k": 2, "v": "b"}', 1, "x"), ('{"k": 2, "v": "b"}', 1, "x"),     # tie: last text
            ('{"k": 3}', 1, "x"), ('{"v": 1}', 1, "x"), ('{"v": 1}', 1, "x"), ("{", 1, "x"), (None, 1, "x")]
    frame = (spark.createDataFrame(rows, "raw_json string, n int, source_file string")
             .select("raw_json", F.timestamp_seconds("n").alias("load_timestamp"), "source_file"))
    want = sorted(str(rows[i][0]) for i in (1, 4, 6, 7, 8, 9, 10))
    for few, joins in ((0, 1), (backfill.FEW_KEYS, 2)):
        monkeypatch.setattr(backfill, "FEW_KEYS", few)
        got = backfill.latest_by(frame, ["k"])
        assert sorted(str(r.raw_json) for r in got.collect()) == want
        assert got.columns == frame.columns and _plan(got).count("Join ") == joins
        assert few or "broadcast" not in _plan(got)
    once = backfill.latest_by(frame.where("source_file = 'x' and raw_json like '%3%'"), ["k"])
    assert once.count() == 1 and "Join" not in _plan(once)      # nothing came twice: no text moves


def test_both_loads_read_orders_that_were_nested_once(spark):
    from nestlift.plans.catalog import _order_loads
    from conftest import SF
    for load in _order_loads(spark, SF):
        assert "collect_list" not in _plan(load)


def test_both_loads_are_landed_in_one_pass(spark, monkeypatch):
    from conftest import SF
    from nestlift.plans import catalog
    kinds = []
    monkeypatch.setattr(catalog, "scratch_path", lambda s, kind: kinds.append(kind) or scratch_path(s, kind))
    texts = catalog._land_order_loads(spark, SF)
    assert kinds == ["landing"]                             # the nested orders are not stored between
    for text, load in zip(texts, catalog._order_loads(spark, SF), strict=True):
        want = sorted(r.raw_json for r in load.collect())
        assert want and sorted(r.value for r in spark.read.text(text).collect()) == want


def test_a_load_without_orders_lands_nothing(spark):
    from nestlift.plans import catalog
    sf = scratch_path(spark, "tables")
    spark.sql("""SELECT * FROM VALUES (1L, 1L, 'O', 2.5D, TIMESTAMP_NTZ '1996-01-01 00:00:00', 'x'), (2L, 1L, 'O', 1D, NULL, 'x')
        AS t(o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)""").write.parquet(f"{sf}/orders.parquet")
    spark.sql("""SELECT * FROM VALUES (1L, 1L, 1L, 1, 1D, 1D, 0D, 0D, 'N', 'O', TIMESTAMP_NTZ '1996-01-02 00:00:00') AS t(l_orderkey, l_partkey,
        l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)
        """).write.parquet(f"{sf}/lineitem.parquet")
    assert [spark.read.text(t).count() for t in catalog._land_order_loads(spark, sf)] == [1, 0]
    assert catalog.q_incremental_run(spark, sf).count() == 1


def test_bronze_text_is_packed_harder(spark):
    from nestlift.session import stored_bytes
    recs = spark.range(20_000).selectExpr("""to_json(struct(id AS orderkey, xxhash64(id) % 1000 AS custkey,
        transform(sequence(1, 4), i -> struct(i AS linenumber, xxhash64(id, i) % 100000 AS partkey)) AS lines)) AS raw_json""").coalesce(1)
    plain, target = scratch_path(spark, "plain"), scratch_path(spark, "bronze")
    rows = recs.select("raw_json", F.lit("2024-01-01T00:00:00Z").cast("timestamp").alias("load_timestamp"), F.lit("x").alias("source_file"))
    rows.write.parquet(plain, compression="zstd")
    append_bronze(rows, target)
    assert stored_bytes(spark, target) < 0.97 * stored_bytes(spark, plain)
