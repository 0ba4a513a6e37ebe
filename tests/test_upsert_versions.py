import pytest
from pyspark.sql import Observation

from nestlift.operators.upsert import MergeConflict, compare_keys, kept_rows, merge_frames, upsert_path
from nestlift.session import scratch_path
from nestlift.sources.bronze import exists

S = "k STRING, v INT"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_path_deals_out_no_stored_row_without_need(spark, monkeypatch):
    monkeypatch.setattr("nestlift.operators.upsert.WIDE_ROW", 0)
    t = spark.createDataFrame([(f"k{i}", i) for i in range(50)], S)
    v1 = upsert_path(spark, None, t, ["k"], scratch_path(spark, "t"))
    stored = spark.read.parquet(v1)
    listed = lambda path: spark.read.parquet(path)
    for load, hits in ((t.selectExpr("concat('n', k) k", "v"), 0), (t.selectExpr("k", "v + 1 v"), 50)):
        path = scratch_path(spark, "keys")
        seen = compare_keys(stored, load, ["k"], path).get
        assert (seen["hits"], seen["misses"], seen["updated"], seen["fresh"] or 0) == (hits, 50 - hits, hits, 50 - hits)
        kept = kept_rows(stored, ["k"], listed(path), hits, 50 - hits)
        assert kept.count() == 50 - hits
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan
    out = scratch_path(spark, "t")
    assert upsert_path(spark, v1, t, ["k"], out) == v1 and not exists(spark, out)       # nothing changed, nothing written
    with pytest.raises(MergeConflict):
        upsert_path(spark, v1, t.unionByName(t), ["k"], out)
    assert not exists(spark, out)                                                       # told before the write


@pytest.mark.parametrize("null_safe,wide", [(False, 0), (True, 0), (False, 10**9)])
def test_upsert_path_equals_merge(spark, monkeypatch, null_safe, wide):
    monkeypatch.setattr("nestlift.operators.upsert.WIDE_ROW", wide)
    shape = "k string, j long, v int"
    nulls = [(None, 1, 1), (None, None, 2), ("n", None, 3)]
    target = [(f"k{i}", i % 3, i) for i in range(30)] + nulls
    loads = [[], nulls, [("k1", 1, 1)], [("k1", 1, 9), ("z", 1, 1), ("z", 1, 1), (None, 1, 5)],
             [(f"k{i}", i % 3, i + i % 2) for i in range(28)], [(f"k{i}", i % 3, i + 1) for i in range(30)] + nulls]
    full = lambda df: sorted(map(tuple, df.collect()), key=str)
    for stored in (target, nulls, []):
        t = spark.createDataFrame(stored, shape)
        v1 = upsert_path(spark, None, t, ["k", "j"], scratch_path(spark, "t"))
        for load in loads:
            s, told, n = spark.createDataFrame(load, shape), {}, Observation()
            v2 = upsert_path(spark, v1, s, ["k", "j"], scratch_path(spark, "t"), null_safe=null_safe, rows=n, changes=told)
            assert full(spark.read.parquet(v2)) == full(merge_frames(t, s, ["k", "j"], null_safe))
            assert int(n.get.get("rows", 0)) == len(load) == told["inserted"] + told["updated"] + told["unchanged"]


def test_new_row_beside_a_key_stored_twice(spark, monkeypatch):
    monkeypatch.setattr("nestlift.operators.upsert.WIDE_ROW", 0)
    v1 = upsert_path(spark, None, spark.createDataFrame([("a", 1), ("a", 1)], S), ["k"], scratch_path(spark, "t"))
    v2 = upsert_path(spark, v1, spark.createDataFrame([("a", 1), ("b", 2)], S), ["k"], scratch_path(spark, "t"))
    assert rows(spark.read.parquet(v2)) == [("a", 1), ("b", 2)]


@pytest.mark.parametrize("null_safe", [False, True])
def test_many_replaced_rows_are_told_by_their_place(spark, monkeypatch, null_safe):
    from nestlift.operators.upsert import with_places
    monkeypatch.setattr("nestlift.operators.upsert.WIDE_ROW", 0)
    monkeypatch.setattr("nestlift.operators.upsert.FEW_KEYS", 2)
    full = lambda df: sorted(map(tuple, df.collect()), key=str)
    target = (spark.range(100_000).selectExpr("if(id % 1000 = 7, null, concat('k', id div 2 * 2)) k", "cast(id as int) v")
              .repartition(3, "v").sortWithinPartitions("v"))
    v1 = upsert_path(spark, None, target, ["k"], scratch_path(spark, "t"))
    load = spark.range(0, 150_000, 6).selectExpr("if(id = 0, null, concat('k', id)) k", "cast(id + 1 as int) v")
    v2 = upsert_path(spark, v1, load, ["k"], scratch_path(spark, "t"), null_safe=null_safe)
    assert full(spark.read.parquet(v2)) == full(merge_frames(spark.read.parquet(v1), load, ["k"], null_safe))
    placed, path = with_places(spark.read.parquet(v1)), scratch_path(spark, "keys")
    seen = compare_keys(placed, load, ["k"], path, null_safe).get
    kept = kept_rows(placed, ["k"], spark.read.parquet(path), seen["hits"], seen["misses"], null_safe)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan and kept.columns == ["k", "v"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:        # whatever Spark would broadcast by itself
        kept = kept_rows(placed, ["k"], spark.read.parquet(path), seen["hits"], seen["misses"], null_safe)
        assert "SortMergeJoin" not in kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_merge_tasks_follow_the_rows(spark, monkeypatch):
    from nestlift.operators import upsert
    monkeypatch.setattr(upsert, "MERGE_ROWS", 10)
    asked, real = [], upsert.merge_states
    monkeypatch.setattr(upsert, "merge_states", lambda *a, **k: asked.append(k["tasks"]) or real(*a, **k))
    path, t = scratch_path(spark, "part"), spark.range(300).selectExpr("id", "id % 2 p", "1 v")
    upsert.upsert_partitioned(spark, path, t, ["id"], ["p"], exists=False)
    upsert.upsert_partitioned(spark, path, t.where("id < 100").withColumn("v", t.v + 1), ["id"], ["p"])
    upsert.upsert_partitioned(spark, path, t.where("id < 4 and p = 0").limit(0), ["id"], ["p"])
    assert asked == [40, None]
    assert rows(upsert.read_partitioned(spark, path).groupBy("v").count().select("v", "count")) == [(1, 200), (2, 100)]
