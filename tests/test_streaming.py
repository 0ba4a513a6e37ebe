import json

from nestlift.session import scratch_path
from nestlift.sources.bronze import read_bronze
from nestlift.spec import JobSpec
from nestlift.streaming.landing_stream import stream_landing

SPEC = JobSpec.from_dict({
    "main_table_name": "stream_conv", "main_table_key": "id", "silver_schema": None,
    "data_schema": {"id": "int", "name": "string", "parts": "array"},
    "nested_tables": [{"unnested_to_table": "stream_conv_parts", "parent_key": {"id": "int"},
                       "unnested_to_table_key": ["pid"], "unnested_column": ["parts"],
                       "data_schema": {"pid": "string", "v": "int"}}],
    "full_schema": {"id": "BIGINT", "name": "STRING", "parts": [{"pid": "STRING", "v": "INT"}]},
})


def _land(spark, folder, recs):
    spark.createDataFrame([(json.dumps(r),) for r in recs], "value STRING").coalesce(1) \
        .write.mode("append").text(folder)


def test_stream_two_runs_upsert(spark):
    for t in ("stream_conv", "stream_conv_parts"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    landing_dir, bronze, ckpt = (scratch_path(spark, k) for k in ("landing", "bronze", "stream"))
    _land(spark, landing_dir, [{"id": 1, "name": "a", "parts": [{"pid": "p1", "v": 1}]},
                               {"id": 2, "name": "b", "parts": []}])
    stream_landing(spark, SPEC, landing_dir, bronze, ckpt).awaitTermination()
    _land(spark, landing_dir, [{"id": 1, "name": "a2", "parts": [{"pid": "p1", "v": 5}, {"pid": "p2", "v": 6}]}])
    stream_landing(spark, SPEC, landing_dir, bronze, ckpt).awaitTermination()   # resumes: only the new file
    main = sorted(tuple(r) for r in spark.table("stream_conv").select("id", "name").collect())
    assert main == [(1, "a2"), (2, "b")]
    parts = sorted(tuple(r) for r in spark.table("stream_conv_parts").collect())
    assert parts == [(1, "p1", 5), (1, "p2", 6)]
    b = read_bronze(spark, bronze)
    assert b.count() == 3 and b.select("load_timestamp").distinct().count() == 2


def test_replayed_batch_is_not_appended_twice(spark):
    from pyspark.sql import functions as F

    from nestlift.streaming.landing_stream import batch_runner

    for t in ("stream_conv", "stream_conv_parts"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    bronze = scratch_path(spark, "bronze")
    batch = spark.createDataFrame([(json.dumps({"id": 7, "name": "z", "parts": [{"pid": "q", "v": 1}]}),)],
                                  "raw_json STRING").select(
        "raw_json", F.lit("2024-05-01 10:00:00").cast("timestamp").alias("load_timestamp"),
        F.lit("f1").alias("source_file"))
    run = batch_runner(SPEC, bronze)
    run(batch, 3)
    run(batch, 3)            # the same batch again, as after a failure
    assert read_bronze(spark, bronze).count() == 1
    assert spark.table("stream_conv").count() == 1 and spark.table("stream_conv_parts").count() == 1


def test_stream_with_partitioned_silver(spark):
    for t in ("stream_conv", "stream_conv_parts"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    landing_dir, bronze, ckpt = (scratch_path(spark, k) for k in ("landing", "bronze", "stream"))
    _land(spark, landing_dir, [{"id": 1, "name": "a", "parts": [{"pid": "p1", "v": 1}]},
                               {"id": 2, "name": "b", "parts": [{"pid": "p9", "v": 9}]}])
    parts = {"stream_conv": ["name"], "stream_conv_parts": ["id"]}
    stream_landing(spark, SPEC, landing_dir, bronze, ckpt, partition_by=parts).awaitTermination()
    _land(spark, landing_dir, [{"id": 1, "name": "a", "parts": [{"pid": "p1", "v": 5}]}])
    stream_landing(spark, SPEC, landing_dir, bronze, ckpt, partition_by=parts).awaitTermination()
    got = sorted(tuple(r) for r in spark.table("stream_conv_parts").select("id", "pid", "v").collect())
    assert got == [(1, "p1", 5), (2, "p9", 9)]
    assert sorted(r.id for r in spark.table("stream_conv").collect()) == [1, 2]


def _fresh(spark, *folders):
    for t in ("stream_conv", "stream_conv_parts"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    return [scratch_path(spark, f) for f in folders]


def _ids(spark, path):
    return sorted(json.loads(r.raw_json).get("id", -1) for r in read_bronze(spark, path).collect())


def test_two_streams_share_a_bronze_location(spark):
    one, two, bronze, c1, c2 = _fresh(spark, "landing", "landing", "bronze", "stream", "stream")
    _land(spark, one, [{"id": 1, "name": "a"}, {"name": "no key"}])
    _land(spark, two, [{"id": 2, "name": "b"}, {"name": "no key either"}])
    stream_landing(spark, SPEC, one, bronze, c1).awaitTermination()
    stream_landing(spark, SPEC, two, bronze, c2).awaitTermination()
    assert _ids(spark, bronze) == [-1, -1, 1, 2]
    bad = spark.read.parquet(f"{bronze}_quarantine")
    assert sorted(json.loads(r.raw_json)["name"] for r in bad.collect()) == ["no key", "no key either"]


def test_a_new_checkpoint_replaces_nothing(spark):
    landing_dir, bronze, c1, c2 = _fresh(spark, "landing", "bronze", "stream", "stream")
    _land(spark, landing_dir, [{"id": 1, "name": "a"}])
    stream_landing(spark, SPEC, landing_dir, bronze, c1).awaitTermination()
    _land(spark, landing_dir, [{"id": 2, "name": "b"}])
    stream_landing(spark, SPEC, landing_dir, bronze, c1).awaitTermination()
    stream_landing(spark, SPEC, landing_dir, bronze, c2, max_files_per_trigger=10).awaitTermination()
    assert _ids(spark, bronze) == [1, 1, 2, 2]               # the new query reads all files again, as its own rows
    assert sorted(r.id for r in spark.table("stream_conv").collect()) == [1, 2]
