from pyspark.sql import types as T

from nestlift.functions.json import infer_schema, parse
from nestlift.functions.types import shape_to_struct
from nestlift.operators.unnest import unnest
from nestlift.plans.silver import silver_tables
from nestlift.spec import ChildSpec, JobSpec


def child(path, keys, schema, name="c", own=()):
    return ChildSpec(name=name, path=tuple(path), parent_keys=tuple(keys.items()),
                     keys=tuple(own), schema=tuple(schema.items()))


def parsed(records, *lines):
    df = records(*lines)
    return parse(df, infer_schema(df))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def test_null_elements_empty_and_absent(spark, records):
    p = parsed(records, '{"id": "r1", "s": [{"k": 1}, null, {"k": 2}]}', '{"id": "r2", "s": []}',
               '{"id": "r3"}', '{"id": "r4", "s": null}')
    r = unnest(p, child(["s"], {"id": "string"}, {"k": "int"}))
    assert rows(r.df) == [("r1", 1), ("r1", 2), ("r1", None)]


def test_only_empty_arrays_gives_empty_table(spark, records):
    p = parsed(records, '{"id": 1, "s": []}', '{"id": 2, "s": []}')
    r = unnest(p, child(["s"], {"id": "int"}, {"k": "int"}))
    assert r.skipped is None and r.df.count() == 0


def test_only_nulls_skips_table(spark, records):
    p = parsed(records, '{"id": 1, "s": null}', '{"id": 2}')
    r = unnest(p, child(["s"], {"id": "int"}, {"k": "int"}))
    assert r.df is None and "no value" in r.skipped


def test_missing_column_and_struct_level_skip(spark, records):
    p = parsed(records, '{"id": 1, "st": {"k": 1}}')
    assert unnest(p, child(["nope"], {"id": "int"}, {"k": "int"})).skipped.endswith("not found")
    assert "not an array" in unnest(p, child(["st"], {"id": "int"}, {"k": "int"})).skipped


def test_string_level_object_and_array(spark, records):
    p = parsed(records, '{"id": 1, "js": "{\\"k\\": 5}"}', '{"id": 2, "js": "[{\\"k\\": 6}, {\\"k\\": 7}]"}')
    r = unnest(p, child(["js"], {"id": "int"}, {"k": "int"}))
    assert rows(r.df) == [(1, 5), (2, 6), (2, 7)]   # a lone object is a 1-element array


def test_string_level_of_scalars_only_corrupt(spark, records):
    p = parsed(records, '{"id": 1, "js": "[\\"a\\", \\"b\\"]"}')
    assert infer_schema(p.select("js"), "js").fieldNames() == ["_corrupt_record"]
    r = unnest(p, child(["js"], {"id": "int"}, {"k": "int"}))
    assert r.skipped is None and r.df.count() == 0   # elements are not objects: nothing parses


def test_scalar_array_level(spark, records):
    p = parsed(records, '{"id": 1, "tags": ["a", "b"]}')
    r = unnest(p, child(["tags"], {"id": "int"}, {"tags_exploded": "string", "other": "string"}))
    assert rows(r.df) == [(1, "a", None), (1, "b", None)]


def test_multi_level_keys_discovered(spark, records):
    p = parsed(records,
               '{"shelf": "s1", "boxes": [{"box": "b1", "trays": [{"tray": "t1", "coins": '
               '[{"mint": "m1", "worth": 1}, {"mint": "m2", "worth": 2}]}]}, {"box": "b2"}]}')
    c = child(["boxes", "trays", "coins"], {"shelf": "string", "box": "string", "tray": "string"},
              {"mint": "string", "worth": "int"})
    r = unnest(p, c)
    assert r.df.columns == ["shelf", "box", "tray", "mint", "worth"]
    assert rows(r.df) == [("s1", "b1", "t1", "m1", 1), ("s1", "b1", "t1", "m2", 2)]


def test_parent_key_repeated_in_child_struct(spark, records):
    p = parsed(records, '{"cid": "c1", "parts": [{"cid": "other", "pid": "p1"}]}')
    r = unnest(p, child(["parts"], {"cid": "string"}, {"pid": "string"}))
    assert rows(r.df) == [("c1", "p1")]          # the ancestor's key wins
    assert r.dropped_duplicates == ["parts.cid"]


def test_missing_parent_key_is_typed_null(spark, records):
    p = parsed(records, '{"parts": [{"pid": "p1"}]}')
    r = unnest(p, child(["parts"], {"cid": "int"}, {"pid": "string"}))
    assert r.missing_keys == ["cid"] and rows(r.df) == [(None, "p1")]
    assert r.df.schema["cid"].dataType == T.LongType()


def test_one_parse_per_child_in_plan(spark, records):
    """posexplode_outer + filter keeps a single from_json in the optimized plan."""
    df = records('{"id": 1, "a": [{"b": [{"c": 1}]}]}')
    sp = JobSpec.from_dict({
        "main_table_name": "m", "main_table_key": "id", "data_schema": {"id": "int"},
        "nested_tables": [{"unnested_to_table": "t", "parent_key": {"id": "int"},
                           "unnested_column": ["a", "b"], "data_schema": {"c": "int"}}],
        "full_schema": {"id": "BIGINT", "a": [{"b": [{"c": "INT"}]}]},
    })
    res = silver_tables(df, sp, reuse=None, probe=False)
    plan = res.tables["t"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert rows(res.tables["t"]) == [(1, 1)]


def test_declared_schema_prunes_parse(spark, records):
    df = records('{"id": 1, "wide": "x", "a": [{"b": 1, "unused": 2}]}')
    sp = JobSpec.from_dict({
        "main_table_name": "m", "main_table_key": "id", "data_schema": {"id": "int"},
        "nested_tables": [{"unnested_to_table": "t", "parent_key": {"id": "int"},
                           "unnested_column": ["a"], "data_schema": {"b": "int"}}],
        "full_schema": {"id": "BIGINT", "wide": "STRING", "a": [{"b": "INT", "unused": "INT"}]},
    })
    res = silver_tables(df, sp, only="t", reuse=None)
    assert res.parsed.schema.simpleString() == "struct<id:bigint,a:array<struct<b:int>>>"
    assert shape_to_struct(sp.full_schema) == res.record_schema


def test_skip_reason_names_the_empty_level(spark, records):
    p = parsed(records, '{"id": 1, "a": [{"b": null}]}', '{"id": 2, "a": [{"b": null}]}')
    r = unnest(p, child(["a", "b"], {"id": "int"}, {"k": "int"}))
    assert r.df is None and r.skipped.startswith("level 2") 
    p2 = parsed(records, '{"id": 1, "a": null, "z": [{"b": [1]}]}')
    r2 = unnest(p2, child(["a"], {"id": "int"}, {"k": "int"}))
    assert r2.df is None and r2.skipped.startswith("level 1")


def test_staged_fan_out_reads_only_each_tables_leaves(spark, records):
    df = records('{"id": 1, "wide": "w", "a": [{"x": "big", "b": [{"c": 1, "d": 2}]}]}')
    sp = JobSpec.from_dict({
        "main_table_name": "m", "main_table_key": "id", "data_schema": {"id": "int", "wide": "string"},
        "nested_tables": [{"unnested_to_table": "t", "parent_key": {"id": "int"},
                           "unnested_column": ["a", "b"], "data_schema": {"c": "int"}}],
        "full_schema": {"id": "BIGINT", "wide": "STRING",
                        "a": [{"x": "STRING", "b": [{"c": "INT", "d": "INT"}]}]},
    })
    res = silver_tables(df, sp, reuse="stage")
    scan = res.tables["t"]._jdf.queryExecution().sparkPlan().collectLeaves().head()
    assert scan.requiredSchema().simpleString() == "struct<id:bigint,a:array<struct<b:array<struct<c:int>>>>>"
    assert rows(res.tables["t"]) == [(1, 1)] and rows(res.tables["m"]) == [(1, "w")]


def test_drift_covers_child_tables(spark, records):
    df = records('{"id": 1, "a": [{"b": 1, "extra": 2}]}')
    sp = JobSpec.from_dict({
        "main_table_name": "m", "main_table_key": "id", "data_schema": {"id": "int", "gone": "string"},
        "nested_tables": [{"unnested_to_table": "t", "parent_key": {"id": "int"},
                           "unnested_column": ["a"], "data_schema": {"b": "int", "nope": "date"}}],
    })
    res = silver_tables(df, sp, reuse=None)
    got = sorted(tuple(r) for r in res.drift(sp).collect())
    assert got == sorted([("m", "gone", "missing", "string", None),
                          ("m", "a", "extra", None, "array<struct<b:bigint,extra:bigint>>"),
                          ("t", "nope", "missing", "date", None),
                          ("t", "extra", "extra", None, "bigint")])


def test_child_whose_declared_columns_are_all_absent(spark, records):
    df = records('{"id": 1, "a": [{"x": 1}, {"x": 2}]}')
    sp = JobSpec.from_dict({
        "main_table_name": "m", "main_table_key": "id", "data_schema": {"id": "int"},
        "nested_tables": [{"unnested_to_table": "t", "parent_key": {"id": "int"},
                           "unnested_column": ["a"], "data_schema": {"nope": "string"}}],
        "full_schema": {"id": "BIGINT", "a": [{"x": "INT"}]},
    })
    for reuse in ("stage", None):
        res = silver_tables(df, sp, only="t", reuse=reuse)
        assert rows(res.tables["t"]) == [(1, None), (1, None)]   # one row per element, typed NULLs


def test_one_huge_array_is_opened_by_many_tasks(spark):
    from pyspark.sql import functions as F

    from nestlift.operators.unnest import open_array

    rows = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id INT").select(
        "id", F.when(F.col("id") == 1, F.sequence(F.lit(1), F.lit(200_000))).when(F.col("id") == 2, F.array(F.lit(7), F.lit(None)))
        .when(F.col("id") == 3, F.array().cast("array<int>")).alias("a"))
    plain, sliced = open_array(rows, ["id"], F.col("a"), "e"), open_array(rows, ["id"], F.col("a"), "e", slice_rows=1_000)
    assert sliced.columns == plain.columns and sliced.exceptAll(plain).isEmpty() and plain.exceptAll(sliced).isEmpty()
    tasks = sliced.where("id = 1").groupBy(F.spark_partition_id().alias("t")).count().collect()
    assert len(tasks) >= 6 and max(r["count"] for r in tasks) < 80_000
    assert sliced.count() == 200_002


def test_slices_are_cut_before_rows_multiply(spark):
    from pyspark.sql import functions as F

    from nestlift.operators.unnest import open_array
    df = spark.createDataFrame([(1, [1, 2, None, 4, 5]), (2, [6]), (3, []), (4, None), (None, [7, 8, 9])], "k INT, a ARRAY<INT>")
    out = open_array(df, ["k"], F.col("a"), slice_rows=2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate posexplode(transform(sequence" in plan      # no generator hands the whole array on with each slice
    assert not any(x.lstrip(" :+-*()0123456789").startswith("Generate explode(") and "a#" in x for x in plan.splitlines())
    assert sorted(map(str, out.collect())) == sorted(map(str, open_array(df, ["k"], F.col("a")).collect()))
