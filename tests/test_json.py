from pyspark.sql import types as T

from nestlift.functions.json import CORRUPT, _kinds, infer_schema, parse, split_corrupt


def test_mixed_types_infer_string(spark, records):
    df = records('{"a": 1}', '{"a": "x"}', '{"b": null}', '{"c": []}')
    st = infer_schema(df)
    assert st["a"].dataType == T.StringType()
    assert st["b"].dataType == T.StringType()          # all-NULL -> STRING
    assert st["c"].dataType == T.ArrayType(T.StringType())  # only [] seen -> array<string>


def test_late_fields_kept(spark, records):
    df = records(*(['{"a": 1}'] * 50 + ['{"a": 2, "late": true}']))
    assert infer_schema(df)["late"].dataType == T.BooleanType()


def test_malformed_row_and_quarantine(spark, records):
    df = records('{"a": 1}', '{"a": 2', '{"a": 3}')
    st = infer_schema(df)
    assert CORRUPT in st.fieldNames()   # parity: inference reports the bad row
    clean = T.StructType([T.StructField("a", T.LongType())])
    parsed = parse(df, clean, corrupt_column=CORRUPT)
    good, bad = split_corrupt(parsed)
    assert sorted(r.a for r in good.collect()) == [1, 3]
    assert [r[CORRUPT] for r in bad.collect()] == ['{"a": 2']
    # without quarantine a bad row is an all-NULL record
    assert sorted((r.a for r in parse(df, clean).collect()), key=lambda v: (v is None, v)) == [1, 3, None]


def test_parse_keeps_columns(spark):
    df = spark.createDataFrame([("{\"x\": 1}", "f1")], "raw_json STRING, source_file STRING")
    out = parse(df, T.StructType([T.StructField("x", T.LongType())]), keep=("source_file",))
    assert out.columns == ["source_file", "x"] and tuple(out.first()) == ("f1", 1)


def test_inference_of_multiline_values_and_odd_names(spark, records):
    df = records('{"a": 1,\n "b": [1, 2.5]}', '{"c": {"d": "x\\ny"}, "OBJECT<x`y": 3, "e": {}}')
    st = infer_schema(df)
    assert st.fieldNames() == ["OBJECT<x`y", "a", "b", "c"]       # nothing to store in e
    assert st["b"].dataType == T.ArrayType(T.DoubleType()) and st["OBJECT<x`y"].dataType == T.LongType()


def test_inference_agrees_with_the_json_reader(spark, records, tmp_path):
    lines = ['{"a": 1, "b": [{"x": 1.5}, {"y": true}]}', '{"a": "s", "b": null, "n": {"m": [[1], [2]]}}']
    (tmp_path / "x.json").write_text("\n".join(lines))
    assert infer_schema(records(*lines)) == spark.read.json(str(tmp_path / "x.json")).schema


def test_inference_without_values(spark, records):
    assert infer_schema(records("{}").limit(0)).fields == []
    arrays = records('[{"k": 1}, {"k": 2, "m": "s"}]', '{"k": 3}')
    assert infer_schema(arrays).fieldNames() == ["k", "m"]


def test_inference_parses_each_value_once(records):
    df = records('{"a":1}', ' [{"b":2},null]', "x", None)
    plan = _kinds(df, "raw_json")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1 and plan.count("schemaOfVariant,") <= 1
    assert infer_schema(df).fieldNames() == ["_corrupt_record", "a", "b"]
