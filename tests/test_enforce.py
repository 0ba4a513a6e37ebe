import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from nestlift.functions.json import to_json_text
from nestlift.operators.enforce import SchemaConflict, drift, enforce, enforce_strings


def test_typed_missing_extra_order(spark):
    df = spark.createDataFrame([(1, "2024-01-02T03:04:05", "x", 2.5, "true")],
                               "id BIGINT, ts STRING, extra STRING, amt DOUBLE, flag STRING")
    out = enforce(df, {"flag": "boolean", "id": "int", "ts": "timestamp", "day": "date",
                       "amt": "currency", "gone": "double"})
    assert out.columns == ["flag", "id", "ts", "day", "amt", "gone"]
    assert [f.dataType.simpleString() for f in out.schema.fields] == [
        "boolean", "bigint", "timestamp", "date", "decimal(20,2)", "double"]
    r = out.first()
    assert r.flag is True and r.id == 1 and r.ts == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert r.day is None and r.amt == Decimal("2.50") and r.gone is None


def test_bad_text_becomes_null(spark):
    df = spark.createDataFrame([("abc",), ("1.9",), ("7",)], "v STRING")
    got = [r.v for r in enforce(df, {"v": "long"}).collect()]
    assert got == [None, None, 7]


def test_complex_to_json_and_struct_as_string(spark):
    df = spark.sql("""SELECT array(named_struct('a', 1, 'b', CAST(NULL AS INT)), NULL) AS arr,
                             named_struct('k', 1) AS st, array() AS empty, 'plain' AS s""")
    out = enforce(df, {"arr": "array", "st": "string", "empty": "array<int>", "s": "struct"}).first()
    assert out.arr == '[{"a":1},null]'   # NULL struct field dropped, NULL element kept
    assert out.st == "{1}"               # declared string on a struct: display cast
    assert out.empty == "[]"
    assert out.s == "plain"              # declared complex, actual text: cast to string


def test_scalar_declared_on_array_is_an_error(spark):
    df = spark.sql("SELECT array(1, 2) AS a")
    with pytest.raises(SchemaConflict):
        enforce(df, {"a": "int"})


def test_case_colliding_columns_rejected(spark):
    df = spark.sql("SELECT 1 AS Id, 2 AS id_other").withColumnRenamed("id_other", "id")
    with pytest.raises(SchemaConflict):
        enforce(df, {"Id": "int"})


def test_exact_case_presence(spark):
    df = spark.sql("SELECT 5 AS id")
    r = enforce(df, {"Id": "int"}).first()
    assert r.Id is None   # exact-case test: 'Id' is absent, even though Spark would resolve it


def test_dotted_names(spark):
    df = spark.sql("SELECT 3 AS `a.b`")
    assert enforce(df, {"a.b": "int"}).first()[0] == 3


def test_enforce_strings(spark):
    df = spark.sql("SELECT 1 AS a, 'x' AS b")
    out = enforce_strings(df, ["b", "c", "a"])
    assert out.columns == ["b", "c", "a"]
    assert out.schema["c"].dataType.simpleString() == "string"
    assert out.schema["a"].dataType.simpleString() == "int"


def test_microsecond_timestamps_in_json(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:07.179575' AS t")
    assert df.select(F.to_json(F.struct("t")).alias("j")).first().j == '{"t":"2024-01-01T00:00:07.179"}'
    assert df.select(to_json_text(F.struct("t")).alias("j")).first().j == '{"t":"2024-01-01T00:00:07.179575"}'


def test_drift_report(spark):
    df = spark.sql("SELECT 1 AS a, 'x' AS extra1")
    rows = drift(spark, [("t", df.schema, {"a": "int", "b": "string"})]).collect()
    assert [tuple(r) for r in rows] == [("t", "b", "missing", "string", None),
                                        ("t", "extra1", "extra", None, "string")]


def test_uncastable_pairs_become_typed_nulls(spark):
    from nestlift.operators.enforce import castable, drift_rows
    from pyspark.errors import AnalysisException
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    df = spark.createDataFrame([(5, True)], "n BIGINT, b BOOLEAN")
    out = enforce(df, {"n": "date", "b": "timestamp"})
    assert [tuple(r) for r in out.collect()] == [(None, None)] and dict(out.dtypes) == {"n": "date", "b": "timestamp"}
    assert [(r[1], r[2]) for r in drift_rows("t", df.schema, {"n": "date", "b": "timestamp"})] == [("n", "type"), ("b", "type")]
    kinds = [T.LongType(), T.DoubleType(), T.DecimalType(20, 2), T.BooleanType(), T.DateType(), T.TimestampType(), T.StringType()]
    for a in kinds:
        frame = spark.createDataFrame([], T.StructType([T.StructField("x", a)]))
        for b in kinds:
            try:
                frame.select(F.col("x").try_cast(b)).schema
                ok = True
            except AnalysisException:
                ok = False
            assert castable(a, b) == ok, (a, b)
