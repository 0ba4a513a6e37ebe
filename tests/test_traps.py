"""Remaining traps: casts (T9), session zone (T10), dotted names (T16, T17)."""

import datetime as dt

from nestlift.functions.json import infer_schema, parse
from nestlift.operators.enforce import enforce
from nestlift.operators.unnest import unnest
from nestlift.operators.upsert import merge_frames
from nestlift.spec import ChildSpec


def test_scalar_cast_texts(spark):
    df = spark.createDataFrame([("true", "2024-03-01", "2024-03-01T10:20:30", "12.345", "x")],
                               "b STRING, d STRING, t STRING, c STRING, bad STRING")
    r = enforce(df, {"b": "boolean", "d": "date", "t": "timestamp", "c": "currency", "bad": "boolean"}).first()
    assert r.b is True and r.d == dt.date(2024, 3, 1) and r.t == dt.datetime(2024, 3, 1, 10, 20, 30)
    assert str(r.c) == "12.35" and r.bad is None


def test_zoneless_text_uses_session_zone(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00",)], "t STRING")
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        utc = enforce(df, {"t": "timestamp"}).selectExpr("unix_seconds(t) AS s").first().s
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        tokyo = enforce(df, {"t": "timestamp"}).selectExpr("unix_seconds(t) AS s").first().s
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert utc - tokyo == 9 * 3600


def test_dotted_names_through_unnest_and_upsert(spark, records):
    df = records('{"conv.id": "c1", "my.parts": [{"p.id": "p1", "v": 1}]}')
    p = parse(df, infer_schema(df))
    c = ChildSpec(name="t", path=("my.parts",), parent_keys=(("conv.id", "string"),),
                  keys=("p.id",), schema=(("p.id", "string"), ("v", "int")))
    out = unnest(p, c).df
    assert out.columns == ["conv.id", "p.id", "v"] and tuple(out.first()) == ("c1", "p1", 1)
    src = spark.createDataFrame([("c1", "p1", 9)], "`conv.id` STRING, `p.id` STRING, v BIGINT")
    merged = merge_frames(out, src, ["conv.id", "p.id"])
    assert [tuple(r) for r in merged.collect()] == [("c1", "p1", 9)]
