import pytest
from pyspark.sql import types as T

from nestlift.functions.types import merge_needs, prune, resolve, shape_to_ddl, shape_to_struct


@pytest.mark.parametrize("word,out,js", [
    ("array", T.StringType(), True),
    ("struct", T.StringType(), True),
    ("array<date>", T.StringType(), True),          # rule 1 wins over rule 3
    ("timestamp", T.TimestampType(), False),
    ("timestamp_ntz", T.TimestampType(), False),    # substring -> zoned TIMESTAMP
    ("DateTime", T.TimestampType(), False),
    ("date", T.DateType(), False),
    ("boolean", T.BooleanType(), False),
    ("bool", T.StringType(), False),                # not a rule: falls to STRING
    ("int", T.LongType(), False),
    (" Long ", T.LongType(), False),
    ("integer", T.StringType(), False),             # 'equals' rule, not substring
    ("bigint", T.StringType(), False),
    ("double", T.DoubleType(), False),
    ("float", T.DoubleType(), False),
    ("currency", T.DecimalType(20, 2), False),
    ("decimal(10,2)", T.StringType(), False),
    ("string", T.StringType(), False),
    ("anything", T.StringType(), False),
])
def test_type_rules(word, out, js):
    assert resolve(word) == (out, js)


def test_shape_to_ddl():
    shape = {"a": "BIGINT", "b": [{"c": "STRING", "d": ["INT"]}], "e": {"f.g": "TIMESTAMP"}}
    ddl = shape_to_ddl(shape)
    assert ddl == "STRUCT<`a`: BIGINT, `b`: ARRAY<STRUCT<`c`: STRING, `d`: ARRAY<INT>>>, `e`: STRUCT<`f.g`: TIMESTAMP>>"


def test_shape_to_struct(spark):
    st = shape_to_struct({"a": "BIGINT", "b": [{"c": "STRING"}], "d.e": "ARRAY<STRING>"})
    assert st.simpleString() == "struct<a:bigint,b:array<struct<c:string>>,d.e:array<string>>"
    with pytest.raises(ValueError):
        shape_to_ddl([{"a": "INT"}, {"b": "INT"}])


def test_prune_keeps_only_needed(spark):
    st = shape_to_struct({"k": "BIGINT", "x": "STRING", "arr": [{"a": "INT", "b": "INT", "n": [{"z": "INT", "w": "INT"}]}]})
    need = merge_needs({"k": True, "arr": {"a": True}}, {"arr": {"n": {"z": True}}})
    assert prune(st, need).simpleString() == "struct<k:bigint,arr:array<struct<a:int,n:array<struct<z:int>>>>>"
    assert prune(st, True) == st
