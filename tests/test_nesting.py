from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nestlift.functions.json import parse
from nestlift.functions.types import shape_to_struct
from nestlift.operators.unnest import unnest
from nestlift.plans import nesting
from nestlift.plans.nesting import as_records, nest
from nestlift.spec import ChildSpec

CHILD = ChildSpec(name="kids", path=("kids",), parent_keys=(("pid", "int"),), keys=(),
                  schema=(("v", "int"), ("s", "string")))
SHAPE = {"pid": "BIGINT", "kids": [{"v": "BIGINT", "s": "STRING"}]}


def _roundtrip(spark, parents, kids):
    p = spark.createDataFrame([(x,) for x in parents] or [], "pid BIGINT")
    c = spark.createDataFrame(kids or [], "pid BIGINT, v BIGINT, s STRING")
    recs = as_records(nest(p, c, ["pid"], "kids"))
    out = unnest(parse(recs, shape_to_struct(SHAPE)), CHILD, probe=False).df
    return recs, out


def test_hot_parent_is_one_record(spark):
    kids = [(1, i, f"x{i}") for i in range(2500)] + [(2, 0, "y")]
    recs, out = _roundtrip(spark, [1, 2, 3], kids)
    assert recs.count() == 3                               # one main row per parent, however many children
    assert sorted(tuple(r) for r in out.collect()) == sorted(kids)
    assert recs.filter(~F.col("raw_json").contains("kids")).count() == 1   # parent 3: key absent


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(-5, 5), st.sampled_from(["a", "b", "ü", "x.y"])),
                max_size=25))
def test_unnest_of_nest_is_identity(spark, kids):
    _, out = _roundtrip(spark, list(range(5)), kids)
    assert sorted(tuple(r) for r in out.collect()) == sorted(kids)


def test_children_are_packed_behind_their_shuffle(spark, monkeypatch):
    p = spark.createDataFrame([(1,), (2,), (None,)], "pid BIGINT")
    c = spark.createDataFrame([(1, 7, "a"), (1, 8, "b"), (None, 9, "c")], "pid BIGINT, v BIGINT, s STRING")
    monkeypatch.setattr(nesting, "ROWS_PER_TASK", 1)
    assert nesting.pack_tasks(c) is None                  # three rows: the session's eight tasks are enough
    nested = nest(p, c, ["pid"], "kids", tasks=11)
    plan = nested._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_collect_list") < plan.index("Exchange hashpartitioning(pid", plan.index("partial_collect_list"))
    assert "11), REPARTITION_BY_NUM" in plan              # nothing is packed, so nothing sorted, before the rows are dealt out
    got = {r["pid"]: r["kids"] and sorted(x["v"] for x in r["kids"]) for r in nested.collect()}
    assert got == {1: [7, 8], 2: None, None: None}
