import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nestlift.operators.upsert import MergeConflict, check_conflicts, merge_frames, merge_states, upsert_path, upsert_table
from nestlift.session import scratch_path

S = "k STRING, v INT"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_fixture_semantics(spark):
    t = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], S)
    s = spark.createDataFrame([("a", 9), (None, 8), ("d", 4)], S)
    assert rows(merge_frames(t, s, ["k"])) == [("a", 9), ("c", 3), ("d", 4), (None, 2), (None, 8)]
    # opt-in null-safe match: NULL matches NULL
    assert rows(merge_frames(t, s, ["k"], null_safe=True)) == [("a", 9), ("c", 3), ("d", 4), (None, 8)]


def test_composite_key_and_column_alignment(spark):
    t = spark.createDataFrame([("x", 1, "old"), ("x", 2, "keep")], "a STRING, b INT, v STRING")
    s = spark.createDataFrame([("new", 1, "x")], "v STRING, b INT, a STRING")
    assert rows(merge_frames(t, s, ["a", "b"])) == [("x", 1, "new"), ("x", 2, "keep")]


def test_conflicts(spark):
    t = spark.createDataFrame([("a", 1)], S)
    dup_match = spark.createDataFrame([("a", 2), ("a", 3)], S)
    with pytest.raises(MergeConflict):
        check_conflicts(t, dup_match, ["k"])
    dup_new = spark.createDataFrame([("z", 2), ("z", 3)], S)
    check_conflicts(t, dup_new, ["k"])   # several *new* rows with one key are fine
    assert rows(merge_frames(t, dup_new, ["k"])) == [("a", 1), ("z", 2), ("z", 3)]


def test_upsert_path_versions(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2)], S)
    v1 = upsert_path(spark, None, t, ["k"], scratch_path(spark, "t"))
    v2 = upsert_path(spark, v1, spark.createDataFrame([("b", 5), ("c", 6)], S), ["k"],
                     scratch_path(spark, "t"))
    assert rows(spark.read.parquet(v1)) == [("a", 1), ("b", 2)]     # old version untouched
    assert rows(spark.read.parquet(v2)) == [("a", 1), ("b", 5), ("c", 6)]


def test_upsert_catalog_table(spark):
    name = "upsert_catalog_t"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    upsert_table(spark, name, spark.createDataFrame([("a", 1), ("b", 2)], S), ["k"])
    upsert_table(spark, name, spark.createDataFrame([("b", 7), ("c", 3)], S), ["k"])
    assert rows(spark.table(name)) == [("a", 1), ("b", 7), ("c", 3)]
    assert not spark.catalog.tableExists(name + "__nl_next")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcdef"), st.integers(0, 9)), max_size=8),
       st.dictionaries(st.sampled_from("abcdefgh"), st.integers(0, 9), max_size=6))
def test_idempotent_for_unique_keys(spark, target, source):
    t = spark.createDataFrame(list({k: v for k, v in target}.items()) or [], S)
    s = spark.createDataFrame(list(source.items()) or [], S)
    once = merge_frames(t, s, ["k"])
    twice = merge_frames(once, s, ["k"])
    assert rows(once) == rows(twice)
    expect = {**dict(target), **source}
    assert rows(once) == sorted(expect.items())


def test_partitioned_upsert_rewrites_only_touched_partitions(spark):
    import glob
    import os

    from nestlift.operators.upsert import upsert_partitioned

    path = scratch_path(spark, "part")
    t = spark.createDataFrame([("a", 1, 2023), ("b", 2, 2023), ("c", 3, 2024)], "k STRING, v INT, y INT")
    upsert_partitioned(spark, path, t, ["k"], ["y"], exists=False)
    before = {p: os.path.getmtime(p) for p in glob.glob(f"{path}/y=2023/*.parquet")}
    s = spark.createDataFrame([("c", 30, 2024), ("d", 4, 2024)], "k STRING, v INT, y INT")
    upsert_partitioned(spark, path, s, ["k"], ["y"], scratch=scratch_path(spark, "merge"))
    after = {p: os.path.getmtime(p) for p in glob.glob(f"{path}/y=2023/*.parquet")}
    assert before == after and before                      # untouched partition: same files
    assert rows(spark.read.parquet(path).select("k", "v")) == [("a", 1), ("b", 2), ("c", 30), ("d", 4)]


def test_partitioned_upsert_prunes_the_target_scan(spark):
    from nestlift.operators.upsert import _touched_rows

    path = scratch_path(spark, "part")
    spark.createDataFrame([(i, i % 5) for i in range(50)], "k INT, y INT").write.partitionBy("y").parquet(path)
    t = spark.read.parquet(path)
    part = _touched_rows(t, spark.createDataFrame([(3,)], "y INT"), ["y"])
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "= 3" in plan.split("PartitionFilters: [")[1].split("]")[0] \
        or "<=> 3" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sorted(r.k for r in part.collect()) == [3, 8, 13, 18, 23, 28, 33, 38, 43, 48]


def test_conflict_found_during_write_is_not_published(spark):
    t = spark.createDataFrame([("a", 1)], S)
    v1 = upsert_path(spark, None, t, ["k"], scratch_path(spark, "t"))
    with pytest.raises(MergeConflict):
        upsert_path(spark, v1, spark.createDataFrame([("a", 2), ("a", 3)], S), ["k"], scratch_path(spark, "t"))
    name = "upsert_conflict_t"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    upsert_table(spark, name, t, ["k"])
    with pytest.raises(MergeConflict):
        upsert_table(spark, name, spark.createDataFrame([("a", 2), ("a", 3)], S), ["k"])
    assert rows(spark.table(name)) == [("a", 1)]          # old rows still published


def test_new_columns_are_an_error_unless_allowed(spark):
    t = spark.createDataFrame([("a", 1)], S)
    s = spark.createDataFrame([("b", 2, "x")], "k STRING, v INT, w STRING")
    with pytest.raises(ValueError, match="allow_new_columns"):
        merge_frames(t, s, ["k"])
    out = merge_frames(t, s, ["k"], allow_new_columns=True)
    assert out.columns == ["k", "v", "w"]
    assert rows(out) == [("a", 1, None), ("b", 2, "x")]


def test_partitioned_upsert_keeps_null_partitions_and_text_values(spark):
    from nestlift.operators.upsert import read_partitioned, upsert_partitioned

    path = scratch_path(spark, "part")
    shape = "k INT, v STRING, p STRING"
    upsert_partitioned(spark, path, spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "c", "001")], shape),
                       ["k"], ["p"], exists=False)
    upsert_partitioned(spark, path, spark.createDataFrame([(1, "A", None), (3, "C", "001")], shape), ["k"], ["p"])
    assert rows(read_partitioned(spark, path)) == [(1, "A", None), (2, "b", None), (3, "C", "001")]
    upsert_partitioned(spark, path, spark.createDataFrame([(2, "B", None)], shape), ["k"], ["p"])   # NULL only
    assert rows(read_partitioned(spark, path)) == [(1, "A", None), (2, "B", None), (3, "C", "001")]


def test_moved_key_is_refused_before_any_write(spark):
    from nestlift.operators.upsert import PartitionMove, read_partitioned, upsert_partitioned

    path = scratch_path(spark, "part")
    shape = "k INT, v STRING, p INT"
    upsert_partitioned(spark, path, spark.createDataFrame([(1, "a", 1)], shape), ["k"], ["p"], exists=False)
    with pytest.raises(PartitionMove):
        upsert_partitioned(spark, path, spark.createDataFrame([(1, "b", 2)], shape), ["k"], ["p"])
    assert rows(read_partitioned(spark, path)) == [(1, "a", 1)]


def test_added_column_is_there_afterwards(spark):
    from nestlift.operators.upsert import read_partitioned, upsert_partitioned

    wide = spark.createDataFrame([(3, "c", 7, 2)], "k INT, v STRING, n INT, p INT")
    narrow = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k INT, v STRING, p INT")
    path = scratch_path(spark, "part")
    upsert_partitioned(spark, path, narrow, ["k"], ["p"], exists=False)
    upsert_partitioned(spark, path, wide, ["k"], ["p"], allow_new_columns=True)
    got = read_partitioned(spark, path).select("k", "v", "n", "p")
    assert rows(got) == [(1, "a", None, 1), (2, "b", None, 2), (3, "c", 7, 2)]
    spark.sql("DROP TABLE IF EXISTS added_column_t")
    upsert_partitioned(spark, "added_column_t", narrow, ["k"], ["p"], as_table=True)
    upsert_partitioned(spark, "added_column_t", wide, ["k"], ["p"], as_table=True, allow_new_columns=True)
    assert rows(spark.table("added_column_t").select("k", "v", "n", "p")) == rows(got)


def test_interrupted_swap_recovers(spark):
    from nestlift.operators.upsert import recover

    name = "swap_t"
    for x in ("", "__nl_prev", "__nl_next"):
        spark.sql(f"DROP TABLE IF EXISTS {name}{x}")
    upsert_table(spark, name, spark.createDataFrame([("a", 1), ("b", 2)], S), ["k"])
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__nl_prev")        # stopped after the first rename
    upsert_table(spark, name, spark.createDataFrame([("b", 9)], S), ["k"])
    assert rows(spark.table(name)) == [("a", 1), ("b", 9)]
    spark.sql(f"CREATE TABLE {name}__nl_prev AS SELECT * FROM {name}")  # stopped before the old table was dropped
    recover(spark, name)
    assert rows(spark.table(name)) == [("a", 1), ("b", 9)] and not spark.catalog.tableExists(f"{name}__nl_prev")


def test_swap_keeps_the_tables_partitioning(spark):
    spark.sql("DROP TABLE IF EXISTS swap_part_t")
    spark.createDataFrame([("a", 1)], S).write.partitionBy("v").saveAsTable("swap_part_t")
    upsert_table(spark, "swap_part_t", spark.createDataFrame([("b", 2)], S), ["k"])
    assert [c.name for c in spark.catalog.listColumns("swap_part_t") if c.isPartition] == ["v"]
    assert rows(spark.table("swap_part_t")) == [("a", 1), ("b", 2)]


def _files(path):
    import glob
    import os
    return {p: os.path.getmtime(p) for p in glob.glob(f"{path}/**/*.parquet", recursive=True)}


PARTED = "p STRING, k INT, v INT, y INT"


def test_only_changed_partitions_are_written(spark):
    from nestlift.operators.upsert import read_partitioned, upsert_partitioned

    path = scratch_path(spark, "part")
    first = [("a", 1, 1, 1), ("a", 2, 2, 2), ("b", 3, 3, 3), ("c", 4, 4, None), ("d", None, 5, 1)]
    upsert_partitioned(spark, path, spark.createDataFrame(first, PARTED), ["p", "k"], ["y"], exists=False)
    before, seen = _files(path), {}
    same = spark.createDataFrame(first[:4], PARTED)
    upsert_partitioned(spark, path, same, ["p", "k"], ["y"], changes=seen)
    assert _files(path) == before and seen == {"inserted": 0, "updated": 0, "unchanged": 4, "deleted": 0}
    load = spark.createDataFrame([("a", 1, 1, 1), ("a", 2, 20, 2), ("c", 4, 4, None)], PARTED)
    upsert_partitioned(spark, path, load, ["p", "k"], ["y"], changes=seen)
    after = _files(path)
    assert {p.split("/")[-2] for p in set(before) - set(after)} == {"y=2"}
    assert seen == {"inserted": 0, "updated": 1, "unchanged": 2, "deleted": 0}
    assert rows(read_partitioned(spark, path).where("y = 2").select("p", "k", "v")) == [("a", 2, 20)]


@pytest.mark.parametrize("as_table", [False, True])
def test_children_of_loaded_parents_are_replaced(spark, as_table):
    from nestlift.operators.upsert import Scope, read_partitioned, upsert_partitioned

    path = "scope_t" if as_table else scratch_path(spark, "part")
    spark.sql("DROP TABLE IF EXISTS scope_t")
    first = [("a", 1, 1, 1), ("a", 2, 2, 2), ("a", None, 9, 2), ("b", 1, 1, 1), ("c", 1, 1, 4), (None, 1, 7, 2)]
    upsert_partitioned(spark, path, spark.createDataFrame(first, PARTED), ["p", "k"], ["y"], exists=False, as_table=as_table)
    load = spark.createDataFrame([("a", 1, 10, 1), ("a", 3, 3, 3), ("a", None, 8, 1)], PARTED)
    parents = spark.createDataFrame([("a",), ("c",), (None,), ("new",)], "p STRING")
    seen = {}
    upsert_partitioned(spark, path, load, ["p", "k"], ["y"], as_table=as_table, scope=Scope(["p"], parents), changes=seen)
    got = spark.table(path) if as_table else read_partitioned(spark, path)
    assert sorted((tuple(r) for r in got.select("p", "k", "v", "y").collect()), key=str) == sorted(
        [("a", 1, 10, 1), ("a", 3, 3, 3), ("a", None, 8, 1), ("b", 1, 1, 1), (None, 1, 7, 2)], key=str)
    assert seen == {"inserted": 2, "updated": 1, "unchanged": 0, "deleted": 3}
    with pytest.raises(MergeConflict):
        upsert_partitioned(spark, path, load.union(load), ["p", "k"], ["y"], as_table=as_table, scope=Scope(["p"]))


def test_scope_in_versions_and_swapped_tables(spark):
    from nestlift.operators.upsert import Scope, stage_table

    shape = "p STRING, k INT, v INT"
    first = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 1, 1)], shape)
    load, want = spark.createDataFrame([("a", 2, 2)], shape), [("a", 2, 2), ("b", 1, 1)]
    v1 = upsert_path(spark, None, first, ["p", "k"], scratch_path(spark, "t"))
    seen = {}
    v2 = upsert_path(spark, v1, load, ["p", "k"], scratch_path(spark, "t"), scope=Scope(["p"]), changes=seen)
    assert rows(spark.read.parquet(v2)) == want and seen == {"inserted": 0, "updated": 0, "unchanged": 1, "deleted": 1}
    assert upsert_path(spark, v2, load, ["p", "k"], scratch_path(spark, "t"), scope=Scope(["p"])) == v2      # nothing changed
    with pytest.raises(ValueError, match="part of the key"):
        upsert_path(spark, v2, load, ["p", "k"], scratch_path(spark, "t"), scope=Scope(["v"]))
    spark.sql("DROP TABLE IF EXISTS scope_swap_t")
    upsert_table(spark, "scope_swap_t", first, ["p", "k"])
    stage_table(spark, "scope_swap_t", load, ["p", "k"], scope=Scope(["p"]))()
    assert rows(spark.table("scope_swap_t")) == want


def test_null_moved_between_columns_is_a_change(spark):
    shape = "k INT, a STRING, b STRING"
    v1 = upsert_path(spark, None, spark.createDataFrame([(1, "x", None), (2, None, None)], shape), ["k"], scratch_path(spark, "t"))
    seen = {}
    upsert_path(spark, v1, spark.createDataFrame([(1, None, "x"), (2, None, None), (3, "n", "n")], shape), ["k"],
                scratch_path(spark, "t"), changes=seen)
    assert seen == {"inserted": 1, "updated": 1, "unchanged": 1, "deleted": 0}


def test_merge_states_agree_with_a_simple_merge(spark):
    from nestlift.operators.upsert import _STATE, DELETED, Scope, merge_states

    import random
    rnd = random.Random(2)
    row = lambda n: [(rnd.choice("abc"), rnd.choice([1, 2, 3, None]), rnd.randint(0, 1)) for _ in range(n)]
    shape = "p STRING, k INT, v INT"
    for _ in range(3):
        t = list({r[:2]: r for r in row(6)}.values())
        s = list({r[:2]: r for r in row(4)}.values())
        tf, sf = spark.createDataFrame(t, shape), spark.createDataFrame(s, shape)
        out, _ = merge_states(tf, sf, ["p", "k"])
        assert rows2(out.filter(f"{_STATE} <> '{DELETED}'").drop(_STATE)) == rows2(merge_frames(tf, sf, ["p", "k"]))
        out, _ = merge_states(tf, sf, ["p", "k"], scope=Scope(["p"]))
        loaded = {r[0] for r in s}
        assert rows2(out.filter(f"{_STATE} <> '{DELETED}'").drop(_STATE)) == sorted([r for r in t if r[0] not in loaded] + s, key=str)


def rows2(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_target_partitions_are_pruned_at_run_time(spark):
    import glob

    from nestlift.operators.upsert import _touched_rows, read_partitioned, upsert_partitioned

    path = scratch_path(spark, "part")
    frame = spark.createDataFrame([(i, i, i % 50 if i % 50 else None) for i in range(500)], "k INT, v INT, y INT")
    upsert_partitioned(spark, path, frame, ["k"], ["y"], exists=False)
    load = spark.createDataFrame([(3, 30, 3), (47, 470, 47), (50, 5, None)], "k INT, v INT, y INT")
    part = _touched_rows(read_partitioned(spark, path), load, ["y"], scratch_path(spark, "touched"))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "isnull(y" in plan
    assert part.count() == 30
    for p in glob.glob(f"{path}/y=*/*.parquet"):                     # no file of another partition can be read any more
        if p.split("/")[-2] not in ("y=3", "y=47", "y=__HIVE_DEFAULT_PARTITION__"):
            with open(p, "wb") as f:
                f.write(b"not parquet")
    upsert_partitioned(spark, path, load, ["k"], ["y"], fixed_partitions=True)
    got = read_partitioned(spark, path).where("y in (3, 47) or y is null")
    assert sorted(r.v for r in got.where("k in (3, 47, 50)").collect()) == [5, 30, 470] and got.count() == 30


def test_touched_rows_of_two_partition_columns_with_nulls(spark):
    from nestlift.operators.upsert import _touched_rows

    path = scratch_path(spark, "part")
    every = [(10 * a + b, a if a else None, str(b) if b else None) for a in range(4) for b in range(4)]
    spark.createDataFrame(every, "k INT, a INT, b STRING").write.partitionBy("a", "b").parquet(path)
    t = spark.read.schema("k INT, a INT, b STRING").parquet(path)
    touched = [(1, "2"), (None, "1"), (3, None), (None, None), (2, "2")]
    got = _touched_rows(t, spark.createDataFrame(touched, "a INT, b STRING"), ["a", "b"])
    assert sorted(r.k for r in got.collect()) == [0, 1, 12, 22, 30]


def test_value_hashes_do_not_travel(spark):
    t = spark.createDataFrame([("a", 1), ("c", 3)], S)
    plan = merge_states(t, spark.createDataFrame([("a", 9)], S), ["k"])[0]._jdf.queryExecution().executedPlan().toString()
    assert "xxhash64" in plan[:plan.index("Exchange hashpartitioning")]       # worked out above the only shuffle
    assert "xxhash64" not in plan[plan.index("Exchange hashpartitioning"):]


def test_versions_are_packed(spark):
    v = upsert_path(spark, None, spark.createDataFrame([("a", 1)], S), ["k"], scratch_path(spark, "silver"))
    assert spark.read.format("binaryFile").load(v).where("path like '%.zstd.parquet'").count() >= 1


def test_a_new_partitioned_table_is_written_once(spark):
    import glob
    import os

    from nestlift.operators.upsert import FEW_PARTITIONS, read_partitioned, stage_partitioned
    for parts in (3, FEW_PARTITIONS + 5):
        path = scratch_path(spark, "silver")
        df = spark.range(200).selectExpr("id", f"if(id % {parts} = 0, null, id % {parts}) as p", "'x' as v")
        publish = stage_partitioned(spark, path, df, ["id"], ["p"], exists=False)
        files = lambda root: {os.path.basename(f) for f in glob.glob(f"{root}/**/*.parquet", recursive=True)}
        staged = files(os.path.dirname(path))
        assert staged and not os.path.exists(path)
        assert publish() == path and files(path) <= staged and files(path)
        assert not glob.glob(f"{os.path.dirname(path)}/_{os.path.basename(path)}*")
        assert {tuple(r) for r in read_partitioned(spark, path).select("id", "p", "v").collect()} == {tuple(r) for r in df.collect()}


def test_changed_partitions_are_written_once(spark):
    import glob
    import os

    from nestlift.operators.upsert import read_partitioned, stage_partitioned, upsert_partitioned
    path, shape = scratch_path(spark, "silver"), "id INT, p STRING, q INT, v INT"
    parent, name = os.path.split(path)
    files = lambda root: {f[len(root) + 1:] for f in glob.glob(f"{root}/**/*.parquet", recursive=True)}
    beside = lambda: glob.glob(f"{parent}/_{name}__nl_next-*")
    got = lambda: rows(read_partitioned(spark, path).select("id", "p", "q", "v"))
    first = [(1, "001", 1, 1), (2, "a=/b", 1, 2), (3, None, None, 3), (4, None, None, 4), (5, "a=/b", 1, 5)]
    upsert_partitioned(spark, path, spark.createDataFrame(first, shape), ["id"], ["p", "q"], exists=False)
    before = files(path)
    load = spark.createDataFrame([(1, "001", 1, 1), (2, "a=/b", 1, 20), (3, None, None, 30), (6, "", 9, 6)], shape)
    publish = stage_partitioned(spark, path, load, ["id"], ["p", "q"])
    staged = files(*beside())
    assert files(path) == before and got() == rows(spark.createDataFrame(first, shape))      # nothing is published yet
    assert publish() == path and not beside()
    same = {f for f in before if "p=001" in f}
    assert same and files(path) == same | {f for f in staged if "p=001" not in f}             # these files, not copies of them
    want = [(1, "001", 1, 1), (2, "a=/b", 1, 20), (3, None, None, 30), (4, None, None, 4), (5, "a=/b", 1, 5), (6, None, 9, 6)]
    assert got() == sorted(want, key=str)
    after = files(path)
    again = load.where("id < 6")
    assert stage_partitioned(spark, path, again, ["id"], ["p", "q"])() == path and files(path) == after and not beside()
    with pytest.raises(MergeConflict):
        stage_partitioned(spark, path, again.unionByName(again), ["id"], ["p", "q"])
    assert files(path) == after and not beside()


def test_a_few_emptied_partitions_go(spark):
    import glob

    from nestlift.operators.upsert import Scope, read_partitioned, upsert_partitioned
    path = scratch_path(spark, "silver")
    upsert_partitioned(spark, path, spark.createDataFrame([("a", 1, 1, 1), ("a", 2, 1, 2), ("b", 1, 1, 1)], PARTED), ["p", "k"], ["y"],
                       exists=False)
    seen = {}
    upsert_partitioned(spark, path, spark.createDataFrame([("a", 1, 1, 1)], PARTED), ["p", "k"], ["y"], scope=Scope(["p"]), changes=seen)
    assert seen == {"inserted": 0, "updated": 0, "unchanged": 1, "deleted": 1}
    assert rows(read_partitioned(spark, path).select("p", "k")) == [("a", 1), ("b", 1)] and not glob.glob(f"{path}/y=2")
