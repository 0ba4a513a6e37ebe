from nestlift.plans.run import backfill, ingest
from nestlift.session import scratch_path
from nestlift.sources.bronze import write_landing
from nestlift.spec import JobSpec

SPEC = JobSpec.from_dict({
    "main_table_name": "m", "main_table_key": "id",
    "data_schema": {"id": "int", "name": "string"},
    "nested_tables": [{"unnested_to_table": "kids", "parent_key": {"id": "int"},
                       "unnested_to_table_key": ["kid"], "unnested_column": ["kids"],
                       "data_schema": {"kid": "string"}}],
    "full_schema": {"id": "BIGINT", "name": "STRING", "kids": [{"kid": "STRING"}]},
})


def test_ingest_then_backfill(spark, records):
    bronze, root = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    l1 = write_landing(records('{"id": 1, "name": "a", "kids": [{"kid": "x"}]}', '{"id": 2, "name": "b"}'),
                       scratch_path(spark, "landing"))
    r1 = ingest(spark, SPEC, l1, "2024-01-01T00:00:00Z", bronze, root)
    assert r1.rows == {"m": 2, "kids": 1}        # counted by observe during the writes
    l2 = write_landing(records('{"id": 1, "name": "a2", "kids": [{"kid": "y"}]}'), scratch_path(spark, "landing"))
    r2 = ingest(spark, SPEC, l2, "2024-01-02T00:00:00Z", bronze, root, r1.versions)
    m = sorted(tuple(r) for r in spark.read.parquet(r2.versions["m"]).collect())
    assert m == [(1, "a2"), (2, "b")]
    kids = sorted(tuple(r) for r in spark.read.parquet(r2.versions["kids"]).collect())
    assert kids == [(1, "x"), (1, "y")]          # children removed upstream persist (no delete)
    # rebuild the child table from the first load only
    r3 = backfill(spark, SPEC, bronze, "2024-01-01T00:00:00Z", "2024-01-01T23:59:59Z",
                  scratch_path(spark, "silver"), only="kids")
    assert list(r3.versions) == ["kids"] and r3.rows == {"kids": 1}


def test_ingest_pages_gate(spark):
    import datetime as dt

    import pytest

    from nestlift.plans.run import IncompleteLanding, ingest_pages

    spec = JobSpec.from_dict({
        "main_table_name": "m", "main_table_key": "id", "data": "items", "pages": "total",
        "PAGE_SIZE": 2, "data_schema": {"id": "int"}, "full_schema": {"id": "BIGINT"},
    })
    w = dt.datetime(2024, 1, 1)
    pages = [(w, 1, '{"total": 3, "items": [{"id": 1}, {"id": 2}]}'),
             (w, 2, '{"total": 3, "items": [{"id": 3}]}')]
    env = spark.createDataFrame(pages, "window_start TIMESTAMP, page INT, body STRING")
    with pytest.raises(IncompleteLanding):
        ingest_pages(spark, spec, env.filter("page = 1"), "2024-01-02T00:00:00Z",
                     scratch_path(spark, "bronze"), scratch_path(spark, "silver"))
    run = ingest_pages(spark, spec, env, "2024-01-02T00:00:00Z",
                       scratch_path(spark, "bronze"), scratch_path(spark, "silver"))
    assert sorted(r.id for r in spark.read.parquet(run.versions["m"]).collect()) == [1, 2, 3]
    assert run.rows == {"m": 3}


def test_summary_and_preview(spark, records):
    from nestlift.plans.report import preview, summary

    bronze, root = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    lines = [f'{{"id": {i}, "name": "n{i}", "kids": [{{"kid": "k{i}"}}]}}' for i in range(15)]
    run = ingest(spark, SPEC, write_landing(records(*lines), scratch_path(spark, "landing")),
                 "2024-01-01T00:00:00Z", bronze, root)
    s = {r["table"]: (r.rows, r.cols) for r in summary(spark, run.versions).collect()}
    assert s == {"m": (15, 2), "kids": (15, 2)}
    p = preview(spark, run.versions, n=10).collect()
    assert sum(1 for r in p if r["table"] == "m") == 10 and all(r.row.startswith("{") for r in p)


def test_rerun_of_a_load_and_last_load_wins(spark, records):
    bronze, root = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    l1 = write_landing(records('{"id": 1, "name": "old", "kids": [{"kid": "x"}]}', '{"id": 2, "name": "b"}'),
                       scratch_path(spark, "landing"))
    l2 = write_landing(records('{"id": 1, "name": "new", "kids": [{"kid": "y"}]}'), scratch_path(spark, "landing"))
    first = ingest(spark, SPEC, l1, "2024-01-01T00:00:00Z", bronze, root)
    again = ingest(spark, SPEC, l1, "2024-01-01T00:00:00Z", bronze, root, first.versions)
    assert spark.read.parquet(bronze).count() == 2 and spark.read.parquet(again.versions["m"]).count() == 2
    ingest(spark, SPEC, l2, "2024-01-02T00:00:00Z", bronze, root, again.versions)
    built = backfill(spark, SPEC, bronze, "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z", scratch_path(spark, "silver"))
    assert sorted(tuple(r) for r in spark.read.parquet(built.versions["m"]).collect()) == [(1, "new"), (2, "b")]
    assert [tuple(r) for r in spark.read.parquet(built.versions["kids"]).collect()] == [(1, "y")]


def test_bad_records_are_set_aside(spark, records):
    root = scratch_path(spark, "silver")
    text = write_landing(records('{"id": 1, "name": "a"}', '{"id": 2, "na', '{"name": "no key"}'), scratch_path(spark, "landing"))
    run = ingest(spark, SPEC, text, "2024-01-01T00:00:00Z", scratch_path(spark, "bronze"), root)
    assert [tuple(r) for r in spark.read.parquet(run.versions["m"]).collect()] == [(1, "a")]
    assert run.quarantined == 2
    assert sorted(r.reason for r in spark.read.parquet(run.quarantine).collect()) == ["malformed", "no_key"]


def test_scratch_is_removed_and_quiet_day_gives_empty_tables(spark, records):
    import os

    from nestlift.plans.silver import silver_tables

    spec = JobSpec.from_dict({"main_table_name": "q", "main_table_key": "id", "data_schema": {"id": "int", "n": "string"}})
    res = silver_tables(records('{"id": 1}').limit(0), spec)
    assert res.tables["q"].count() == 0 and res.tables["q"].columns == ["id", "n"]
    staged = res._paths[0].removeprefix("file:")
    assert os.path.isdir(staged)
    res.release()
    assert not os.path.exists(staged)


def test_conflict_in_one_table_changes_none(spark, records):
    import pytest

    from nestlift.operators.upsert import MergeConflict
    from nestlift.plans.run import upsert_all_tables

    spec = JobSpec.from_dict({**{"main_table_name": "all_m", "main_table_key": "id", "data_schema": {"id": "int", "v": "int"}},
                              "nested_tables": [{"unnested_to_table": "all_k", "parent_key": {"id": "int"},
                                                 "unnested_to_table_key": ["kid"], "unnested_column": ["kids"],
                                                 "data_schema": {"kid": "string"}}]})
    for t in ("all_m", "all_k"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    m = spark.createDataFrame([(1, 1)], "id BIGINT, v BIGINT")
    k = spark.createDataFrame([(1, "x")], "id BIGINT, kid STRING")
    upsert_all_tables(spark, spec, {"all_m": m, "all_k": k})
    with pytest.raises(MergeConflict):
        upsert_all_tables(spark, spec, {"all_m": m.selectExpr("id", "v + 1 AS v"), "all_k": k.union(k)})
    assert [tuple(r) for r in spark.table("all_m").collect()] == [(1, 1)]


def test_selection_of_unknown_tables_only_is_an_error(spark, records):
    import pytest

    from nestlift.plans.silver import silver_tables
    from nestlift.spec import SpecError

    with pytest.raises(SpecError):
        silver_tables(records('{"id": 1}'), SPEC, only="nope")


def test_drift_against_the_data(spark, records):
    from nestlift.plans.silver import silver_tables

    spec = JobSpec.from_dict({"main_table_name": "d", "main_table_key": "id", "data_schema": {"id": "int", "day": "date"},
                              "nested_tables": [{"unnested_to_table": "d_js", "parent_key": {"id": "int"},
                                                 "unnested_to_table_key": [], "unnested_column": ["js"],
                                                 "data_schema": {"x": "int", "gone": "int"}}],
                              "full_schema": {"id": "BIGINT", "day": "STRING", "js": "STRING"}})
    bronze = records('{"id": 1, "day": 20240101, "js": "[{\\"x\\": 1, \\"y\\": 2}]", "brand_new": true}')
    res = silver_tables(bronze, spec)
    got = {(r["table"], r["column"], r["kind"]) for r in res.drift(spec, bronze).collect()}
    assert {("d", "brand_new", "extra"), ("d", "day", "type"), ("d_js", "y", "extra"), ("d_js", "gone", "missing")} <= got


def test_run_replaces_children_of_loaded_records(spark, records):
    bronze, root = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    run, kids = None, lambda r: sorted(tuple(x) for x in spark.read.parquet(r.versions["kids"]).collect())
    for i, (lines, want) in enumerate([
            (['{"id": 1, "kids": [{"kid": "x"}, {"kid": "y"}]}', '{"id": 2, "kids": [{"kid": "z"}]}'], [(1, "x"), (1, "y"), (2, "z")]),
            (['{"id": 1, "kids": [{"kid": "y"}]}'], [(1, "y"), (2, "z")]),
            (['{"id": 2}', '{"id": 3, "kids": []}'], [(1, "y")])]):
        text = write_landing(records(*lines), scratch_path(spark, "landing"))
        run = ingest(spark, SPEC, text, f"2024-01-0{i + 1}T00:00:00Z", bronze, root, run.versions if run else None,
                     replace_children=True)
        assert kids(run) == want
    assert run.changes["kids"] == {"inserted": 0, "updated": 0, "unchanged": 0, "deleted": 1}
    assert run.changes["m"] == {"inserted": 1, "updated": 0, "unchanged": 1, "deleted": 0}


def test_a_failed_run_resumes_at_the_table_it_did_not_reach(spark, records, monkeypatch):
    import glob
    import os

    import pytest

    from nestlift.operators.upsert import read_partitioned
    from nestlift.plans import run as module

    text = write_landing(records('{"id": 1, "name": "a", "kids": [{"kid": "x"}]}', '{"id": 2, "name": "b"}'), scratch_path(spark, "landing"))
    parts, real = {"m": ["name"], "kids": ["id"]}, module.stage_partitioned

    def stage(spark, path, *args, **kw):
        step = real(spark, path, *args, **kw)
        return step if not path.rstrip("/").endswith("kids") else lambda: (_ for _ in ()).throw(RuntimeError("lost"))

    for catalog in (False, True):
        for t in ("m", "kids"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")
        bronze, root = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
        monkeypatch.setattr(module, "stage_partitioned", stage)
        with pytest.raises(RuntimeError, match="lost"):
            ingest(spark, SPEC, text, "2024-01-01T00:00:00Z", bronze, root, catalog=catalog, partition_by=parts)
        monkeypatch.setattr(module, "stage_partitioned", real)
        files = lambda: {p: os.path.getmtime(p) for p in glob.glob(f"{root}/m/**/*.parquet", recursive=True)}
        before = files()
        run = ingest(spark, SPEC, text, "2024-01-01T00:00:00Z", bronze, root, {"m": f"{root}/m"}, catalog=catalog,
                     partition_by=parts, resume=True)
        assert run.rows == {"kids": 1} and files() == before
        get = (lambda t: spark.table(t)) if catalog else (lambda t: read_partitioned(spark, run.versions[t]))  # noqa: B023
        assert sorted((r.id, r.name) for r in get("m").collect()) == [(1, "a"), (2, "b")]
        assert [(r.id, r.kid) for r in get("kids").collect()] == [(1, "x")]
        assert set(run.versions) == {"m", "kids"}
