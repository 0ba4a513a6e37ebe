"""Whole runs: land -> bronze -> silver -> upsert, and load-time backfills.

* ``ingest``    one incremental run over a landed JSONL location
* ``backfill``  rebuild chosen tables from the bronze rows loaded in a time range
* ``upsert_all``/``upsert_all_tables``  upsert every produced table by its key

Silver storage is either catalog tables (``upsert_all_tables``: in-place
MERGE where the format supports it, else a staged swap) or Parquet version
paths (``upsert_all``: each run writes ``<root>/<table>/<version>`` and
returns the new path per table; the caller keeps that mapping). All tables are
staged and checked for conflicts before the first one is changed; the changes
themselves follow one after another.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime
from typing import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import quote
from ..operators.backfill import latest_by, load_window
from ..operators.enforce import enforce
from ..operators.upsert import Scope, applied_batch, note_batch, stage_partitioned, stage_table, upsert_path
from ..sources import landing
from ..sources.bronze import annotate, append_bronze, batch_id, bronze_from_text, read_bronze
from ..session import delete_path, scratch_path
from ..spec import JobSpec
from .silver import SilverResult, silver_tables


def table_keys(spec: JobSpec, table: str) -> list[str]:
    if table == spec.main_table:
        return list(spec.main_key)
    return spec.child(table).merge_keys


def upsert_all(spark: SparkSession, spec: JobSpec, tables: Mapping[str, DataFrame],
               current: Mapping[str, str | None], root: str, null_safe: bool = False,
               check: bool = True, rows: dict[str, int] | None = None,
               allow_new_columns: bool = False,
               partition_by: Mapping[str, list[str]] | None = None,
               scopes: Mapping[str, Scope] | None = None,
               changes: dict[str, dict[str, int]] | None = None,
               losses: dict[str, dict[str, int]] | None = None,
               batch: str | None = None, resume: bool = False) -> dict[str, str]:
    """Upsert each table under ``root``; returns ``{table: path}``.

    A table gets a new Parquet version per run (the mapping returned is the
    publication: a conflict in any table raises before it exists). Tables named
    in ``partition_by`` live at ``<root>/<table>`` instead, and only the
    partitions a run touches are rewritten, after every table was staged.
    Tables not produced this run keep their current version. When ``rows`` is
    given it receives the number of rows upserted per table, counted by
    ``observe`` inside the write job itself (no extra pass over the data), and
    ``changes`` how many rows of each table were inserted, updated, unchanged and
    deleted; ``losses`` how many values of each column its declared type made NULL
    (if the tables were made with ``mark_losses``), counted in the same job. A table
    in which nothing changed keeps its version. ``scopes`` names
    the tables in which the children of loaded parents are replaced as a whole.

    ``batch`` is noted beside each partitioned table once it is published. With
    ``resume``, tables that have seen it are left alone, so a run that failed between
    two publications repeats only those behind (versions need none: they are published
    together, by the mapping).
    """
    out = {k: v for k, v in current.items() if v}
    publish, counted = [], {}
    for name, df in tables.items():
        obs = Observation(f"upsert_{name}_{uuid.uuid4().hex[:12]}")
        cols = (partition_by or {}).get(name)
        options = {"null_safe": null_safe, "check": check, "allow_new_columns": allow_new_columns, "rows": obs,
                   "scope": (scopes or {}).get(name), "changes": {} if changes is None else changes.setdefault(name, {})}
        if cols:
            path = f"{root.rstrip('/')}/{name}"
            if resume and batch and current.get(name) and applied_batch(spark, path) == batch:
                continue
            publish.append(stage_partitioned(spark, path, df, table_keys(spec, name), cols, exists=bool(current.get(name)), **options))
            if batch:
                publish.append(lambda path=path: note_batch(spark, path, batch))
            out[name] = path
        else:
            path = f"{root.rstrip('/')}/{name}/{uuid.uuid4().hex}"
            out[name] = upsert_path(spark, current.get(name), df, table_keys(spec, name), path, **options)
        counted[name] = int(obs.get.get("rows", 0))
        _note_losses(losses, name, obs)
    for step in publish:
        step()
    if rows is not None:
        rows.update(counted)
    return out


def upsert_all_tables(spark: SparkSession, spec: JobSpec, tables: Mapping[str, DataFrame],
                      null_safe: bool = False, check: bool = True,
                      partition_by: Mapping[str, list[str]] | None = None,
                      rows: dict[str, int] | None = None,
                      scopes: Mapping[str, Scope] | None = None,
                      changes: dict[str, dict[str, int]] | None = None,
                      losses: dict[str, dict[str, int]] | None = None,
                      batch: str | None = None, resume: bool = False) -> dict[str, str]:
    """Upsert each table into the catalog table ``silver_schema.table``.

    First every table is staged and its conflicts are checked; only then are
    the tables changed, one after another. So a conflict in any of them leaves
    all as they were. Tables named in ``partition_by`` are kept partitioned by
    those columns (fixed per key, checked) and only the touched partitions are
    rewritten; the others are merged in place where the format allows it, else
    swapped whole. ``scopes`` and ``changes`` as in ``upsert_all`` (tables merged in
    place by their format do not count changes). ``batch`` is noted as a property of
    each table once it is changed; with ``resume``, tables that have seen it are left alone.
    """
    steps, counted, done = {}, {}, {}
    for name, df in tables.items():
        qualified, keys = spec.qualified(name), table_keys(spec, name)
        if resume and batch and applied_batch(spark, qualified, as_table=True) == batch:
            done[name] = qualified
            continue
        cols = (partition_by or {}).get(name)
        obs = Observation(f"upsert_{name}_{uuid.uuid4().hex[:12]}")
        options = {"null_safe": null_safe, "check": check, "rows": obs, "scope": (scopes or {}).get(name),
                   "changes": {} if changes is None else changes.setdefault(name, {})}
        if cols:
            steps[name] = stage_partitioned(spark, qualified, df, keys, cols, as_table=True, **options)
        else:
            steps[name] = stage_table(spark, qualified, df, keys, **options)
        counted[name] = obs
    out = done
    for name, step in steps.items():
        out[name] = step()
        if batch:
            note_batch(spark, out[name], batch, as_table=True)
    if rows is not None:
        rows.update({name: int(obs.get.get("rows", 0)) for name, obs in counted.items()})
    if losses is not None:
        for name, obs in counted.items():
            _note_losses(losses, name, obs)
    return out


def _note_losses(losses: dict[str, dict[str, int]] | None, table: str, obs: Observation) -> None:
    if losses is not None:
        losses[table] = {k.removeprefix("lost:"): int(n) for k, n in obs.get.items() if k.startswith("lost:")}


@dataclass
class RunResult:
    silver: SilverResult
    versions: dict[str, str]
    rows: dict[str, int]
    quarantined: int = 0
    quarantine: str | None = None
    # per table: rows inserted, updated, unchanged, deleted
    changes: dict[str, dict[str, int]] = field(default_factory=dict)
    # per table and column whose cast can fail: values that became NULL
    losses: dict[str, dict[str, int]] = field(default_factory=dict)

    def cast_losses(self, spark: SparkSession) -> DataFrame:
        """table, column, lost: one row per column whose cast can fail."""
        return spark.createDataFrame([(t, c, n) for t, cols in self.losses.items() for c, n in cols.items()],
                                     "table string, column string, lost long")


def child_scopes(spec: JobSpec, res: SilverResult, tables: dict[str, DataFrame], known) -> dict[str, Scope]:
    """The scope of every child table: the records of this load, by the main key that the child carries.

    A child table that this load did not produce, because no record has such children
    any more, gets an empty frame if it is ``known`` from before, so that the old ones go.
    """
    spark, out = res.parsed.sparkSession, {}
    for child in spec.children:
        types = {k: t for k, t in child.parent_keys if k in spec.main_key}
        if set(types) != set(spec.main_key):
            raise ValueError(f"{child.name} does not carry the main key {list(spec.main_key)}, so its parents cannot be told")
        if child.name not in tables:
            if child.name not in res.skipped or not known(child.name):
                continue
            keys = T.StructType([T.StructField(k, T.StringType()) for k in child.output_schema])
            tables[child.name] = enforce(spark.createDataFrame([], keys), child.output_schema)
        parents = enforce(res.parsed.select(*[F.col(quote(k)) for k in types]), types)
        out[child.name] = Scope(list(types), parents)
    return out


def _run(spark: SparkSession, spec: JobSpec, bronze: DataFrame, silver_root: str, batch: str,
         current: Mapping[str, str | None] | None, only: str | None, catalog: bool,
         partition_by: Mapping[str, list[str]] | None, replace_children: bool = False,
         resume: bool = False) -> RunResult:
    """Silver tables of ``bronze``, bad records set aside, everything upserted, scratch removed."""
    res = silver_tables(bronze, spec, only=only, quarantine=True, mark_losses=True)
    try:
        bad = f"{silver_root.rstrip('/')}/_quarantine/batch={batch}"
        obs = Observation(f"quarantine_{uuid.uuid4().hex[:12]}")
        res.quarantine.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(bad)
        rows: dict[str, int] = {}
        changes: dict[str, dict[str, int]] = {}
        losses: dict[str, dict[str, int]] = {}
        tables, scopes = dict(res.tables), None
        if replace_children:
            known = (lambda t: spark.catalog.tableExists(spec.qualified(t))) if catalog else (lambda t: (current or {}).get(t))
            scopes = child_scopes(spec, res, tables, known)
        if catalog:
            versions = upsert_all_tables(spark, spec, tables, partition_by=partition_by, rows=rows, scopes=scopes, changes=changes,
                                         losses=losses, batch=batch, resume=resume)
        else:
            versions = upsert_all(spark, spec, tables, current or {}, silver_root, rows=rows, partition_by=partition_by,
                                  scopes=scopes, changes=changes, losses=losses, batch=batch, resume=resume)
    finally:
        res.release()
    return RunResult(res, versions, rows, int(obs.get.get("rows", 0)), bad, changes, losses)


def ingest(spark: SparkSession, spec: JobSpec, landing: str, load_ts: datetime | str,
           bronze_target: str, silver_root: str, current: Mapping[str, str | None] | None = None,
           only: str | None = None, catalog: bool = False,
           partition_by: Mapping[str, list[str]] | None = None, replace_children: bool = False,
           resume: bool = False) -> RunResult:
    """One incremental run: the landed text goes to bronze, then silver is upserted.

    The load's rows are their own bronze partition, named by load time and
    landing, so running the same load again (after a failure, say) replaces them,
    and another landing loaded at the same time keeps its own. The silver input is
    this batch read back from bronze, so bronze and silver agree on what was loaded. Malformed texts and records without
    the main key are written to ``RunResult.quarantine`` and counted. With
    ``replace_children`` a loaded record's children replace those it had before, so
    children removed upstream go; records that are not in the load keep theirs.
    ``resume`` is for repeating a run that failed between two tables: those that this
    load has reached (partitioned paths and catalog tables note it) are left alone.
    """
    batch = batch_id(load_ts, landing)
    append_bronze(bronze_from_text(spark, landing, load_ts), bronze_target, batch=batch)
    rows = load_window(read_bronze(spark, bronze_target, batch=batch), load_ts, load_ts)
    return _run(spark, spec, rows, silver_root, batch, current, only, catalog, partition_by, replace_children, resume)


def backfill(spark: SparkSession, spec: JobSpec, bronze_target: str, start: datetime | str,
             end: datetime | str, silver_root: str,
             current: Mapping[str, str | None] | None = None, only: str | None = None,
             catalog: bool = False, partition_by: Mapping[str, list[str]] | None = None, replace_children: bool = False,
           resume: bool = False) -> RunResult:
    """Rebuild the chosen tables from bronze rows loaded in ``[start, end]``; of a record's copies the last counts."""
    several = scratch_path(spark, "several")
    batch = batch_id(end, f"{bronze_target} from {start}")
    try:
        bronze = latest_by(load_window(read_bronze(spark, bronze_target), start, end), spec.main_key, scratch=several)
        return _run(spark, spec, bronze, silver_root, batch, current, only, catalog, partition_by, replace_children, resume)
    finally:
        delete_path(spark, several)


class IncompleteLanding(RuntimeError):
    """The landing is not what the source announced; loading now would silently lose or repeat records."""


def ingest_pages(spark: SparkSession, spec: JobSpec, envelopes: DataFrame, load_ts: datetime | str,
                 bronze_target: str, silver_root: str,
                 current: Mapping[str, str | None] | None = None, only: str | None = None,
                 require_complete: bool = True, source: str = "pages", catalog: bool = False,
                 partition_by: Mapping[str, list[str]] | None = None, replace_children: bool = False,
           resume: bool = False) -> RunResult:
    """One run from landed page responses (``window_start, page, body``).

    ``landing.gate`` compares what landed with the spec's request windows (if it
    has a date range) and with each window's hit total. With ``require_complete``
    anything but received pages raises ``IncompleteLanding`` before anything is
    loaded. Then the envelopes are flattened to records and loaded as a run, whose
    bronze batch is named by load time and ``source``: name each landing's own.
    """
    if require_complete:
        bad = landing.gate(envelopes, spec).where("status <> 'received'")
        sample = [tuple(r) for r in bad.limit(5).collect()]
        if sample:
            raise IncompleteLanding(f"pages or windows did not land as announced, e.g. {sample}")
    recs = landing.records(envelopes, spec.data_key)
    batch = batch_id(load_ts, source)
    # where a record came from, in an order that text keeps: window, page, position
    place = F.concat_ws("/", F.lit(source), F.date_format("window_start", "yyyy-MM-dd'T'HH:mm:ss"),
                        F.lpad(F.col("page").cast("string"), 9, "0"), F.lpad(F.col("position").cast("string"), 9, "0"))
    append_bronze(annotate(recs, load_ts, place, column="raw_json"), bronze_target, batch=batch)
    rows = load_window(read_bronze(spark, bronze_target, batch=batch), load_ts, load_ts)
    return _run(spark, spec, rows, silver_root, batch, current, only, catalog, partition_by, replace_children, resume)
