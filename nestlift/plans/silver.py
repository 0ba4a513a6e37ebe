"""Bronze -> silver fan-out: one parse of the raw records, then main + child tables.

The raw JSON is parsed once, with a schema pruned to the fields the selected
tables read (declared ``full_schema`` if given, else inferred). The parsed
frame is then shared by every table:

* ``reuse="stage"``   write it as Parquet under the shared scratch folder and
  read it back: one JSON parse, each table then scans only its columns
  (nested schema pruning), and the lineage is cut, so a lost executor does
  not force a re-parse. The default, and the choice at scale.
* ``reuse="persist"`` ``persist(MEMORY_AND_DISK)``; unpersist via the result.
* ``reuse=None``      every table re-parses its own pruned text (cheapest for
  a single table).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import CORRUPT, infer_schema, parse
from ..functions.types import merge_needs, prune, quote, shape_to_struct
from ..operators.enforce import drift, enforce
from ..operators.unnest import path_need, unnest
from ..session import PARQUET_CODEC, delete_path, scratch_path
from ..spec import JobSpec, SpecError, select_tables


@dataclass
class SilverResult:
    tables: dict[str, DataFrame]
    skipped: dict[str, str]
    unknown: list[str]
    record_schema: T.StructType
    parsed: DataFrame
    quarantine: DataFrame | None = None
    notes: dict[str, list[str]] = field(default_factory=dict)
    _persisted: list[DataFrame] = field(default_factory=list)
    _paths: list[str] = field(default_factory=list)

    def drift(self, spec: JobSpec, bronze: DataFrame | None = None, column: str = "raw_json") -> DataFrame:
        """Missing/extra/uncastable columns of every produced table against its declaration.

        Worked out on schemas: the main table against the record, each child
        against its parent keys plus the fields of the struct its path ends in.
        The record schema is the one parsing used. With ``bronze`` it is inferred
        from that data instead (one aggregate), so fields a declared
        ``full_schema`` does not know are reported, and so are the fields of
        children opened from a JSON-text column.
        """
        spark = self.parsed.sparkSession
        record = self.record_schema if bronze is None else infer_schema(bronze, column)
        record = T.StructType([f for f in record.fields if f.name != CORRUPT])
        reports = []
        if spec.main_table in self.tables:
            reports.append((spec.main_table, record, spec.main_schema))
        for c in spec.children:
            if c.name in self.tables:
                flat = child_fields(record, c)
                if flat is None and bronze is not None and len(c.path) == 1 and c.path[0] in record.fieldNames():
                    text = parse(bronze, T.StructType([T.StructField(c.path[0], T.StringType())]), column)
                    keys = [f for f in record.fields if f.name in c.parent_key_names]
                    flat = T.StructType(keys + [f for f in infer_schema(text, c.path[0]).fields
                                                if f.name not in c.parent_key_names and f.name != CORRUPT])
                if flat is not None:
                    reports.append((c.name, flat, c.output_schema))
        return drift(spark, reports)

    def release(self) -> None:
        """Drop the shared parse (cache or staged files); the tables cannot be read any more."""
        for df in self._persisted:
            df.unpersist()
        self._persisted.clear()
        for path in self._paths:
            delete_path(self.parsed.sparkSession, path)
        self._paths.clear()


def child_fields(record: T.StructType, child) -> T.StructType | None:
    """Columns a child has before enforcement: carried parent keys, then the leaf struct's fields.

    ``None`` when the path passes through JSON text (known only after parsing it).
    """
    keys = child.parent_key_names
    cur: T.DataType = record
    carried: list[T.StructField] = [f for f in record.fields if f.name in keys]
    for name in child.path:
        if not isinstance(cur, T.StructType) or name not in cur.fieldNames():
            return None
        t = cur[name].dataType
        if not isinstance(t, T.ArrayType):
            return None
        cur = t.elementType
        if isinstance(cur, T.StructType):
            have = {f.name for f in carried}
            carried += [f for f in cur.fields if f.name in keys and f.name not in have]
    if not isinstance(cur, T.StructType):
        return T.StructType(carried + [T.StructField(f"{child.path[-1]}_exploded", cur)])
    names = {f.name for f in carried}
    return T.StructType(carried + [f for f in cur.fields if f.name not in names])


def record_schema(bronze: DataFrame, spec: JobSpec, column: str = "raw_json") -> T.StructType:
    """Declared ``full_schema`` when given, else inferred from the raw text.

    Text without any field (a quiet day's empty bronze) gives the declared main
    columns as text, so the main table comes out empty and typed.
    """
    if spec.full_schema:
        return shape_to_struct(spec.full_schema)
    found = infer_schema(bronze, column)
    return found if found.fields else T.StructType([T.StructField(c, T.StringType()) for c in spec.main_schema])


def main_need(spec: JobSpec) -> dict:
    need = merge_needs({c: True for c in spec.main_schema}, {k: True for k in spec.main_key})
    return need


def needs(spec: JobSpec, tables: list[str]) -> dict:
    need: dict = {}
    if spec.main_table in tables:
        need = merge_needs(need, main_need(spec))
    for c in spec.children:
        if c.name in tables:
            need = merge_needs(need, path_need(c))
    return need


BAD_TEXT, BAD_REASON = "__nl_bad_text", "__nl_bad_reason"


def _marked(bronze: DataFrame, schema: T.StructType, spec: JobSpec, column: str) -> DataFrame:
    """Parsed records plus, for those that cannot be loaded, their text and the reason."""
    raw = "__nl_raw"
    parsed = parse(bronze.select(F.col(quote(column)).alias(raw)), schema, raw, keep=(raw,), corrupt_column=CORRUPT)
    keys = [F.col(quote(k)).isNull() for k in spec.main_key if k in schema.fieldNames()]
    reason = F.when(F.col(CORRUPT).isNotNull() | F.col(raw).isNull(), F.lit("malformed"))
    if keys:
        reason = reason.when(reduce(lambda a, b: a | b, keys), F.lit("no_key"))
    return (parsed.withColumn(BAD_REASON, reason)
            .withColumn(BAD_TEXT, F.when(F.col(BAD_REASON).isNotNull(), F.col(raw))).drop(raw, CORRUPT))


def silver_tables(bronze: DataFrame, spec: JobSpec, only: str | None = None,
                  schema: T.StructType | None = None, reuse: str | None = "stage",
                  column: str = "raw_json", quarantine: bool = False, probe: bool = True,
                  mark_losses: bool = False, slice_rows: int | None = None) -> SilverResult:
    """Lazy main + child tables from a bronze frame (``raw_json`` text).

    Every table reads only its own fields: from the staged Parquet through
    an explicit pruned read schema (nested pruning does not pass through
    generators, an explicit schema does), or, without staging, by parsing
    with its own pruned schema.

    With ``quarantine`` (every run mode sets it) malformed texts and records
    without the main key go to ``SilverResult.quarantine`` (text, reason)
    instead of becoming NULL rows; they are told apart in the same parse.
    ``mark_losses`` marks values that the declared types turn into NULL (see ``enforce``);
    ``slice_rows`` opens arrays of more elements in slices, by many tasks (see ``open_array``).
    """
    kept, unknown = select_tables(spec, only)
    if unknown and not kept:
        raise SpecError(f"none of the selected tables is in the spec: {unknown}")
    spark = bronze.sparkSession
    full = schema if schema is not None else record_schema(bronze, spec, column)
    full = T.StructType([f for f in full.fields if f.name != CORRUPT])
    need = needs(spec, kept)
    if quarantine:
        need = merge_needs(need, {k: True for k in spec.main_key})
    pruned = prune(full, need)
    parsed = _marked(bronze, pruned, spec, column) if quarantine else parse(bronze, pruned, column)
    bad = None
    persisted: list[DataFrame] = []
    paths: list[str] = []
    good_only = F.col(BAD_REASON).isNull()
    if reuse == "stage":
        path = scratch_path(spark, "parsed")
        parsed.write.mode("overwrite").parquet(path, compression=PARQUET_CODEC)
        paths.append(path)
        parsed = spark.read.schema(parsed.schema).parquet(path)
        staged = parsed.schema

        def source(need: dict) -> DataFrame:
            if not quarantine:
                return spark.read.schema(prune(staged, need)).parquet(path)
            own = prune(staged, merge_needs(need, {BAD_REASON: True}))
            return spark.read.schema(own).parquet(path).where(good_only).drop(BAD_REASON)
    elif reuse == "persist" or quarantine:
        if reuse == "persist":
            parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
            persisted.append(parsed)

        def source(need: dict) -> DataFrame:
            return parsed.where(good_only).drop(BAD_REASON, BAD_TEXT) if quarantine else parsed
    else:
        def source(need: dict) -> DataFrame:
            return parse(bronze, prune(full, need), column)
    if quarantine:
        bad = parsed.where(~good_only).select(F.col(BAD_TEXT).alias(column), F.col(BAD_REASON).alias("reason"))
        parsed = parsed.where(good_only).drop(BAD_REASON, BAD_TEXT)
    tables: dict[str, DataFrame] = {}
    skipped: dict[str, str] = {}
    notes: dict[str, list[str]] = {}
    if spec.main_table in kept:
        tables[spec.main_table] = enforce(source(main_need(spec)), spec.main_schema, mark_losses)
    for child in spec.children:
        if child.name not in kept:
            continue
        r = unnest(source(path_need(child)), child, probe=probe, mark_losses=mark_losses, slice_rows=slice_rows)
        if r.df is None:
            skipped[child.name] = r.skipped or "skipped"
        else:
            tables[child.name] = r.df
        n = []
        if r.dropped_duplicates:
            n.append(f"child fields named like a carried parent key were dropped: {r.dropped_duplicates}")
        if r.missing_keys:
            n.append(f"parent keys not found, filled with NULL: {r.missing_keys}")
        if n:
            notes[child.name] = n
    return SilverResult(tables, skipped, unknown, full, parsed, bad, notes, persisted, paths)
