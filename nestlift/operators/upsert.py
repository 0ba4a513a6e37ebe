"""Upsert by single or composite key: ``WHEN MATCHED UPDATE SET * WHEN NOT MATCHED INSERT *``.

Semantics kept from a SQL MERGE without a delete clause:

* a target row whose key equals a source key is replaced by the source row;
* every source row is inserted or replaces; target rows no source row
  matches are kept (rows removed upstream persist);
* keys compare with ``=``: a NULL key part never matches, so NULL-key rows
  on either side are kept and re-inserted on every run (``null_safe=True``
  compares with ``<=>`` instead);
* several source rows matching one target row is an error
  (``MergeConflict``), while several *new* source rows with one key are all
  inserted.

As a plan, ``merge_frames`` is ``target LEFT JOIN counted-source-keys``
keeping unmatched rows, ``UNION ALL source``; the per-key count also
detects conflicts in the same job. The source is read twice (its keys are
counted, its rows are merged); runs hand over staged Parquet, so neither read
parses again. NULL-key target rows
bypass the join (they cannot match), so a mass of NULL keys never lands in
one join task. Broadcast vs sort-merge is left to AQE, which decides on
measured sizes.

Two further merges share one window per key (``merge_states``), which also says
of every row whether it was inserted, updated, unchanged, kept or deleted:

* partitioned tables: only partitions in which something changed are replaced,
  so a load that changes nothing replaces no file;
* ``Scope`` (opt-in): the children of every loaded parent are replaced as a
  whole, so those that vanished upstream go; parents that were not loaded keep
  theirs.

Storage: a table format with row-level MERGE (a DataSource V2 table) is
merged in place through ``DataFrame.mergeInto``. Plain Parquet cannot be
rewritten while it is read, so there the merged rows are written to a new
version (a new path, or a staging table swapped in by name).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.types import quote
from .enforce import LOST
from ..session import (PARQUET_CODEC, TEXT_LEVEL, delete_path, more_tasks, path_exists, read_text, rename_path, replace_path, scratch_path,
                       stored_bytes, write_text)


class MergeConflict(ValueError):
    """Several source rows match the same target row."""


def _any_null(df: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [df[quote(k)].isNull() for k in keys])


def _all_set(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(quote(k)).isNotNull() for k in keys])


def _align(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source rows in the target's column order and types."""
    have = set(source.columns)
    missing = [c for c in target.columns if c not in have]
    if missing:
        raise ValueError(f"source lacks target columns {missing} (the declared schema is the contract)")
    return source.select(*[F.col(quote(f.name)).cast(f.dataType).alias(f.name) for f in target.schema.fields],
                         *([LOST] if LOST in have else []))


def _evolve(target: DataFrame, source: DataFrame, allow_new_columns: bool) -> DataFrame:
    """Target widened by the source's new columns (typed NULL for old rows), if allowed.

    The declared schema is the contract: a source column the target lacks is
    an error unless ``allow_new_columns`` is set.
    """
    have = set(target.columns)
    new = [f for f in source.schema.fields if f.name not in have and f.name != LOST]
    if not new:
        return target
    if not allow_new_columns:
        raise ValueError(f"source has columns the target lacks: {[f.name for f in new]} "
                         "(pass allow_new_columns=True to add them)")
    return target.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in new])


_N, _H = "__nl_src_n", "__nl_src_hash"
# Fixed value: keys up to which a list of them is broadcast.
FEW_KEYS = 100_000
# Fixed value: stored rows up to which the places of replaced ones are broadcast (a bit each, so 125 MB at most).
MOST_PLACES = 1_000_000_000
# Where a stored row lies: its file (a hash of the path) and its place in it. Only on rows straight from Parquet.
_FILE, _AT = "__nl_file", "__nl_at"
# Fixed value: stored bytes a row from which a table's keys and hashes are dealt out before its rows. Those of
# shorter rows weigh about as much as the rows.
WIDE_ROW = 64


def _has_map(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return any(_has_map(f.dataType) for f in t.fields)
    return isinstance(t, T.MapType) or isinstance(t, T.ArrayType) and _has_map(t.elementType)


def row_hash(df: DataFrame, columns: list[str]) -> Column:
    """128 bits that tell rows apart by ``columns``, NULLs included (maps by their JSON text)."""
    parts = []
    for c in columns:
        col = F.to_json(F.struct(F.col(quote(c)))) if _has_map(df.schema[c].dataType) else F.col(quote(c))
        parts += [col, F.col(quote(c)).isNull()]
    parts = parts or [F.lit(0)]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit("row"), *parts).alias("b"))


def _values(df: DataFrame, keys: list[str]) -> list[str]:
    return [c for c in df.columns if c not in keys]


def merge_with_conflicts(target: DataFrame, source: DataFrame, keys: list[str],
                         null_safe: bool = False, allow_new_columns: bool = False,
                         rows: Observation | None = None) -> tuple[DataFrame, Observation]:
    """Merged rows plus an observation of conflicts and changes while they are produced.

    The source keys are counted per key (a partial, map-side aggregate) and
    left-joined to the target: a target row with a count is replaced, a row
    without one is kept, and a count above 1 is a conflict, tallied by
    ``observe`` inside the same job, as are the replaced rows whose values changed
    (``updated``) or not (``unchanged``). NULL-key target rows bypass the join.
    ``rows`` counts the source rows as they are written.
    """
    target = _evolve(target, source, allow_new_columns)
    src = _align(source, target)
    values = _values(target, keys)
    counted = src.groupBy(*[F.col(quote(k)) for k in keys]).agg(F.count(F.lit(1)).alias(_N), F.max(row_hash(src, values)).alias(_H))
    null_rows = None
    if null_safe:
        ren = counted.select(*[F.col(quote(k)).alias(f"__nl_k{i}") for i, k in enumerate(keys)], _N, _H)
        cond = reduce(lambda a, b: a & b,
                      [target[quote(k)].eqNullSafe(ren[f"__nl_k{i}"]) for i, k in enumerate(keys)])
        j = target.join(ren, cond, "left").drop(*[f"__nl_k{i}" for i in range(len(keys))])
    else:
        null_rows = target.filter(_any_null(target, keys))
        rest = target.filter(~_any_null(target, keys))
        j = rest.join(counted.filter(_all_set(keys)), keys, "left").select(
            *[F.col(quote(c)) for c in target.columns], _N, _H)
    obs = Observation()
    same = F.col(_H) == row_hash(target, values)
    j = j.observe(obs, F.count_if(F.col(_N) > 1).alias("conflicts"), F.count_if((F.col(_N) == 1) & same).alias("unchanged"),
                  F.count_if((F.col(_N) == 1) & ~same).alias("updated"))
    kept = j.filter(F.col(_N).isNull()).drop(_N, _H)
    if null_rows is not None:
        kept = kept.unionByName(null_rows)
    return kept.unionByName(_counted(src, rows)), obs


def _key_match(keys: list[str], names: list[str], null_safe: bool) -> Column:
    pairs = [(F.col(quote(k)), F.col(n)) for k, n in zip(keys, names, strict=True)]
    return reduce(lambda a, b: a & b, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def compare_keys(target: DataFrame, source: DataFrame, keys: list[str], scratch: str, null_safe: bool = False) -> Observation:
    """Write the key of every target row and whether the source has it (``__nl_hit``) to ``scratch``.

    Only keys and row hashes are dealt out, and the rows' places if the target has them (``with_places``).
    ``source`` has the target's other columns. The
    observation counts what ``merge_with_conflicts`` does, and the target rows that
    the source has (``hits``) or not (``misses``), and source rows without a target
    row (``fresh``). NULL-key target rows match nothing and are not listed, unless
    ``null_safe``.
    """
    names, places = [f"__nl_k{i}" for i in range(len(keys))], _places(target)
    values = _values(target, [*keys, *places])
    counted = (source.groupBy(*[F.col(quote(k)).alias(n) for k, n in zip(keys, names, strict=True)])
               .agg(F.count(F.lit(1)).alias(_N), F.max(row_hash(source, values)).alias(_H)))
    own = target if null_safe else target.filter(_all_set(keys))
    own = own.select(*[F.col(quote(k)) for k in keys], *places, row_hash(target, values).alias("__nl_own"))
    n, here = F.col(_N), F.col("__nl_own").isNotNull()
    same = F.col(_H) == F.col("__nl_own")
    obs = Observation()
    met = (own.join(counted, _key_match(keys, names, null_safe), "full")
           .observe(obs, F.count_if(here & (n > 1)).alias("conflicts"), F.count_if(here & (n == 1) & same).alias(UNCHANGED),
                    F.count_if(here & (n == 1) & ~same).alias(UPDATED), F.count_if(here & n.isNotNull()).alias("hits"),
                    F.count_if(here & n.isNull()).alias("misses"), F.sum(F.when(~here, n)).alias("fresh")))
    (met.filter(here).select(*[F.col(quote(k)).alias(x) for k, x in zip(keys, names, strict=True)], *places, n.isNotNull().alias("__nl_hit"))
     .write.parquet(scratch, compression=PARQUET_CODEC))
    return obs


def with_places(stored: DataFrame) -> DataFrame:
    """Rows straight from Parquet files, and where each of them lies."""
    return stored.select("*", F.xxhash64("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_AT))


def _places(df: DataFrame) -> list[str]:
    return [c for c in (_FILE, _AT) if c in df.columns]


def _not_at(rest: DataFrame, hit: DataFrame) -> DataFrame:
    """The rows that lie elsewhere than the ``hit`` ones: a bit for each place, broadcast, so no row is dealt out."""
    place, byte = F.col(_AT) + 1, F.expr("cast(conv(hex(substring(__nl_bits, __nl_bit div 8 + 1, 1)), 16, 10) as int)")
    bits = (hit.groupBy(F.col(_FILE).alias("__nl_in"), F.bitmap_bucket_number(place).alias("__nl_part"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("__nl_bits")))
    met = rest.withColumn("__nl_bit", F.bitmap_bit_position(place)).join(
        F.broadcast(bits), (F.col(_FILE) == F.col("__nl_in")) & (F.bitmap_bucket_number(place) == F.col("__nl_part")), "left")
    taken = F.coalesce(F.getbit(byte, F.expr("cast(__nl_bit % 8 as int)")), F.lit(0).cast("byte"))
    return met.where(taken == 0).select(*[F.col(quote(c)) for c in rest.columns])


def kept_rows(target: DataFrame, keys: list[str], listed: DataFrame, hits: int, misses: int, null_safe: bool = False) -> DataFrame:
    """The target rows whose key the source lacks, by the shorter list of ``compare_keys``; NULL-key rows bypass the join.

    If that list is long and the rows' places are known, they tell instead: then too, the rows themselves are not dealt out.
    """
    places = _places(target)
    if places:
        if hits and min(hits, misses) > FEW_KEYS and hits + misses <= MOST_PLACES:
            return _not_at(target, listed.where("__nl_hit")).drop(*places)
        target = target.drop(*places)
    rest = target if null_safe else target.filter(_all_set(keys))
    if hits:
        names, most = [f"__nl_k{i}" for i in range(len(keys))], min(hits, misses)
        some = listed.where(F.col("__nl_hit") == F.lit(hits <= misses)).select(*names)
        some = F.broadcast(some) if most <= FEW_KEYS else some
        rest = rest.join(some, _key_match(keys, names, null_safe), "left_anti" if hits <= misses else "left_semi") if most else rest.limit(0)
    return rest if null_safe else rest.unionByName(target.filter(_any_null(target, keys)))


@dataclass(frozen=True)
class Scope:
    """Whose children a load replaces as a whole: ``columns`` are the key columns that name the parent.

    ``parents`` are the loaded parents; those that the loaded children name are
    loaded anyway, so it is needed for parents that came without any child.
    """

    columns: list[str]
    parents: DataFrame | None = None


KEPT, UNCHANGED, UPDATED, INSERTED, DELETED = "kept", "unchanged", "updated", "inserted", "deleted"
CHANGED = (UPDATED, INSERTED, DELETED)
_STATE, _SIDE = "__nl_state", "__nl_side"


def _loaded(source: DataFrame, scope: Scope) -> DataFrame:
    cols = [F.col(quote(c)) for c in scope.columns]
    own = source.select(*cols)
    return (own if scope.parents is None else own.unionByName(scope.parents.select(*cols))).filter(_all_set(scope.columns)).distinct()


def merge_states(target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool = False,
                 allow_new_columns: bool = False, rows: Observation | None = None,
                 scope: Scope | None = None, tasks: int | None = None) -> tuple[DataFrame, Observation]:
    """The rows of ``target`` after the upsert with their state, and an observation of the counts.

    Target and source rows (and the loaded parents of a ``scope``) meet in one
    shuffle by key, or by parent, in which the rows of one key lie together too.
    Windows over the key say who matches whom and whether the values differ; a
    window over the parent says whether it was loaded. Rows of state ``deleted`` are
    in the frame, for the caller to leave out. Keys repeated in the source that
    match a target row are counted as ``conflicts``. Rows with a NULL in the key (in
    the parent, with a scope) bypass the shuffle: they match nothing. A row of a loaded
    parent with a NULL elsewhere in its key matches nothing either, so it goes with a scope.
    ``tasks``: how many tasks the shuffle deals to, if not as many as the session says.
    """
    target = _evolve(target, source, allow_new_columns)
    src = _align(source, target)
    if scope and not set(scope.columns) <= set(keys):
        raise ValueError(f"scope {scope.columns} must be part of the key {keys}")
    cols = [F.col(quote(c)) for c in target.columns]
    both = target.select(*cols, F.lit(0).alias(_SIDE)).unionByName(_counted(src, rows).select(*cols, F.lit(1).alias(_SIDE)))
    if scope and scope.parents is not None:
        names = set(scope.columns)
        parents = scope.parents.select(*[F.col(quote(c)).cast(target.schema[c].dataType).alias(c) for c in scope.columns]).distinct()
        both = both.unionByName(parents.select(
            *[F.col(quote(f.name)) if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema.fields],
            F.lit(2).alias(_SIDE)))
    side = F.col(_SIDE)
    apart = None
    if scope or not null_safe:
        null = reduce(lambda a, b: a | b, [F.col(quote(k)).isNull() for k in (scope.columns if scope else keys)])
        apart = (both.filter(null & (side < 2)).withColumn(_STATE, F.when(side == 0, KEPT).otherwise(INSERTED)).drop(_SIDE))
        both = both.filter(~null)
    # the rows are dealt out first: the hashes of their values need not travel
    both = both.repartition(*([tasks] if tasks else []), *[F.col(quote(c)) for c in (scope.columns if scope else keys)])
    own = Window.partitionBy(*[F.col(quote(k)) for k in keys])
    both = both.withColumn(_H, row_hash(target, _values(target, keys)))
    for i in (0, 1):
        both = (both.withColumn(f"__nl_n{i}", F.count_if(side == i).over(own))
                .withColumn(f"__nl_h{i}", F.max(F.when(side == i, F.col(_H))).over(own)))
    n0, n1 = F.col("__nl_n0"), F.col("__nl_n1")
    match = (n0 > 0) & (n1 > 0) & (F.lit(True) if null_safe else _all_set(keys))
    loaded = F.lit(False)
    if scope:
        both = both.withColumn("__nl_loaded", F.max(side).over(Window.partitionBy(*[F.col(quote(c)) for c in scope.columns])) > 0)
        loaded = F.col("__nl_loaded")
    state = (F.when(side == 2, "parent")
             .when(side == 1, F.when(match & (n0 == 1) & (n1 == 1) & (F.col("__nl_h0") == F.col("__nl_h1")), UNCHANGED)
                   .when(match, UPDATED).otherwise(INSERTED))
             .when(match & (n1 > 1), "conflict").when(match, "replaced").when(loaded, DELETED).otherwise(KEPT))
    out = both.withColumn(_STATE, state).select(*cols, _STATE)
    if apart is not None:
        out = out.unionByName(apart)
    obs = Observation()
    out = out.observe(obs, F.count_if(F.col(_STATE) == "conflict").alias("conflicts"),
                      *[F.count_if(F.col(_STATE) == x).alias(x) for x in (UNCHANGED, *CHANGED)])
    return out.filter(F.col(_STATE).isin(KEPT, UNCHANGED, *CHANGED)), obs


def _note(changes: dict[str, int] | None, obs: Observation | None, rows: Observation | None) -> dict[str, int]:
    """Inserted, updated, unchanged and deleted rows of a finished write."""
    seen = obs.get if obs is not None else {}
    out = {x: int(seen.get(x, 0)) for x in (INSERTED, UPDATED, UNCHANGED, DELETED)}
    if INSERTED not in seen:        # every source row that replaced none
        out[INSERTED] = int(rows.get.get("rows", 0)) - out[UPDATED] - out[UNCHANGED]
    if changes is not None:
        changes.update(out)
    return out


def _counted(source: DataFrame, rows: Observation | None) -> DataFrame:
    """Source rows, counted as they are written, with the values their casts lost (``lost:`` and the column)."""
    marks = source.schema[LOST].dataType.fieldNames() if LOST in source.columns else []
    if rows is not None:
        source = source.observe(rows, F.count(F.lit(1)).alias("rows"),
                                *[F.count_if(F.col(LOST)[c]).alias(f"lost:{c}") for c in marks])
    return source.drop(LOST)


def merge_frames(target: DataFrame, source: DataFrame, keys: list[str],
                 null_safe: bool = False, allow_new_columns: bool = False) -> DataFrame:
    """Rows of ``target`` after upserting ``source`` on ``keys`` (lazy)."""
    return merge_with_conflicts(target, source, keys, null_safe, allow_new_columns)[0]


def conflicts(target: DataFrame, source: DataFrame, keys: list[str],
              null_safe: bool = False) -> DataFrame:
    """Source keys that occur more than once *and* match a target row: ``(keys..., n)``.

    The per-key count is a partial (map-side) aggregate, so a hot key costs
    one row per map task before the shuffle.
    """
    dup = (source.groupBy(*[F.col(quote(k)) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
           .filter(F.col("n") > 1))
    # target keys are de-duplicated map-side first: a key repeated many times
    # in the target becomes one row per task before the shuffle
    if null_safe:
        t = target.select(*[F.col(quote(k)).alias(f"__nl_t{i}") for i, k in enumerate(keys)]).distinct()
        cond = reduce(lambda a, b: a & b,
                      [dup[quote(k)].eqNullSafe(t[f"__nl_t{i}"]) for i, k in enumerate(keys)])
        return dup.join(t, cond, "left_semi")
    dup = dup.filter(_all_set(keys))
    return dup.join(target.select(*[F.col(quote(k)) for k in keys]).distinct(), keys, "left_semi")


def check_conflicts(target: DataFrame, source: DataFrame, keys: list[str],
                    null_safe: bool = False) -> None:
    bad = conflicts(target, source, keys, null_safe)
    if not bad.isEmpty():
        sample = [r.asDict() for r in bad.limit(5).collect()]
        raise MergeConflict(f"several source rows match one target row on {keys}, e.g. {sample}")


def upsert_path(spark: SparkSession, current: str | None, source: DataFrame, keys: list[str],
                out: str, null_safe: bool = False, check: bool = True,
                allow_new_columns: bool = False, rows: Observation | None = None,
                scope: Scope | None = None, changes: dict[str, int] | None = None) -> str:
    """Write the next version of a Parquet table to ``out`` and return it.

    ``current=None`` creates the table from the source as is (no key dedup,
    like the first write of a MERGE-maintained table). Conflicts are counted
    before the merged version is written (of short rows, or with a ``scope``, during the
    write itself); on a conflict no version is published and ``MergeConflict`` is raised. ``scope`` replaces the children
    of loaded parents; ``changes`` receives the number of inserted, updated,
    unchanged and deleted rows. If nothing changed, ``current`` stays the version.
    """
    rows = rows or Observation()
    if current is None:
        _counted(source, rows).write.mode("errorifexists").options(**TEXT_LEVEL).parquet(out, compression=PARQUET_CODEC)
        _note(changes, None, rows)
        return out
    stored = spark.read.parquet(current)
    if scope or stored_bytes(spark, current) < WIDE_ROW * stored.count():
        if scope:
            merged, obs = merge_states(stored, source, keys, null_safe, allow_new_columns, rows, scope)
            merged = merged.filter(F.col(_STATE) != DELETED).drop(_STATE)
        else:
            merged, obs = merge_with_conflicts(stored, source, keys, null_safe, allow_new_columns, rows)
        width = len(merged.columns)
        merged.write.mode("errorifexists").parquet(out, compression=PARQUET_CODEC)
        n = int(obs.get.get("conflicts", 0))
        if check and n:
            raise MergeConflict(f"{n} target rows match several source rows on {keys}; "
                                f"the merged version at {out} was not published")
        found = _note(changes, obs, rows)
        if not n and width == len(stored.columns) and not any(found[x] for x in CHANGED):
            delete_path(spark, out)
            return current
        return out
    target = _evolve(stored, source, allow_new_columns)
    src = _align(source, target)
    placed = _evolve(with_places(stored), source, allow_new_columns)
    scratch = scratch_path(spark, "keys")
    try:
        obs = compare_keys(placed, src.drop(LOST), keys, scratch, null_safe)
        n, hits, misses, *new = (int(obs.get.get(x) or 0) for x in ("conflicts", "hits", "misses", "fresh", UPDATED))
        if check and n:
            raise MergeConflict(f"{n} target rows match several source rows on {keys}; the version {out} was not written")
        counted = _counted(src, rows)
        if not n and not any(new) and len(target.columns) == len(stored.columns):
            # as it seems, nothing to write: the source is only counted
            counted.write.format("noop").mode("overwrite").save()
            found, counted = _note(changes, obs, rows), src.drop(LOST)
            if not any(found[x] for x in CHANGED):
                return current
        listed = spark.read.parquet(scratch)
        kept = kept_rows(placed, keys, listed, hits, misses, null_safe)
        kept.unionByName(counted).write.mode("errorifexists").options(**TEXT_LEVEL).parquet(out, compression=PARQUET_CODEC)
        _note(changes, obs, rows)
        return out
    finally:
        delete_path(spark, scratch)


# ------------------------------------------------------------------ partitioned tables
_SCHEMA_FILE = "_nl_schema.json"      # names starting with "_" are not data files
# Fixed value: rows that one task of a merge sorts. With more rows than the session's shuffle partitions hold at that
# size, tasks multiply instead of growing (and spilling).
MERGE_ROWS = 1_000_000
# Fixed value: partitions up to which every task writes its rows of each; more are dealt out first.
FEW_PARTITIONS = 16


class PartitionMove(ValueError):
    """A key of the source sits in another partition of the target."""


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """A path written by ``upsert_partitioned``, with the types it was written with.

    Partition values keep their declared type (``'001'`` stays text) and columns
    added later are there for old files too.
    """
    text = read_text(spark, f"{path.rstrip('/')}/{_SCHEMA_FILE}")
    reader = spark.read
    return (reader.schema(T.StructType.fromJson(json.loads(text))) if text else reader).parquet(path)


def _target(spark: SparkSession, path: str, source: DataFrame, partition_by: list[str], as_table: bool) -> DataFrame:
    if as_table:
        return spark.table(path)
    if read_text(spark, f"{path.rstrip('/')}/{_SCHEMA_FILE}"):
        return read_partitioned(spark, path)
    # a table from elsewhere: the files' columns, partition values typed like the source's
    files = spark.read.parquet(path).schema
    typed = [source.schema[f.name] if f.name in partition_by else f for f in files.fields]
    return spark.read.schema(T.StructType(typed)).parquet(path)


def _touched_rows(target: DataFrame, touched: DataFrame, partition_by: list[str], scratch: str | None = None) -> DataFrame:
    """Target rows in the touched partitions (a NULL partition value is a partition like any other).

    The touched values are written to ``scratch`` first, so their size is known. They
    are joined by equality, which lets Spark prune the target's partitions at run
    time to exactly these values (when they are few enough to be broadcast, as
    partition values are), and their least and greatest are literal filters in
    front, for when they are not. Values with a NULL are joined apart, one branch
    for each set of columns that are NULL (a literal filter) together.
    """
    names = [f"__nl_p{i}" for i in range(len(partition_by))]
    t = touched.select(*[F.col(quote(c)).alias(n) for c, n in zip(partition_by, names, strict=True)]).distinct()
    if scratch:
        t.write.parquet(scratch)
        t = touched.sparkSession.read.schema(t.schema).parquet(scratch)
    nulls = [F.col(n).isNull().alias(n) for n in names]
    branches = []
    for pattern in sorted(t.select(*nulls).distinct().collect()):
        part, values, set_ = target, t, []
        for c, n, is_null in zip(partition_by, names, pattern, strict=True):
            if is_null:
                part, values = part.filter(F.col(quote(c)).isNull()), values.filter(F.col(n).isNull())
            else:
                values = values.filter(F.col(n).isNotNull())
                set_.append((c, n))
        if set_:
            ends = values.agg(*[f(n).alias(f"{k}{n}") for _, n in set_ for k, f in (("lo", F.min), ("hi", F.max))]).first()
            for c, n in set_:
                lo, hi = F.lit(ends[f"lo{n}"]), F.lit(ends[f"hi{n}"])
                part, values = part.filter(F.col(quote(c)).between(lo, hi)), values.filter(F.col(n).between(lo, hi))
            part = part.join(values.select(*[n for _, n in set_]),
                             reduce(lambda a, b: a & b, [F.col(quote(c)) == F.col(n) for c, n in set_]), "left_semi")
        branches.append(part)
    return reduce(DataFrame.unionByName, branches) if branches else target.limit(0)


def check_moves(target: DataFrame, source: DataFrame, keys: list[str], partition_by: list[str]) -> None:
    """Raise ``PartitionMove`` if a key is in another partition of the target than in the source."""
    cols = keys + [c for c in partition_by if c not in keys]
    s = source.select(*[F.col(quote(c)) for c in cols]).filter(_all_set(keys))
    t = target.select(*[F.col(quote(c)) for c in keys],
                      *[F.col(quote(c)).alias(f"__nl_at{i}") for i, c in enumerate(partition_by)]).filter(_all_set(keys))
    same = reduce(lambda a, b: a & b, [F.col(quote(c)).eqNullSafe(F.col(f"__nl_at{i}")) for i, c in enumerate(partition_by)])
    moved = s.join(t, keys).filter(~same).select(*[F.col(quote(k)) for k in keys])
    sample = [r.asDict() for r in moved.limit(5).collect()]
    if sample:
        raise PartitionMove(f"keys change their partition {partition_by}, e.g. {sample}; an upsert of the touched "
                            "partitions alone would leave the old row behind")


def _same(a: list[str], b: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(quote(p)).eqNullSafe(F.col(q)) for p, q in zip(a, b, strict=True)])


def _drop_partitions(spark: SparkSession, path: str, partition_by: list[str], gone: DataFrame, as_table: bool) -> None:
    """Remove partitions of which no row is left (dynamic overwrite only replaces those that get rows)."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for row in gone.select(*[F.col(quote(c)).cast("string") for c in partition_by]).distinct().collect():
        values = list(zip(partition_by, row, strict=True))
        if as_table:
            spec = ", ".join(f"{quote(c)} = " + ("NULL" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'")
                             for c, v in values)
            spark.sql(f"ALTER TABLE {_quoted(path)} DROP IF EXISTS PARTITION ({spec})")
        else:
            delete_path(spark, "/".join([path.rstrip("/"), *(names.getPartitionPathString(c, v) for c, v in values)]))


def _beside(path: str) -> str:
    """A folder beside a path, on the same file system, for what is to take its place."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}__nl_next-{uuid.uuid4().hex}"


def _stage_few(spark: SparkSession, path: str, merged: DataFrame, partition_by: list[str], schema: T.StructType, every: bool,
               note: Callable[[], tuple[int, bool]], conflict: str) -> Callable[[], str]:
    """Write merged rows once, beside a table and as its partitions; the returned function puts the changed ones in their place.

    For so few partitions that their values fit in a task's result: which of them have rows, and which an inserted,
    updated or deleted one (``every``: all count as changed), is observed during the write. ``note`` tells, after it,
    how many conflicts there are to refuse (with the message ``conflict``) and whether a row changed.
    """
    beside, state, parts = _beside(path), F.col(_STATE), Observation()
    values = F.struct(*[F.col(quote(c)).cast("string").alias(f"p{i}") for i, c in enumerate(partition_by)])
    seen = merged.observe(parts, F.collect_set(F.when(state != DELETED, values)).alias("left"),
                          F.collect_set(F.when(F.lit(every) | state.isin(*CHANGED), values)).alias("changed"))
    (seen.filter(state != DELETED).drop(_STATE).write.mode("errorifexists").partitionBy(*partition_by)
     .parquet(beside, compression=PARQUET_CODEC))
    n, changed = note()
    if n or not (changed or every):
        delete_path(spark, beside)
        if n:
            raise MergeConflict(f"{n} {conflict}")
        return lambda: path
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    left, replaced = ({"/".join(names.getPartitionPathString(c, v) for c, v in zip(partition_by, row, strict=True))
                       for row in parts.get.get(x) or []} for x in ("left", "changed"))
    lost = sorted(p for p in left if not path_exists(spark, f"{beside}/{p}"))
    if lost:
        raise RuntimeError(f"partitions {lost} of {path} are not in {beside}")

    def publish() -> str:
        for p in sorted(replaced):
            if p in left:
                replace_path(spark, f"{beside}/{p}", f"{path.rstrip('/')}/{p}")
            else:
                delete_path(spark, f"{path.rstrip('/')}/{p}")
        delete_path(spark, beside)
        write_text(spark, f"{path.rstrip('/')}/{_SCHEMA_FILE}", schema.json())
        spark.catalog.refreshByPath(path)
        return path

    return publish


def stage_partitioned(spark: SparkSession, path: str, source: DataFrame, keys: list[str],
                      partition_by: list[str], exists: bool = True, null_safe: bool = False,
                      check: bool = True, scratch: str | None = None, as_table: bool = False,
                      allow_new_columns: bool = False, fixed_partitions: bool = False,
                      rows: Observation | None = None, scope: Scope | None = None,
                      changes: dict[str, int] | None = None, direct: bool = False) -> Callable[[], str]:
    """Do all of ``upsert_partitioned`` but the replacement, which the returned function does.

    ``direct``: a table that does not exist yet is written from the source at once, not staged first.
    """
    if as_table:
        exists = spark.catalog.tableExists(path)
    if not scratch:
        scratch = scratch_path(spark, "merge")
    rows, new, obs = rows or Observation(), [], None
    if exists:
        target = _target(spark, path, source, partition_by, as_table)
        widened = _evolve(target, source, allow_new_columns)
        src = _align(source, widened)
        if not fixed_partitions and not set(partition_by) <= set(keys):
            check_moves(target, src, keys, partition_by)
        loading = Observation()
        touched = src.select(*[F.col(quote(c)) for c in partition_by]).observe(loading, F.count(F.lit(1)).alias("rows"))
        if scope and not set(partition_by) <= set(scope.columns):
            # vanished children may lie in partitions that no loaded one is in
            own = target.select(*[F.col(quote(c)) for c in dict.fromkeys([*scope.columns, *partition_by])])
            touched = touched.unionByName(own.join(_loaded(src, scope), scope.columns, "left_semi").select(*touched.columns))
        elif scope and scope.parents is not None:
            touched = touched.unionByName(_loaded(src, scope).select(*touched.columns))
        part = _touched_rows(widened, touched, partition_by, f"{scratch}_touched")
        tasks = more_tasks(spark, part.count() + int(loading.get.get("rows", 0)), MERGE_ROWS)
        merged, obs = merge_states(part, src, keys, null_safe, rows=rows, scope=scope, tasks=tasks)
        new = [f for f in widened.schema.fields if f.name not in target.columns]
    else:
        merged = _counted(source, rows).withColumn(_STATE, F.lit(INSERTED))
    schema = T.StructType([f for f in merged.schema.fields if f.name != _STATE])
    conflict = f"target rows of {path} match several source rows on {keys}"
    if exists and not as_table:
        listed = T.StructType([T.StructField(f"__nl_p{i}", touched.schema[c].dataType) for i, c in enumerate(partition_by)])
        if spark.read.schema(listed).parquet(f"{scratch}_touched").limit(FEW_PARTITIONS + 1).count() <= FEW_PARTITIONS:
            def note() -> tuple[int, bool]:
                delete_path(spark, f"{scratch}_touched")
                found = _note(changes, obs, rows)
                return int(obs.get.get("conflicts", 0)) if check else 0, any(found[x] for x in CHANGED)

            return _stage_few(spark, path, merged, partition_by, schema, bool(new), note, conflict)
    beside = None
    if not exists and not direct and not as_table:
        # a new path conflicts with nothing: its files are written once, beside it, and take its name when published
        beside = _beside(path)
        new_rows = merged.drop(_STATE)
        few = source.select(*[F.col(quote(c)) for c in partition_by]).distinct().limit(FEW_PARTITIONS + 1).count() <= FEW_PARTITIONS
        (new_rows if few else new_rows.hint("rebalance", *partition_by)).write.mode("errorifexists").partitionBy(
            *partition_by).parquet(beside, compression=PARQUET_CODEC)
        _note(changes, obs, rows)
    elif exists or not direct:
        merged.write.parquet(scratch, compression=PARQUET_CODEC)          # cuts the lineage to the partitions about to be replaced
        merged = spark.read.schema(merged.schema).parquet(scratch)
        if exists:
            delete_path(spark, f"{scratch}_touched")
        _note(changes, obs, rows)
    n = int(obs.get.get("conflicts", 0)) if obs is not None else 0
    if check and n:
        delete_path(spark, scratch)
        raise MergeConflict(f"{n} {conflict}")
    left = merged.filter(F.col(_STATE) != DELETED)
    emptied = None
    if exists:
        at = [f"__nl_c{i}" for i in range(len(partition_by))]
        parts = lambda df: df.select(*[F.col(quote(c)).alias(n) for c, n in zip(partition_by, at, strict=True)]).distinct()
        # if a column was added, every touched partition gets it
        changed = merged if new else merged.filter(F.col(_STATE).isin(*CHANGED))
        if obs.get.get(DELETED, 0):
            emptied = (parts(merged.filter(F.col(_STATE) == DELETED)).join(left.select(*partition_by).distinct(),
                                                                           _same(partition_by, at), "left_anti")
                       .select(*[F.col(n).alias(c) for c, n in zip(partition_by, at, strict=True)]))
        left = left.join(parts(changed), _same(partition_by, at), "left_semi")
    # one writer per partition value, large ones split (AQE), instead of a file per task and value
    staged = left.drop(_STATE).hint("rebalance", *partition_by)
    unchanged = exists and not new and not any(obs.get.get(x, 0) for x in CHANGED)

    def publish() -> str:
        if unchanged:
            delete_path(spark, scratch)
            return path
        if beside:
            rename_path(spark, beside, path)
        elif not exists:
            w = staged.write.mode("errorifexists").partitionBy(*partition_by)
            w.saveAsTable(path) if as_table else w.parquet(path, compression=PARQUET_CODEC)
        elif as_table:
            if new:
                cols = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in new)
                spark.sql(f"ALTER TABLE {_quoted(path)} ADD COLUMNS ({cols})")
            # insertInto is positional: the table's column order, partition columns last
            cols = spark.table(path).columns
            key = "spark.sql.sources.partitionOverwriteMode"   # insertInto reads the session setting
            prev = spark.conf.get(key)
            spark.conf.set(key, "dynamic")
            try:
                staged.select(*[F.col(quote(c)) for c in cols]).write.mode("overwrite").insertInto(path)
            finally:
                spark.conf.set(key, prev)
        else:
            (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*partition_by).parquet(path, compression=PARQUET_CODEC))
        if emptied is not None:
            _drop_partitions(spark, path, partition_by, emptied, as_table)
        if not as_table:
            write_text(spark, f"{path.rstrip('/')}/{_SCHEMA_FILE}", schema.json())
        if direct and not exists:
            _note(changes, None, rows)
        delete_path(spark, scratch)
        return path

    return publish


def upsert_partitioned(spark: SparkSession, path: str, source: DataFrame, keys: list[str],
                       partition_by: list[str], **options) -> str:
    """Upsert into a partitioned Parquet table, rewriting only the touched partitions.

    ``path`` is a directory, or a catalog table name with ``as_table=True``
    (then existence is looked up in the catalog; else ``exists`` says it). The
    partition columns must be fixed per key. That holds when they are key
    columns, or when ``fixed_partitions=True`` declares them an expression of
    the key; otherwise the keys are checked against the table (a join on key
    and partition columns) and ``PartitionMove`` is raised before any write.

    1. target rows of the touched partitions (pruned at run time) are merged
       with the source and written beside the table, as the partitions they will
       be, counting conflicts and changes on the way; a conflict stops here;
    2. of those partitions, the ones with an inserted, updated or deleted row take
       their place by a rename; every other partition is left untouched.

    Of catalog tables, and of more touched partitions than ``FEW_PARTITIONS``, the
    merged rows are written to ``scratch``, dealt out by partition (a file per task and
    partition would be many) and replaced with ``partitionOverwriteMode=dynamic``.

    Data movement is O(touched partitions), not O(table). Partitions are replaced
    one by one, without cross-partition atomicity. ``exists=False`` creates the
    table from the source. Read a path back with ``read_partitioned``.
    """
    return stage_partitioned(spark, path, source, keys, partition_by, **{"direct": True, **options})()


# ------------------------------------------------------------------ which batch a table has seen
_APPLIED_FILE, _APPLIED_PROPERTY = "_nl_applied", "nestlift.applied_batch"


def applied_batch(spark: SparkSession, table: str, as_table: bool = False) -> str | None:
    """The last batch that was published to a catalog table or a partitioned path, if it was noted."""
    if not as_table:
        return read_text(spark, f"{table.rstrip('/')}/{_APPLIED_FILE}")
    if not spark.catalog.tableExists(table):
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {_quoted(table)}").where(F.col("key") == _APPLIED_PROPERTY).collect()
    return found[0]["value"] if found else None


def note_batch(spark: SparkSession, table: str, batch: str, as_table: bool = False) -> None:
    """Note the batch that was just published: one value per table."""
    if as_table:
        spark.sql(f"ALTER TABLE {_quoted(table)} SET TBLPROPERTIES ('{_APPLIED_PROPERTY}' = '{batch}')")
    else:
        write_text(spark, f"{table.rstrip('/')}/{_APPLIED_FILE}", batch)


# ------------------------------------------------------------------ catalog tables
def _quoted(table: str) -> str:
    return ".".join(quote(p) for p in table.split("."))


def _merge_condition(table: str, keys: list[str], null_safe: bool) -> Column:
    parts = []
    for k in keys:
        t, s = F.col(f"{table}.{quote(k)}"), F.col(f"__nl_src.{quote(k)}")
        parts.append(t.eqNullSafe(s) if null_safe else t == s)
    return reduce(lambda a, b: a & b, parts)


def recover(spark: SparkSession, table: str) -> None:
    """Finish or undo a swap that was interrupted: the old rows come back under their name."""
    prev = f"{table}__nl_prev"
    if spark.catalog.tableExists(prev):
        if not spark.catalog.tableExists(table):
            spark.sql(f"ALTER TABLE {_quoted(prev)} RENAME TO {_quoted(table)}")
        else:
            spark.sql(f"DROP TABLE {_quoted(prev)}")      # the new rows had taken the name


def _partitions(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


# File formats without row-level MERGE.
_FILE_FORMATS = {"parquet", "orc", "json", "csv", "text", "avro", "hive"}


def _provider(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}").where("col_name = 'Provider'").collect()
    return rows[0]["data_type"].lower() if rows else ""


def stage_table(spark: SparkSession, table: str, source: DataFrame, keys: list[str],
                null_safe: bool = False, check: bool = True, allow_new_columns: bool = False,
                rows: Observation | None = None, scope: Scope | None = None,
                changes: dict[str, int] | None = None) -> Callable[[], str]:
    """Do all of ``upsert_table`` but the change of the table, which the returned function does."""
    rows = rows or Observation()
    recover(spark, table)
    staging = f"{table}__nl_next"
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(staging)}")
    if not spark.catalog.tableExists(table):
        _counted(source, rows).write.saveAsTable(staging)
        _note(changes, None, rows)

        def create() -> str:
            spark.sql(f"ALTER TABLE {_quoted(staging)} RENAME TO {_quoted(table)}")
            return table

        return create
    target = _evolve(spark.table(table), source, allow_new_columns)
    src = _align(source, target)
    if _provider(spark, table) not in _FILE_FORMATS:
        if scope:
            raise NotImplementedError("a scope is not offered for formats with row-level MERGE")
        if check:
            check_conflicts(target, src, keys, null_safe)
        m = _counted(src, rows).alias("__nl_src").mergeInto(table, _merge_condition(table.split(".")[-1], keys, null_safe))
        if allow_new_columns:
            m = m.withSchemaEvolution()

        def merge() -> str:
            m.whenMatched().updateAll().whenNotMatched().insertAll().merge()
            return table

        return merge
    parts = _partitions(spark, table)
    if parts:       # a partitioned table keeps its partitions: the touched ones are replaced
        return stage_partitioned(spark, table, source, keys, parts, null_safe=null_safe, check=check, as_table=True,
                                 allow_new_columns=allow_new_columns, rows=rows, scope=scope, changes=changes)
    if scope:
        merged, obs = merge_states(target, src, keys, null_safe, rows=rows, scope=scope)
        merged = merged.filter(F.col(_STATE) != DELETED).drop(_STATE)
    else:
        merged, obs = merge_with_conflicts(target, src, keys, null_safe, rows=rows)
    merged.write.saveAsTable(staging)
    n = int(obs.get.get("conflicts", 0))
    if check and n:
        spark.sql(f"DROP TABLE {_quoted(staging)}")
        raise MergeConflict(f"{n} target rows of {table} match several source rows")
    found = _note(changes, obs, rows)
    if not n and len(target.columns) == len(spark.table(table).columns) and not any(found[x] for x in CHANGED):
        spark.sql(f"DROP TABLE {_quoted(staging)}")
        return lambda: table

    def swap() -> str:
        swap_in(spark, table)
        return table

    return swap


def swap_in(spark: SparkSession, table: str) -> None:
    """Give the staging table the table's name.

    The old table is renamed aside first and dropped only when the new one can
    be found. Interrupted in between, the next ``recover`` (every upsert starts
    with it) gives the old rows their name back.
    """
    q, qs, qp = (_quoted(f"{table}{x}") for x in ("", "__nl_next", "__nl_prev"))
    spark.sql(f"ALTER TABLE {q} RENAME TO {qp}")
    spark.sql(f"ALTER TABLE {qs} RENAME TO {q}")
    if not spark.catalog.tableExists(table):
        raise RuntimeError(f"{table} is missing after its swap; its old rows are in {table}__nl_prev")
    spark.sql(f"DROP TABLE {qp}")


def upsert_table(spark: SparkSession, table: str, source: DataFrame, keys: list[str],
                 null_safe: bool = False, check: bool = True,
                 allow_new_columns: bool = False) -> str:
    """Upsert into a catalog table; create it when absent.

    Table formats with row-level operations are merged in place
    (``mergeInto``). Of file formats, a partitioned table has its touched
    partitions replaced (``upsert_partitioned``); else the merged rows are
    written to a staging table that is swapped in by name.
    """
    return stage_table(spark, table, source, keys, null_safe, check, allow_new_columns)()
