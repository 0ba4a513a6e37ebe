"""Multi-level unnest of a parsed record along a declared path of array names.

Each level keeps only the parent-key columns found so far plus the array
being opened, so wide records never travel past the level that needs them.
Per level:

1. the named column must exist and be an array or JSON text (a struct, map
   or scalar skips the table), and must hold at least one non-NULL value
   (checked with as few ``limit(1)`` jobs as possible, see ``unnest``);
2. JSON text is parsed with the inferred (or given) element schema, a lone
   object becoming a one-element array;
3. the array is opened with ``posexplode_outer`` filtered on ``pos IS NOT
   NULL``: the same rows as an inner explode (NULL/empty array -> no row,
   NULL element -> one row) but Catalyst does not duplicate the upstream
   ``from_json`` into an inferred ``size(...) > 0`` filter;
4. a struct element is flattened into its fields; parent keys found among
   the fields join the carried set. A field named like an already carried
   key is dropped: the ancestor's key wins. An array of scalars stays one
   column named ``<name>_exploded``.

Finally the declared output schema (parent keys with their spec types, then
the child columns) is enforced. Explode is a narrow operation: no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import element_schema, infer_schema
from ..functions.types import quote
from ..spec import ChildSpec
from .enforce import enforce

_POS = "__nl_pos"
_ELEM = "__nl_elem"
_SLICE = "__nl_slice"


@dataclass
class UnnestResult:
    table: str
    df: DataFrame | None
    skipped: str | None = None
    dropped_duplicates: list[str] = field(default_factory=list)
    missing_keys: list[str] = field(default_factory=list)
    levels: list[str] = field(default_factory=list)


def open_array(df: DataFrame, carry: list[str], arr, elem: str = _ELEM, slice_rows: int | None = None) -> DataFrame:
    """``carry`` columns plus one row per array element (inner-explode rows, one generator).

    A task opens an array that it has read, so one record of millions of elements
    is one task, which no skew handling splits. With ``slice_rows``, arrays of more
    elements are first cut into slices of that many, which are dealt out by key and
    slice and then opened; the others are opened where they are.
    """
    keys = [F.col(quote(k)) for k in carry]

    def opened(rows: DataFrame, values) -> DataFrame:
        return (rows.select(*keys, F.posexplode_outer(values).alias(_POS, elem))
                .filter(F.col(_POS).isNotNull())
                .drop(_POS))

    if not slice_rows:
        return opened(df, arr)
    n = F.array_size(arr)
    # all slices of an array are cut in one pass over it; exploding their numbers first would copy the whole array to each
    cut = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / slice_rows).cast("int")),
                      lambda i: F.slice(arr, i * slice_rows + 1, F.lit(slice_rows)))
    large = df.filter(n > slice_rows).select(*keys, F.posexplode(cut).alias(_SLICE, _ELEM))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = large.repartition(parts, *keys, F.col(_SLICE))
    return opened(df.filter((n <= slice_rows) | n.isNull()), arr).unionByName(opened(dealt, F.col(_ELEM)))


def _empty(df: DataFrame, name: str) -> bool:
    c = F.col(quote(name))
    return df.select(c).filter(c.isNotNull()).limit(1).isEmpty()


def unnest(parsed: DataFrame, child: ChildSpec, probe: bool = True,
           text_schemas: Mapping[str, T.DataType] | None = None, mark_losses: bool = False,
           slice_rows: int | None = None) -> UnnestResult:
    """Build one child table from a parsed record frame.

    ``probe`` applies the rule that a level holding no value at all skips
    the table. A value at the deepest level implies values at every level
    above it, so array levels share ONE ``limit(1)`` probe at the deepest of
    them; shallower levels are probed only when it finds nothing, to name
    the empty level. A JSON-text level is probed where it stands, since its
    element schema is inferred from those values. ``text_schemas`` gives
    element schemas for JSON-text levels by name. ``mark_losses`` as in ``enforce``,
    ``slice_rows`` (array levels) as in ``open_array``.
    """
    keys = child.parent_key_names
    res = UnnestResult(child.name, None)
    cur = parsed
    carried: list[str] = []
    pending: list[tuple[int, str, DataFrame]] = []   # array levels not yet probed

    def first_empty(levels) -> str | None:
        for lv, nm, df in levels:
            if _empty(df, nm):
                return f"level {lv + 1}: {nm!r} holds no value"
        return None

    for level, name in enumerate(child.path):
        res.levels.append(name)
        if name not in cur.columns:
            res.skipped = f"level {level + 1}: column {name!r} not found"
            return res
        if level == 0:
            carried = [k for k in keys if k in cur.columns]
        dtype = cur.schema[name].dataType
        if not isinstance(dtype, (T.StringType, T.ArrayType)):
            res.skipped = f"level {level + 1}: {name!r} is {dtype.simpleString()}, not an array or JSON text"
            return res
        col = F.col(quote(name))
        if isinstance(dtype, T.StringType):
            es = (text_schemas or {}).get(name)
            if es is None:
                es = element_schema(infer_schema(cur.select(col), name))
            if probe:
                if not (es.elementType.fields if isinstance(es, T.ArrayType) and isinstance(es.elementType, T.StructType)
                        else True) or (name in (text_schemas or {}) and _empty(cur, name)):
                    res.skipped = first_empty(pending) or f"level {level + 1}: {name!r} holds no value"
                    return res
                pending.clear()   # a value here implies values at every level above
            col = F.from_json(col, es)
        else:
            pending.append((level, name, cur))
        present = [k for k in keys if k in cur.columns and k != name]
        ex = open_array(cur, present, col, slice_rows=slice_rows if isinstance(dtype, T.ArrayType) else None)
        etype = ex.schema[_ELEM].dataType
        if isinstance(etype, T.StructType):
            fields = etype.fieldNames()
            carried += [k for k in keys if k in fields and k not in carried]
            kept = [k for k in carried if k in present]
            res.dropped_duplicates += [f"{name}.{f}" for f in fields if f in kept]
            cur = ex.select(*[F.col(quote(k)) for k in kept],
                            *[F.col(_ELEM)[f].alias(f) for f in fields if f not in kept])
        else:
            cur = ex.withColumnRenamed(_ELEM, f"{name}_exploded")
    if probe and pending:
        lv, nm, df = pending[-1]
        if _empty(df, nm):
            res.skipped = first_empty(pending[:-1]) or f"level {lv + 1}: {nm!r} holds no value"
            return res
    res.missing_keys = [k for k in keys if k not in cur.columns]
    res.df = enforce(cur, child.output_schema, mark_losses)
    return res


def path_need(child: ChildSpec) -> dict:
    """The parts of a record this child reads (for ``from_json`` schema pruning)."""
    keys = child.parent_key_names
    leaf: dict = {k: True for k in keys}
    leaf.update({c: True for c, _ in child.schema})
    need: dict = leaf
    for name in reversed(child.path[1:]):
        level = {k: True for k in keys}
        level[name] = need
        need = level
    top = {k: True for k in keys}
    top[child.path[0]] = need
    return top
