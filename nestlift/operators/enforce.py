"""Declared-schema enforcement: one ``select`` that names, orders and types every column.

* present column, declared complex (array/struct)  -> JSON text (``to_json``)
* present column, declared scalar                  -> ``try_cast`` (bad text -> NULL)
* absent column                                    -> NULL of the declared type
* present column of a type no cast relates         -> typed NULL (reported by ``drift``)
* undeclared column                                -> dropped (reported by ``drift``)

Column presence is an exact, case-sensitive name test. A frame whose
columns collide by case is rejected, since Spark would resolve either name
to both.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import to_json_text
from ..functions.types import is_complex, quote, resolve
from ..spec import _case_collisions


class SchemaConflict(TypeError):
    """A declared scalar column holds an array/struct value."""


def typed_column(name: str, declared: str, actual: T.DataType | None) -> Column:
    """The output expression for one declared column."""
    out, as_json = resolve(declared)
    if actual is None:
        return F.lit(None).cast(out).alias(name)
    c = F.col(quote(name))
    if as_json:
        expr = to_json_text(c) if isinstance(actual, (T.ArrayType, T.StructType)) else c.cast("string")
        return expr.alias(name)
    if isinstance(out, T.StringType):
        return c.cast("string").alias(name)
    if is_complex(actual):
        raise SchemaConflict(f"column {name!r} is declared {declared!r} but holds {actual.simpleString()}")
    if actual == out:
        return c.alias(name)
    if not castable(actual, out):
        return F.lit(None).cast(out).alias(name)
    return c.try_cast(out).alias(name)


# scalar pairs that no cast relates: values become typed NULLs, and drift reports the column
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


def castable(actual: T.DataType, out: T.DataType) -> bool:
    """Whether ``try_cast`` accepts this pair of scalar types."""
    if isinstance(actual, (T.NullType, T.StringType)) or isinstance(out, T.StringType) or actual == out:
        return not isinstance(out, T.BinaryType) or isinstance(actual, (T.StringType, T.BinaryType, T.NullType))
    if isinstance(actual, _NUMBERS):
        return isinstance(out, (*_NUMBERS, T.BooleanType, T.TimestampType))
    if isinstance(actual, T.BooleanType):
        return isinstance(out, _NUMBERS)
    if isinstance(actual, (T.DateType, *_TIMES)):
        return isinstance(out, (T.DateType, *_TIMES)) or (isinstance(actual, T.TimestampType) and isinstance(out, _NUMBERS))
    return False


def _check_case(df: DataFrame) -> None:
    bad = _case_collisions(df.columns)
    if bad:
        raise SchemaConflict(f"columns differ only in case: {bad}")


# with ``mark_losses``: per column that a cast can empty, whether it emptied this row's value
LOST = "__nl_lost"


def can_lose(declared: str, actual: T.DataType | None) -> bool:
    """Whether typing a column as declared can turn a value into NULL."""
    out, as_json = resolve(declared)
    return not (actual is None or as_json or isinstance(out, T.StringType) or actual == out)


def enforce(df: DataFrame, schema: Mapping[str, str], mark_losses: bool = False) -> DataFrame:
    """Typed, ordered output columns exactly as declared.

    ``mark_losses`` adds a struct column ``LOST`` that says of every column whose
    cast can fail whether a value of this row became NULL in it; the upserts count
    and drop it while they write.
    """
    _check_case(df)
    actual = {f.name: f.dataType for f in df.schema.fields}
    typed = [typed_column(n, t, actual.get(n)) for n, t in schema.items()]
    marks = [(F.col(quote(n)).isNotNull() & typed_column(n, t, actual[n]).isNull()).alias(n)
             for n, t in schema.items() if mark_losses and can_lose(t, actual.get(n))]
    return df.select(*typed, *([F.struct(*marks).alias(LOST)] if marks else []))


def enforce_strings(df: DataFrame, columns) -> DataFrame:
    """Names and order only: absent columns become NULL strings, extras are dropped."""
    _check_case(df)
    present = set(df.columns)
    return df.select(*[F.col(quote(c)) if c in present else F.lit(None).cast("string").alias(c)
                       for c in columns])


DRIFT_SCHEMA = "table STRING, column STRING, kind STRING, declared STRING, actual STRING"


def drift_rows(table: str, actual: T.StructType, schema: Mapping[str, str]) -> list[tuple]:
    """Missing (declared, not found), extra (found, not declared), then type (no cast) columns."""
    have = {f.name: f.dataType.simpleString() for f in actual.fields}
    rows = [(table, c, "missing", t, None) for c, t in schema.items() if c not in have]
    rows += [(table, c, "extra", None, t) for c, t in have.items() if c not in schema]
    for f in actual.fields:
        if f.name in schema:
            out, as_json = resolve(schema[f.name])
            if not as_json and not isinstance(out, T.StringType) and (is_complex(f.dataType) or not castable(f.dataType, out)):
                rows.append((table, f.name, "type", schema[f.name], f.dataType.simpleString()))
    return rows


def drift(spark: SparkSession, reports: list[tuple[str, T.StructType, Mapping[str, str]]]) -> DataFrame:
    """Schema drift report as a small DataFrame (one row per column, not per record)."""
    rows = [r for t, a, s in reports for r in drift_rows(t, a, s)]
    return spark.createDataFrame(rows, DRIFT_SCHEMA)
