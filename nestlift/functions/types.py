"""Declared types: the spec's type words, and the nested ``full_schema`` shape.

Two declarations exist in a job spec:

* ``data_schema`` (per table) drives the *output* columns. Its type words are
  matched case-insensitively, mostly by substring, in a fixed order (below).
* ``full_schema`` (optional, whole record) drives *parsing*. It is an
  example-shaped JSON value: a string is a Spark DDL type, an object is a
  struct, a one-element list ``[x]`` is an array of ``x``.
"""

from __future__ import annotations

from typing import Any, Mapping

from pyspark.sql import types as T

# The output-type rules for declared type words, tried in this
# order on the stripped, lower-cased word. "contains" is a substring test,
# "equals" an exact one. A word matching none of them is a STRING.
#   1. contains "array" or "struct"     -> STRING holding JSON text
#   2. contains "timestamp" or "datetime" -> TIMESTAMP
#   3. contains "date"                  -> DATE
#   4. contains "boolean"               -> BOOLEAN
#   5. equals "int" or "long"           -> BIGINT
#   6. contains "double" or "float"     -> DOUBLE
#   7. equals "currency"                -> DECIMAL(20,2)
TYPE_RULES: tuple[tuple[str, tuple[str, ...], T.DataType | None], ...] = (
    ("contains", ("array", "struct"), None),
    ("contains", ("timestamp", "datetime"), T.TimestampType()),
    ("contains", ("date",), T.DateType()),
    ("contains", ("boolean",), T.BooleanType()),
    ("equals", ("int", "long"), T.LongType()),
    ("contains", ("double", "float"), T.DoubleType()),
    ("equals", ("currency",), T.DecimalType(20, 2)),
)


def resolve(declared: str) -> tuple[T.DataType, bool]:
    """Declared type word -> (output Spark type, is_json_text)."""
    word = declared.strip().lower()
    for how, words, out in TYPE_RULES:
        hit = any(w in word for w in words) if how == "contains" else word in words
        if hit:
            return (T.StringType(), True) if out is None else (out, False)
    return T.StringType(), False


def quote(name: str) -> str:
    """Backtick-quote an identifier so dots and spaces stay part of the name."""
    return "`" + name.replace("`", "``") + "`"


# ---------------------------------------------------------------- full_schema
def shape_to_ddl(shape: Any) -> str:
    """Compile an example-shaped declaration to a Spark DDL type string."""
    if isinstance(shape, str):
        return shape.strip()
    if isinstance(shape, Mapping):
        inner = ", ".join(f"{quote(k)}: {shape_to_ddl(v)}" for k, v in shape.items())
        return f"STRUCT<{inner}>"
    if isinstance(shape, (list, tuple)):
        if len(shape) != 1:
            raise ValueError("an array shape must hold exactly one element shape")
        return f"ARRAY<{shape_to_ddl(shape[0])}>"
    raise ValueError(f"unsupported shape element: {shape!r}")


def shape_to_struct(shape: Mapping[str, Any]) -> T.StructType:
    """Compile a record declaration to a ``StructType`` (needs an active session)."""
    ddl = ", ".join(f"{quote(k)} {shape_to_ddl(v)}" for k, v in shape.items())
    st = T.StructType.fromDDL(ddl)
    return st


# ------------------------------------------------------------------ pruning
# A "need" tree says which parts of a record a job reads: ``True`` = the
# whole value, a dict = only those fields of a struct (or of the struct
# elements of an array).
Need = "bool | dict[str, Need]"


def merge_needs(a: Any, b: Any) -> Any:
    if a is True or b is True:
        return True
    if not a:
        return b
    if not b:
        return a
    out = dict(a)
    for k, v in b.items():
        out[k] = merge_needs(out.get(k), v)
    return out


def prune(dt: T.DataType, need: Any) -> T.DataType:
    """Keep only the needed parts of ``dt``; unknown names are ignored."""
    if need is True or not need:
        return dt
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(prune(dt.elementType, need), dt.containsNull)
    if isinstance(dt, T.StructType):
        fields = [T.StructField(f.name, prune(f.dataType, need[f.name]), f.nullable)
                  for f in dt.fields if f.name in need]
        if not fields and dt.fields:
            # nothing needed inside, but the value itself still counts (e.g. one row per
            # array element): keep one field rather than an unstorable empty struct
            f = dt.fields[0]
            fields = [T.StructField(f.name, f.dataType, f.nullable)]
        return T.StructType(fields)
    return dt


def is_complex(dt: T.DataType) -> bool:
    return isinstance(dt, (T.ArrayType, T.StructType, T.MapType))
