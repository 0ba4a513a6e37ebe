"""JSON text <-> typed columns, all as built-in Spark expressions.

* ``parse``       from_json + star-expand, optionally keeping malformed text
* ``infer_schema`` schema of a JSON text column (Spark's JSON inference)
* ``to_json_text`` struct/array -> JSON text with microsecond timestamps
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .types import quote

CORRUPT = "_corrupt_record"

# Timestamp text layouts used when records are written as JSON.
# Spark's default keeps milliseconds only; these keep microseconds.
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
JSON_WRITE_OPTIONS = {"timestampFormat": TS_FORMAT, "timestampNTZFormat": TS_NTZ_FORMAT}


def to_json_text(c: Column) -> Column:
    """Struct/array -> JSON text; NULL struct fields omitted, timestamps to the microsecond."""
    return F.to_json(c, JSON_WRITE_OPTIONS)


def parse(df: DataFrame, schema: T.StructType, column: str = "raw_json",
          keep: tuple[str, ...] | list[str] = (), corrupt_column: str | None = None) -> DataFrame:
    """``from_json(column, schema)`` expanded to top-level columns.

    Permissive: malformed text gives a row of NULLs. With ``corrupt_column``
    the malformed text itself is kept in that column so it can be routed to a
    quarantine (see ``split_corrupt``). Columns in ``keep`` (e.g. bronze
    metadata) are carried through unchanged, in front.
    """
    opts = {"mode": "PERMISSIVE"}
    if corrupt_column:
        if corrupt_column not in schema.fieldNames():
            schema = T.StructType(schema.fields + [T.StructField(corrupt_column, T.StringType())])
        opts["columnNameOfCorruptRecord"] = corrupt_column
    rec = "__nl_rec"
    parsed = df.select(*[F.col(quote(k)) for k in keep],
                       F.from_json(F.col(quote(column)), schema, opts).alias(rec))
    fields = [F.col(rec)[f.name].alias(f.name) for f in schema.fields if f.name not in keep]
    return parsed.select(*[F.col(quote(k)) for k in keep], *fields)


def split_corrupt(parsed: DataFrame, corrupt_column: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, quarantined rows)."""
    bad = F.col(quote(corrupt_column)).isNotNull()
    return parsed.filter(~bad).drop(corrupt_column), parsed.filter(bad)


def _kinds(df: DataFrame, column: str) -> DataFrame:
    """One row: the schemas of a JSON text column's records and arrays, and its bad values.

    Each value is parsed once, in a projection of its own, and its fields are walked once, by
    the aggregate: objects and arrays are told by their first character (JSON knows four blanks).
    """
    text, v, array = F.col("__nl_text"), F.col("__nl_v"), F.col("__nl_array")
    values = (df.select(F.col(quote(column)).cast("string").alias("__nl_text"))
              .select("__nl_text", F.try_parse_json(text).alias("__nl_v"),
                      F.substring(F.ltrim(text, F.lit(" \t\r\n")), 1, 1).alias("__nl_first"))
              .select("__nl_v", text.isNotNull().alias("__nl_set"), "__nl_first", (F.col("__nl_first") == "[").alias("__nl_array")))
    objects = F.when(array, F.schema_of_variant(v).rlike("^ARRAY<(OBJECT<|VOID>)")).otherwise(F.col("__nl_first").isin("{", "n"))
    return values.agg(F.schema_of_variant_agg(F.when(~array, v)).alias("records"),
                      F.schema_of_variant_agg(F.when(array, v)).alias("arrays"),
                      F.count_if(F.col("__nl_set") & (v.isNull() | ~objects)).alias("bad"))


def infer_schema(df: DataFrame, column: str = "raw_json") -> T.StructType:
    """The fields of a JSON text column, over every value (no sample: rare and late fields count).

    One JVM-side partial aggregate (``schema_of_variant_agg``). Numbers with a
    fraction or beyond BIGINT are DOUBLE; a field seen with different kinds of
    values, or only as NULL, is STRING. A value that is an
    array of objects contributes its elements' fields. If any value is malformed,
    or neither an object nor an array of objects, the schema has a
    ``_corrupt_record``. No values: no fields.
    """
    agg = _kinds(df, column).first()
    fields: dict[str, T.DataType] = {}
    for text in (agg["records"], agg["arrays"]):
        t = _variant_type(text)
        t = t.elementType if isinstance(t, T.ArrayType) else t
        if isinstance(t, T.StructType):
            for f in t.fields:
                fields[f.name] = f.dataType if fields.get(f.name, f.dataType) == f.dataType else T.StringType()
    if agg["bad"]:
        fields[CORRUPT] = T.StringType()
    return T.StructType([T.StructField(n, fields[n]) for n in sorted(fields)])


def _variant_type(text: str | None) -> T.DataType:
    """A variant schema text as the type a JSON parse should use."""
    parts = re.split(r"(`(?:[^`]|``)*`)", text or "VOID")       # names in backticks stay as they are
    ddl = "".join(x if i % 2 else re.sub(r"\bOBJECT<", "STRUCT<", x) for i, x in enumerate(parts))

    def hollow(t: T.DataType) -> bool:      # only {} seen: nothing to store
        return hollow(t.elementType) if isinstance(t, T.ArrayType) else (
            isinstance(t, T.StructType) and all(hollow(f.dataType) for f in t.fields))

    def plain(t: T.DataType) -> T.DataType:
        if isinstance(t, T.StructType):
            return T.StructType([T.StructField(f.name, plain(f.dataType)) for f in t.fields if not hollow(f.dataType)])
        if isinstance(t, T.ArrayType):
            return T.ArrayType(plain(t.elementType))
        if isinstance(t, (T.DecimalType, T.DoubleType, T.FloatType)):
            return T.DoubleType()
        return t if isinstance(t, (T.LongType, T.BooleanType)) else T.StringType()

    return plain(T._parse_datatype_string(ddl))


def element_schema(inferred: T.StructType) -> T.DataType:
    """Schema to parse a JSON-text level with: the inferred struct as array elements.

    A lone object parsed with an array-of-struct schema becomes a 1-element
    array, so both ``{..}`` and ``[{..}, ..]`` texts explode the same way.
    """
    return T.ArrayType(inferred)
