"""Fit a DataFrame to its target: names, types, missing and extra columns, plain values."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weftline.functions.columns import quote
from weftline.functions.names import clean_identifier, dedupe_names, match_column

# --- fixed values ---
NULL_WORDS = ["nan", "null", "none", ""]
DDL_TYPES = {"INTEGER": "int", "SERIAL": "int", "BIGINT": "bigint", "SMALLINT": "smallint", "TEXT": "string", "JSONB": "string",
             "JSON": "string", "UUID": "string", "INET": "string", "DOUBLE PRECISION": "double", "REAL": "float", "NUMERIC": "decimal(38,10)",
             "TIMESTAMP": "timestamp", "TIMESTAMPTZ": "timestamp", "DATE": "date", "BOOLEAN": "boolean", "FLOAT": "double",
             "Int64": "bigint", "UInt8": "tinyint", "Float64": "double", "DateTime": "timestamp", "String": "string"}
# --- end of fixed values ---

_INTEGERS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


def spark_type(ddl: str) -> str:
    """Type name of a database column as a Spark type: VARCHAR(50) -> string, NUMERIC(12,2) -> decimal(12,2)."""
    text = ddl.strip()
    if text in DDL_TYPES:
        return DDL_TYPES[text]
    upper = text.upper()
    for suffix in (" NOT NULL", " NULL", " PRIMARY KEY", " UNIQUE"):
        upper = upper.removesuffix(suffix)
    if upper.startswith("NULLABLE("):
        return spark_type(text[len("Nullable("):-1])
    if upper in DDL_TYPES:
        return DDL_TYPES[upper]
    if upper.startswith(("VARCHAR", "CHAR")):
        return "string"
    return upper.replace("NUMERIC", "DECIMAL").lower()


def with_schema(df: DataFrame, table_schema: dict[str, str]) -> DataFrame:
    """Columns of an explicit schema, in its order; a column the data lacks is null."""
    return df.select(*[
        (F.col(quote(name)) if name in df.columns else F.lit(None)).cast(spark_type(kind)).alias(name)
        for name, kind in table_schema.items()])


def _without_null_words(c: Column) -> Column:
    return F.when(~F.lower(c).isin(*NULL_WORDS), c)


def serialize_for_sink(df: DataFrame, nested_as_text: bool = True) -> DataFrame:
    """NaN, infinities and words for null become null; decimals double; bytes and nested values text."""
    columns = []
    for f in df.schema.fields:
        c, t = F.col(quote(f.name)), f.dataType
        if isinstance(t, (T.FloatType, T.DoubleType)):
            c = F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)
        elif isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, T.StringType):
            c = _without_null_words(c)
        elif isinstance(t, T.BinaryType):
            c = F.when(F.is_valid_utf8(c.cast("string")), c.cast("string")).otherwise(F.lower(F.hex(c)))
        elif nested_as_text and isinstance(t, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            c = F.when(c.isNotNull(), F.to_json(c, {"ignoreNullFields": "false"}))
        columns.append(c.alias(f.name))
    return df.select(*columns)


def all_string(df: DataFrame) -> DataFrame:
    """Every column as text, for stores that take text only."""
    return df.select(*[F.col(quote(c)).cast("string").alias(c) for c in df.columns])


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*dedupe_names([clean_identifier(c) for c in df.columns]))


def merge_values(older: Column, newer: Column, text: bool) -> Column:
    """Two inputs for one column: the filled one; two different texts joined; else the newer."""
    def empty(c):
        return (c.isNull() | (c == "")) if text else c.isNull()

    both = F.concat_ws("; ", older, newer) if text else newer
    return F.when(empty(older), F.coalesce(newer, older)).when(empty(newer) | (older == newer), older).otherwise(both)


def align_to(df: DataFrame, target: list[str]) -> DataFrame:
    """Rename to the target's columns, merge inputs of the same column, drop the rest.

    Only names are compared, on the driver; the data sees one projection.
    """
    inputs: dict[str, list[T.StructField]] = defaultdict(list)
    for f in df.schema.fields:
        match = match_column(f.name, target)
        if match is not None:
            inputs[match].append(f)
    columns = []
    for name in target:
        if name not in inputs:
            continue
        first, *rest = inputs[name]
        merged = F.col(quote(first.name))
        for f in rest:
            text = isinstance(first.dataType, T.StringType) and isinstance(f.dataType, T.StringType)
            merged = merge_values(merged, F.col(quote(f.name)), text)
        columns.append(merged.alias(name))
    return df.select(*columns)


def widened(old: T.DataType, new: T.DataType) -> T.DataType:
    """The smallest type that holds both without loss; raises where there is none."""
    if old == new:
        return old
    if type(old) in _INTEGERS and type(new) in _INTEGERS:
        return max(old, new, key=lambda t: _INTEGERS.index(type(t)))
    small = (T.ByteType, T.ShortType, T.IntegerType, T.FloatType)
    for a, b in ((old, new), (new, old)):
        if isinstance(a, T.DoubleType) and isinstance(b, small):
            return a
        if isinstance(a, T.StringType):
            return a
        if isinstance(a, T.TimestampType) and isinstance(b, T.DateType):
            return a
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        scale = max(old.scale, new.scale)
        whole = max(old.precision - old.scale, new.precision - new.scale)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    raise TypeError(f"no lossless common type for {old.simpleString()} and {new.simpleString()}")


def evolve(incoming: DataFrame, target: T.StructType) -> tuple[DataFrame, T.StructType]:
    """Incoming rows and the schema both sides fit: new columns nullable, types only widened."""
    merged = {f.name: f.dataType for f in target.fields}
    for f in incoming.schema.fields:
        merged[f.name] = widened(merged[f.name], f.dataType) if f.name in merged else f.dataType
    schema = T.StructType([T.StructField(n, t, True) for n, t in merged.items()])
    return conform(incoming, schema), schema


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns, missing ones as null."""
    return df.select(*[
        (F.col(quote(f.name)) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])
