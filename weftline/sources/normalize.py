"""Plain value types for exchange: one walk over the schema, one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weftline.functions.columns import quote

# --- fixed values ---
ISO_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
# --- end of fixed values ---


def iso_text(c: Column) -> Column:
    """ISO text, with microseconds only where there are any."""
    seconds = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(c, "SSSSSS")
    return F.when(micros == "000000", seconds).otherwise(F.concat(seconds, F.lit("."), micros))


def _binary_text(c: Column) -> Column:
    """The bytes as UTF-8 text, or as lower-case hex where they are not valid UTF-8."""
    return F.when(F.is_valid_utf8(c.cast("string")), c.cast("string")).otherwise(F.lower(F.hex(c)))


def plain(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.DecimalType):
        return c.cast("double")
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return iso_text(c)
    if isinstance(dtype, T.BinaryType):
        return _binary_text(c)
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: plain(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        keys, values = F.transform_keys(c, lambda k, v: plain(k, dtype.keyType).cast("string")), dtype.valueType
        return F.transform_values(keys, lambda k, v: plain(v, values))
    if isinstance(dtype, T.StructType):
        inner = F.struct(*[plain(c[f.name], f.dataType).alias(f.name) for f in dtype.fields])
        return F.when(c.isNotNull(), inner)
    simple = (T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
    return c if isinstance(dtype, simple) else c.cast("string")


def normalize_types(df: DataFrame) -> DataFrame:
    return df.select(*[plain(F.col(quote(f.name)), f.dataType).alias(f.name) for f in df.schema.fields])
