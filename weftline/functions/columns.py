"""Column expressions shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# --- fixed values ---
NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# --- end of fixed values ---

NUMERIC_TYPES = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
)
DATE_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC_TYPES)


def present(name: str, dtype: T.DataType) -> Column:
    """The column with NaN read as null, as a record-based tool would read it."""
    c = F.col(quote(name))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c)
    return c


def to_number(c: Column) -> Column:
    """Text to double; anything that is not plain decimal notation becomes null.

    The guard is needed because a SQL cast also accepts suffixes such as `1.5d`.
    """
    return F.when(c.rlike(NUMERIC_TEXT), F.trim(c).try_cast("double"))


def looks_whole(c: Column) -> Column:
    """For numeric text: no fraction and no exponent."""
    return ~c.contains(".") & ~c.contains("e") & ~c.contains("E")


def fits_double(c: Column) -> Column:
    """For whole numeric text: a double holds it without rounding."""
    return F.coalesce(F.abs(F.trim(c).try_cast("decimal(38,0)")) <= (1 << 53), F.lit(False))


def starts_matching(c: Column, pattern: str) -> Column:
    """True where the text matches the pattern from its first character on."""
    return c.cast("string").rlike(f"^(?:{pattern})")


def to_time(name: str, dtype: T.DataType) -> Column:
    """Column as a session-zone timestamp, null where it cannot be read."""
    c = F.col(quote(name))
    if isinstance(dtype, T.StringType):
        return c.try_cast("timestamp")
    return c.cast("timestamp")


def json_text(c: Column) -> Column:
    return F.to_json(c, {"ignoreNullFields": "false"})
