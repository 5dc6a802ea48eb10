"""Row cleaning in a fixed order: duplicates, missing values, types, ranges, patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from weftline.functions.columns import is_numeric, quote, starts_matching, to_number

# Names a rule may use for a target type, and the SQL type each one means.
TYPE_NAMES = {
    "int": "bigint", "int64": "bigint", "integer": "int", "int32": "int",
    "float": "double", "float64": "double", "float32": "float",
    "str": "string", "string": "string", "object": "string",
    "bool": "boolean", "boolean": "boolean", "date": "date", "timestamp": "timestamp",
}


def drop_duplicates(df: DataFrame, subset: list[str] | None = None, order_by: list | None = None) -> DataFrame:
    """Whole-row distinct, or the first row per `subset` in the given order.

    Rows have no order of their own, so a subset needs one. The `row_number = 1`
    filter is pushed below the shuffle: each task sends at most one row per key,
    however many copies a key has.
    """
    if subset is None:
        return df.dropDuplicates()
    if not order_by:
        raise ValueError("duplicates by subset need order_by to say which row is kept")
    first = Window.partitionBy(*[F.col(quote(c)) for c in subset]).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn")


def fill_missing(df: DataFrame, rules: dict[str, object]) -> DataFrame:
    """`drop`, `fill_zero`, `fill_mean` or `fill_<literal>` per column, in the order given.

    All means between two drops come from one aggregate, as filling a column changes no other column's mean.
    """
    means, averaged = None, [c for c, action in rules.items() if action == "fill_mean" and c in df.columns and is_numeric(df.schema[c].dataType)]
    for name, action in rules.items():
        if name not in df.columns:
            continue
        dtype, c = df.schema[name].dataType, F.col(quote(name))
        if action == "drop":
            df, means = df.na.drop(subset=[name]), None
        elif action == "fill_zero":
            df = df.withColumn(name, F.coalesce(c, F.lit(0).cast(dtype)))
        elif action == "fill_mean":
            if not is_numeric(dtype):
                raise ValueError(f"fill_mean needs a numeric column, {name} is {dtype.simpleString()}")
            if means is None:
                means = df.agg(F.struct(*[F.avg(F.col(quote(x))).alias(x) for x in averaged])).scalar()
            df = df.withColumn(name, F.coalesce(c.cast("double"), means.getField(name)))
        elif isinstance(action, str) and action.startswith("fill_"):
            df = df.withColumn(name, F.coalesce(c, F.lit(action.removeprefix("fill_")).cast(dtype)))
        else:
            raise ValueError(f"unknown missing-value action for {name}: {action}")
    return df


def convert_types(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """`datetime` and `numeric` turn unreadable values into null; any other type is all or nothing."""
    strict = {}
    for name, target in rules.items():
        if name not in df.columns:
            continue
        dtype, c = df.schema[name].dataType, F.col(quote(name))
        if target == "datetime":
            df = df.withColumn(name, c.try_cast("timestamp"))
        elif target == "numeric":
            if not is_numeric(dtype):
                df = df.withColumn(name, to_number(c.cast("string")))
        else:
            strict[name] = TYPE_NAMES.get(target, target)
    return _cast_if_lossless(df, strict) if strict else df


def _cast_if_lossless(df: DataFrame, targets: dict[str, str]) -> DataFrame:
    """Cast a column only if every value survives; one aggregate decides for all columns."""
    lost = {}
    for i, (name, kind) in enumerate(targets.items()):
        c = F.col(quote(name))
        lost[name] = F.count_if(c.isNotNull() & c.try_cast(kind).isNull()).alias(f"c{i}")
    counts = df.agg(*lost.values()).first()
    good = {name: kind for (name, kind), bad in zip(targets.items(), counts) if bad == 0}
    return df.withColumns({name: F.col(quote(name)).cast(kind) for name, kind in good.items()}) if good else df


def apply_ranges(df: DataFrame, rules: dict[str, dict], drop_invalid: bool = False) -> DataFrame:
    """Clamp to [min, max], or drop rows outside it. Nulls are always kept."""
    for name, bounds in rules.items():
        if name not in df.columns:
            continue
        c, low, high = F.col(quote(name)), bounds.get("min"), bounds.get("max")
        if drop_invalid:
            if low is not None:
                df = df.filter(c.isNull() | (c >= F.lit(low)))
            if high is not None:
                df = df.filter(c.isNull() | (c <= F.lit(high)))
            continue
        clamped = c
        if high is not None:
            clamped = F.when(c > F.lit(high), F.lit(high)).otherwise(clamped)
        if low is not None:
            clamped = F.when(c < F.lit(low), F.lit(low)).otherwise(clamped)
        df = df.withColumn(name, _same_kind(clamped, df.schema[name].dataType, low, high))
    return df


def _same_kind(c: Column, dtype: T.DataType, low, high) -> Column:
    """Keep the column type unless a fractional bound needs more room than an integer has."""
    fractional = any(isinstance(b, float) and not b.is_integer() for b in (low, high))
    whole = isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    return c.cast("double") if whole and fractional else c.cast(dtype)


def apply_patterns(df: DataFrame, rules: dict[str, str], drop_invalid: bool = False) -> DataFrame:
    """Drop rows that do not match from the start, or flag them with `<column>_valid = false`."""
    for name, pattern in rules.items():
        if name not in df.columns:
            continue
        matches = F.coalesce(starts_matching(F.col(quote(name)), pattern), F.lit(False))
        if drop_invalid:
            df = df.filter(matches)
        else:
            df = df.withColumn(f"{name}_valid", F.when(~matches, F.lit(False)))
    return df


def clean(df: DataFrame, rules: dict, drop_invalid: bool = False, order_by: list | None = None) -> DataFrame:
    if rules.get("remove_duplicates"):
        df = drop_duplicates(df, rules.get("duplicate_subset"), order_by or rules.get("order_by"))
    df = fill_missing(df, rules.get("missing_values") or {})
    df = convert_types(df, rules.get("type_conversions") or {})
    df = apply_ranges(df, rules.get("range_validations") or {}, drop_invalid)
    return apply_patterns(df, rules.get("pattern_validations") or {}, drop_invalid)


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Every decimal column as double, for SQL that mixes it with floating point."""
    casts = {f.name: F.col(quote(f.name)).cast("double") for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)}
    return df.withColumns(casts) if casts else df
