"""Column profiles: one row per column.

Counts, extremes, means and lengths of every column come from one aggregate.
Distinct counts and most common values come from a value count per column, each
reading just that column. Quantiles are exact (see `quantiles`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F, types as T

from weftline.functions.columns import DATE_TYPES, is_numeric, present, quote
from weftline.operators.quantiles import column_quantiles

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def _chosen(df: DataFrame, include: list[str] | None, exclude: list[str] | None) -> list[T.StructField]:
    skip = set(exclude or ())
    wanted = [f for f in df.schema.fields if (not include or f.name in include) and f.name not in skip]
    if not wanted:
        raise ValueError("no column left to profile")
    return wanted


def dataset_info(df: DataFrame, include=None, exclude=None) -> DataFrame:
    """One row: rows, columns and how many columns a profile would cover."""
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        "total_rows", F.lit(len(df.columns)).alias("total_columns"),
        F.lit(len(_chosen(df, include, exclude))).alias("profiled_columns"))


def _basic(df: DataFrame, fields: list[T.StructField]) -> DataFrame:
    aggregates, structs = [F.count(F.lit(1)).alias("rows")], []
    for i, f in enumerate(fields):
        c, tag = present(f.name, f.dataType), f"c{i}"
        none = F.lit(None)
        number, length, moment = is_numeric(f.dataType), isinstance(f.dataType, T.StringType), isinstance(f.dataType, DATE_TYPES)
        aggregates.append(F.count(c).alias(f"{tag}_n"))
        if number:
            d = c.cast("double")
            aggregates += [F.min(d).alias(f"{tag}_min"), F.max(d).alias(f"{tag}_max"), F.avg(d).alias(f"{tag}_mean"),
                           F.stddev_samp(d).alias(f"{tag}_std")]
        if length:
            n = F.char_length(c)
            aggregates += [F.min(n).alias(f"{tag}_min"), F.max(n).alias(f"{tag}_max"), F.avg(n).alias(f"{tag}_mean")]
        if moment:
            aggregates += [F.min(c).cast("timestamp").alias(f"{tag}_min"), F.max(c).cast("timestamp").alias(f"{tag}_max")]

        def stat(name, on, kind, tag=tag):
            return (F.col(f"{tag}_{name}") if on else F.lit(None)).cast(kind)

        filled = F.col(f"{tag}_n")
        # A single value has spread 0; no value has none.
        std = F.when(filled > 0, F.coalesce(F.col(f"{tag}_std"), F.lit(0.0))) if number else none
        days = F.floor((F.unix_micros(F.col(f"{tag}_max")) - F.unix_micros(F.col(f"{tag}_min"))) / F.lit(86_400_000_000)) if moment else none
        structs.append(F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col("rows").alias("count"), (F.col("rows") - filled).alias("null_count"),
            F.when(F.col("rows") > 0, (F.col("rows") - filled) * 100.0 / F.col("rows")).cast("double").alias("null_percentage"),
            stat("min", number, "double").alias("min"), stat("max", number, "double").alias("max"),
            stat("mean", number, "double").alias("mean"), std.cast("double").alias("std"),
            stat("min", length, "bigint").alias("min_length"), stat("max", length, "bigint").alias("max_length"),
            stat("mean", length, "double").alias("avg_length"),
            stat("min", moment, "timestamp").alias("min_date"), stat("max", moment, "timestamp").alias("max_date"),
            days.cast("bigint").alias("date_range_days"),
        ))
    return df.agg(*aggregates).select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Columns `value`, `n`: how often each non-null value occurs."""
    c = present(column, df.schema[column].dataType)
    return df.select(c.alias("value")).filter("value is not null").groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(df: DataFrame, columns: list[str], approx: bool = False) -> DataFrame:
    def one(name):
        if approx:
            c = present(name, df.schema[name].dataType)
            return df.agg(F.approx_count_distinct(c).alias("unique_count")).select(F.lit(name).alias("column"), "unique_count")
        return value_counts(df, name).agg(F.count(F.lit(1)).alias("unique_count")).select(F.lit(name).alias("column"), "unique_count")

    return reduce(DataFrame.unionByName, [one(c) for c in columns])


def most_common(df: DataFrame, columns: list[str], top: int = 5) -> DataFrame:
    """The `top` most frequent values of each text column, ties by value.

    The row_number filter lets every task keep only its own `top` candidates.
    """
    counted = reduce(DataFrame.unionByName, [
        value_counts(df, c).select(F.lit(c).alias("column"), F.col("value").cast("string").alias("value"), "n") for c in columns])
    order = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    return counted.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= top)


def profile(df: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None,
            approx: bool = False, top: int = 5) -> DataFrame:
    """Profile of every chosen column; join keys are column names, so those joins are tiny."""
    fields = _chosen(df, include, exclude)
    names = [f.name for f in fields]
    countable = [f.name for f in fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    out = _basic(df, fields).join(distinct_counts(df, countable, approx), "column", "left")

    numbers = [f.name for f in fields if is_numeric(f.dataType)]
    if numbers:
        if approx:
            quart = reduce(DataFrame.unionByName, [
                df.agg(F.percentile_approx(F.col(quote(n)).cast("double"), list(QUARTILES.values())).alias("q"))
                .select(F.lit(n).alias("column"), *[F.col("q")[i].alias(k) for i, k in enumerate(QUARTILES)]) for n in numbers])
        else:
            quart = column_quantiles(df, numbers, QUARTILES)
    else:
        quart = df.sparkSession.createDataFrame([], "column string, q25 double, q50 double, q75 double")
    out = out.join(quart, "column", "left")

    texts = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    if texts:
        listed = (most_common(df, texts, top).groupBy("column")
                  .agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("position", "value", "n"))),
                                             lambda s: F.struct(s["value"].alias("value"), s["n"].alias("n")))).alias("most_common")))
        out = out.join(listed, "column", "left")
    else:
        out = out.withColumn("most_common", F.lit(None).cast("string"))
    return out.select(
        "position", "column", "dtype", "count", "null_count", "null_percentage", "unique_count",
        F.when(F.col("count") > 0, F.col("unique_count") * 100.0 / F.col("count")).otherwise(0.0).cast("double").alias("unique_percentage"),
        "min", "max", "mean", F.col("q50").alias("median"), "std", "q25", "q50", "q75",
        "min_length", "max_length", "avg_length", "most_common", "min_date", "max_date", "date_range_days")
