"""Exact quantiles by distributed selection: no task ever holds a share of the rows.

The built-in exact `percentile` keeps every distinct value of a group in one
aggregation buffer. Here a bounded sketch first finds a narrow bracket around each
quantile. While a bracket may hold more than `few` values, another pass counts what
lies below it and sketches only what is strictly inside, which narrows it about forty
times; a hot value becomes an end of its bracket and is only counted. The last pass
keeps the values inside and collapses all others to one counted row per gap between
brackets, before anything is shuffled. The answer is the exact order statistic with
linear interpolation. Passes grow with the logarithm of the largest group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from weftline.functions.columns import quote
from weftline.session import freeze

Bracket = tuple[Column, Column]

# Brackets reach this many times the sketch's own error to each side.
SAFETY = 4.0
# Values of one bracket that one task may order.
FEW = 100_000
# A narrowing pass cuts a bracket at this many places, found with this accuracy.
STEPS, STEP_ACCURACY = 200, 10_000


def _marks(levels: list[float], accuracy: int) -> list[float]:
    margin = SAFETY / accuracy
    return [m for p in levels for m in (max(0.0, p - margin), min(1.0, p + margin))]


def _stats(v: Column, levels: list[float], accuracy: int, tag: str = "") -> list[Column]:
    return [F.count(v).alias(f"_n{tag}"), F.min(v).alias(f"_min{tag}"), F.max(v).alias(f"_max{tag}"),
            F.percentile_approx(v, _marks(levels, accuracy), accuracy).alias(f"_marks{tag}")]


def _brackets(levels: list[float], accuracy: int) -> list[Column]:
    """Columns `_n`, `_lo<i>`, `_hi<i>` and `_open`, the most values a bracket can hold.

    A group below the sketch's resolution is its own bracket.
    """
    small = F.col("_n") <= F.lit(accuracy)
    out = [F.col("_n")]
    for i in range(len(levels)):
        out.append(F.when(small, F.col("_min")).otherwise(F.get("_marks", 2 * i)).alias(f"_lo{i}"))
        out.append(F.when(small, F.col("_max")).otherwise(F.get("_marks", 2 * i + 1)).alias(f"_hi{i}"))
    return [*out, F.when(small, F.col("_n").cast("double")).otherwise(F.col("_n") * (2 * SAFETY + 2) / accuracy).alias("_open")]


def _with_brackets(rows: DataFrame, ends: DataFrame, by: list[str]) -> DataFrame:
    """Rows beside the brackets of their group; where those are small Spark broadcasts them by itself."""
    same = reduce(lambda a, b: a & b, [F.col(f"l.{quote(k)}").eqNullSafe(F.col(f"r.{quote(k)}")) for k in by])
    return rows.alias("l").join(ends.alias("r"), same).select("l.*", *[f"r.{quote(c)}" for c in ends.columns if c not in by])


def _narrower(rows: DataFrame, ends: DataFrame, by: list[str], levels: list[float]) -> DataFrame:
    """The brackets after one more pass. Only what is strictly between the ends is sketched, so ties cannot keep a bracket open."""
    v = F.col("_v")
    grid = [k / STEPS for k in range(STEPS + 1)]
    aggregates = [F.first("_n").alias("_n")]
    for i in range(len(levels)):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        between = (v > lo) & (v < hi)
        aggregates += [F.first(lo).alias(f"_lo{i}"), F.first(hi).alias(f"_hi{i}"), F.count_if(v <= lo).alias(f"_upto{i}"),
                       F.count_if(between).alias(f"_mid{i}"),
                       F.percentile_approx(F.when(between, v), grid, STEP_ACCURACY).alias(f"_grid{i}")]
    counted = _with_brackets(rows, ends, by).groupBy(*map(quote, by)).agg(*aggregates)
    out = []
    for i, p in enumerate(levels):
        lo, hi, mid, upto = (F.col(f"_{x}{i}") for x in ("lo", "hi", "mid", "upto"))
        rank = F.floor(F.lit(p) * (F.col("_n") - 1))
        first, second = rank - upto, F.least(rank + 1, F.col("_n") - 1) - upto

        def step(at: Column, move: int, mid=mid, i=i) -> Column:
            return F.get(f"_grid{i}", (F.floor(at * STEPS / mid) + move).cast("int"))

        # A step of the grid is off by less than its width, so one step down and two up hold the rank for certain.
        low = F.when(first < 0, lo).when(first >= mid, hi).otherwise(F.coalesce(step(first, -1), lo))
        high = F.when(second < 0, lo).when(second >= mid, hi).otherwise(F.coalesce(step(second, 2), hi))
        out += [low.alias(f"_lo{i}"), high.alias(f"_hi{i}")]
    held = F.greatest(F.lit(0.0), *[F.col(f"_mid{i}") * 5.0 / STEPS for i in range(len(levels))])
    return counted.select(*map(quote, by), "_n", *out, held.alias("_open"))


def _narrowed(rows: DataFrame, ends: DataFrame, by: list[str], levels: list[float], few: int) -> DataFrame:
    """Brackets of at most `few` values. Groups whose brackets are narrow enough take no further pass."""
    while (ends.agg(F.max("_open").alias("m")).first().m or 0) > few:
        wide = F.col("_open") > few
        ends = freeze(ends.filter(~wide).unionByName(_narrower(rows, ends.filter(wide), by, levels)), "brackets")
    return ends


def _reduced(rows: DataFrame, by: list[str], brackets: list[Bracket]) -> DataFrame:
    """Counts per value inside a bracket, and per gap outside. `_gap` grows with the value."""
    v = F.col("_v")
    gap = reduce(lambda a, b: a + b, [F.when(t, 1).otherwise(0) for lo, hi in brackets for t in (v >= lo, v > hi)])
    inside = reduce(lambda a, b: a | b, [(v >= lo) & (v <= hi) for lo, hi in brackets])
    keys = [quote(k) for k in by]
    return (rows.select(*keys, gap.alias("_gap"), F.when(inside, v).alias("_x"))
            .groupBy(*keys, "_gap", "_x").agg(F.count(F.lit(1)).alias("_c")))


def _joined(brackets: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Brackets in order, those that meet made one."""
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(brackets):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _pick(counts: DataFrame, by: list[str], names: list[str], levels: list[float]) -> DataFrame:
    """Order statistics out of the counted rows, interpolated."""
    keys = [quote(k) for k in by]
    order = Window.partitionBy(*keys).orderBy("_gap", "_x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("_upto", F.sum("_c").over(order)).withColumn("_rows", F.sum("_c").over(Window.partitionBy(*keys)))

    def at(rank: Column) -> Column:
        # A rank outside its bracket would mean a broken sketch; that must not pass as a null.
        value = F.coalesce(F.col("_x"), F.raise_error(F.lit("quantile outside its bracket")).cast("double"))
        return F.max(F.when((F.col("_upto") > rank) & (F.col("_upto") - F.col("_c") <= rank), value))

    aggregates, results = [], []
    for i, (name, p) in enumerate(zip(names, levels)):
        h = F.lit(p) * (F.col("_rows") - 1)
        aggregates += [at(F.floor(h)).alias(f"_a{i}"), at(F.floor(h) + 1).alias(f"_b{i}"), F.max(h - F.floor(h)).alias(f"_f{i}")]
        # At the largest rank there is no next value; the fraction is then zero.
        low = F.col(f"_a{i}")
        results.append((low + F.col(f"_f{i}") * (F.coalesce(F.col(f"_b{i}"), low) - low)).alias(name))
    return ranked.groupBy(*keys).agg(*aggregates).select(*keys, *results)


def grouped_quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float], accuracy: int = 10_000,
                      few: int = FEW) -> DataFrame:
    """Columns `keys` plus one double per entry of `probs` ({name: probability})."""
    names, levels = list(probs), list(probs.values())
    if not keys:
        return column_quantiles(df, [value], probs, accuracy, few).select(*names)
    v = F.col(quote(value)).cast("double")
    rows = df.select(*[F.col(quote(k)) for k in keys], F.when(~F.isnan(v), v).alias("_v")).filter("_v is not null")
    by = [quote(k) for k in keys]
    ends = freeze(rows.groupBy(*by).agg(*_stats(F.col("_v"), levels, accuracy)).select(*by, *_brackets(levels, accuracy)), "brackets")
    ends = _narrowed(rows, ends, keys, levels, few)
    brackets = [(F.col(f"_lo{i}"), F.col(f"_hi{i}")) for i in range(len(levels))]
    return _pick(_reduced(_with_brackets(rows, ends, keys), keys, brackets), keys, names, levels)


def column_quantiles(df: DataFrame, columns: list[str], probs: dict[str, float], accuracy: int = 10_000, few: int = FEW) -> DataFrame:
    """One row per column: `column` and a double per entry of `probs`.

    The brackets of all columns come from one aggregate, and each later pass reads the
    table once for all columns.
    """
    names, levels = list(probs), list(probs.values())

    def clean(name):
        v = F.col(quote(name)).cast("double")
        return F.when(~F.isnan(v), v)

    spark = df.sparkSession
    found = df.agg(*[a for i, c in enumerate(columns) for a in _stats(clean(c), levels, accuracy, str(i))]).first()
    stats = [(i, *[found[f"{x}{i}"] for x in ("_n", "_min", "_max", "_marks")]) for i in range(len(columns)) if found[f"_n{i}"]]
    empty = [c for i, c in enumerate(columns) if not found[f"_n{i}"]]
    nothing = spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in empty]).cast("array<string>")).alias("column")).select("column", *[F.lit(None).cast("double").alias(k) for k in names])
    if not stats:
        return nothing
    brackets = {}
    for i, n, low, high, marks in stats:
        brackets[i] = [(low, high) if n <= accuracy else (marks[2 * k], marks[2 * k + 1]) for k in range(len(levels))]
    if any((n if n <= accuracy else n * (2 * SAFETY + 2) / accuracy) > few for _, n, *_ in stats):
        ends = spark.createDataFrame(stats, "_column int, _n bigint, _min double, _max double, _marks array<double>").select("_column", *_brackets(levels, accuracy))
        rows = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("_column"), clean(columns[i]).alias("_v")) for i in brackets])).alias("s")).select(
            "s.*").filter("_v is not null")
        # One row per column.
        for row in _narrowed(rows, ends, ["_column"], levels, few).collect():
            brackets[row["_column"]] = [(row[f"_lo{k}"], row[f"_hi{k}"]) for k in range(len(levels))]
    # Brackets are literals now: outside them one aggregate counts, and only values inside become rows.
    counts, outside, inside = [], [], []
    for i, ends in brackets.items():
        v, parts, reached = clean(columns[i]), _joined(ends), F.lit(0).cast("bigint")
        gap = F.lit(0)
        for k, (lo, hi) in enumerate(parts):
            counts += [F.count_if(v < F.lit(lo)).alias(f"_under{i}_{k}"), F.count_if(v <= F.lit(hi)).alias(f"_upto{i}_{k}")]
            outside.append((i, 2 * k, F.col(f"_under{i}_{k}") - reached))
            reached = F.col(f"_upto{i}_{k}")
            gap = F.when(v >= F.lit(lo), 2 * k + 1).otherwise(gap)
        counts.append(F.count(v).alias(f"_all{i}"))
        outside.append((i, 2 * len(parts), F.col(f"_all{i}") - reached))
        within = reduce(lambda a, b: a | b, [(v >= F.lit(lo)) & (v <= F.lit(hi)) for lo, hi in parts])
        inside.append(F.when(within, F.struct(F.lit(i).alias("_column"), gap.alias("_gap"), v.alias("_x"))))
    counted = (df.agg(*counts).select(F.explode(F.array(*[F.struct(
        F.lit(i).alias("_column"), F.lit(g).alias("_gap"), F.lit(None).cast("double").alias("_x"), c.alias("_c")) for i, g, c in outside])).alias("s"))
        .select("s.*").filter("_c > 0"))
    listed = (df.select(F.explode(F.array(*inside)).alias("s")).filter("s is not null").select("s.*")
              .groupBy("_column", "_gap", "_x").agg(F.count(F.lit(1)).alias("_c")))
    labels = F.get(F.array(*[F.lit(c) for c in columns]), F.col("_column"))
    out = _pick(counted.unionByName(listed), ["_column"], names, levels).select(labels.alias("column"), *names)
    return out.unionByName(nothing) if empty else out
