"""Group aggregates named `<column>_<function>`, and stacking of several inputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from weftline.functions.columns import quote
from weftline.operators.quantiles import grouped_quantiles

QUANTILE_FUNCTIONS = {"median": 0.5}
ORDERED_FUNCTIONS = {"first": F.min_by, "last": F.max_by}


def _aggregate(function: str, name: str, order_col: str | None) -> Column:
    c = F.col(quote(name))
    simple = {
        "sum": lambda: F.coalesce(F.sum(c), F.lit(0)),
        "mean": lambda: F.avg(c),
        "count": lambda: F.count(c),
        "size": lambda: F.count(F.lit(1)),
        "min": lambda: F.min(c),
        "max": lambda: F.max(c),
        "std": lambda: F.stddev_samp(c),
        "var": lambda: F.var_samp(c),
        "nunique": lambda: F.count_distinct(c),
        "prod": lambda: F.product(c),
    }
    if function in simple:
        return simple[function]()
    if function in ORDERED_FUNCTIONS:
        if order_col is None:
            raise ValueError(f"{function} needs an order column, rows have no order of their own")
        # The first / last *non-null* value in that order.
        return ORDERED_FUNCTIONS[function](c, F.when(c.isNotNull(), F.col(quote(order_col))))
    raise ValueError(f"unknown aggregate function: {function}")


def aggregate(df: DataFrame, group_by: list[str], aggregations: dict[str, str | list[str]],
              order_col: str | None = None, null_keys: str = "drop", flat_single: bool = False) -> DataFrame:
    """`aggregations` maps a column to a function name or a list of them.

    Groups with a null key are dropped unless `null_keys='keep'`. With
    `flat_single` a column that has one function only keeps its own name.
    """
    if null_keys not in ("drop", "keep"):
        raise ValueError("null_keys is 'drop' or 'keep'")
    if group_by and null_keys == "drop":
        df = df.na.drop(subset=group_by)
    plain, quantiles, order = [], {}, []
    for name, functions in aggregations.items():
        several = not isinstance(functions, str)
        for function in functions if several else [functions]:
            alias = name if flat_single and not several else f"{name}_{function}"
            order.append(alias)
            if function in QUANTILE_FUNCTIONS:
                quantiles.setdefault(name, {})[alias] = QUANTILE_FUNCTIONS[function]
            else:
                plain.append(_aggregate(function, name, order_col).alias(alias))
    parts = []
    if plain or not quantiles or group_by:
        plain = plain or [F.count(F.lit(1)).alias("_rows")]
        parts.append(df.groupBy(*[F.col(quote(k)) for k in group_by]).agg(*plain))
    parts += [grouped_quantiles(df, group_by, name, probs) for name, probs in quantiles.items()]
    out = reduce(lambda a, b: _join_groups(a, b, group_by), parts)
    return out.select(*[F.col(quote(c)) for c in [*group_by, *order]])


def _join_groups(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Both sides have one row per group; a group without values has no quantile."""
    if not keys:
        extra = {c: right.select(F.col(quote(c))).scalar() for c in right.columns}
        return left.withColumns(extra)
    same = reduce(lambda a, b: a & b, [F.col(f"l.{quote(k)}").eqNullSafe(F.col(f"r.{quote(k)}")) for k in keys])
    values = [F.col(f"r.{quote(c)}") for c in right.columns if c not in keys]
    return left.alias("l").join(right.alias("r"), same, "left").select("l.*", *values)


def stack(frames: list[DataFrame]) -> DataFrame:
    """Several inputs under one schema; a column an input lacks is null."""
    if not frames:
        raise ValueError("nothing to stack")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
