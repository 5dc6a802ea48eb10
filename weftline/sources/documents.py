"""Filter documents (`{"field": value}`, `{"field": {"$gte": 3}}`) as Column predicates."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from weftline.functions.columns import quote

Missing = Callable[[str], bool]


def _field(name: str) -> Column:
    return F.col(".".join(quote(p) for p in name.split(".")))


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _all(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def _any(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def _equal(c: Column, value) -> Column:
    return c.isNull() if value is None else _true(c == F.lit(value))


def _in(c: Column, values: list) -> Column:
    given = [v for v in values if v is not None]
    found = _true(c.isin(*given)) if given else F.lit(False)
    return found | c.isNull() if len(given) < len(values) else found


_TESTS: dict[str, Callable[[Column, object], Column]] = {
    "$eq": _equal,
    "$ne": lambda c, v: ~_equal(c, v),
    "$gt": lambda c, v: _true(c > F.lit(v)),
    "$gte": lambda c, v: _true(c >= F.lit(v)),
    "$lt": lambda c, v: _true(c < F.lit(v)),
    "$lte": lambda c, v: _true(c <= F.lit(v)),
    "$in": _in,
    "$nin": lambda c, v: ~_in(c, v),
    "$exists": lambda c, v: c.isNotNull() if v else c.isNull(),
    "$regex": lambda c, v: _true(c.rlike(v)),
}


def _field_test(name: str, condition, known: list[str]) -> Column:
    c = _field(name) if name.split(".")[0] in known else F.lit(None).cast("string")
    if not (isinstance(condition, dict) and any(k.startswith("$") for k in condition)):
        return _equal(c, condition)
    parts = []
    for op, value in condition.items():
        if op == "$not":
            parts.append(~_field_test(name, value, known))
        elif op in _TESTS:
            parts.append(_TESTS[op](c, value))
        else:
            raise ValueError(f"unknown filter operator: {op}")
    return _all(parts)


def to_predicate(document: dict, columns: list[str]) -> Column:
    """A field the table lacks behaves like a null, as it does in a document store."""
    parts = []
    for key, value in document.items():
        if key == "$and":
            parts.append(_all([to_predicate(d, columns) for d in value]))
        elif key == "$or":
            parts.append(_any([to_predicate(d, columns) for d in value]))
        elif key == "$nor":
            parts.append(~_any([to_predicate(d, columns) for d in value]))
        elif key.startswith("$"):
            raise ValueError(f"unknown filter operator: {key}")
        else:
            parts.append(_field_test(key, value, columns))
    return _all(parts)


def filter_documents(df: DataFrame, document: dict | None) -> DataFrame:
    """Rows the filter document accepts; `_id` as text."""
    if document:
        df = df.filter(to_predicate(document, df.columns))
    return df.withColumn("_id", F.col("_id").cast("string")) if "_id" in df.columns else df
