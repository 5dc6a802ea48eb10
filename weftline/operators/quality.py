"""Scored quality rules.

All rules over a table share one aggregate, so the table is read once however
many rules there are. Only `unique` needs a shuffle by value; each such rule is a
narrow aggregate of its own (one column read) instead of an Expand that would
multiply every row by the number of rules. Nothing is collected: the result is a
DataFrame with one row per rule.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from weftline.functions.columns import json_text, present, quote, starts_matching, to_time

RESULT_SCHEMA = T.StructType([
    T.StructField("rule_name", T.StringType()),
    T.StructField("rule_type", T.StringType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("details", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])


@dataclass(frozen=True)
class Rule:
    name: str
    rule_type: str
    column: str | None = None
    parameters: dict = field(default_factory=dict)
    threshold: float | None = 1.0
    severity: str = "warning"


class QualityGateError(RuntimeError):
    """Raised by `gate` when rules of a blocking severity failed."""


class RuleInputError(ValueError):
    """A rule that cannot be evaluated; it becomes a failed result, not an exception."""


@dataclass
class _Plan:
    """Aggregates a rule needs, and how to read score and details from them."""

    aggregates: list[Column]
    score: Column
    details: list[Column]


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(1.0))


def _column(df: DataFrame, rule: Rule) -> tuple[Column, T.DataType]:
    if rule.column is None or rule.column not in df.columns:
        raise RuleInputError(f"there is no column {rule.column!r} to check")
    dtype = df.schema[rule.column].dataType
    return present(rule.column, dtype), dtype


def _count_plan(tag: str, good: Column, whole: Column, names: tuple[str, str, str]) -> _Plan:
    """Score = good / whole, both of them counts taken in the shared aggregate."""
    g, w = F.col(f"{tag}_good"), F.col(f"{tag}_all")
    details = [w.alias(names[0]), g.alias(names[1]), (w - g).alias(names[2]),
               (_ratio(g, w) * 100).alias("percentage")]
    return _Plan([good.alias(f"{tag}_good"), whole.alias(f"{tag}_all")], _ratio(g, w), details)


def _plan_not_null(df, rule, tag, now):
    c, _ = _column(df, rule)
    return _count_plan(tag, F.count(c), F.count(F.lit(1)),
                       ("total_rows", "non_null_count", "null_count"))


def _plan_range(df, rule, tag, now):
    c, _ = _column(df, rule)
    low, high = rule.parameters.get("min_value"), rule.parameters.get("max_value")
    if low is None and high is None:
        raise RuleInputError("give min_value, max_value or both")
    tests = [c >= F.lit(low)] if low is not None else []
    tests += [c <= F.lit(high)] if high is not None else []
    plan = _count_plan(tag, F.count_if(reduce(lambda a, b: a & b, tests)), F.count(c),
                       ("total_non_null_rows", "valid_count", "invalid_count"))
    plan.details += [F.lit(low).alias("min_value"), F.lit(high).alias("max_value")]
    return plan


def _plan_pattern(df, rule, tag, now):
    c, _ = _column(df, rule)
    pattern = rule.parameters.get("pattern")
    if not pattern:
        raise RuleInputError("give the pattern to match")
    # The engine's own reading counts: another dialect accepts and refuses other patterns.
    try:
        df.sparkSession._jvm.java.util.regex.Pattern.compile(f"^(?:{pattern})")
    except (PySparkException, Py4JJavaError) as problem:
        raise RuleInputError(f"the pattern cannot be read: {str(problem).splitlines()[0]}") from problem
    plan = _count_plan(tag, F.count_if(starts_matching(c, pattern)), F.count(c),
                       ("total_non_null_rows", "valid_count", "invalid_count"))
    plan.details.append(F.lit(pattern).alias("pattern"))
    return plan


def _plan_completeness(df, rule, tag, now):
    cells = [F.count(present(f.name, f.dataType)) for f in df.schema.fields]
    filled = reduce(lambda a, b: a + b, cells)
    return _count_plan(tag, filled, F.count(F.lit(1)) * len(cells),
                       ("total_cells", "non_null_cells", "null_cells"))


def _plan_freshness(df, rule, tag, now):
    _, dtype = _column(df, rule)
    limit = float(rule.parameters.get("max_age_hours", 24))
    latest = F.col(f"{tag}_latest")
    age = (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(latest)) / F.lit(3.6e9)
    score = F.greatest(F.lit(0.0), 1 - age / limit) if limit > 0 else F.lit(1.0)
    # No readable time at all means the data cannot be called fresh.
    score = F.when(latest.isNull(), F.lit(0.0)).otherwise(score)
    details = [latest.cast("string").alias("latest_timestamp"), age.alias("age_hours"),
               F.lit(limit).alias("max_age_hours"), (age <= limit).alias("is_fresh")]
    return _Plan([F.max(to_time(rule.column, dtype)).alias(f"{tag}_latest")], score, details)


def _plan_expression(df, rule, tag, now):
    """Custom rule given as a SQL aggregate whose value is the score, or as two that add up over parts of a table."""
    if "expression" not in rule.parameters:
        good, total = (F.expr(rule.parameters[x]).cast("double") for x in ("good", "total"))
        g, w = (F.coalesce(F.col(f"{tag}_{x}"), F.lit(0.0)) for x in ("good", "all"))
        return _Plan([good.alias(f"{tag}_good"), total.alias(f"{tag}_all")], _ratio(g, w), [g.alias("good"), w.alias("total")])
    value = F.expr(rule.parameters["expression"]).cast("double").alias(f"{tag}_score")
    return _Plan([value], F.coalesce(F.col(f"{tag}_score"), F.lit(0.0)),
                 [F.lit(rule.parameters["expression"]).alias("expression")])


_FUSED: dict[str, Callable] = {
    "not_null": _plan_not_null,
    "range": _plan_range,
    "pattern": _plan_pattern,
    "completeness": _plan_completeness,
    "freshness": _plan_freshness,
}


def _result(rule: Rule, score: Column, passed: Column, details: Column, now: datetime) -> Column:
    return F.struct(
        F.lit(rule.name).alias("rule_name"), F.lit(rule.rule_type).alias("rule_type"),
        passed.alias("passed"), score.cast("double").alias("score"), details.alias("details"),
        F.lit(rule.severity).alias("severity"), F.lit(now).cast("timestamp").alias("timestamp"),
    )


def _scored(rule: Rule, plan: _Plan, now: datetime) -> Column:
    details = F.struct(*plan.details, F.lit(rule.threshold).cast("double").alias("threshold"))
    return _result(rule, plan.score, plan.score >= F.lit(_limit(rule)), json_text(details), now)


def _limit(rule: Rule) -> float:
    return 1.0 if rule.threshold is None else float(rule.threshold)


def _failed(rule: Rule, message: str, now: datetime) -> Column:
    return _result(rule, F.lit(0.0), F.lit(False), json_text(F.struct(F.lit(message).alias("error"))), now)


def _unique_rows(df: DataFrame, rule: Rule, now: datetime, approx: bool) -> DataFrame:
    c, _ = _column(df, rule)
    distinct = F.approx_count_distinct(c) if approx else F.count_distinct(c)
    g, w = F.col("good"), F.col("total_rows")
    plan = _Plan([], _ratio(g, w), [w, g.alias("unique_count"), (w - g).alias("duplicate_count"),
                                    (_ratio(g, w) * 100).alias("uniqueness_percentage")])
    return (df.agg(distinct.alias("good"), F.count(F.lit(1)).alias("total_rows"))
            .select("total_rows", _scored(rule, plan, now).alias("r")))


def unique_values(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Columns `rule_name`, `digest`: every distinct value of the columns of `unique` rules once, as 128 bits.

    Digests of parts of a table, taken together, give the distinct count of the whole.
    """
    parts = []
    for rule in rules:
        if rule.rule_type == "unique" and rule.column in df.columns:
            c, dtype = _column(df, rule)
            if isinstance(dtype, (T.FloatType, T.DoubleType)):
                c = c + F.lit(0.0)
            known = c.isNotNull()
            text = c if isinstance(dtype, (T.BinaryType, T.StringType)) else F.to_json(F.struct(c.alias("v")))
            parts.append(df.select(F.lit(rule.name).alias("rule_name"), F.when(known, F.unhex(F.md5(text))).alias("digest"))
                         .filter("digest is not null").distinct())
    return reduce(DataFrame.unionByName, parts) if parts else df.sparkSession.createDataFrame([], "rule_name string, digest binary")


def _query_rows(spark: SparkSession, rule: Rule, now: datetime) -> DataFrame:
    """Custom SQL rule: first cell of the query against explicit bounds."""
    p = rule.parameters
    cell = spark.sql(p["query"])
    value = F.coalesce(F.col("value"), F.lit(0.0))
    tests = [value >= F.lit(float(p["min_threshold"]))] if "min_threshold" in p else []
    tests += [value <= F.lit(float(p["max_threshold"]))] if "max_threshold" in p else []
    tests += [value <= F.lit(float(p["threshold"]))] if p.get("threshold") is not None else []
    passed = reduce(lambda a, b: a & b, tests, F.lit(True))
    one = cell.select(F.col(quote(cell.columns[0])).cast("double").alias("value")).agg(F.max("value").alias("value"), F.count(F.lit(1)).alias("result_rows"))
    # A result of several rows has no one value to compare.
    passed = passed & (F.col("result_rows") <= 1)
    details = json_text(F.struct(value.alias("actual_value"), F.col("result_rows")))
    return one.select(F.lit(1).cast("bigint").alias("total_rows"),
                      _result(rule, F.when(passed, 1.0).otherwise(0.0), passed, details, now).alias("r"))


def _analysed(df: DataFrame, plan: _Plan) -> _Plan:
    """The plan, if it can be resolved by itself; nothing is run for it."""
    if plan.aggregates:
        df.agg(*plan.aggregates).schema
    return plan


def run_rules(df: DataFrame, rules: list[Rule], now: datetime, approx_unique: bool = False) -> DataFrame:
    """One result row per rule. On an empty table only rules about the number of rows and SQL rules have a result.

    A rule that cannot be read or resolved (a broken pattern, expression or query, a missing column or table) is a failed result of its own.
    """
    spark = df.sparkSession
    aggregates: list[Column] = [F.count(F.lit(1)).alias("total_rows")]
    fused: list[Column] = []
    extra: list[DataFrame] = []
    for index, rule in enumerate(rules):
        tag = f"r{index}"
        try:
            if rule.rule_type == "unique":
                extra.append(_unique_rows(df, rule, now, approx_unique))
                continue
            if rule.rule_type == "row_count":
                has_rows = F.when(F.col("total_rows") > 0, 1.0).otherwise(0.0)
                fused.append(_scored(rule, _Plan([], has_rows, [F.col("total_rows")]), now))
                continue
            if rule.rule_type == "custom":
                if "query" in rule.parameters:
                    extra.append(_query_rows(spark, rule, now))
                elif callable(rule.parameters.get("function")):
                    fused.append(_from_callable(df, rule, now))
                elif "expression" in rule.parameters or {"good", "total"} <= set(rule.parameters):
                    plan = _analysed(df, _plan_expression(df, rule, tag, now))
                    aggregates += plan.aggregates
                    fused.append(_scored(rule, plan, now))
                else:
                    raise RuleInputError("give one of function, expression, query, or good and total")
                continue
            if rule.rule_type not in _FUSED:
                raise RuleInputError(f"no rule is called {rule.rule_type!r}")
            plan = _analysed(df, _FUSED[rule.rule_type](df, rule, tag, now))
            aggregates += plan.aggregates
            fused.append(_scored(rule, plan, now))
        except RuleInputError as problem:
            fused.append(_failed(rule, str(problem), now))
        except (PySparkException, ValueError, TypeError) as problem:
            fused.append(_failed(rule, f"the rule cannot be resolved: {str(problem).splitlines()[0]}", now))
    parts = list(extra)
    if fused:
        parts.append(df.agg(*aggregates).select("total_rows", F.explode(F.array(*fused)).alias("r")))
    if not parts:
        return spark.createDataFrame([], RESULT_SCHEMA)
    rows = reduce(DataFrame.unionByName, parts)
    return rows.filter("total_rows > 0 or r.rule_type = 'row_count'").select("r.*")


def _from_callable(df: DataFrame, rule: Rule, now: datetime) -> Column:
    """Custom rule given as `fn(df) -> (score, details)`; an exception is a failed rule."""
    try:
        score, details = rule.parameters["function"](df)
    except Exception as problem:  # noqa: BLE001 - any user error becomes a failed result
        return _failed(rule, f"the function raised: {problem}", now)
    text = json_text(F.struct(*[F.lit(v).alias(k) for k, v in details.items()])) if details else F.lit("{}")
    return _result(rule, F.lit(float(score)), F.lit(float(score) >= _limit(rule)), text, now)


def summarize(results: DataFrame) -> DataFrame:
    """One row: number of checks, how many passed and failed, mean score."""
    passed = F.count_if(F.col("passed"))
    return results.agg(
        F.count(F.lit(1)).alias("total_checks"), passed.alias("passed_checks"),
        (F.count(F.lit(1)) - passed).alias("failed_checks"),
        F.coalesce(F.avg("score"), F.lit(0.0)).alias("overall_score"),
    )


def gate(results: DataFrame, fail_on_error: bool = True, blocking: tuple[str, ...] = ("critical",), asked: list[Rule] | None = None) -> list[str]:
    """Names of rules of a blocking severity that failed or, of those asked for, have no result; raises when asked to.

    The rows are one per rule, so their number is bounded by the rule list.
    """
    found = results.filter(F.col("severity").isin(*blocking)).select("rule_name", F.coalesce("passed", F.lit(False)).alias("passed")).collect()
    missing = {r.name for r in asked or () if r.severity in blocking} - {r.rule_name for r in found}
    names = sorted({r.rule_name for r in found if not r.passed} | missing)
    if names and fail_on_error:
        raise QualityGateError("blocked by rules that did not pass: " + ", ".join(names))
    return names


def check_target(spark: SparkSession, rules: list[Rule], now: datetime, table: DataFrame | None = None, fail_without_table: bool = False) -> DataFrame:
    """All rules on a stored table. Without one, rules that query tables by SQL; those needing rows are skipped, or fail."""
    if table is not None:
        return run_rules(table, rules, now)
    sql_rules = [r for r in rules if r.rule_type == "custom" and "query" in r.parameters]
    checked = run_rules(spark.range(1).toDF("id"), sql_rules, now)
    others = [_failed(r, "there is no table to check", now) for r in rules if r not in sql_rules]
    if not fail_without_table or not others:
        return checked
    return checked.unionByName(spark.range(1).select(F.explode(F.array(*others)).alias("r")).select("r.*"))


def rules_or_default(task_rules: list[Rule] | None, global_rules: list[Rule] | None) -> list[Rule]:
    """Task rules, else global rules, else completeness of 95 %."""
    return task_rules or global_rules or [Rule("basic_completeness", "completeness", threshold=0.95)]


def store_results(results: DataFrame, path: str, dag_id: str, task_id: str, run_date: str) -> None:
    """Append results to the result table; input of the score alerts."""
    (results.select(
        F.lit(dag_id).alias("dag_id"), F.lit(task_id).alias("task_id"),
        F.lit(run_date).cast("timestamp").alias("execution_date"), "rule_name", "rule_type", "passed",
        F.col("score").cast("decimal(5,4)").alias("score"), "details", "severity")
     .write.mode("append").parquet(path))
