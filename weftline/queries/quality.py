"""Quality rules and profiles over the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from weftline.operators import profile as P
from weftline.operators.quality import Rule, check_target, gate, run_rules, summarize
from weftline.queries.registry import n, query, r

NOW = datetime(2024, 2, 1)

LINES = """SELECT *, nullif(l_returnflag, 'R') AS flag,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount END AS disc FROM lineitem"""


def lines(t):
    """Lineitem with nulls put in the same way as in the SQL twins."""
    return t.lineitem.withColumns({
        "flag": F.expr("nullif(l_returnflag, 'R')"),
        "disc": F.expr("CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount END")})


def scores(df):
    return df.select("rule_name", "rule_type", "passed", r("score", 6).alias("score"), "severity")


def score_sql(name, kind, expr, table, threshold=1.0, severity="warning"):
    return (f"SELECT '{name}' AS rule_name, '{kind}' AS rule_type, s >= {threshold} AS passed, "
            f"round(s, 6) AS score, '{severity}' AS severity FROM (SELECT CAST({expr} AS DOUBLE) AS s FROM {table})")


@query("quality_not_null", score_sql("flag_present", "not_null", "count(flag) / count(*)", f"({LINES})", 0.6))
def _(t):
    return scores(run_rules(lines(t), [Rule("flag_present", "not_null", "flag", threshold=0.6)], NOW))


@query("quality_unique", " UNION ALL ".join([
    score_sql("order_unique", "unique", "count(DISTINCT o_orderkey) / count(*)", "orders"),
    score_sql("customer_unique", "unique", "count(DISTINCT o_custkey) / count(*)", "orders", 0.5, "error")]))
def _(t):
    return scores(run_rules(t.orders, [
        Rule("order_unique", "unique", "o_orderkey"),
        Rule("customer_unique", "unique", "o_custkey", threshold=0.5, severity="error")], NOW))


@query("quality_range", " UNION ALL ".join([
    score_sql("both", "range", "count(*) FILTER (disc BETWEEN 0.02 AND 0.08) / count(disc)", f"({LINES})", 0.5),
    score_sql("low", "range", "count(*) FILTER (disc >= 0.05) / count(disc)", f"({LINES})"),
    score_sql("high", "range", "count(*) FILTER (l_quantity <= 50) / count(l_quantity)", f"({LINES})")]))
def _(t):
    return scores(run_rules(lines(t), [
        Rule("both", "range", "disc", {"min_value": 0.02, "max_value": 0.08}, 0.5),
        Rule("low", "range", "disc", {"min_value": 0.05}), Rule("high", "range", "l_quantity", {"max_value": 50})], NOW))


@query("quality_pattern", " UNION ALL ".join([
    score_sql("capital", "pattern", "count(*) FILTER (regexp_matches(text, '^(?:[A-Z][a-z]+)')) / count(text)", "documents", 0.1),
    score_sql("priority", "pattern", "count(*) FILTER (regexp_matches(o_orderpriority, '^(?:[12]-)')) / count(*)", "orders", 0.3)]))
def _(t):
    a = run_rules(t.documents, [Rule("capital", "pattern", "text", {"pattern": "[A-Z][a-z]+"}, 0.1)], NOW)
    b = run_rules(t.orders, [Rule("priority", "pattern", "o_orderpriority", {"pattern": "[12]-"}, 0.3)], NOW)
    return scores(a.unionByName(b))


@query("quality_completeness", score_sql(
    "cells", "completeness", "(count(flag) + count(disc) + 11 * count(*)) / (13 * count(*))", f"({LINES})", 0.95))
def _(t):
    return scores(run_rules(lines(t), [Rule("cells", "completeness", threshold=0.95)], NOW))


@query("quality_freshness", score_sql(
    "recent", "freshness",
    "greatest(0.0, 1 - (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(ts))) / 3600e6 / 48)", "events", 0.3))
def _(t):
    return scores(run_rules(t.events, [Rule("recent", "freshness", "ts", {"max_age_hours": 48}, 0.3)], NOW))


@query("quality_custom_expression", score_sql(
    "mean_quality", "custom", "avg(CASE WHEN quality = 1 AND toxic = 0 THEN 1.0 ELSE 0.0 END)", "labels", 0.4))
def _(t):
    rule = Rule("mean_quality", "custom", parameters={
        "expression": "avg(CASE WHEN quality = 1 AND toxic = 0 THEN 1.0D ELSE 0.0D END)"}, threshold=0.4)
    return scores(run_rules(t.labels, [rule], NOW))


@query("quality_custom_function", score_sql("share", "custom", "count(*) FILTER (value > 50) / count(*)", "events", 0.1))
def _(t):
    def share(df):
        row = df.agg(F.count_if(F.col("value") > 50).alias("a"), F.count(F.lit(1)).alias("b")).first()
        return row.a / row.b, {"above": row.a}

    return scores(run_rules(t.events, [Rule("share", "custom", parameters={"function": share}, threshold=0.1)], NOW))


@query("quality_custom_sql", """
SELECT 'enough' AS rule_name, 'custom' AS rule_type, c >= 100 AS passed, CASE WHEN c >= 100 THEN 1.0 ELSE 0.0 END::DOUBLE AS score, 'critical' AS severity
FROM (SELECT count(*) AS c FROM orders) UNION ALL
SELECT 'few_open', 'custom', c <= 5, CASE WHEN c <= 5 THEN 1.0 ELSE 0.0 END::DOUBLE, 'warning' FROM (SELECT count(*) AS c FROM orders WHERE o_orderstatus = 'O') UNION ALL
SELECT 'mean_price', 'custom', c >= 1 AND c <= 1e9, CASE WHEN c >= 1 AND c <= 1e9 THEN 1.0 ELSE 0.0 END::DOUBLE, 'warning' FROM (SELECT avg(o_totalprice) AS c FROM orders)""")
def _(t):
    t.views("orders")
    return scores(check_target(t.spark, [
        Rule("enough", "custom", parameters={"query": "SELECT count(*) FROM orders", "min_threshold": 100}, severity="critical"),
        Rule("few_open", "custom", parameters={"query": "SELECT count(*) FROM orders WHERE o_orderstatus = 'O'", "max_threshold": 5}),
        Rule("mean_price", "custom", parameters={"query": "SELECT avg(o_totalprice) FROM orders", "min_threshold": 1, "threshold": 1e9}),
    ], NOW))


@query("quality_row_count_and_errors", " UNION ALL ".join([
    score_sql("rows", "row_count", "CASE WHEN count(*) > 0 THEN 1 ELSE 0 END", "orders"),
    score_sql("absent", "not_null", "CASE WHEN count(*) > 0 THEN 0 END", "orders"),
    score_sql("odd", "validity", "CASE WHEN count(*) > 0 THEN 0 END", "orders"),
    score_sql("unbounded", "range", "CASE WHEN count(*) > 0 THEN 0 END", "orders"),
    score_sql("bad_regex", "pattern", "CASE WHEN count(*) > 0 THEN 0 END", "orders")]))
def _(t):
    return scores(run_rules(t.orders, [
        Rule("rows", "row_count"), Rule("absent", "not_null", "nowhere"), Rule("odd", "validity", "o_orderkey"),
        Rule("unbounded", "range", "o_totalprice"), Rule("bad_regex", "pattern", "o_orderstatus", {"pattern": "["})], NOW))


@query("quality_broken_rules", " UNION ALL ".join([
    score_sql("key", "not_null", "CASE WHEN count(*) > 0 THEN 1 END", "orders", severity="critical"),
    score_sql("named_group", "pattern", "CASE WHEN count(*) > 0 THEN 0 END", "orders"),
    score_sql("no_column", "custom", "CASE WHEN count(*) > 0 THEN 0 END", "orders"),
    score_sql("no_table", "custom", "CASE WHEN count(*) > 0 THEN 0 END", "orders"),
    score_sql("half", "custom", "count(*) FILTER (o_orderstatus = 'F') / count(*)", "orders", 0.1)]))
def _(t):
    """Rules that cannot be resolved fail by themselves, beside others that are scored."""
    return scores(run_rules(t.orders, [
        Rule("key", "not_null", "o_orderkey", severity="critical"), Rule("named_group", "pattern", "o_orderstatus", {"pattern": "(?P<x>F)"}),
        Rule("no_column", "custom", parameters={"expression": "avg(no_such_column)"}), Rule("no_table", "custom", parameters={"query": "SELECT count(*) FROM no_such_table"}),
        Rule("half", "custom", parameters={"expression": "count_if(o_orderstatus = 'F') / count(*)"}, threshold=0.1)], NOW))


@query("quality_gate", "SELECT unnest(['empty_key', 'price']) AS rule_name, count(*) AS orders FROM orders")
def _(t):
    """What blocks a run: a critical rule that fails on the orders, and one that has no result on an empty table."""
    on_orders = [Rule("price", "range", "o_totalprice", {"max_value": 1}, severity="critical"), Rule("key", "not_null", "o_orderkey", severity="critical"), Rule("soft", "range", "o_totalprice", {"max_value": 1})]
    on_nothing = [Rule("empty_key", "not_null", "o_orderkey", severity="critical")]
    names = gate(run_rules(t.orders, on_orders, NOW), False, asked=on_orders) + gate(run_rules(t.orders.filter("o_orderkey is null"), on_nothing, NOW), False, asked=on_nothing)
    return t.orders.agg(n(F.count(F.lit(1))).alias("orders")).select(F.explode(F.array(*map(F.lit, names))).alias("rule_name"), "orders")


RULE_SET = [
    Rule("key_present", "not_null", "o_orderkey", severity="critical"), Rule("key_unique", "unique", "o_orderkey", severity="critical"),
    Rule("price", "range", "o_totalprice", {"min_value": 0, "max_value": 400000}, 0.9), Rule("cells", "completeness", threshold=0.95),
    Rule("status", "pattern", "o_orderstatus", {"pattern": "[FO]"}, 0.9, "error"),
]


@query("quality_summary", """
WITH s AS (SELECT unnest([count(o_orderkey) / count(*), count(DISTINCT o_orderkey) / count(*),
  count(*) FILTER (o_totalprice BETWEEN 0 AND 400000) / count(*), 1.0,
  count(*) FILTER (o_orderstatus IN ('F', 'O')) / count(*)]) AS score, unnest([1.0, 1.0, 0.9, 0.95, 0.9]) AS lim FROM orders)
SELECT count(*) AS total_checks, count(*) FILTER (score >= lim) AS passed_checks, count(*) FILTER (score < lim) AS failed_checks,
  round(avg(score), 6) AS overall_score FROM s""")
def _(t):
    return summarize(run_rules(t.orders, RULE_SET, NOW)).select(
        "total_checks", "passed_checks", "failed_checks", r("overall_score", 6).alias("overall_score"))


@query("profile_dataset", "SELECT count(*) AS total_rows, 11 AS total_columns, 10 AS profiled_columns FROM lineitem")
def _(t):
    return P.dataset_info(t.lineitem, exclude=["l_tax"])


def profile_number(c):
    return f"""SELECT '{c}' AS "column", count(*) AS "count", count(*) - count({c}) AS null_count,
 round((count(*) - count({c})) * 100.0 / count(*), 4)::DOUBLE AS null_percentage, count(DISTINCT {c}) AS unique_count,
 round(count(DISTINCT {c}) * 100.0 / count(*), 4)::DOUBLE AS unique_percentage, min({c})::DOUBLE AS "min", max({c})::DOUBLE AS "max",
 round(avg({c}), 4) AS "mean", round(quantile_cont({c}, 0.5), 4)::DOUBLE AS "median", round(stddev_samp({c}), 4) AS "std",
 round(quantile_cont({c}, 0.25), 4)::DOUBLE AS q25, round(quantile_cont({c}, 0.75), 4)::DOUBLE AS q75 FROM ({LINES})"""


@query("profile_numbers", " UNION ALL ".join(profile_number(c) for c in ("l_quantity", "l_extendedprice", "disc", "l_linenumber")))
def _(t):
    p = P.profile(lines(t), include=["l_quantity", "l_extendedprice", "disc", "l_linenumber"])
    return p.select("column", "count", "null_count", r("null_percentage").alias("null_percentage"), "unique_count",
                    r("unique_percentage").alias("unique_percentage"), "min", "max", r("mean").alias("mean"), r("median").alias("median"),
                    r("std").alias("std"), r("q25").alias("q25"), r("q75").alias("q75"))


def profile_text(c, table):
    return f"""SELECT '{c}' AS "column", count(*) AS "count", count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS unique_count,
 min(length({c})) AS min_length, max(length({c})) AS max_length, round(avg(length({c})), 4) AS avg_length FROM {table}"""


@query("profile_texts", " UNION ALL ".join([profile_text("flag", f"({LINES})"), profile_text("l_linestatus", f"({LINES})"),
                                            profile_text("text", "documents"), profile_text("source", "documents")]))
def _(t):
    p = P.profile(lines(t), include=["flag", "l_linestatus"]).unionByName(P.profile(t.documents, include=["text", "source"]))
    return p.select("column", "count", "null_count", "unique_count", "min_length", "max_length", r("avg_length").alias("avg_length"))


@query("profile_most_common", """
SELECT "column", value, n, CAST(position AS INTEGER) AS position FROM (
 SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS position FROM (
  SELECT 'lang' AS "column", lang AS value, count(*) AS n FROM documents GROUP BY ALL
  UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY ALL
  UNION ALL SELECT 'text', text, count(*) FROM documents GROUP BY ALL)) WHERE position <= 5""")
def _(t):
    return P.most_common(t.documents, ["lang", "source", "text"])


@query("profile_dates", """
SELECT 'ts' AS "column", min(ts) AS min_date, max(ts) AS max_date, (epoch_us(max(ts)) - epoch_us(min(ts))) // 86400000000 AS date_range_days FROM events
UNION ALL SELECT 'o_orderdate', min(o_orderdate), max(o_orderdate), (epoch_us(max(o_orderdate)) - epoch_us(min(o_orderdate))) // 86400000000 FROM orders""")
def _(t):
    p = P.profile(t.events, include=["ts"]).unionByName(P.profile(t.orders, include=["o_orderdate"]))
    return p.select("column", F.col("min_date").cast("timestamp_ntz").alias("min_date"), F.col("max_date").cast("timestamp_ntz").alias("max_date"), "date_range_days")


@query("quality_result_log", """
SELECT 'orders' AS task_id, count(*) AS rules, count(*) FILTER (s < 1) AS below_full FROM (
 SELECT unnest([count(o_orderkey) / count(*), count(DISTINCT o_custkey) / count(*)]) AS s FROM orders) GROUP BY ALL""")
def _(t):
    """Results appended to the result table and read back."""
    from weftline.operators.quality import store_results
    from weftline.session import scratch_path

    path = scratch_path(t.spark, "results")
    rules = [Rule("a", "not_null", "o_orderkey"), Rule("b", "unique", "o_custkey")]
    store_results(run_rules(t.orders, rules, NOW), path, "plan", "orders", "2024-02-01")
    return t.spark.read.parquet(path).groupBy("task_id").agg(
        n(F.count(F.lit(1))).alias("rules"), n(F.count_if(F.col("score") < 1)).alias("below_full"))
