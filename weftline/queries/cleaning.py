"""Cleaning, aggregation and user code over the given tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from weftline.operators.aggregate import aggregate, stack
from weftline.operators.clean import clean, convert_types, decimals_to_double, drop_duplicates, fill_missing
from weftline.operators.code import run_callable, through_command
from weftline.queries.quality import LINES, lines
from weftline.queries.registry import n, query, r


@query("clean_duplicates", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM (SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem) GROUP BY ALL")
def _(t):
    d = drop_duplicates(t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus"))
    return d.groupBy("l_returnflag", "l_linestatus").agg(n(F.count(F.lit(1))).alias("n"))


@query("clean_duplicates_by_key", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (
 SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def _(t):
    return drop_duplicates(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("clean_missing", f"""
SELECT l_linenumber, count(*) AS n, round(sum(z), 2) AS zero_sum, round(sum(m), 2) AS mean_sum, count(*) FILTER (f = 'unknown') AS filled
FROM (SELECT l_linenumber, coalesce(disc, 0) AS z, coalesce(disc, avg(disc) OVER ()) AS m, coalesce(flag, 'unknown') AS f
      FROM ({LINES}) WHERE nullif(l_linestatus, 'F') IS NOT NULL) GROUP BY ALL""")
def _(t):
    df = lines(t).withColumns({"z": F.col("disc"), "m": F.col("disc"), "st": F.expr("nullif(l_linestatus, 'F')")})
    df = fill_missing(df, {"st": "drop", "z": "fill_zero", "m": "fill_mean", "flag": "fill_unknown"})
    return df.groupBy("l_linenumber").agg(n(F.count(F.lit(1))).alias("n"), r(F.sum("z"), 2).alias("zero_sum"),
                                          r(F.sum("m"), 2).alias("mean_sum"), n(F.count_if(F.col("flag") == "unknown")).alias("filled"))


@query("clean_numeric_and_datetime", """
SELECT count(*) AS n, count(TRY_CAST(a AS DOUBLE)) AS numbers, round(sum(TRY_CAST(a AS DOUBLE)), 2) AS total,
 count(TRY_CAST(b AS TIMESTAMP)) AS times, max(TRY_CAST(b AS TIMESTAMP)) AS latest
FROM (SELECT CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS a,
             CASE WHEN event_type = 'click' THEN 'soon' ELSE CAST(ts AS VARCHAR) END AS b FROM events)""")
def _(t):
    df = t.events.select(
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string")).alias("a"),
        F.when(F.col("event_type") == "click", "soon").otherwise(F.col("ts").cast("string")).alias("b"))
    df = convert_types(df, {"a": "numeric", "b": "datetime"})
    return df.agg(n(F.count(F.lit(1))).alias("n"), n(F.count("a")).alias("numbers"), r(F.sum("a"), 2).alias("total"),
                  n(F.count("b")).alias("times"), F.max("b").cast("timestamp_ntz").alias("latest"))


@query("clean_cast_all_or_nothing", """
SELECT o_orderstatus, sum(CAST(o_totalprice AS BIGINT) % 7)::BIGINT AS checksum, min(o_orderpriority) AS kept_text FROM
 (SELECT o_orderstatus, o_orderpriority, trunc(o_totalprice) AS o_totalprice FROM orders) GROUP BY ALL""")
def _(t):
    df = t.orders.select("o_orderstatus", "o_orderpriority", F.floor("o_totalprice").cast("string").alias("p"))
    df = convert_types(df, {"p": "int", "o_orderpriority": "int"})
    return df.groupBy("o_orderstatus").agg(n(F.sum(F.col("p") % 7)).alias("checksum"), F.min("o_orderpriority").alias("kept_text"))


@query("clean_range_drop", f"""
SELECT l_linenumber, count(*) AS n, count(disc) AS filled FROM ({LINES})
WHERE (disc IS NULL OR disc BETWEEN 0.02 AND 0.07) AND l_quantity <= 40 GROUP BY ALL""")
def _(t):
    df = clean(lines(t), {"range_validations": {"disc": {"min": 0.02, "max": 0.07}, "l_quantity": {"max": 40}}}, drop_invalid=True)
    return df.groupBy("l_linenumber").agg(n(F.count(F.lit(1))).alias("n"), n(F.count("disc")).alias("filled"))


@query("clean_range_clamp", f"""
SELECT l_linenumber, round(sum(CASE WHEN disc < 0.02 THEN 0.02 WHEN disc > 0.07 THEN 0.07 ELSE disc END), 2) AS d,
 round(sum(least(l_quantity, 40)), 2) AS q FROM ({LINES}) GROUP BY ALL""")
def _(t):
    df = clean(lines(t), {"range_validations": {"disc": {"min": 0.02, "max": 0.07}, "l_quantity": {"max": 40}}})
    return df.groupBy("l_linenumber").agg(r(F.sum("disc"), 2).alias("d"), r(F.sum("l_quantity"), 2).alias("q"))


@query("clean_pattern_drop", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE regexp_matches(o_orderpriority, '^(?:[1-3]-)') GROUP BY ALL")
def _(t):
    df = clean(t.orders, {"pattern_validations": {"o_orderpriority": "[1-3]-"}}, drop_invalid=True)
    return df.groupBy("o_orderpriority").agg(n(F.count(F.lit(1))).alias("n"))


@query("clean_pattern_flag", f"""
SELECT flag, CASE WHEN flag = 'A' THEN NULL ELSE false END AS flag_valid, count(*) AS n FROM ({LINES}) GROUP BY ALL""")
def _(t):
    df = clean(lines(t), {"pattern_validations": {"flag": "A"}})
    return df.groupBy("flag", "flag_valid").agg(n(F.count(F.lit(1))).alias("n"))


@query("clean_all_rules", f"""
WITH d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM ({LINES})) WHERE rn = 1),
 m AS (SELECT l_linestatus, coalesce(disc, 0.0) AS disc, least(l_quantity, 30) AS q FROM d WHERE flag IS NOT NULL)
SELECT l_linestatus, count(*) AS n, round(sum(disc), 2) AS disc, round(sum(q), 2) AS q FROM m GROUP BY ALL""")
def _(t):
    df = clean(lines(t), {
        "remove_duplicates": True, "duplicate_subset": ["l_orderkey"], "missing_values": {"flag": "drop", "disc": "fill_zero"},
        "range_validations": {"l_quantity": {"max": 30}}},
        order_by=["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])
    return df.groupBy("l_linestatus").agg(n(F.count(F.lit(1))).alias("n"), r(F.sum("disc"), 2).alias("disc"), r(F.sum("l_quantity"), 2).alias("q"))


@query("clean_decimals", "SELECT o_orderstatus, round(sum(CAST(o_totalprice AS DECIMAL(12,2))), 2)::DOUBLE AS total FROM orders GROUP BY ALL")
def _(t):
    df = decimals_to_double(t.orders.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(12,2)")))
    return df.groupBy("o_orderstatus").agg(r(F.sum("o_totalprice"), 2).alias("total"))


@query("aggregate_functions", """
SELECT o_orderpriority, round(sum(o_totalprice), 2) AS o_totalprice_sum, round(avg(o_totalprice), 4) AS o_totalprice_mean,
 count(o_totalprice) AS o_totalprice_count, min(o_totalprice) AS o_totalprice_min, max(o_totalprice) AS o_totalprice_max,
 round(quantile_cont(o_totalprice, 0.5), 4)::DOUBLE AS o_totalprice_median, round(stddev_samp(o_totalprice), 3) AS o_totalprice_std,
 round(var_samp(o_totalprice), 0) AS o_totalprice_var, count(DISTINCT o_custkey) AS o_custkey_nunique, count(*) AS o_custkey_size,
 arg_min(o_custkey, o_orderkey) AS o_custkey_first, arg_max(o_custkey, o_orderkey) AS o_custkey_last
FROM orders GROUP BY ALL""")
def _(t):
    a = aggregate(t.orders, ["o_orderpriority"], {
        "o_totalprice": ["sum", "mean", "count", "min", "max", "median", "std", "var"], "o_custkey": ["nunique", "size", "first", "last"]},
        order_col="o_orderkey")
    return a.withColumns({"o_totalprice_sum": r("o_totalprice_sum", 2), "o_totalprice_mean": r("o_totalprice_mean"),
                          "o_totalprice_median": r("o_totalprice_median"), "o_totalprice_std": r("o_totalprice_std", 3),
                          "o_totalprice_var": r("o_totalprice_var", 0)})


@query("aggregate_null_keys", f"SELECT flag, count(*) AS l_quantity_size, round(sum(l_quantity), 2) AS l_quantity_sum FROM ({LINES}) WHERE flag IS NOT NULL GROUP BY ALL")
def _(t):
    a = aggregate(lines(t), ["flag"], {"l_quantity": ["size", "sum"]})
    return a.withColumn("l_quantity_sum", r("l_quantity_sum", 2))


@query("aggregate_null_keys_kept", f"SELECT flag, round(quantile_cont(l_extendedprice, 0.5), 4)::DOUBLE AS l_extendedprice_median, count(disc) AS disc_count FROM ({LINES}) GROUP BY ALL")
def _(t):
    a = aggregate(lines(t), ["flag"], {"l_extendedprice": "median", "disc": "count"}, null_keys="keep")
    return a.withColumn("l_extendedprice_median", r("l_extendedprice_median"))


@query("aggregate_whole_table", """
SELECT round(sum(p_retailprice), 2) AS p_retailprice_sum, round(quantile_cont(p_retailprice, 0.5), 4)::DOUBLE AS p_retailprice_median,
 max(p_size) AS p_size_max FROM part""")
def _(t):
    a = aggregate(t.part, [], {"p_retailprice": ["sum", "median"], "p_size": "max"})
    return a.withColumns({"p_retailprice_sum": r("p_retailprice_sum", 2), "p_retailprice_median": r("p_retailprice_median")})


@query("aggregate_product", "SELECT l_linenumber, round(product(1 + l_tax / 1000), 3) AS f_prod FROM lineitem GROUP BY ALL")
def _(t):
    a = aggregate(t.lineitem.withColumn("f", 1 + F.col("l_tax") / 1000), ["l_linenumber"], {"f": "prod"})
    return a.withColumn("f_prod", r("f_prod", 3))


@query("stack_inputs", """
SELECT kind, count(*) AS n, count(nation) AS with_nation, round(sum(balance), 2) AS balance FROM (
 SELECT 'customer' AS kind, c_nationkey AS nation, c_acctbal AS balance FROM customer
 UNION ALL SELECT 'supplier', NULL, s_acctbal FROM supplier) GROUP BY ALL""")
def _(t):
    df = stack([t.customer.select(F.lit("customer").alias("kind"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")),
                t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("balance"))])
    return df.groupBy("kind").agg(n(F.count(F.lit(1))).alias("n"), n(F.count("nation")).alias("with_nation"), r(F.sum("balance"), 2).alias("balance"))


@query("user_callable", """
SELECT c_mktsegment, count(o_orderkey) AS orders, '2024-02-01' AS processing_date
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY ALL""")
def _(t):
    def orders_per_segment(inputs, context):
        joined = inputs["customers"].join(inputs["orders"], F.col("c_custkey") == F.col("o_custkey"), "left")
        return joined.groupBy("c_mktsegment").agg(n(F.count("o_orderkey")).alias("orders")).withColumn("processing_date", F.lit(context["ds"]))

    return run_callable(orders_per_segment, {"customers": t.customer, "orders": t.orders}, {"ds": "2024-02-01"})


@query("user_vectorized_function", "SELECT o_orderstatus, round(sum(o_totalprice * 1.1), 2) AS gross FROM orders GROUP BY ALL")
def _(t):
    @F.pandas_udf("double")
    def gross(price: pd.Series) -> pd.Series:
        return price * 1.1

    return t.orders.withColumn("gross", gross("o_totalprice")).groupBy("o_orderstatus").agg(r(F.sum("gross"), 2).alias("gross"))


@query("user_table_function", """
SELECT word_length, count(*) AS n FROM (
 SELECT length(unnest(string_split(p_name, ' '))) AS word_length FROM part) GROUP BY ALL""")
def _(t):
    @F.udtf(returnType="word_length bigint", useArrow=True)
    class WordLengths:
        def eval(self, name: str):
            for word in name.split(" "):
                yield (len(word),)

    t.spark.udtf.register("word_lengths", WordLengths)
    t.views("part")
    words = t.spark.sql("SELECT w.word_length FROM part, LATERAL word_lengths(p_name) w")
    return words.groupBy("word_length").agg(n(F.count(F.lit(1))).alias("n"))


def measure(batches):
    """Languages and lengths, batch by batch. A `.str` accessor and its column hold each other, so every batch would stay in memory until a full garbage collection."""
    for batch in batches:
        yield batch[["lang"]].assign(chars=batch["text"].map(len, na_action="ignore"))


@query("user_batch_function", "SELECT lang, count(*) AS n, sum(length(text))::BIGINT AS chars FROM documents GROUP BY ALL")
def _(t):
    """Batches in, batches out: any share of the rows may have one language."""
    measured = t.documents.select("lang", "text").mapInPandas(measure, "lang string, chars bigint")
    return measured.groupBy("lang").agg(n(F.count(F.lit(1))).alias("n"), n(F.sum("chars")).alias("chars"))


@query("user_command", "SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY ALL")
def _(t):
    """Rows piped through an external command, one process per task."""
    piped = through_command(t.orders, ["o_orderkey", "o_orderstatus"], "cat", "k string, status string")
    return piped.groupBy("status").agg(n(F.count(F.lit(1))).alias("n"))
