"""Relational steps of data pipelines: summaries, joins, view chains, category reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from weftline.operators.aggregate import aggregate
from weftline.plans.runner import Runner
from weftline.plans.spec import load_plan
from weftline.queries.registry import n, query, r, sql_query

DS = "2001-08-01"

SUMMARY = """
SELECT c.c_custkey AS customer_id, c.c_name || ' / ' || c.c_mktsegment AS full_name, c.c_mktsegment AS segment,
  CAST(COALESCE(COUNT(o.o_orderkey), 0) AS BIGINT) AS orders_count,
  ROUND(COALESCE(SUM(o.o_totalprice), 0), 2) AS total_spent, ROUND(COALESCE(AVG(o.o_totalprice), 0), 6) AS avg_order_value,
  MAX(o.o_orderdate) AS last_order, DATE '2001-08-01' AS processing_date
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
GROUP BY c.c_custkey, c.c_name, c.c_mktsegment"""

sql_query("customer_summary", "customer orders", SUMMARY)

sql_query("projection_and_filter", "orders", """
SELECT o_orderkey AS column1, o_custkey AS column2, o_totalprice * 1.1 AS column3, 'orders' AS kind, UPPER(o_orderpriority) AS priority
FROM orders WHERE o_totalprice > 100000 AND (o_orderstatus = 'F' OR o_orderpriority = '1-URGENT') AND o_custkey IS NOT NULL""",
          """SELECT o_orderkey AS column1, o_custkey AS column2, o_totalprice * 1.1::DOUBLE AS column3, 'orders' AS kind, UPPER(o_orderpriority) AS priority
FROM orders WHERE o_totalprice > 100000 AND (o_orderstatus = 'F' OR o_orderpriority = '1-URGENT') AND o_custkey IS NOT NULL""")


@query("date_window", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderdate >= DATE '2001-08-01' - INTERVAL '365 days' GROUP BY ALL")
def _(t):
    """The window ends at an injected run date; the comparison is pushed down to the files."""
    t.views("orders")
    return Runner(t.spark).sql("""
        SELECT o_orderstatus, count(*) AS n FROM orders
        WHERE o_orderdate >= CAST(to_date('{{ ds }}') - INTERVAL '365' DAY AS TIMESTAMP_NTZ) GROUP BY o_orderstatus""", {}, {"ds": DS, "ts": DS})


sql_query("left_join", "lineitem part", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, p.p_name, p.p_brand, p.p_type
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey AND p.p_size > 10""")

sql_query("sales_by_category", "lineitem part supplier nation region", """
SELECT p_type AS category, r_name AS region, COUNT(*) AS total_sales, ROUND(SUM(l_quantity), 2) AS total_quantity,
  ROUND(SUM(l_extendedprice), 2) AS total_revenue, ROUND(AVG(l_extendedprice), 6) AS avg_sale, DATE '2001-08-01' AS processing_date
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY p_type, r_name""")

sql_query("global_count", "orders", "SELECT count(*) AS total FROM orders")

sql_query("distinct_with_group", "orders", """
SELECT DISTINCT(o_custkey) AS distinct_customers, COUNT(*) AS orders_per_customer FROM orders
GROUP BY o_custkey ORDER BY orders_per_customer DESC""")

sql_query("top_orders", "orders", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")

sql_query("count_case_and_filter", "orders", """
SELECT o_orderpriority, COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS finished, COUNT(*) FILTER (WHERE o_totalprice > 200000) AS big,
  CAST(ROUND(COUNT(*) FILTER (WHERE o_orderstatus = 'O') * 100.0 / COUNT(*), 2) AS DOUBLE) AS open_percent,
  COALESCE(MAX(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END), 0) AS largest_pending
FROM orders GROUP BY o_orderpriority""")


@query("category_report", """
SELECT o_orderpriority, round(sum(o_totalprice), 2) AS o_totalprice_sum, round(avg(o_totalprice), 3) AS o_totalprice_mean,
 count(o_totalprice) AS o_totalprice_count, DATE '2001-08-01' AS processing_date, count(*) OVER () AS total_categories
FROM orders GROUP BY o_orderpriority""")
def _(t):
    a = aggregate(t.orders, ["o_orderpriority"], {"o_totalprice": ["sum", "mean", "count"]})
    return a.select("o_orderpriority", r("o_totalprice_sum", 2).alias("o_totalprice_sum"), r("o_totalprice_mean", 3).alias("o_totalprice_mean"),
                    "o_totalprice_count", F.lit(DS).cast("date").alias("processing_date"),
                    a.agg(n(F.count(F.lit(1)))).scalar().alias("total_categories"))


@query("validated_summary", f"""
SELECT customer_id, total_spent FROM ({SUMMARY}) WHERE full_name IS NOT NULL AND contains(full_name, '#') AND total_spent BETWEEN 0 AND 3000000""")
def _(t):
    t.views("customer", "orders")
    s = t.spark.sql(SUMMARY).dropDuplicates(["customer_id"]).filter(F.col("full_name").isNotNull() & F.col("full_name").contains("#"))
    return s.fillna(0, ["total_spent"]).filter(F.col("total_spent").between(0, 3000000)).select("customer_id", "total_spent")


@query("numbers_or_zero", """
SELECT event_type, round(sum(coalesce(TRY_CAST(v AS DOUBLE), 0)), 2) AS total, count(*) AS n FROM
 (SELECT event_type, CASE WHEN event_type = 'click' THEN 'missing' ELSE CAST(value AS VARCHAR) END AS v FROM events) GROUP BY ALL""")
def _(t):
    from weftline.functions.columns import to_number

    df = t.events.withColumn("v", F.when(F.col("event_type") == "click", "missing").otherwise(F.col("value").cast("string")))
    return (df.withColumn("v", F.coalesce(to_number(F.col("v")), F.lit(0.0))).groupBy("event_type")
            .agg(r(F.sum("v"), 2).alias("total"), n(F.count(F.lit(1))).alias("n")))


@query("json_attributes", "SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def _(t):
    v = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return t.events.groupBy(v.alias("k")).agg(n(F.count(F.lit(1))).alias("n"), r(F.sum("value"), 2).alias("total"))


VIEW_CHAIN = {
    "dag_id": "view_chain", "description": "three SQL steps, one Spark plan",
    "tasks": [
        {"task_id": "sales", "operator_type": "extract", "source": {"name": "s", "type": "file", "file_path": "given"}},
        {"task_id": "big_sales", "operator_type": "transform", "depends_on": ["sales"],
         "sql_transform": "SELECT l_suppkey AS supplier, l_extendedprice AS price FROM sales WHERE l_quantity > 25"},
        {"task_id": "per_supplier", "operator_type": "transform", "source_task_ids": ["big_sales"],
         "sql_transform": "SELECT supplier, COUNT(*) AS n, ROUND(SUM(price), 2) AS total FROM big_sales GROUP BY supplier"},
        {"task_id": "stamped", "operator_type": "transform", "depends_on": ["per_supplier"],
         "sql_transform": "SELECT 'sales' AS source, CAST(:ds AS DATE) AS processing_date, * FROM per_supplier"},
    ],
}


@query("view_chain", """
SELECT 'sales' AS source, DATE '2001-08-01' AS processing_date, l_suppkey AS supplier, count(*) AS n, round(sum(l_extendedprice), 2) AS total
FROM lineitem WHERE l_quantity > 25 GROUP BY l_suppkey""")
def _(t):
    run = Runner(t.spark).run(load_plan(VIEW_CHAIN), datetime(2001, 8, 1), {"sales": t.lineitem})
    return run.frames["stamped"]


@query("half_even_rounding", """
WITH c AS (SELECT o_orderpriority, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
SELECT o_orderpriority, count(*) AS n, count(*) FILTER (WHERE cents % 10 = 5) AS ties, (sum((cents + 5) // 10))::BIGINT AS tenths_up,
 (sum(CASE WHEN cents % 10 = 5 THEN cents // 10 + (cents // 10) % 2 ELSE (cents + 5) // 10 END))::BIGINT AS tenths_even
FROM c GROUP BY ALL""")
def _(t):
    """Both ways to round to tenths, summed up as whole tenths; they differ on ties only."""
    d = F.col("o_totalprice").cast("decimal(12,2)")
    tenths = lambda x: n(F.sum((x * 10).cast("bigint")))
    return t.orders.groupBy("o_orderpriority").agg(n(F.count(F.lit(1))).alias("n"), n(F.count_if((d * 100).cast("bigint") % 10 == 5)).alias("ties"),
                                                   tenths(F.round(d, 1)).alias("tenths_up"), tenths(F.bround(d, 1)).alias("tenths_even"))
