"""The SQL surface users write in transforms: one whole-table query per construct.

Windows run over daily or per-order aggregates, so a window group is bounded by
the number of days or lines, however many rows one key has.
"""

from __future__ import annotations

from weftline.functions.sqlnames import register
from weftline.plans.runner import Runner
from weftline.queries.registry import query, sql_query

DAILY = """daily AS (
  SELECT o_orderpriority AS grp, CAST(o_orderdate AS DATE) AS day, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total
  FROM orders GROUP BY o_orderpriority, CAST(o_orderdate AS DATE))"""

sql_query("sql_inner_join", "orders customer", """
SELECT o_orderkey, c_name, c_mktsegment, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0""")

sql_query("sql_cross_join_literal_bands", "customer", """
SELECT c_custkey, band, ROUND(c_acctbal * factor, 4) AS scaled
FROM customer CROSS JOIN (VALUES ('low', 0.5D), ('high', 1.5D)) AS b(band, factor)""",
          """SELECT c_custkey, band, ROUND(c_acctbal * factor, 4) AS scaled
FROM customer CROSS JOIN (VALUES ('low', 0.5::DOUBLE), ('high', 1.5::DOUBLE)) AS b(band, factor)""")

sql_query("sql_right_join", "orders customer", """
SELECT c_custkey, o_orderkey, o_totalprice FROM orders RIGHT JOIN customer ON o_custkey = c_custkey AND o_totalprice > 300000""")

sql_query("sql_full_join", "customer supplier", """
SELECT COALESCE(c.nation, s.nation) AS nation, customers, suppliers FROM
 (SELECT c_nationkey AS nation, COUNT(*) AS customers FROM customer WHERE c_acctbal < 500 GROUP BY c_nationkey) c
 FULL OUTER JOIN (SELECT s_nationkey AS nation, COUNT(*) AS suppliers FROM supplier WHERE s_acctbal > 500 GROUP BY s_nationkey) s
 ON c.nation = s.nation""")

sql_query("sql_range_join", "orders", """
SELECT band, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders
JOIN (VALUES ('small', 0D, 50000D), ('middle', 50000D, 200000D), ('large', 200000D, 1000000000D)) AS b(band, lo, hi)
  ON o_totalprice >= lo AND o_totalprice < hi GROUP BY band""",
          """SELECT band, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders
JOIN (VALUES ('small', 0::DOUBLE, 50000::DOUBLE), ('middle', 50000::DOUBLE, 200000::DOUBLE), ('large', 200000::DOUBLE, 1000000000::DOUBLE)) AS b(band, lo, hi)
  ON o_totalprice >= lo AND o_totalprice < hi GROUP BY band""")

sql_query("sql_self_join", "orders", f"""
WITH {DAILY} SELECT a.grp, a.day, a.n AS n_today, b.n AS n_next FROM daily a JOIN daily b ON a.grp = b.grp AND b.day = a.day + INTERVAL '1' DAY""",
          f"""WITH {DAILY} SELECT a.grp, a.day, a.n AS n_today, b.n AS n_next FROM daily a JOIN daily b ON a.grp = b.grp AND b.day = a.day + 1""")

sql_query("sql_join_using", "nation region customer", """
SELECT n_name, r_name, COUNT(*) AS customers FROM (SELECT n_nationkey AS k, n_name, n_regionkey AS rk FROM nation)
JOIN (SELECT r_regionkey AS rk, r_name FROM region) USING (rk) JOIN (SELECT c_nationkey AS k FROM customer) USING (k) GROUP BY n_name, r_name""")

sql_query("sql_natural_join", "nation region supplier", """
SELECT n_name, r_name, COUNT(*) AS suppliers FROM (SELECT n_nationkey AS k, n_name, n_regionkey AS rk FROM nation)
NATURAL JOIN (SELECT r_regionkey AS rk, r_name FROM region) NATURAL JOIN (SELECT s_nationkey AS k FROM supplier) GROUP BY n_name, r_name""")

sql_query("sql_semi_join_exists", "customer orders", """
SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""")

sql_query("sql_semi_join_in", "lineitem part", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 5)""")

sql_query("sql_anti_join_not_exists", "customer orders", """
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")

sql_query("sql_anti_join_not_in", "customer nation", """
SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)""")

sql_query("sql_union", "customer supplier", """
SELECT c_nationkey AS nation, 'any' AS kind FROM customer UNION SELECT s_nationkey, 'any' FROM supplier""")

sql_query("sql_union_all", "customer supplier", """
SELECT nation, COUNT(*) AS n FROM (SELECT c_nationkey AS nation FROM customer UNION ALL SELECT s_nationkey FROM supplier) GROUP BY nation""")

sql_query("sql_intersect", "orders lineitem", """
SELECT o_orderkey AS k FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'""")

sql_query("sql_except", "orders lineitem", """
SELECT o_orderkey AS k FROM orders EXCEPT SELECT l_orderkey FROM lineitem WHERE l_quantity > 10""")

sql_query("sql_having", "orders", """
SELECT o_custkey, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey HAVING COUNT(*) >= 10 AND SUM(o_totalprice) > 1000000""")

sql_query("sql_distinct_aggregate", "lineitem", """
SELECT l_returnflag, COUNT(DISTINCT l_suppkey) AS suppliers, COUNT(DISTINCT l_partkey) AS parts, COUNT(*) AS n FROM lineitem GROUP BY l_returnflag""")

sql_query("sql_scalar_subquery", "orders", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 1.5 * (SELECT AVG(o_totalprice) FROM orders)""",
          """SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 1.5 * (SELECT AVG(o_totalprice) FROM orders)""")

sql_query("sql_correlated_subquery", "orders", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders o
WHERE o_totalprice = (SELECT MAX(i.o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)""")

sql_query("sql_derived_table", "lineitem", """
SELECT lines, COUNT(*) AS orders FROM (SELECT l_orderkey, COUNT(*) AS lines FROM lineitem GROUP BY l_orderkey) GROUP BY lines""")

sql_query("sql_cte", "orders customer", """
WITH spend AS (SELECT o_custkey, SUM(o_totalprice) AS total FROM orders GROUP BY o_custkey),
     named AS (SELECT c_mktsegment, total FROM customer JOIN spend ON c_custkey = o_custkey)
SELECT c_mktsegment, COUNT(*) AS buyers, ROUND(MAX(total), 2) AS best FROM named GROUP BY c_mktsegment""")

sql_query("sql_recursive_cte", "orders", """
WITH RECURSIVE months(m, last) AS (
  SELECT CAST(DATE_TRUNC('month', MIN(o_orderdate)) AS DATE), CAST(MAX(o_orderdate) AS DATE) FROM orders
  UNION ALL SELECT ADD_MONTHS(m, 1), last FROM months WHERE ADD_MONTHS(m, 1) <= last),
counts AS (SELECT CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS m, COUNT(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT months.m AS month, COALESCE(n, 0) AS pending FROM months LEFT JOIN counts ON months.m = counts.m""",
          """
WITH RECURSIVE months(m, last) AS (
  SELECT CAST(DATE_TRUNC('month', MIN(o_orderdate)) AS DATE), CAST(MAX(o_orderdate) AS DATE) FROM orders
  UNION ALL SELECT CAST(m + INTERVAL 1 MONTH AS DATE), last FROM months WHERE m + INTERVAL 1 MONTH <= last),
counts AS (SELECT CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS m, COUNT(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT months.m AS month, COALESCE(n, 0) AS pending FROM months LEFT JOIN counts ON months.m = counts.m""")

sql_query("sql_ranking_windows", "orders", f"""
WITH {DAILY} SELECT grp, day, total, ROW_NUMBER() OVER w AS rn, RANK() OVER w AS rk, DENSE_RANK() OVER w AS dr, NTILE(4) OVER w AS quarter,
  ROUND(PERCENT_RANK() OVER w, 6) AS pr, ROUND(CUME_DIST() OVER w, 6) AS cd FROM daily WINDOW w AS (PARTITION BY grp ORDER BY total DESC, day)""",
          f"""WITH {DAILY} SELECT grp, day, total, (ROW_NUMBER() OVER w)::INTEGER AS rn, (RANK() OVER w)::INTEGER AS rk, (DENSE_RANK() OVER w)::INTEGER AS dr,
  (NTILE(4) OVER w)::INTEGER AS quarter, ROUND(PERCENT_RANK() OVER w, 6) AS pr, ROUND(CUME_DIST() OVER w, 6) AS cd
  FROM daily WINDOW w AS (PARTITION BY grp ORDER BY total DESC, day)""")

sql_query("sql_top_per_group", "orders", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT o_custkey, o_orderkey, o_totalprice, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
WHERE rn <= 3""")

sql_query("sql_analytic_windows", "orders", f"""
WITH {DAILY} SELECT grp, day, LAG(n) OVER w AS before, LEAD(n, 2, CAST(0 AS BIGINT)) OVER w AS after, FIRST_VALUE(n) OVER w AS first_n,
  LAST_VALUE(n) OVER (PARTITION BY grp ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_n,
  NTH_VALUE(n, 3) OVER w AS third FROM daily WINDOW w AS (PARTITION BY grp ORDER BY day)""")

sql_query("sql_frame_windows", "orders", f"""
WITH {DAILY} SELECT grp, day, SUM(n) OVER (PARTITION BY grp ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS last7,
  CAST(ROUND(AVG(n) OVER (PARTITION BY grp ORDER BY day RANGE BETWEEN INTERVAL '3' DAY PRECEDING AND CURRENT ROW), 6) AS DOUBLE) AS mean4,
  MAX(n) OVER (PARTITION BY grp ORDER BY day ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS ahead FROM daily""",
          f"""WITH {DAILY} SELECT grp, day, (SUM(n) OVER (PARTITION BY grp ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))::BIGINT AS last7,
  CAST(ROUND(AVG(n) OVER (PARTITION BY grp ORDER BY day RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND CURRENT ROW), 6) AS DOUBLE) AS mean4,
  MAX(n) OVER (PARTITION BY grp ORDER BY day ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS ahead FROM daily""")

sql_query("sql_order_limit_offset", "orders", """
SELECT o_orderkey, price FROM (SELECT o_orderkey, NULLIF(o_totalprice, 0) AS price FROM orders) ORDER BY price ASC NULLS LAST, o_orderkey LIMIT 50 OFFSET 25""")

sql_query("sql_values_table", "orders", """
SELECT label, COUNT(*) AS n FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open')) AS s(code, label) ON o_orderstatus = code GROUP BY label""")

sql_query("sql_conditionals", "lineitem", """
SELECT kind, COUNT(*) AS n, COUNT(maybe) AS filled, SUM(IFNULL(maybe, -1)) AS total FROM (
  SELECT CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'returned' ELSE 'none' END AS kind, NULLIF(l_linenumber, 3) AS maybe FROM lineitem) GROUP BY kind""",
          """SELECT kind, COUNT(*) AS n, COUNT(maybe) AS filled, SUM(IFNULL(maybe, -1))::BIGINT AS total FROM (
  SELECT CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'returned' ELSE 'none' END AS kind, NULLIF(l_linenumber, 3) AS maybe FROM lineitem) GROUP BY kind""")

sql_query("sql_iif", "orders", "SELECT IF(o_totalprice > 100000, 'big', 'small') AS size, COUNT(*) AS n FROM orders GROUP BY 1",
          "SELECT CASE WHEN o_totalprice > 100000 THEN 'big' ELSE 'small' END AS size, COUNT(*) AS n FROM orders GROUP BY 1")

sql_query("sql_predicates", "part", """
SELECT p_partkey, p_name FROM part WHERE p_size BETWEEN 5 AND 25 AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#13')
  AND p_name ILIKE '%RED%' AND p_type IS NOT NULL""")

sql_query("sql_glob", "part", "SELECT p_partkey, p_name FROM part WHERE p_name RLIKE '^s.*[t-z]$'",
          "SELECT p_partkey, p_name FROM part WHERE p_name GLOB 's*[t-z]'")

sql_query("sql_strings", "customer", r"""
SELECT c_custkey, SUBSTR(c_name, 1, 8) AS head, INSTR(c_name, '#') AS mark, REPLACE(c_mktsegment, 'O', '0') AS swapped,
  TRIM('  ' || c_mktsegment || ' ') AS trimmed, LTRIM('  x') AS lt, RTRIM('x  ') AS rt, LOWER(c_name) AS low, LENGTH(c_name) AS len,
  PRINTF('%05d-%s', c_custkey, c_mktsegment) AS code, HEX(c_mktsegment) AS hexed FROM customer""",
          r"""SELECT c_custkey, SUBSTR(c_name, 1, 8) AS head, INSTR(c_name, '#')::INTEGER AS mark, REPLACE(c_mktsegment, 'O', '0') AS swapped,
  TRIM('  ' || c_mktsegment || ' ') AS trimmed, LTRIM('  x') AS lt, RTRIM('x  ') AS rt, LOWER(c_name) AS low, LENGTH(c_name)::INTEGER AS len,
  PRINTF('%05d-%s', c_custkey, c_mktsegment) AS code, HEX(c_mktsegment) AS hexed FROM customer""")


@query("sql_dates", """
SELECT CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%Y/%m week day %j') AS label, CAST(o_orderdate AS DATE) + 30 AS later,
  CAST(CAST(o_orderdate AS DATE) + INTERVAL 2 MONTH AS DATE) AS two_months, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS text,
  round(julian(o_orderdate) - 0.5, 6) AS jd, count(*) AS n FROM orders GROUP BY ALL""")
def _(t):
    register(t.spark)
    t.views("orders")
    return t.spark.sql("""
        SELECT CAST(o_orderdate AS DATE) AS day, strftime('%Y/%m week day %j', o_orderdate) AS label, DATE_ADD(CAST(o_orderdate AS DATE), 30) AS later,
          ADD_MONTHS(CAST(o_orderdate AS DATE), 2) AS two_months, datetime(o_orderdate) AS text, ROUND(julianday(o_orderdate), 6) AS jd, n
        FROM (SELECT o_orderdate, COUNT(*) AS n FROM orders GROUP BY o_orderdate)""")


sql_query("sql_math", "lineitem", """
SELECT l_orderkey, l_linenumber, ABS(l_tax - l_discount) AS gap, ROUND(l_extendedprice / 1000, 1) AS thousands, l_partkey % 7 AS rest, l_partkey DIV 7 AS whole,
  LEAST(l_tax, l_discount) AS low, GREATEST(l_tax, l_discount) AS high FROM lineitem""",
          """SELECT l_orderkey, l_linenumber, ABS(l_tax - l_discount) AS gap, ROUND(l_extendedprice / 1000, 1) AS thousands, l_partkey % 7 AS rest, l_partkey // 7 AS whole,
  LEAST(l_tax, l_discount) AS low, GREATEST(l_tax, l_discount) AS high FROM lineitem""")

sql_query("sql_group_concat", "lineitem", """
SELECT l_orderkey, LISTAGG(CAST(l_linenumber AS STRING), ',') WITHIN GROUP (ORDER BY l_linenumber) AS line_list, COALESCE(SUM(l_quantity), 0.0D) AS total
FROM lineitem GROUP BY l_orderkey""",
          """SELECT l_orderkey, STRING_AGG(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS line_list, COALESCE(SUM(l_quantity), 0.0)::DOUBLE AS total
FROM lineitem GROUP BY l_orderkey""")

sql_query("sql_json_functions", "events", """
SELECT event_id, CAST(get_json_object(props, '$.k') AS BIGINT) AS k, json_array_length(concat('[1,', get_json_object(props, '$.k'), ']')) AS len FROM events""",
          """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
json_array_length('[1,' || json_extract_string(props, '$.k') || ']')::INTEGER AS len FROM events""")

sql_query("sql_json_table", "events", """
SELECT e.key AS name, CAST(e.value AS BIGINT) AS number, COUNT(*) AS n
FROM events, LATERAL variant_explode(parse_json(props)) AS e GROUP BY e.key, CAST(e.value AS BIGINT)""",
          """SELECT name, CAST(json_extract(props, '$.' || name) AS BIGINT) AS number, COUNT(*) AS n
FROM (SELECT props, unnest(json_keys(props)) AS name FROM events) GROUP BY ALL""")

sql_query("sql_casts", "events", """
SELECT event_type, COUNT(TRY_CAST(event_type AS INT)) AS none, SUM(CAST(value AS BIGINT)) AS whole, COUNT(CAST(ts AS DATE)) AS days, MAX(CAST(user_id AS STRING)) AS text
FROM events GROUP BY event_type""",
          """SELECT event_type, COUNT(TRY_CAST(event_type AS INT)) AS none, SUM(CAST(trunc(value) AS BIGINT))::BIGINT AS whole, COUNT(CAST(ts AS DATE)) AS days,
MAX(CAST(user_id AS VARCHAR)) AS text FROM events GROUP BY event_type""")


def transform(t, text: str, *names: str):
    """SQL text as a transform task runs it."""
    return Runner(t.spark).sql(text, {name: getattr(t, name) for name in names}, {})


@query("sql_names_times", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m week day ') || CAST(dayofweek(o_orderdate) AS VARCHAR) || ' 100%' AS label,
  strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH - INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS month_end,
  strftime(date_trunc('year', o_orderdate) + INTERVAL 36 HOUR, '%H:%M:%S') AS noon, CAST(epoch(o_orderdate) AS BIGINT) AS seconds,
  CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH + to_days(CAST(day(o_orderdate) - 1 AS INTEGER)) AS DATE) AS month_later,
  round(julian(o_orderdate) - 0.5 + 7, 6) AS jd, strftime(o_orderdate, '%Y-%m-%d') AS again, CAST(NULL AS VARCHAR) AS no_time FROM orders""")
def _(t):
    return transform(t, """
        SELECT o_orderkey, strftime('%Y-%m week day %w 100%%', o_orderdate) AS label, datetime(o_orderdate, 'start of month', '+1 month', '-1 day') AS month_end,
          time_of(o_orderdate, 'start of year', '+36 hours') AS noon, unixepoch(o_orderdate) AS seconds, day_of(o_orderdate, '+1 month') AS month_later,
          ROUND(julianday(o_orderdate, '+7 days'), 6) AS jd, CAST(day_of(unixepoch(o_orderdate), 'unixepoch') AS STRING) AS again,
          datetime(o_orderpriority) AS no_time FROM orders""", "orders")


@query("sql_names_glob", """
SELECT p_partkey, p_name GLOB 's*[t-z]' AS ends, p_name GLOB '?e*' AS second, p_name GLOB '[!a-m]*' AS late, p_brand GLOB '*[#]1[0-9]' AS tens FROM part""")
def _(t):
    return transform(t, """
        SELECT p_partkey, glob('s*[t-z]', p_name) AS ends, glob('?e*', p_name) AS second, glob('[^a-m]*', p_name) AS late,
          glob('*[#]1[0-9]', p_brand) AS tens FROM part""", "part")


@query("sql_names_json", """
SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS last_digit, count(*) AS n, count(json_extract_string(props, '$.nope')) AS others FROM events GROUP BY 1""")
def _(t):
    return transform(t, """
        SELECT CAST(json_extract(props, '$.k') AS BIGINT) % 10 AS last_digit, count(*) AS n, count(json_extract(props, '$.nope')) AS others FROM events GROUP BY 1""", "events")
