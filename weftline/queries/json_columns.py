"""JSON flattening over the event properties and over documents built from orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators.jsonflat import (
    Options, context_activities, discover, field_coverage, find_json_column, flatten_json, leaves_from_json, leaves_to_json,
    parse, split_records,
)
from weftline.queries.registry import n, query, r

RAW = Options(type_inference=False)


def order_documents(t):
    """Orders as JSON of three shapes: nested object, text where the object was, and a list of two records."""
    return t.orders.select("o_orderkey", F.expr("""CASE o_orderstatus
      WHEN 'F' THEN concat('{"order":{"key":', o_orderkey, ',"big price":', o_totalprice, '},"tags":["f",', o_custkey, '],"done":true}')
      WHEN 'O' THEN concat('{"order":"open","lines":[{"n":', o_orderkey, '},{"n":', o_orderkey + 1, ',"p":"', o_orderpriority, '"}],"done":false}')
      ELSE concat('[{"order":{"key":', o_orderkey, '}},{"order":{"key":', o_orderkey + 1, '},"none":{},"tags":[]}]') END""").alias("event"))


@query("json_flatten_properties", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(t):
    return flatten_json(t.events.select("event_id", "props"), "props")


@query("json_flatten_mixed_shapes", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'open' END AS "order",
 CASE o_orderstatus WHEN 'O' THEN NULL ELSE CAST(o_orderkey + i AS VARCHAR) END AS order_key,
 CASE WHEN o_orderstatus = 'F' THEN '["f", ' || o_custkey || ']' WHEN o_orderstatus = 'P' AND i = 1 THEN '[]' END AS tags,
 CASE WHEN o_orderstatus = 'P' AND i = 1 THEN '0' END AS tags_count,
 CASE WHEN o_orderstatus = 'F' THEN 'true' WHEN o_orderstatus = 'O' THEN 'false' END AS done,
 CASE WHEN o_orderstatus = 'O' THEN '[{"n":' || o_orderkey || '}, {"n":' || (o_orderkey + 1) || ',"p":"' || o_orderpriority || '"}]' END AS lines,
 CASE WHEN o_orderstatus = 'O' THEN '2' END AS lines_count,
 CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderkey AS VARCHAR) END AS lines_first_n,
 CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderkey AS VARCHAR) END AS lines_0_n,
 CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderkey + 1 AS VARCHAR) END AS lines_1_n,
 CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS lines_1_p
FROM orders, (SELECT unnest([0, 1]) AS i) WHERE o_orderstatus = 'P' OR i = 0""")
def _(t):
    return flatten_json(order_documents(t), "event", RAW).drop("order_big_price")


@query("json_flatten_types", """
SELECT "order", order_key, round(sum(order_big_price), 2) AS total, done, max(lines_count) AS lines_count FROM (
 SELECT CASE WHEN o_orderstatus = 'O' THEN 'open' END AS "order", CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'P' THEN 1 END AS order_key,
 CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS order_big_price,
 CASE WHEN o_orderstatus = 'F' THEN true WHEN o_orderstatus = 'O' THEN false END AS done,
 CASE WHEN o_orderstatus = 'O' THEN 2::BIGINT END AS lines_count FROM orders) GROUP BY "order", order_key, done""")
def _(t):
    f = flatten_json(order_documents(t), "event")
    kinds = dict(f.dtypes)
    assert kinds["done"] == "boolean" and kinds["order_key"] == "bigint" and kinds["order_big_price"] == "double"
    f = f.withColumn("order_key", F.when(F.col("done"), 0).when(F.col("order").isNull(), 1))
    return f.groupBy("order", "order_key", "done").agg(r(F.sum("order_big_price"), 2).alias("total"), F.max("lines_count").alias("lines_count"))


@query("json_large_integers", """
SELECT o_orderkey, 1234567890123456789 + o_orderkey AS id, '1234567890123456789012' || o_orderkey AS wide, o_totalprice AS price FROM orders""")
def _(t):
    """Whole numbers of 19 digits are bigint; larger ones stay text, and nothing is rounded."""
    docs = t.orders.select("o_orderkey", F.expr("""concat('{"id":', 1234567890123456789 + o_orderkey, ',"wide":"1234567890123456789012', o_orderkey, '","price":"', o_totalprice, '"}')""").alias("event"))
    return flatten_json(docs, "event")


@query("json_deep_arrays", "SELECT o_orderkey, o_custkey AS a FROM orders UNION ALL SELECT o_orderkey, o_custkey + 1 FROM orders WHERE o_orderkey % 2 = 0")
def _(t):
    """Five arrays in one another around one record, or around two at different levels."""
    docs = t.orders.select("o_orderkey", F.expr("""CASE WHEN o_orderkey % 2 = 0 THEN concat('[[[[[{"a":', o_custkey, '}]]],{"a":', o_custkey + 1, '}]]')
      ELSE concat('[[[[[{"a":', o_custkey, '}]]]]]') END""").alias("event"))
    return flatten_json(docs, "event")


@query("json_colliding_names", "SELECT o_orderkey, o_custkey AS a_b, o_orderkey + 1 AS a_b_1, o_custkey + 2 AS a_b_2 FROM orders")
def _(t):
    """Three places whose cleaned names are equal: none hides another."""
    docs = t.orders.select("o_orderkey", F.expr("""concat('{"a b":', o_orderkey + 1, ',"a_b":', o_custkey + 2, ',"a":{"b":', o_custkey, '}}')""").alias("event"))
    return flatten_json(docs, "event")


@query("json_duplicate_keys", "SELECT o_orderkey, o_custkey AS a FROM orders")
def _(t):
    """Of a key that stands twice in an object the last value counts."""
    return flatten_json(t.orders.select("o_orderkey", F.expr("""concat('{"a":0,"a":', o_custkey, '}')""").alias("event")), "event")


@query("json_flatten_array_modes", """
SELECT count(*) FILTER (o_orderstatus = 'F') AS first_is_f, 2 * count(*) FILTER (o_orderstatus = 'F') AS tag_items,
 count(*) FILTER (o_orderstatus = 'F') + count(*) FILTER (o_orderstatus = 'P') AS counted FROM orders""")
def _(t):
    docs = order_documents(t)
    first = flatten_json(docs, "event", Options(type_inference=False, array_handling="first_item"))
    count = flatten_json(docs, "event", Options(type_inference=False, array_handling="count"))
    a = first.agg(n(F.count_if(F.col("tags") == "f")).alias("first_is_f"))
    return a.withColumns({
        "tag_items": count.agg(n(F.sum(F.col("tags_count").cast("bigint")))).scalar(),
        "counted": count.agg(n(F.count("tags_count"))).scalar()})


@query("json_flatten_options", """
SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN '{"big price":' || CASE WHEN o_totalprice = trunc(o_totalprice) THEN CAST(CAST(o_totalprice AS BIGINT) AS VARCHAR) ELSE CAST(o_totalprice AS VARCHAR) END || ',"key":' || o_orderkey || '}'
  WHEN o_orderstatus = 'O' THEN 'open' END AS doc_order FROM orders WHERE o_orderstatus <> 'P'""")
def _(t):
    """Numbers inside JSON text are in their shortest form (1.0 is 1)."""
    docs = order_documents(t).filter(~F.col("event").startswith("["))
    f = flatten_json(docs, "event", Options(type_inference=False, column_prefix="doc_", max_depth=1, include_original=True))
    return f.select(F.col("o_orderkey").alias("id"), "doc_order")


@query("json_known_fields", """
SELECT o_orderpriority AS p, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY ALL""")
def _(t):
    """A stored field list skips discovery: one pass over the data."""
    docs = order_documents(t)
    fields = leaves_from_json(leaves_to_json(discover(split_records(docs, "event"))))
    f = flatten_json(docs, "event", RAW, leaves=fields)
    return f.filter("lines_1_p IS NOT NULL").groupBy(F.col("lines_1_p").alias("p")).agg(n(F.count(F.lit(1))).alias("n"))


@query("json_field_list", """
SELECT unnest(['order', 'order.big price', 'order.key', 'done', 'tags', 'lines', 'lines.n', 'lines.p', 'none']) AS field
FROM (SELECT count(*) AS c FROM orders) WHERE c > 0""")
def _(t):
    leaves = discover(split_records(order_documents(t), "event"))
    names = sorted({".".join((*x.path, *x.inner)) for x in leaves if x.path} - {"", "x"})
    return t.spark.createDataFrame([(x,) for x in names], "field string")


@query("json_bad_documents", """
SELECT count(*) AS n, count(*) FILTER (event_type NOT IN ('error', 'click')) AS parsed FROM events""")
def _(t):
    docs = t.events.select(F.when(F.col("event_type") == "error", "{bad").when(F.col("event_type") == "click", " ").otherwise(F.col("props")).alias("event"))
    return flatten_json(docs, "event").agg(n(F.count(F.lit(1))).alias("n"), n(F.count("k")).alias("parsed"))


@query("json_top_level_values", """
SELECT value, count(*) AS n FROM (SELECT o_orderpriority AS value FROM orders UNION ALL SELECT NULL FROM orders WHERE o_orderstatus = 'F') GROUP BY ALL""")
def _(t):
    docs = t.orders.select(F.expr("""concat('["', o_orderpriority, '"', if(o_orderstatus = 'F', ',null', ''), ']')""").alias("event"))
    return flatten_json(docs, "event", RAW).groupBy("value").agg(n(F.count(F.lit(1))).alias("n"))


@query("json_find_column", "SELECT 'props' AS found, count(*) AS n FROM events")
def _(t):
    return t.events.agg(n(F.count(F.lit(1))).alias("n")).select(F.lit(find_json_column(t.events)).alias("found"), "n")


@query("json_coverage", """
SELECT f.field, count(*) FILTER (f.has) AS filled, count(*) AS total, round(count(*) FILTER (f.has) * 100.0 / count(*), 2)::DOUBLE AS coverage FROM (
 SELECT unnest([{'field': 'order_key', 'has': o_orderstatus <> 'O'}, {'field': 'done', 'has': o_orderstatus <> 'P'},
  {'field': 'lines_1_p', 'has': o_orderstatus = 'O'}]) AS f FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'P')) GROUP BY ALL""")
def _(t):
    f = flatten_json(order_documents(t), "event", RAW)
    c = field_coverage(f, ["order_key", "done", "lines_1_p"])
    return c.select("field", n("filled").alias("filled"), n("total").alias("total"), "coverage")


@query("json_activities", """
SELECT n_name AS ctx_first_name, count(*) AS n, min('u/' || c_custkey) AS low_id FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def _(t):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    docs = joined.select(parse(F.expr("""concat('{"ctx":[{"id":"u/', c_custkey, '","definition":{"name":{"en":"', n_name, '"}}}]}')""")).alias("doc"))
    columns = context_activities(F.col("doc"), ("ctx",), "ctx")
    return (docs.select(columns["ctx_first_name"].alias("ctx_first_name"), columns["ctx_0_id"].alias("id"))
            .groupBy("ctx_first_name").agg(n(F.count(F.lit(1))).alias("n"), F.min("id").alias("low_id")))
