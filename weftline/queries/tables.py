"""Table writes, reads and staged outputs over the given tables. Files go to the shared folder."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from weftline.functions.names import clean_identifier, match_column
from weftline.operators.staging import LINEAGE, Stage
from weftline.plans.runner import Runner, first_non_empty
from weftline.plans.spec import SinkSpec, SourceSpec, load_plan
from weftline.queries.registry import n, query, r
from weftline.session import scratch_path
from weftline.sinks.registry import write_many
from weftline.sinks.shape import align_to, clean_names, serialize_for_sink, with_schema
from weftline.sinks.tables import (
    evolve_table, newest_version, overwrite_partitions, read_table, reprocess_window, write_table,
)
from weftline.sinks.buckets import read_buckets, upsert_buckets
from weftline.sources.documents import filter_documents
from weftline.sources.files import read_files, read_wildcard
from weftline.sources.normalize import normalize_types
from weftline.sources.registry import read_source
from weftline.sources.remote import unwrap_payload

RUN = datetime(2001, 8, 1)

# Old and new state of the same table: new rows change the price and bring more orders.
OLD = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderpriority <> '1-URGENT'"
NEW = "SELECT o_orderkey, o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderstatus <> 'F'"


def old_rows(t):
    return t.orders.filter("o_orderpriority <> '1-URGENT'").select("o_orderkey", "o_orderstatus", "o_totalprice")


def new_rows(t):
    return t.orders.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_orderstatus", (F.col("o_totalprice") + 1).alias("o_totalprice"))


def digest(df):
    return df.groupBy("o_orderstatus").agg(n(F.count(F.lit(1))).alias("n"), n(F.count_distinct("o_orderkey")).alias("keys"), r(F.sum("o_totalprice"), 2).alias("total"))


def digest_sql(rows):
    return f"SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_orderkey) AS keys, round(sum(o_totalprice), 2) AS total FROM ({rows}) GROUP BY ALL"


def started(t, label, **kw):
    path = scratch_path(t.spark, label)
    write_table(old_rows(t), path, "overwrite", **kw)
    return path


@query("write_overwrite", digest_sql(NEW))
def _(t):
    path = started(t, "overwrite")
    write_table(new_rows(t), path, "overwrite")
    return digest(read_table(t.spark, path))


@query("write_append", digest_sql(f"{OLD} UNION ALL {NEW}"))
def _(t):
    path = started(t, "append")
    write_table(new_rows(t), path, "append")
    return digest(read_table(t.spark, path))


UPSERTED = f"""SELECT coalesce(i.o_orderkey, o.o_orderkey) AS o_orderkey, coalesce(i.o_orderstatus, o.o_orderstatus) AS o_orderstatus,
 coalesce(i.o_totalprice, o.o_totalprice) AS o_totalprice FROM ({OLD}) o FULL JOIN ({NEW}) i ON o.o_orderkey = i.o_orderkey"""


@query("write_upsert", digest_sql(UPSERTED))
def _(t):
    path = started(t, "upsert")
    write_table(new_rows(t), path, "upsert", keys=["o_orderkey"])
    return digest(read_table(t.spark, path))


@query("write_upsert_twice", digest_sql(UPSERTED))
def _(t):
    """A repeated upsert changes nothing; of equal keys in one input, the first in the given order wins."""
    path = started(t, "upsert2")
    both = new_rows(t).withColumn("o_totalprice", F.col("o_totalprice") - 1).withColumn("age", F.lit(2)).unionByName(new_rows(t).withColumn("age", F.lit(1)))
    for _ in range(2):
        write_table(both, path, "upsert", keys=["o_orderkey"], order=[F.col("age")])
    return digest(read_table(t.spark, path).drop("age"))


@query("write_upsert_partitions", digest_sql(UPSERTED))
def _(t):
    """Only partitions the input touches are rewritten."""
    path = started(t, "parts", partition_by=["o_orderstatus"])
    write_table(new_rows(t), path, "upsert", keys=["o_orderkey", "o_orderstatus"], partition_by=["o_orderstatus"])
    return digest(read_table(t.spark, path))


@query("write_update_only", digest_sql(f"""SELECT o.o_orderkey, coalesce(i.o_orderstatus, o.o_orderstatus) AS o_orderstatus,
 coalesce(i.o_totalprice, o.o_totalprice) AS o_totalprice FROM ({OLD}) o LEFT JOIN ({NEW}) i ON o.o_orderkey = i.o_orderkey"""))
def _(t):
    path = started(t, "update")
    write_table(new_rows(t), path, "update", keys=["o_orderkey"])
    return digest(read_table(t.spark, path))


@query("write_insert_only", digest_sql(f"{OLD} UNION ALL SELECT * FROM ({NEW}) i WHERE NOT EXISTS (SELECT 1 FROM ({OLD}) o WHERE o.o_orderkey = i.o_orderkey)"))
def _(t):
    path = started(t, "insert")
    write_table(new_rows(t), path, "insert_only", keys=["o_orderkey"])
    return digest(read_table(t.spark, path))


@query("read_newest_version", digest_sql(UPSERTED))
def _(t):
    """Append only; the read view keeps the newest version of a key."""
    path = scratch_path(t.spark, "versions")
    write_table(old_rows(t).withColumn("version", F.lit(1)), path, "append")
    write_table(new_rows(t).withColumn("version", F.lit(2)), path, "append")
    return digest(newest_version(read_table(t.spark, path), ["o_orderkey"], "version"))


@query("write_result_counts", """SELECT 'overwrite' AS mode, count(*) AS rows, true AS created FROM orders WHERE o_orderpriority <> '1-URGENT' UNION ALL SELECT 'append', count(*), false FROM orders WHERE o_orderstatus <> 'F'
 UNION ALL SELECT 'insert_only', count(*) FILTER (o_orderkey % 2 = 1), false FROM orders UNION ALL SELECT 'update', count(*) FILTER (o_orderkey % 3 = 0), false FROM orders
 UNION ALL SELECT 'upsert', count(*) FILTER (o_orderkey % 5 = 0), false FROM orders""")
def _(t):
    """Rows are counted while they are written: of repeated keys one, and only what an insert or update touches."""
    path, merged = scratch_path(t.spark, "counts"), scratch_path(t.spark, "merged")
    done = [write_table(old_rows(t), path, "overwrite"), write_table(new_rows(t), path, "append")]
    write_table(t.orders.filter("o_orderkey % 2 = 0"), merged, "overwrite")
    twice = t.orders.unionByName(t.orders)
    done.append(write_table(twice, merged, "insert_only", keys=["o_orderkey"], order=["o_totalprice"]))
    elsewhere = t.orders.filter("o_orderkey % 3 = 0").unionByName(t.orders.withColumn("o_orderkey", -1 - F.col("o_orderkey")))
    done.append(write_table(elsewhere, merged, "update", keys=["o_orderkey"], order=["o_totalprice"]))
    done.append(write_table(twice.filter("o_orderkey % 5 = 0"), merged, "upsert", keys=["o_orderkey"], order=["o_totalprice"]))
    return t.spark.createDataFrame([(d.mode, d.rows, d.created) for d in done], "mode string, rows bigint, created boolean")


@query("write_partitioned", digest_sql("SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice FROM orders"))
def _(t):
    """Rows with a null partition value are kept."""
    path = scratch_path(t.spark, "partitioned")
    write_table(t.orders.withColumn("o_orderstatus", F.expr("nullif(o_orderstatus, 'P')")), path, "overwrite",
                partition_by=["o_orderstatus"], sort_by=["o_orderkey", "no_such_column"])
    return digest(read_table(t.spark, path))


@query("write_formats", "SELECT unnest(['csv', 'json', 'orc', 'parquet']) AS format, n, total FROM (SELECT count(*) AS n, round(sum(s_acctbal), 2) AS total FROM supplier)")
def _(t):
    out = []
    for kind in ("json", "csv", "orc", "parquet"):
        path = scratch_path(t.spark, kind)
        write_many(t.supplier, [SinkSpec("s", "datalake_gen2", write_mode="overwrite", file_path=path, file_format=kind)], {})
        back = read_files(t.spark, path, "jsonl" if kind == "json" else kind, schema=t.supplier.schema)
        out.append(back.agg(F.lit(kind).alias("format"), n(F.count(F.lit(1))).alias("n"), r(F.sum("s_acctbal"), 2).alias("total")))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query("write_new_columns", """SELECT o_orderpriority, count(*) AS n, count(o_totalprice) AS priced FROM (
 SELECT NULL AS o_orderpriority, o_totalprice FROM orders WHERE o_orderpriority <> '1-URGENT' UNION ALL SELECT o_orderpriority, NULL FROM orders) GROUP BY ALL""")
def _(t):
    path = started(t, "evolve")
    write_table(t.orders.select("o_orderkey", "o_orderpriority"), path, "append")
    return read_table(t.spark, path).groupBy("o_orderpriority").agg(n(F.count(F.lit(1))).alias("n"), n(F.count("o_totalprice")).alias("priced"))


@query("write_widened_types", "SELECT count(*) AS n, sum(s_nationkey + 3000000000)::BIGINT + sum(s_nationkey)::BIGINT AS total, 'bigint' AS kind FROM supplier")
def _(t):
    path = scratch_path(t.spark, "widen")
    small = t.supplier.select("s_suppkey", "s_nationkey")
    big = small.withColumn("s_nationkey", F.col("s_nationkey").cast("bigint") + 3000000000)
    write_table(small, path, "overwrite")
    evolve_table(t.spark, path, big.schema)
    write_table(big, path, "append")
    back = read_table(t.spark, path)
    kind = dict(back.dtypes)["s_nationkey"]
    return back.agg(n(F.count(F.lit(1)) / 2).alias("n"), n(F.sum("s_nationkey")).alias("total"), F.lit(kind).alias("kind"))


@query("write_explicit_schema", """SELECT CAST(c_custkey AS INTEGER) AS customer_id, c_name AS full_name, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS balance,
 CAST(NULL AS DATE) AS seen FROM customer""")
def _(t):
    df = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name"), F.col("c_acctbal").alias("balance"))
    shaped = with_schema(df, {"customer_id": "INTEGER", "full_name": "VARCHAR(255)", "balance": "DECIMAL(12,2)", "seen": "DATE"})
    return shaped.withColumn("balance", F.col("balance").cast("double"))


@query("write_serialized", """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS word,
 CASE WHEN event_type IN ('click', 'view') THEN NULL ELSE value END AS number, '{"k":' || user_id || ',"n":null}' AS nested FROM events""")
def _(t):
    t.views("events")
    return serialize_for_sink(t.spark.sql("""
        SELECT event_id, if(event_type = 'error', 'NaN', event_type) AS word,
          CASE event_type WHEN 'click' THEN double('NaN') WHEN 'view' THEN double('Infinity') ELSE value END AS number,
          named_struct('k', user_id, 'n', CAST(NULL AS STRING)) AS nested FROM events"""))


@query("align_columns", """SELECT c_custkey, c_name || '; ' || c_mktsegment AS customer_full_name, c_acctbal FROM customer""")
def _(t):
    df = t.customer.select("c_custkey", F.col("c_name").alias("customer_full_name"), F.col("c_mktsegment").alias("customer_full_name_of_record"),
                           "c_acctbal", F.col("c_nationkey").alias("unrelated"))
    return align_to(df, ["c_custkey", "customer_full_name", "c_acctbal"])


@query("clean_column_names", "SELECT count(*) AS n, 'field_2_order_no' AS first_name, 'order_no' AS second_name, 'order_no_1' AS third_name FROM orders")
def _(t):
    df = clean_names(t.orders.select(F.col("o_orderkey").alias("2. order no"), F.col("o_orderkey").alias("order no!"), F.col("o_orderkey").alias("order__no")))
    names = df.columns
    assert clean_identifier("order no!") == names[1] and match_column("order_no", names) == "order_no"
    return df.agg(n(F.count(names[0])).alias("n")).withColumns(
        {"first_name": F.lit(names[0]), "second_name": F.lit(names[1]), "third_name": F.lit(names[2])})


@query("reprocess_days", digest_sql("SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderdate > DATE '2001-08-01' - 30 THEN 0 ELSE o_totalprice END AS o_totalprice FROM orders"))
def _(t):
    """A rerun rewrites only the days in its window; here they come back with price zero."""
    path = scratch_path(t.spark, "days")
    month = t.orders.withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    write_table(month, path, "overwrite", partition_by=["month"])
    touched = reprocess_window(month, "o_orderdate", "2001-08-01", 30).select("month").distinct()
    rerun = month.join(touched, "month").withColumn("o_totalprice", F.when(
        F.col("o_orderdate").cast("date") > F.date_sub(F.lit("2001-08-01").cast("date"), 30), 0.0).otherwise(F.col("o_totalprice")))
    overwrite_partitions(rerun, path, ["month"])
    return digest(read_table(t.spark, path))


@query("staged_output_sql", "SELECT c_mktsegment, count(*) AS n, 'plan' AS dag FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY ALL")
def _(t):
    stage = Stage(t.spark, scratch_path(t.spark, "stage"))
    stage.put(t.customer, "plan", "customers", RUN)
    stage.put(t.orders, "plan", "orders_raw", RUN, "temp_file")
    joined = stage.query("SELECT c_mktsegment, count(*) AS n FROM customers JOIN orders_raw ON c_custkey = o_custkey GROUP BY c_mktsegment",
                         "plan", ["customers", "orders_raw"])
    return joined.withColumn("dag", F.lit(stage.get("plan", "customers", lineage=True).select(LINEAGE[0]).first()[0]))


@query("staged_retention", "SELECT 2::BIGINT AS kept, count(*) AS n FROM supplier")
def _(t):
    stage = Stage(t.spark, scratch_path(t.spark, "stage"))
    for day in (1, 5, 9):
        stage.put(t.supplier, "plan", "suppliers", datetime(2024, 1, day), created=datetime(2024, 1, day))
    stage.cleanup(datetime(2024, 1, 10), 7)
    return stage.get("plan", "suppliers").agg(F.lit(stage.registry().count()).cast("bigint").alias("kept"), n(F.count(F.lit(1))).alias("n"))


@query("multi_sink", "SELECT count(*) AS n, round(sum(s_acctbal), 2) AS total, 1::BIGINT AS failed FROM supplier")
def _(t):
    """Three sinks, one of them broken: the others still get all rows."""
    a, b = scratch_path(t.spark, "a"), scratch_path(t.spark, "b")
    done = write_many(t.supplier, [
        SinkSpec("a", "file", write_mode="overwrite", file_path=a), SinkSpec("bad", "custom", file_path="x"),
        SinkSpec("b", "datalake_gen2", write_mode="append", file_path=b, file_format="json")], {})
    failed = sum(isinstance(x, str) for x in done.values())
    joined = read_table(t.spark, a).join(t.spark.read.schema(t.supplier.schema).json(b).select("s_suppkey"), "s_suppkey")
    return joined.agg(n(F.count(F.lit(1))).alias("n"), r(F.sum("s_acctbal"), 2).alias("total")).withColumn("failed", F.lit(failed).cast("bigint"))


@query("load_upstream_or_source", "SELECT count(*) AS n FROM orders")
def _(t):
    empty = t.orders.filter("o_orderkey < 0")
    return first_non_empty([empty, t.orders]).agg(n(F.count(F.lit(1))).alias("n"))


@query("read_documents_filtered", """
SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_totalprice FROM orders
WHERE (o_orderstatus = 'F' OR o_orderpriority IN ('1-URGENT', '2-HIGH')) AND o_totalprice >= 100000 AND NOT regexp_matches(o_orderpriority, '^5')""")
def _(t):
    df = t.orders.withColumnRenamed("o_orderkey", "_id")
    found = filter_documents(df, {
        "$or": [{"o_orderstatus": "F"}, {"o_orderpriority": {"$in": ["1-URGENT", "2-HIGH"]}}], "o_totalprice": {"$gte": 100000},
        "o_orderpriority": {"$not": {"$regex": "^5"}}, "no_such_field": {"$exists": False}})
    return found.select("_id", "o_totalprice")


@query("read_wildcard_files", "SELECT count(*) AS n, round(sum(s_acctbal), 2) AS total FROM supplier")
def _(t):
    """`*` crosses folder borders."""
    path = scratch_path(t.spark, "wild")
    write_table(t.supplier, f"{path}/2001/8/data", "overwrite", partition_by=["s_nationkey"])
    back = read_wildcard(t.spark, f"{path}/{{year}}/{{month}}/*.parquet", run=RUN, schema="s_suppkey bigint, s_name string, s_acctbal double")
    return back.agg(n(F.count(F.lit(1))).alias("n"), r(F.sum("s_acctbal"), 2).alias("total"))


@query("read_missing_file", "SELECT count(*) AS n, 0::BIGINT AS missing FROM supplier")
def _(t):
    none = read_source(t.spark, SourceSpec("gone", "file", file_path="/no/such/{ds}.parquet", custom_config={"schema": t.supplier.schema}), {}, RUN)
    return t.supplier.unionByName(none).agg(n(F.count(F.lit(1))).alias("n")).withColumn("missing", F.lit(none.count()).cast("bigint"))


@query("read_whole_texts", "SELECT count(*) AS n, sum(length(html))::BIGINT AS chars FROM pages")
def _(t):
    """Whole files as (content, filename), some pages per file; every page ends with a mark."""
    path = scratch_path(t.spark, "texts")
    t.pages.select(F.concat("html", F.lit("\u0001")).alias("value")).write.option("maxRecordsPerFile", 50).text(path)
    back = read_files(t.spark, path, "text")
    marks = F.length("content") - F.length(F.translate("content", "\u0001", ""))
    return back.agg(n(F.sum(marks)).alias("n"), n(F.sum(F.length("content") - 2 * marks)).alias("chars"))


@query("normalized_values", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS day, o_totalprice AS price, o_orderpriority AS raw,
 [strftime(o_orderdate, '%Y-%m-%d')] AS days FROM orders""")
def _(t):
    df = t.orders.select("o_orderkey", F.col("o_orderdate").alias("day"), F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
                         F.col("o_orderpriority").cast("binary").alias("raw"), F.array(F.col("o_orderdate").cast("date")).alias("days"))
    return normalize_types(df)


@query("unwrapped_answers", "SELECT CAST(o_orderkey AS VARCHAR) AS k, count(*) AS n FROM orders GROUP BY ALL UNION ALL SELECT 'x', count(*) FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    """Answers as a list, as an object around a list, and as one object."""
    payload = F.expr("""CASE o_orderstatus WHEN 'F' THEN concat('[{"k":"', o_orderkey, '"},{"k":"x"}]')
      WHEN 'O' THEN concat('{"total":1,"items":[{"k":"', o_orderkey, '"}]}') ELSE concat('{"k":"', o_orderkey, '"}') END""")
    records = t.orders.select(F.explode(unwrap_payload(payload)).alias("record"))
    return records.groupBy(F.get_json_object("record", "$.k").alias("k")).agg(n(F.count(F.lit(1))).alias("n"))


PLAN = """
dag_id: segment_report
description: customers and orders to a checked segment table
pipeline_type: batch
global_quality_rules:
  - {name: cells, rule_type: completeness, threshold: 0.95}
tasks:
  - {task_id: begin, operator_type: dummy}
  - task_id: customers
    operator_type: extract
    depends_on: [begin]
    source: {name: c, type: file, file_path: customer.parquet, connection_id: given}
  - task_id: orders_in
    operator_type: extract
    depends_on: [begin]
    source: {name: o, type: file, file_path: orders.parquet, connection_id: given}
  - task_id: report
    operator_type: transform
    depends_on: [customers, orders_in]
    sql_transform: |
      SELECT c_mktsegment AS segment, COUNT(o_orderkey) AS orders, ROUND(COALESCE(SUM(o_totalprice), 0), 2) AS total,
             CAST('{{ ds }}' AS DATE) AS processing_date
      FROM customers LEFT JOIN orders_in ON c_custkey = o_custkey GROUP BY c_mktsegment
  - task_id: tidy
    operator_type: transform
    depends_on: [report]
    validation_rules: {missing_values: {segment: drop}, range_validations: {total: {min: 0}}}
  - task_id: check
    operator_type: quality_check
    depends_on: [tidy]
    quality_rules:
      - {name: segment_unique, rule_type: unique, column: segment, severity: critical}
  - task_id: store
    operator_type: load
    depends_on: [tidy]
    sink: {name: out, type: postgresql, table_name: segments, connection_id: shared, write_mode: upsert, upsert_keys: [segment, processing_date]}
"""


@query("run_spec", """SELECT c_mktsegment AS segment, count(o_orderkey) AS orders, round(coalesce(sum(o_totalprice), 0), 2) AS total, DATE '2001-08-01' AS processing_date
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY ALL""")
def _(t):
    """A whole spec: read, transform, clean, check, upsert; run twice with one result."""
    shared = scratch_path(t.spark, "warehouse")
    runner = Runner(t.spark, {"given": {"path": t.folder}, "shared": {"path": shared}}, fail_on_quality=True)
    plan = load_plan(PLAN)
    runner.run(plan, RUN)
    runner.run(plan, RUN)
    return read_table(t.spark, f"{shared}/segments")


@query("write_upsert_buckets", """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS grade FROM orders
UNION ALL SELECT -1 - o_orderkey, o_orderstatus, o_totalprice, NULL FROM orders WHERE o_orderstatus = 'P'""")
def _(t):
    """All orders into buckets; then changed prices of finished ones with a new column, then new keys."""
    path = scratch_path(t.spark, "buckets")
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    changed = t.orders.filter("o_orderstatus = 'F'").select(
        "o_orderkey", "o_orderstatus", (F.col("o_totalprice") + 1).alias("o_totalprice"), F.col("o_orderpriority").alias("grade"))
    added = rows.filter("o_orderstatus = 'P'").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    for part in (rows, changed, added):
        upsert_buckets(part, path, ["o_orderkey"], buckets=32)
    return read_buckets(t.spark, path)
