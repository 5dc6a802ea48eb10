"""Streaming runs over the event table, compared with the same question asked in batch.

An append-mode window is written once the watermark has passed its end. Behind the last event a clock moves the
watermark on, so the newest windows are written and compared, too.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from weftline.operators.quality import Rule
from weftline.queries.alerting import windows_sql
from weftline.queries.registry import ORACLES, n, query, r
from weftline.session import scratch_path
from weftline.sinks.buckets import read_buckets
from weftline.sinks.tables import read_table
from weftline.streaming import events as S
from weftline.streaming.tables import check_stream, stream_totals, upsert_stream


def events(t):
    """The event stream and its clock."""
    clock = S.new_clock(t.spark)
    return S.with_clock(S.read_stream(t.spark, t.folder, t.events.schema, "events.parquet"), clock), clock


def later(t):
    """A time by which every window of the events has ended."""
    return F.lit(t.events.agg(F.max("ts") + F.expr("INTERVAL 2 DAYS")).first()[0])


def finished(t, rows, label, clock, time="ts"):
    """All rows of the stream, with zoneless times."""
    found = t.spark.read.parquet(S.run_until(rows, label, clock, later(t), time))
    return found.withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


@query("stream_rate", windows_sql("count(*) AS n, round(count(*) / 300.0, 6)::DOUBLE AS rate"))
def _(t):
    rows, clock = events(t)
    return finished(t, S.rate(rows, ["event_type"]), "stream-rate", clock).select("event_type", n("n").alias("n"), r("rate", 6).alias("rate"), "window_end")


@query("stream_failure_ratio", f"""SELECT * FROM ({windows_sql("count(*) FILTER (event_type = 'error') AS failed, count(*) AS total, round(count(*) FILTER (event_type = 'error') / count(*), 6) AS ratio", '', 3600, 600)})
WHERE ratio > 0.25""")
def _(t):
    rows, clock = events(t)
    ratios = S.failure_ratio(rows, [], F.col("event_type") == "error", 3600, 600)
    return finished(t, ratios.filter("ratio > 0.25"), "stream-ratio", clock).select(n("failed").alias("failed"), n("total").alias("total"), r("ratio", 6).alias("ratio"), "window_end")


@query("stream_sustained_breach", f"""SELECT event_type, window_end, since FROM (
 SELECT *, min(window_end) OVER (PARTITION BY event_type, island) AS since FROM (
  SELECT *, sum(CASE WHEN window_end - INTERVAL 10 MINUTE = before THEN 0 ELSE 1 END) OVER (PARTITION BY event_type ORDER BY window_end) AS island FROM (
   SELECT *, lag(window_end) OVER (PARTITION BY event_type ORDER BY window_end) AS before FROM ({windows_sql('count(*) AS n', 'event_type', 3600, 600)}) WHERE n >= 5)))
 WHERE window_end - since >= INTERVAL 20 MINUTE""")
def _(t):
    """Window counts are one stream; a second one follows each series with state."""
    rows, clock = events(t)
    windows = S.run_until(S.windowed(rows, ["event_type"], {"n": F.lit(1)}, "1 hour", "10 minutes"), "stream-windows", clock, later(t))
    clock = S.new_clock(t.spark, "window_end")
    counts = S.with_clock(S.read_stream(t.spark, windows, "event_type string, window_end timestamp, n bigint"), clock, "window_end")
    fired = S.held(counts, "event_type", F.col("n") >= 5, 1200, 600)
    return finished(t, fired, "stream-held", clock, "window_end").select("event_type", "window_end", F.col("since").cast("timestamp_ntz").alias("since"))


@query("stream_counter_increase", ORACLES["counter_increase"])
def _(t):
    """Sums per step, growth from step to step with a memory for each series, and windows are one stream each."""
    rows, clock = events(t)
    samples = rows.withColumn("c", F.get_json_object("props", "$.k").cast("bigint"))
    sums = S.run_until(S.counter_steps(samples, "event_type", "c", "event_id", 300), "stream-steps", clock, later(t))
    clock = S.new_clock(t.spark, "step_end")
    steps = S.with_clock(S.read_stream(t.spark, sums, S.STEPS), clock, "step_end")
    grown = S.run_until(S.counter_growth(steps, "event_type", quiet=400 * 86_400), "stream-growth", clock, later(t), "step_end")
    clock = S.new_clock(t.spark, "step_end")
    steps = S.with_clock(S.read_stream(t.spark, grown, "event_type string, step_end timestamp, grown double"), clock, "step_end")
    found = finished(t, S.counter_increase(steps, "event_type", 900, 300), "stream-increase", clock, "step_end")
    return found.select("event_type", n("increase").alias("increase"), "window_end")


@query("stream_paired_durations", "SELECT event_id, round(value, 2) AS duration FROM events")
def _(t):
    start = F.timestamp_micros(F.unix_micros("ts") - F.round(F.col("value") * 1000000).cast("bigint"))
    raw = S.read_stream(t.spark, t.folder, t.events.schema, "events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    starts = raw.select("event_id", start.alias("started")).withWatermark("started", "1 hour")
    ends = S.read_stream(t.spark, t.folder, t.events.schema, "events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ended")).withWatermark("ended", "1 hour")
    path = S.run_to_table(S.paired(starts, ends, "event_id", "started", "ended"), "stream-paired")
    return t.spark.read.parquet(path).select("event_id", r("duration", 2).alias("duration"))


@query("stream_quality", """SELECT rule_name, rule_type, round(s, 6) AS score FROM (
 SELECT 'user' AS rule_name, 'not_null' AS rule_type, count(user_id) / count(*) AS s FROM events
 UNION ALL SELECT 'value', 'range', count(*) FILTER (value BETWEEN 1 AND 20) / count(value) FROM events
 UNION ALL SELECT 'kind', 'pattern', count(*) FILTER (regexp_matches(event_type, '^(?:[ce])')) / count(*) FROM events
 UNION ALL SELECT 'cells', 'completeness', CASE WHEN count(*) > 0 THEN 1.0 END FROM events
 UNION ALL SELECT 'rows', 'row_count', CASE WHEN count(*) > 0 THEN 1.0 END FROM events
 UNION ALL SELECT 'users', 'unique', count(DISTINCT user_id) / count(*) FROM events
 UNION ALL SELECT 'new', 'freshness', greatest(0, 1 - (epoch_us(TIMESTAMP '2024-03-31') - epoch_us(max(ts))) / 3.6e9 / 8760) FROM events
 UNION ALL SELECT 'large', 'custom', sum(value) FILTER (value > 5) / sum(value) FROM events)""")
def _(t):
    path = scratch_path(t.spark, "stream-quality")
    rules = [Rule("user", "not_null", "user_id"), Rule("value", "range", "value", {"min_value": 1, "max_value": 20}),
             Rule("kind", "pattern", "event_type", {"pattern": "[ce]"}), Rule("cells", "completeness"), Rule("rows", "row_count"),
             Rule("users", "unique", "user_id"), Rule("new", "freshness", "ts", {"max_age_hours": 8760}),
             Rule("large", "custom", parameters={"good": "sum(value) FILTER (WHERE value > 5)", "total": "sum(value)"})]
    check_stream(S.read_stream(t.spark, t.folder, t.events.schema, "events.parquet"), rules, path, datetime(2024, 3, 31))
    return stream_totals(t.spark, path).select("rule_name", "rule_type", r("score", 6).alias("score"))


@query("stream_upsert", """SELECT user_id, event_id, event_type, value FROM (
 SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def _(t):
    """Latest event of every user."""
    path = scratch_path(t.spark, "stream-upsert")
    upsert_stream(S.read_stream(t.spark, t.folder, t.events.schema, "events.parquet"), path, ["user_id"],
                  order=[F.col("ts").desc(), F.col("event_id").desc()])
    return read_table(t.spark, path).select("user_id", "event_id", "event_type", "value")


@query("stream_upsert_buckets", ORACLES["stream_upsert"])
def _(t):
    """The same into a table in buckets."""
    path = scratch_path(t.spark, "stream-buckets")
    upsert_stream(S.read_stream(t.spark, t.folder, t.events.schema, "events.parquet"), path, ["user_id"],
                  order=[F.col("ts").desc(), F.col("event_id").desc()], buckets=16)
    return read_buckets(t.spark, path).select("user_id", "event_id", "event_type", "value")
