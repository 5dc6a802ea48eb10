"""Alert conditions over the events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from weftline.operators import alerts as A
from weftline.operators.monitoring import TASK_DURATION_BOUNDS, duration_histogram
from weftline.queries.registry import n, query, r

NOW = datetime(2024, 1, 31)


def windows_sql(select: str, labels: str = "event_type", window: int = 300, step: int = 60, source: str = "events") -> str:
    """Plain form: every event copied into each window that holds it."""
    by = f"{labels}, " if labels else ""
    return f"""SELECT {by}{select}, epoch_ms(slot * 1000) AS window_end FROM (
 SELECT *, unnest(range((floor(epoch(ts) / {step})::BIGINT + 1) * {step}, (floor(epoch(ts) / {step})::BIGINT * {step}) + {window} + 1, {step})) AS slot FROM {source})
 GROUP BY {by}slot"""


@query("event_rate", windows_sql("count(*) AS n, round(count(*) / 300.0, 6)::DOUBLE AS rate"))
def _(t):
    return A.rate(t.events, ["event_type"]).select("event_type", n("n").alias("n"), r("rate", 6).alias("rate"), "window_end")


@query("event_increase", windows_sql("count(*) AS increase", "", 600, 300))
def _(t):
    return A.increase(t.events, [], 600, 300).select(n("increase").alias("increase"), "window_end")


SAMPLES = "(SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS c FROM events)"


@query("counter_increase", windows_sql("sum(step)::BIGINT AS increase", "event_type", 900, 300, f"""(
 SELECT *, CASE WHEN before IS NULL THEN 0 WHEN c < before THEN c ELSE c - before END AS step FROM (
  SELECT *, lag(c) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS before FROM {SAMPLES}))"""))
def _(t):
    samples = t.events.withColumn("c", F.get_json_object("props", "$.k").cast("bigint"))
    return A.counter_increase(samples, ["event_type"], "c", 900, 300, tie="event_id").select("event_type", n("increase").alias("increase"), "window_end")


RATIO = windows_sql("count(*) FILTER (event_type = 'error') AS failed, count(*) AS total, round(count(*) FILTER (event_type = 'error') / count(*), 6) AS ratio", "", 3600, 600)


@query("failure_ratio_breaches", f"SELECT * FROM ({RATIO}) WHERE ratio > 0.25")
def _(t):
    x = A.failure_ratio(t.events, [], F.col("event_type") == "error", 3600, 600)
    return A.breaches(x, "ratio", above=0.25).select(n("failed").alias("failed"), n("total").alias("total"), r("ratio", 6).alias("ratio"), "window_end")


# Linear interpolation inside the first bucket that reaches the wanted rank.
BUCKETS = [1, 5, 10, 30, 60, 300, 600, 1800, 3600]


def quantile_sql(source: str, by: str, q: float, digits: int = 5) -> str:
    return f"""SELECT {by}, round(CASE WHEN any_value(hit) IS NULL THEN 3600 ELSE any_value(lo) + (any_value(hit) - any_value(lo)) * (any_value(rank) - any_value(below)) / (any_value(n) - any_value(below)) END, {digits})::DOUBLE AS quantile
FROM (SELECT {by}, rank, min(le) FILTER (c >= rank) AS hit, coalesce(max(le) FILTER (c < rank), 0) AS lo, min(c) FILTER (c >= rank) AS n, coalesce(max(c) FILTER (c < rank), 0) AS below
 FROM (SELECT *, {q} * total AS rank FROM ({source})) GROUP BY {by}, rank) GROUP BY {by}"""


HISTOGRAM = """SELECT {by}, unnest([{bounds}]) AS le, unnest([{counts}]) AS c, count(*) AS total FROM {source} GROUP BY {by}"""


def histogram_sql(source: str, by: str) -> str:
    return HISTOGRAM.format(by=by, source=source, bounds=", ".join(map(str, BUCKETS)), counts=", ".join(f"count(*) FILTER (value <= {b})" for b in BUCKETS))


@query("histogram_quantile", quantile_sql(histogram_sql("events", "event_type"), "event_type", 0.95))
def _(t):
    h = duration_histogram(t.events, TASK_DURATION_BOUNDS, ("event_type",), "value")
    return A.histogram_quantile(h, ["event_type"], 0.95).withColumn("quantile", r("quantile", 5))


COPIES = "(SELECT *, epoch_ms(a * 1000) AS window_end FROM (SELECT *, unnest(range((floor(epoch(ts) / 3600)::BIGINT + 1) * 3600, (floor(epoch(ts) / 3600)::BIGINT * 3600) + 21601, 3600)) AS a FROM events))"


@query("duration_spread_breaches", f"""SELECT window_end, round(a.quantile / b.quantile, 6) AS spread FROM ({quantile_sql(histogram_sql(COPIES, "window_end"), "window_end", 0.95, 12)}) a
 JOIN ({quantile_sql(histogram_sql(COPIES, "window_end"), "window_end", 0.5, 12)}) b USING (window_end) WHERE a.quantile / b.quantile > 5""")
def _(t):
    h = A.sliding_histogram(t.events, [], F.col("value"), TASK_DURATION_BOUNDS, 21600, 3600)
    high, mid = A.histogram_quantile(h, ["window_end"], 0.95), A.histogram_quantile(h, ["window_end"], 0.5).withColumnRenamed("quantile", "mid")
    spread = high.join(mid, "window_end").withColumn("spread", F.col("quantile") / F.col("mid"))
    return A.breaches(spread, "spread", above=5).select("window_end", r("spread", 6).alias("spread"))


@query("rate_drop", f"""SELECT a.event_type, a.window_end, round((a.n / 3600.0) / (b.n / 7200.0), 6)::DOUBLE AS ratio
FROM ({windows_sql('count(*) AS n', 'event_type', 3600, 3600)}) a JOIN ({windows_sql('count(*) AS n', 'event_type', 7200, 3600)}) b
 ON a.event_type = b.event_type AND a.window_end = b.window_end + INTERVAL 1 HOUR WHERE (a.n / 3600.0) / (b.n / 7200.0) < 0.5""")
def _(t):
    x = A.rate_drop(t.events, ["event_type"], 3600, 7200, 3600, 3600)
    return A.breaches(x, "ratio", below=0.5).select("event_type", "window_end", r("ratio", 6).alias("ratio"))


BUSY = windows_sql("count(*) AS n", "event_type", 3600, 600)


@query("sustained_breach", f"""SELECT event_type, window_end, n, since FROM (
 SELECT *, min(window_end) OVER (PARTITION BY event_type, island) AS since FROM (
  SELECT *, sum(CASE WHEN window_end - INTERVAL 10 MINUTE = before THEN 0 ELSE 1 END) OVER (PARTITION BY event_type ORDER BY window_end) AS island FROM (
   SELECT *, lag(window_end) OVER (PARTITION BY event_type ORDER BY window_end) AS before FROM ({BUSY}) WHERE n >= 5))) WHERE window_end - since >= INTERVAL 20 MINUTE""")
def _(t):
    x = A.sliding(t.events, ["event_type"], {"n": F.lit(1)}, 3600, 600)
    return A.held(x, ["event_type"], F.col("n") >= 5, 1200, 600).select("event_type", "window_end", n("n").alias("n"), "since")


@query("stale_series", "SELECT user_id, round((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 1e6, 3) AS age_seconds FROM events GROUP BY user_id HAVING max(ts) < TIMESTAMP '2024-01-31' - INTERVAL 14400 SECOND")
def _(t):
    return A.staleness(t.events, ["user_id"], NOW, 14400).withColumn("age_seconds", r("age_seconds", 3))


OK_RATE = "SELECT user_id, 100.0 * count(*) FILTER (event_type <> 'error') / count(*) AS success_rate FROM events GROUP BY ALL"


def ok_rate(t):
    return t.events.groupBy("user_id").agg((F.count_if(F.col("event_type") != "error") * 100.0 / F.count(F.lit(1))).cast("double").alias("success_rate"))


@query("rate_band", f"SELECT user_id, round(success_rate, 4)::DOUBLE AS success_rate FROM ({OK_RATE}) WHERE success_rate >= 75 AND success_rate < 80")
def _(t):
    return A.breaches(ok_rate(t), "success_rate", at_least=75, below=80).withColumn("success_rate", r("success_rate"))


SHARE = windows_sql("100.0 * count(*) FILTER (event_type <> 'error') / count(*) AS share", "", 7200, 600)


@query("recovered_windows", f"""SELECT a.window_end, round(a.share, 4)::DOUBLE AS share, round(b.share, 4)::DOUBLE AS before FROM ({SHARE}) a JOIN ({SHARE}) b ON a.window_end = b.window_end + INTERVAL 20 MINUTE
 WHERE a.share >= 80 AND b.share < 80""")
def _(t):
    x = A.failure_ratio(t.events, [], F.col("event_type") == "error", 7200, 600)
    x = x.withColumn("share", ((F.col("total") - F.col("failed")) * 100.0 / F.col("total")).cast("double"))
    return A.recovered(x, [], "share", 80, 1200).select("window_end", r("share").alias("share"), r("before").alias("before"))


DAY = "SELECT CAST(ts AS DATE) AS day, user_id, 100.0 * count(*) FILTER (event_type <> 'error') / count(*) AS share FROM events GROUP BY ALL"


@query("many_breaching_groups", f"SELECT day, count(*) AS breaching FROM ({DAY}) WHERE share < 50 GROUP BY day HAVING count(*) >= 3")
def _(t):
    x = t.events.groupBy(F.col("ts").cast("date").alias("day"), "user_id").agg(
        (F.count_if(F.col("event_type") != "error") * 100.0 / F.count(F.lit(1))).cast("double").alias("share"))
    return A.breaching_groups(x, ["day"], "share", 50)


@query("system_success_rate", windows_sql("round(100.0 * count(*) FILTER (event_type <> 'error') / count(*), 4)::DOUBLE AS success_rate", "", 86400, 3600))
def _(t):
    x = A.failure_ratio(t.events, [], F.col("event_type") == "error", 86400, 3600)
    return x.select("window_end", r((F.col("total") - F.col("failed")) * 100.0 / F.col("total")).alias("success_rate"))


@query("quiet_windows", """WITH b AS (SELECT DISTINCT floor(epoch(ts) / 600)::BIGINT * 600 AS m FROM events)
SELECT epoch_ms((m + 600) * 1000) AS window_end FROM (SELECT unnest(range((SELECT min(m) FROM b), (SELECT max(m) FROM b) + 1, 600)) AS m) WHERE m NOT IN (SELECT m FROM b)""")
def _(t):
    return A.quiet_windows(t.events)


@query("sums_by_label", "SELECT event_type, round(sum(value), 2) AS total, round(avg(value), 4) AS mean, max(value) AS top FROM events GROUP BY ALL")
def _(t):
    return t.events.groupBy("event_type").agg(r(F.sum("value"), 2).alias("total"), r(F.avg("value")).alias("mean"), F.max("value").alias("top"))


@query("utilisation", """SELECT user_id, round(used / (used + free), 6) AS utilisation FROM (
 SELECT user_id, count(*) FILTER (event_type = 'view') AS used, count(*) FILTER (event_type = 'click') AS free FROM events GROUP BY ALL) WHERE used + free > 0""")
def _(t):
    x = t.events.groupBy("user_id").agg(F.count_if(F.col("event_type") == "view").alias("used"), F.count_if(F.col("event_type") == "click").alias("free"))
    return A.utilisation(x, "used", "free").filter("utilisation IS NOT NULL").select("user_id", r("utilisation", 6).alias("utilisation"))


NAME_RULES = [
    {"match": "run.duration.*", "name": "run_duration_seconds", "labels": {"user": "$1"}},
    {"match": "run.*.error", "name": "run_failed_total", "labels": {"user": "$1"}},
    {"match": "run.*.*", "name": "run_${2}_total", "labels": {"user": "$1", "kind": "${2}"}},
]


@query("metric_names", """SELECT CASE event_type WHEN 'error' THEN 'run_failed_total' WHEN 'view' THEN 'run_duration_seconds' WHEN 'signup' THEN NULL ELSE 'run_' || event_type || '_total' END AS metric,
 CASE WHEN event_type <> 'signup' THEN user_id::VARCHAR END AS "user", CASE WHEN event_type IN ('click', 'purchase') THEN event_type END AS kind, count(*) AS n FROM events GROUP BY ALL""")
def _(t):
    name = (F.when(F.col("event_type") == "view", F.concat(F.lit("run.duration."), F.col("user_id")))
            .when(F.col("event_type") == "signup", F.lit("other")).otherwise(F.concat(F.lit("run."), F.col("user_id"), F.lit("."), F.col("event_type"))))
    return A.map_metric_names(t.events.select(name.alias("dotted")), "dotted", NAME_RULES).groupBy("metric", "user", "kind").agg(n(F.count(F.lit(1))).alias("n"))
