"""Run analytics. Events stand in for runs: one event is one run of pipeline `user_id`."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from weftline.operators import monitoring as M
from weftline.queries.registry import n, query, r

NOW = datetime(2024, 1, 31)
NOW_SQL = "TIMESTAMP '2024-01-31'"

# `start_time` is exact to the microsecond on both sides: value has two decimals.
RUNS = """(SELECT user_id AS dag_id, event_type AS task_id, event_id AS run_id,
 CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'running' WHEN 'click' THEN 'queued' ELSE 'success' END AS state,
 ts - to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS start_time, ts AS end_time, value AS duration,
 CAST(json_extract(props, '$.k') AS BIGINT) AS records FROM events)"""


def runs(t):
    state = (F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "running")
             .when(F.col("event_type") == "click", "queued").otherwise("success"))
    start = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) - F.round(F.col("value") * 1000000).cast("bigint"))
    return t.events.select(
        F.col("user_id").alias("dag_id"), F.col("event_type").alias("task_id"), F.col("event_id").alias("run_id"), state.alias("state"),
        start.cast("timestamp_ntz").alias("start_time"), F.col("ts").alias("end_time"), F.col("value").alias("duration"),
        F.get_json_object("props", "$.k").cast("bigint").alias("records"))


@query("runs_by_state", f"SELECT dag_id, state, count(*) AS runs, max(end_time) AS last_run FROM {RUNS} WHERE start_time >= {NOW_SQL} - INTERVAL 24 HOUR GROUP BY ALL")
def _(t):
    return M.runs_by_state(runs(t), NOW)


@query("success_rates", f"""SELECT dag_id, count(*) AS total_runs, count(*) FILTER (state = 'success') AS successful_runs, count(*) FILTER (state = 'failed') AS failed_runs,
 max(end_time) FILTER (state = 'success') AS last_success, max(end_time) FILTER (state = 'failed') AS last_failure,
 round(100.0 * count(*) FILTER (state = 'success') / count(*), 4)::DOUBLE AS success_rate FROM {RUNS} GROUP BY ALL""")
def _(t):
    return M.success_rates(runs(t)).withColumn("success_rate", r("success_rate"))


@query("consecutive_failures", f"""SELECT dag_id, coalesce(min(CASE WHEN state <> 'failed' THEN rn END) - 1, count(*)) AS consecutive_failures FROM (
 SELECT *, row_number() OVER (PARTITION BY dag_id ORDER BY start_time DESC, run_id DESC) AS rn FROM {RUNS}) GROUP BY ALL""")
def _(t):
    return M.consecutive_failures(runs(t))


STREAK = f"""SELECT dag_id, run_id, end_time, (sum(CASE WHEN state = 'failed' THEN 1 ELSE 0 END) OVER (PARTITION BY dag_id, grp ORDER BY end_time, run_id))::BIGINT AS failure_streak
 FROM (SELECT *, sum(CASE WHEN state = 'success' THEN 1 ELSE 0 END) OVER (PARTITION BY dag_id ORDER BY end_time, run_id) AS grp FROM {RUNS})"""


@query("current_failure_streak", f"SELECT dag_id, arg_max(failure_streak, (end_time, run_id)) AS failure_streak FROM ({STREAK}) GROUP BY ALL")
def _(t):
    return M.current_streak(runs(t))


@query("running_failure_streak", f"SELECT dag_id, run_id, failure_streak FROM ({STREAK})")
def _(t):
    return M.running_streak(runs(t)).select("dag_id", "run_id", "failure_streak")


@query("task_runs_by_state", f"SELECT dag_id, task_id, state, count(*) AS runs FROM {RUNS} GROUP BY ALL")
def _(t):
    return M.task_runs_by_state(runs(t))


@query("task_success_rates", f"SELECT task_id, count(*) AS total_runs, round(100.0 * count(*) FILTER (state = 'success') / count(*), 4)::DOUBLE AS success_rate FROM {RUNS} GROUP BY ALL")
def _(t):
    return M.success_rates(runs(t), ("task_id",)).select("task_id", "total_runs", r("success_rate").alias("success_rate"))


@query("active_counts_with_zeros", f"""SELECT dag_id, unnest(['running', 'queued', 'scheduled']) AS state,
 unnest([count(*) FILTER (state = 'running'), count(*) FILTER (state = 'queued'), count(*) FILTER (state = 'scheduled')]) AS runs FROM {RUNS} GROUP BY dag_id""")
def _(t):
    return M.counts_with_zeros(runs(t))


@query("failed_tasks_with_zeros", f"""WITH w AS (SELECT * FROM {RUNS} WHERE start_time >= {NOW_SQL} - INTERVAL 24 HOUR)
SELECT dag_id, task_id, 'task_failure' AS error_type, count(*) AS errors FROM w WHERE state = 'failed' GROUP BY ALL
UNION ALL SELECT DISTINCT dag_id, '_no_errors', 'none', 0 FROM w""")
def _(t):
    return M.failed_tasks(runs(t), NOW)


@query("service_health", f"""SELECT count(*) FILTER (state = 'failed' AND end_time >= {NOW_SQL} - INTERVAL 30 MINUTE) AS recent_failures,
 CASE WHEN recent_failures < 5 THEN 1 ELSE 0 END AS healthy FROM {RUNS}""")
def _(t):
    return M.health(runs(t), NOW)


@query("throughput", f"""SELECT dag_id, round(arg_max(records / (epoch_us(end_time) - epoch_us(start_time)) * 1e6, (end_time, run_id)), 6) AS records_per_second
 FROM {RUNS} WHERE state = 'success' AND end_time >= {NOW_SQL} - INTERVAL 1440 MINUTE AND end_time > start_time GROUP BY ALL""")
def _(t):
    return M.throughput(runs(t), NOW, 1440).withColumn("records_per_second", r("records_per_second", 6))


@query("overdue_runs", f"""SELECT dag_id, count(*) AS violations FROM {RUNS} WHERE start_time <= {NOW_SQL} - INTERVAL 60 MINUTE AND state IN ('running', 'failed') GROUP BY ALL""")
def _(t):
    return M.overdue(runs(t), NOW)


@query("mean_of_last_durations", f"""SELECT dag_id, round(avg(duration), 4) AS avg_duration FROM (
 SELECT *, row_number() OVER (PARTITION BY dag_id ORDER BY end_time DESC, run_id DESC) AS rn FROM {RUNS} WHERE duration <> 0) WHERE rn <= 20 GROUP BY ALL""")
def _(t):
    return M.mean_of_last(runs(t), 20).withColumn("avg_duration", r("avg_duration"))


@query("duration_histogram", f"""SELECT task_id, le, n FROM (SELECT task_id,
 unnest([1.0, 5, 10, 30, 60, 300, 600, 1800, 3600, NULL])::DOUBLE AS le,
 unnest([count(*) FILTER (duration <= 1), count(*) FILTER (duration <= 5), count(*) FILTER (duration <= 10), count(*) FILTER (duration <= 30), count(*) FILTER (duration <= 60),
  count(*) FILTER (duration <= 300), count(*) FILTER (duration <= 600), count(*) FILTER (duration <= 1800), count(*) FILTER (duration <= 3600), count(*)]) AS n FROM {RUNS} GROUP BY task_id)""")
def _(t):
    return M.duration_histogram(runs(t), M.TASK_DURATION_BOUNDS, ("task_id",))


@query("paired_durations", f"SELECT run_id, round(duration, 2) AS duration FROM {RUNS}")
def _(t):
    all_runs = runs(t)
    paired = M.pair_durations(all_runs.select("run_id", "start_time"), all_runs.select("run_id", "end_time"), ["run_id"], "start_time", "end_time")
    return paired.select("run_id", r("duration", 2).alias("duration"))


@query("observed_output_ratio", "SELECT count(*) AS rows_in, count(*) FILTER (l_quantity > 25) AS rows_out, round(count(*) FILTER (l_quantity > 25) / count(*), 6) AS ratio FROM lineitem")
def _(t):
    """Input and output of one transform, counted in the pass that writes the output."""
    from pyspark.sql import Observation

    from weftline.session import scratch_path

    before, after = Observation("rows in"), Observation("rows out")
    kept = t.lineitem.observe(before, F.count(F.lit(1)).alias("n")).filter("l_quantity > 25").observe(after, F.count(F.lit(1)).alias("n"))
    kept.write.parquet(scratch_path(t.spark, "ratio"))
    counts = before.get["n"], after.get["n"]
    return t.spark.createDataFrame([(*counts, round(M.output_ratio(*counts), 6))], "rows_in bigint, rows_out bigint, ratio double")


@query("monitoring_summary", f"""WITH m AS (SELECT dag_id, round(avg(duration), 2) AS avg_duration FROM (
  SELECT *, row_number() OVER (PARTITION BY dag_id ORDER BY end_time DESC, run_id DESC) AS rn FROM {RUNS} WHERE duration <> 0) WHERE rn <= 100 GROUP BY ALL),
 s AS (SELECT dag_id, arg_max(failure_streak, (end_time, run_id)) AS failure_streak FROM ({STREAK}) GROUP BY ALL)
SELECT q.dag_id, count(*) AS total_runs, round(100.0 * count(*) FILTER (state = 'success') / count(*), 2)::DOUBLE AS success_rate, any_value(failure_streak) AS failure_streak,
 any_value(avg_duration) AS avg_duration, max(end_time) FILTER (state = 'success') AS last_success, max(end_time) FILTER (state = 'failed') AS last_failure
FROM {RUNS} q JOIN m ON q.dag_id = m.dag_id JOIN s ON q.dag_id = s.dag_id GROUP BY q.dag_id""")
def _(t):
    return M.summary(runs(t))
