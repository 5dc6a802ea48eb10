"""Run analytics over a table of runs.

Input columns: `dag_id`, `task_id` (optional), `run_id`, `state`, `start_time`,
`end_time`, `duration` (seconds), `records`. Every function takes `now`, so a
result can be repeated. One pipeline may hold any share of the rows: all
functions aggregate before they shuffle, or keep a bounded top per group.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from weftline.functions.columns import quote
from weftline.session import freeze

# --- fixed values ---
DAG_DURATION_BOUNDS = [30, 60, 300, 600, 1800, 3600, 7200, 14400, 28800]
TASK_DURATION_BOUNDS = [1, 5, 10, 30, 60, 300, 600, 1800, 3600]
ACTIVE_STATES = ["running", "queued", "scheduled"]
RECENT_HOURS = 24
HEALTH_MINUTES, HEALTH_FAILURES = 30, 5
THROUGHPUT_MINUTES = 10
OVERDUE_MINUTES = 60
LAST_DURATIONS_DAG, LAST_DURATIONS_TASK = 100, 50
NO_ERROR_TASK = "_no_errors"
# --- end of fixed values ---


def _ago(now: datetime, minutes: int) -> Column:
    return F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL '{minutes}' MINUTE")


def _is(state: str) -> Column:
    return F.col("state") == state


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part * 100.0 / whole).cast("double")


def recent(runs: DataFrame, now: datetime, hours: int = RECENT_HOURS) -> DataFrame:
    return runs.filter(F.col("start_time") >= _ago(now, hours * 60))


def runs_by_state(runs: DataFrame, now: datetime, hours: int = RECENT_HOURS) -> DataFrame:
    return recent(runs, now, hours).groupBy("dag_id", "state").agg(
        F.count(F.lit(1)).alias("runs"), F.max("end_time").alias("last_run"))


def success_rates(runs: DataFrame, keys: tuple[str, ...] = ("dag_id",)) -> DataFrame:
    """Success share of all runs, running ones included, with the last end of each outcome."""
    return runs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_runs"), F.count_if(_is("success")).alias("successful_runs"),
        F.count_if(_is("failed")).alias("failed_runs"),
        F.max(F.when(_is("success"), F.col("end_time"))).alias("last_success"),
        F.max(F.when(_is("failed"), F.col("end_time"))).alias("last_failure"),
    ).withColumn("success_rate", _percent(F.col("successful_runs"), F.col("total_runs")))


def consecutive_failures(runs: DataFrame) -> DataFrame:
    """Failures of each pipeline after its newest run that did not fail; a running one counts as such."""
    place = F.struct("start_time", "run_id")
    kept = runs.select("dag_id", place.alias("_place"), F.coalesce(_is("failed"), F.lit(False)).alias("_failed"))
    newest = kept.groupBy("dag_id").agg(F.max(F.when(~F.col("_failed"), F.col("_place"))).alias("_last"))
    after = F.col("_failed") & (F.col("_last").isNull() | (F.col("_place") > F.col("_last")))
    joined = kept.join(newest.withColumnRenamed("dag_id", "_dag"), F.col("dag_id").eqNullSafe(F.col("_dag")))
    return joined.groupBy("dag_id").agg(F.count_if(after).alias("consecutive_failures"))


def current_streak(events: DataFrame, key: str = "dag_id", time: str = "end_time", tie: str = "run_id") -> DataFrame:
    """Failures since the last success of each pipeline; other states do not count.

    Two passes and a join on one row per pipeline instead of a window over all rows of
    a pipeline. The rows per pipeline are written out once, so Spark knows their size.
    """
    moment = F.struct(F.col(time), F.col(tie))
    stats = freeze(events.groupBy(key).agg(F.max(F.when(_is("success"), moment)).alias("_last"),
                                           F.count_if(_is("failed")).alias("_failed")), "streaks")
    same = F.col(f"e.{quote(key)}").eqNullSafe(F.col(f"s.{quote(key)}"))
    since = (events.filter(_is("failed")).select(key, moment.alias("_at")).alias("e").join(stats.alias("s"), same)
             .filter("e._at > s._last").groupBy(F.col(f"e.{quote(key)}").alias(key)).agg(F.count(F.lit(1)).alias("_since")))
    joined = stats.alias("s").join(since.alias("e"), same, "left")
    streak = F.when(F.col("_last").isNull(), F.col("_failed")).otherwise(F.coalesce("_since", F.lit(0)))
    return joined.select(F.col(f"s.{quote(key)}").alias(key), streak.cast("bigint").alias("failure_streak"))


def running_streak(events: DataFrame, key: str = "dag_id", time: str = "end_time", tie: str = "run_id", chunk: str = "hour") -> DataFrame:
    """The streak after every event: +1 on a failure, 0 on a success.

    A pipeline's rows are cut into time chunks and shuffled once by (pipeline, chunk).
    Each chunk is scanned by itself; one summary row per chunk carries the streak over
    to the next. No task sees more of one pipeline than a chunk, and the result equals
    one scan over everything. Rows without a pipeline or a time have no streak.
    """
    by_row = [time, tie]
    placed = F.col(quote(key)).isNotNull() & F.col(quote(time)).isNotNull()
    apart = events.filter(~placed).withColumn("failure_streak", F.lit(None).cast("bigint"))
    # The same filters on both sides of the join below let Spark reuse one shuffle.
    e = events.filter(placed).withColumn("_chunk", F.date_trunc(chunk, F.col(time))).filter("_chunk IS NOT NULL")
    inside = Window.partitionBy(key, "_chunk").orderBy(*by_row).rowsBetween(Window.unboundedPreceding, 0)
    e = e.withColumn("_resets", F.sum(F.when(_is("success"), 1).otherwise(0)).over(inside))
    segment = Window.partitionBy(key, "_chunk", "_resets").orderBy(*by_row).rowsBetween(Window.unboundedPreceding, 0)
    e = e.withColumn("_local", F.sum(F.when(_is("failed"), 1).otherwise(0)).over(segment))

    # What a chunk hands on: its last local streak, on top of earlier ones if it holds no success.
    chunks = e.groupBy(key, "_chunk").agg(F.max("_resets").alias("_resets"), F.max_by("_local", F.struct(*by_row)).alias("_tail"))
    by_time = Window.partitionBy(key).orderBy("_chunk")
    chunks = chunks.withColumn("_group", F.sum(F.when(F.col("_resets") > 0, 1).otherwise(0)).over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
    handed_on = F.sum("_tail").over(Window.partitionBy(key, "_group").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, 0))
    carry = (chunks.withColumn("_out", handed_on).withColumn("_carry", F.coalesce(F.lag("_out").over(by_time), F.lit(0)))
             .select(key, "_chunk", "_carry"))
    joined = e.join(carry, [key, "_chunk"])
    streak = F.col("_local") + F.when(F.col("_resets") == 0, F.col("_carry")).otherwise(0)
    done = joined.withColumn("failure_streak", streak.cast("bigint")).drop("_chunk", "_resets", "_local", "_carry")
    return done.unionByName(apart)


def task_runs_by_state(runs: DataFrame) -> DataFrame:
    return runs.groupBy("dag_id", "task_id", "state").agg(F.count(F.lit(1)).alias("runs"))


def counts_with_zeros(runs: DataFrame, states: list[str] = ACTIVE_STATES) -> DataFrame:
    """One row per pipeline and state, zeros included, out of one aggregate."""
    counted = runs.groupBy("dag_id").agg(*[F.count_if(_is(s)).alias(f"s{i}") for i, s in enumerate(states)])
    pairs = F.array(*[F.struct(F.lit(s).alias("state"), F.col(f"s{i}").alias("runs")) for i, s in enumerate(states)])
    return counted.select("dag_id", F.explode(pairs).alias("p")).select("dag_id", "p.state", "p.runs")


def failed_tasks(runs: DataFrame, now: datetime, hours: int = RECENT_HOURS) -> DataFrame:
    """Failures per task, and a zero row for every pipeline that ran at all."""
    window = recent(runs, now, hours)
    zero = window.groupBy("dag_id").agg(F.lit(0).cast("bigint").alias("errors")).select(
        "dag_id", F.lit(NO_ERROR_TASK).alias("task_id"), F.lit("none").alias("error_type"), "errors")
    failed = window.filter(_is("failed")).groupBy("dag_id", F.col("task_id").cast("string").alias("task_id")).agg(
        F.count(F.lit(1)).alias("errors")).select("dag_id", "task_id", F.lit("task_failure").alias("error_type"), "errors")
    return zero.unionByName(failed)


def health(runs: DataFrame, now: datetime, minutes: int = HEALTH_MINUTES, failures: int = HEALTH_FAILURES) -> DataFrame:
    bad = F.count_if(_is("failed") & (F.col("end_time") >= _ago(now, minutes)))
    return runs.agg(bad.alias("recent_failures")).withColumn(
        "healthy", F.when(F.col("recent_failures") < failures, 1).otherwise(0))


def throughput(runs: DataFrame, now: datetime, minutes: int = THROUGHPUT_MINUTES) -> DataFrame:
    """Records per second of the latest successful run of each pipeline in the window."""
    seconds = (F.unix_micros(F.col("end_time").cast("timestamp")) - F.unix_micros(F.col("start_time").cast("timestamp"))) / 1e6
    good = runs.filter(_is("success") & (F.col("end_time") >= _ago(now, minutes))).withColumn("_s", seconds).filter("_s > 0")
    latest = F.max_by(F.col("records") / F.col("_s"), F.struct("end_time", "run_id"))
    return good.groupBy("dag_id").agg(latest.cast("double").alias("records_per_second"))


def overdue(runs: DataFrame, now: datetime, minutes: int = OVERDUE_MINUTES) -> DataFrame:
    late = runs.filter((F.col("start_time") <= _ago(now, minutes)) & F.col("state").isin("running", "failed"))
    return late.groupBy("dag_id").agg(F.count(F.lit(1)).alias("violations"))


def mean_of_last(runs: DataFrame, last: int = LAST_DURATIONS_DAG, keys: tuple[str, ...] = ("dag_id",)) -> DataFrame:
    """Mean duration of the latest `last` runs that have one; zero durations do not count."""
    newest = Window.partitionBy(*keys).orderBy(F.desc("end_time"), F.desc("run_id"))
    timed = runs.filter(F.col("duration") != 0).select(*keys, "end_time", "run_id", "duration")
    return (timed.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= last)
            .groupBy(*keys).agg(F.avg("duration").alias("avg_duration")))


def duration_histogram(runs: DataFrame, bounds: list[float], keys: tuple[str, ...] = ("dag_id",), value: str = "duration") -> DataFrame:
    """Cumulative counts per bound; the last row (`le` null) counts everything."""
    v = F.col(quote(value))
    counts = [F.count_if(v <= F.lit(b)).alias(f"b{i}") for i, b in enumerate(bounds)]
    agg = runs.groupBy(*keys).agg(*counts, F.count(v).alias("b_all"), F.sum(v).alias("total"))
    rows = [F.struct(F.lit(float(b)).alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(bounds)]
    rows.append(F.struct(F.lit(None).cast("double").alias("le"), F.col("b_all").alias("n")))
    return agg.select(*keys, F.explode(F.array(*rows)).alias("h")).select(*keys, "h.le", "h.n")


def pair_durations(starts: DataFrame, ends: DataFrame, keys: list[str], start_time: str, end_time: str) -> DataFrame:
    """Seconds between the start and the end of the same run. Run keys are unique on both sides."""
    seconds = (F.unix_micros(F.col(end_time).cast("timestamp")) - F.unix_micros(F.col(start_time).cast("timestamp"))) / 1e6
    return starts.select(*keys, start_time).join(ends.select(*keys, end_time), keys).withColumn("duration", seconds)


def output_ratio(rows_in: int, rows_out: int) -> float | None:
    """Output rows per input row, from counts observed while writing."""
    return rows_out / rows_in if rows_in > 0 else None


def summary(runs: DataFrame, last: int = LAST_DURATIONS_DAG) -> DataFrame:
    """Totals, success rate, streak and mean duration; both sides of each join have one row per pipeline."""
    rates = success_rates(runs).select("dag_id", "total_runs", F.round("success_rate", 2).alias("success_rate"), "last_success", "last_failure")
    mean = mean_of_last(runs, last).select("dag_id", F.round("avg_duration", 2).alias("avg_duration"))
    return rates.join(current_streak(runs), "dag_id", "left").join(mean, "dag_id", "left").withColumn(
        "avg_duration", F.coalesce("avg_duration", F.lit(0.0)))
