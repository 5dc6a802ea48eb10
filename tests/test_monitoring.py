"""Run analytics, alert conditions and their streaming twins."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from weftline.operators import alerts as A, monitoring as M
from weftline.operators.quality import Rule, run_rules
from weftline.sinks.tables import read_table
from weftline.streaming import events as S
from weftline.streaming.tables import check_stream, stream_totals, total_scores, upsert_stream

T0 = datetime(2024, 1, 1)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def run_rows(spark, rows):
    """(dag, run, minutes, state) -> run table."""
    return spark.createDataFrame(
        [(d, "t", r, s, at(m), at(m + 1), 60.0, 120) for d, r, m, s in rows],
        "dag_id string, task_id string, run_id int, state string, start_time timestamp_ntz, end_time timestamp_ntz, duration double, records bigint")


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_leading_failures(spark):
    runs = run_rows(spark, [("a", 1, 0, "success"), ("a", 2, 1, "failed"), ("a", 3, 2, "failed")] + [("b", i, i, "failed") for i in range(15)] + [("c", 1, 0, "running")])
    assert as_dict(M.consecutive_failures(runs), "dag_id", "consecutive_failures") == {"a": 2, "b": 15, "c": 0}


def test_streaks_equal_a_plain_scan(spark):
    rng = random.Random(3)
    rows = [(rng.choice("aaab"), i, rng.randint(0, 6000), rng.choice(["failed", "failed", "success", "running"])) for i in range(400)]
    streak, want = {}, {}
    for d, r, m, s in sorted(rows, key=lambda x: (x[2], x[1])):
        streak[d] = 0 if s == "success" else streak.get(d, 0) + (s == "failed")
        want[r] = streak[d]
    runs = run_rows(spark, rows)
    for chunk in ("hour", "day"):
        assert as_dict(M.running_streak(runs, chunk=chunk), "run_id", "failure_streak") == want
    assert as_dict(M.current_streak(runs), "dag_id", "failure_streak") == streak


def test_streak_rows_without_a_key_are_kept(spark):
    runs = run_rows(spark, [("a", 1, 0, "failed"), (None, 2, 0, "failed"), (None, 3, 1, "success")])
    assert as_dict(M.running_streak(runs), "run_id", "failure_streak") == {1: 1, 2: None, 3: None}
    assert as_dict(M.current_streak(runs), "dag_id", "failure_streak") == {"a": 1, None: 0}


def test_zero_rows_and_health(spark):
    runs = run_rows(spark, [("a", 1, 0, "running"), ("b", 2, 0, "success")] + [("b", 3 + i, 50, "failed") for i in range(5)])
    zeros = {(r.dag_id, r.state): r.runs for r in M.counts_with_zeros(runs).collect()}
    assert zeros[("a", "running")] == 1 and zeros[("b", "queued")] == 0 and len(zeros) == 6
    errors = {(r.dag_id, r.task_id): r.errors for r in M.failed_tasks(runs, at(60)).collect()}
    assert errors == {("a", "_no_errors"): 0, ("b", "_no_errors"): 0, ("b", "t"): 5}
    assert M.health(runs, at(60)).first().healthy == 0 and M.health(runs, at(600)).first().healthy == 1
    assert as_dict(M.overdue(runs, at(200)), "dag_id", "violations") == {"a": 1, "b": 5}
    assert as_dict(M.throughput(runs, at(5)), "dag_id", "records_per_second") == {"b": 2.0}


def event_rows(spark, minutes, kind="x"):
    return spark.createDataFrame([(at(m), kind) for m in minutes], "ts timestamp_ntz, kind string")


def test_windows_hold_what_they_should(spark):
    got = as_dict(A.increase(event_rows(spark, [0, 0.5, 3]), [], 120, 60), "window_end", "increase")
    assert got == {at(1): 2, at(2): 2, at(4): 1, at(5): 1}
    with pytest.raises(ValueError):
        A.rate(event_rows(spark, [0]), [], 100, 60)


def test_counter_restarts(spark):
    values = [10, 12, 3, 3, 20, 1]
    df = spark.createDataFrame([(at(i * 0.7), v) for i, v in enumerate(values)], "ts timestamp_ntz, v int").withColumn("l", F.lit("x"))
    total = A.counter_increase(df, ["l"], "v", 6000, 6000).agg(F.max("increase")).first()[0]
    assert total == 2 + 3 + 0 + 17 + 1
    per_minute = A.counter_increase(df, ["l"], "v", 60, 60).agg(F.sum("increase")).first()[0]
    assert per_minute == total


def test_held_needs_an_unbroken_run(spark):
    rows = [(at(m), m not in (3, 9)) for m in (0, 1, 2, 3, 4, 5, 6, 8, 9, 10)]
    df = spark.createDataFrame(rows, "window_end timestamp_ntz, bad boolean").withColumn("l", F.lit("x"))
    assert sorted(r.window_end for r in A.held(df, ["l"], F.col("bad"), 120).collect()) == [at(2), at(6)]
    assert A.held(df, ["l"], F.col("bad"), 0).count() == 8


def test_bucket_quantiles(spark):
    h = spark.createDataFrame([(1.0, 2), (10.0, 6), (None, 8)], "le double, n int").withColumn("l", F.lit("x"))
    q = lambda p: A.histogram_quantile(h, ["l"], p).first().quantile
    assert q(0.125) == 0.5 and q(0.5) == pytest.approx(1 + 9 * 0.5) and q(0.99) == 10.0
    none = spark.createDataFrame([(1.0, 0), (None, 0)], "le double, n int").withColumn("l", F.lit("x"))
    assert A.histogram_quantile(none, ["l"], 0.5).first().quantile is None


def test_recovery_staleness_and_silence(spark):
    df = spark.createDataFrame([(at(0), 98.0), (at(5), 99.5), (at(10), 99.5)], "window_end timestamp_ntz, v double")
    assert [r.window_end for r in A.recovered(df, [], "v", 99, 300).collect()] == [at(5)]
    assert A.staleness(event_rows(spark, [0]), ["kind"], at(2), 100).first().age_seconds == 120.0
    assert A.staleness(event_rows(spark, [0]), ["kind"], at(2), 120).count() == 0
    assert [r.window_end for r in A.quiet_windows(event_rows(spark, [0, 25])).collect()] == [at(20)]


def test_metric_names(spark):
    rules = [{"match": "a.*.done", "name": "a_done", "labels": {"x": "$1"}}, {"match": "a.*", "name": "a_${1}"}]
    df = spark.createDataFrame([("a.b.done",), ("a.c",), ("a.b.c",), ("z",)], "m string")
    got = {r.m: (r.metric, r.x) for r in A.map_metric_names(df, "m", rules).collect()}
    assert got == {"a.b.done": ("a_done", "b"), "a.c": ("a_c", None), "a.b.c": (None, None), "z": (None, None)}


# --- streams: several micro-batches, with late rows ---

def parts(spark, folder, batches, schema):
    """One file per batch, in order of time of writing."""
    import os
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        for f in os.listdir(folder):
            path = f"{folder}/{f}"
            if f.endswith(".parquet") and os.path.getmtime(path) > 1e9:
                os.utime(path, (1000 + i, 1000 + i))


def test_stream_rate_over_several_batches(spark, tmp_path):
    folder = str(tmp_path / "in")
    minutes = [[0, 2], [1, 30], [31], [3, 32], [300]]
    batches = [[(at(m), "x") for m in b] for b in minutes]
    parts(spark, folder, batches, "ts timestamp_ntz, kind string")
    source = S.with_event_time(S.read_stream(spark, folder, "ts timestamp_ntz, kind string", files_per_batch=1), delay="10 minutes")
    path = S.run_to_table(S.rate(source, ["kind"], 300, 60), "rate")
    got = as_dict(spark.read.parquet(path).withColumn("window_end", F.col("window_end").cast("timestamp_ntz")), "window_end", "n")
    # Minute 1 came late but in time. Minute 3 came after the watermark had passed minute 20, so it is dropped.
    kept = event_rows(spark, [0, 1, 2, 30, 31, 32], "x")
    want = as_dict(A.rate(kept, ["kind"], 300, 60), "window_end", "n")
    assert got == want


def test_stream_held_in_any_order(spark, tmp_path):
    """Reordered and late windows give the batch answer, and the newest ones are there once the clock has moved on."""
    rows = [(datetime(2024, 1, 1, 0, m), 1 if m % 11 and m != 25 else 0, label) for m in range(40) for label in ("a", "b") if (m, label) != (33, "b")]
    order = sorted(rows, key=lambda r: (r[0].minute // 20, r[0].minute * 7 % 20, r[2]))
    for k in range(0, len(order), 13):
        spark.createDataFrame(order[k:k + 13], "window_end timestamp_ntz, n int, l string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/w")
    clock = S.new_clock(spark, "window_end")
    stream = S.with_clock(S.read_stream(spark, f"{tmp_path}/w", "window_end timestamp, n int, l string", files_per_batch=1), clock, "window_end", "1 hour")
    path = S.run_until(S.held(stream, "l", F.col("n") > 0, 180, 60), "held", clock, F.lit(datetime(2024, 1, 2)), "window_end")
    found = spark.read.parquet(path).select("l", F.col("window_end").cast("timestamp_ntz"), F.col("since").cast("timestamp_ntz"))
    whole = spark.createDataFrame(rows, "window_end timestamp_ntz, n int, l string")
    want = A.held(whole, ["l"], F.col("n") > 0, 180, 60).select("l", "window_end", "since")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    assert found.where("window_end = timestamp_ntz '2024-01-01 00:39:00'").count() == 2


def test_stream_counter_with_restarts(spark, tmp_path):
    """Growth over batches equals the batch answer; a series that was quiet begins anew."""
    values = {"a": [5, 7, 7, 2, 9, 1, 4], "b": [1, 10, 3, 3, 8, 8, 0]}
    rows = [(datetime(2024, 1, 1, 0, 2 * k, 7 * k), label, v) for label, vs in values.items() for k, v in enumerate(vs)]
    rows += [(datetime(2024, 1, 1, 0, 2, 50), "a", 6), (datetime(2024, 1, 1, 0, 2, 55), "a", 3)]
    for k in range(0, len(rows), 4):
        spark.createDataFrame(sorted(rows)[k:k + 4], "ts timestamp_ntz, l string, v int").coalesce(1).write.mode("append").parquet(f"{tmp_path}/s")
    at = F.lit(datetime(2024, 1, 2))
    clock = S.new_clock(spark)
    samples = S.with_clock(S.read_stream(spark, f"{tmp_path}/s", "ts timestamp_ntz, l string, v int", files_per_batch=1), clock)
    sums = S.run_until(S.counter_steps(samples, "l", "v"), "sums", clock, at)
    for quiet, again in ((86_400, False), (119, True)):
        clock = S.new_clock(spark, "step_end")
        steps = S.with_clock(S.read_stream(spark, sums, S.STEPS), clock, "step_end")
        grown = spark.read.parquet(S.run_until(S.counter_growth(steps, "l", quiet), "grown", clock, at, "step_end"))
        total = {r.l: r.g for r in grown.groupBy("l").agg(F.sum("grown").alias("g")).collect()}
        whole = A.counter_increase(spark.createDataFrame(rows, "ts timestamp_ntz, l string, v int"), ["l"], "v", 60, 60)
        want = {r.l: r.g for r in whole.groupBy("l").agg(F.sum("increase").alias("g")).collect()}
        assert (total == want) if not again else all(total[k] <= want[k] for k in want)


def test_stream_upsert_and_quality(spark, tmp_path):
    folder, table = str(tmp_path / "in"), str(tmp_path / "table")
    parts(spark, folder, [[(1, "a"), (2, "b"), (2, "c")], [(2, "d"), (3, None)]], "k int, v string")
    read = lambda: S.read_stream(spark, folder, "k int, v string", files_per_batch=1)
    for _ in range(2):
        upsert_stream(read(), table, ["k"], order=[F.desc("v")])
    assert sorted((r.k, r.v) for r in read_table(spark, table).collect()) == [(1, "a"), (2, "d"), (3, None)]
    results = str(tmp_path / "results")
    check_stream(read(), [Rule("v", "not_null", "v"), Rule("k", "range", "k", {"max_value": 2})], results, T0)
    assert as_dict(total_scores(spark.read.parquet(results)), "rule_name", "score") == {"v": 0.8, "k": 0.8}


def test_stream_totals_equal_the_batch_score(spark, tmp_path):
    """Every rule type; values that repeat over batches, a batch of nulls, the latest time in an early batch, a broken rule."""
    folder, results = str(tmp_path / "in"), str(tmp_path / "results")
    batches = [[(1, "a", 0.0, at(50)), (2, "b", -0.0, at(1))], [(2, "b", 1.5, at(20)), (None, None, None, None)], [(3, "a", float("nan"), at(30))]]
    kinds = "k int, v string, d double, t timestamp"
    parts(spark, folder, batches, kinds)
    rules = [Rule(x, "unique", x) for x in "kvdt"] + [
        Rule("n", "not_null", "v"), Rule("r", "range", "d", {"min_value": 1}), Rule("p", "pattern", "v", {"pattern": "a"}),
        Rule("c", "completeness"), Rule("f", "freshness", "t", {"max_age_hours": 1}), Rule("rows", "row_count"),
        Rule("sum", "custom", parameters={"good": "sum(k) FILTER (WHERE k > 1)", "total": "sum(k)"}),
        Rule("q", "custom", parameters={"query": "SELECT 5", "max_threshold": 4}),
        Rule("broken", "pattern", "v", {"pattern": "(?P<x>a)"}), Rule("gone", "unique", "gone"),
        Rule("ex", "custom", parameters={"expression": "avg(k)"})]
    for _ in range(2):  # the second run repeats every batch
        check_stream(S.read_stream(spark, folder, kinds, files_per_batch=1), rules, results, at(60))
    whole = as_dict(run_rules(spark.createDataFrame([r for b in batches for r in b], kinds), rules, at(60)), "rule_name", "score")
    got = as_dict(stream_totals(spark, results), "rule_name", "score")
    assert got.pop("ex") is None and whole.pop("ex") is not None
    assert got == pytest.approx(whole) and got["broken"] == 0 and got["gone"] == 0 and 0 < got["f"] < 1
    alone = as_dict(total_scores(spark.read.parquet(results)), "rule_name", "score")
    assert alone["k"] is None and alone["n"] == whole["n"]


def test_stream_pairs(spark, tmp_path):
    starts, ends = str(tmp_path / "s"), str(tmp_path / "e")
    parts(spark, starts, [[("r1", at(0)), ("r2", at(1))], [("r3", at(90))]], "run string, started timestamp")
    parts(spark, ends, [[("r1", at(5))], [("r2", at(200)), ("r3", at(91))]], "run string, ended timestamp")
    s = S.read_stream(spark, starts, "run string, started timestamp", files_per_batch=1).withWatermark("started", "2 hours")
    e = S.read_stream(spark, ends, "run string, ended timestamp", files_per_batch=1).withWatermark("ended", "2 hours")
    path = S.run_to_table(S.paired(s, e, "run", "started", "ended"), "pairs")
    assert as_dict(spark.read.parquet(path), "run", "duration") == {"r1": 300.0, "r3": 60.0}
