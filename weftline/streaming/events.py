"""Streaming twins of rates, ratios, held conditions and paired durations.

Each function takes a streaming DataFrame and returns one; `run_to_table` drives it
until the input is used up. Every stateful step has a watermark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from weftline.session import scratch_path


def read_stream(spark: SparkSession, folder: str, schema: T.StructType | str, file_name: str | None = None,
                files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream; `file_name` narrows it to matching files."""
    reader = spark.readStream.schema(schema)
    if file_name:
        reader = reader.option("pathGlobFilter", file_name)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def with_event_time(stream: DataFrame, time: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """Zoneless times become session-zone timestamps, which a watermark needs."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def windowed(stream: DataFrame, labels: list[str], measures: dict[str, Column], window: str, step: str, time: str = "ts") -> DataFrame:
    """Sliding sums in two stateful steps: rows add up per `step`, then steps add up per window.

    The state holds one small row per label and step, never a copy of an event per window.
    """
    minutes = (stream.select(*labels, F.col(time), *[m.alias(k) for k, m in measures.items()])
               .groupBy(F.window(time, step).alias("_step"), *labels).agg(*[F.sum(k).alias(k) for k in measures]))
    slides = minutes.groupBy(F.window(F.window_time("_step"), window, step).alias("_w"), *labels).agg(*[F.sum(k).alias(k) for k in measures])
    return slides.select(*labels, F.col("_w.end").alias("window_end"), *measures)


def rate(stream: DataFrame, labels: list[str], window_seconds: int = 300, step_seconds: int = 60, time: str = "ts") -> DataFrame:
    counts = windowed(stream, labels, {"n": F.lit(1)}, f"{window_seconds} seconds", f"{step_seconds} seconds", time)
    return counts.withColumn("rate", F.col("n") / F.lit(float(window_seconds)))


def failure_ratio(stream: DataFrame, labels: list[str], failed: Column, window_seconds: int = 300, step_seconds: int = 60, time: str = "ts") -> DataFrame:
    sums = windowed(stream, labels, {"failed": F.when(failed, 1).otherwise(0), "total": F.lit(1)},
                    f"{window_seconds} seconds", f"{step_seconds} seconds", time)
    return sums.withColumn("ratio", F.col("failed") / F.col("total"))


def paired(starts: DataFrame, ends: DataFrame, key: str, start_time: str, end_time: str, longest: str = "1 hour") -> DataFrame:
    """Start and end events of the same run; state older than `longest` is dropped by the watermarks."""
    s = starts.select(F.col(key).alias("_k"), start_time)
    e = ends.select(key, end_time)
    in_time = (F.col(end_time) >= F.col(start_time)) & (F.col(end_time) <= F.col(start_time) + F.expr(f"INTERVAL {longest}"))
    seconds = (F.unix_micros(end_time) - F.unix_micros(start_time)) / 1e6
    return s.join(e, (F.col("_k") == F.col(key)) & in_time).select(key, start_time, end_time, seconds.alias("duration"))


class _InOrder(StatefulProcessor):
    """Rows of a series in the order of their time, whatever the order they come in.

    Rows wait in the state until the watermark has passed their time; one event-time timer a series, at its earliest row, hands them on, and the state is
    read and written once a batch. `follow(memory, s, row)` gives the new memory and a row to put out or None. A series that says
    nothing for `quiet` seconds of event time loses its state.
    """

    def __init__(self, follow: Callable, row: str, memory: str, quiet: int, columns: list[str]):
        self.follow, self.quiet, self.columns, self.remembered = follow, quiet, columns, len(memory.split(", "))
        waiting = ", ".join(f"{name} array<{kind}>" for name, kind in (c.split() for c in row.split(", ")))
        self.schema = f"at bigint, {memory}, s array<bigint>, {waiting}"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("series", self.schema)

    def _read(self):
        at, *rest = self.state.get() if self.state.exists() else (None, *[None] * self.remembered)
        waiting = list(zip(*rest[self.remembered:])) if len(rest) > self.remembered else []
        return at, rest[: self.remembered], waiting

    def _write(self, at, memory, waiting) -> None:
        columns = [list(c) for c in zip(*waiting)] or [[]] * (self.schema.count("array<"))
        self.state.update((at, *memory, *columns))
        self.handle.registerTimer((min(w[0] for w in waiting) if waiting else at + self.quiet) * 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802 - Spark's name
        new = [row for frame in rows for row in zip(*[frame.iloc[:, i].tolist() for i in range(1, frame.shape[1] - 1)])]
        yield from self._advance(key, timerValues.getCurrentWatermarkInMs() // 1000, new)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802 - Spark's name
        yield from self._advance(key, max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()) // 1000, [])

    def _advance(self, key, now: int, new: list) -> Iterator[pd.DataFrame]:
        at, memory, waiting = self._read()
        waiting += new
        due, waiting = sorted(w for w in waiting if w[0] <= now), [w for w in waiting if w[0] > now]
        out = []
        for s, *row in due:
            memory, found = self.follow(memory if at is not None else None, s, row)
            at = s
            if found is not None:
                out.append((key[0], *found))
        if due or new or waiting:
            self._write(at, memory, waiting)
        elif at is None or at + self.quiet <= now:
            self.state.clear()
        if out:
            yield pd.DataFrame(out, columns=self.columns)

    def close(self) -> None:
        pass


def _in_order(rows: DataFrame, follow: Callable, row: str, memory: str, quiet: int, out: str) -> DataFrame:
    """rows has label, s (seconds), the columns of `row`, and last a time with a watermark."""
    columns = [c.split()[0] for c in f"label string, {out}".split(", ")]
    return rows.groupBy("label").transformWithStateInPandas(
        _InOrder(follow, row, memory, quiet, columns), f"label string, {out}", "Append", "eventTime")


def held(windows: DataFrame, label: str, condition: Column, hold: int, step: int) -> DataFrame:
    """Windows in which the condition has been true without a gap for `hold` seconds.

    `windows` has one row per label and window and a watermark on `window_end`; rows may come in any order and as late as it allows. Memory of
    a series: start of the current breach, if any. A row is put out once the watermark has passed its window. A missing
    window ends a breach like a false one.
    """
    rows = windows.select(F.col(label).cast("string").alias("label"), F.unix_seconds("window_end").alias("s"), F.coalesce(condition, F.lit(False)).alias("bad"), "window_end")

    def follow(memory, s, row):
        (bad,) = row
        last, since = memory or (None, None)
        if not bad:
            return (s, None), None
        since = s if since is None or s - last != step else since
        return (s, since), (s, since) if s - since >= hold else None

    out = _in_order(rows, follow, "bad boolean", "last bigint, since bigint", 2 * step + hold, "s bigint, since_s bigint")
    return out.select(F.col("label").alias(label), F.timestamp_seconds("s").alias("window_end"), F.timestamp_seconds("since_s").alias("since"))


STEPS = "label string, step_end timestamp, grown double, first double, last double"


def counter_steps(samples: DataFrame, label: str, value: str, tie: str | None = None, step_seconds: int = 60, time: str = "ts") -> DataFrame:
    """Per series and step what its samples add up to by themselves: the columns of STEPS.

    `samples` has a watermark on `time`. A smaller value than before is a restart from zero. Samples of a step are ordered and added up by Spark.
    """
    v = F.col(value).cast("double")
    order = [F.col(time)] + ([F.col(tie)] if tie else [])
    sample = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], v.alias("v"))
    steps = (samples.where(v.isNotNull()).select(F.col(label).cast("string").alias("label"), F.col(time), sample.alias("x"))
             .groupBy("label", F.window(time, f"{step_seconds} seconds").alias("w")).agg(F.sort_array(F.collect_list("x")).alias("x")))
    grown = F.aggregate(F.slice("x", 2, F.greatest(F.size("x"), F.lit(1))), F.struct(F.lit(0.0).alias("sum"), F.col("x")[0]["v"].alias("last")), lambda m, y: F.struct(
        (m["sum"] + F.when(y["v"] < m["last"], y["v"]).otherwise(y["v"] - m["last"])).alias("sum"), y["v"].alias("last")), lambda m: m["sum"])
    return steps.select("label", F.col("w.end").alias("step_end"), grown.alias("grown"), F.col("x")[0]["v"].alias("first"), F.element_at("x", -1)["v"].alias("last"))


def counter_growth(steps: DataFrame, label: str, quiet: int = 86_400) -> DataFrame:
    """Growth of each step, with that since the step before: label, step_end, grown.

    `steps` is a stream of STEPS with a watermark on `step_end`. Memory of a series: its last value; after `quiet` seconds without a step it begins anew.
    """
    rows = steps.select("label", F.unix_seconds("step_end").alias("s"), "grown", "first", "last", "step_end")

    def follow(memory, s, row):
        inside, first, last = row
        before = memory[0] if memory else None
        across = 0.0 if before is None else first if first < before else first - before
        return (last,), (s, inside + across)

    out = _in_order(rows, follow, "grown double, first double, last double", "value double", quiet, "s bigint, grown double")
    return out.select(F.col("label").alias(label), F.timestamp_seconds("s").alias("step_end"), "grown")


def counter_increase(steps: DataFrame, label: str, window_seconds: int = 300, step_seconds: int = 60) -> DataFrame:
    """Growth per sliding window from rows of `counter_growth` with a watermark on `step_end`: label, window_end, increase."""
    # A step belongs to the windows that hold its last moment; the time itself stays as it is, for it carries the watermark.
    w = F.window("step_end", f"{window_seconds} seconds", f"{step_seconds} seconds")
    sums = steps.groupBy(w.alias("_w"), label).agg(F.sum("grown").alias("increase"))
    return sums.select(label, (F.col("_w.end") - F.expr(f"INTERVAL {step_seconds} SECONDS")).alias("window_end"), "increase")


def with_clock(stream: DataFrame, clock: str, time: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """The stream with a watermark that the rows of a clock folder move on, too, so that windows close when no event comes any more.

    `tick` adds a row to the clock. Its rows never reach a result.
    """
    ticks = stream.sparkSession.readStream.schema(f"`{time}` timestamp").parquet(clock).withColumn("_tick", F.lit(True))
    both = stream.withColumn(time, F.col(time).cast("timestamp")).withColumn("_tick", F.lit(False)).unionByName(ticks, allowMissingColumns=True)
    # No filter may be moved below the watermark, where it would take the ticks out: a random column in between holds all of them up.
    held_up = both.withWatermark(time, delay).withColumn("_any", F.rand())
    return held_up.where(~F.col("_tick") & (F.col("_any") >= 0)).drop("_tick", "_any")


def new_clock(spark: SparkSession, time: str = "ts") -> str:
    path = scratch_path(spark, "clock")
    spark.createDataFrame([], f"`{time}` timestamp").write.parquet(path)
    return path


def tick(spark: SparkSession, clock: str, at: Column, time: str = "ts") -> None:
    spark.range(1).select(at.cast("timestamp").alias(time)).write.mode("append").parquet(clock)


def run_until(stream: DataFrame, label: str, clock: str, at: Column, time: str = "ts") -> str:
    """`run_to_table`, then the clock moves to `at` and what this closes is added to the same folder."""
    spark = stream.sparkSession
    path, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-state")
    run_to_table(stream, label, path=path, checkpoint=checkpoint)
    tick(spark, clock, at, time)
    return run_to_table(stream, label, path=path, checkpoint=checkpoint)


def run_to_table(stream: DataFrame, label: str, mode: str = "append", path: str | None = None, checkpoint: str | None = None) -> str:
    """Process all available input into a Parquet folder and return its path."""
    spark = stream.sparkSession
    path = path or scratch_path(spark, label)
    job = (stream.writeStream.format("parquet").outputMode(mode).option("path", path)
           .option("checkpointLocation", checkpoint or scratch_path(spark, f"{label}-state")).trigger(availableNow=True).start())
    job.awaitTermination()
    return path
