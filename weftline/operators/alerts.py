"""Alert conditions over event tables: rates, ratios, quantiles, sustained breaches.

A range vector (`rate(x[5m])` each minute) is built in two steps: rows are first
added up per minute and label, and only these sums are copied into the windows
they belong to. The copies grow with minutes, not with events.

Windows carry their end as `window_end`: a window holds the rows with
`window_end - range <= ts < window_end`.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from weftline.functions.columns import quote


def _seconds(c: Column | str) -> Column:
    return F.unix_seconds((F.col(c) if isinstance(c, str) else c).cast("timestamp"))


def _floor(c: Column, step: int) -> Column:
    """Start of the step a time falls into, as epoch seconds."""
    return (F.floor(_seconds(c) / step) * step).cast("bigint")


def _time(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def sliding(events: DataFrame, labels: list[str], measures: dict[str, Column], window: int = 300, step: int = 60, time: str = "ts") -> DataFrame:
    """Sums of `measures` (numbers per row) in every window of `window` seconds, one per `step`."""
    if window % step:
        raise ValueError("window must be a multiple of step")
    minutes = (events.select(*[F.col(quote(x)) for x in labels], _floor(F.col(time), step).alias("_m"),
                             *[m.alias(k) for k, m in measures.items()])
               .groupBy(*labels, "_m").agg(*[F.sum(k).alias(k) for k in measures]))
    ends = F.sequence(F.col("_m") + step, F.col("_m") + window, F.lit(step).cast("bigint"))
    return (minutes.withColumn("_at", F.explode(ends)).groupBy(*labels, "_at")
            .agg(*[F.sum(k).alias(k) for k in measures]).withColumn("window_end", _time(F.col("_at"))).drop("_at"))


def rate(events: DataFrame, labels: list[str], window: int = 300, step: int = 60, time: str = "ts") -> DataFrame:
    """Events per second."""
    return (sliding(events, labels, {"n": F.lit(1)}, window, step, time)
            .withColumn("rate", F.col("n") / F.lit(float(window))))


def increase(events: DataFrame, labels: list[str], window: int = 300, step: int = 60, time: str = "ts") -> DataFrame:
    return sliding(events, labels, {"increase": F.lit(1)}, window, step, time)


def counter_increase(samples: DataFrame, labels: list[str], value: str, window: int = 300, step: int = 60,
                     time: str = "ts", tie: str | None = None) -> DataFrame:
    """Growth of a counter per window; a smaller value than before is a restart from zero.

    Steps between neighbouring samples are taken inside each minute; the step across
    two minutes needs only the first and last value of a minute. So one series may be
    as long as it likes. A step counts for the minute of its later sample.
    """
    order = [F.col(time)] + ([F.col(tie)] if tie else [])
    v = F.col(quote(value))

    def grown(new: Column, old: Column) -> Column:
        return F.when(old.isNull(), 0).when(new < old, new).otherwise(new - old)

    s = samples.select(*labels, time, *([tie] if tie else []), value, _floor(F.col(time), step).alias("_m"))
    inside = Window.partitionBy(*labels, "_m").orderBy(*order)
    s = s.withColumn("_step", grown(v, F.lag(v).over(inside)))
    at = F.struct(*order)
    minutes = s.groupBy(*labels, "_m").agg(F.sum("_step").alias("_grown"), F.min_by(v, at).alias("_first"), F.max_by(v, at).alias("_last"))
    across = Window.partitionBy(*labels).orderBy("_m")
    minutes = minutes.withColumn("_grown", F.col("_grown") + grown(F.col("_first"), F.lag("_last").over(across)))
    ends = F.sequence(F.col("_m") + step, F.col("_m") + window, F.lit(step).cast("bigint"))
    return (minutes.withColumn("_at", F.explode(ends)).groupBy(*labels, "_at").agg(F.sum("_grown").alias("increase"))
            .withColumn("window_end", _time(F.col("_at"))).drop("_at"))


def failure_ratio(events: DataFrame, labels: list[str], failed: Column, window: int = 300, step: int = 60, time: str = "ts") -> DataFrame:
    sums = sliding(events, labels, {"failed": F.when(failed, 1).otherwise(0), "total": F.lit(1)}, window, step, time)
    return sums.withColumn("ratio", F.col("failed") / F.col("total"))


def breaches(df: DataFrame, value: str, above: float | None = None, below: float | None = None, at_least: float | None = None) -> DataFrame:
    """Rows on the alerting side of a limit, or inside a band (`at_least <= value < below`)."""
    c = F.col(quote(value))
    tests = [c > F.lit(above)] if above is not None else []
    tests += [c < F.lit(below)] if below is not None else []
    tests += [c >= F.lit(at_least)] if at_least is not None else []
    return df.filter(reduce(lambda a, b: a & b, tests))


def histogram_quantile(histogram: DataFrame, labels: list[str], q: float, bound: str = "le", count: str = "n") -> DataFrame:
    """Quantile estimate from cumulative buckets, linear inside a bucket.

    The bucket without a bound answers with the highest bound. Buckets per group are
    few and fixed, so a group is one short array.
    """
    le, n = F.col(quote(bound)), F.col(quote(count))
    grouped = histogram.groupBy(*labels).agg(
        F.array_sort(F.collect_list(F.when(le.isNotNull(), F.struct(le.alias("le"), n.cast("double").alias("n"))))).alias("_b"),
        F.max(n).cast("double").alias("_total"))
    rank = F.lit(q) * F.col("_total")
    hit = F.get(F.filter("_b", lambda b: b["n"] >= rank), 0)
    before = F.filter("_b", lambda b: b["n"] < rank)
    prior = F.when(F.size(before) > 0, F.element_at(before, -1))
    low = F.coalesce(prior["le"], F.least(F.lit(0.0), F.get("_b", 0)["le"]))
    below = F.coalesce(prior["n"], F.lit(0.0))
    inside = low + (hit["le"] - low) * F.when(hit["n"] > below, (rank - below) / (hit["n"] - below)).otherwise(F.lit(0.0))
    highest = F.try_element_at("_b", F.lit(-1))["le"]
    value = F.when(F.col("_total") > 0, F.when(hit.isNull(), highest).otherwise(inside))
    return grouped.select(*labels, value.alias("quantile"))


def sliding_histogram(events: DataFrame, labels: list[str], value: Column, bounds: list[float], window: int = 600, step: int = 60, time: str = "ts") -> DataFrame:
    """Cumulative bucket counts per window, long form (`window_end`, `le`, `n`)."""
    measures = {f"b{i}": F.when(value <= F.lit(b), 1).otherwise(0) for i, b in enumerate(bounds)}
    sums = sliding(events, labels, {**measures, "b_all": F.lit(1)}, window, step, time)
    rows = [F.struct(F.lit(float(b)).alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(bounds)]
    rows.append(F.struct(F.lit(None).cast("double").alias("le"), F.col("b_all").alias("n")))
    return sums.select(*labels, "window_end", F.explode(F.array(*rows)).alias("h")).select(*labels, "window_end", "h.le", "h.n")


def _by_labels(labels: list[str]) -> Window:
    """Windows per series. Rows here are windows, whose number depends on time only."""
    return Window.partitionBy(*[F.col(quote(x)) for x in labels]) if labels else Window.partitionBy(F.lit(0))


def offset_value(df: DataFrame, labels: list[str], value: str, seconds: int) -> Column:
    """The series' value exactly `seconds` earlier, null where there is none."""
    w = _by_labels(labels).orderBy(_seconds("window_end")).rangeBetween(-seconds, -seconds)
    return F.max(F.col(quote(value))).over(w)


def rate_drop(events: DataFrame, labels: list[str], window: int = 300, base: int = 1800, offset: int = 3600, step: int = 60, time: str = "ts") -> DataFrame:
    """Rate now over the rate of a longer window some time ago."""
    now = rate(events, labels, window, step, time).select(*labels, "window_end", F.col("rate").alias("rate_now"))
    then = rate(events, labels, base, step, time).select(
        *labels, (F.col("window_end") + F.make_dt_interval(secs=F.lit(offset))).alias("window_end"), F.col("rate").alias("rate_before"))
    return now.join(then, [*labels, "window_end"]).withColumn("ratio", F.col("rate_now") / F.col("rate_before"))


def held(df: DataFrame, labels: list[str], condition: Column, hold: int, step: int = 60) -> DataFrame:
    """Rows where the condition has been true without a gap for at least `hold` seconds.

    A missing window ends a breach like a false one.
    """
    w = _by_labels(labels).orderBy("window_end")
    previous, was = F.lag(F.col("_s")).over(w), F.lag(F.col("_true")).over(w)
    starts = F.col("_true") & (F.coalesce(~was, F.lit(True)) | (F.col("_s") - previous != step))
    marked = (df.withColumn("_true", F.coalesce(condition, F.lit(False))).withColumn("_s", _seconds("window_end"))
              .withColumn("_start", F.when(starts, F.col("_s"))))
    since = F.max("_start").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return (marked.withColumn("_since", since).filter(F.col("_true") & (F.col("_s") - F.col("_since") >= hold))
            .withColumn("since", _time(F.col("_since"))).drop("_true", "_s", "_start", "_since"))


def staleness(events: DataFrame, labels: list[str], now: datetime, limit: float, time: str = "ts") -> DataFrame:
    """Series whose last event is more than `limit` seconds old."""
    age = (F.unix_micros(F.lit(now).cast("timestamp_ntz").cast("timestamp")) - F.unix_micros(F.max(F.col(time)).cast("timestamp"))) / 1e6
    return events.groupBy(*labels).agg(age.alias("age_seconds")).filter(F.col("age_seconds") > limit)


def recovered(df: DataFrame, labels: list[str], value: str, at_least: float, offset: int = 300) -> DataFrame:
    """Good now, bad `offset` seconds ago."""
    return (df.withColumn("before", offset_value(df, labels, value, offset))
            .filter((F.col(quote(value)) >= at_least) & (F.col("before") < at_least)))


def breaching_groups(df: DataFrame, by: list[str], value: str, below: float, at_least: int = 3) -> DataFrame:
    """How many series breach at once, where that is at least `at_least`."""
    return (breaches(df, value, below=below).groupBy(*by).agg(F.count(F.lit(1)).alias("breaching"))
            .filter(F.col("breaching") >= at_least))


def quiet_windows(events: DataFrame, window: int = 600, step: int = 600, time: str = "ts") -> DataFrame:
    """Windows between the first and the last event in which nothing happened."""
    busy = events.select(_floor(F.col(time), step).alias("_m")).distinct()
    span = events.agg(_floor(F.min(time), step).alias("lo"), _floor(F.max(time), step).alias("hi"))
    spine = span.select(F.explode(F.sequence("lo", "hi", F.lit(step).cast("bigint"))).alias("_m"))
    if window == step:
        quiet = spine.join(busy, "_m", "left_anti").select((F.col("_m") + step).alias("_at"))
    else:
        covered = busy.select(F.explode(F.sequence(F.col("_m") + step, F.col("_m") + window, F.lit(step).cast("bigint"))).alias("_at"))
        quiet = spine.select((F.col("_m") + step).alias("_at")).join(covered, "_at", "left_anti")
    return quiet.select(_time(F.col("_at")).alias("window_end"))


def utilisation(df: DataFrame, used: str, free: str) -> DataFrame:
    u, f = F.col(quote(used)), F.col(quote(free))
    return df.withColumn("utilisation", F.when(u + f != 0, u / (u + f)))


def map_metric_names(df: DataFrame, column: str, rules: list[dict]) -> DataFrame:
    """Dotted names to a metric name and labels; the first rule that matches wins.

    A rule is `{"match": "a.*.b", "name": "a_b", "labels": {"x": "$1"}}`. `*` stands
    for one part of the name; `$1` or `${1}` puts it back.
    """
    c = F.col(quote(column))

    def pattern(rule):
        parts = ["([^.]*)" if p == "*" else p.replace("*", "([^.]*)") for p in rule["match"].split(".")]
        return "^" + r"\.".join(parts) + "$"

    def fill(template, rule):
        pieces, text = [], template.replace("{", "").replace("}", "")
        while "$" in text:
            head, _, text = text.partition("$")
            digits = ""
            while text[:1].isdigit():
                digits, text = digits + text[0], text[1:]
            pieces += [F.lit(head), F.regexp_extract(c, pattern(rule), int(digits))]
        return F.concat(*pieces, F.lit(text))

    def first(make):
        out = F.lit(None).cast("string")
        for rule in reversed(rules):
            value = make(rule)
            out = F.when(c.rlike(pattern(rule)), value if value is not None else F.lit(None)).otherwise(out)
        return out

    names = sorted({x for rule in rules for x in rule.get("labels", {})})
    return df.withColumns({"metric": first(lambda r: fill(r["name"], r)), **{
        x: first(lambda r, x=x: fill(r["labels"][x], r) if x in r.get("labels", {}) else None) for x in names}})
