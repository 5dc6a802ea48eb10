"""Micro-batches into tables: upserts and scored quality rules."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from weftline.operators.quality import Rule, run_rules, unique_values
from weftline.session import scratch_path
from weftline.sinks.buckets import upsert_buckets
from weftline.sinks.tables import write_table


def _run(stream: DataFrame, each, checkpoint: str | None) -> None:
    spark = stream.sparkSession
    job = (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint or scratch_path(spark, "batches"))
           .trigger(availableNow=True).start())
    job.awaitTermination()


def upsert_stream(stream: DataFrame, path: str, keys: list[str], order: list[Column] | None = None,
                  partition_by: list[str] | None = None, checkpoint: str | None = None, buckets: int | None = None) -> None:
    """Upsert every micro-batch. A repeated batch replaces rows by themselves, so the result is exact.

    With `buckets` the table is one in buckets, of which a batch rewrites only those of its keys.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        if buckets is not None:
            upsert_buckets(batch, path, keys, order, buckets)
            return
        write_table(batch, path, "upsert", keys=keys, order=order, partition_by=partition_by)

    _run(stream, each, checkpoint)


def _values_path(path: str) -> str:
    return f"{path.rstrip('/')}-values"


def check_stream(stream: DataFrame, rules: list[Rule], path: str, now: datetime, checkpoint: str | None = None) -> None:
    """Score every micro-batch into `path`; a repeated batch overwrites its own folders.

    Beside it, `<path>-values` keeps the digests of each batch's distinct values for the
    `unique` rules, 16 bytes a value, so that totals are exact.
    """
    counted = [r for r in rules if r.rule_type == "unique"]

    def each(batch: DataFrame, batch_id: int) -> None:
        if counted:
            unique_values(batch, counted).write.mode("overwrite").parquet(f"{_values_path(path)}/batch={batch_id}")
        run_rules(batch, rules, now).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    _run(stream, each, checkpoint)


# --- fixed values: detail fields that add up over batches, per rule type (part, whole) ---
ADDITIVE = {
    "not_null": ("non_null_count", "total_rows"),
    "range": ("valid_count", "total_non_null_rows"),
    "pattern": ("valid_count", "total_non_null_rows"),
    "completeness": ("non_null_cells", "total_cells"),
    "row_count": ("total_rows", "total_rows"),
    "unique": ("unique_count", "total_rows"),
    "custom": ("good", "total"),
}
# --- end of fixed values ---


def total_scores(results: DataFrame, values: DataFrame | None = None) -> DataFrame:
    """Scores over all batches so far, one row per rule: `part`, `whole`, `score`.

    Counts add up; distinct values come from `values` (see `stream_totals`); freshness is
    that of the latest time of all batches at the latest check; a SQL rule has the score of
    its latest run. A rule that could not be evaluated in a batch scores 0. A rule whose
    parts do not add up (an expression or a function, give `good` and `total` instead; or
    `unique` without `values`) keeps its row with no score.
    """
    def field(name: str, kind: str) -> Column:
        return F.get_json_object("details", f"$.{name}").cast(kind)

    part = whole = F.lit(None).cast("double")
    for kind, (good, total) in ADDITIVE.items():
        is_kind = F.col("rule_type") == kind
        part = F.when(is_kind, field(good, "double")).otherwise(part)
        whole = F.when(is_kind, field(total, "double")).otherwise(whole)
    rows = results.select(
        "rule_name", "rule_type", "score", "timestamp", *(["batch"] if "batch" in results.columns else [F.lit(0).alias("batch")]),
        part.alias("part"), whole.alias("whole"), field("error", "string").alias("error"), field("actual_value", "string").alias("asked"),
        field("latest_timestamp", "timestamp").alias("latest"), field("max_age_hours", "double").alias("limit"))
    totals = rows.groupBy("rule_name", "rule_type").agg(
        F.sum("part").alias("part"), F.sum("whole").alias("whole"), F.max("latest").alias("latest"), F.max("limit").alias("limit"),
        F.max("timestamp").alias("at"), F.count("error").alias("errors"), F.count("asked").alias("asked"),
        F.max_by("score", F.struct("timestamp", "batch")).alias("newest"))
    if values is not None:
        seen = values.distinct().groupBy("rule_name").agg(F.count(F.lit(1)).cast("double").alias("distinct"))
        totals = totals.join(seen, "rule_name", "left")
    else:
        totals = totals.withColumn("distinct", F.lit(None).cast("double"))
    is_unique, is_custom = F.col("rule_type") == "unique", F.col("rule_type") == "custom"
    none_found = F.lit(None if values is None else 0.0).cast("double")
    part = F.when(is_unique, F.coalesce("distinct", none_found)).otherwise(F.col("part"))
    age = (F.unix_micros("at") - F.unix_micros("latest")) / F.lit(3.6e9)
    fresh = F.when(F.col("latest").isNull(), 0.0).when(F.col("limit") > 0, F.greatest(F.lit(0.0), 1 - age / F.col("limit"))).otherwise(1.0)
    ratio = F.when(F.col("whole") > 0, F.col("part") / F.col("whole")).when(F.col("whole").isNotNull(), 1.0)
    score = (F.when(F.col("errors") > 0, 0.0).when(F.col("rule_type") == "freshness", fresh)
             .when(is_custom & (F.col("asked") > 0), F.col("newest")).when(F.col("rule_type") == "row_count", (F.col("whole") > 0).cast("double"))
             .otherwise(ratio))
    return totals.withColumn("part", part).withColumn("score", score).select("rule_name", "rule_type", "part", "whole", "score")


def stream_totals(spark: SparkSession, path: str) -> DataFrame:
    """`total_scores` of what `check_stream` wrote to `path`."""
    results = spark.read.parquet(path)
    if results.filter("rule_type = 'unique'").isEmpty():
        return total_scores(results)
    schema = T.StructType().add("rule_name", "string").add("digest", "binary")
    return total_scores(results, spark.read.schema(schema).parquet(_values_path(path)).select("rule_name", "digest"))
