"""Table writes: overwrite, append, upsert, update, insert-only; evolution; partitions.

A table is a plain Parquet folder. A rewrite goes to a new folder in the shared
area first and is swapped in with two renames, so a reader never sees half a
table and a lost executor only repeats tasks. When the table is partitioned and
the incoming keys include the partition columns, only the touched partitions are
rewritten, whatever the size of the rest.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from weftline.functions.columns import quote
from weftline.session import scratch_path
from weftline.sinks.shape import align_to, conform, evolve, with_schema


MODES = ("overwrite", "append", "upsert", "update", "insert_only")


@dataclass
class WriteResult:
    target: str
    mode: str
    rows: int
    created: bool = False
    columns: list[str] = field(default_factory=list)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def read_table(spark: SparkSession, path: str, merge_schema: bool = True) -> DataFrame:
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def swap_in(spark: SparkSession, fresh: str, path: str) -> None:
    """Put folder `fresh` in the place of `path`; the old table comes back if that fails."""
    fs, target = _fs(spark, path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    aside = jpath(f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    had_old = fs.exists(target)
    if had_old and not fs.rename(target, aside):
        raise OSError(f"cannot move {path} aside")
    if target.getParent() is not None:
        fs.mkdirs(target.getParent())
    if not fs.rename(jpath(fresh), target):
        if had_old:
            fs.rename(aside, target)
        raise OSError(f"cannot move {fresh} to {path}")
    if had_old:
        fs.delete(aside, True)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row per key: the first in `order`, or an arbitrary but repeatable one.

    Tasks drop all but their own best row per key before the shuffle.
    """
    by = order or [F.xxhash64(*[F.col(quote(c)) for c in df.columns])]
    ranked = Window.partitionBy(*[F.col(quote(k)) for k in keys]).orderBy(*by)
    return df.withColumn("_rn", F.row_number().over(ranked)).filter("_rn = 1").drop("_rn")


def _same_keys(keys: list[str], left: str = "l", right: str = "r") -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{quote(k)}").eqNullSafe(F.col(f"{right}.{quote(k)}")) for k in keys])


def merge_upsert(target: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Incoming rows replace rows with the same keys; the rest of the target stays."""
    fresh = latest_per_key(incoming, keys, order)
    _, schema = evolve(fresh, target.schema)
    kept = target.alias("l").join(fresh.select(*keys).alias("r"), _same_keys(keys), "left_anti")
    return conform(kept, schema).unionByName(conform(fresh, schema))


def merge_update(target: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Rows with the same keys are replaced; incoming rows without a match are ignored."""
    fresh = latest_per_key(incoming, keys, order).withColumn("_hit", F.lit(True))
    joined = target.alias("l").join(fresh.alias("r"), _same_keys(keys), "left")
    return joined.select(*[
        (F.when(F.col("r._hit"), F.col(f"r.{quote(c)}")).otherwise(F.col(f"l.{quote(c)}"))
         if c in fresh.columns else F.col(f"l.{quote(c)}")).cast(target.schema[c].dataType).alias(c) for c in target.columns])


def rows_to_insert(target: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    fresh = latest_per_key(incoming, keys, order)
    return fresh.alias("l").join(target.select(*keys).alias("r"), _same_keys(keys), "left_anti")


def newest_version(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Read view of an append-only table: the newest version of every key."""
    by = [F.col(quote(version)).desc_nulls_last(), F.xxhash64(*[F.col(quote(c)) for c in df.columns])]
    return latest_per_key(df, keys, by)


def usable_sort(df: DataFrame, wanted: list[str] | None) -> list[str]:
    """Requested sort columns the data has; none is fine."""
    return [c for c in wanted or [] if c in df.columns]


def _writer(df: DataFrame, partition_by: list[str] | None, sort_by: list[str] | None):
    partition_by = [c for c in partition_by or [] if c in df.columns]
    sort_by = usable_sort(df, sort_by)
    if partition_by:
        # Few files per partition value; Spark splits a large value over several tasks.
        df = df.hint("rebalance", *[F.col(quote(c)) for c in partition_by])
    if partition_by or sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write
    return writer.partitionBy(*partition_by) if partition_by else writer


def write_table(df: DataFrame, path: str, mode: str = "append", keys: list[str] | None = None, order: list[Column] | None = None,
                partition_by: list[str] | None = None, sort_by: list[str] | None = None,
                table_schema: dict[str, str] | None = None, auto_create: bool = True, align: bool = False) -> WriteResult:
    """Write and return the number of rows written, counted while writing.

    An empty input leaves the target as it is. The input is computed once: rows go to
    a new folder, are counted on the way, and only then take the target's place.
    """
    spark = df.sparkSession
    if mode in MODES[2:] and not keys:
        raise ValueError(f"{mode} needs keys")
    if table_schema:
        df = with_schema(df, table_schema)
    exists = table_exists(spark, path)
    if not exists and not auto_create:
        raise FileNotFoundError(f"{path} does not exist and auto_create is off")
    if mode not in MODES:
        raise ValueError(f"unknown write mode: {mode}")
    if align and exists and mode != "overwrite":
        df = align_to(df, read_table(spark, path).columns)
    counter = Observation()

    def counted(frame: DataFrame) -> DataFrame:
        """What is written, not what came in: repeated keys and rows that are there already do not count."""
        return frame.observe(counter, F.count(F.lit(1)).alias("rows"))

    def rows() -> int:
        return int(counter.get["rows"])

    layout = (partition_by, sort_by)
    if mode == "append" and exists:
        _writer(_fit_for_append(counted(df), read_table(spark, path).schema), *layout).mode("append").parquet(path)
    elif mode == "insert_only" and exists:
        _writer(counted(rows_to_insert(read_table(spark, path), df, keys, order)), *layout).mode("append").parquet(path)
    elif mode == "overwrite" or (not exists and mode != "update"):
        fresh = _stage(counted(df if mode in ("overwrite", "append") else latest_per_key(df, keys, order)), *layout)
        _swap_unless_empty(spark, fresh, path, rows())
    elif exists:
        # The input is used twice below, so it is computed once and read back.
        incoming = latest_per_key(df, keys, order)
        if mode == "update":
            incoming = incoming.alias("l").join(read_table(spark, path).select(*keys).alias("r"), _same_keys(keys), "left_semi")
        incoming_path = _stage(counted(incoming), None, None)
        if rows():
            incoming = spark.read.schema(df.schema).parquet(incoming_path)
            if mode == "update":
                swap_in(spark, _stage(merge_update(read_table(spark, path), incoming, keys), *layout), path)
            else:
                _upsert(incoming, path, keys, *layout)
        _delete(spark, incoming_path)
    else:
        return WriteResult(path, mode, 0, columns=df.columns)
    return WriteResult(path, mode, rows(), created=not exists and rows() > 0, columns=df.columns)


def _stage(df: DataFrame, partition_by, sort_by) -> str:
    """Write to a new folder of the shared area."""
    fresh = scratch_path(df.sparkSession, "staged")
    _writer(df, partition_by, sort_by).parquet(fresh)
    return fresh


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _swap_unless_empty(spark: SparkSession, fresh: str, path: str, rows: int) -> None:
    if rows:
        swap_in(spark, fresh, path)
    else:
        _delete(spark, fresh)


def _fit_for_append(df: DataFrame, target: T.StructType) -> DataFrame:
    """New columns may come with an append, stored types may not change under old files."""
    fitted, schema = evolve(df, target)
    changed = [f.name for f in target.fields if schema[f.name].dataType != f.dataType]
    if changed:
        raise TypeError(f"append would widen {', '.join(changed)}; rewrite the table first (evolve_table)")
    return fitted


def _upsert(incoming: DataFrame, path: str, keys, partition_by, sort_by) -> None:
    """`incoming` has one row per key and is read from files."""
    spark = incoming.sparkSession
    target = read_table(spark, path)
    if not partition_by or not set(partition_by) <= set(keys):
        swap_in(spark, _stage(merge_upsert(target, incoming, keys), partition_by, sort_by), path)
        return
    # Rows with equal keys share a partition, so only partitions of the input change.
    touched = incoming.select(*partition_by).distinct()
    affected = target.alias("l").join(touched.alias("r"), _same_keys(partition_by), "left_semi")
    fresh = _stage(merge_upsert(affected, incoming, keys), partition_by, None)
    merged = spark.read.schema(_stored_schema(spark, fresh, target)).parquet(fresh)
    (_writer(merged, partition_by, sort_by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path))
    _delete(spark, fresh)


def _stored_schema(spark, fresh: str, target: DataFrame) -> T.StructType:
    """Types of the rewritten partitions, with partition columns typed as in the target."""
    known = {f.name: f.dataType for f in target.schema.fields}
    found = spark.read.parquet(fresh).schema
    return T.StructType([T.StructField(f.name, known.get(f.name, f.dataType), True) for f in found.fields])


def evolve_table(spark: SparkSession, path: str, wanted: T.StructType, partition_by: list[str] | None = None) -> T.StructType:
    """Rewrite a table under a schema that also fits `wanted`; all columns nullable, no row lost."""
    table = read_table(spark, path)
    _, schema = evolve(spark.createDataFrame([], wanted), table.schema)
    if [(f.name, f.dataType) for f in schema.fields] != [(f.name, f.dataType) for f in table.schema.fields]:
        swap_in(spark, _stage(conform(table, schema), partition_by, None), path)
    return schema


def reprocess_window(df: DataFrame, date_column: str, run_date: str, lookback_days: int) -> DataFrame:
    """Rows of the run date and the days before it that a rerun may rewrite."""
    day = F.col(quote(date_column)).cast("date")
    return df.filter((day <= F.lit(run_date).cast("date")) & (day > F.date_sub(F.lit(run_date).cast("date"), lookback_days)))


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> WriteResult:
    """Replace exactly the partitions present in the data."""
    counted = Observation()
    (_writer(df.observe(counted, F.count(F.lit(1)).alias("rows")), partition_by, None)
     .mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path))
    return WriteResult(path, "overwrite_partitions", int(counted.get["rows"]), columns=df.columns)
