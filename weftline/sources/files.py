"""File and lake reads: path templates, wildcards, formats, missing files."""

from __future__ import annotations

import fnmatch
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# --- fixed values ---
FORMATS_BY_SUFFIX = {".json": "json", ".jsonl": "jsonl", ".csv": "csv", ".parquet": "parquet", ".txt": "text"}
TEXT_SCHEMA = "content string, filename string"
# --- end of fixed values ---


def expand_path(template: str, run: datetime) -> str:
    """`{year} {month} {day} {hour}` (no leading zeros), `{ds}` and `{ts}` of the run."""
    values = {"year": run.year, "month": run.month, "day": run.day, "hour": run.hour,
              "ds": run.strftime("%Y-%m-%d"), "ts": run.isoformat()}
    for key, value in values.items():
        template = template.replace("{" + key + "}", str(value))
    return template


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if a file or a glob match exists."""
    fs, p = _file_system(spark, path)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def guess_format(path: str) -> str:
    lowered = path.lower()
    return next((kind for suffix, kind in FORMATS_BY_SUFFIX.items() if lowered.endswith(suffix)), "binary")


def empty(spark: SparkSession, schema: str | T.StructType | None) -> DataFrame:
    return spark.createDataFrame([], schema if schema is not None else T.StructType([]))


def read_files(spark: SparkSession, path: str, file_format: str | None = None, schema: str | T.StructType | None = None,
               run: datetime | None = None, options: dict | None = None) -> DataFrame:
    """Read one path or glob. A missing path gives an empty table, not an error.

    Give a schema wherever the files are large: without one, json and csv are read
    twice, once to look for types.
    """
    if run is not None:
        path = expand_path(path, run)
    kind = (file_format or guess_format(path)).lower()
    if not path_exists(spark, path):
        return empty(spark, schema if schema is not None else (TEXT_SCHEMA if kind in ("text", "txt") else None))
    reader = spark.read.options(**(options or {}))
    if kind in ("text", "txt"):
        return reader.text(path, wholetext=True).select(
            F.col("value").alias("content"), F.col("_metadata.file_path").alias("filename"))
    if kind == "binary":
        return reader.format("binaryFile").load(path).select(F.col("content"), F.col("path").alias("filename"))
    return _reader(spark, kind, schema).options(**(options or {})).load(path)


def _reader(spark: SparkSession, kind: str, schema: str | T.StructType | None):
    options = {"json": {"multiLine": "true"}, "csv": {"header": "true", "inferSchema": str(schema is None).lower()}}.get(kind, {})
    formats = {"json": "json", "jsonl": "json", "csv": "csv", "parquet": "parquet", "orc": "orc"}
    if kind not in formats:
        raise ValueError(f"unknown file format: {kind}")
    reader = spark.read.format(formats[kind]).options(**options)
    return reader if schema is None else reader.schema(schema)


def read_wildcard(spark: SparkSession, pattern: str, file_format: str | None = None,
                  schema: str | T.StructType | None = None, run: datetime | None = None) -> DataFrame:
    """Every file below the fixed start of the pattern whose whole path matches it.

    Unlike a path glob, `*` here also crosses folder borders. With a schema, Spark lists
    the folder in parallel and drops files by their path before any is opened. Without
    one, the matching files are listed first, so that no other file shapes the result.
    """
    if run is not None:
        pattern = expand_path(pattern, run)
    marks = [pattern.index(m) for m in "*?[" if m in pattern]
    if not marks:
        return read_files(spark, pattern, file_format, schema)
    root = pattern[: min(marks)].rsplit("/", 1)[0]
    kind = (file_format or guess_format(pattern)).lower()
    if not path_exists(spark, root):
        return empty(spark, schema)
    if schema is None:
        matched = _matching_files(spark, root, pattern)
        return _reader(spark, kind, schema).load(matched) if matched else empty(spark, schema)
    suffix = pattern[max(pattern.rfind(m) for m in "*?]") + 1:]
    found = _reader(spark, kind, schema).options(recursiveFileLookup="true", pathGlobFilter=f"*{suffix}").load(root)
    return found.filter(_plain_path(F.col("_metadata.file_path")).rlike("^(?:" + fnmatch.translate(_path_only(pattern)) + ")"))


def _path_only(path: str) -> str:
    """Without scheme and host."""
    if "://" in path:
        return "/" + path.split("://", 1)[1].partition("/")[2]
    return path.removeprefix("file:")


def _plain_path(uri: Column) -> Column:
    """File address without scheme and host, percent signs decoded."""
    path = F.regexp_replace(uri, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def _matching_files(spark: SparkSession, root: str, pattern: str) -> list[str]:
    fs, p = _file_system(spark, root)
    listing, matched, wanted = fs.listFiles(p, True), [], _path_only(pattern)
    while listing.hasNext():
        found = listing.next().getPath()
        if fnmatch.fnmatch(found.toUri().getPath(), wanted):
            matched.append(found.toString())
    return matched
