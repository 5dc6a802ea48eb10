"""Source type -> reader."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from weftline.plans.spec import SourceSpec, SpecError, validate_source
from weftline.sinks.buckets import is_bucketed, read_buckets
from weftline.sources import documents, files, jdbc, remote
from weftline.sources.normalize import normalize_types

Reader = Callable[[SparkSession, SourceSpec, dict, datetime], DataFrame]


def _database(spark, source, connection, run):
    kind = source.type
    split = source.custom_config.get("split")
    df = jdbc.read_jdbc(spark, kind, connection["url"], connection.get("properties"), query=source.query,
                        table=source.table_name, schema=source.schema_name, split=jdbc.Split(**split) if split else None)
    if kind == "clickhouse":
        return normalize_types(df)
    return jdbc.vectors_from_text(df, source.custom_config.get("vector_columns", [])) if kind == "pgvector" else df


def _documents(spark, source, connection, run):
    """The document-store connector when a connection names one, JSON lines otherwise."""
    if "format" in connection:
        df = spark.read.format(connection["format"]).options(
            **connection.get("options", {}), collection=source.collection_name).load()
    else:
        df = files.read_files(spark, f"{connection['path'].rstrip('/')}/{source.collection_name}", "jsonl",
                              source.custom_config.get("schema"))
    return documents.filter_documents(df, source.filter_condition)


def _files(spark, source, connection, run):
    path = source.file_path
    root = connection.get("path")
    if root and "://" not in path and not path.startswith("/"):
        path = f"{root.rstrip('/')}/{path}"
    if source.file_format in (None, "parquet") and "*" not in path and is_bucketed(spark, path):
        return read_buckets(spark, path)
    read = files.read_wildcard if "*" in path else files.read_files
    return read(spark, path, source.file_format, source.custom_config.get("schema"), run)


def _sftp(spark, source, connection, run):
    path = files.expand_path(source.file_path, run)
    raw = remote.read_remote_files(spark, connection["fetch"], [path])
    return remote.parse_remote_files(raw, source.file_format or files.guess_format(path), source.custom_config.get("schema"))


def _rest(spark, source, connection, run):
    request = {"endpoint": source.endpoint, "headers": source.headers, "params": source.params}
    return remote.read_rest(spark, connection["fetch"], [request], run)


def _statements(spark, source, connection, run):
    daily = source.custom_config.get("date_filter") == "daily"
    start, end = (run, run + timedelta(days=1)) if daily else (None, None)
    return remote.read_statements(spark, connection["fetch"], start, end,
                                  source.custom_config.get("batch_size", remote.DEFAULT_PAGE), params=source.params)


READERS: dict[str, Reader] = {
    "postgresql": _database, "clickhouse": _database, "pgvector": _database, "mongodb": _documents,
    "datalake_gen2": _files, "file": _files, "sftp": _sftp, "rest_api": _rest, "xapi": _statements,
}


def with_run_date(value, run: datetime):
    """Text, also inside lists and dicts, with `{{ ds }}` and `{{ ts }}` replaced by the run's date and time."""
    if isinstance(value, dict):
        return {k: with_run_date(v, run) for k, v in value.items()}
    if isinstance(value, list):
        return [with_run_date(v, run) for v in value]
    if isinstance(value, str):
        for key, text in (("ds", f"{run:%Y-%m-%d}"), ("ts", run.isoformat())):
            value = value.replace("{{ %s }}" % key, text).replace("{{%s}}" % key, text)
    return value


def read_source(spark: SparkSession, source: SourceSpec, connections: dict[str, dict], run: datetime) -> DataFrame:
    if source.type not in READERS:
        raise SpecError(f"unsupported source type: {source.type}")
    problems = validate_source(source)
    if problems:
        raise SpecError("; ".join(problems))
    source = replace(source, query=with_run_date(source.query, run), filter_condition=with_run_date(source.filter_condition, run))
    return READERS[source.type](spark, source, connections.get(source.connection_id or "", {}), run)
