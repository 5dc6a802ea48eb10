"""Sink type -> writer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from weftline.plans.spec import SinkSpec, SpecError, validate_sink
from weftline.sinks import outbound
from weftline.sinks.buckets import upsert_buckets
from weftline.sinks.tables import WriteResult, write_table


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    counted = Observation()
    return df.observe(counted, F.count(F.lit(1)).alias("rows")), counted


def _folder(sink: SinkSpec, connection: dict) -> str:
    name = sink.file_path or sink.collection_name or ".".join(p for p in (sink.schema_name, sink.table_name) if p)
    root = connection.get("path")
    return name if root is None or "://" in name or name.startswith("/") else f"{root.rstrip('/')}/{name}"


def _tables(df: DataFrame, sink: SinkSpec, connection: dict) -> WriteResult:
    """Tables and collections kept as Parquet folders; a JDBC url sends them to a database."""
    if sink.write_mode == "upsert" and "connect" in connection:
        name = ".".join(p for p in (sink.schema_name, sink.table_name) if p)
        sent = outbound.upsert_database(df, connection["connect"], name, sink.upsert_keys,
                                        sink.batch_size or outbound.DATABASE_BATCH.get(sink.type, 1000))
        return WriteResult(name, "upsert", sent, columns=df.columns)
    if "url" in connection:
        counted, seen = _counted(df)
        created = sink.custom_config.get("create_options")
        if created is None and sink.custom_config.get("order_by"):
            created = outbound.merge_tree_options(sink.custom_config["order_by"], df.columns,
                                                  sink.custom_config.get("partition_by"))
        outbound.write_jdbc(counted, sink.type, connection["url"], sink.table_name, sink.write_mode,
                            connection.get("properties"), schema=sink.schema_name, batch_size=sink.batch_size,
                            create_options=created, column_types=sink.table_schema)
        return WriteResult(sink.table_name, sink.write_mode, int(seen.get["rows"]), columns=df.columns)
    if "buckets" in sink.custom_config:
        if sink.write_mode != "upsert":
            raise SpecError(f"{sink.write_mode} cannot keep a table in buckets")
        return upsert_buckets(df, _folder(sink, connection), sink.upsert_keys, buckets=int(sink.custom_config["buckets"]))
    return write_table(df, _folder(sink, connection), sink.write_mode, sink.upsert_keys,
                       partition_by=sink.partition_columns, sort_by=sink.custom_config.get("order_by"),
                       table_schema=sink.table_schema, auto_create=sink.auto_create_table,
                       align=bool(sink.custom_config.get("align")))


def _files(df: DataFrame, sink: SinkSpec, connection: dict) -> WriteResult:
    kind = (sink.file_format or "parquet").lower()
    if kind == "parquet":
        return _tables(df, sink, connection)
    if kind not in ("json", "csv", "orc"):
        raise SpecError(f"unsupported file format: {kind}")
    if sink.write_mode not in ("overwrite", "append"):
        raise SpecError(f"{sink.write_mode} needs parquet files")
    counted, seen = _counted(df)
    writer = counted.write.mode(sink.write_mode)
    if sink.partition_columns:
        writer = writer.partitionBy(*sink.partition_columns)
    path = _folder(sink, connection)
    writer.option("header", "true").format(kind).save(path)
    return WriteResult(path, sink.write_mode, int(seen.get["rows"]), columns=df.columns)


def _sftp(df: DataFrame, sink: SinkSpec, connection: dict) -> WriteResult:
    counted, seen = _counted(df)
    outbound.write_remote_files(counted, connection["put"], sink.file_path, sink.file_format or "json",
                                connection.get("list"), connection.get("remove"))
    return WriteResult(sink.file_path, "overwrite", int(seen.get["rows"]), columns=df.columns)


def _rest(df: DataFrame, sink: SinkSpec, connection: dict) -> WriteResult:
    sent = outbound.write_rest(df, connection["send"], sink.batch_size or outbound.REST_BATCH)
    return WriteResult(sink.name, "append", sent, columns=df.columns)


WRITERS = {"postgresql": _tables, "clickhouse": _tables, "pgvector": _tables, "mongodb": _tables,
           "datalake_gen2": _files, "file": _files, "sftp": _sftp, "rest_api": _rest}


def write_sink(df: DataFrame, sink: SinkSpec, connections: dict[str, dict]) -> WriteResult:
    if sink.type not in WRITERS:
        raise SpecError(f"unsupported sink type: {sink.type}")
    problems = validate_sink(sink)
    if problems:
        raise SpecError("; ".join(problems))
    return WRITERS[sink.type](df, sink, connections.get(sink.connection_id or "", {}))


def write_many(df: DataFrame, sinks: list[SinkSpec], connections: dict[str, dict]) -> dict[str, WriteResult | str]:
    """Every sink gets the same rows, computed once; a failing sink does not stop the others."""
    if len(sinks) > 1:
        df = df.persist()
    out: dict[str, WriteResult | str] = {}
    try:
        for sink in sinks:
            try:
                out[sink.name] = write_sink(df, sink, connections)
            except Exception as problem:  # noqa: BLE001 - reported per sink
                out[sink.name] = f"error: {problem}"
    finally:
        if len(sinks) > 1:
            df.unpersist()
    return out
