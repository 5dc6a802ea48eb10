"""Writes that leave the cluster: databases, HTTP, remote files. Work stays in the tasks."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from weftline.sinks.shape import serialize_for_sink
from weftline.sinks.tables import latest_per_key
from weftline.sources.jdbc import DRIVERS

# --- fixed values ---
DATABASE_BATCH = {"postgresql": 1000, "clickhouse": 10_000}
REST_BATCH = 100
# --- end of fixed values ---

REMOTE_FILE_BYTES = 64 << 20
# Name of the file that lists the parts of the last complete write.
COMMITTED = "_committed"


def jdbc_write_options(kind: str, url: str, table: str, schema: str | None = None, batch_size: int | None = None,
                       create_options: str | None = None, column_types: dict[str, str] | None = None) -> dict[str, str]:
    options = {"url": url, "dbtable": f"{schema}.{table}" if schema else table, "driver": DRIVERS.get(kind, ""),
               "batchsize": str(batch_size or DATABASE_BATCH.get(kind, 1000)), "truncate": "true"}
    if create_options:
        options["createTableOptions"] = create_options
    if column_types:
        options["createTableColumnTypes"] = ", ".join(f"{c} {t}" for c, t in column_types.items())
    return {k: v for k, v in options.items() if v}


def merge_tree_options(order_by: list[str], columns: list[str], partition_by: str | None = None,
                       engine: str = "MergeTree", version: str | None = None) -> str:
    """Table options of a column store: engine, sort key (only columns that exist) and partition."""
    engine_text = f"{engine}({version})" if version else f"{engine}()"
    kept = [c for c in order_by if c in columns]
    text = f"ENGINE = {engine_text} ORDER BY " + (f"({', '.join(kept)})" if kept else "tuple()")
    return text + (f" PARTITION BY {partition_by}" if partition_by else "")


def write_jdbc(df: DataFrame, kind: str, url: str, table: str, mode: str, properties: dict | None = None, **kw) -> None:
    """Overwrite truncates and refills. Upserts go through `upsert_database`."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode {mode} over JDBC: give the connection a 'connect' function for upserts")
    (serialize_for_sink(df).write.format("jdbc").mode(mode)
     .options(**jdbc_write_options(kind, url, table, **kw), **(properties or {})).save())


def upsert_statement(table: str, columns: list[str], keys: list[str], mark: str = "%s") -> str:
    """INSERT that replaces all other columns of a row with the same keys."""
    def listed(names):
        return ", ".join('"' + c.replace('"', '""') + '"' for c in names)

    others = [c for c in columns if c not in keys]
    action = "UPDATE SET " + ", ".join(f"{listed([c])} = EXCLUDED.{listed([c])}" for c in others) if others else "NOTHING"
    return (f"INSERT INTO {table} ({listed(columns)}) VALUES ({', '.join([mark] * len(columns))}) "
            f"ON CONFLICT ({listed(keys)}) DO {action}")


def upsert_database(df: DataFrame, connect: Callable[[], object], table: str, keys: list[str],
                    batch_size: int = DATABASE_BATCH["postgresql"], mark: str = "%s") -> int:
    """Upsert in batches, one connection per task, one transaction per batch.

    `connect()` gives a DB-API connection. Equal keys are reduced to one row first, so
    a repeated task or batch gives the same table.
    """
    rows = serialize_for_sink(latest_per_key(df, keys))
    statement = upsert_statement(table, rows.columns, keys, mark)

    def write_partition(partition) -> int:
        connection, sent = None, 0
        for batch in batches((tuple(r.values()) for r in partition), batch_size):
            connection = connection or connect()
            connection.cursor().executemany(statement, batch)
            connection.commit()
            sent += len(batch)
        if connection is not None:
            connection.close()
        return sent

    return _per_partition(rows, write_partition)


def _per_partition(df: DataFrame, work: Callable[[Iterator[dict]], int]) -> int:
    """Run `work` on the rows of every partition; the sum of the counts it returns.

    A query over Arrow batches rather than an RDD action, so metrics observed on the
    input are reported.
    """
    def run(arrow_batches):
        import pyarrow as pa

        count = work(row for batch in arrow_batches for row in batch.to_pylist())
        yield pa.RecordBatch.from_pydict({"rows": pa.array([count], pa.int64())})

    return df.mapInArrow(run, "rows bigint").agg(F.sum("rows").alias("rows")).first().rows or 0


def batches(rows: Iterable, size: int) -> Iterator[list]:
    batch = []
    for row in rows:
        batch.append(row)
        if len(batch) == size:
            yield batch
            batch = []
    if batch:
        yield batch


def write_rest(df: DataFrame, send: Callable[[list[dict]], None], batch_size: int = REST_BATCH) -> int:
    """Send rows in batches, at least once: a repeated task sends its batches again."""
    records = serialize_for_sink(df).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))

    def send_partition(rows) -> int:
        sent = 0
        for batch in batches((json.loads(r["record"]) for r in rows), batch_size):
            send(batch)
            sent += len(batch)
        return sent

    return _per_partition(records, send_partition)


def _remote_writer(transport: dict, root: str, kind: str, header: str | None, file_bytes: int, run: str):
    """Data source class that sends one column of text lines as remote files and commits them as a whole."""
    put, listed, remove = transport["put"], transport.get("list"), transport.get("remove")
    if (listed is None) != (remove is None):
        raise ValueError("give both 'list' and 'remove', or neither")

    @dataclass
    class Sent(WriterCommitMessage):
        names: list
        rows: int

    class RemoteWriter(DataSourceArrowWriter):
        def write(self, iterator):
            # Every attempt has names of its own, so a lost or doubled one cannot touch the files of another.
            context = TaskContext.get()
            stem = f"part-{context.partitionId():05d}-{run}-{context.taskAttemptId()}"
            names, rows, lines, size = [], 0, [], 0

            def flush():
                name = f"{stem}-{len(names):04d}.{kind}"
                put(f"{root}/{name}", ("\n".join(([header] if header is not None else []) + lines) + "\n").encode())
                names.append(name)

            for batch in iterator:
                for line in batch.column(0).to_pylist():
                    lines.append(line)
                    size += len(line) + 1
                    if size >= file_bytes:
                        flush()
                        rows, lines, size = rows + len(lines), [], 0
            if lines:
                flush()
            return Sent(names, rows + len(lines))

        def _clear(self, keep, mine_only):
            for name in listed(root) if listed else ():
                name = name.rsplit("/", 1)[-1]
                if name.startswith("part-") and name not in keep and (not mine_only or f"-{run}-" in name):
                    remove(f"{root}/{name}")

        def commit(self, messages):
            names = sorted(n for m in messages if m for n in m.names)
            rows = sum(m.rows for m in messages if m)
            # The list of files is the commit: until it is there, a reader of it sees the files before.
            put(f"{root}/{COMMITTED}", json.dumps({"files": names, "rows": rows}).encode())
            self._clear(set(names), mine_only=False)

        def abort(self, messages):
            self._clear(set(), mine_only=True)

    class RemoteFiles(DataSource):
        @classmethod
        def name(cls):
            return f"remote_files_{run}"

        def writer(self, schema, overwrite):
            return RemoteWriter()

    return RemoteFiles


def write_remote_files(df: DataFrame, put: Callable[[str, bytes], None], path: str, file_format: str = "json",
                       list_files: Callable[[str], list[str]] | None = None, remove: Callable[[str], None] | None = None,
                       file_bytes: int = REMOTE_FILE_BYTES) -> None:
    """Replace the files under `path` by json lines, or csv files with a header, of about `file_bytes` each.

    Tasks hold one file's lines at a time. When all are done the driver puts `_committed`,
    a list of the files that count, and with `list_files` and `remove` deletes all other
    parts, those of earlier runs and of lost tasks. A failed run deletes its own files and
    leaves the earlier ones as they were. Without those two functions old parts stay, and
    `_committed` tells them apart.
    """
    if file_format not in ("json", "csv"):
        raise ValueError(f"remote files are json or csv, not {file_format}")
    plain = serialize_for_sink(df)
    whole, header = F.struct("*"), None
    if file_format == "json":
        line = F.to_json(whole, {"ignoreNullFields": "false"})
    else:
        line = F.to_csv(whole, {"escape": '"', "emptyValue": '""', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
        header = ",".join('"' + c.replace('"', '""') + '"' if any(x in c for x in ',"\n\r') else c for c in plain.columns)
    source = _remote_writer({"put": put, "list": list_files, "remove": remove}, path.rstrip("/"), file_format, header,
                            file_bytes, uuid.uuid4().hex[:12])
    df.sparkSession.dataSource.register(source)
    plain.select(line.alias("line")).write.format(source.name()).mode("append").save()
