"""Paged HTTP and remote files as Spark data sources.

Each partition is one time slice, page range or remote file; its task fetches and
yields batches. The transport is a function given by the caller, so credentials
and network code stay outside and tests need no network. A lost executor only
repeats its own slices.
"""

from __future__ import annotations

import io
import json
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

# --- fixed values ---
LIST_KEYS = ["data", "results", "items", "records"]
STATEMENTS_KEY, MORE_KEY = "statements", "more"
DEFAULT_PAGE = 1000
ZULU = "%Y-%m-%dT%H:%M:%S.%fZ"
# --- end of fixed values ---

Fetch = Callable[[dict], object]


class _Slice(InputPartition):
    def __init__(self, request: dict):
        super().__init__(request)


def _source(name: str, schema: str, requests: list[dict], read_slice: Callable[[dict], Iterator[tuple]]) -> type[DataSource]:
    """A data source class over fixed requests; the functions travel with the class."""

    class Reader(DataSourceReader):
        def partitions(self):
            return [_Slice(r) for r in requests]

        def read(self, partition):
            yield from read_slice(partition.value)

    class Source(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return schema

        def reader(self, schema):
            return Reader()

    return Source


def _load(spark: SparkSession, name: str, schema: str, requests: list[dict], read_slice) -> DataFrame:
    spark.dataSource.register(_source(name, schema, requests, read_slice))
    return spark.read.format(name).load()


def time_slices(start: datetime, end: datetime, step: timedelta) -> list[tuple[datetime, datetime]]:
    slices = []
    while start < end:
        slices.append((start, min(start + step, end)))
        start += step
    return slices


def read_statements(spark: SparkSession, fetch: Fetch, start: datetime | None = None, end: datetime | None = None,
                    limit: int = DEFAULT_PAGE, step: timedelta = timedelta(days=1), params: dict | None = None) -> DataFrame:
    """Statement store: one task per time slice, following `more` links to the last page.

    Without a time range there is a single slice.

    `fetch(request)` gets `{"params": {...}}` for a first page and `{"link": "..."}`
    for a following one, and returns the decoded page.
    """
    base = {**(params or {}), "limit": limit}
    requests = [{"params": base}]
    if start is not None and end is not None:
        requests = [{"params": {**base, "since": a.strftime(ZULU), "until": b.strftime(ZULU)}}
                    for a, b in time_slices(start, end, step)]

    return _load(spark, "weftline_statements", "event string", requests, _all_pages(fetch))


def _all_pages(fetch: Fetch) -> Callable[[dict], Iterator[tuple]]:
    def read_slice(request):
        while request:
            page = fetch(request) or {}
            for statement in page.get(STATEMENTS_KEY) or []:
                yield (json.dumps(statement),)
            link = page.get(MORE_KEY)
            request = {"link": link} if link else None

    return read_slice


def stream_statements(spark: SparkSession, fetch: Fetch, start: datetime, clock: Callable[[], datetime], limit: int = DEFAULT_PAGE,
                      step: timedelta = timedelta(days=1), params: dict | None = None) -> DataFrame:
    """Statement store as a stream whose offsets are times: what was stored after `start` up to `clock()`.

    A batch is the time since the one before, cut into slices of `step`, one task each; a slice holds
    what was stored after its `since`, up to and with its `until`, so slices share no statement and leave none out.
    A run with the same checkpoint goes on where the last one ended. After a failed run it repeats the unfinished
    batch as it was; with `availableNow` that run ends there and the next one goes on.
    `clock` gives a time (UTC, without a zone) before which the store accepts nothing any more: now, less its
    delay. A clock that goes back gives no statement twice: the stream waits until it has caught up.
    """
    base = {**(params or {}), "limit": limit}
    read_slice = _all_pages(fetch)

    class Reader(DataSourceStreamReader):
        reached = start.strftime(ZULU)

        def initialOffset(self):
            return {"until": start.strftime(ZULU)}

        def latestOffset(self):
            # Text of this form is ordered like the times.
            self.reached = max(self.reached, clock().strftime(ZULU))
            return {"until": self.reached}

        def partitions(self, begin, end):
            self.reached = max(self.reached, end["until"])
            times = (datetime.strptime(o["until"], ZULU) for o in (begin, end))
            return [_Slice({"params": {**base, "since": a.strftime(ZULU), "until": b.strftime(ZULU)}})
                    for a, b in time_slices(*times, step)]

        def read(self, partition):
            yield from read_slice(partition.value)

    class Source(DataSource):
        @classmethod
        def name(cls):
            return "weftline_statement_stream"

        def schema(self):
            return "event string"

        def streamReader(self, schema):
            return Reader()

    spark.dataSource.register(Source)
    return spark.readStream.format("weftline_statement_stream").load()


def read_rest(spark: SparkSession, fetch: Fetch, requests: list[dict], run: datetime) -> DataFrame:
    """GET requests, one task each; one row per record of the answers (column `record`, JSON text)."""
    stamped = [{**r, "params": {**(r.get("params") or {}), "execution_date": run.isoformat(),
                                "ds": run.strftime("%Y-%m-%d")}} for r in requests]

    def read_slice(request):
        yield (json.dumps(fetch(request)),)

    pages = _load(spark, "weftline_rest", "payload string", stamped, read_slice)
    return pages.select(F.explode(unwrap_payload(F.col("payload"))).alias("record"))


def unwrap_payload(payload: Column) -> Column:
    """Array of JSON texts, one per record of an answer.

    A list gives its items; an object gives the first list under a usual key, else
    itself; anything else is wrapped as `{"data": value}`.
    """
    v = F.try_parse_json(payload)
    items = [v.try_cast("array<variant>")] + [
        F.try_variant_get(v, f"$.{k}", "variant").try_cast("array<variant>") for k in LIST_KEYS]
    texts = F.transform(F.coalesce(*items), lambda x: F.to_json(x))
    is_object = F.schema_of_variant(v).startswith("OBJECT")
    wrapped = F.concat(F.lit('{"data":'), payload, F.lit("}"))
    return F.coalesce(texts, F.array(F.when(is_object, payload).otherwise(wrapped)))


def read_remote_files(spark: SparkSession, fetch: Callable[[str], bytes | None], paths: list[str]) -> DataFrame:
    """Whole remote files as (content, filename), one task per file; a missing file gives no row."""

    def read_slice(request):
        content = fetch(request["path"])
        if content is not None:
            yield (bytearray(content), request["path"])

    return _load(spark, "weftline_files", "content binary, filename string", [{"path": p} for p in paths], read_slice)


def parse_remote_files(files: DataFrame, file_format: str, schema: str | None = None) -> DataFrame:
    """Rows of remote json (list, object or lines) and csv (with header) files; other formats stay bytes."""
    text = F.decode(F.col("content"), "UTF-8")
    if file_format == "json":
        rows = files.select(F.explode(unwrap_payload(text)).alias("record"))
        return rows if schema is None else rows.select(F.from_json("record", schema).alias("r")).select("r.*")
    if file_format == "csv":
        if schema is None:
            raise ValueError("a remote csv file needs a schema")
        return _csv_rows(files, schema)
    return files


def _csv_rows(files: DataFrame, schema: str) -> DataFrame:
    """Rows of csv files with a header line; quoted fields may hold line breaks."""
    wanted = files.sparkSession.createDataFrame([], schema).schema
    names = wanted.names

    def parse(batches):
        for batch in batches:
            for content in batch["content"]:
                rows = pd.read_csv(io.BytesIO(content), dtype=str)
                yield rows.reindex(columns=names).astype(object).where(lambda x: x.notna(), None)

    texts = files.mapInPandas(parse, ", ".join(f"`{c}` string" for c in names))
    return texts.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in wanted.fields])
