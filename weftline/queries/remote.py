"""Statement-store reads over the event table, which a transport inside the tasks serves in pages."""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime, timedelta
from itertools import islice

import pyarrow.dataset as arrow
from pyspark.sql import functions as F

from weftline.queries.registry import n, query
from weftline.session import scratch_path
from weftline.sources.remote import STATEMENTS_KEY, ZULU, read_statements, stream_statements

SHAPE = "event_id long, ts string, user_id long, event_type string, value double, props string"
BATCH_ROWS = 2000  # rows of the event table that a task turns into records at once
SQL = "SELECT event_id, ts, user_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"


# The slice a worker is reading, by what its next page is asked with.
_OPEN: dict[tuple, Iterator[tuple[list[dict], bool]]] = {}


def _records(place: str, since: str, until: str) -> Iterator[dict]:
    """A slice, a batch at a time."""
    after, last = (datetime.strptime(x, ZULU) for x in (since, until))
    ts = arrow.field("ts")
    scan = arrow.dataset(place).scanner(filter=(ts > after) & (ts <= last), batch_size=BATCH_ROWS, batch_readahead=1, fragment_readahead=1, use_threads=False)
    for batch in scan.to_batches():
        for row in batch.to_pylist():
            yield {**row, "ts": row["ts"].isoformat()}


def _pages(place: str, since: str, until: str, skip: int, limit: int) -> Iterator[tuple[list[dict], bool]]:
    """Pages of a slice from its row `skip` on, and whether another one follows."""
    records = islice(_records(place, since, until), skip, None)
    page = list(islice(records, limit))
    while page:
        following = list(islice(records, limit))
        yield page, bool(following)
        page = following


def stored(place: str, since: str, until: str, skip: int, limit: int) -> tuple[list[dict], bool]:
    """One page of a slice. The task goes on reading where its last page ended; any other page is read from the slice's start on."""
    pages = _OPEN.pop((place, since, until, skip, limit), None)
    _OPEN.clear()
    if pages is None:
        pages = _pages(place, since, until, skip, limit)
    page, more = next(pages, ([], False))
    if more:
        _OPEN[place, since, until, skip + len(page), limit] = pages
    return page, more


def event_store(folder: str):
    """Transport over events.parquet: what was stored after `since` up to `until`, in pages with a `more` link."""
    place = f"{folder.rstrip('/')}/events.parquet"

    def fetch(request: dict) -> dict:
        at = json.loads(request["link"]) if "link" in request else {**request["params"], "skip": 0}
        rows, more = stored(place, at["since"], at["until"], at["skip"], at["limit"])
        return {STATEMENTS_KEY: rows, "more": json.dumps({**at, "skip": at["skip"] + len(rows)}) if more else ""}

    return fetch


def span(t):
    """From just before the first event to the last one."""
    first, last = t.events.agg(F.min("ts"), F.max("ts")).first()
    return first - timedelta(microseconds=1), last


def fields(statements):
    s = statements.select(F.from_json("event", SHAPE).alias("s")).select("s.*")
    return s.withColumn("ts", F.col("ts").cast("timestamp_ntz")).withColumn("k", n(F.get_json_object("props", "$.k"))).drop("props")


@query("read_statements", SQL)
def _(t):
    """One task a slice of time."""
    first, last = span(t)
    return fields(read_statements(t.spark, event_store(t.folder), first, last, step=(last - first) / 16))


@query("stream_statements", SQL)
def _(t):
    """Two runs with one checkpoint, the first up to the middle of the time."""
    first, last = span(t)
    out, checkpoint = scratch_path(t.spark, "statements"), scratch_path(t.spark, "statements-checkpoint")
    for now in (first + (last - first) / 2, last):
        stream = stream_statements(t.spark, event_store(t.folder), first, lambda now=now: now, step=(last - first) / 16)
        run = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
        run.awaitTermination()
    return fields(t.spark.read.schema("event string").parquet(out))
