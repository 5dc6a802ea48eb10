"""Pages of the event store: every statement once, and never a whole slice in memory."""

import gc
import json
import tracemalloc
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from weftline.queries import remote
from weftline.sources.remote import STATEMENTS_KEY, ZULU


def peak_mb(work):
    gc.collect()
    tracemalloc.start()
    try:
        result = work()
        return result, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


START = datetime(2024, 1, 1)


def pages(fetch, request):
    while request:
        page = fetch(request)
        yield request, page
        request = {"link": page["more"]} if page["more"] else None


@pytest.fixture
def store(tmp_path):
    ts = np.datetime64(START, "us") + np.arange(60_000) * np.timedelta64(1, "s")
    ts[59_999] = ts[59_998]
    pq.write_table(pa.table({"event_id": np.arange(60_000), "ts": ts, "props": ["x" * 40] * 60_000}), tmp_path / "events.parquet", row_group_size=7_000)
    return remote.event_store(str(tmp_path))


def asked(since, until, limit):
    return {"params": {"since": (START + timedelta(seconds=since)).strftime(ZULU), "until": (START + timedelta(seconds=until)).strftime(ZULU), "limit": limit}}


def test_a_slice_is_read_page_by_page(store):
    ids = lambda page: [s["event_id"] for s in page[STATEMENTS_KEY]]
    total, peak = peak_mb(lambda: sum(len(ids(p)) for _, p in pages(store, asked(-1, 60_000, 500))))
    assert total == 60_000 and peak < 12  # as records the slice has 20 MB and more
    got = list(pages(store, asked(9, 3_009, 1_000)))
    assert [ids(p) for _, p in got] == [list(range(a, a + 1_000)) for a in (10, 1_010, 2_010)]
    assert json.loads(got[1][0]["link"])["skip"] == 1_000 and got[2][1]["more"] == ""
    # Pages asked for once more, out of order, or between those of another slice.
    for request, page in reversed(got):
        assert store(request) == page
        assert ids(store(asked(59_990, 60_001, 100))) == list(range(59_991, 60_000))
        assert store(request) == page
    assert store(asked(70_000, 80_000, 10)) == {STATEMENTS_KEY: [], "more": ""}
    assert len(remote._OPEN) <= 1
