"""Searches in tiles: the nearest rows by brute force, in bounded memory."""

import gc
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from weftline.operators import vectors


def peak_mb(work):
    gc.collect()
    tracemalloc.start()
    try:
        result = work()
        return result, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("metric", ["l2", "cosine", "inner_product"])
def test_search_in_tiles(metric):
    random = np.random.default_rng(5)
    queries, rows = random.normal(size=(4000, 4)), random.normal(size=(3001, 4))
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(len(rows))), "v": pa.array(list(rows))})
    found, peak = peak_mb(lambda: list(vectors._task_best(list(range(len(queries))), queries, metric, 3, [batch])))
    assert peak < 60  # one product of all queries and 2,000 rows has 64 MB
    got = {b["query_id"][0].as_py(): (b["id"].to_pylist(), b["distance"].to_pylist()) for b in found}
    assert len(got) == len(queries)
    for q in range(0, len(queries), 37):
        distance = vectors._pairs(metric, rows, queries[q])
        nearest = np.lexsort((np.arange(len(rows)), distance))[:3]
        assert got[q] == (nearest.tolist(), distance[nearest].tolist())
