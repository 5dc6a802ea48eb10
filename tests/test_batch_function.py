"""The batch function over documents lets go of every batch."""

import gc
import weakref

import pandas as pd

from weftline.queries import cleaning


class Text(str):
    pass


def test_a_measured_batch_is_let_go():
    alive = []

    def batches():
        for i in range(4):
            texts = [Text("ä" * i), None, Text(f"text {i}")]
            alive.extend(weakref.ref(t) for t in texts if t is not None)
            yield pd.DataFrame({"lang": ["de", "en", None], "text": texts})

    gc.collect()
    gc.disable()
    try:
        got = [b["chars"].tolist() for b in cleaning.measure(batches())]
        assert sum(r() is not None for r in alive) <= 2  # the last batch at most
    finally:
        gc.enable()
    assert [[None if pd.isna(x) else x for x in c] for c in got] == [[i, None, 6] for i in range(4)]
