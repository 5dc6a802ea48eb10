"""Substring dedup: repeated windows of words are found by Rabin-Karp hashes and cut out.

Every window of `width` consecutive words is hashed by prefix sums. Spark counts the windows:
each block of documents sends its distinct window hashes to buckets, which tell the block
what is also in an earlier block (`blocks.ask`). A window of 72 bits or more decides; at 10**13
windows some ten equal hashes of different windows are to be expected in all.

Defined cases: a null text has no words and gives an empty kept text. Rows without an id
count as later than all others and not as earlier than one another. Rows of equal id do not
repeat each other. Words over the width of a document shorter than a window are
all kept. Other columns of the input are not read. An empty table gives no rows.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from weftline.llm import blocks as B, text as T

SCHEMA = "doc_id long, n_words long, n_removed long, kept string, removed array<struct<first: long, count: long>>"


class _Windows:
    """The windows of a block's documents in id order, and its distinct hashes in sorted order."""

    def __init__(self, table: pa.Table, width: int):
        self.ids, table = B.id_order(table)
        self.nulls = table.column("doc_id").is_null().to_numpy()
        self.data, self.offsets = T.text_bytes(table.column("text"))
        self.starts, self.ends, self.doc = T.words(self.data, self.offsets)
        hashes = T.span_hashes(self.data, self.starts, self.ends)
        self.at, first = T.gram_hashes(hashes, self.doc, width, T.BASES[1])
        second = T.gram_hashes(hashes, self.doc, width, T.BASES[2])[1]
        self.order = np.argsort(first, kind="stable")
        ordered = first[self.order]
        new = np.r_[True, ordered[1:] != ordered[:-1]] if len(ordered) else np.zeros(0, bool)
        self.run, self.heads = np.cumsum(new) - 1, np.flatnonzero(new)
        self.distinct = ordered[self.heads]
        self.entries = (self.distinct << np.uint64(8)) | (second[self.order][self.heads] & np.uint64(255))


def _send(width: int, bits: int, key, table: pa.Table) -> pa.Table:
    w = _Windows(table, width)
    return B.sent(key, *B.bucket_bounds(w.distinct, bits), w.entries)


def _answer(table: pa.Table) -> pa.Table:
    """One bit an entry: an earlier block has it too."""
    table, entries, bounds = B.received(table, np.uint64)
    order = np.argsort(entries, kind="stable")
    ordered, rank = entries[order], np.repeat(B.ranks(table), np.diff(bounds))[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    older = np.zeros(len(entries), bool)
    older[order] = rank > rank[np.flatnonzero(new)][np.cumsum(new) - 1]
    return B.answered(table, [np.packbits(older[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:])])


def _cut(width: int, bits: int, table: pa.Table, told: pa.Table) -> pa.Table:
    w = _Windows(table, width)
    _, bounds = B.bucket_bounds(w.distinct, bits)
    older = [np.unpackbits(np.frombuffer(x, np.uint8), count=int(b - a)) for x, a, b in zip(B.replies(told), bounds[:-1], bounds[1:])]
    older = np.concatenate(older).astype(bool) if older else np.zeros(0, bool)

    # A window goes if an earlier block has it, or a smaller id of this block.
    owner = w.ids[w.doc[w.at[w.order]]] if len(w.at) else np.zeros(0, np.int64)
    goes = np.zeros(len(w.at), bool)
    if len(w.at):
        goes[w.order] = older[w.run] | (owner[w.heads][w.run] < owner)
    n, docs = len(w.starts), len(w.ids)
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, w.at[goes], 1)
    np.add.at(steps, w.at[goes] + width, -1)
    gone = np.cumsum(steps[:n]) > 0

    # Kept words joined by one space: a word brings the byte after it, the last one does not.
    word_bounds = np.searchsorted(w.doc, np.arange(docs + 1))
    kept = np.flatnonzero(~gone)
    last = np.r_[w.doc[kept][1:] != w.doc[kept][:-1], True] if len(kept) else np.zeros(0, bool)
    data = np.append(w.data, np.uint8(32))
    after = w.ends[np.r_[w.doc[1:] == w.doc[:-1], False]] if n else w.ends
    data[after] = 32
    upto = w.ends[kept] + ~last
    marks = np.zeros(len(data) + 1, np.int8)
    marks[w.starts[kept]] += 1
    np.add.at(marks, upto, -1)
    text = data[np.cumsum(marks[:-1], dtype=np.int8) > 0]
    sizes = np.zeros(docs, np.int64)
    np.add.at(sizes, w.doc[kept], upto - w.starts[kept])

    # Maximal removal intervals, as places of words in their document.
    same = np.r_[False, w.doc[1:] == w.doc[:-1]] if n else np.zeros(0, bool)
    opens = np.flatnonzero(gone & ~(same & np.r_[False, gone[:-1]])) if n else np.zeros(0, np.int64)
    closes = np.flatnonzero(gone & ~np.r_[same[1:] & gone[1:], False]) + 1 if n else opens
    intervals = pa.StructArray.from_arrays([pa.array(opens - word_bounds[w.doc[opens]], pa.int64()), pa.array(closes - opens, pa.int64())], ["first", "count"])
    at = np.searchsorted(w.doc[opens], np.arange(docs + 1)).astype(np.int32)
    return pa.table({
        "doc_id": pa.array(w.ids, pa.int64(), mask=w.nulls),
        "n_words": pa.array(np.diff(word_bounds), pa.int64()),
        "n_removed": pa.array(np.bincount(w.doc[gone], minlength=docs)[:docs].astype(np.int64), pa.int64()),
        "kept": T.strings(text, np.r_[0, np.cumsum(sizes)]),
        "removed": pa.ListArray.from_arrays(pa.array(at, pa.int32()), intervals),
    })


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13, block_docs: int = 256) -> DataFrame:
    """Per row: n_words, n_removed, the kept words joined by a space, and the removal intervals.

    A word is removed if a window over it also starts in a document of smaller id.
    """
    rows, bits = B.blocks_of(docs, id_col, text_col, block_docs)
    send, cut = partial(_send, width, bits), partial(_cut, width, bits)
    return B.ask(rows, lambda key, table: send(key, table), _answer, lambda left, right: cut(left, right), SCHEMA)
