"""Questions that every document's hashes ask of the whole corpus, with little shuffled.

Documents are grouped into blocks of neighbouring ids. A block sorts its distinct hashes and
sends them, packed, to buckets given by the top bits; a bucket answers every entry
(is it older? how common is it?) and the block joins the packed answers by position. So a
hash costs a few bytes on the way there and a bit or a byte on the way back, however often it
occurs: a block holds it once, and no bucket gets more than one entry of it from a block.

Blocks of `block_docs` ids and about `BUCKET_ENTRIES` entries a bucket bound every group; with much
larger corpora raise block_docs in step, so that a block keeps sending hundreds of entries to each bucket.
A range of ids with more than BLOCK_BYTES is cut between ids into parts of at most twice that, and an id
(or the rows without one) with more has parts of its own, over which its rows are dealt at random.
Only a single row may be larger. Parts of one id are not earlier or later than one another.

A task that is run again sends and expects the same: blocks, parts and buckets are functions of ids and
hashes, and the rows dealt at random are written to the shared folder before they are asked about.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from weftline.session import freeze

BLOCK_BYTES = 8 << 20
ROW_BYTES = 64  # of a row besides its text
BUCKET_ENTRIES = 1_000_000
LAST = (1 << 62)  # the block of rows without an id


def block_of(id_col: str, block_docs: int) -> Column:
    return F.coalesce(F.expr(f"`{id_col}` div {block_docs}"), F.lit(LAST)).cast("long")


def blocks_of(docs: DataFrame, id_col: str, text_col: str, block_docs: int, *more: Column) -> tuple[DataFrame, int]:
    """block, part, doc_id, text and more of every row, and so many top bits that a bucket holds about BUCKET_ENTRIES words; 8 at least.

    part is 2**32 times the place of a cut in its block, plus the number of a share of the cut.
    """
    rows = docs.select(block_of(id_col, block_docs).alias("block"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *more)
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES).alias("bytes")
    sizes = freeze(rows.groupBy("block").agg(size, F.sum(F.octet_length("text")).alias("text_bytes")), "sizes")
    total, largest = sizes.agg(F.sum("text_bytes"), F.max("bytes")).first()
    bits = max(8, math.ceil(math.log2(max(1, (total or 0) / 7 / BUCKET_ENTRIES))))
    names = ["block", "part", *rows.columns[1:]]
    if (largest or 0) <= BLOCK_BYTES:
        return rows.withColumn("part", F.lit(0).cast("long")).select(names), bits

    ids = rows.groupBy("block", "doc_id").agg(size, F.count("*").alias("n"))
    ids = ids.join(sizes.where(F.col("bytes") > BLOCK_BYTES).select("block"), "block", "left_semi")
    before = F.sum("bytes").over(Window.partitionBy("block").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("bytes")
    # Ids under the budget share the even cuts; one over it has an odd one to itself.
    large = F.col("bytes") > BLOCK_BYTES
    cut = 2 * F.floor(before / BLOCK_BYTES) + F.when(large, 1).otherwise(0)
    shares = F.when(large, F.least(F.ceil(F.col("bytes") / BLOCK_BYTES), F.col("n"))).otherwise(1)
    cuts = freeze(ids.select(F.col("doc_id").alias("_cut_id"), cut.cast("long").alias("cut"), shares.cast("long").alias("shares")), "cuts")
    placed = rows.join(cuts, F.col("doc_id").eqNullSafe(F.col("_cut_id")), "left")
    first = F.coalesce(F.col("cut"), F.lit(0)).cast("long") * (1 << 32)
    whole = placed.where(F.coalesce("shares", F.lit(1)) == 1).withColumn("part", first).select(names)
    if cuts.where("shares > 1").isEmpty():
        return whole, bits
    shared = placed.where("shares > 1").withColumn("part", first + F.floor(F.rand() * F.col("shares")).cast("long")).select(names)
    return whole.unionByName(freeze(shared, "shared")), bits


def id_order(table: pa.Table) -> tuple[np.ndarray, pa.Table]:
    """Ids (the largest integer for a null) in ascending order and the rows in that order."""
    column = table.column("doc_id").cast(pa.int64())
    ids = column.fill_null(np.iinfo(np.int64).max).to_numpy()
    order = np.argsort(ids, kind="stable")
    return ids[order], table.take(pa.array(order))


def bucket_bounds(sorted_hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that have entries, and the bounds of their entries."""
    bucket = (sorted_hashes >> np.uint64(64 - bits)).astype(np.int64)
    at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
    return bucket[at], np.r_[at, len(bucket)]


def sent(key, buckets: np.ndarray, bounds: np.ndarray, entries: np.ndarray) -> pa.Table:
    from weftline.llm.text import binaries

    block, part = (pa.array(np.full(len(buckets), k.as_py()), pa.int64()) for k in key)
    return pa.table({"bucket": pa.array(buckets, pa.int64()), "block": block, "part": part, "entries": binaries(entries, bounds)})


SENT = "bucket long, block long, part long, entries binary"
ANSWER = "block long, part long, bucket long, answer binary"


def received(table: pa.Table, kind) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """A bucket's rows by ascending block and part, all their entries, and the bounds of the rows."""
    table = table.take(pa.array(np.lexsort((table.column("part").to_numpy(), table.column("block").to_numpy()))))
    parts = [np.frombuffer(x, kind) for x in table.column("entries").to_pylist()]
    return table, np.concatenate(parts), np.cumsum([0, *map(len, parts)])


def ranks(table: pa.Table) -> np.ndarray:
    """Of rows from `received`: ascending, and equal for the shares of one id."""
    block, cut = table.column("block").to_numpy(), table.column("part").to_numpy() >> 32
    return np.cumsum(np.r_[False, (block[1:] != block[:-1]) | (cut[1:] != cut[:-1])])


def answered(table: pa.Table, answers: list[bytes]) -> pa.Table:
    return pa.table({"block": table.column("block"), "part": table.column("part"), "bucket": table.column("bucket"), "answer": pa.array(answers, pa.binary())})


def replies(table: pa.Table) -> list[bytes]:
    """A block's answers, by ascending bucket."""
    if not table.num_rows:
        return []
    order = np.argsort(table.column("bucket").to_numpy(), kind="stable")
    return table.column("answer").take(pa.array(order)).to_pylist()


def ask(blocks: DataFrame, send, answer, read, schema: str) -> DataFrame:
    """blocks is from `blocks_of`; send, answer and read work on one group each."""
    asked = blocks.groupBy("block", "part").applyInArrow(send, SENT)
    told = asked.groupBy("bucket").applyInArrow(answer, ANSWER)
    return blocks.groupBy("block", "part").cogroup(told.groupBy("block", "part")).applyInArrow(read, schema)
