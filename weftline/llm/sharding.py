"""Sharding by jump consistent hashing: no ring table, and a new last shard takes rows only into itself.

The jump runs vectorised over Arrow batches. Places in a shard are numbered by counts
per chunk of ids and their running sum, so that no task sees a whole shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

CHUNK_ROWS = 50_000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    key, bucket, ahead = keys.astype(np.uint64).copy(), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    active = np.arange(len(keys))
    while len(active):
        bucket[active] = ahead[active]
        key[active] = key[active] * np.uint64(2862933555777941757) + np.uint64(1)
        step = ((key[active] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        ahead[active] = ((bucket[active] + 1) * (float(1 << 31) / step)).astype(np.int64)
        active = active[ahead[active] < shards]
    return bucket


def shard_of(key: Column, shards: int) -> Column:
    """Jump hash of any column's 64-bit hash; equal values, nulls included, go to one shard."""

    @F.pandas_udf("int")
    def place(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump(hashed.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return place(F.xxhash64(key))


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8) -> DataFrame:
    """Per row: doc_id, size, text_crc32, shard, slot (gapless in the shard) and grown_shard.

    A null text has no bytes (size 1, checksum 0); rows without an id share the shard of the null key. Equal
    rows get places one after another, in any order. Other columns are not read; an empty table gives no rows.
    """
    # fixed values: the jump hash's multiplier above, and size = bytes + 1
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"))
    chunks = max(1, -(-docs.count() // CHUNK_ROWS)) * 4
    equal = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(chunks)).cast("int"))
    equal = equal.groupBy("chunk", "doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    equal = equal.withColumn("shard", shard_of(F.col("doc_id"), shards)).withColumn("grown_shard", shard_of(F.col("doc_id"), shards + 1))
    sums = equal.groupBy("shard", "chunk").agg(F.sum("n").alias("total"))
    before = sums.withColumn("before", F.coalesce(F.sum("total").over(Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("total")
    inside = Window.partitionBy("shard", "chunk").orderBy(F.col("doc_id").asc_nulls_first(), "size", "text_crc32")
    placed = equal.withColumn("inside", F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")).join(before, ["shard", "chunk"])
    each = placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    return each.select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("inside") + F.col("copy")).cast("long").alias("slot"), "grown_shard")
