"""Distances and nearest neighbours on array columns."""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from weftline.functions.columns import quote


def _sum(items: Column) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda total, x: total + x)


def _dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def l2_distance(a: Column, b: Column) -> Column:
    return F.sqrt(_sum(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0)))))


def inner_product(a: Column, b: Column) -> Column:
    return _dot(a, b)


def negative_inner_product(a: Column, b: Column) -> Column:
    return -_dot(a, b)


def cosine_distance(a: Column, b: Column) -> Column:
    size = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    return F.when(size > 0, 1 - _dot(a, b) / size)


METRICS = {"l2": l2_distance, "cosine": cosine_distance, "inner_product": negative_inner_product}


def _pairs(metric: str, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Distances of some rows from one query, entry by entry as the column functions do; NaN where there is none."""
    if metric == "l2":
        return np.sqrt(((rows - query) ** 2).sum(axis=1))
    dot = (rows * query).sum(axis=1)
    if metric == "inner_product":
        return -dot
    size = np.sqrt((rows ** 2).sum(axis=1)) * np.sqrt((query ** 2).sum())
    with np.errstate(all="ignore"):
        return np.where(size > 0, 1 - dot / size, np.nan)


def _near(metric: str, rows: np.ndarray, queries: np.ndarray, k: int):
    """(query, row) numbers that may be among the k nearest of these rows: by a matrix product, with room for its rounding."""
    dot = queries @ rows.T
    if metric == "l2":
        score = (queries ** 2).sum(axis=1)[:, None] + (rows ** 2).sum(axis=1)[None, :] - 2 * dot
    elif metric == "cosine":
        with np.errstate(all="ignore"):
            score = 1 - dot / np.sqrt((queries ** 2).sum(axis=1)[:, None] * (rows ** 2).sum(axis=1)[None, :])
    else:
        score = -dot
    score = np.where(np.isnan(score), np.inf, score)
    if len(rows) > k:
        bound = np.partition(score, k - 1, axis=1)[:, k - 1: k]
        room = 1e-9 * (np.abs(np.where(np.isinf(score), 0, score)).max(axis=1, keepdims=True) + 1)
        return np.nonzero(score <= bound + room)
    return np.nonzero(np.isfinite(score))


def _task_best(ids: list, vectors: np.ndarray, metric: str, k: int, batches):
    """The k nearest of a task's rows for each query of a block. Rows and queries meet in tiles of TILE_NUMBERS distances at most."""
    best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    some_rows = max(1, min(BATCH_ROWS, TILE_NUMBERS // vectors.shape[1]))
    for batch in batches:
        for at in range(0, batch.num_rows, some_rows):
            part = batch.slice(at, some_rows)
            # Only rows of the queries' width without nulls have a distance.
            lists = part.column(1).to_pylist()
            fit = [i for i, v in enumerate(lists) if v is not None and len(v) == vectors.shape[1] and None not in v]
            if not fit:
                continue
            rows = np.array([lists[i] for i in fit], float)
            own = np.array([part.column(0)[i].as_py() for i in fit])
            some_queries = max(1, TILE_NUMBERS // len(rows))
            for first in range(0, len(vectors), some_queries):
                tile = vectors[first: first + some_queries]
                query, row = _near(metric, rows, tile, k)
                bounds = np.searchsorted(query, np.arange(len(tile) + 1))
                for q in range(len(tile)):
                    some = row[bounds[q]: bounds[q + 1]]
                    distance = _pairs(metric, rows[some], tile[q])
                    keep = ~np.isnan(distance)
                    distance, found = distance[keep], own[some][keep]
                    if first + q in best:
                        near, ids_near = best[first + q]
                        distance, found = np.concatenate([near, distance]), np.concatenate([ids_near, found])
                    order = np.lexsort((found, distance))[:k]
                    best[first + q] = distance[order], found[order]
    for q, (distance, found) in best.items():
        yield pa.RecordBatch.from_pydict({"query_id": pa.array([ids[q]] * len(found)), "id": pa.array(found), "distance": pa.array(distance, pa.float64())})


BATCH_ROWS = 2000
BLOCK_NUMBERS = 1 << 20  # numbers of a block of queries, 8 MB
TILE_NUMBERS = 1 << 19  # distances that a task works out at once, 4 MB; it holds a few arrays of this size
SALTS = 64


def nearest(df: DataFrame, vector: str, queries: DataFrame, k: int, id_column: str, metric: str = "l2", query_vector: str | None = None, query_id: str | None = None) -> DataFrame:
    """The `k` rows closest to each query vector: query_id, id, distance, position (from 1; of equal distances the smaller id first).

    `queries` is a table of any size: it goes over the rows block by block (BLOCK_NUMBERS numbers a block), so work grows with queries times rows, as
    an exact search asks for. Every task keeps its own k best rows for each query, which any k allows, and these meet in
    two steps: k of each salt, then k of all. A row or query that is null, holds a null or differs in width has no distance and no row here.
    """
    rows = df.select(F.col(quote(id_column)).alias("id"), F.col(quote(vector)).cast("array<double>").alias("v")).filter("v IS NOT NULL")
    asked = queries.select(F.col(quote(query_id or id_column)).alias("query_id"), F.col(quote(query_vector or vector)).cast("array<double>").alias("q")).filter("q IS NOT NULL AND NOT exists(q, x -> x IS NULL)")
    widths = {r.w: r.n for r in asked.groupBy(F.size("q").alias("w")).agg(F.count("*").alias("n")).collect()}  # a row for each width of vectors
    schema = f"query_id {asked.schema['query_id'].dataType.simpleString()}, id {rows.schema['id'].dataType.simpleString()}, distance double"
    found = df.sparkSession.createDataFrame([], schema)
    for width, count in sorted(widths.items()):
        if width < 1:
            continue
        blocks = -(-count * width // BLOCK_NUMBERS)
        for block in range(blocks):
            here = asked.filter((F.size("q") == width) & (F.pmod(F.xxhash64("query_id", "q"), F.lit(blocks)) == block)).collect()  # about BLOCK_NUMBERS numbers
            if here:
                here.sort(key=lambda r: (r.query_id is None, r.query_id))
                work = partial(_task_best, [r.query_id for r in here], np.array([r.q for r in here], float), metric, k)
                found = found.unionByName(rows.mapInArrow(lambda b, f=work: f(b), schema))
    salted = found.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    some = salted.withColumn("place", F.row_number().over(Window.partitionBy("query_id", "salt").orderBy("distance", "id"))).filter(F.col("place") <= k)
    best = Window.partitionBy("query_id").orderBy("distance", "id")
    return some.select("query_id", "id", "distance", F.row_number().over(best).alias("position")).filter(F.col("position") <= k)
