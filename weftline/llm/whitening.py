"""Whitening of embeddings by the singular values of their centred rows.

Entries become whole numbers x = floor(256 c), so sums are exact. The fit list is each distinct x vector once. Every task
reduces its centred rows block by block to the triangular factor of their QR factorisation; factors of FAN tasks
are reduced to one in rounds, and the last few to one on the driver: a square matrix of as many rows as a vector has entries,
whatever the number of vectors. `singular.top_directions` makes it bidiagonal, and its singular values s and right singular
vectors give the covariance's eigenvalues s^2 / n and components without forming products of rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftline.llm.singular import top_directions
from weftline.session import freeze

FAN = 16  # triangular factors reduced to one at a time
MOST_DIMENSIONS = 4096  # a factor has 8 * MOST_DIMENSIONS ** 2 bytes, 128 MB
BLOCK_VALUES = 1 << 19  # entries of a block of rows
LONGEST = (1 << 63) - 1


@dataclass(frozen=True)
class Whitening:
    """What `fit` finds; nothing in it grows with the rows."""

    dims: int
    n: int  # rows of the fit list
    sums: list[int]  # of the fit list, for each dimension
    eigenvalues: np.ndarray  # falling; none that is 0 to double precision
    components: np.ndarray  # a row of unit length each
    explained: np.ndarray
    identity_error: float = 0.0

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        """n x - S: exact whole numbers, as Python's where 64 bits might not hold them."""
        largest = max(map(abs, (int(x.max(initial=0)), int(x.min(initial=0)))))
        if self.n * largest + max(map(abs, self.sums), default=0) < 1 << 62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self._scaled(x) / self.n).astype(float)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 of each row; None where a long cannot hold it."""
        scaled = self._scaled(x)
        if scaled.dtype != object and float(np.abs(scaled).max(initial=0)) ** 2 * max(1, self.dims) < 2.0 ** 62:
            return (scaled * scaled).sum(axis=1).tolist()
        totals = (scaled.astype(object) ** 2).sum(axis=1) if self.dims else [0] * len(x)
        return [t if t <= LONGEST else None for t in totals]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components.T / np.sqrt(self.eigenvalues)


def _quantised(dims: int, batches):
    """id and x (little-endian 64-bit entries) of rows whose entries are all finite."""
    for batch in batches:
        step = max(1, BLOCK_VALUES // max(1, dims))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            vectors = part.column(1)
            if not pa.types.is_large_list(vectors.type):
                vectors = vectors.cast(pa.large_list(pa.float64()))
            offsets = vectors.offsets.to_numpy()
            values = vectors.values.slice(offsets[0], offsets[-1] - offsets[0])
            numbers = values.to_numpy(zero_copy_only=False).astype(float)  # nulls are NaN
            offsets = offsets - offsets[0]
            size = np.diff(offsets)
            bad = np.r_[0, np.cumsum(~np.isfinite(numbers))]
            keep = (bad[offsets[1:]] == bad[offsets[:-1]]) & ~vectors.is_null().to_numpy(zero_copy_only=False)
            with np.errstate(all="ignore"):
                scaled = np.floor(256 * np.where(np.isfinite(numbers), numbers, 0))
            whole = np.where(scaled >= 2.0 ** 63, LONGEST, np.where(scaled < -2.0 ** 63, -LONGEST - 1, np.clip(scaled, -2.0 ** 63, 2.0 ** 63 - 1025)).astype(np.int64))
            padded = np.zeros((part.num_rows, dims), "<i8")
            row = np.repeat(np.arange(part.num_rows), size)
            padded[row, np.arange(len(whole)) - np.repeat(offsets[:-1], size)] = whole
            padded = padded[keep]
            raw = pa.array([r.tobytes() for r in padded], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(keep)), raw], names=["id", "x"])


def _vectors(column, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), dims)


def _slices(dims: int, batches):
    step = max(1, BLOCK_VALUES // max(1, dims))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def _sums(dims: int, batches):
    """This task's sums for each place; the number of rows has the place -1."""
    total, rows = [0] * dims, 0
    for part in _slices(dims, batches):
        x = _vectors(part.column("x"), dims)
        rows += len(x)
        small = np.abs(x.astype(float)).max(initial=0) < 2.0 ** 40
        added = x.sum(axis=0) if small else x.astype(object).sum(axis=0)
        total = [a + int(b) for a, b in zip(total, added)]
    if rows:
        yield pa.RecordBatch.from_pydict({"place": pa.array(range(-1, dims), pa.int32()), "total": pa.array([str(v) for v in [rows, *total]], pa.string())})


def _factor(first: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows if first is None else np.vstack([first, rows]), mode="r")


def _factors(model: Whitening, batches):
    """The triangular factor of this task's centred rows."""
    from pyspark import TaskContext

    factor = None
    for part in _slices(model.dims, batches):
        if part.num_rows:
            factor = _factor(factor, model.centred(_vectors(part.column("x"), model.dims)))
    if factor is not None:
        yield pa.RecordBatch.from_pydict({"place": pa.array([TaskContext.get().partitionId()], pa.int64()), "factor": pa.array([factor.tobytes()], pa.binary())})


def _reduced(dims: int, key, table: pa.Table) -> pa.Table:
    """One factor for the FAN or fewer of a group."""
    factor = None
    for raw in table.sort_by("place").column("factor").to_pylist():
        factor = _factor(factor, np.frombuffer(raw).reshape(-1, dims))
    return pa.table({"place": pa.array([key[0].as_py()], pa.int64()), "factor": pa.array([factor.tobytes()], pa.binary())})


def _moments(model: Whitening, batches):
    """This task's sums of whitened entries (place i, -1) and of their products (i, j)."""
    k = len(model.eigenvalues)
    total = np.zeros((k, k + 1))
    for part in _slices(model.dims, batches):
        w = model.whitened(_vectors(part.column("x"), model.dims))
        total += np.c_[w.T @ w, w.sum(axis=0)]
    i, j = np.indices(total.shape)
    yield pa.RecordBatch.from_pydict({"i": pa.array(i.ravel(), pa.int32()), "j": pa.array(j.ravel(), pa.int32()), "value": pa.array(total.ravel(), pa.float64())})


def _rows(rows: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    picked = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    dims = picked.agg(F.max(F.size("vector"))).first()[0] or 0
    if dims > MOST_DIMENSIONS:
        raise ValueError(f"vectors have up to {dims} entries; {MOST_DIMENSIONS} at most are whitened")
    return picked, max(0, dims)


def _exact(picked: DataFrame, dims: int) -> DataFrame:
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(lambda b, f=partial(_quantised, dims): f(b), f"id {kind}, x binary")


def fit(rows: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> Whitening:
    """Up to `components` components of the distinct x vectors of rows; fewer where the covariance has a lower rank."""
    picked, dims = _rows(rows, id_col, vector_col)
    listed = freeze(_exact(picked, dims).select("x").distinct(), "fit-list")
    sums = listed.mapInArrow(lambda b, f=partial(_sums, dims): f(b), "place int, total string")
    found = dict(sums.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total")).collect())  # a row for each dimension
    n = int(found.get(-1, 0))
    empty = np.zeros(0)
    model = Whitening(dims, n, [int(found.get(i, 0)) for i in range(dims)], empty, np.zeros((0, dims)), empty)
    if not n or not dims:
        return model
    factors = freeze(listed.mapInArrow(lambda b, f=partial(_factors, model): f(b), "place long, factor binary"), "factors")
    while factors.count() > FAN:
        grouped = factors.groupBy(F.floor(F.col("place") / FAN).alias("group"))
        factors = freeze(grouped.applyInArrow(lambda key, table, d=dims: _reduced(d, key, table), "place long, factor binary"), "factors")
    last = [np.frombuffer(r.factor).reshape(-1, dims) for r in factors.orderBy("place").collect()]  # FAN factors at most
    factor = np.linalg.qr(np.vstack(last), mode="r")
    square = np.zeros((dims, dims))
    square[: len(factor)] = factor
    values, directions = top_directions(square, components)
    total = float((square ** 2).sum())
    model = Whitening(dims, n, model.sums, values ** 2 / n, directions, values ** 2 / total if total else values)
    sums = listed.mapInArrow(lambda b, f=partial(_moments, model): f(b), "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect()  # a few rows
    k = len(values)
    moments = np.zeros((k, k + 1))
    for r in sums:
        moments[r.i, r.j] = r.value / n
    covariance = moments[:, :k] - np.outer(moments[:, k], moments[:, k])
    return Whitening(dims, n, model.sums, model.eigenvalues, directions, model.explained, float(np.abs(covariance - np.eye(k)).max(initial=0)))


def _whitened(model: Whitening, batches):
    k = len(model.eigenvalues)
    for part in _slices(model.dims, batches):
        x = _vectors(part.column("x"), model.dims)
        rows = len(x)
        times = lambda a: np.tile(a, rows)
        yield pa.RecordBatch.from_arrays([
            part.column("id").take(pa.array(np.repeat(np.arange(rows), k))), pa.array(times(np.arange(1, k + 1)), pa.int32()), pa.array(np.full(rows * k, model.n), pa.int64()),
            pa.array([d for d in model.deviations(x) for _ in range(k)], pa.int64()), pa.array(model.whitened(x).ravel(), pa.float64()),
            pa.array(times(model.explained), pa.float64()), pa.array(np.full(rows * k, model.identity_error), pa.float64())],
            names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


def whiten(rows: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row and component: id_col, component (from 1), n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds a null, NaN or infinite entry are left out. Shorter vectors count as filled up with zeros, and
    entries beyond a long as the nearest long; a deviation beyond a long is null. Equal rows, and rows of
    equal id or without one, give a result each. Vectors of one distinct kind only, empty ones and an empty table have no component
    and give no rows. Other columns are not read.
    """
    picked, dims = _rows(rows, id_col, vector_col)
    if dims > model.dims:
        raise ValueError(f"vectors of {dims} entries, but {model.dims} were fitted")
    kind = picked.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    out = _exact(picked, model.dims).mapInArrow(lambda b, f=partial(_whitened, model): f(b), schema)
    return out.withColumnRenamed("id", id_col)
