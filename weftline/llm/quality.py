"""Quality classifier: random Fourier features, ridge regression and isotonic calibration.

Statistics of whole texts are computed batch by batch. Random Fourier features stand for a Gaussian
kernel on them; every task adds up its part of the normal equations, and a tree of sums brings one matrix
to the driver. Ridge scores of the training rows, counted in BINS bins, are calibrated
by pooling adjacent violators. All labelled rows are used.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from weftline.llm import text as T
from weftline.session import freeze

FEATURES = 256  # random features
BINS = 2000
FAN = 8  # matrices added at a time
SEED = 20240501
STATISTICS = [
    "log_bytes", "log_words", "word_mean", "word_spread", "capitals", "digits", "signs", "bars", "high_bytes", "spaces", "sign_ends", "sign_words",
    "distinct_words", "repeats_before", "distinct_triples", "top_word", "log_lines", "line_words", "distinct_lines", "capital_words", "long_words", "tripled",
]

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_SIGN = ~(_LETTER | _DIGIT | T.SPACE)
_PLAIN = np.zeros(256, bool)
_PLAIN[[ord(c) for c in ".,;:'\"()-?"]] = True


def _distinct(keys: np.ndarray, owner: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each document and the greatest count of one."""
    if not len(keys):
        return np.zeros(docs), np.zeros(docs)
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    heads = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (o[1:] != o[:-1])])
    top = np.zeros(docs)
    np.maximum.at(top, o[heads], np.diff(np.r_[heads, len(k)]))
    return np.bincount(o[heads], minlength=docs).astype(float), top


def statistics(column) -> np.ndarray:
    """One row of STATISTICS a text. Shares of nothing are 0."""
    data, offsets = T.text_bytes(column)
    docs, size = len(offsets) - 1, np.diff(offsets).astype(float)
    per = lambda flags: np.diff(np.r_[0, np.cumsum(flags)][offsets]).astype(float)
    starts, ends, doc = T.words(data, offsets)
    words = np.bincount(doc, minlength=docs).astype(float)
    of_words = lambda x: np.bincount(doc, weights=x, minlength=docs)
    a, b = np.maximum(size, 1), np.maximum(words, 1)
    length = (ends - starts).astype(float)
    mean = of_words(length) / b
    spread = np.sqrt(np.maximum(0, of_words(length ** 2) / b - mean ** 2))
    hashes = T.span_hashes(data, starts, ends)
    upto = np.r_[0, np.cumsum(_LETTER[data] | _DIGIT[data])]
    no_letters = upto[ends] == upto[starts]
    upper, letters = np.r_[0, np.cumsum(_UPPER[data])], np.r_[0, np.cumsum(_LETTER[data])]
    all_upper = (upper[ends] - upper[starts] >= 2) & (upper[ends] - upper[starts] == letters[ends] - letters[starts])
    odd_end = (_SIGN[data] & ~_PLAIN[data])[ends - 1] if len(ends) else np.zeros(0, bool)
    before = np.r_[False, (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])] if len(doc) else np.zeros(0, bool)
    distinct, top = _distinct(hashes, doc, docs)
    at, triples = T.gram_hashes(hashes, doc, 3)
    n_triples = np.maximum(1, np.bincount(doc[at], minlength=docs))
    line_at, line_to, line_doc = T.spans(data == 10, offsets)
    lines = np.bincount(line_doc, minlength=docs).astype(float)
    tripled = np.zeros(len(data), bool)
    tripled[2:] = (data[2:] == data[1:-1]) & (data[2:] == data[:-2])
    with np.errstate(all="ignore"):
        return np.c_[
            np.log1p(size), np.log1p(words), mean, spread, per(_UPPER[data]) / a, per(_DIGIT[data]) / a, per(_SIGN[data]) / a, per(data == 124) / a, per(data >= 128) / a,
            per(T.SPACE[data]) / a, of_words(odd_end) / b, of_words(no_letters) / b, distinct / b, of_words(before) / b, _distinct(triples, doc[at], docs)[0] / n_triples, top / b,
            np.log1p(lines), np.log1p(words / np.maximum(lines, 1)), _distinct(T.span_hashes(data, line_at, line_to), line_doc, docs)[0] / np.maximum(lines, 1),
            of_words(all_upper) / b, of_words(length > 30) / b, per(tripled) / a]


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None  # None: no labels of both kinds, every text scores `base`
    edges: np.ndarray  # calibration: ridge scores from edges[i] on get levels[i]
    levels: np.ndarray
    base: float = 0.5

    def features(self, x: np.ndarray) -> np.ndarray:
        random = np.random.default_rng(SEED)
        w, shift = random.normal(size=(x.shape[1], FEATURES)) / np.sqrt(x.shape[1]), random.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.c_[np.ones(len(z)), np.sqrt(2 / FEATURES) * np.cos(z @ w + shift)]

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.features(x) @ self.weights, -1, 2)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.base)
        return np.interp(self.ridge(x), self.edges, self.levels)


def _measure(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            x = statistics(part.column(1))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(x.astype(float)), pa.list_(pa.float64()))], names=["doc_id", "x"])


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the statistics x of every row, written to the shared folder once."""
    kind = docs.schema[id_col].dataType.simpleString()
    return freeze(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_measure, f"doc_id {kind}, x array<double>"), "statistics")


def _matrix(batch) -> np.ndarray:
    return np.array(batch.column("x").to_pylist(), float).reshape(batch.num_rows, len(STATISTICS))


def _equations(model: Model, batches):
    """This task's sums z'z and z'y, as one row."""
    size = FEATURES + 1
    left, right, rows = np.zeros((size, size)), np.zeros(size), 0
    for batch in batches:
        if batch.num_rows:
            z, y = model.features(_matrix(batch)), batch.column("y").to_numpy()
            left += z.T @ z
            right += z.T @ y
            rows += batch.num_rows
    if rows:
        yield pa.RecordBatch.from_pydict({"slot": pa.array([TaskContext.get().partitionId()], pa.int64()), "sums": pa.array([np.r_[left.ravel(), right].tobytes()], pa.binary())})


def _added(key, table: pa.Table) -> pa.Table:
    """The sum of a group's matrices, FAN at most, in the order of their slots."""
    total = sum(np.frombuffer(x) for x in table.sort_by("slot").column("sums").to_pylist())
    return pa.table({"slot": pa.array([key[0].as_py()], pa.int64()), "sums": pa.array([total.tobytes()], pa.binary())})


def _scored(model: Model, batches):
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"bin": pa.array(np.round((model.ridge(_matrix(batch)) + 1) / 3 * BINS).astype(int), pa.int32()), "y": batch.column("y")})


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Pool adjacent violators."""
    pools: list[list[float]] = []
    for v, w in zip(values, weights):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v2, w2, n2 = pools.pop()
            v1, w1, n1 = pools.pop()
            pools.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in pools])


def learn(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", ridge: float = 1e-3) -> Model:
    """A model from `measured` rows and labels. Rows without a label or id are not used."""
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("y")).where("doc_id is not null and y is not null")
    train = freeze(stats.join(known, "doc_id"), "labelled")
    k = len(STATISTICS)
    sums = train.agg(F.count("*").alias("n"), F.sum("y").alias("y"), *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(k)], *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(k)]).first()
    if not sums.n or sums.y in (0, sums.n):
        return Model(np.zeros(k), np.ones(k), None, np.zeros(1), np.zeros(1), (sums.y or 0) / sums.n if sums.n else 0.5)
    mean, scale = np.array([sums[f"m{i}"] for i in range(k)]), np.array([max(sums[f"s{i}"], 1e-6) for i in range(k)])
    model = Model(mean, scale, None, np.zeros(1), np.zeros(1))
    parts = freeze(train.mapInArrow(lambda x, f=partial(_equations, model): f(x), "slot long, sums binary"), "equations")
    while parts.count() > FAN:
        groups = parts.groupBy(F.floor(F.col("slot") / FAN).alias("group"))
        parts = freeze(groups.applyInArrow(lambda key, table: _added(key, table), "slot long, sums binary"), "equations")
    total = sum(np.frombuffer(r["sums"]) for r in parts.orderBy("slot").collect())  # FAN matrices at most
    size = FEATURES + 1
    left, right = total[: size * size].reshape(size, size), total[size * size:]
    weights = np.linalg.solve(left + ridge * sums.n / size * np.eye(size), right)
    model = Model(mean, scale, weights, np.zeros(1), np.zeros(1))
    bins = train.mapInArrow(lambda x, f=partial(_scored, model): f(x), "bin int, y double").groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("y")).orderBy("bin").collect()  # BINS rows
    n, y = np.array([b.n for b in bins], float), np.array([b.y for b in bins])
    return Model(mean, scale, weights, np.array([b.bin for b in bins]) / BINS * 3 - 1, isotonic(y / n, n))


def _score(model: Model, batches):
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(model.score(_matrix(batch)), pa.float64())})


def score(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every `measured` row; empty and null texts are scored as texts of no bytes.

    Rows of equal id are scored each by itself. An empty table gives no rows.
    """
    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.mapInArrow(lambda x, f=partial(_score, model): f(x), f"doc_id {kind}, score double")


def _keep(model: Model, least: float, batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            good = model.score(statistics(part.columns[-1])) >= least
            yield pa.RecordBatch.from_arrays(part.columns[:-1], schema=pa.schema(list(part.schema)[:-1])).filter(pa.array(good))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of docs that score at least `least`, with all their columns, in one pass."""
    rows = T.numbered(docs)  # whatever the columns are called
    text = F.col(rows.columns[docs.columns.index(text_col)])
    return rows.select("*", text.alias("text")).mapInArrow(lambda x, f=partial(_keep, model, least): f(x), rows.schema).toDF(*docs.columns)
