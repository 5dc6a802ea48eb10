"""Language identification with hyperdimensional profiles.

Every letter has a random vector of DIMENSIONS signs, drawn from a hash of its code point. A letter triple is bound
from the vectors of its letters, of which the first is permuted twice and the second once (the permutation
is a rotation by one place), so that order counts. A text is the bundle, the sum, of the vectors of
all its triples; a language's prototype is the sum of its texts' bundles at unit length, and a text has the language
of the prototype with the largest cosine.

Letters are Unicode letters in lower case; whatever stands between two words counts as one blank, and triples do not reach over
it. Bundles of many texts at a time are a product of their triple counts and the triples' vectors, in slices of
bounded size, so a text may be of any length. Prototypes are sums of whole numbers: no order of adding changes them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftline.llm.text import mixed

DIMENSIONS = 1024
UNIT = 1 << 20  # length of a bundle that is added to a prototype
MOST_LANGUAGES = 10_000  # 80 MB of prototypes; a column with more values holds no languages
NONE = "und"

SLICE_LETTERS = 1 << 19  # letters counted at once
SLICE_TEXTS = 256
SLICE_TRIPLES = 4096  # vectors of triples held at once

_FOLDED: list[np.ndarray] = []


def _folded() -> np.ndarray:
    """Code point -> code point in lower case, or 0 for what is no letter."""
    if not _FOLDED:
        table = np.zeros(0x110000, np.uint32)
        for code in range(0x110000):
            letter = chr(code)
            if letter.isalpha():
                low = letter.lower()
                table[code] = ord(low) if len(low) == 1 else code
        _FOLDED.append(table)
    return _FOLDED[0]


def letters(text: str | None) -> np.ndarray:
    """Code points of the letters, with one 0 between words and at either end; a text without letters is a single 0."""
    codes = _folded()[np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")]
    codes = np.concatenate([[0], codes, [0]]).astype(np.uint32)
    return codes[np.r_[True, (codes[1:] != 0) | (codes[:-1] != 0)]]


def letter_vectors(codes: np.ndarray) -> np.ndarray:
    """Signs (int8) of each code point; the blank, 0, has a vector as well."""
    words = np.arange(DIMENSIONS // 64, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bits = mixed(mixed(codes.astype(np.uint64)[:, None] + np.uint64(1)) + words)
    return (np.unpackbits(bits.view(np.uint8), axis=1).astype(np.int8) << 1) - 1


def _slices(texts):
    """Lists of (text number, letters): each of bounded size; a long text's parts overlap by two letters."""
    part, size = [], 0
    for number, text in enumerate(texts):
        codes = letters(text)
        for start in range(0, max(1, len(codes) - 2), SLICE_LETTERS):
            piece = codes[start: start + SLICE_LETTERS + 2]
            if part and (size + len(piece) > SLICE_LETTERS or len(part) == SLICE_TEXTS):
                yield part
                part, size = [], 0
            part.append((number, piece))
            size += len(piece)
    if part:
        yield part


def _numbered(values: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values (all below end), ascending, and the place of each value among them."""
    if end > 1 << 24:
        return np.unique(values, return_inverse=True)
    seen = np.zeros(end, bool)
    seen[values] = True
    place = np.cumsum(seen) - 1
    return np.flatnonzero(seen), place[values]


def bundles(texts: list[str | None]) -> np.ndarray:
    """One row of DIMENSIONS whole numbers (as doubles) a text; zeros for a text without letters."""
    out = np.zeros((len(texts), DIMENSIONS))
    for part in _slices(texts):
        codes = np.concatenate([piece for _, piece in part])
        owner = np.repeat(np.arange(len(part)), [len(piece) for _, piece in part])
        known, place = _numbered(codes, int(codes.max()) + 1)
        # A triple has a letter in the middle and lies in one text.
        at = np.flatnonzero((codes[1:-1] != 0) & (owner[:-2] == owner[2:]))
        if not len(at):
            continue
        k = len(known)
        distinct, column = _numbered((place[at] * k + place[at + 1]) * k + place[at + 2], k ** 3)
        base = letter_vectors(known)
        once, twice = np.roll(base, 1, axis=1), np.roll(base, 2, axis=1)
        total = np.zeros((len(part), DIMENSIONS), np.float32)  # exact: counts stay below 2**24
        for start in range(0, len(distinct), SLICE_TRIPLES):
            some = distinct[start: start + SLICE_TRIPLES]
            bound = twice[some // (k * k)] * once[some // k % k] * base[some % k]
            here = np.flatnonzero((column >= start) & (column < start + len(some)))
            counts = np.bincount(owner[at[here]] * len(some) + column[here] - start, minlength=len(part) * len(some))
            total += counts.reshape(len(part), len(some)).astype(np.float32) @ bound.astype(np.float32)
        for (number, _), row in zip(part, total):
            out[number] += row
    return out


def _units(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Bundles at unit length, and which texts have letters."""
    whole = bundles(texts)
    length = np.sqrt((whole ** 2).sum(axis=1))
    some = np.array([len(letters(t)) > 1 if not n else True for t, n in zip(texts, length)], bool)
    return whole / np.where(length > 0, length, 1)[:, None], some


def _parts(batch: pa.RecordBatch):
    for at in range(0, batch.num_rows, SLICE_TEXTS):
        yield batch.slice(at, SLICE_TEXTS)


def _sums(batches):
    """This task's sum for each language: lang, place, value."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in _parts(batch):
            units, _ = _units(part.column("text").to_pylist())
            units = np.rint(units * UNIT).astype(np.int64)
            langs = np.array(part.column("lang").to_pylist(), object)
            for lang in set(langs):
                sums[lang] = sums.get(lang, 0) + units[langs == lang].sum(axis=0)
    for lang, total in sums.items():
        yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * DIMENSIONS, pa.string()), "place": pa.array(range(DIMENSIONS), pa.int32()), "value": pa.array(total, pa.int64())})


@dataclass(frozen=True)
class Model:
    languages: list[str]
    prototypes: np.ndarray  # one row of unit length a language


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Prototypes of all languages in docs. Rows without a language are not used; texts without letters add nothing.

    All rows are used. No rows, or no language with letters, give a model without languages.
    """
    known = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("lang is not null and text is not null")
    # At most DIMENSIONS rows for each task and language leave Python; Spark adds them up.
    sums = known.mapInArrow(_sums, "lang string, place int, value long").groupBy("lang", "place").agg(F.sum("value").alias("value"))
    found = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("v")).select("lang", "v.value").limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MOST_LANGUAGES} values")
    rows = {r.lang: np.array(r.value, float) for r in found}
    languages = sorted(lang for lang, v in rows.items() if v.any())
    units = [rows[x] / np.sqrt((rows[x] ** 2).sum()) for x in languages]
    return Model(languages, np.array(units).reshape(-1, DIMENSIONS))


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and cosine (0 at least) of each text; of equal cosines the first language by name."""
    units, some = _units(texts)
    if not model.languages:
        return [NONE] * len(texts), np.zeros(len(texts))
    cosines = units @ model.prototypes.T
    best = cosines.argmax(axis=1)
    score = np.clip(cosines[np.arange(len(texts)), best], 0, 1)
    return [model.languages[b] if s else NONE for b, s in zip(best, some)], np.where(some, score, 0.0)


def _detect(model: Model, batches):
    for batch in batches:
        for part in _parts(batch):
            lang, score = predict(model, part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])


def detect(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred and score, the cosine (0 to 1).

    A text that is null or has no letter is `und` with score 0, and so is every text if the model has no languages. Rows
    of equal id are judged each by itself. Other columns are not read. An empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        lambda batches, f=partial(_detect, model): f(batches), f"doc_id {kind}, lang_pred string, score double")
