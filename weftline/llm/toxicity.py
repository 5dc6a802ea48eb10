"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton on folded text.

Folding undoes disguises: compatibility forms, accents added over letters of other scripts, look-alike letters, digits
and signs inside words, invisible characters, repeated and spaced-out letters. The same folding
is used to learn the lexicon and to match it.

The lexicon holds stems (starts of words, or whole words) that occur far more often in toxic
than in other labelled texts, with their log odds as weights; exception phrases are words
beside a match that make it harmless. The summed weights and the sum per length enter a
logistic score. Learning uses at most SAMPLE_ROWS labelled rows (chosen by a hash of the id).
"""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftline.session import freeze

SAMPLE_ROWS = 12_000
LEXICON = 5_000  # stems a model may hold
STEM = (3, 14)  # characters of a stem
SURPRISE = 20.0  # nats by which a stem must beat chance; some 10**6 stems are tried

# --- fixed values: look-alikes and substitutions ---
LOOKS = dict(zip(
    "аеорсухіјѕԁһӏкмтвнαορνικτυγ" "ɑɡıʟ",
    "aeopcyxijsdhikmtbhaopvıktuy" "agil"))
SIGNS = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "€": "e", "|": "l", "!": "l", "+": "t"}
# --- end of fixed values ---
SAME = {"i": "l", "ı": "l"}  # 1, i and l stand for one another

WORDS_KEPT = 500_000  # folded words a worker remembers before it starts anew

_INVISIBLE = re.compile("[­͏؜ᅟᅠ឴឵᠎​-‏‪-‮⁠-⁯︀-️﻿]")
_MARKS = re.compile("[̀-ͯ]")
_LETTER = re.compile(r"[^\W\d_]")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_SIGN_EDGE = re.compile(r"^[^\w@$€]+|[^\w$]+$")
_SINGLES = re.compile(r"[^\W_](?:[.\-_*·][^\W_])+")
_REPEAT = re.compile(r"([^\W\d_])\1+")
_OTHER = re.compile(r"[\W_]+")
_LOOKS = str.maketrans(LOOKS)
_SIGNS = str.maketrans(SIGNS)
_SAME = str.maketrans(SAME)


def fold_word(word: str) -> str:
    """The folded form of what stands between white space: no, one or several words joined by a space."""
    if not word.isascii():
        word = unicodedata.normalize("NFKC", _MARKS.sub("", _INVISIBLE.sub("", word)))
    word = word.lower()
    if not word.isalpha():
        bare = _EDGES.sub("", word)
        if not bare.isalpha() or "@" in word or "$" in word:
            word = _SIGN_EDGE.sub("", word)
            if _SINGLES.fullmatch(word):
                word = _OTHER.sub("", word)
            if _LETTER.search(word):
                word = word.translate(_SIGNS)
        else:
            word = bare
    if not word.isascii():
        word = word.translate(_LOOKS)
    return _OTHER.sub(" ", _REPEAT.sub(r"\1", word.translate(_SAME))).strip()


class _Known(dict):
    def __missing__(self, word: str) -> str:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = got = fold_word(word)
        return got


_KNOWN = _Known()


def fold(text: str) -> str:
    """Folded words joined by one space, with a space at either end. Four or more letters standing alone are one word."""
    words = list(map(_KNOWN.__getitem__, text.split()))
    alone = [i for i, w in enumerate(words) if len(w) == 1]
    if len(alone) > 3:
        runs, start = [], 0
        for k in range(1, len(alone) + 1):
            if k == len(alone) or alone[k] != alone[k - 1] + 1:
                if k - start > 3:
                    runs.append((alone[start], alone[k - 1] + 1))
                start = k
        for a, b in reversed(runs):
            words[a:b] = [_REPEAT.sub(r"\1", "".join(words[a:b]))]
    return " " + " ".join(filter(None, words)) + " "


@dataclass(frozen=True)
class Model:
    """stems: ' start' or ' whole ' -> weight; exceptions: ' two words ' that are harmless; logistic weights."""

    stems: dict[str, float]
    exceptions: frozenset[str] = frozenset()
    logistic: tuple[float, float, float] = (-4.0, 1.0, 1.0)
    _automaton: list = field(default_factory=list, compare=False, repr=False)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_automaton"} | {"_automaton": []}

    def __setstate__(self, state):
        self.__dict__.update(state)

    def automaton(self):
        if not self._automaton:
            import ahocorasick

            made = ahocorasick.Automaton()
            for stem, weight in self.stems.items():
                made.add_word(stem, (len(stem), weight))
            made.make_automaton()
            self._automaton.append(made)
        return self._automaton[0]

    def matches(self, folded: str):
        """(word start, word end, weight) of the longest stem of each matching word that is no exception."""
        if not self.stems:
            return
        found: dict[int, float] = {}
        for end, (size, weight) in self.automaton().iter(folded):
            found[end - size + 2] = weight  # longer stems of a word come later
        for start, weight in found.items():
            end = folded.index(" ", start)
            if self.exceptions:
                before, after = folded.rfind(" ", 0, start - 1), folded.find(" ", end + 1)
                if folded[before:end + 1] in self.exceptions or after > 0 and folded[start - 1:after + 1] in self.exceptions:
                    continue
            yield start, end, weight

    def signals(self, folded: str) -> tuple[float, float, int]:
        """Log of the summed weights, log of their sum per 100 words, and the number of matches."""
        weights = [w for *_, w in self.matches(folded)]
        words = folded.count(" ") - 1
        total = sum(weights)
        return math.log1p(total), math.log1p(100 * total / (words + 20)), len(weights)

    def score(self, total: float, density: float) -> float:
        a, b, c = self.logistic
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, a + b * total + c * density))))


def _folded(batches):
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"toxic": batch.column("toxic"), "folded": pa.array([fold(x or "") for x in batch.column("text").to_pylist()], pa.string())})


def _contexts(model: Model, batches):
    """Phrases of a match and a neighbour, and whether the text is toxic."""
    for batch in batches:
        phrases, toxic = [], []
        for text, label in zip(batch.column("folded").to_pylist(), batch.column("toxic").to_pylist()):
            own = set()
            for start, end, _ in model.matches(text):
                before, after = text.rfind(" ", 0, start - 1), text.find(" ", end + 1)
                own |= ({text[before:end + 1]} if before >= 0 else set()) | ({text[start - 1:after + 1]} if after > 0 else set())
            phrases += own
            toxic += [label] * len(own)
        yield pa.RecordBatch.from_pydict({"phrase": pa.array(phrases, pa.string()), "toxic": pa.array(toxic, pa.int32())})


def _signals(model: Model, batches):
    for batch in batches:
        got = [model.signals(x)[:2] for x in batch.column("folded").to_pylist()]
        yield pa.RecordBatch.from_pydict({"toxic": batch.column("toxic"), "total": pa.array([g[0] for g in got], pa.float64()), "density": pa.array([g[1] for g in got], pa.float64())})


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps; weights of signals are not negative."""
    z, w = np.c_[np.ones(len(x)), x], np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z.T * (p * (1 - p))) @ z + np.diag([1e-6, 0.1, 0.1]), z.T @ (y - p) - np.array([1e-6, 0.1, 0.1]) * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), max(0.0, float(w[1])), max(0.0, float(w[2]))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from labelled rows. No labels, or labels of one kind only, give a model without stems."""
    chosen = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("toxic")).where("_id is not null and toxic is not null")
    # At most sample_rows rows of two numbers: small enough for every task.
    chosen = chosen.orderBy(F.xxhash64("_id"), "toxic").limit(sample_rows).collect()
    if not chosen:
        return Model({})
    chosen = docs.sparkSession.createDataFrame([tuple(x) for x in chosen], f"_id {labels.schema[id_col].dataType.simpleString()}, toxic int")
    sample = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "_id").select("toxic", "text")
    sample = sample.mapInArrow(_folded, "toxic int, folded string")
    # Near copies count once, or any word of a text that was copied often would look telling.
    start = F.slice(F.sort_array(F.transform(F.array_distinct(F.split("folded", " ")), lambda w: F.xxhash64(w))), 1, 4)
    sample = freeze(sample.withColumn("like", F.xxhash64(start)).dropDuplicates(["like", "toxic"]).drop("like"), "toxic-sample")
    counts = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, other = counts.get(1, 0), counts.get(0, 0)
    if not toxic or not other:
        return Model({})

    words = sample.select("toxic", F.explode(F.array_distinct(F.split(F.trim("folded"), " "))).alias("word"))
    starts = words.select("toxic", F.explode(F.array_distinct(F.expr(
        f"transform(sequence({STEM[0]}, {STEM[1]}), n -> if(n > length(word), concat(' ', word, ' '), concat(' ', left(word, n))))"))).alias("stem"), "word")
    found = starts.groupBy("stem").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    # A stem must beat chance, as bounded by its divergence from the base rate, among all the stems tried.
    share, base = F.col("t") / (F.col("t") + F.col("c")), toxic / (toxic + other)
    surprise = (F.col("t") + F.col("c")) * (share * F.log(share / base) + F.when(F.col("c") > 0, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0))
    weight = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (other + 1))
    found = found.where("t >= 4").withColumn("w", weight).where((F.col("w") >= 3) & (surprise >= SURPRISE)).orderBy(F.col("t").desc(), "stem").limit(LEXICON).collect()
    rows = {r.stem: (r.t, r.c, r.w) for r in found}

    # Of a chain of stems, the shortest that is as telling; then longer as long as it stands for the same texts.
    kept = {}
    for stem in sorted(rows, key=len):
        parents = [stem[:n] for n in range(2, len(stem)) if stem[:n] in rows]
        same = [p for p in parents if rows[p][0] <= 1.1 * rows[stem][0]]
        inner = [p for p in parents if p in kept]
        if inner and not any(p in same for p in inner):
            continue
        for p in inner:
            del kept[p]
        kept[stem] = rows[stem][2]
    model = Model(kept)
    if not kept:
        return model
    near = sample.mapInArrow(lambda x, f=partial(_contexts, model): f(x), "phrase string, toxic int")
    harmless = near.groupBy("phrase").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).where("c >= 3 and c >= 9 * t")
    harmless = frozenset(r.phrase for r in harmless.orderBy(F.col("c").desc(), "phrase").limit(LEXICON).collect())
    model = Model(kept, harmless)
    seen = sample.mapInArrow(lambda x, f=partial(_signals, model): f(x), "toxic int, total double, density double").toPandas()  # sample_rows rows
    return Model(kept, harmless, _logistic(seen[["total", "density"]].to_numpy(), seen["toxic"].to_numpy(float)))


def _score(model: Model, batches):
    for batch in batches:
        got = [model.signals(fold(x or "")) for x in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array([model.score(a, b) for a, b, _ in got], pa.float64()), "matches": pa.array([n for *_, n in got], pa.int32())})


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, score (0 to 1) and the number of matches. A null or empty text scores as one without matches.

    Rows of equal id are scored each by itself. Other columns are not read. An empty table gives no rows.
    """
    score = partial(_score, model)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(lambda x: score(x), f"doc_id {kind}, score double, matches int")
