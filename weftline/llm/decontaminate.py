"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. Benchmark items are taken in blocks of bounded size (a stated query set against all rows).
2. The n-grams are pairs of words one or two places apart. One pass over all documents counts in how many each pair of
   the items occurs. The rarest become seeds: so many that no copy of the wanted score can do without them (`Items`).
3. A second pass joins the documents' pairs to the seeds. Enough hits of an item near one
   diagonal give a passage, and the passage is aligned word by word with the whole item.
   The score is the best local alignment over that of a perfect copy.

Only counts of the items' own pairs are shuffled or collected; documents stay where they are.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftline.llm import text as T

MATCH, MISMATCH, GAP = 2, -1, -1
BLOCK_BYTES = 4 << 20  # benchmark text held by a task at once
REMEMBERED = 4096  # alignments of equal passages a task keeps
HITS = "doc_id long, item_id long, score double, matched int, first_word long, last_word long"

# Words are runs of ASCII letters and digits and of all bytes of other letters.
_BREAK = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def _tokens(column) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts and each word's text. Texts come in lower case."""
    data, offsets = T.text_bytes(column)
    starts, ends, doc = T.spans(_BREAK[data], offsets)
    return T.span_hashes(data, starts, ends), doc


def _pairs(hashes: np.ndarray, doc: np.ndarray, alone: bool) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of all pairs of words of a text that are one or two places apart, and of each word by itself if asked."""
    starts, found = [], []
    for apart in (1, 2):
        at = np.flatnonzero(doc[:-apart] == doc[apart:])
        starts.append(at)
        found.append(T.mixed(hashes[at] * np.uint64(T.BASES[1]) + T.mixed(hashes[at + apart])))
    if alone:
        starts.append(np.arange(len(hashes)))
        found.append(T.mixed(hashes ^ np.uint64(T.BASES[2])))
    return np.concatenate(starts), np.concatenate(found)


class Items:
    """A block of benchmark items: words, and the places of their pairs.

    Between two words that an alignment matches one after the other lie mismatches and gaps, which cost a point
    each. A score of `least` leaves so few points that of an item of n words `sure` = least * n - 1 such pairs at least are one or two places apart in
    both texts. So a copy has at least one of an item's pairs even if the commonest `sure` - 1 are not looked for. Half of them
    are not, and the other half must be found near one diagonal. An item of one word is sought as that word.
    """

    def __init__(self, rows: list[tuple[int, str]], least: float):
        hashes, doc = _tokens(pa.array([x for _, x in rows], pa.large_string()))
        bounds = np.searchsorted(doc, np.arange(len(rows) + 1))
        self.ids = [i for i, _ in rows]
        self.words = [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        size = np.array([len(w) for w in self.words], np.int64)
        sure = np.maximum(0, np.ceil(least * size - 1 - 1e-9)).astype(np.int64)
        self.left_out = sure // 2
        self.needed = np.maximum(1, sure - self.left_out)
        # Points for gaps: an alignment's diagonals are no farther apart.
        self.slack = np.floor(2 * size * (1 - least) + 1e-9).astype(np.int64)
        self.alone = bool((size == 1).any())
        at, grams = _pairs(hashes, doc, self.alone)
        item = doc[at]
        keep = (np.arange(len(at)) < len(at) - len(hashes) * self.alone) | (size[item] == 1)
        self.item, self.place, self.gram = item[keep], (at - bounds[item])[keep], grams[keep]

    def grams(self) -> np.ndarray:
        return np.unique(self.gram)

    def seeds(self, grams: np.ndarray, count: np.ndarray) -> "Seeds":
        """The pairs to look for: all that occur, less the commonest ones of each item."""
        often = count[np.searchsorted(grams, self.gram)]
        order = np.lexsort((self.place, self.gram, -often, self.item))
        rank = np.arange(len(order)) - np.searchsorted(self.item[order], self.item[order])
        kept = order[(rank >= self.left_out[self.item[order]]) & (often[order] > 0)]
        kept = kept[np.argsort(self.gram[kept], kind="stable")]
        listed, first = np.unique(self.gram[kept], return_index=True)
        return Seeds(listed, np.append(first, len(kept)), self.item[kept], self.place[kept])


@dataclass(frozen=True)
class Seeds:
    """Pairs in ascending order; those of number i stand in items and places from bounds[i] on."""

    grams: np.ndarray
    bounds: np.ndarray
    item: np.ndarray
    place: np.ndarray


def _found(sorted_grams: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which grams are listed, and where in the list."""
    at = np.minimum(np.searchsorted(sorted_grams, grams), len(sorted_grams) - 1)
    hit = np.flatnonzero(sorted_grams[at] == grams)
    return hit, at[hit]


def _slices(batches, rows: int = 256):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _count(listed: np.ndarray, alone: bool, batches):
    total = np.zeros(len(listed), np.int64)
    for batch in _slices(batches):
        hashes, doc = _tokens(batch.column("text"))
        at, grams = _pairs(hashes, doc, alone)
        hit, which = _found(listed, grams)
        pairs = np.unique(doc[at[hit]] * len(listed) + which)
        total += np.bincount(pairs % len(listed), minlength=len(listed))
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"gram": pa.array(seen, pa.int64()), "n": pa.array(total[seen], pa.int64())})


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int, int]:
    """Smith-Waterman with a linear gap: best score, equal words, first and last word of the passage.

    Rows follow the item; a row's own gaps are a running maximum.
    """
    n = len(passage)
    score = np.zeros((len(item) + 1, n + 1), np.int32)
    ramp = np.arange(n + 1) * GAP
    for i, word in enumerate(item):
        row = np.zeros(n + 1, np.int32)
        row[1:] = np.maximum(score[i, :-1] + np.where(passage == word, MATCH, MISMATCH), score[i, 1:] + GAP)
        row = np.maximum(row, 0)
        score[i + 1] = np.maximum.accumulate(row - ramp) + ramp
    best = int(score.argmax())
    i, j = divmod(best, n + 1)
    top, last, equal = int(score[i, j]), j - 1, 0
    while i and j and score[i, j] > 0:
        same = item[i - 1] == passage[j - 1]
        if score[i, j] == score[i - 1, j - 1] + (MATCH if same else MISMATCH):
            equal += bool(same)
            i, j = i - 1, j - 1
        elif score[i, j] == score[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return top, equal, j, last


def _begins(items: Items, seeds: Seeds, hashes: np.ndarray, doc: np.ndarray) -> dict[tuple[int, int], list[int]]:
    """(row, item) -> where the item would begin, of hits that enough others share a neighbourhood of diagonals with."""
    at, grams = _pairs(hashes, doc, items.alone)
    hit, which = _found(seeds.grams, grams)
    times = seeds.bounds[which + 1] - seeds.bounds[which]
    entry = np.repeat(seeds.bounds[which] - np.r_[0, np.cumsum(times)[:-1]], times) + np.arange(times.sum())
    item, place = seeds.item[entry], np.repeat(at[hit], times)
    begin, row = place - seeds.place[entry], doc[place]
    # Hits of one alignment lie in one cell or two neighbouring ones.
    width = items.slack[item] + 1
    cell = (begin + width * 2) // width
    order = np.lexsort((begin, cell, item, row))
    row, item, cell, begin = row[order], item[order], cell[order], begin[order]
    if not len(row):
        return {}
    heads = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (cell[1:] != cell[:-1])])
    size = np.diff(np.append(heads, len(row)))
    r, k, c = row[heads], item[heads], cell[heads]
    next_ = np.zeros(len(heads), np.int64)
    joined = (r[1:] == r[:-1]) & (k[1:] == k[:-1]) & (c[1:] == c[:-1] + 1)
    next_[:-1] = np.where(joined, size[1:], 0)
    before = np.zeros(len(heads), np.int64)
    before[1:] = np.where(joined, size[:-1], 0)
    enough = np.repeat(np.maximum(next_, before) + size >= items.needed[k], size)
    out: dict[tuple[int, int], list[int]] = defaultdict(list)
    for number, which_item, b in zip(row[enough].tolist(), item[enough].tolist(), begin[enough].tolist()):
        out[number, which_item].append(b)
    return out


def _hits(items: Items, seeds: Seeds, least: float, known: dict, column) -> list[tuple]:
    """(row, item number, score, equal words, first and last word) of the texts of one batch."""
    hashes, doc = _tokens(column)
    bounds = np.searchsorted(doc, np.arange(len(column) + 1))
    rows = []
    for (number, k), begins in sorted(_begins(items, seeds, hashes, doc).items()):
        item, slack = items.words[k], int(items.slack[k])
        low, high = int(bounds[number]), int(bounds[number + 1])
        best = None
        begins = sorted(set(begins))
        groups = [[begins[0], begins[0]]]
        for b in begins[1:]:
            if b - groups[-1][1] <= slack and b - groups[-1][0] <= 4 * len(item):
                groups[-1][1] = b
            else:
                groups.append([b, b])
        for a, b in groups:
            a, b = max(low, a - slack), min(high, b + len(item) + slack)
            passage = hashes[a:b]
            key = (k, passage.tobytes())
            if key not in known:
                if len(known) >= REMEMBERED:
                    known.clear()
                # A score of `least` takes so many equal words at least.
                known[key] = align(item, passage) if np.isin(item, passage).sum() >= least * len(item) else (0, 0, 0, 0)
            top, equal, first, last = known[key]
            if best is None or top > best[0]:
                best = top, equal, a - low + first, a - low + last
        score = best[0] / (MATCH * len(item))
        if score >= least:
            rows.append((number, k, score, *best[1:]))
    return rows


def _search(items: Items, seeds: Seeds, least: float, batches):
    known: dict = {}
    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int64(), pa.int64())
    for batch in _slices(batches):
        if rows := _hits(items, seeds, least, known, batch.column("text")):
            ids = batch.column("doc_id").to_pylist()
            rows = [(ids[r], items.ids[k], *rest) for r, k, *rest in rows]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["doc_id", "item_id", "score", "matched", "first_word", "last_word"])


def _drop(items: Items, seeds: Seeds, least: float, batches):
    """Rows without a hit; the last column is the text in lower case and goes."""
    known: dict = {}
    for batch in _slices(batches):
        clean = np.ones(batch.num_rows, bool)
        clean[[r for r, *_ in _hits(items, seeds, least, known, batch.columns[-1])]] = False
        yield pa.RecordBatch.from_arrays(batch.columns[:-1], schema=pa.schema(list(batch.schema)[:-1])).filter(pa.array(clean))


def _query_blocks(rows: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str, least: float):
    """(items, seeds) of each block of the benchmark; rows has the lower-cased `text` of all documents."""
    asked = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.lower(F.col(item_text_col)).alias("text")).where("text is not null").distinct()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    for block in range(blocks):
        listed = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()  # about BLOCK_BYTES
        items = Items(sorted((tuple(x) for x in listed), key=lambda x: (x[0] is not None, x[0] or 0, x[1])), least)
        grams = items.grams()
        if len(grams):
            count = partial(_count, grams, items.alone)
            counted = rows.select("text").mapInArrow(lambda x, f=count: f(x), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()  # pairs of this block
            often = np.zeros(len(grams), np.int64)
            for r in counted:
                often[r.gram] = r.n
            seeds = items.seeds(grams, often)
            if len(seeds.grams):
                yield items, seeds


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least: float = 0.5) -> DataFrame:
    """(doc_id, item_id, score, matched, first_word, last_word) of every document row that holds an item.

    score is 1 for a whole copy; rows below `least` are left out. For items of three words or more, what is found is what aligning
    every item with every text would find; one or two words must stand with at most one word between them. first_word and last_word are places in the
    document's words (letters and digits only). An item or text that is null or has no words matches nothing;
    rows of equal doc_id each count, equal items give one row each. Other columns are not read. An empty table on
    either side gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.lower(F.col(text_col)).alias("text")).where("text is not null")
    out = docs.sparkSession.createDataFrame([], HITS)
    for items, seeds in _query_blocks(rows, benchmark, item_col, item_text_col, least):
        search = partial(_search, items, seeds, least)
        out = out.unionByName(rows.mapInArrow(lambda x, f=search: f(x), HITS))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of docs that hold no benchmark item, with all their columns, by the rules of `contaminated`."""
    out = T.numbered(docs)  # whatever the columns are called
    text = F.lower(F.col(out.columns[docs.columns.index(text_col)]))
    schema = out.schema
    for items, seeds in _query_blocks(out.select(text.alias("text")), benchmark, item_col, item_text_col, least):
        drop = partial(_drop, items, seeds, least)
        out = out.select("*", text.alias("lower")).mapInArrow(lambda x, f=drop: f(x), schema)
    return out.toDF(*docs.columns)
