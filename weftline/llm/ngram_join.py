"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence.

1. Blocks ask how common each n-gram is (`blocks.ask`). An n-gram of one document overlaps with
   nothing, so a document with fewer common n-grams than the size-derived bound
   ceil(0.8 * size) links to no other and is done.
2. Documents of equal sets are one class (aggregated before any shuffle of sets).
3. Two sets that link share one of the rarest size - ceil(0.8 * size) + 1 n-grams of
   each. These put classes into clusters; no pairs are formed for it.
4. In a cluster the rows of the incidence matrix are cut into blocks of BLOCK_ROWS; the product of
   two blocks accumulates overlap counts, column slice by column slice, and pairs outside the
   size bounds are not computed. Each product returns a spanning forest of its links.
5. Forests of clusters with several blocks are merged by `components`.

Nothing is capped; common n-grams only lower an n-gram's place in the order. The exact test
is on integers: 100 * overlap >= percent * union. N-grams are compared by 64-bit hashes.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from weftline.llm import blocks as B, text as T
from weftline.llm.components import components
from weftline.session import freeze

BLOCK_ROWS = 512
COLUMNS = 4096
SETS = "doc_id long, text_hash long, n_shingles long, d1 long, d2 long, prefix binary, grams binary"


class _Sets:
    """Distinct n-grams of each document of a block, ordered by document and hash."""

    def __init__(self, table: pa.Table, width: int):
        self.ids, table = B.id_order(table)
        self.nulls = table.column("doc_id").is_null().to_numpy()
        self.text_hash = table.column("text_hash")
        data, offsets = T.text_bytes(table.column("text"))
        data = T.lowered(data)
        starts, ends, doc = T.words(data, offsets)
        hashes = T.span_hashes(data, starts, ends)
        at, grams = T.gram_hashes(hashes, doc, width)
        owner = doc[at]
        docs = len(self.ids)
        bounds = np.searchsorted(doc, np.arange(docs + 1))
        short = np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < width))
        extra = [_whole(hashes[bounds[i]:bounds[i + 1]]) for i in short]
        if extra:
            grams, owner = np.r_[grams, np.array(extra, np.uint64)], np.r_[owner, short]
        order = np.lexsort((grams, owner))
        grams, owner = grams[order], owner[order]
        if len(grams):
            keep = np.r_[True, (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])]
            grams, owner = grams[keep], owner[keep]
        self.grams, self.owner = grams, owner
        order = np.argsort(grams)
        ordered = grams[order]
        new = np.r_[True, ordered[1:] != ordered[:-1]] if len(ordered) else np.zeros(0, bool)
        self.distinct = ordered[new]
        self.place = np.empty(len(grams), np.int64)
        self.place[order] = np.cumsum(new) - 1
        self.local = np.diff(np.r_[np.flatnonzero(new), len(ordered)])


def _whole(hashes: np.ndarray) -> np.uint64:
    """One n-gram for all the words of a document shorter than an n-gram."""
    out = np.uint64(0x2545F4914F6CDD1D) + np.uint64(len(hashes))
    for h in hashes:
        out = T.mixed(np.array([out], np.uint64) * np.uint64(T.BASES[2]) + h)[0]
    return out


def _send(width: int, bits: int, key, table: pa.Table) -> pa.Table:
    s = _Sets(table, width)
    return B.sent(key, *B.bucket_bounds(s.distinct, bits), (s.distinct >> np.uint64(32 - bits)).astype(np.uint32))


def _answer(table: pa.Table) -> pa.Table:
    """One byte an entry: in how many blocks its 32 bits occur, coarser above 200.

    Equal bits of different n-grams only make both look more common; the order stays one order.
    """
    table, entries, bounds = B.received(table, np.uint32)
    order = np.argsort(entries, kind="stable")
    ordered = entries[order]
    heads = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    count = np.diff(np.r_[heads, len(ordered)])
    code = np.where(count <= 200, count, np.minimum(255, 200 + 4 * np.log2(np.maximum(count, 200) / 200))).astype(np.uint8)
    codes = np.empty(len(entries), np.uint8)
    codes[order] = np.repeat(code, count)
    return B.answered(table, [codes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])])


def _sets(width: int, percent: int, table: pa.Table, told: pa.Table) -> pa.Table:
    s = _Sets(table, width)
    docs = len(s.ids)
    code = np.frombuffer(b"".join(B.replies(told)), np.uint8)
    common = (code > 1) | (s.local > 1) if len(code) else np.zeros(0, bool)
    size = np.bincount(s.owner, minlength=docs).astype(np.int64)
    shared = np.bincount(s.owner[common[s.place]], minlength=docs).astype(np.int64) if len(code) else size
    need = -(-percent * size // 100)
    candidate = (shared >= need) & (size > 0) & ~s.nulls

    at = np.flatnonzero(candidate[s.owner] & common[s.place]) if len(code) else np.zeros(0, np.int64)
    at = at[np.lexsort((s.grams[at], code[s.place[at]], s.owner[at]))] if len(at) else at
    grams, first = s.grams[at], np.searchsorted(s.owner[at], np.arange(docs + 1))
    prefix = np.maximum(0, size - need + 1 - (size - shared))
    bounds = np.searchsorted(s.owner, np.arange(docs + 1))

    def digest(base: int) -> pa.Array:
        sums = np.r_[np.zeros(1, np.uint64), np.cumsum(T.mixed(s.grams ^ np.uint64(base)))]
        return pa.array((sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64), pa.int64())

    raw = grams.tobytes()
    cut = lambda i, n: raw[8 * first[i]: 8 * (first[i] + n)] if candidate[i] else None
    return pa.table({
        "doc_id": pa.array(s.ids, pa.int64(), mask=s.nulls), "text_hash": s.text_hash, "n_shingles": pa.array(size, pa.int64()), "d1": digest(T.BASES[0]), "d2": digest(T.BASES[1]),
        "prefix": pa.array([cut(i, prefix[i]) for i in range(docs)], pa.binary()),
        "grams": pa.array([cut(i, first[i + 1] - first[i]) for i in range(docs)], pa.binary()),
    })


def _prefix_rows(batches):
    for batch in batches:
        parts = [np.frombuffer(x, np.int64) for x in batch.column("prefix").to_pylist()]
        sizes = np.array([len(x) for x in parts], np.int64)
        yield pa.RecordBatch.from_pydict({
            "gram": pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64()),
            "doc": pa.array(np.repeat(batch.column("node").to_numpy(zero_copy_only=False).astype(np.int64), sizes), pa.int64())})


def overlaps(rows: list[np.ndarray], cols: list[np.ndarray]) -> np.ndarray:
    """Overlap counts of two lists of distinct hashes: a product of 0/1 matrices, COLUMNS at a time."""
    left, right = np.concatenate(rows), np.concatenate(cols)
    shared = np.intersect1d(left, right)
    out = np.zeros((len(rows), len(cols)), np.float32)
    row = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    col = np.repeat(np.arange(len(cols)), [len(x) for x in cols])
    if not len(shared):
        return out

    def placed(values, owner):
        at = np.minimum(np.searchsorted(shared, values), len(shared) - 1)
        hit = shared[at] == values
        at, owner = at[hit], owner[hit]
        order = np.argsort(at, kind="stable")
        return at[order], owner[order]

    (la, lo), (ra, ro) = placed(left, row), placed(right, col)
    for start in range(0, len(shared), COLUMNS):
        width = min(COLUMNS, len(shared) - start)
        a, b = np.zeros((len(rows), width), np.float32), np.zeros((len(cols), width), np.float32)
        i, j = np.searchsorted(la, [start, start + width])
        a[lo[i:j], la[i:j] - start] = 1
        i, j = np.searchsorted(ra, [start, start + width])
        b[ro[i:j], ra[i:j] - start] = 1
        out += a @ b.T
    return out


def _product(percent: int, table: pa.Table) -> pa.Table:
    """Links between the row blocks `low` and `high` of a cluster, as (document, least of its part)."""
    low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
    size = table.column("n_shingles").to_numpy()
    order = np.argsort(size, kind="stable")
    table, size = table.take(pa.array(order)), size[order]
    ids, part = table.column("doc").to_numpy(), table.column("part").to_numpy()
    grams = [np.frombuffer(x, np.int64) for x in table.column("grams").to_pylist()]
    links = []
    if low == high:
        one = two = np.arange(len(ids))
    else:
        one, two = np.flatnonzero(part == low), np.flatnonzero(part == high)
    step = 256
    for i in range(0, len(one), step):
        rows = one[i: i + step]
        near = two[(100 * size[two] >= percent * size[rows[0]]) & (percent * size[two] <= 100 * size[rows[-1]])]
        if low == high:
            near = near[near >= rows[0]]
        for k in range(0, len(near), 1024):
            cols = near[k: k + 1024]
            both = overlaps([grams[x] for x in rows], [grams[x] for x in cols]).astype(np.int64)
            union = size[rows][:, None] + size[cols][None, :] - both
            a, b = np.nonzero(100 * both >= percent * union)
            links.append(np.stack([rows[a], cols[b]]))
    a, b = np.concatenate(links, axis=1) if links else np.zeros((2, 0), np.int64)
    label = ids.copy()
    while True:
        least = label.copy()
        np.minimum.at(least, a, label[b])
        np.minimum.at(least, b, label[a])
        if (least == label).all():
            break
        label = least
    moved = label != ids
    return pa.table({"a": pa.array(ids[moved], pa.int64()), "b": pa.array(label[moved], pa.int64()), "several": pa.array(np.full(int(moved.sum()), table.column("parts")[0].as_py() > 1))})


def _node() -> Column:
    """Texts of equal sets are one node."""
    return F.xxhash64("n_shingles", "d1", "d2").alias("node")


def _linked(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, block_docs: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per row doc_id, text_hash, n_shingles and, if its text can link, node; per node its least row; (a, b) links of nodes to the least of theirs."""
    rows, bits = B.blocks_of(docs, id_col, text_col, block_docs, F.xxhash64(text_col).alias("text_hash"))
    send, read, multiply = partial(_send, width, bits), partial(_sets, width, percent), partial(_product, percent)
    sets = freeze(B.ask(rows, lambda key, table: send(key, table), _answer, lambda left, right: read(left, right), SETS), "sets")

    likely = sets.where("prefix is not null").withColumn("node", _node())
    classes = freeze(likely.groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("least")), "classes")
    chosen = likely.join(classes.select("node", "least.*"), ["node", "doc_id", "text_hash"])
    prefixes = chosen.select("node", "prefix").mapInArrow(_prefix_rows, "gram long, doc long")
    # Each class that shares a rare n-gram with another is tied to the least class that has the n-gram.
    least = prefixes.groupBy("gram").agg(F.min("doc").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    ties = prefixes.join(least, "gram").where("doc <> b").select(F.col("doc").alias("a"), "b").distinct()
    roots = components(ties)

    members = roots.select(F.col("a").alias("doc"), F.col("b").alias("cluster")).unionByName(roots.select(F.col("b").alias("doc"), F.col("b").alias("cluster")).distinct())
    parts = members.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("long").alias("parts"))
    placed = members.join(parts, "cluster").withColumn("part", F.pmod(F.xxhash64("doc"), "parts"))
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    other = other.select("doc", "cluster", "parts", "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"))
    filled = chosen.select(F.col("node").alias("doc"), "n_shingles", "grams").dropDuplicates(["doc"]).join(other, "doc")
    forest = freeze(filled.groupBy("cluster", "low", "high").applyInArrow(lambda table: multiply(table), "a long, b long, several boolean"), "forest")
    merged = components(forest.where("several").select("a", "b"))
    links = forest.where("not several").select("a", "b").unionByName(merged)
    named = sets.select("doc_id", "text_hash", "n_shingles", F.when(F.col("prefix").isNotNull(), _node()).alias("node"))
    return named, classes, links


def _least(classes: DataFrame, links: DataFrame) -> DataFrame:
    """Per node the least row of its component."""
    rooted = classes.join(links.withColumnRenamed("a", "node"), "node", "left").select("node", F.coalesce("b", "node").alias("root"), "least")
    return rooted.select("node", "root").join(rooted.groupBy("root").agg(F.min("least").alias("least")), "root").select("node", "least")


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, block_docs: int = 256) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the least doc_id it reaches by links.

    A set holds the distinct n-grams of lower-cased (A-Z) words; a shorter text is one n-gram. A null or
    empty text has none and links to nothing. A row without an id links to nothing and
    has no component. Rows of equal id are one node, whatever their texts, and have the links of all of them;
    n_shingles is the row's own. Other columns are not read. An empty table gives no rows.
    """
    rows, classes, links = _linked(docs, id_col, text_col, width, percent, block_docs)
    ids = freeze(rows.where("node is not null").groupBy("doc_id").agg(F.min("node").alias("node"), F.max("node").alias("last")), "ids")
    several = ids.where("node <> last")
    if not several.isEmpty():
        of_one = rows.where("node is not null").join(several.select("doc_id", F.col("node").alias("b")), "doc_id").select(F.col("node").alias("a"), "b")
        links = components(links.unionByName(of_one))
    found = ids.join(_least(classes, links), "node").select("doc_id", F.col("least.doc_id").alias("component")).where("component <> doc_id")
    out = rows.select("doc_id", "n_shingles").join(found, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, block_docs: int = 256) -> DataFrame:
    """One row of docs of each group of linked texts, the one of least id, with all its columns.

    Here each text of an id is a document of its own: a row stays if its text links to nothing, whatever
    other rows of its id link to. Of rows of equal id and text one stays. Rows without an id stay.
    """
    rows, classes, links = _linked(docs, id_col, text_col, width, percent, block_docs)
    same = lambda df, other: [df[id_col].cast("long") == other["_id"], F.xxhash64(df[text_col]) == other["_hash"]]
    row = F.struct("doc_id", "text_hash")
    gone = rows.where("node is not null").join(_least(classes, links), "node").where(row != F.col("least"))
    gone = freeze(gone.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "components")
    kept = docs.join(gone, same(docs, gone), "left_anti")
    twice = freeze(rows.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).count().where("count > 1").drop("count"), "twice")
    if twice.isEmpty():
        return kept
    again = kept.join(twice, same(kept, twice), "left_semi").dropDuplicates([id_col, text_col])
    return kept.join(twice, same(kept, twice), "left_anti").unionByName(again)
