"""Every operator against brute force on small rows with all the odd cases, and against its SQL twin at the smallest scale."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tools.compare import compare, duck
from weftline.llm import blocks, decontaminate, line_dedup, merkle, ngram_join, packing, quality, sharding, substring_dedup, toxicity, warc
from weftline.llm.components import components
from weftline.llm.queries import ORACLES, QUERIES, tokenizer

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, block string, word int, _id string, entries binary, n double"


def vocabulary(seed, n):
    random.seed(seed)
    return ["".join(random.choice("abcdefghijklm") for _ in range(random.randint(2, 9))) for _ in range(n)]


def rows():
    """Nulls, empty and very long texts, ties, repeated rows, near copies, shared passages."""
    words = vocabulary(1, 4000)
    text = lambda n: " ".join(random.choice(words) for _ in range(n))
    passage = text(60)
    base = text(200).split()
    near = base[:]
    near[7] = "edited"
    long = "\n".join(text(40) for _ in range(500))
    texts = [(1, text(30)), (2, None), (3, ""), (4, " \t\n\r \x0b\x0c"), (5, " ".join(base)), (6, " ".join(near)), (7, " ".join(base)), (8, text(20) + " " + passage), (9, passage + " " + text(20)),
             (9, passage + " " + text(20)), (10, "one two three"), (11, "ONE two three"), (12, "one"), (13, "x" * 30_000), (14, long), (15, long + "\nlast line here"), (None, " ".join(base)), (None, None),
             (16, "a b  c \U0001F600 d́"), (17, text(12)), (18, text(13)), (-5, text(40)), (1 << 40, text(40)), (19, passage)]
    twice = (20, text(25))
    return [(i, x, "block", 1, "id", b"e", 0.5) for i, x in [*texts, twice, twice]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def words_of(text):
    return (text or "").encode().split()


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


def test_substring_dedup(docs, none):
    first = {}
    data = [(r[0], r[1]) for r in rows()]
    rank = lambda i: float("inf") if i is None else i
    for i, x in data:
        w = words_of(x)
        for k in range(len(w) - 12):
            g = tuple(w[k:k + 13])
            first[g] = min(first.get(g, float("inf")), rank(i))
    want = []
    for i, x in data:
        w = words_of(x)
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k:k + 13])] < rank(i):
                gone |= set(range(k, k + 13))
        want.append((i, len(w), len(gone), b" ".join(y for k, y in enumerate(w) if k not in gone).decode()))
    found = substring_dedup.substring_dedup(docs, block_docs=4).collect()
    assert sorted((tuple(r)[:4] for r in found), key=key) == sorted(want, key=key)
    for r in found:
        assert sum(s["count"] for s in r.removed) == r.n_removed
        assert all(a["first"] + a["count"] < b["first"] for a, b in zip(r.removed, r.removed[1:]))
    assert any(r.n_removed for r in found)
    assert substring_dedup.substring_dedup(none).count() == 0


def test_blocks_of_hot_ids(spark, monkeypatch):
    """No block grows with one id, with the rows without one or with long texts, and the results stay."""
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 2000)
    words = vocabulary(5, 300)
    random.seed(5)
    passage = " ".join(words[:15])
    text = lambda: " ".join(random.choices(words, k=20)) + " " + (passage if random.random() < 0.3 else "")
    long = " ".join(random.choices(words, k=600))
    data = [(i, text()) for i in range(60)] + [(None, text()) for _ in range(60)] + [(7, text()) for _ in range(60)] + [(None, None), (100, long), (101, long)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    placed, _ = blocks.blocks_of(docs, "doc_id", "text", 256)
    groups = {}
    for r in placed.collect():
        groups.setdefault((r.block, r.part), []).append((r.doc_id, len(r.text or "") + blocks.ROW_BYTES))
    assert sum(map(len, groups.values())) == len(data)
    assert all(len(g) == 1 or sum(n for _, n in g) <= (4000 if len({i for i, _ in g}) > 1 else 8000) for g in groups.values())
    assert all(len(p) > 1 for p in ([k for k, g in groups.items() if i in {x for x, _ in g}] for i in (None, 7)))
    first, rank = {}, lambda i: float("inf") if i is None else i
    for i, x in data:
        w = words_of(x)
        for k in range(len(w) - 12):
            first[tuple(w[k:k + 13])] = min(first.get(tuple(w[k:k + 13]), float("inf")), rank(i))
    want = []
    for i, x in data:
        w = words_of(x)
        want.append((i, len(w), len({j for k in range(len(w) - 12) if first[tuple(w[k:k + 13])] < rank(i) for j in range(k, k + 13)})))
    found = substring_dedup.substring_dedup(docs).collect()
    assert sorted((tuple(r)[:3] for r in found), key=key) == sorted(want, key=key)
    unique = [(i, x) for i, x in data if i != 7]
    found = ngram_join.ngram_jaccard_join(spark.createDataFrame(unique, "doc_id long, text string")).collect()
    least = linked(unique)
    assert sorted(map(tuple, found), key=key) == sorted(((i, len(shingles(x)), least.get(i)) for i, x in unique), key=key)


def shingles(text):
    w = [x.decode().translate({c: c + 32 for c in range(65, 91)}) for x in words_of(text)]
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def linked(data):
    """Least reachable id of each id by brute force."""
    sets = [(i, shingles(x)) for i, x in data if i is not None]
    least = {i: i for i, _ in sets}
    while True:
        before = dict(least)
        for i, a in sets:
            for k, b in sets:
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    least[i] = least[k] = min(least[i], least[k])
        if before == least:
            return least


@pytest.mark.parametrize("block_rows", [512, 2])
def test_ngram_join(spark, docs, none, monkeypatch, block_rows):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", block_rows)
    data = [(r[0], r[1]) for r in rows()]
    least = linked(data)
    want = [(i, len(shingles(x)), least.get(i)) for i, x in data]
    found = ngram_join.ngram_jaccard_join(docs, block_docs=4)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(want, key=key)
    # A chain of near copies, longer than a block: neighbours link, the ends do not.
    words = vocabulary(3, 500)
    chain = [(k, " ".join(words[4 * k:4 * k + 100])) for k in range(30)]
    least = linked(chain)
    found = ngram_join.ngram_jaccard_join(spark.createDataFrame(chain, "doc_id long, text string"), block_docs=7)
    assert {r.doc_id: r.component_id for r in found.collect()} == least and set(least.values()) == {0}
    assert ngram_join.ngram_jaccard_join(none).count() == 0
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 5 in ids and not {6, 7} & set(ids) and ids.count(20) == 1 and ids.count(None) == 2


def test_ngram_join_of_different_texts_of_an_id(spark):
    """All texts of an id count for its links; a text that is like no other stays in the corpus."""
    words = vocabulary(11, 2000)
    random.seed(11)
    a, b, c, d = (random.choices(words, k=60) for _ in range(4))
    near = lambda x: " ".join([*x[:-1], "edited"])
    a, b, c, d = map(" ".join, (a, b, c, d))
    data = [(3, a), (7, a), (7, b), (9, near(b.split())), (12, near(b.split())), (12, c), (12, c), (20, near(c.split())), (30, d), (None, d), (30, near(d.split())), (40, ""), (40, "alone")]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    found = ngram_join.ngram_jaccard_join(docs, block_docs=4).collect()
    least = linked(data)
    assert {least[i] for i in (3, 7, 9, 12, 20)} == {3}
    assert sorted(map(tuple, found), key=key) == sorted(((i, len(shingles(x)), least.get(i)) for i, x in data), key=key)
    kept = sorted(map(tuple, ngram_join.one_of_each(docs, block_docs=4).collect()), key=key)
    assert [x for x in kept if x[0] != 30] == sorted([(3, a), (7, b), (12, c), (40, ""), (40, "alone"), (None, d)], key=key)
    assert len([x for x in kept if x[0] == 30]) == 1


def test_overlaps_in_slices(monkeypatch):
    monkeypatch.setattr(ngram_join, "COLUMNS", 3)
    random.seed(2)
    sets = [np.array(random.sample(range(40), random.randint(1, 30))) for _ in range(12)]
    want = [[len(set(a) & set(b)) for b in sets[5:]] for a in sets[:5]]
    assert ngram_join.overlaps(sets[:5], sets[5:]).tolist() == want


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 2), (5, 5), (9, 8), (8, 7), (7, 30), (None, 4), (4, None)]
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == [(2, 1), (3, 1), (8, 7), (9, 7), (30, 7)]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_line_dedup(spark, docs, none):
    words = vocabulary(5, 300)
    random.seed(6)
    line = lambda n: " ".join(random.sample(words, n))
    data = [(r[0], r[1]) for r in rows() if r[0] not in (9, 20)]
    crowd = line(20)
    for i in range(60):
        parts = crowd.split()
        parts[i % 20] = f"new{i}"
        data.append((100 + i, "\n".join([" ".join(parts), line(15), "", line(3)])))
    data += [(200, crowd.upper() + "\n  \n" + crowd), (201, crowd), (None, crowd + "\nnever seen before")]
    sets = []
    for i, x in data:
        for k, text in enumerate((x or "").split("\n") if x is not None else []):
            if s := {w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w}:
                sets.append(((float("inf"), 0) if i is None else (i, k), s))
    want = []
    for i, x in data:
        removed, lines = [], [] if x is None else x.split("\n")
        for k, text in enumerate(lines):
            s = {w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w}
            place = (float("inf"), 0) if i is None else (i, k)
            if s and any(p < place and 100 * len(s & o) >= 80 * len(s | o) for p, o in sets):
                removed.append(k)
        want.append((i, len(lines), removed))
    frame = spark.createDataFrame(data, "doc_id long, text string")
    found = [(r.doc_id, r.n_lines, r.removed) for r in line_dedup.repeated_lines(frame).collect()]
    by = lambda x: (x[0] is None, x[0] or 0, x[1], x[2])
    assert sorted(found, key=by) == sorted(want, key=by)
    kept = {r.doc_id: r.text for r in line_dedup.line_dedup(frame).where("doc_id is not null").collect()}
    assert 201 not in kept and 200 not in kept and 2 in kept and kept[3] == ""
    assert line_dedup.line_dedup(docs).columns == docs.columns
    assert line_dedup.repeated_lines(none).count() == 0


def test_warc(spark, tmp_path):
    pages = [(1, "http://a/ä b", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "u\r\nX: y", None), (4, "v", ""), (5, "w", "é" * 400_000), (0, "z", "<p>x</p>"), (None, "q", "<p>x</p>"), (7, "t", "b"), (7, "t", "b")]
    frame = spark.createDataFrame([(*p, "extra") for p in pages], "page_id long, url string, html string, archive string")
    found = warc.read_warc(warc.write_warc(frame, f"file://{tmp_path}/warc")).collect()
    least = {}
    for i, _, h in pages:
        if i is not None:
            least[h or ""] = min(least.get(h or "", i), i)
    want = []
    for i, _, h in pages:
        again = i is not None and i != least[h or ""]
        want.append((i, "revisit" if again else "response", least[h or ""] if again else None, len((h or "").encode()), warc.digest((h or "").encode()), b"" if again else (h or "").encode()))
    got = [(r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, bytes(r.payload)) for r in found]
    assert sorted(got, key=lambda x: (x[0] is None, x[0] or 0)) == sorted(want, key=lambda x: (x[0] is None, x[0] or 0))
    assert warc.read_warc(warc.write_warc(frame.limit(0))).count() == 0


def test_warc_rejects_damage(tmp_path):
    whole = warc.record(1, "u", b"payload", 1, False, "2000-01-01T00:00:00Z")
    import io

    pack = lambda x: (lambda c: c.compress(x) + c.flush())(zlib.compressobj(6, zlib.DEFLATED, 31))
    good = pack(whole) + pack(whole)
    assert [p for _, _, p in warc.records(io.BytesIO(good), True)] == [b"payload"] * 2
    for bad in (pack(whole.replace(b"payload", b"pAyload")), pack(whole[:-6]), good[:-9], pack(whole + b"more")):
        with pytest.raises((ValueError, zlib.error)):
            list(warc.records(io.BytesIO(bad), False))


def test_sharding(docs, none):
    found = sharding.shard(docs, shards=3).collect()
    assert len(found) == len(rows())
    for s in {r.shard for r in found}:
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found)))
    assert all(r.grown_shard in (r.shard, 3) for r in found)
    assert sorted((r.size, r.text_crc32) for r in found) == sorted((len((x or "").encode()) + 1, zlib.crc32((x or "").encode())) for _, x, *_ in rows())
    keys = np.random.default_rng(1).integers(0, 1 << 63, 20_000)
    eight, nine = sharding.jump(keys, 8), sharding.jump(keys, 9)
    assert set(nine[eight != nine]) == {8} and abs((eight != nine).mean() - 1 / 9) < 0.01 and np.bincount(eight).min() > 2300
    assert sharding.shard(none).count() == 0


def test_merkle(spark, docs, none):
    data = sorted(((i, x or "") for i, x, *_ in rows() if i is not None))
    want = {}
    for k, (i, x) in enumerate(data):
        cut, after = len(x) // 4, data[(k + 1) % len(data)][1]
        want.setdefault(i, []).append(hashlib.sha256((x[:len(x) - cut] + after[:cut]).encode()).hexdigest())
    found = merkle.fingerprints(docs).collect()
    assert len(found) == len(rows())
    got = {}
    for r in found:
        got.setdefault(r.doc_id, []).append(r.edited_sha256)
    assert all(sorted(got[i]) == sorted(x) for i, x in want.items())
    texts = spark.createDataFrame([(a, b) for a in ("", "a", "a\n\nb", "a\n\n\nb", "a\nb", "b\na", "a\n", "x" * 100) for b in ("a\nb", "")], "a string, b string")
    for r in texts.select("a", "b", merkle.fingerprint(F.col("a")).alias("f"), merkle.fingerprint(F.col("b")).alias("g")).withColumn("l", merkle.likeness(F.col("f"), F.col("g"))).collect():
        assert (r.f == r.g) == (r.a == r.b) == (r.f.split(":")[0] == r.g.split(":")[0]) and (r.l == 1 or r.a != r.b)
    far = spark.createDataFrame([("a\nb\n\nc\nd", "a\nb\n\nc\ne")], "a string, b string")
    assert far.select(merkle.first_difference(merkle.fingerprint(F.col("a")), merkle.fingerprint(F.col("b")))).first()[0] == 3
    assert merkle.fingerprints(none).count() == 0


def test_packing(docs, none):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(tokenizer())
    found = packing.best_fit_packing(docs, tokenizer(), with_ids=True).collect()
    want = []
    for i, x, *_ in rows():
        ids = reference.encode(x or "", add_special_tokens=False).ids + [2]
        head = len(ids) % 1024 or 1024
        cuts = [0, *range(head, len(ids) + 1, 1024)]
        want += [(i, k, a, ids[a:b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    assert sorted(((r.doc_id, r.piece, r.start, r.ids) for r in found), key=order) == sorted(want, key=order)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and r.length == len(r.ids) for r in found)
    bins = {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in b) <= 1024 and [o for o, _ in sorted(b)] == [sum(n for _, n in sorted(b)[:k]) for k in range(len(b))] for b in bins.values())
    assert len(bins) <= -(-sum(r.length for r in found) // 1024) + 3
    assert packing.best_fit_packing(none, tokenizer()).count() == 0


def test_tokens_of_odd_texts():
    from tokenizers import Tokenizer

    random.seed(9)
    low, high = [chr(c) for c in range(0x340)], ["　", "日", "​", "\U0001F600", "ж"]
    texts = ["".join(random.choice(low + [" "] * 90 + ["a", "'", "s"] * 30) for _ in range(80)) for _ in range(400)]
    texts += [t + random.choice(high) for t in texts[:50]] + ["a<|endoftext|>b", "", "  a  b \n\n c\t\t", "it's we'll I'M"]
    plain = [all(b < packing.FAST_BYTES for b in t.encode()) for t in texts]
    got = [np.frombuffer(x, "<u4").tolist() for x in packing.encode(tokenizer(), texts, plain)]
    assert got == [e.ids for e in Tokenizer.from_file(tokenizer()).encode_batch(texts, add_special_tokens=False)]


def test_alignment():
    random.seed(4)
    for _ in range(60):
        a, b = np.array(random.choices(range(6), k=random.randint(1, 12))), np.array(random.choices(range(6), k=random.randint(1, 15)))
        h, best = np.zeros((len(a) + 1, len(b) + 1), int), 0
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
                best = max(best, h[i + 1, j + 1])
        assert decontaminate.align(a, b)[0] == best


def test_decontaminate(spark, docs, none):
    words = vocabulary(8, 900)
    item = [" ".join(random.sample(words, 30)), " ".join(random.sample(words, 18)), "two words", None, "", ". , !"]
    bench = spark.createDataFrame([(k, x, "block") for k, x in enumerate(item)] + [(0, item[0], "block")], "item_id long, text string, block string")
    edited = item[0].split()
    for k in (3, 9, 15, 21, 27):
        edited[k] = "other"
    del edited[12]
    long = " ".join(random.choices(words, k=30_000))
    more = [(50, "Before. " + item[0].upper().replace(" ", ", ") + "! After."), (51, "x y " + " ".join(edited) + " z"), (52, " ".join(item[0].split()[:8])), (53, long + " " + item[1] + " " + long), (54, "some two words"), (None, item[1])]
    both = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    found = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(both, bench).collect()}
    assert set(found) == {(50, 0), (51, 0), (53, 1), (54, 2), (None, 1)}
    assert found[50, 0].score == 1 and found[50, 0].first_word == 1 and found[53, 1].first_word == 30_000 and 0.6 < found[51, 0].score < 0.9
    kept = decontaminate.decontaminate(both, bench)
    assert kept.columns == both.columns and kept.count() == both.count() - 5
    assert decontaminate.contaminated(none, bench).count() == 0 and decontaminate.contaminated(both, bench.limit(0)).count() == 0
    assert decontaminate.decontaminate(both, bench.limit(0)).count() == both.count()


def test_folding():
    plain = toxicity.fold("loser idiot pathetic trash worthless moron")
    for text in ("L0SER 1D10T p@thetic tra$h w0rthle55 m0r0n", "ʟoser іdіоt раthetic ｔｒａｓｈ worthless moron", "lo​ser i.d.i.o.t p-a-t-h-e-t-i-c t r a s h worthlesssss mooooron!!"):
        assert toxicity.fold(text) == plain
    assert toxicity.fold("in 2024 we paid 300 $") == toxicity.fold("in 2024 we paid 300")
    assert toxicity.fold("") == toxicity.fold(" .,! ") == "  "


def test_toxicity(spark, docs, none):
    words = vocabulary(10, 800)
    random.seed(11)
    data, labels = [], []
    for i in range(900):
        text = random.choices(words, k=random.randint(20, 60))
        toxic = i % 5 == 0
        if toxic:
            text[3], text[11] = random.choice(["zorkling", "zorky", "Z0rk"]), "vilebad"
        elif i % 7 == 0:
            text[5:7] = ["vilebad", "recipe"]
        data.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    frame, marks = spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.learn(frame, marks.where("doc_id % 3 <> 0"))
    scores = {r.doc_id: r.score for r in toxicity.toxicity(frame, model).collect()}
    assert sum((scores[i] >= 0.3) != bool(t) for i, t in labels) <= 9
    odd = toxicity.toxicity(docs, model).collect()
    assert len(odd) == len(rows()) and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.toxicity(none, model).count() == 0
    empty = toxicity.learn(frame, marks.limit(0))
    assert empty.stems == {} and toxicity.toxicity(docs, empty).count() == len(rows())


def test_quality(spark, docs, none):
    words = vocabulary(12, 800)
    random.seed(13)
    data = [(i, " ".join(random.choices(words, k=random.randint(20, 90))) if i % 3 else " ".join([random.choice(words).upper() + "!!"] * random.randint(20, 90))) for i in range(600)]
    frame, marks = spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(600)], "doc_id long, quality int")
    stats = quality.measured(frame)
    model = quality.learn(stats, marks.where("doc_id % 2 = 0"))
    scores = {r.doc_id: r.score for r in quality.score(stats, model).collect()}
    assert all((scores[i] >= 0.5) == (i % 3 > 0) for i in range(600))
    odd = quality.score(quality.measured(docs), model).collect()
    assert len(odd) == len(rows()) and all(0 <= r.score <= 1 for r in odd)
    assert quality.score(quality.measured(none), model).count() == 0 and quality.keep_good(none, model).columns == none.columns
    assert quality.keep_good(frame, model).count() == 400
    assert quality.learn(stats, marks.limit(0)).score(np.zeros((2, len(quality.STATISTICS)))).tolist() == [0.5, 0.5]


def test_isotonic():
    assert quality.isotonic(np.array([0.1, 0.5, 0.3, 0.9]), np.array([1, 1, 3, 1.0])).tolist() == pytest.approx([0.1, 0.35, 0.35, 0.9])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries(spark, name):
    if name in ORACLES:
        assert compare(spark, duck(FOLDER), name, QUERIES[name], ORACLES[name], FOLDER) is None
    else:
        assert QUERIES[name](spark, FOLDER).count() > 0


def test_pipeline(spark):
    import corpus_pipeline

    whole = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs, columns = whole, whole.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        if name != "packing":
            assert out.columns == columns
            path = corpus_pipeline.scratch_path(spark, "test")
            out.write.parquet(path)
            out = spark.read.parquet(path)
            assert 0 < out.count() <= docs.count()
        if name == "near_copies":
            data = [(r.doc_id, r.text) for r in docs.collect()]
            assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, k in linked(data).items() if i == k)
        docs = out
    assert docs.count() == corpus_pipeline.run(spark, FOLDER).count()


def test_decontaminate_against_all_alignments(spark):
    """Copies with every third word replaced, with words between, with holes: what aligning everything finds is found."""
    random.seed(21)
    words = vocabulary(21, 60)
    items = [(k, " ".join(random.choices(words, k=n))) for k, n in enumerate((1, 3, 4, 5, 8, 15, 17, 38, 59))]
    texts = []
    for k, item in items:
        w = item.split()
        for copy in range(6):
            v = [f"new{random.random()}" if i % 3 == 2 else x for i, x in enumerate(w)] if copy == 0 else [y for x in w for y in (x, "between")][: 2 * len(w) - 1] if copy == 1 else list(w)
            if copy == 2:
                v = w[: len(w) // 2] + random.choices(words, k=len(w)) + w[len(w) // 2:]
            for _ in range(copy and random.randint(0, len(w))):
                v[random.randrange(len(v))] = random.choice(words)
            texts.append(" ".join(random.choices(words, k=random.randint(0, 40)) + v + random.choices(words, k=random.randint(0, 40))))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    number = {w: i for i, w in enumerate({x for t in [*texts, *[i for _, i in items]] for x in t.replace(".", " ").split()})}
    coded = lambda t: np.array([number[x] for x in t.replace(".", " ").split()])
    want = {}
    for d, text in enumerate(texts):
        for k, item in items:
            score = decontaminate.align(coded(item), coded(text))[0] / (2 * len(item.split()))
            if score >= 0.5:
                want[d, k] = score
    found = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(docs, bench).collect()}
    assert found == want and len(want) > 30
    assert sorted(r.doc_id for r in decontaminate.decontaminate(docs, bench).collect()) == sorted(set(range(len(texts))) - {d for d, _ in want})


def test_word_hashes_without_form(spark):
    """Words that collide under any polynomial modulo a power of two, and words longer than the tables."""
    from weftline.llm import text as T

    a = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    b = a.translate(str.maketrans("ab", "ba"))
    odd = [a, b, a[:1024], b[:1024], "x" * 255, "x" * 256, "x" * 257, "x" * 300 + "y", "y" + "x" * 300, "ab", "ba", "é"]
    data, offsets = T.text_bytes(__import__("pyarrow").array([" ".join(odd)]))
    starts, ends, _ = T.words(data, offsets)
    assert len(set(T.span_hashes(data, starts, ends).tolist())) == len(odd)
    one = [T.span_hashes(*(lambda d, o: (d, *T.words(d, o)[:2]))(*T.text_bytes(__import__("pyarrow").array(["lead " + w]))))[1] for w in odd]
    assert one == T.span_hashes(data, starts, ends).tolist()
    tail = " one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, a + tail), (2, b + tail)], "doc_id long, text string")
    assert [r.n_removed for r in substring_dedup.substring_dedup(docs).collect()] == [0, 0]
    assert {r.component_id for r in ngram_join.ngram_jaccard_join(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")).collect()} == {1, 2}


def test_stages_with_odd_column_names(spark):
    names = "doc_id long, text string, _all boolean, _removed int, _lower string, _text string, `a.b` int, lower string, c1 int, removed string, all_removed int"
    words = vocabulary(31, 200)
    random.seed(31)
    data = [(i, " ".join(random.choices(words, k=20)), True, 1, "l", "t", 2, "low", 3, "r", 4) for i in range(20)]
    docs = spark.createDataFrame([*data, (30, None, *data[0][2:]), (31, data[3][1], *data[0][2:])], names)
    bench = spark.createDataFrame([(1, data[5][1])], "item_id long, text string")
    for out, count in ((line_dedup.line_dedup(docs), 21), (decontaminate.decontaminate(docs, bench), 21), (quality.keep_good(docs, quality.Model(np.zeros(22), np.ones(22), None, np.zeros(1), np.zeros(1))), 22)):
        assert out.columns == docs.columns
        rows = out.collect()
        assert len(rows) == count and {tuple(r)[2:] for r in rows} == {data[0][2:]}
