"""Line dedup: prefixes in two parts, files without dictionaries, counts of rows that stand twice."""

from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from weftline.llm import line_dedup as L
from weftline.session import freeze, frozen


def test_smaller_set_meets_others_with_its_shorter_prefix_only(spark):
    rows = [(n, 0, " ".join(f"w{i}" for i in range(n))) for n in (1, 4, 9, 45, 150)]
    hashed = L._hashed(spark.createDataFrame(rows, "doc long, spot long, line string"))
    short, long = L._unfolded(L._prefixes(hashed, L._ranks(hashed), 80), 80)
    count = lambda side: {r.n: r.at for r in side.groupBy("n").agg(F.sort_array(F.collect_list("at")).alias("at")).collect()}
    first, rest = count(short), count(long)
    for n in (1, 4, 9, 45, 150):
        prefix = n - -(-n * 80 // 100) + 1
        assert first[n] + rest.get(n, []) == list(range(prefix))
        assert first[n] == [at for at in range(prefix) if 180 * at <= 20 * n]


def test_files_of_hashes_have_no_dictionary(spark):
    freeze(spark.createDataFrame([([1, 2, 1],)], "hashes array<long>"), "plain", L.PLAIN)
    parts = list(Path(frozen()[-1].removeprefix("file://")).glob("*.parquet"))
    groups = [m.row_group(i).column(0) for m in (pq.ParquetFile(p).metadata for p in parts) for i in range(m.num_row_groups)]
    assert groups and not any(c.has_dictionary_page for c in groups)


def test_rows_that_stand_twice(spark):
    data = [(1, "a b c\n\nd e"), (2, "a b c"), (2, "a b c"), (3, "x\n \t\v\f\r\na b c"), (3, "x\n \t\v\f\r\na b c"), (4, None), (4, None), (5, ""), (None, "a b c\nq"), (None, "a b c\nq")]
    found = L.repeated_lines(spark.createDataFrame(data, "doc_id long, text string")).collect()
    got = {(r.doc_id, r.n_lines): (r.removed, r.all_removed) for r in found}
    assert len(found) == 6
    assert got == {(1, 3): ([], False), (2, 1): ([0], True), (3, 3): ([2], False), (4, 0): ([], False), (5, 1): ([], False), (None, 2): ([0], False)}


def test_crowds_settled_first_change_nothing(spark, monkeypatch):
    lines = [" ".join(f"w{(i * 7 + k) % 41}" for k in range(12 + i % 3)) for i in range(60)]
    docs = spark.createDataFrame([(i, f"{lines[i]}\n{lines[-i]} x{i}") for i in range(60)], "doc_id long, text string")
    monkeypatch.setattr(L, "CROWD", 1000)
    want = {(r.doc_id, tuple(r.removed)) for r in L.repeated_lines(docs).collect()}
    monkeypatch.setattr(L, "CROWD", 3)
    assert {(r.doc_id, tuple(r.removed)) for r in L.repeated_lines(docs).collect()} == want and any(removed for _, removed in want)


def test_words_of_pairs_travel_as_one_text(spark):
    texts = [(1, "A b\tc d  e f g h i"), (2, "a B c d e f g h i a"), (3, "a b c d e f g h x y z"), (4, "é\u00a0ü b"), (5, "É\u00a0ü  B b")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    spot = {r.doc_id: r.spot for r in L._lines(docs, "doc_id", "text").collect()}
    pairs = spark.createDataFrame([(1, spot[1], 2, spot[2]), (1, spot[1], 3, spot[3]), (4, spot[4], 5, spot[5])], "doc long, spot long, late_doc long, late_spot long")
    near = L._contents(docs, "doc_id", "text", pairs)
    assert {r.doc: (r.n, sorted(r.words.split(" "))) for r in near.collect()} == {
        1: (9, list("abcdefghi")), 2: (9, list("abcdefghi")), 3: (11, list("abcdefghxyz")), 4: (2, ["b", "é\u00a0ü"]), 5: (2, ["b", "é\u00a0ü"])}
    assert {r.doc for r in L._verified(pairs, near, 80).collect()} == {2, 5}
