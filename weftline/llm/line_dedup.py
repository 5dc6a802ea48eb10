"""Line dedup: an exact set-similarity join of lines, in SQL functions only.

1. Words are counted over all distinct lines in 2**18 slots of their hashes; a word's rarity is the logarithm of its
   slot's count. This order has a fixed size, and any order makes the join exact.
2. Distinct lines become sets of words, ordered by rarity. Two sets of Jaccard similarity t share one of the first
   n - ceil(t n) + 1 words of each, and of the smaller n - ceil(2 t n / (1 + t)) + 1 suffice (prefix filter). Pairs must also pass the length filter, the positional
   filter (what can still be common from here on) and a bitmap filter (parity bits of both sets, whose
   differences never outnumber the words not in common).
3. Words of the shorter prefix and those after them are two sets of rows, so that a smaller set's other words are
   never met. Pairs that pass are verified on the words themselves. Where many lines share a prefix word, each is
   first verified against the earliest of them; a line settled so meets no more candidates as the later one.
4. A line goes if an equal or similar line stands earlier, by doc_id and then by line number. This is judged on
   the input, not on what is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weftline.llm import text as T
from weftline.session import freeze, frozen, release

SLOTS = 1 << 18
HASH_BITS = 56  # of a word's key
LONG = 128  # words of a set from which on the bitmap has 128 bits
CROWD = 256  # lines that share a word of their prefixes before they are tried against the earliest one first
BROADCAST_IDS = 1_000_000  # ids of similar or repeated lines that may be broadcast; more are joined by a shuffle
NO_ID = (1 << 63) - 1  # doc of lines in rows without an id
SPACES = " \t\n\v\f\r"
PLAIN = {"parquet.enable.dictionary": "false"}  # of files of hashes, which differ too much for dictionaries


def _split(line: Column) -> Column:
    """Lower-case words; other white space than blanks is rare, so the costlier split is only made where there is any."""
    other = F.lit(False)
    for c in "\t\v\f\r":
        other = other | F.contains(line, F.lit(c))
    return F.when(other, F.split(F.lower(line), "[\\x20\\x09-\\x0D]+")).otherwise(F.split(F.lower(line), " "))


def tokens(line: Column) -> Column:
    """Distinct lower-case words."""
    return F.array_distinct(F.array_remove(_split(line), ""))


def _hashed(distinct: DataFrame) -> DataFrame:
    """Per distinct line the hashes of its distinct words: each word is split off and hashed here, and nowhere else before the last check."""
    hashes = F.array_distinct(F.array_remove(F.transform(_split(F.col("line")), lambda w: F.xxhash64(w)), F.xxhash64(F.lit(""))))
    return distinct.select("doc", "spot", hashes.alias("hashes"))


def _step(lines: Column) -> Column:
    """Rarity of a slot: three steps for each doubling of the number of lines that have a word in it."""
    return F.least(F.lit(127), F.floor(3 * F.log2(lines + 1))).cast("int")


def _ranks(hashed: DataFrame) -> Column:
    """Rarity of each slot as a constant array of SLOTS numbers."""
    slot = F.col("hash").bitwiseAND(F.lit(SLOTS - 1)).cast("int")
    counts = hashed.select(F.explode("hashes").alias("hash")).groupBy(slot.alias("slot")).agg(F.count("*").alias("n"))
    found = counts.agg(F.collect_list(F.col("slot") * 128 + _step(F.col("n")))).first()[0]  # SLOTS numbers at most
    rank = [0] * SLOTS
    for x in found:
        rank[x >> 7] = x & 127
    return F.split(F.lit(",".join(map(str, rank))), ",").cast("array<tinyint>")


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line: doc_id, sig (of the whole text), line_no, line, and id of lines that have words.

    doc (the id, or the largest number without one) and spot (line number and 32 bits of the line's hash) order lines by place.
    """
    # sig is a column of the text; beside the generator it would be computed for every line again.
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("sig"))
    rows = texts.select("doc_id", "sig", F.posexplode_outer(F.split(F.col("text"), "\n")).alias("line_no", "line"))
    spot = F.call_function("shiftleft", F.col("line_no").cast("long"), F.lit(32)).bitwiseOR(F.hash("line").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    spot = F.coalesce(spot, F.lit(-1).cast("long"))
    worded = F.ltrim(F.col("line"), F.lit(SPACES)) != ""
    return rows.select("doc_id", "sig", "line_no", "line", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), spot.alias("spot"), F.when(worded, F.xxhash64("line")).alias("id"))


def _earlier(doc: str, spot: str, other_doc: str, other_spot: str) -> Column:
    """The first place is earlier: a smaller doc, or a smaller line number of the same one."""
    number = lambda c: F.shiftright(F.col(c), 32)
    return (F.col(doc) < F.col(other_doc)) | ((F.col(doc) == F.col(other_doc)) & (F.col(doc) != NO_ID) & (number(spot) < number(other_spot)))


def _small(frame: DataFrame, rows: int) -> DataFrame:
    """The frame, to be broadcast if it has so few rows."""
    return F.broadcast(frame) if rows <= BROADCAST_IDS else frame


def _prefixes(hashed: DataFrame, ranks: Column, percent: int) -> DataFrame:
    """Per distinct line its size, bitmaps and prefix, the shorter one that suffices for the smaller set and the words after it: doc, spot, n, even, odd, short, long."""
    # A word's key: its slot's rarity above HASH_BITS bits of its hash, the lowest of which are the slot. Sorting the keys orders words by rarity.
    key = lambda h: F.call_function("shiftleft", F.get(ranks, h.bitwiseAND(F.lit(SLOTS - 1))).cast("long"), F.lit(HASH_BITS)).bitwiseOR(h.bitwiseAND(F.lit((1 << HASH_BITS) - 1)))
    keys = F.sort_array(F.transform("hashes", lambda h: F.coalesce(key(h), F.lit(0).cast("long"))))  # numbers that cannot be null are sorted without boxes
    sized = hashed.select("doc", "spot", keys.alias("words")).select("doc", "spot", "words", F.size("words").alias("n"))
    # Parity bitmaps: 128 bits for long sets, and 64 bits, which are the two halves of 128 put together, for others.
    bit = lambda w: F.call_function("shiftleft", F.lit(1).cast("long"), w.bitwiseAND(F.lit(63)).cast("int"))
    none = F.lit(0).cast("long")
    parity = lambda flag: F.aggregate("words", none, lambda s, w: s.bitwiseXOR(flag(w)))
    half = lambda which: parity(lambda w: F.when(w.bitwiseAND(F.lit(64)) == which, bit(w)).otherwise(none))
    even, odd = F.when(F.col("n") > LONG, half(0)).otherwise(parity(bit)), F.when(F.col("n") > LONG, half(64)).otherwise(none)
    size, short = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1, _short(F.col("n"), percent)
    # The bitmaps are columns of the line; beside the generator of `_unfolded` they would be computed for every word again.
    return sized.select("doc", "spot", "n", even.alias("even"), odd.alias("odd"), F.slice("words", F.lit(1), short).alias("short"), F.slice("words", short + 1, F.greatest(size - short, F.lit(0))).alias("long"))


def _short(n: Column, percent: int) -> Column:
    """Words of the shorter prefix, which suffices for a set of n words towards sets of its size or more."""
    return F.floor((100 - percent) * n / (100 + percent)).cast("int") + 1


def _unfolded(prefixes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """One row per word of the shorter prefix, and one per word after it: doc, spot, n, even, odd, at, word."""
    short = prefixes.select("doc", "spot", "n", "even", "odd", F.posexplode("short").alias("at", "word"))
    long = prefixes.select("doc", "spot", "n", "even", "odd", F.posexplode("long").alias("at", "word"))
    return short, long.withColumn("at", F.col("at") + _short(F.col("n"), percent))


def _stars(short: DataFrame, long: DataFrame, percent: int) -> DataFrame:
    """Pairs of each line with the earliest one of every crowded word: CROWD lines or more have it in their prefix."""
    words = short.unionByName(long)
    # A word is not crowded if fewer lines than that have any word of its slot.
    often = words.where(F.shiftright("word", HASH_BITS) >= _step(F.lit(CROWD)))
    counts = often.groupBy("word").agg(F.count("*").alias("lines"), F.min("doc").alias("first_doc"))
    crowded = freeze(counts.where(F.col("lines") >= CROWD).select("word", "first_doc"), "crowded-words")
    count = crowded.count()  # as many rows as the earliest lines below
    rows = words.select("word", "doc", "spot", "n", "even", "odd").join(_small(crowded, count), "word")
    first = rows.where("doc = first_doc").groupBy("word").agg(F.min(F.struct("doc", "spot", "n", "even", "odd")).alias("a"))
    pairs = rows.select("word", F.struct("doc", "spot", "n", "even", "odd").alias("b")).join(_small(first, count), "word")
    pairs = pairs.where(_earlier("a.doc", "a.spot", "b.doc", "b.spot") & _may_match(F.least("a.n", "b.n"), F.greatest("a.n", "b.n"), percent))
    return pairs.select("a.doc", "a.spot", F.col("b.doc").alias("late_doc"), F.col("b.spot").alias("late_spot")).distinct()


def _may_match(smaller: Column, larger: Column, percent: int) -> Column:
    """Length and bitmap filter of rows a and b."""
    evens, odds = F.col("a.even").bitwiseXOR(F.col("b.even")), F.col("a.odd").bitwiseXOR(F.col("b.odd"))
    apart = F.when(smaller > LONG, F.bit_count(evens) + F.bit_count(odds)).otherwise(F.bit_count(evens.bitwiseXOR(odds)))
    return (100 * smaller >= percent * larger) & ((100 + percent) * (smaller + larger - apart) >= 2 * percent * (smaller + larger))


def _candidates(short: DataFrame, long: DataFrame, settled: DataFrame, percent: int) -> DataFrame:
    """Pairs (doc, spot, late_doc, late_spot) of lines that pass all filters and whose later one is not settled yet."""
    known = _small(settled.withColumn("known", F.lit(True)), settled.count())

    def rows(side: DataFrame) -> DataFrame:
        marked = side.where("word is not null and n is not null").join(known, ["doc", "spot"], "left")
        # The size, the place of the word and whether the line is settled are one number: fewer columns to sort, and to read for each pair.
        size = F.call_function("shiftleft", F.col("n").cast("long"), F.lit(32)).bitwiseOR(F.call_function("shiftleft", F.col("at").cast("long"), F.lit(1)))
        return marked.select(size.bitwiseOR(F.when(F.col("known"), 1).otherwise(0).cast("long")).alias("size"), "odd", "doc", "spot", "even", "word")

    # a is the smaller set; of it the shorter prefix that suffices towards sets of its size or more. Conditions
    # name both sides and nulls are out before, so that no filter is pushed to one side only and all read one shuffle of the shorter prefixes.
    n = lambda side: F.shiftright(F.col(f"{side}.size"), 32)
    at = lambda side: F.shiftright(F.col(f"{side}.size").bitwiseAND(F.lit(0xFFFFFFFF)), 1)
    known_ = lambda side: F.col(f"{side}.size").bitwiseAND(F.lit(1)) == 1
    order = (n("a") < n("b")) | ((n("a") == n("b")) & ((F.col("a.doc") < F.col("b.doc")) | ((F.col("a.doc") == F.col("b.doc")) & (F.col("a.spot") < F.col("b.spot")))))
    both = n("a") + n("b")
    rest = F.least(n("a") - at("a"), n("b") - at("b"))
    # One of the two is not settled, and it is the later one.
    open_ = ~(known_("a") & known_("b")) & F.when(_earlier("a.doc", "a.spot", "b.doc", "b.spot"), ~known_("b")).otherwise(~known_("a"))
    # Tests that are cheap and leave few pairs come first.
    near = order & _may_match(n("a"), n("b"), percent) & ((100 + percent) * rest >= percent * both) & open_

    def met(b: DataFrame) -> DataFrame:
        pairs = rows(short).alias("a").join(rows(b).alias("b"), (F.col("a.word") == F.col("b.word")) & near)
        return pairs.select(F.col("a.doc").alias("d1"), F.col("a.spot").alias("s1"), F.col("b.doc").alias("d2"), F.col("b.spot").alias("s2"))

    found = met(short).unionByName(met(long)).distinct()
    one, two = F.struct(F.col("d1").alias("doc"), F.col("s1").alias("spot")), F.struct(F.col("d2").alias("doc"), F.col("s2").alias("spot"))
    first = _earlier("d1", "s1", "d2", "s2")
    found = found.where(first | _earlier("d2", "s2", "d1", "s1")).select(F.when(first, one).otherwise(two).alias("x"), F.when(first, two).otherwise(one).alias("y"))
    return found.select("x.doc", "x.spot", F.col("y.doc").alias("late_doc"), F.col("y.spot").alias("late_spot"))


def _contents(docs: DataFrame, id_col: str, text_col: str, pairs: DataFrame) -> DataFrame:
    """doc, spot, number of distinct words and these words, with blanks between them, of the lines in pairs. Only documents that have such a line are split."""
    named = freeze(pairs.select("doc", "spot").unionByName(pairs.select(F.col("late_doc").alias("doc"), F.col("late_spot").alias("spot"))).distinct(), "line-names")
    lines = named.count()
    ids = named.select(F.col("doc").alias("named_doc")).distinct()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    texts = texts.join(_small(ids, lines), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)) == F.col("named_doc"), "left_semi")
    found = _lines(texts, "doc_id", "text").select("doc", "spot", "line").join(_small(named, lines), ["doc", "spot"], "left_semi")
    # One text is smaller in sorts and shuffles than an array of words, each padded and with its place.
    found = found.select("doc", "spot", tokens(F.col("line")).alias("words"))
    return found.select("doc", "spot", F.size("words").alias("n"), F.array_join("words", " ").alias("words")).dropDuplicates(["doc", "spot"])


def _verified(pairs: DataFrame, near: DataFrame, percent: int) -> DataFrame:
    """The later lines (doc, spot) of pairs whose sets of words are similar."""
    late = near.select(F.col("doc").alias("late_doc"), F.col("spot").alias("late_spot"), F.col("n").alias("late_n"), F.col("words").alias("late_words"))
    sided = pairs.join(late, ["late_doc", "late_spot"]).join(near, ["doc", "spot"])
    # No word has a blank in it. The numbers of words come with the rows, so that each text is split once.
    common = F.size(F.array_intersect(F.split("words", " "), F.split("late_words", " ")))
    similar = sided.where((100 + percent) * common >= percent * (F.col("n") + F.col("late_n")))
    return similar.select(F.col("late_doc").alias("doc"), F.col("late_spot").alias("spot")).distinct()


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """Per distinct (doc_id, text): doc_id, sig, n_lines, n_removed, removed (numbers of the removed lines from 0) and all_removed.

    Lines are what stands between newlines; a line without words is never removed. A null text has no
    lines. all_removed: every line with words goes. Lines at the same place of rows of equal id are not earlier than one
    another; rows without an id come last and are not earlier than one another. Other columns are not read. An
    empty table gives no rows. Ids are whole numbers.
    """
    lines = _lines(docs, id_col, text_col)
    index = freeze(lines.drop("line"), "lines")
    # Equal lines: 64 bits of the hash, and the 32 others in the place of the first one.
    worded = index.where("id is not null").withColumn("more", F.col("spot").bitwiseAND(F.lit(0xFFFFFFFF)))
    firsts = worded.groupBy("id", "more").agg(F.min("doc").alias("doc"), F.count("*").alias("n"))
    repeated = freeze(worded.join(firsts.where("n > 1").drop("n"), ["id", "more", "doc"]).groupBy("id", "more").agg(F.min("doc").alias("first_doc"), F.min("spot").alias("first_spot")), "repeated-lines")
    more = F.col("spot").bitwiseAND(F.lit(0xFFFFFFFF)).alias("more")
    marked = lines.where("id is not null").select("id", more, "doc", "spot", "line").join(_small(repeated, repeated.count()), ["id", "more"], "left")
    distinct = marked.where("first_doc is null or (doc = first_doc and spot = first_spot)").select("doc", "spot", "line")
    hashed = freeze(_hashed(distinct), "line-hashes", PLAIN)
    hash_files = frozen()[-1]
    prefixes = freeze(_prefixes(hashed, _ranks(hashed), percent), "line-prefixes", PLAIN)
    prefix_files = frozen()[-1]
    release(docs.sparkSession, [hash_files])
    short, long = _unfolded(prefixes, percent)

    # In a crowd of like lines nearly all are settled by the earliest one; only the others meet every candidate.
    stars = freeze(_stars(short, long, percent), "line-stars")
    settled = freeze(_verified(stars, _contents(docs, id_col, text_col, stars), percent), "settled-lines")
    pairs = freeze(_candidates(short, long, settled, percent), "line-pairs")
    release(docs.sparkSession, [prefix_files])
    similar = freeze(settled.unionByName(_verified(pairs, _contents(docs, id_col, text_col, pairs), percent)).distinct(), "similar-lines")

    # A removed first line takes its copies with it; copies of any line go.
    firsts = repeated.select(F.col("first_doc").alias("doc"), F.col("first_spot").alias("spot"), "id", "more")
    taken = firsts.join(similar, ["doc", "spot"], "left_semi").select("id", "more", F.lit(True).alias("taken"))
    copies = worded.join(repeated.join(taken, ["id", "more"], "left"), ["id", "more"]).where(F.col("taken") | _earlier("first_doc", "first_spot", "doc", "spot"))
    alone = index.where("id is not null").join(similar, ["doc", "spot"], "left_semi")
    gone = copies.select("doc_id", "sig", "line_no").unionByName(alone.select("doc_id", "sig", "line_no")).groupBy("doc_id", "sig").agg(F.sort_array(F.collect_set("line_no")).alias("removed"))
    # Rows of equal id and text have the same lines: worded ones of one of them are all of them, divided by the number of first lines.
    base = index.groupBy("doc_id", "sig").agg((F.coalesce(F.max("line_no"), F.lit(-1)) + 1).alias("n_lines"), F.count("id").alias("all_worded"), F.count(F.when(F.col("line_no") == 0, 1)).alias("rows"))
    worded = F.col("all_worded") / F.greatest("rows", F.lit(1))
    n = F.coalesce(F.size("removed"), F.lit(0))
    found = base.alias("base").join(gone.alias("gone"), F.col("base.doc_id").eqNullSafe(F.col("gone.doc_id")) & F.col("base.sig").eqNullSafe(F.col("gone.sig")), "left")
    return found.select(
        "base.doc_id", "base.sig", "n_lines", n.alias("n_removed"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"), ((n > 0) & (n == worded)).alias("all_removed"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """The rows of docs, with all their columns, without repeated lines; rows that lose every line with words go."""
    rows = T.numbered(docs)  # whatever the columns are called
    id_, text = (rows.columns[docs.columns.index(c)] for c in (id_col, text_col))
    found = repeated_lines(rows, id_, text, percent).where("n_removed > 0")
    found = freeze(found.select(F.col("doc_id").alias("found_id"), F.col("sig").alias("found_sig"), "removed", "all_removed"), "removed-lines")
    left = rows.join(found, rows[id_].eqNullSafe(found["found_id"]) & (F.xxhash64(rows[text]) == found["found_sig"]), "left").where("all_removed is null or not all_removed")
    kept = F.array_join(F.filter(F.split(F.col(text), "\n"), lambda x, i: ~F.array_contains("removed", i)), "\n")
    new = F.when(F.col("removed").isNull(), F.col(text)).otherwise(kept)
    return left.select(*[new.alias(c) if c == text else F.col(c) for c in rows.columns]).toDF(*docs.columns)
