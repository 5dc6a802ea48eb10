"""One registered query per operator, over whole tables, with a SQL twin where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weftline.llm import conversation, decontaminate, language, line_dedup, merkle, ngram_join, packing, quality, sharding, substring_dedup, toxicity, warc, whitening
from weftline.queries.registry import Tables
from weftline.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(tune(spark), folder))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def held_out(parts: int, part: int) -> Column:
    """Rows whose labels are never learnt from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts)) == part


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_decontaminate")
def op1(t: Tables) -> DataFrame:
    """Every document that holds a benchmark item, with the place and the alignment's score."""
    return decontaminate.contaminated(t.documents, t.benchmark)


WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


@query("op2_substring_dedup", rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
first AS (SELECT g, min(doc_id) AS first FROM windows GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM windows JOIN first USING (g) WHERE first < doc_id),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""")
def op2(t: Tables) -> DataFrame:
    found = substring_dedup.substring_dedup(t.documents)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_toxicity")
def op3(t: Tables) -> DataFrame:
    model = toxicity.learn(t.documents, t.labels.where(~held_out(4, 2)))
    scored = toxicity.toxicity(t.documents, model)
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "matches")


@query("op4_line_dedup", r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS n FROM documents),
s AS (SELECT doc_id, n, list_distinct(list_filter(regexp_split_to_array(lower(line), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS w FROM l),
classes AS (SELECT list_sort(w) AS w, min((doc_id, n)) AS place FROM s WHERE len(w) > 0 GROUP BY ALL),
token AS (SELECT place, len(w) AS size, unnest(w) AS t FROM classes),
df AS (SELECT t, count(*) AS df FROM token GROUP BY t),
prefix AS (SELECT place, size, t, row_number() OVER (PARTITION BY place ORDER BY df, t) AS k FROM token JOIN df USING (t) QUALIFY k <= size - ceil(0.8 * size) + 1),
pairs AS (SELECT DISTINCT a.place AS early, b.place AS late FROM prefix a JOIN prefix b ON a.t = b.t AND a.place < b.place AND a.size * 10 >= b.size * 8 AND b.size * 10 >= a.size * 8),
near AS (SELECT DISTINCT late FROM pairs JOIN classes x ON x.place = early JOIN classes y ON y.place = late
  WHERE 100 * len(list_intersect(x.w, y.w)) >= 80 * (len(x.w) + len(y.w) - len(list_intersect(x.w, y.w)))),
gone AS (SELECT doc_id, n FROM s JOIN classes c ON list_sort(s.w) = c.w WHERE (doc_id, n) > place OR place IN (SELECT late FROM near)),
each AS (SELECT doc_id, count(*) AS n_removed, string_agg(n, ',' ORDER BY n) AS removed FROM gone GROUP BY doc_id)
SELECT doc_id, max(n)::INTEGER + 1 AS n_lines, coalesce(max(n_removed), 0)::INTEGER AS n_removed, coalesce(max(removed), '') AS removed,
  coalesce(max(n_removed), 0) > 0 AND coalesce(max(n_removed), 0) = count(*) FILTER (len(w) > 0) AS all_removed
FROM s LEFT JOIN each USING (doc_id) GROUP BY doc_id""")
def op4(t: Tables) -> DataFrame:
    found = line_dedup.repeated_lines(t.documents)
    return found.select("doc_id", "n_lines", "n_removed", F.array_join("removed", ",").alias("removed"), "all_removed")


@query("op5_warc", r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS h, min(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INTEGER) & 31) + 1)::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM d""")
def op5(t: Tables) -> DataFrame:
    read = warc.read_warc(warc.write_warc(t.pages), payloads=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op6_quality")
def op6(t: Tables) -> DataFrame:
    stats = quality.measured(t.documents)
    model = quality.learn(stats, t.labels.where(~held_out(3, 1)))
    return quality.score(stats, model).select("doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op7_sharding")
def op7(t: Tables) -> DataFrame:
    found = sharding.shard(t.documents, shards=8)
    return found.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query("op8_merkle")
def op8(t: Tables) -> DataFrame:
    return merkle.fingerprints(t.documents)


@query("op9_ngram_join", rf"""
WITH RECURSIVE d AS (SELECT doc_id, list_transform({WORDS}, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w FROM documents),
grams AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM grams a JOIN grams b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, least(d.doc_id, min(b)) AS component_id
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id""")
def op9(t: Tables) -> DataFrame:
    return ngram_join.ngram_jaccard_join(t.documents)


@query("op10_packing")
def op10(t: Tables) -> DataFrame:
    return packing.best_fit_packing(t.documents, tokenizer())


@query("op11_language_id")
def op11(t: Tables) -> DataFrame:
    model = language.learn(t.documents.where(~held_out(4, 2)))
    found = language.detect(t.documents, model)
    return found.select("doc_id", F.coalesce(held_out(4, 2), F.lit(False)).alias("held_out"), "lang_pred", "score")


def crc32_sql(text: str) -> str:
    """CRC-32 of a text's bytes, bit by bit."""
    byte = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    bits = "list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    return f"xor(list_reduce(list_prepend(4294967295, {byte}), lambda a, b: {bits}), 4294967295)"


def _repair_sql() -> str:
    """Costs and audits from the end of each conversation; a key is eight digits of cost and the audit."""
    add = lambda k, cost, edit: f"(lpad((substr({k}, 1, 8)::BIGINT + {cost})::VARCHAR, 8, '0') || '{edit}' || substr({k}, 9))"
    made = (2, 2, 3, 2)
    kept = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})

    def least(q: int) -> str:
        own = [add(f"w{q}", 2, "D"), f"CASE WHEN sign <> 'x' THEN {add(f'w{made[q]}', '1 + more', 'R')} END"]
        own += [f"CASE WHEN sign = '{c}' THEN {add(f'w{to}', 'more', 'K')} END" for c, to in kept[q].items()]
        return f"list_min([{', '.join(own)}]) AS b{q}"

    w2, w3 = f"list_min([b2, {add('b3', 5, 'I')}])", f"list_min([b3, {add('b2', 5, 'I')}])"
    inserted = f"list_min([b0, {add('w2', 5, 'I')}]) AS w0, list_min([b1, {add('w2', 5, 'I')}]) AS w1, w2, w3"
    return rf"""
WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
h AS (SELECT *, {crc32_sql('k')} % 20 AS h FROM c),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE h <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i, left(role, 1) AS initial,
  regexp_matches(text, '[^ 	-
]') AS said, right(regexp_replace(text, '[ 	-
]+$', ''), 1) NOT IN ('.', '!', '?') AS cut FROM d),
f AS (SELECT *, said AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
r AS (SELECT conv_id, i, turn, role, text, CASE WHEN NOT said OR again THEN 'x' WHEN initial IN ('s', 'u', 'a') THEN initial ELSE 'o' END AS sign, CASE WHEN said AND NOT again AND cut THEN 5 ELSE 0 END AS more,
  NOT said AS blank, again, before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au') AS illegal FROM f),
n AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate,
  count(*) FILTER (more > 0) AS truncated, count(*) FILTER (illegal) AS illegal FROM r GROUP BY conv_id),
t AS (SELECT conv_id, n + 1 AS i, '00000000' AS w0, '00000010II' AS w1, '00000005I' AS w2, '00000000' AS w3 FROM n
  UNION ALL SELECT conv_id, i, {inserted} FROM (SELECT *, {w2} AS w2, {w3} AS w3 FROM (SELECT r.conv_id, r.i, {', '.join(map(least, range(4)))} FROM t JOIN r ON r.conv_id IS NOT DISTINCT FROM t.conv_id AND r.i = t.i - 1))),
best AS (SELECT conv_id, substr(w0, 1, 8)::BIGINT AS cost, substr(w0, 9) AS audit FROM t WHERE i = 1),
e AS (SELECT *, sum(CASE WHEN edit <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY p) AS i FROM (SELECT conv_id, unnest(range(1, length(audit) + 1)) AS p, unnest(string_split(audit, '')) AS edit FROM best WHERE audit <> '')),
l AS (SELECT e.conv_id, edit, role, text, row_number() OVER (PARTITION BY e.conv_id ORDER BY p) AS place FROM e LEFT JOIN r ON edit <> 'I' AND r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.i = e.i WHERE edit <> 'D'),
s AS (SELECT *, first_value(edit = 'K' AND left(role, 1) = 's') OVER (PARTITION BY conv_id ORDER BY place)::BIGINT AS system FROM l),
x AS (SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY place)) AS sha FROM s GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN x ON x.conv_id IS NOT DISTINCT FROM a.conv_id"""


@query("op12_conversation_repair", _repair_sql())
def op12(t: Tables) -> DataFrame:
    return conversation.repair_report(t.conversations, conversation.damaged(t.conversations))


@query("op13_whitening")
def op13(t: Tables) -> DataFrame:
    return whitening.whiten(t.embeddings, whitening.fit(t.embeddings))
