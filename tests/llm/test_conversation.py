"""Conversation repair against a search over all edits, row by row in Python."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from weftline.llm import conversation

ROWS = "conv_id long, turn long, role string, text string, audit string, `a.b` int"
BLANK = re.compile(r"[\x20\x09-\x0D]*\Z")


def damaged(rows):
    out = []
    say = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        role, text = say(role), say(text)
        harm = zlib.crc32(f"{say(conv)}:{say(turn)}".encode()) % 20
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        out += [(conv, turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return out


def cheapest(rows):
    """Dijkstra over (rows done, initials so far as a state), least cost and then least audit."""
    goal = {"": True, "s": False, "u": False, "a": True}
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if i == len(rows) and goal[state]:
            return cost, audit, lines
        if (i, state) in seen:
            continue
        seen.add((i, state))
        for made, word in (("u", "user"), ("a", "assistant")):
            if made in after[state]:
                heapq.heappush(heap, (cost + 5, audit + "I", i, made, (*lines, (word, ""))))
                if i < len(rows) and rows[i][2] not in ("blank", "duplicate"):
                    more = 5 if rows[i][2] == "truncated" else 0
                    heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, made, (*lines, (word, rows[i][1]))))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, lines))
            if fault not in ("blank", "duplicate") and role[:1] and role[:1] in after[state]:
                heapq.heappush(heap, (cost + (5 if fault else 0), audit + "K", i + 1, role[:1], (*lines, (role, text))))


def expected(rows, original):
    out = []
    for conv in {r[0] for r in original}:
        own = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        seen, faults = set(), []
        for _, _, role, text in own:
            bare = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = "blank" if BLANK.match(text) else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append((role, text, fault))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, lines = cheapest(faults)
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        counts = [sum(f == k for *_, f in faults) for k in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()))
    return out


def rows():
    random.seed(5)
    texts = ["Yes.", "No!", "Why?  ", "cut off", "", " \t", "Fine.\n", "…", "say é.", "x" * 5000 + "."]
    out = []
    for conv in range(120):
        for turn in range(random.randint(0, 12)):
            role = random.choice(["user", "assistant"]) if random.random() < 0.4 else "user" if turn % 2 == 0 else "assistant"
            role = random.choice(["system", "tool", "unknown", "", "User", None]) if random.random() < 0.15 else role
            out.append((conv, turn * random.choice([1, 1, 1, 3]) if conv % 2 else turn, role, random.choice(texts) if random.random() < 0.5 else f"text {random.random()}."))
    out += [(200, None, "user", "a."), (200, None, "assistant", "b."), (200, 3, "user", "a."), (201, None, None, None), (None, 1, "user", "q?"), (None, None, "assistant", "r."), (None, 2, "assistant", "r.")]
    out += [(202, 1, "user", "same.")] * 5 + [(203, 5, "assistant", "tie."), (203, 5, "user", "tie."), (203, 5, "user", "other."), (203, -9, "system", "s.")]
    out += [(204, t, "user" if t % 2 == 0 else "assistant", f"{t % 7}.") for t in range(70)] + [(205, (1 << 62), "user", "hi."), (205, -(1 << 62) - 5, "assistant", "hi.")]
    random.shuffle(out)
    return out


def order(x):
    return x[0] is None, x[0] or 0


@pytest.mark.parametrize("word, together", [(512, 64), (3, 2)])
def test_against_search(spark, monkeypatch, word, together):
    """Whole words, and conversations of many words that are joined in rounds."""
    monkeypatch.setattr(conversation, "WORD", word)
    monkeypatch.setattr(conversation, "ROUND", together)
    data = rows()
    frame = spark.createDataFrame([(*r, "x", 1) for r in data], ROWS).repartition(5)
    found = [tuple(r) for r in conversation.repair_report(frame, conversation.damaged(frame)).collect()]
    want = expected(damaged(data), data)
    for got, ref in zip(sorted(found, key=order), sorted(want, key=order), strict=True):
        if got[0] == 205:  # the span is more than a long holds
            assert got[1] == conversation.LONGEST
            got, ref = got[:1] + got[2:], ref[:1] + ref[2:]
        assert got == ref


def test_repaired_rows(spark):
    data = [r for r in rows() if r[2] is not None and r[3] is not None]
    frame = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    verdicts = conversation.judged(frame)
    lines = {}
    for r in conversation.repaired(frame, verdicts).collect():
        lines.setdefault(r.conv_id, {})[r.place] = f"{r.role}:{r.text}"
    hashes = {r.conv_id: r.repaired_sha256 for r in conversation.digests(frame, verdicts).collect()}
    want = {x[0]: x for x in expected(data, data)}
    for conv, x in want.items():
        own = lines.get(conv, {})
        assert sorted(own) == list(range(len(own)))
        assert hashlib.sha256("\n".join(own[k] for k in sorted(own)).encode()).hexdigest() == hashes[conv] == x[-1]
        assert re.fullmatch("(s?(ua)+)?", "".join(own[k][:1] for k in sorted(own)))


def test_automaton_shares_endings():
    """Every node is built once, in whatever order words with like endings come."""
    import pyarrow as pa

    made = []
    solve = conversation.node
    words = sorted({"".join(random.choices("suaoSUAOx", k=k % 9)) for k in range(300)}, key=lambda w: w[::-1])
    try:
        conversation.node = lambda sign, rest: made.append(sign) or solve(sign, rest)
        batch = pa.RecordBatch.from_pydict({"word": words, "last": [True] * len(words)})
        (out,) = list(conversation._solved([batch]))
    finally:
        conversation.node = solve
    assert len(made) == len({w[k:] for w in words for k in range(len(w))})
    assert len(out.column("costs")) == len(words)


def test_empty(spark):
    none = spark.createDataFrame([], ROWS)
    assert conversation.repair_report(none, conversation.damaged(none)).count() == 0
    gone = spark.createDataFrame([(c, t, "user", "a.", "x", 1) for c in range(40) for t in range(20) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0], ROWS)
    found = conversation.repair_report(gone, conversation.damaged(gone)).collect()
    assert found and {tuple(r)[1:] for r in found} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
