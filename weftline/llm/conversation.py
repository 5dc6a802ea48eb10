"""Conversation structure repair with a suffix-shared automaton.

A conversation should read `(s?(ua)+)?` in the initials of its roles. Rows may be kept (K, free), get the role user or assistant
(R, 1), be deleted (D, 2) or stand behind an inserted empty row (I, 5); a truncated row that is not deleted
costs 5 more, and blank and duplicate rows must be deleted. The grammar has four states (nothing yet, after a
system row, after a user row, after an assistant row), in each of which one edit of a kind leads to one state.

1. Rows become light: conversation, turn, role, digest of the text, fault. Equal rows are counted before the shuffle; the
   first of equal rows is found by an aggregate over (conversation, role, digest), not in one group for each conversation.
2. Light rows are dealt out by ranges of (conversation, turn, role, digest), so a conversation of any length lies in as many
   tasks as it needs. A row's role and fault make one of nine signs; a task writes words of at most WORD signs.
3. Distinct words are sorted by their reversed signs. Read in that order, words that end alike follow one another: the
   nodes of an automaton that shares all suffixes are the stack of the common ending, each is built once, and its
   cost-to-go and least audit are computed once for every grammar state, for all conversations that end so.
4. Words of one conversation are joined as products of (state, state) tables in rounds of ROUND words. Nearly all conversations are one word.
5. Whole rows are sorted by conversation behind its audit and edited as a stream: only a SHA-256 state is held.
"""

from __future__ import annotations

import hashlib
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from weftline.session import freeze

WORD = 512  # signs of a word
ROUND = 64  # words joined at once

# --- fixed values: costs ---
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# --- end of fixed values ---
BLANKS = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
GOALS = (START, ASSISTANT)  # states in which a conversation may end
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})  # state -> initial -> state
MADE = (USER, USER, ASSISTANT, USER)  # state -> state after a rerole or an insertion
LONGEST = (1 << 63) - 1

Best = tuple[int, str] | None  # cost and audit
Table = list[list[Best]]  # state -> exit -> best


# ---------------------------------------------------------------- costs and audits

def _inserted(table: Table) -> Table:
    """An insertion may come first in every state. Two in a row come from the second step; a third only closes a circle."""
    exits = range(len(table[0]))
    for _ in range(2):
        table = [[_least(table[q][x], _then(INSERT, "I", table[MADE[q]][x])) for x in exits] for q in range(4)]
    return table


def _least(a: Best, b: Best) -> Best:
    return b if a is None else a if b is None else min(a, b)


def _then(cost: int, edit: str, rest: Best) -> Best:
    return rest and (cost + rest[0], edit + rest[1])


def root(goals: tuple[int, ...] | None) -> Table:
    """The node after the last sign. goals: one exit, at the end of a conversation; None: an exit for each state."""
    if goals is None:
        return _inserted([[(0, "") if q == x else None for x in range(4)] for q in range(4)])
    return _inserted([[(0, "") if q in goals else None] for q in range(4)])


def node(sign: str, rest: Table) -> Table:
    """The node before `rest`: x stands for a row that must go; s, u, a and o (other) for roles, in capitals if truncated."""
    exits = range(len(rest[0]))
    table = [[_then(DELETE, "D", rest[q][x]) for x in exits] for q in range(4)]
    if sign != "x":
        more = TRUNCATED if sign.isupper() else 0
        for q in range(4):
            kept = NEXT[q].get(sign.lower())
            for x in exits:
                if kept is not None:
                    table[q][x] = _least(table[q][x], _then(more, "K", rest[kept][x]))
                table[q][x] = _least(table[q][x], _then(more + REROLE, "R", rest[MADE[q]][x]))
    return _inserted(table)


def joined(first: Table, second: Table) -> Table:
    """Both words, one after the other."""
    out = [[None] * len(second[0]) for _ in range(4)]
    for q in range(4):
        for x in range(len(second[0])):
            for between in range(4):
                a, b = first[q][between], second[between][x]
                if a is not None and b is not None:
                    out[q][x] = _least(out[q][x], (a[0] + b[0], a[1] + b[1]))
    return out


_COLUMNS = "costs array<long>, audits array<string>"


def _flat(tables: list[Table]) -> dict[str, pa.Array]:
    cells = [[cell for row in t for cell in row] for t in tables]
    return {"costs": pa.array([[c and c[0] for c in x] for x in cells], pa.list_(pa.int64())), "audits": pa.array([[c and c[1] for c in x] for x in cells], pa.list_(pa.string()))}


def _table(costs: list, audits: list) -> Table:
    exits = len(costs) // 4
    cells = [None if c is None else (c, a) for c, a in zip(costs, audits)]
    return [cells[q * exits: (q + 1) * exits] for q in range(4)]


def _solved(batches):
    """Tables of words that come in the order of their reversed signs, the last words of conversations apart."""
    stack, path, kind = [], "", None
    for batch in batches:
        words, tables = batch.column("word").to_pylist(), []
        for word, last in zip(words, batch.column("last").to_pylist()):
            back = word[::-1]
            if last != kind:
                kind, path, stack = last, "", [root(GOALS if last else None)]
            common = 0
            while common < len(path) and common < len(back) and path[common] == back[common]:
                common += 1
            del stack[common + 1:]
            for sign in back[common:]:
                stack.append(node(sign, stack[-1]))
            path = back
            # Of a whole conversation only the start is asked; others need every state.
            tables.append(stack[-1])
        yield pa.RecordBatch.from_pydict({"word": batch.column("word"), "last": batch.column("last"), **_flat(tables)})


# ---------------------------------------------------------------- rows

def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role and text of rows after the damage that crc32 of `conv_id:turn` deals out; nulls are one blank."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), said(role_col).alias("role"), said(text_col).alias("text"))
    rows = rows.withColumn("harm", F.crc32(F.concat_ws(":", said("conv_id"), said("turn")).cast("binary")) % 20).where("harm <> 0")
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "harm")
    return rows.withColumn("copy", F.explode(F.when(F.col("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("harm", "copy")


def _digest() -> Column:
    return F.unhex(F.sha2("text", 256))


def light(rows: DataFrame) -> DataFrame:
    """One row for equal rows of a turn: conv_id, turn, role, digest, n, blank, truncated, seen (equal to a row of an earlier turn)."""
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    blank = trimmed == ""
    rows = rows.select("conv_id", "turn", "role", _digest().alias("digest"), blank.alias("blank"), (~blank & ~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    rows = rows.groupBy("conv_id", "turn", "role", "digest").agg(F.count("*").alias("n"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated"))
    rows = freeze(rows, "turns")
    # A null turn is the first one.
    place = F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("turn"))
    first = rows.groupBy("conv_id", "role", "digest").agg(F.min(place).alias("first"))
    a, b = rows.alias("a"), first.alias("b")
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.role") == F.col("b.role")) & (F.col("a.digest") == F.col("b.digest"))
    return a.join(b, same).select("a.*", (~F.col("a.turn").eqNullSafe(F.col("b.first.turn"))).alias("seen"))


_PIECE = "conv_id {kind}, task int, place long, word string, rows long, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, first_turn long, last_turn long, first_role string, last_role string"
_SUMS = ("rows", "blank", "duplicate", "truncated", "illegal")


def _follows(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


class _Piece:
    """Signs and counts of some rows of a conversation that follow one another."""

    def __init__(self):
        self.signs: list[str] = []
        self.counts = dict.fromkeys(_SUMS, 0)
        self.turns, self.low, self.high = 0, None, None
        self.ends: list = [None, None, None, None]  # first and last turn, first and last role

    def add(self, sign: str, fault: str, initial: str, turn, n: int) -> None:
        self.signs.append(sign * n)
        c = self.counts
        if c["rows"]:
            c["illegal"] += not _follows(self.ends[3], initial)
        c["illegal"] += (n - 1) * (not _follows(initial, initial))
        if turn is not None:
            self.turns += not c["rows"] or self.ends[1] != turn
            self.low, self.high = turn if self.low is None else self.low, turn
        if not c["rows"]:
            self.ends[0], self.ends[2] = turn, initial
        self.ends[1], self.ends[3] = turn, initial
        c["rows"] += n
        if fault:
            c[fault] += n


def _pieces(kind: pa.DataType, batches):
    """Light rows in order, as pieces of at most WORD signs."""
    from pyspark import TaskContext

    task, piece, conv, begun, place = TaskContext.get().partitionId(), _Piece(), None, False, 0
    out: list[tuple] = []

    def close():
        nonlocal piece, place
        if piece.signs:
            out.append((conv, task, place, "".join(piece.signs), *(piece.counts[k] for k in _SUMS), piece.turns, piece.low, piece.high, *piece.ends))
            place += 1
        piece = _Piece()

    def written():
        columns = list(zip(*out))
        types = [kind, pa.int32(), pa.int64(), pa.string(), *[pa.int64()] * 10, pa.string(), pa.string()]
        names = ["conv_id", "task", "place", "word", *_SUMS, "turns", "low", "high", "first_turn", "last_turn", "first_role", "last_role"]
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
        out.clear()
        return batch

    for batch in batches:
        for row in batch.to_pylist():
            if not begun or row["conv_id"] != conv:
                close()
                conv, begun, place = row["conv_id"], True, 0
            initial = row["role"][:1]
            sign = initial if initial in ("s", "u", "a") else "o"
            if row["truncated"]:
                sign = sign.upper()
            left = [("x", "blank", row["n"])] if row["blank"] else [("x", "duplicate", row["n"])] if row["seen"] else [
                (sign, "truncated" if row["truncated"] else "", 1), ("x", "duplicate", row["n"] - 1)]
            for mark, fault, n in left:
                while n:
                    room = min(n, WORD - piece.counts["rows"])
                    piece.add(mark, fault, initial, row["turn"], room)
                    n -= room
                    if piece.counts["rows"] == WORD:
                        close()
                        if len(out) >= 1000:
                            yield written()
        if len(out) >= 1000:
            yield written()
    close()
    if out:
        yield written()


def _joined(key, table: pa.Table) -> pa.Table:
    """The rows of a group, in order, as one."""
    rows = table.sort_by([("task", "ascending"), ("place", "ascending")]).to_pylist()
    # From the end, so that whole conversations keep one exit.
    solved = _table(rows[-1]["costs"], rows[-1]["audits"])
    for row in reversed(rows[:-1]):
        solved = joined(_table(row["costs"], row["audits"]), solved)
    one = {**rows[0], "task": 0, "place": key[1].as_py()}
    for row in rows[1:]:
        for k in _SUMS:
            one[k] += row[k]
        one["illegal"] += not _follows(one["last_role"], row["first_role"])
        one["turns"] += row["turns"] - (row["first_turn"] is not None and row["first_turn"] == one["last_turn"])
        one["low"], one["high"] = row["low"] if one["low"] is None else one["low"], row["high"] if row["high"] is not None else one["high"]
        one["last_turn"], one["last_role"] = row["last_turn"], row["last_role"]
    fields = [f for f in table.schema if f.name not in ("costs", "audits", "round")]
    return pa.table({**{f.name: pa.array([one[f.name]], f.type) for f in fields}, **_flat([solved])})


def judged(rows: DataFrame) -> DataFrame:
    """Per conversation with rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    kind = rows.schema["conv_id"].dataType
    turns = freeze(light(rows), "judged-turns")
    ordered = turns.repartitionByRange("conv_id", "turn", "role", "digest").sortWithinPartitions("conv_id", "turn", "role", "digest")
    pieces = freeze(ordered.mapInArrow(lambda b, f=partial(_pieces, to_arrow_type(kind)): f(b), _PIECE.format(kind=kind.simpleString())), "words")
    ends = pieces.groupBy("conv_id").agg(F.max(F.struct("task", "place")).alias("end"), F.count("*").alias("words"))
    p, e = pieces.alias("p"), ends.alias("e")
    pieces = freeze(p.join(e, F.col("p.conv_id").eqNullSafe(F.col("e.conv_id"))).select(
        "p.*", "words", ((F.col("p.task") == F.col("end.task")) & (F.col("p.place") == F.col("end.place"))).alias("last")), "placed-words")

    distinct = pieces.select("word", "last").distinct().withColumn("back", F.reverse("word"))
    ordered = distinct.repartitionByRange("last", "back").sortWithinPartitions("last", "back").select("word", "last")
    solved = freeze(ordered.mapInArrow(_solved, f"word string, last boolean, {_COLUMNS}"), "solved-words")
    whole = pieces.join(solved, ["word", "last"]).drop("word", "last")

    done, more = whole.where("words = 1"), pieces.where("words > 1")
    if not more.isEmpty():
        more = freeze(whole.where("words > 1"), "long-conversations")
        while True:
            ranked = _numbered(more)
            more = freeze(ranked.groupBy("conv_id", "round").applyInArrow(lambda key, table: _joined(key, table), more.schema), "long-conversations")
            if more.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
                break
        done = done.unionByName(more)
    first = lambda c: F.element_at(c, 1)  # noqa: E731  the start state; a whole conversation has one exit
    span = F.col("high").cast("decimal(20,0)") - F.col("low") + 1 - F.col("turns")
    gaps = F.when(span.isNull(), 0).otherwise(F.least(span, F.lit(LONGEST))).cast("long")
    return done.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", first("costs").alias("cost"), first("audits").alias("audit"))


def _numbered(words: DataFrame) -> DataFrame:
    """Words with `round`: ROUND of them that follow one another share a number. Words of one task lie in order, tasks too."""
    counts = words.groupBy("conv_id", "task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))  # a row for each task
    start = counts.select(F.col("conv_id").alias("_conv"), F.col("task").alias("_task"), F.coalesce(before, F.lit(0)).alias("before"))
    found = words.join(start, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("task") == F.col("_task")))
    return found.withColumn("round", F.floor((F.col("before") + F.col("place")) / ROUND)).drop("_conv", "_task", "before")


# ---------------------------------------------------------------- repair

def _lines(batches):
    """Lists of (conv_id, place, role, text) after all edits; place -1 begins a conversation."""
    conv, audit, at, state, place = None, "", 0, START, 0
    for batch in batches:
        lines = []

        def say(role: str, text: str) -> None:
            nonlocal place
            lines.append((conv, place, role, text))
            place += 1

        def made(text: str) -> None:
            nonlocal state
            state = MADE[state]
            say("user" if state == USER else "assistant", text)

        for c, head, role, text in zip(*[batch.column(k).to_pylist() for k in ("conv_id", "head", "role", "text")]):
            if head:
                conv, audit, at, state, place = c, text, 0, START, 0
                lines.append((conv, -1, None, None))
            else:
                if audit[at] == "K":
                    state = NEXT[state][role[:1]]
                    say(role, text)
                elif audit[at] == "R":
                    made(text)
                at += 1
            # Insertions stand before the next row, or at the end.
            while at < len(audit) and audit[at] == "I":
                made("")
                at += 1
        yield lines


def _written(kind: pa.DataType, batches):
    for lines in _lines(batches):
        rows = list(zip(*[x for x in lines if x[1] >= 0])) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, (kind, pa.int64(), pa.string(), pa.string()))], names=["conv_id", "place", "role", "text"])


def _hashed(kind: pa.DataType, batches):
    sha, conv, out = None, None, []

    def batch():
        ids, sums = zip(*out)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(sums, pa.string())], names=["conv_id", "repaired_sha256"])

    for lines in _lines(batches):
        for c, place, role, text in lines:
            if place < 0:
                if sha:
                    out.append((conv, sha.hexdigest()))
                conv, sha = c, hashlib.sha256()
            else:
                sha.update(f"{chr(10) if place else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        if out:
            yield batch()
    if sha:
        out.append((conv, sha.hexdigest()))
        yield batch()


def _with_audits(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Whole rows in order behind the audit of their conversation."""
    turns = rows.select("conv_id", F.lit(False).alias("head"), "turn", "role", _digest().alias("digest"), "text")
    none = lambda c: F.lit(None).cast(turns.schema[c].dataType).alias(c)
    heads = verdicts.select("conv_id", F.lit(True).alias("head"), none("turn"), none("role"), none("digest"), F.col("audit").alias("text"))
    return turns.unionByName(heads).repartition("conv_id").sortWithinPartitions("conv_id", F.desc("head"), "turn", "role", "digest")


def repaired(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The rows after the edits of `judged`: conv_id, place (from 0), role, text."""
    kind = rows.schema["conv_id"].dataType
    return _with_audits(rows, verdicts).mapInArrow(lambda b, f=partial(_written, to_arrow_type(kind)): f(b), f"conv_id {kind.simpleString()}, place long, role string, text string")


def digests(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Per conversation with rows: conv_id and repaired_sha256, of the lines `role:text` of what `repaired` gives."""
    kind = rows.schema["conv_id"].dataType
    return _with_audits(rows, verdicts).mapInArrow(lambda b, f=partial(_hashed, to_arrow_type(kind)): f(b), f"conv_id {kind.simpleString()}, repaired_sha256 string")


def repair_report(conversations: DataFrame, rows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row for every conv_id of `conversations`: what `judged` finds in its `rows`, and the digest of the repaired ones.

    rows has conv_id, turn, role and text without nulls in the last two (`damaged` gives such rows). Rows of one turn, or without one, which
    come first, stand in the order of role and then of the text's SHA-256, so that no order of reading changes a result. Equal rows
    are duplicates of the first. Rows without a conv_id are one conversation. A conversation without rows has zeros,
    an empty audit and the digest of an empty text. Texts may be of any length. An empty table gives no rows. gaps never exceeds the
    largest long. The digest of a conversation is computed by one task, as SHA-256 is a chain, in bounded memory.
    """
    verdicts = freeze(judged(rows), "verdicts")
    ids = conversations.select(F.col(conv_col).alias("id")).distinct()
    hashes = digests(rows, verdicts).select(F.col("conv_id").alias("hash_id"), "repaired_sha256")
    found = ids.join(verdicts, F.col("id").eqNullSafe(F.col("conv_id")), "left").join(hashes, F.col("id").eqNullSafe(F.col("hash_id")), "left")
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return found.select(
        F.col("id").alias("conv_id"), *[number(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
