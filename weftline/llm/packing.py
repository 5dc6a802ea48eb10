"""Best-fit packing by sums of squares: documents become tokens, and tokens full sequences.

Each piece goes to the open sequence where the squared counts of open sequences per residual
gap become smallest; a new one is opened only where none has room. Pieces are placed by falling
length, which leaves almost no gap (about four sequences over the lower bound in a group).
Pieces are dealt into groups of about GROUP_PIECES by a hash, and each group is packed
by itself: the state of the rule is one count per gap, so a group needs little memory
and waste stays a fixed share at every size.

Tokens: a byte-level BPE splits a text into pre-tokens and merges within each. Pre-tokens seen
before are looked up; new ones are merged by the tokenizer's model. What a worker remembers is bounded
by bytes: words in use move from an old generation to a young one, the rest of the old one goes, and long words are not kept.
Texts with letters beyond FAST_BYTES or a special token in them go through the tokenizer whole, and so does every text where the file
describes anything but a byte-level BPE without a normalizer.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import zlib
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftline.llm import text as T
from weftline.session import freeze

GROUP_PIECES = 32_768
CACHE_BYTES = 64 << 20  # of one generation of pre-tokens that a worker remembers; there are two
ENTRY_BYTES = 220  # of a pre-token and its ids beside their bytes: two objects and a place in a table
LONG_WORD = 24  # characters from which on a pre-token is not remembered
FAST_BYTES = 0xCD  # texts whose UTF-8 bytes are below hold code points below U+0340 only

_LOADED: dict[str, tuple] = {}
# The public byte-level alphabet: printable bytes are themselves, the others the letters from U+0100 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


def _char_class(prefix: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(0x340) if unicodedata.category(chr(c)).startswith(prefix))


class _Words:
    """Pre-token -> ids. `young` holds all words of the batch at work."""

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def missing(self, words: set[str]) -> list[str]:
        """Words that no generation knows; known ones become young."""
        if self.size > CACHE_BYTES:
            self.old, self.young, self.size = self.young, {}, 0
        new = []
        for word in words.difference(self.young):
            ids = self.old.pop(word, None)
            if ids is None:
                new.append(word)
            else:
                self.put(word, ids)
        return new

    def put(self, word: str, ids: bytes) -> None:
        self.young[word] = ids
        self.size += ENTRY_BYTES + len(word) + len(ids)

    def forget(self, words: list[str]) -> None:
        for word in words:
            if len(word) > LONG_WORD:
                self.size -= ENTRY_BYTES + len(word) + len(self.young.pop(word))


def _plain_bpe(path: str) -> bool:
    """Whether the file describes a byte-level BPE that splits by the public pattern and changes nothing before it."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    before = made.get("pre_tokenizer") or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    return bool(plain and made.get("normalizer") is None and made.get("model", {}).get("type") == "BPE" and not made["model"].get("dropout") and not made["model"].get("ignore_merges"))


def _load(path: str):
    if path not in _LOADED:
        from tokenizers import Tokenizer

        letters, digits, space = _char_class("L"), _char_class("N"), "\t-\r \x85\xa0"
        # The byte-level pre-tokenizer's public pattern with its classes spelled out.
        # Letters come first, as most pre-tokens are such; no other alternative but that for digits could match there.
        split = re.compile(
            rf" [{letters}]+|[{letters}]+| ?[{digits}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{space}{letters}{digits}]+|[{space}]+(?![^{space}])|[{space}]+")
        tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        _LOADED[path] = tokenizer, split.findall if _plain_bpe(path) else None, special, tokenizer.model, _Words()
    return _LOADED[path]


def _learn(model, known: _Words, new: list[str]) -> None:
    """Merge each pre-token's bytes by the tokenizer's model, as the whole tokenizer does after splitting."""
    for word in new:
        spelled = word.replace(" ", _BYTES[32]) if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(_BYTES)
        ids = [t.id for t in model.tokenize(spelled)]
        known.put(word, struct.pack(f"<{len(ids)}I", *ids))


def encode(path: str, texts: list[str], plain: list[bool]) -> list[bytes]:
    """Little-endian unsigned 32-bit ids of each text; `plain` texts have low code points only."""
    tokenizer, split, special, model, known = _load(path)
    fast = [bool(split) and p and not any(s in x for s in special) for x, p in zip(texts, plain)]
    words = [split(x) if f else () for x, f in zip(texts, fast)]
    distinct = set(chain.from_iterable(words))
    new = known.missing(distinct)
    _learn(model, known, new)
    here = {w: known.young[w] for w in distinct}  # small beside all known words, so that looking up is fast
    out = [b"".join(map(here.__getitem__, w)) for w in words]
    known.forget(new)
    whole = [i for i, f in enumerate(fast) if not f]
    for i, got in zip(whole, tokenizer.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False)):
        out[i] = np.array(got.ids, "<u4").tobytes()
    return out


def _pieces(path: str, size: int, end_id: int, with_ids: bool, batches):
    end = int(end_id).to_bytes(4, "little")
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            data, offsets = T.text_bytes(batch.column(1))
            high = np.r_[0, np.cumsum(data >= FAST_BYTES)]
            plain = (high[offsets[1:]] == high[offsets[:-1]]).tolist()
            texts = [x or "" for x in batch.column(1).to_pylist()]
            rows: list[list] = [[] for _ in range(6)]
            for doc, ids in zip(batch.column(0).to_pylist(), encode(path, texts, plain)):
                ids += end
                n = len(ids) // 4
                start = 0
                length = n % size or size
                piece = 0
                while start < n:
                    raw = ids[4 * start: 4 * (start + length)]
                    for column, value in zip(rows, (doc, piece, start, length, zlib.crc32(raw), raw)):
                        column.append(value)
                    start, length, piece = start + length, size, piece + 1
            out = {"doc_id": pa.array(rows[0], batch.schema.field(0).type), "piece": pa.array(rows[1], pa.int32()), "start": pa.array(rows[2], pa.int64()),
                   "length": pa.array(rows[3], pa.int64()), "ids_crc32": pa.array(rows[4], pa.int64())}
            if with_ids:
                out["ids"] = pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in rows[5]], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)


def place(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length, in the given order."""
    open_at: list[list[int]] = [[] for _ in range(size + 1)]  # sequences by residual gap
    squares = np.zeros(size + 1)
    sequence, offset, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, length in enumerate(lengths.tolist()):
        gap = size
        if length < size:
            # Change of the sum of squares when a sequence of gap g gets the piece: one less at g, one more at g - length.
            change = 2 - 2 * squares[length:size]
            change[1:] += 2 * squares[1: size - length]
            change[0] -= 1  # a full sequence is not open any more
            change[squares[length:size] == 0] = np.inf
            best = int(change.argmin())
            if change[best] < np.inf:
                gap = length + best
        if gap == size:
            at, made = made, made + 1
        else:
            at = open_at[gap].pop()
            squares[gap] -= 1
        sequence[i], offset[i] = at, size - gap
        if gap > length:
            open_at[gap - length].append(at)
            squares[gap - length] += 1
    return sequence, offset


def _pack(size: int, key, table: pa.Table) -> pa.Table:
    table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
    sequence, offset = place(table.column("length").to_numpy(), size)
    table = table.append_column("sequence_id", pa.array(sequence + (key[0].as_py() << 32), pa.int64()))
    return table.append_column("offset", pa.array(offset, pa.int64())).drop_columns(["packed"])


def best_fit_packing(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", size: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A document longer than `size` is cut into pieces of `size`, the first one shorter where it does not divide.
    A null or empty text is its end id alone. Rows of equal id are documents of their own. Other columns are not
    read. An empty table gives no rows. The file at `tokenizer` must be at the same place on every executor.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    cut, fill = partial(_pieces, tokenizer, size, end_id, with_ids), partial(_pack, size)
    pieces = freeze(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(lambda x: cut(x), schema), "pieces")
    groups = max(1, -(-pieces.count() // GROUP_PIECES))
    dealt = pieces.withColumn("packed", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(groups)))
    return dealt.groupBy("packed").applyInArrow(lambda key, table: fill(key, table), f"{schema}, sequence_id long, offset long")
