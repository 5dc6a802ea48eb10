"""Words and n-gram hashes of whole Arrow batches, computed with numpy on the UTF-8 bytes.

Words are hashed by a random number for each byte and place. Windows of words are polynomials of those hashes modulo 2**64 taken
from prefix sums (the Rabin-Karp way): the hash of any window is a difference of two sums times an inverse power of the
base. Bases are odd, so the inverse exists.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
PIECE = 1 << 18  # bytes whose prefix sums are held at once

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

PLACES = 256  # of a span's bytes that have a table
_TABLES: dict[int, np.ndarray] = {}
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n at least."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = _POWERS[base] = np.cumprod(up), np.cumprod(down)
    return have


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and len + 1 offsets into them; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], pa.large_binary())
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset: array.offset + len(array) + 1]
    raw = array.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]: offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """ASCII capitals in lower case."""
    return np.where((data >= 65) & (data <= 90), data | 32, data)


def spans(breaks: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document number of every run of bytes that are no breaks."""
    if len(breaks) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~breaks
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    edges = offsets[1:-1]
    before[edges[edges < len(breaks)]] = False
    after[edges[edges > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return spans(SPACE[data], offsets)


def _tables(base: int) -> np.ndarray:
    """A random number for each byte value at each of the first PLACES places of a span."""
    if base not in _TABLES:
        _TABLES[base] = mixed(np.arange(PLACES * 256, dtype=np.uint64) * np.uint64(base) + np.uint64(base >> 7))
    return _TABLES[base]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASES[0]) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans ascend and do not overlap.

    The sum of a random number for each byte and its place: no texts collide by their form, as they do under polynomials modulo a power of two.
    """
    out, i, n, table = np.empty(len(starts), np.uint64), 0, len(starts), _tables(base)
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, "right")))
        s, e = starts[i:j] - starts[i], ends[i:j] - starts[i]
        piece = data[starts[i]: ends[j - 1]].astype(np.int64)
        place = np.arange(len(piece)) - np.repeat(s, np.diff(np.append(s, len(piece))))
        values = table[np.minimum(place, PLACES - 1) << 8 | piece]
        far = np.flatnonzero(place >= PLACES)
        if len(far):
            values[far] = mixed(mixed(place[far].astype(np.uint64) * np.uint64(base)) + piece[far].astype(np.uint64))
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(values, out=sums[1:])
        out[i:j] = mixed((sums[e] - sums[s]) ^ ((e - s).astype(np.uint64) << np.uint64(40)))
        i = j
    return out


def gram_hashes(hashes: np.ndarray, doc: np.ndarray, width: int, base: int = BASES[1]) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every window of `width` words inside one document."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = powers(base, len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    at = np.flatnonzero(doc[:count] == doc[width - 1:])
    return at, mixed((sums[at + width] - sums[at]) * down[at])


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Arrow texts from UTF-8 bytes and offsets."""
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))).cast(pa.string())


def binaries(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Arrow binaries of the items of `data` between the bounds."""
    offsets = np.ascontiguousarray(bounds * data.itemsize, np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def numbered(frame):
    """The frame with its columns named c0, c1, ...: neither a clash nor a dot in a name matters then."""
    return frame.toDF(*[f"c{i}" for i in range(len(frame.columns))])
