"""Words of whole texts as Arrow and numpy arrays, and rolling hashes over them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def _table(separators: list[int], fold: bool) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[separators] = 0x20
    if fold:
        table[0x41:0x5B] += 0x20
    return table


# Bytes that part words, replaced by a space; with A-Z made small or left as they are.
PLAIN_WORDS = _table(list(_SPACE), fold=False)
FOLDED_WORDS = _table(list(_SPACE), fold=True)
# Words of ASCII letters, digits and anything beyond ASCII.
ALPHANUMERIC_WORDS = _table(
    [b for b in range(128) if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)], fold=True)


def buffers(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts through ``table``, offsets of the texts in them); null texts are empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(offsets) or offsets[0] == offsets[-1]:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return table[data], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of every word in ``data`` and the number of words of each text."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = data != 0x20
    begin = inside[1:-1] & ~inside[:-2]
    end = inside[1:-1] & ~inside[2:]
    # A text's first and last byte bound a word even where the next text goes on without a space.
    filled = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    begin[first] |= inside[1:-1][first]
    end[last] |= inside[1:-1][last]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


def word_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words as an Arrow string array."""
    if not len(starts):
        return pa.array([], pa.string())
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    packed = data[data != 0x20]
    return pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all others."""
    z = values ^ (values >> np.uint64(30))
    z = z * np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


HASH_BYTES = 1 << 20


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of every word, from running sums over stretches of the data."""
    out = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        base = int(starts[low])
        high = max(low + 1, int(np.searchsorted(ends, base + HASH_BYTES, side="right")))
        stop = int(ends[high - 1])
        up, down = _powers_to(stop - base + 1)
        sums = np.zeros(stop - base + 1, np.uint64)
        np.cumsum((data[base:stop].astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        a, b = starts[low:high] - base, ends[low:high] - base
        out[low:high] = (sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)
        low = high
    return mixed(out)


def window_hashes(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hashes of all windows of ``width`` words inside one text, with the place of each window's first word.

    ``counts`` are the words per text. The hash of a window is a polynomial of its word hashes.
    """
    n = len(hashes)
    if n < width:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    rolled = hashes[:n - width + 1].copy()
    for k in range(1, width):
        rolled *= _STEP
        rolled += hashes[k:n - width + 1 + k]
    ends = np.repeat(np.cumsum(counts), counts)[:n - width + 1]
    places = np.flatnonzero(np.arange(n - width + 1) + width <= ends)
    return mixed(rolled[places]), places
