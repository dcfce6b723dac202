"""Words and word sequences of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a run of bytes outside space and 0x09-0x0D. Every word gets a 64-bit hash, every sequence of
n words of one text another one; nothing loops over words in Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# A slice of texts is cut at about this many bytes; a longer text is a slice of its own. A worker holds some 50 bytes for
# each byte of a slice at its peak, and keeps much of that between tasks.
SLICE_BYTES = 1 << 19

_BASE = np.uint64(0x9E6C63D0676A9A99)
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(
    0, 1 << 64, 256, dtype=np.uint64
)
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base = base
        self.inverse = np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(self.base, n), _powers(self.inverse, n)
        return self.up, self.down


_BYTE_POWERS = _Powers(_BASE)
_WORD_POWERS = (
    _Powers(np.uint64(0xD1342543DE82EF95)),
    _Powers(np.uint64(0xAF251AF3B0F025B5)),
)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of a slice of texts: byte ranges into ``data``, hash, and the first word of each text."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # one more entry than texts
    text: np.ndarray  # of each word

    def sequences(self, n: int, which: int = 0) -> np.ndarray:
        """A hash of the n words from each word on; meaningless where ``fits`` is false."""
        size = len(self.hash)
        if size < n:
            return np.zeros(size, dtype=np.uint64)
        up, down = _WORD_POWERS[which].upto(size + 1)
        total = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(self.hash * up[:size], out=total[1:])
        out = np.zeros(size, dtype=np.uint64)
        out[: size - n + 1] = mix((total[n:] - total[:-n]) * down[: size - n + 1])
        return out

    def fits(self, n: int) -> np.ndarray:
        """Whether the n words from each word on lie in one text."""
        return np.arange(len(self.hash)) + n <= self.first[self.text + 1]


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """``data``: the bytes of the texts, one after the other; ``offsets``: where each starts, and the end."""
    if lower:
        data = np.frombuffer(data.tobytes().translate(LOWER), dtype=np.uint8)
    size = len(data)
    texts = len(offsets) - 1
    if not size:
        none = np.zeros(0, dtype=np.int64)
        return Words(data, none, none, none.astype(np.uint64), np.zeros(texts + 1, np.int64), none)
    inside = ~_SEPARATOR[data]
    border = np.zeros(size + 1, dtype=bool)
    border[offsets] = True
    before = np.empty(size, dtype=bool)
    before[0] = True
    before[1:] = ~inside[:-1]
    start = np.flatnonzero(inside & (before | border[:-1]))
    after = np.empty(size, dtype=bool)
    after[-1] = True
    after[:-1] = ~inside[1:]
    end = np.flatnonzero(inside & (after | border[1:])) + 1
    up, down = _BYTE_POWERS.upto(size + 1)
    total = np.zeros(size + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[:size], out=total[1:])
    value = (total[end] - total[start]) * down[start]
    hashes = mix(value + (end - start).astype(np.uint64))
    first = np.searchsorted(start, offsets)
    text = np.repeat(np.arange(texts), np.diff(first))
    return Words(data, start, end, hashes, first, text)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive texts of about ``size`` bytes: (from row, to row, bytes, offsets)."""
    data, offsets = buffers(column)
    row, rows = 0, len(column)
    while row < rows:
        upto = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        upto = min(max(upto, row + 1), rows)
        yield row, upto, data[offsets[row] : offsets[upto]], offsets[row : upto + 1] - offsets[row]
        row = upto
