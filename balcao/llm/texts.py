"""Words and rolling hashes over whole Arrow batches of texts.

Words are runs of bytes of one class. In UTF-8 every byte of a character beyond
ASCII is 128 or more, so classes that only cut at ASCII characters can be told
byte by byte.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes that are hashed at once; the arrays of one piece take about 40 times as much.
PIECE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _inverse(a: int) -> int:
    return pow(a, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit values spread over the whole value; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordClass:
    """Which bytes make a word, and what they are compared as (0 between words)."""

    def __init__(self, inside, fold_case: bool = True):
        table = np.zeros(256, np.uint8)
        for b in range(256):
            c = b + 32 if fold_case and 65 <= b <= 90 else b
            table[b] = c if inside(c) else 0
        self.table = table


#: Words between ASCII white space, A-Z as a-z. A NUL byte is folded to 255, which UTF-8 never holds.
SPACED = WordClass(lambda c: c != 32 and not 9 <= c <= 13)
SPACED.table[0] = 255
#: Words of digits, a-z and everything beyond ASCII.
ALNUM = WordClass(lambda c: 48 <= c <= 57 or 97 <= c <= 122 or c >= 128)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each followed by a line feed, and where each begins; null as empty."""
    column = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    column = column.cast(pa.large_binary())
    column = pc.fill_null(column, b"")
    joined = pc.binary_join_element_wise(column, pa.scalar(b"", pa.large_binary()), pa.scalar(b"\n", pa.large_binary()))
    joined = joined.combine_chunks() if isinstance(joined, pa.ChunkedArray) else joined
    _, offsets, data = joined.buffers()
    at = np.frombuffer(offsets, np.int64, len(joined) + 1, joined.offset * 8) if len(joined) else np.zeros(1, np.int64)
    if data is None:
        return np.zeros(0, np.uint8), at
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def groups(texts: pa.Array, limit: int = 4 * PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes; a longer text makes a range of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    first, held = 0, 0
    for i, n in enumerate(sizes):
        if i > first and held + n > limit:
            yield first, i
            first, held = i, 0
        held += n
    if first < len(sizes):
        yield first, len(sizes)


@lru_cache(maxsize=1)
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # another C library
        return lambda _: 0


def give_back() -> None:
    """Return memory that is free in this worker to the system; large arrays of one batch else stay with it for good."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


class Words:
    """The words of consecutive texts: bounds in ``data``, hash, and the first word of each text."""

    def __init__(self, texts: pa.Array, kind: WordClass):
        self.data, at = utf8(texts)
        starts, ends, hashes = [], [], []
        pos = 0
        while pos < len(self.data):
            end = self._cut(pos, kind)
            s, e, h = _hashed(self.data[pos:end], kind)
            starts.append(s + pos)
            ends.append(e + pos)
            hashes.append(h)
            pos = end
        none = np.zeros(0, np.int64)
        self.starts = np.concatenate(starts) if starts else none
        self.ends = np.concatenate(ends) if ends else none
        self.hashes = np.concatenate(hashes) if hashes else none.astype(np.uint64)
        self.first = np.searchsorted(self.starts, at)  # one more than texts

    def _cut(self, pos: int, kind: WordClass) -> int:
        """A place after ``pos`` where no word is cut, about one piece on."""
        end = pos + PIECE
        while end < len(self.data):
            gaps = np.flatnonzero(kind.table[self.data[end : end + PIECE]] == 0)
            if len(gaps):
                return end + int(gaps[0])
            end += PIECE
        return len(self.data)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all ``k`` consecutive words, and which of them lie in one text."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        inside = np.ones(n, bool)
        for end in self.first[1:-1]:
            inside[max(0, end - k + 1) : end] = False
        return rolled(self.hashes, k), inside


def rolled(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` values; depends on their order and on ``k``."""
    n = len(hashes) - k + 1
    out = hashes[:n].copy()
    for i in range(1, k):
        out *= _STEP
        out += hashes[i : n + i]
    return mixed(out + np.uint64(k))


def _hashed(data: np.ndarray, kind: WordClass) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    folded = kind.table[data]
    edge = np.flatnonzero(np.diff((folded != 0).view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    starts, ends = edge[::2], edge[1::2]
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(folded * _tables(len(data))[0], out=total[1:])
    hashes = (total[ends] - total[starts]) * _tables(len(data))[1][starts]
    return starts, ends, mixed(hashes + (ends - starts).astype(np.uint64))


_POWERS: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, grown as needed."""
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS[:] = [powers(int(_BASE), max(n, 2 * PIECE)), powers(_inverse(int(_BASE)), max(n, 2 * PIECE))]
    return _POWERS[0][:n], _POWERS[1][:n]
