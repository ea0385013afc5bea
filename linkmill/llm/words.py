"""Words and word shingles of whole Arrow text columns, vectorised.

A word is a maximal run of ASCII digits, ASCII letters (lower-cased) and bytes of
non-ASCII characters.  Every word gets a 64-bit hash: a polynomial over its bytes,
taken from prefix sums, then mixed.  Nothing here loops over words in Python.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BLOCK_BYTES = 500_000
BASE = U64(0x9E3779B97F4A7C15 | 1)


def thrifty(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` of a task whose worker gives freed memory back at its end: workers live on through stages that don't use them, and count with their executor."""

    def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return trimmed


def give_back() -> None:
    """Free memory of Arrow and of the C library to the system, as far as they can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def _lut() -> np.ndarray:
    t = np.zeros(256, np.uint8)
    for b in range(256):
        if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128:
            t[b] = b
        elif 65 <= b <= 90:
            t[b] = b + 32
    return t


LOWER = _lut()
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n; kept between calls."""
    have = _POWERS.get("p")
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1)
        inv = U64(pow(int(BASE), -1, 1 << 64))
        for key, base in (("p", BASE), ("i", inv)):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _POWERS[key] = np.cumprod(a, dtype=np.uint64)
    return _POWERS["p"], _POWERS["i"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads all bits (splitmix finaliser)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@dataclass
class Block:
    """Some rows of a batch: word hashes of all of them, and where each row's words begin."""

    first: int
    rows: int
    words: np.ndarray  # uint64 hashes, row after row
    at: np.ndarray  # rows + 1 offsets into words


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    col = col.cast(pa.large_string())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if len(col) and col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def row_blocks(offsets: np.ndarray, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``max_bytes``; a longer row stands alone."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and the words' begins and ends; a word never crosses rows."""
    low = LOWER[data]
    word = low != 0
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    starts[inner] = word[inner]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    ends[inner - 1] = word[inner - 1]
    return low, np.flatnonzero(starts), np.flatnonzero(ends) + 1


def hash_words(low: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs [s, e), piece by piece so that memory stays bounded."""
    out = np.empty(len(s), np.uint64)
    i = 0
    while i < len(s):
        j = max(i + 1, int(np.searchsorted(e, s[i] + BLOCK_BYTES, "right")))
        lo, hi = int(s[i]), int(e[j - 1])
        p, inv = _powers(hi - lo + 1)
        c = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(low[lo:hi].astype(np.uint64) * p[: hi - lo], out=c[1:])
        a, b = s[i:j] - lo, e[i:j] - lo
        out[i:j] = mix((c[b] - c[a]) * inv[a] + (b - a).astype(np.uint64))
        i = j
    return out


def blocks(col: pa.Array) -> Iterator[Block]:
    data, offsets = text_buffers(col)
    for lo, hi in row_blocks(offsets):
        off = offsets[lo : hi + 1] - offsets[lo]
        low, s, e = word_bounds(data[offsets[lo] : offsets[hi]], off)
        yield Block(lo, hi - lo, hash_words(low, s, e), np.searchsorted(s, off))


def shingles(words: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words of each row, and the rows' offsets.

    A row of 1 to ``width - 1`` words has one shingle, of all its words; a row
    without words has none.
    """
    n = np.diff(at)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    sat = np.concatenate(([0], np.cumsum(count)))
    total = int(sat[-1])
    if not total:
        return np.zeros(0, np.uint64), sat
    first = np.arange(total) - np.repeat(sat[:-1] - at[:-1], count)
    last = np.repeat(at[1:], count)
    h = np.zeros(total, np.uint64)
    k = U64(0xD6E8FEB86659FD93)
    long_rows = bool((n >= width).all())
    for j in range(width):
        w = first + j
        if long_rows:
            h = mix((h + words[w]) * k + U64(j + 1)) if j == 0 else (h * k + words[w])
        else:
            inside = w < last
            x = words[np.minimum(w, len(words) - 1)]
            nxt = mix((h + x) * k + U64(1)) if j == 0 else (h * k + x)
            h = np.where(inside, nxt, h)
    return mix(h), sat


def sequence_keys(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each row's word sequence (0, 0 for none)."""
    out = []
    n = np.diff(at)
    pos = (np.arange(len(words)) - np.repeat(at[:-1], n)).astype(np.uint64)
    for seed in (U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB)):
        c = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(mix(words + mix(pos * seed + seed)), out=c[1:])
        out.append(np.where(n > 0, mix(c[at[1:]] - c[at[:-1]] + n.astype(np.uint64)), U64(0)))
    return out[0], out[1]
