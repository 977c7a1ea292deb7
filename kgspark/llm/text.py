"""Vectorised words and shingles over Arrow text columns.

Everything here works on the UTF-8 bytes of a whole Arrow batch at once, so a
Python worker spends nanoseconds, not microseconds, on each word.  A word is a
maximal run of bytes other than space and 0x09-0x0D (none of which occurs
inside a multi-byte character); A-Z are lower-cased for hashing.

Hashes are 64-bit: a polynomial over the word's bytes, finished with the
splitmix64 mixer.  Two different words (or shingles) of a pair of texts share a
hash with probability of about 2**-64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = U64(0xD1342543DE82EF95)
#: bytes that end a word
_SEP = np.zeros(256, dtype=bool)
_SEP[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: bytes hashed at a time: small enough for the CPU cache
_SPAN = 1 << 17
#: bytes of text tokenised at a time (a longer text is a chunk of its own)
CHUNK = 1 << 20

_pow = _inv = np.ones(1, dtype=U64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse modulo 2**64."""
    global _pow, _inv
    if len(_pow) <= n:
        size = max(n + 1, _SPAN + 1)
        _pow, _inv = np.full(size, _BASE, dtype=U64), np.full(size, pow(_BASE, -1, 1 << 64), dtype=U64)
        _pow[0] = _inv[0] = 1
        np.cumprod(_pow, out=_pow)
        np.cumprod(_inv, out=_inv)
    return _pow, _inv


def trim() -> None:
    """Give freed memory back: a worker that waits for its next task holds none of the last one's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit numbers."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@dataclass
class Words:
    """Words of some texts: byte ranges, hashes, and ptr[i]:ptr[i+1] for text i."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    ptr: np.ndarray


def bounds(buf: np.ndarray, off: np.ndarray, sep: np.ndarray = _SEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, ptr) of the words of the texts buf[off[i]:off[i+1]]; sep: which of the 256 bytes end a word."""
    word = ~sep[buf]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    inner = off[:-1][off[:-1] < off[1:]]
    first[inner] = word[inner]
    last[inner[inner > 0] - 1] = word[inner[inner > 0] - 1]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, off)


def hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), dtype=U64)
    i, n = 0, len(start)
    while i < n:
        base = start[i]
        j = max(i + 1, int(np.searchsorted(end, base + _SPAN, "right")))
        part = _LOWER[buf[base : end[j - 1]]].astype(U64)
        powers, inverse = _powers(len(part))
        part += U64(1)
        part *= powers[: len(part)]
        total = np.empty(len(part) + 1, dtype=U64)
        total[0] = 0
        np.cumsum(part, out=total[1:])
        s, e = start[i:j] - base, end[i:j] - base
        out[i:j] = (total[e] - total[s]) * inverse[s]
        i = j
    return mix(out)


def words(buf: np.ndarray, off: np.ndarray, sep: np.ndarray = _SEP) -> Words:
    start, end, ptr = bounds(buf, off, sep)
    return Words(start, end, hashes(buf, start, end), ptr)


def strings(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte ranges of buf as strings, A-Z lower-cased."""
    off = np.concatenate(([0], np.cumsum(end - start)))
    at = np.repeat(start - off[:-1], end - start) + np.arange(off[-1])
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(off.astype(np.int64)), pa.py_buffer(_LOWER[buf[at]]))


def ngrams(w: Words, k: int) -> np.ndarray:
    """Hash of the k words from each position on (meaningless for the last k - 1 of a text)."""
    h = w.hash
    out = h.copy()
    for j in range(1, min(k, len(h))):
        out *= _STEP
        out[: len(h) - j] += h[j:]
    return mix(out + U64(k))


def sequences(w: Words) -> np.ndarray:
    """A hash of each text's whole word sequence (0 without words)."""
    count = np.diff(w.ptr)
    position = np.arange(len(w.hash)) - np.repeat(w.ptr[:-1], count)
    out = np.zeros(len(count), dtype=U64)
    some = count > 0
    if some.any():
        out[some] = mix(np.add.reduceat(mix(w.hash + position.astype(U64) * _STEP), w.ptr[:-1][some]) + count[some].astype(U64))
    return out


def shingle_sets(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, ptr): each text's sorted distinct k-word shingles; a text of fewer
    than k words but at least one has its whole sequence as its one shingle."""
    count = np.diff(w.ptr)
    short = (count > 0) & (count < k)
    size = np.where(short, 1, np.maximum(count - k + 1, 0))
    ptr = np.concatenate(([0], np.cumsum(size)))
    tokens = np.empty(ptr[-1], dtype=U64)
    grams = ngrams(w, k)
    position = np.arange(len(w.hash)) - np.repeat(w.ptr[:-1], count)
    keep = position <= np.repeat(count, count) - k
    full = np.repeat(~short, size)
    tokens[full] = grams[keep]
    tokens[ptr[:-1][short]] = sequences(w)[short]
    for a, b in zip(ptr[:-1][size > 1].tolist(), ptr[1:][size > 1].tolist()):
        tokens[a:b].sort()
    fresh = np.ones(len(tokens), dtype=bool)
    fresh[1:] = tokens[1:] != tokens[:-1]
    fresh[ptr[:-1][size > 0]] = True
    kept = np.concatenate(([0], np.cumsum(fresh)))
    return tokens[fresh], kept[ptr]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def chunks(buf: np.ndarray, off: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets) of runs of whole texts of at most `most` bytes; a longer text comes alone."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield i, j, buf[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j
