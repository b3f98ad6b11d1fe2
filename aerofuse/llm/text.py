"""Columnar text helpers used inside Arrow tasks: buffers, words and hashes as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A word, once A-Z is lower-cased, is a run of 0-9, a-z and non-ASCII. Every byte of a non-ASCII code
# point is 0x80 or more, so the rule can be applied to UTF-8 bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True

BLOCK_BYTES = 1 << 20  # texts are handled in blocks of about this size, so that temporaries stay in cache
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * _STEP + np.uint64(seed))


_BYTE_VALUES = numbers(256, 11)
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """At least ``n`` powers of one odd multiplier, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        base = np.full(max(n, 2 * len(_powers)), np.uint64(0xD6E8FEB86659FD93))
        base[0] = 1
        _powers = np.cumprod(base)
    return _powers


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, end to end, and the offset at which each begins (one more for the end). Null is empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, width, len(texts) + 1, texts.offset * np.dtype(width).itemsize).astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8, at[-1] - at[0], at[0]), at - at[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``limit`` bytes; a longer text is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words of the texts: a 64-bit hash each, where each begins and ends, and the first word of each text.

    The last array has one entry more than there are texts: text i has the words ``first[i]`` to ``first[i + 1]``.
    """
    low = LOWER[data]
    inside = WORD[low]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(inside):
        before[0] = after[-1] = False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edge = offsets[(offsets > 0) & (offsets < len(data))]
        before[edge] = False
        after[edge - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends, first
    lengths = ends - starts
    at = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1], out=at[1:])
    letters = low[inside]
    place = np.arange(len(letters)) - np.repeat(at, lengths)
    hashes = np.add.reduceat(_BYTE_VALUES[letters] * powers(int(lengths.max()))[place], at)
    return mix(hashes), starts, ends, first


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, by its first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j, factor in enumerate(numbers(size, 29) | np.uint64(1)):
        total += hashes[j : n + j] * factor
    return mix(total)
