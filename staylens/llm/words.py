"""Words and word hashes of whole Arrow text columns, computed with numpy.

A word is a run of lower-case letters ``a-z``, digits and non-ASCII bytes after
``A-Z`` are lower-cased: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  Everything works on
the UTF-8 buffer of a batch, so there is no Python object per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
BYTE_VALUE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64)
PIECE = 1 << 20  # bytes hashed at once

_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit hashes (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    if name not in _powers or len(_powers[name]) < n:
        steps = np.full(max(n, PIECE + 1), base, dtype=np.uint64)
        steps[0] = 1
        _powers[name] = np.multiply.accumulate(steps)
    return _powers[name][:n]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a text column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, ends, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1]
    first = int(offsets[0])
    return np.frombuffer(data, np.uint8)[first : offsets[-1]], offsets.astype(np.int64) - first


def _ranges(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray):
    """Cut the buffer into ranges of about ``PIECE`` bytes that split no word."""
    start, end = 0, int(offsets[-1])
    while start < end:
        stop = min(start + PIECE, end)
        if stop < end:
            bound = int(offsets[np.searchsorted(offsets, stop, "right") - 1])
            if bound > start:
                stop = bound
            else:
                gaps = np.flatnonzero(~in_word[LOWER[data[start:stop]]])
                if len(gaps):
                    stop = start + int(gaps[-1]) + 1
                else:  # one word longer than a piece
                    limit = int(offsets[np.searchsorted(offsets, start, "right")])
                    while stop < limit and in_word[LOWER[data[stop]]]:
                        stop += 1
        yield start, stop
        start = stop


def word_hashes(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and where each text's words start in that array.

    ``in_word`` tells of each byte, after lower-casing, whether it belongs to words.
    """
    found, places = [], []
    for start, stop in _ranges(data, offsets, in_word):
        part = LOWER[data[start:stop]]
        inside = in_word[part]
        before = np.empty_like(inside)
        before[0] = False
        before[1:] = inside[:-1]
        cuts = offsets[np.searchsorted(offsets, start) : np.searchsorted(offsets, stop)] - start
        fresh = inside & ~before
        fresh[cuts] = inside[cuts]
        after = np.empty_like(inside)
        after[-1] = False
        after[:-1] = inside[1:] & ~fresh[1:]
        begin, last = np.flatnonzero(fresh), np.flatnonzero(inside & ~after)
        n = len(part)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUE[part] * _power("inverse", BASE_INVERSE, n), out=total[1:])
        value = (total[last + 1] - total[begin]) * _power("base", BASE, n)[begin]
        found.append(mix(value + (last - begin + 1).astype(np.uint64)))
        places.append(begin + start)
    if not found:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(found), np.searchsorted(np.concatenate(places), offsets)


def shingle_hashes(words: np.ndarray, starts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words of a text, and where each text's runs start.

    A text of fewer words, but at least one, has one run: all its words.
    """
    counts = np.diff(starts)
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    ends = np.zeros(len(starts), np.int64)
    np.cumsum(made, out=ends[1:])
    if not ends[-1]:
        return np.zeros(0, np.uint64), ends
    first = np.repeat(starts[:-1] - ends[:-1], made) + np.arange(ends[-1])
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    short = np.repeat(np.where(counts < size, counts, size), made)
    value = np.zeros(ends[-1], np.uint64)
    factor = np.uint64(0xD6E8FEB86659FD93)
    for k in range(size):
        value = value * factor + np.where(short > k, padded[first + k], np.uint64(0))
    return mix(value), ends
