"""Words and word n-grams of Arrow text batches as 64-bit hashes, computed with numpy.

A word is a run of anything but the six ASCII white space characters. Its hash is the mixed
sum of its bytes' random values, each times a random odd number of its own place; an n-gram's hash
sums its words' hashes the same way. No two places share a multiplier, so words
built of repeating patterns do not collide as they do under powers of one number. Hashes depend
on the bytes alone, so they agree between executors and runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Texts are taken in slices of about this many bytes, as numpy needs some 30 bytes a byte.
SLICE_BYTES = 1 << 20

_SPACES = np.frombuffer(b" \t\n\x0b\x0c\r", dtype=np.uint8)
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[_SPACES] = False
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix64 finaliser)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_EXACT = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_EXACT[_SPACES] = 0
_LOWER = _EXACT.copy()
_LOWER[ord("A") : ord("Z") + 1] = _EXACT[ord("a") : ord("z") + 1]

_scales = np.ones(0, dtype=np.uint64)


def scales(count: int) -> np.ndarray:
    """At least ``count`` odd multipliers, a fixed sequence without a pattern."""
    global _scales
    if len(_scales) < count:
        places = np.arange(1, max(count, 2 * len(_scales)) + 1, dtype=np.uint64)
        _scales = mix(mix(places) + _BASE) | np.uint64(1)
    return _scales


def slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, bytes and text offsets of slices of a string array; null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer else np.empty(0, dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a slice, and where each text's words begin and the last end."""
    is_word = _IS_WORD[data]
    starts = is_word.copy()
    starts[1:] &= ~is_word[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    starts[heads] = is_word[heads]
    first = np.flatnonzero(starts)
    if not len(first):
        return np.empty(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    place = np.arange(len(data))
    within = place - np.maximum.accumulate(np.where(starts, place, 0))
    terms = (_LOWER if lower else _EXACT)[data]
    terms *= scales(int(within.max()) + 1)[within]
    return mix(np.add.reduceat(terms, first)), np.searchsorted(first, offsets)


def ngrams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the n-grams that start at each word; the last size - 1 words start none."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    scale = scales(size + 1)
    total = np.zeros(count, dtype=np.uint64)
    for i in range(size):
        total += hashes[i : i + count] * scale[i + 1]
    return mix(total + np.uint64(size))


def text_ngrams(texts: pa.Array, size: int, lower: bool) -> Iterator[tuple[int, int, np.ndarray]]:
    """Row, number of words and n-gram hashes, in order, of every text.

    n-grams are computed for a whole slice at once; those that cross texts are left out.
    """
    for first, last, data, offsets in slices(texts):
        hashes, bounds = word_hashes(data, offsets, lower)
        grams = ngrams(hashes, size)
        for row in range(first, last):
            begin, end = bounds[row - first], bounds[row - first + 1]
            yield row, int(end - begin), grams[begin : max(begin, end - size + 1)]


def shingle_sets(texts: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingles of every text, A-Z taken as a-z.

    A text of fewer words than ``size`` has one shingle, its whole sequence; one
    without words has none.
    """
    for first, last, data, offsets in slices(texts):
        hashes, bounds = word_hashes(data, offsets, lower=True)
        grams = ngrams(hashes, size)
        for row in range(first, last):
            begin, end = bounds[row - first], bounds[row - first + 1]
            if end - begin >= size:
                yield row, np.unique(grams[begin : end - size + 1])
            else:
                yield row, ngrams(hashes[begin:end], int(end - begin)) if end > begin else grams[:0]


def digest(text: str | None) -> tuple[int, int]:
    """Two signed 64-bit numbers of a text's words, A-Z taken as a-z."""
    found = hashlib.blake2b(b" ".join((text or "").encode().lower().split()), digest_size=16).digest()
    return int.from_bytes(found[:8], "little", signed=True), int.from_bytes(found[8:], "little", signed=True)
