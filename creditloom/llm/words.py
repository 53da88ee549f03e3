"""Words and word shingles of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return; A-Z count as a-z. All arithmetic is modulo 2**64.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Texts are read in parts of about this size, so memory does not depend on the batch.
PART_BYTES = 2 << 20
# Odd, so it has an inverse.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
# No hash: what a place holds before it gets one.
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    # The multipliers and shifts of that finaliser.
    x = x + np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def parts(texts: pa.Array, part_bytes: int = PART_BYTES) -> Iterator[tuple[int, int]]:
    """Slices (start, end) of the array with about ``part_bytes`` of text each, one text at least."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = taken = 0
    for at, size in enumerate(sizes.tolist()):
        if taken and taken + size > part_bytes:
            yield start, at
            start, taken = at, 0
        taken += size
    if len(sizes):
        yield start, len(sizes)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For every word its text's place and its hash, in text order. A null text has no words."""
    column = pa.compute.fill_null(texts, "").cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, at, data = column.buffers()
    ends = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    size = int(ends[-1] - ends[0])
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    raw = np.frombuffer(data, np.uint8)[int(ends[0]) : int(ends[-1])]
    ends = ends - ends[0]
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edges = ends[(ends > 0) & (ends < size)]
    before = np.concatenate([[False], inside[:-1]])
    before[edges] = False
    after = np.concatenate([inside[1:], [False]])
    after[edges - 1] = False
    first = np.flatnonzero(inside & ~before)
    last = np.flatnonzero(inside & ~after) + 1
    lower = raw + 32 * ((raw >= 65) & (raw <= 90)).astype(np.uint8)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * powers(BASE, size), out=sums[1:])
    hashes = (sums[last] - sums[first]) * powers(INVERSE, size)[first]
    text_of = np.searchsorted(ends, first, side="right") - 1
    return text_of, mix(hashes + (last - first).astype(np.uint64))


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For every distinct shingle of ``k`` words its text's place and its hash, ordered by both.

    A text with fewer words, but at least one, has its whole sequence as its only shingle.
    """
    text_of, words = word_hashes(texts)
    n = len(words)
    counts = np.bincount(text_of, minlength=len(texts)) if n else np.zeros(len(texts), np.int64)
    found_text, found = [], []
    for length in range(1, k + 1):
        # Sequences shorter than k only where the text has no more words.
        some = max(n - length + 1, 0)
        start = np.arange(some)
        fits = text_of[start] == text_of[start + length - 1]
        if length < k:
            fits &= counts[text_of[start]] == length
        start = start[fits]
        if not len(start):
            continue
        value = mix(words[start], length)
        for j in range(1, length):
            value = mix(value * np.uint64(BASE) + words[start + j], length)
        found_text.append(text_of[start])
        found.append(value)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place, value = np.concatenate(found_text), np.concatenate(found)
    order = np.lexsort((value, place))
    place, value = place[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (place[1:] != place[:-1])
    return place[new], value[new]
