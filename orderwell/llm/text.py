"""Words, word hashes and shingles of many texts at once, as numpy arrays.

A block is a run of texts held as one byte array with offsets, the layout Arrow
hands over.  Words are maximal runs of anything but space and ``\\t\\n\\v\\f\\r``;
only A-Z are lower-cased.  Both rules look at single bytes of UTF-8 below 0x80, so
working on bytes gives what working on code points would.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
SHINGLE_WORDS = 5

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_VALUES = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64)[_LOWER]
_EXACT_VALUES = np.random.default_rng(31).integers(1, 2**63, (2, 256), dtype=np.uint64)
_MULTIPLIER = 0x9E3779B97F4A7C15
_SHINGLE_FACTORS = np.random.default_rng(7).integers(1, 2**63, SHINGLE_WORDS + 1, dtype=np.uint64) | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values so that every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def as_arrays(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than texts) of a string column; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text, one row at least."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(first, last - first)
            first = last


_powers = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, ``n`` at least."""
    global _powers
    if len(_powers[0]) < n:
        inverse = pow(_MULTIPLIER, -1, 2**64)
        made = []
        for base in (_MULTIPLIER, inverse):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            made.append(np.multiply.accumulate(steps))
        _powers = made[0], made[1]
    return _powers


def exact_hashes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each whole string, case and all."""
    data, offsets = as_arrays(strings)
    up, down = _powers_to(len(data) + 1)
    found = []
    for values in _EXACT_VALUES:
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(values[data] * up[: len(data)], out=sums[1:])
        found.append(mix((sums[offsets[1:]] - sums[offsets[:-1]]) * down[offsets[:-1]]))
    return found[0], found[1]


def _hash_piece(data: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of ``data``; no word crosses ``doc_starts``."""
    inside = ~_SPACE[data]
    if not inside.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    fresh = np.zeros(len(data) + 1, dtype=bool)
    fresh[doc_starts] = True
    fresh[0] = fresh[-1] = True
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | fresh[1:-1]
    closes[:-1] &= ~inside[1:] | fresh[1:-1]
    first, last = np.flatnonzero(begins), np.flatnonzero(closes)
    up, down = _powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
    return mix((sums[last + 1] - sums[first]) * down[first]), first


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash per word of every text in order, and the word count per text.

    Works through pieces of about a MB cut at white space, so a huge text costs eight
    bytes a word and not eight bytes a byte.
    """
    hashes, firsts, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + BLOCK_BYTES)
        step = 4096
        while end < len(data):  # back to white space, or on to the next
            low = max(at, end - step)
            gaps = np.flatnonzero(_SPACE[data[low:end]])
            if len(gaps):
                end = low + int(gaps[-1]) + 1
                break
            if low == at:
                end, step = min(len(data), end + BLOCK_BYTES), 4096
            else:
                step *= 16
        starts = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, end)] - at
        h, first = _hash_piece(data[at:end], starts)
        hashes.append(h)
        firsts.append(first + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    first = np.concatenate(firsts)
    counts = np.diff(np.searchsorted(first, offsets))
    return np.concatenate(hashes), counts


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Per text, the sorted distinct hashes of its runs of five words; a text with
    fewer words has one shingle of all of them, a text without words has none."""
    words, counts = word_hashes(data, offsets)
    factors, k = _SHINGLE_FACTORS, SHINGLE_WORDS
    if len(words) >= k:
        runs = words[: len(words) - k + 1] * factors[0]
        for j in range(1, k):
            runs += words[j : len(words) - k + 1 + j] * factors[j]
        runs = mix(runs)
    sets, at = [], 0
    for n in counts.tolist():
        if n >= k:
            sets.append(np.unique(runs[at : at + n - k + 1]))
        elif n:
            short = words[at : at + n] * factors[:n]
            sets.append(mix(short.sum(dtype=np.uint64, keepdims=True) + factors[k:] * np.uint64(n)))
        else:
            sets.append(np.zeros(0, np.uint64))
        at += n
    return sets
