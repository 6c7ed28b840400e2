"""Whole batches of texts as byte arrays: word borders, 64-bit hashes, word shingles.

Every function takes the UTF-8 bytes of many texts side by side with their offsets, so the work per
word is done by numpy over a slice of a few megabytes at a time. Words are runs of bytes other than
ASCII white space; a multi-byte character holds no ASCII byte, so byte borders are character borders.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20  # bytes of text in work at once; one longer text is a slice of its own
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_STEP = 0x9E3779B97F4A7C15
_STEP_INVERSE = pow(_STEP, -1, 1 << 64)
_CHUNK = 1 << 20
_BYTE = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, offsets from 0, bytes)`` for runs of rows of at most ``limit`` bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    count = len(column)
    if count == 0:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + count + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    first = 0
    while first < count:
        after = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        after = min(max(after, first + 1), count)
        own = offsets[first : after + 1]
        yield first, own - own[0], data[own[0] : own[-1]]
        first = after


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(base: int, size: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < size:
        have = np.full(max(size, _CHUNK + 1), base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * _CHUNK:
            _powers[base] = have
    return have


def prefix(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums; a difference of two, shifted back by ``span_hash``, names the bytes between."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * _power(_STEP, len(data) + 1)[: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; equal bytes give equal hashes wherever they stand."""
    back = _power(_STEP_INVERSE, len(sums))[starts]
    return mix((sums[ends] - sums[starts]) * back + (ends - starts).astype(np.uint64))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``span_hash`` of disjoint rising spans, a megabyte of text at a time."""
    found = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _CHUNK, side="right")))
        base = starts[i]
        sums = prefix(data[base : ends[j - 1]])
        found[i:j] = span_hash(sums, starts[i:j] - base, ends[i:j] - base)
        i = j
    return found


def words(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text number of every word; ``apart`` marks the bytes between words."""
    inside = ~apart[data]
    border = np.zeros(len(data) + 1, dtype=bool)
    border[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | border[1:-1]
    last[:-1] &= ~inside[1:] | border[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, side="right") - 1


def shingles(hashes: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every run of ``size`` words; a shorter text is one run as a whole."""
    factor = [np.uint64((2 * i + 3) * 0xD6E8FEB86659FD93 & (1 << 64) - 1) for i in range(size)]
    if len(hashes) == 0:
        return hashes, text
    full = np.empty(0, dtype=np.uint64), np.empty(0, dtype=text.dtype)
    if len(hashes) >= size:
        n = len(hashes) - size + 1
        total = np.zeros(n, dtype=np.uint64)
        for i in range(size):
            total += hashes[i : n + i] * factor[i]
        whole = text[:n] == text[size - 1 :]
        full = mix(total[whole]), text[:n][whole]
    starts = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    lengths = np.diff(np.r_[starts, len(text)])
    short = lengths < size
    if not short.any():
        return full
    total = lengths[short].astype(np.uint64)
    for i in range(size - 1):
        has = lengths[short] > i
        total[has] += hashes[starts[short][has] + i] * factor[i]
    return np.r_[full[0], mix(total)], np.r_[full[1], text[starts[short]]]


def distinct(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs without repeats, by text and then by hash."""
    order = np.argsort(hashes)
    order = order[np.argsort(text[order], kind="stable")]
    hashes, text = hashes[order], text[order]
    if len(hashes) == 0:
        return hashes, text
    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])]
    return hashes[new], text[new]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, A-Z lower-cased, with their text numbers."""
    data = LOWER[data]
    starts, ends, text = words(data, offsets)
    return distinct(*shingles(hash_spans(data, starts, ends), text, size))


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each list."""
    return pa.ListArray.from_arrays(
        pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32)), pa.array(values).cast(kind)
    )
