"""Word shingles of whole Arrow text columns as 64-bit hashes, in numpy.

Words are maximal runs of bytes other than space and 0x09-0x0D; A-Z count as a-z. Everything
works on the UTF-8 bytes of a column, so no Python string is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240501))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = _BYTE[_LOWER]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_R = U(0x9E3779B97F4A7C55)
_R_INV = U(pow(int(_R), -1, 2**64))
_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * U(2) + U(1)
_powers: tuple[np.ndarray, np.ndarray] | None = None


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if _powers is None or len(_powers[0]) < n:
        size = max(n, 1 << 20)
        with np.errstate(over="ignore"):
            _powers = tuple(np.cumprod(np.concatenate([[U(1)], np.full(size - 1, r, U)])) for r in (_R, _R_INV))
    return _powers[0][:n], _powers[1][:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is empty."""
    column = pa.compute.fill_null(column.cast(pa.large_string()), "") if column.null_count else column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each; a longer row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = j


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word in order, and where each row's words begin (one more at the end)."""
    n = len(raw)
    if not n:
        return np.zeros(0, U), np.zeros(len(offsets), np.int64)
    space = _IS_SPACE[raw]
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = space[:-1]
    row_start = offsets[:-1][offsets[:-1] < n]
    before[row_start] = True
    starts = np.flatnonzero(before & ~space)
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = space[1:]
    ends_at = offsets[1:][offsets[1:] > 0] - 1
    after[ends_at] = True
    ends = np.flatnonzero(after & ~space) + 1
    up, down = _power(n)
    with np.errstate(over="ignore"):
        total = np.empty(n + 1, U)
        total[0] = 0
        np.cumsum(_VALUE[raw] * up, out=total[1:])
        words = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U))
    return words, np.searchsorted(starts, offsets)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct k-word shingles, sorted, and where each row's begin.

    A row of fewer words has the whole sequence as its one shingle; a row without words has none.
    """
    words, at = word_hashes(raw, offsets)
    counts = np.diff(at)
    with np.errstate(over="ignore"):
        if len(words) >= k:
            grams = words[: len(words) - k + 1] * _PLACE[0]
            for j in range(1, k):
                grams = grams + words[j : len(words) - k + 1 + j] * _PLACE[j]
            grams = mix(grams)
        sets = []
        for i, c in enumerate(counts):
            a = at[i]
            if c >= k:
                s = np.sort(grams[a : a + c - k + 1])
                keep = np.empty(len(s), bool)
                keep[0] = True
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                sets.append(s[keep])
            elif c:
                few = words[a : a + c] * _PLACE[:c]
                sets.append(mix(few.sum(dtype=U)[None] + U(int(c))))
            else:
                sets.append(np.zeros(0, U))
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, U)), np.concatenate([[0], np.cumsum(sizes)])


def set_ids(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set, from sums that don't depend on order; 0 for an empty one."""
    with np.errstate(over="ignore"):
        total = np.zeros(len(flat) + 1, U)
        np.cumsum(mix(flat + U(0x632BE59BD9B4E019)), out=total[1:])
        sizes = np.diff(at)
        ids = mix(total[at[1:]] - total[at[:-1]] + sizes.astype(U) * _PLACE[63])
    ids[sizes == 0] = 0
    return ids
