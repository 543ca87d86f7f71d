"""Texts of an Arrow batch as flat numpy arrays: words, hashes, shingles. Runs inside tasks.

Words are the longest runs of bytes other than 0x20 and 0x09-0x0D. Those bytes never occur inside
a longer UTF-8 sequence, so working on bytes gives the same words as working on code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Texts are handled in runs of at most so many bytes, or one text if it is longer.
CHUNK_BYTES = 1 << 20

IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95
_powers = {"up": np.ones(1, dtype=U64), "down": np.ones(1, dtype=U64)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, n of them at least."""
    if len(_powers["up"]) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, CHUNK_BYTES + 1), base, dtype=U64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=U64)
    return _powers["up"], _powers["down"]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins; a null is an empty text."""
    column = pc.fill_null(column, "") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.zeros(1, dtype=np.int64)
    if len(column):
        at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    return flat[at[0] : at[-1]], at.astype(np.int64) - at[0]


def chunks(
    column: pa.Array, limit: int = CHUNK_BYTES
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts: the first one's row, the bytes, and where each text begins in them."""
    data, at = utf8(column)
    row, rows = 0, len(at) - 1
    while row < rows:
        end = max(int(np.searchsorted(at, at[row] + limit, "right")) - 1, row + 1)
        yield row, data[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words begin and end, and the number of words before each text and after the last."""
    inside = IS_WORD[data]
    edge = np.empty(len(data), dtype=bool)
    if len(data):
        edge[0] = True
        np.logical_not(inside[:-1], out=edge[1:])
        edge[at[:-1][at[:-1] < len(data)]] = True
    starts = np.flatnonzero(inside & edge)
    last = np.empty(len(data), dtype=bool)
    if len(data):
        last[-1] = True
        np.copyto(last[:-1], edge[1:] | ~inside[1:])
    ends = np.flatnonzero(inside & last) + 1
    return starts, ends, np.searchsorted(starts, at)


def hash_runs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of 64-bit values; equal runs have equal hashes."""
    up, down = _power(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    total = (sums[ends] - sums[starts]) * down[starts]
    return mix(total + (ends - starts).astype(U64) * U64(0x9E3779B97F4A7C15))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; equal spans have equal hashes."""
    return hash_runs(_BYTE[data], starts, ends)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of n words, by its first word; runs cross the ends of texts."""
    if len(hashes) < n:
        return np.zeros(0, dtype=U64)
    total = np.zeros(len(hashes) - n + 1, dtype=U64)
    for j in range(n):
        total += hashes[j : len(hashes) - n + 1 + j] * U64(pow(_BASE, j + 1, 1 << 64))
    return mix(total + U64(n))


def shingle_sets(
    data: np.ndarray, at: np.ndarray, n: int = 5
) -> Iterator[np.ndarray]:
    """Per text, its distinct n-word shingles, hashed and sorted; A-Z are lower-cased.

    A text of fewer words has the whole sequence as its one shingle; one without words has none.
    """
    data = LOWER[data]
    starts, ends, before = words(data, at)
    hashes = hash_spans(data, starts, ends)
    runs = grams(hashes, n)
    for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
        if b - a >= n:
            found = np.sort(runs[a : b - n + 1])
            yield found[np.append(True, found[1:] != found[:-1])]
        elif b > a:
            yield grams(hashes[a:b], b - a)
        else:
            yield runs[:0]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def segment_sum(values: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Sums of the runs values[before[i]:before[i + 1]]; an empty run has 0."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), dtype=np.float64)
    np.cumsum(values, axis=0, dtype=np.float64, out=total[1:])
    return total[before[1:]] - total[before[:-1]]


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places starts[i], starts[i] + 1, ... of all runs, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
