"""Hashes of all words and shingles of many texts at once, over the raw UTF-8 bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Odd multiplier of the polynomial over bytes, and the constants of the 64-bit finaliser.
BASE = 0x9E3779B97F4A7C15
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
PIECE = 1 << 20
LONG_WORD = 4096
U64 = np.uint64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> U64(30))
    x = x * MIX_1
    x = x ^ (x >> U64(27))
    x = x * MIX_2
    return x ^ (x >> U64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(BASE, PIECE + LONG_WORD + 1)
_INVERSE = _powers(pow(BASE, -1, 1 << 64), PIECE + LONG_WORD + 1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word data[start:end]; the same word has the same hash anywhere."""
    out = np.empty(len(starts), U64)
    long = ends - starts > LONG_WORD
    for i in np.flatnonzero(long):
        digest = hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    short = np.flatnonzero(~long)
    cuts = np.flatnonzero(np.diff(starts[short] // PIECE)) + 1
    for part in np.split(short, cuts) if len(short) else ():
        low, high = starts[part[0]], ends[part].max()
        sums = np.zeros(high - low + 1, U64)
        np.cumsum((data[low:high] + U64(1)) * _POWERS[:high - low], out=sums[1:])
        a, b = starts[part] - low, ends[part] - low
        out[part] = (sums[b] - sums[a]) * _INVERSE[a] + (b - a).astype(U64)
    return mix(out)


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, start and end of every word; text i is data[bounds[i]:bounds[i + 1]]."""
    solid = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[bounds] = True
    before = np.concatenate([[False], solid[:-1]]) if len(data) else solid
    starts = np.flatnonzero(solid & (~before | first[:-1]))
    after = np.concatenate([solid[1:], [False]]) if len(data) else solid
    ends = np.flatnonzero(solid & (~after | first[1:])) + 1
    return np.searchsorted(bounds, starts, side="right") - 1, starts, ends


def shingle_sets(data: np.ndarray, bounds: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its k-word shingles, A-Z lower-cased.

    A text of fewer than k words has one shingle, the whole sequence; one without words, none.
    """
    data = _LOWER[data]
    text, starts, ends = words(data, bounds)
    hashed = word_hashes(data, starts, ends)
    at = np.searchsorted(text, np.arange(len(bounds)))
    seed = mix(np.full(max(len(hashed) - k + 1, 0), k, U64))
    for j in range(k):
        seed = mix(seed + hashed[j:j + len(seed)])
    for i in range(len(bounds) - 1):
        a, b = at[i], at[i + 1]
        if b - a >= k:
            yield np.unique(seed[a:b - k + 1])
        elif b > a:
            short = mix(np.full(1, b - a, U64))
            for j in range(a, b):
                short = mix(short + hashed[j:j + 1])
            yield short
        else:
            yield np.empty(0, U64)


def text_bytes(column: pa.Array, limit: int = 4 * PIECE) -> Iterator[
        tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts of about `limit` bytes at most: first row, their bytes, their bounds.

    A null is an empty text. A longer text is a run of its own, whole.
    """
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.empty(0, np.uint8)
    row, n = 0, len(column)
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        end = min(end, n)
        yield row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end
