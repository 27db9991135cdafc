"""Words and word shingles of whole Arrow batches, hashed without a Python object per word.

A word is a run of bytes other than space and the control characters 9 to 13;
A to Z count as a to z. A shingle is five words in a row; a text of one to
four words has its whole sequence as its only shingle, an empty one has none.
Hashes have 64 bits and are the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SHINGLE = 5
# Texts are hashed in chunks of about so many bytes, which bounds the temporary arrays.
_CHUNK = 1 << 20

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_LOWER += 1
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACES = np.array(
    [0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB],
    dtype=np.uint64,
)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@dataclass
class Words:
    """The words of some texts: `hashes` of all words; text i has those from `bounds[i]` to `bounds[i + 1]`."""

    first: int
    hashes: np.ndarray
    starts: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1


def binary_batches(column: pa.Array, chunk: int = _CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows that hold about `chunk` bytes; a null has no bytes."""
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, places, data = column.buffers()
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(places, dtype=width)[column.offset : column.offset + n + 1].astype(np.int64)
    bytes_ = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + chunk, side="right")) - 1
        end = min(n, max(end, row + 1))
        yield row, bytes_[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def words(column: pa.Array, chunk: int = _CHUNK) -> Iterator[Words]:
    """Hashed words of a binary column, in runs of rows."""
    for first, data, offsets in binary_batches(column, chunk):
        filled = ~_BLANK[data]
        begins, after = filled.copy(), filled.copy()
        begins[1:] &= ~filled[:-1]
        after[:-1] &= ~filled[1:]
        # A text's first byte begins a word even where the one before it ends without a blank.
        inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
        begins[inner] = filled[inner]
        starts = np.flatnonzero(begins)
        if len(starts) == 0:
            yield Words(first, np.zeros(0, np.uint64), starts, np.zeros(len(offsets), np.int64))
            continue
        lead = starts[0]
        place = np.arange(lead, len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
        powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(int(place.max()), _BASE)]))
        value = _LOWER[data[lead:]] * powers[place]
        value[~filled[lead:]] = 0
        yield Words(first, mixed(np.add.reduceat(value, starts - lead)), starts, np.searchsorted(starts, offsets))


def shingles(found: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the shingle that starts at each word, whether one does)."""
    n = len(found.hashes)
    padded = np.concatenate([found.hashes, np.zeros(size, np.uint64)])
    ends = np.repeat(found.bounds[1:], np.diff(found.bounds))
    left = ends - np.arange(n)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        # Words beyond the text's end stay out of a short text's only shingle.
        total += np.where(left > k, padded[k : k + n], np.uint64(0)) * _PLACES[k]
    lengths = np.repeat(np.diff(found.bounds), np.diff(found.bounds))
    starts = np.repeat(found.bounds[:-1], np.diff(found.bounds))
    whole = (lengths < size) & (np.arange(n) == starts)
    return mixed(total ^ np.minimum(lengths, size).astype(np.uint64)), (left >= size) | whole


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in the order of the rows."""
    for found in words(column):
        hashes, valid = shingles(found, size)
        for a, b in zip(found.bounds[:-1], found.bounds[1:]):
            yield np.unique(hashes[a:b][valid[a:b]])
