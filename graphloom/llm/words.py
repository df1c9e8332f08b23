"""Words of whole texts as 64-bit hashes, for many texts at once.

A word is a run of bytes outside 0x20 and 0x09-0x0D; A-Z count as a-z. All work is on the UTF-8 bytes of an
Arrow string column: no Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed at once; texts are never cut, so a longer text is a step of its own.
STEP_BYTES = 2_000_000
SHINGLE = 5

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BYTE[65:91] = _BYTE[97:123]
_BASE = 0xD6E8FEB86659FD93
_SPAN = 1 << 16
# An odd number without structure for each place in a word: no pattern of letters cancels out, as it can with powers.
_PLACE = mix(np.arange(1, _SPAN + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)


def texts_of(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One contiguous column without nulls (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type != pa.large_string():
        column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the n + 1 bounds of its rows, without a copy."""
    n = len(column)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    if data is None or not n or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def placed(value: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``value`` (of every byte) times the number of the byte's place in its run; runs begin at ``begin`` and fill all."""
    within = np.arange(value.size, dtype=np.int64) - np.repeat(begin, lengths)
    if lengths.max() > _SPAN:  # a huge run: only places beyond the table take another factor
        far = np.flatnonzero(within >= _SPAN)
        value[far] *= mix((within[far] >> 16).astype(np.uint64)) | np.uint64(1)
        within &= _SPAN - 1
    value *= _PLACE[within]
    return value


def hash_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and for each row the bounds of its words."""
    keep = ~_BLANK[data]
    first = keep.copy()
    first[1:] &= ~keep[:-1]
    at = bounds[:-1][bounds[:-1] < data.size]
    first[at] = keep[at]
    starts = np.flatnonzero(first)
    words = np.searchsorted(starts, bounds)
    if not starts.size:
        return np.zeros(0, np.uint64), words
    kept = data[keep]
    begin = (np.cumsum(keep, dtype=np.int64)[starts]) - 1
    lengths = np.diff(np.append(begin, kept.size))
    value = placed(_BYTE[kept], begin, lengths)
    return mix(np.add.reduceat(value, begin) + lengths.astype(np.uint64)), words


def hashed_steps(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, word hashes, word bounds) for runs of rows of about ``STEP_BYTES``."""
    data, bounds = raw_bytes(column)
    row, n = 0, len(column)
    while row < n:
        end = int(np.searchsorted(bounds, bounds[row] + STEP_BYTES, "right")) - 1
        end = min(n, max(end, row + 1))
        yield row, end, *hash_words(data[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row])
        row = end


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hash of every ``size``-word shingle of one word sequence, in order; a shorter sequence is one shingle, none gives none."""
    n = words.size
    if not n:
        return words
    k = min(n, size)
    out = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        out = out * np.uint64(_BASE) + words[i : n - k + 1 + i]
    return mix(out + np.uint64(k))


def row_shingles(words: np.ndarray, bounds: np.ndarray, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """``shingles`` of each row; computed over all rows at once."""
    every = shingles(words, size) if words.size >= size else words[:0]
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        yield every[a : b - size + 1] if b - a >= size else shingles(words[a:b], size)
