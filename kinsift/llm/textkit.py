"""Vectorised text kernels over Arrow string columns: words, lines, shingles, hashes.

Texts are taken as UTF-8 bytes, straight from the Arrow buffer; null counts as empty.  A word is
``[^\\x20\\x09-\\x0D]+``; those separators are single bytes in UTF-8, so no character is ever split.
Hashes are 64 bits wide: a polynomial over random byte values, finished by splitmix64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[65:91] += 32
_BYTE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, for i < n."""
    if len(_powers[0]) < n:
        for k, b in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(max(n, 1 << 20), b, U)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finisher."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes, one text after another, and len+1 offsets into them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a piece has at most so many bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of other bytes than separators; runs end where a text does."""
    inside = ~separator[data]
    full = offsets[1:] > offsets[:-1]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    at, to = offsets[:-1][full], offsets[1:][full] - 1
    first[at], last[to] = inside[at], inside[to]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = SAME) -> np.ndarray:
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U)
    np.cumsum(_BYTE[fold[data]] * down[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * up[starts] + (ends - starts).astype(U))


class Words:
    """Words of a column: starts, ends, and of[i]:of[i+1] are those of text i."""

    def __init__(self, column: pa.Array, fold: np.ndarray = SAME):
        self.data, self.offsets = text_bytes(column)
        self.starts, self.ends = spans(self.data, self.offsets, SEPARATOR)
        self.of = np.searchsorted(self.starts, self.offsets)
        self.fold = fold

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends, self.fold)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k words from each word on (the last k-1 are left out)."""
    n = max(0, len(hashes) - k + 1)
    total = np.zeros(n, U)
    factor = 1
    for i in range(k):
        factor = factor * 0xD6E8FEB86659FD93 % 2**64
        total += hashes[i : i + n] * U(factor)
    return mix(total + U(k))


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """For each text its distinct k-word shingles, A-Z lower-cased, as sorted hashes.

    A text of fewer words has one, the whole sequence; one without words has none.
    """
    words = Words(column, LOWER)
    h = words.hashes()
    all_windows = windows(h, k)
    out = []
    for a, b in zip(words.of[:-1].tolist(), words.of[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(all_windows[a : b - k + 1]))
        elif b > a:
            out.append(windows(h[a:b], b - a))
        else:
            out.append(np.zeros(0, U))
    return out


def flat(arrays: list[np.ndarray], kind: type = np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """One array of all, and offsets."""
    offsets = np.zeros(len(arrays) + 1, np.int64)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    return (np.concatenate(arrays) if arrays else np.zeros(0, kind)), offsets
