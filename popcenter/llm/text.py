"""Words and word n-grams of whole texts as NumPy arrays, straight from Arrow string columns.

Nothing here works on a word in Python: a column's bytes are classed, word borders are found
and hashes are taken for all words of a slice of documents at once. Slices hold about
``SLICE_BYTES`` of text (or one document, if that alone is longer), which bounds memory.

Hashes: a word's is a polynomial over its bytes (a random 64-bit number per byte value) from
prefix sums modulo 2^64 with an odd base, so it does not depend on where the word stands; an
n-gram's is the same over word hashes. Both end in a 64-bit mixing step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21
U = np.uint64
#: Odd multipliers and their inverses modulo 2^64 come from one seed.
_BASE = 0x9E3779B97F4A7C15
_BASES = [(_BASE * (2 * i + 1)) % (1 << 64) | 1 for i in range(4)]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse modulo 2^64."""
    have = _powers.get(which)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        out = []
        for base in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
            p = np.full(size, base, U)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = _powers[which] = (out[0], out[1])
    return have[0][:n], have[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """The final step of the public-domain splitmix64 generator."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U) * U(_BASE))


def buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = col.fill_null("")
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of documents of about ``limit`` bytes."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, j
        i = j


def not_space() -> np.ndarray:
    """For each byte: does it belong to a word ``[^\\x20\\x09-\\x0D]+``?"""
    table = np.ones(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = False
    return table


def letters() -> np.ndarray:
    """For each byte: does it belong to a word ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``?"""
    table = np.ones(256, bool)
    table[0x00:0x30] = table[0x3A:0x61] = table[0x7B:0x80] = False
    return table


def lower(buf: np.ndarray) -> np.ndarray:
    """A-Z in lower case, byte by byte."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    return table[buf]


def word_spans(buf: np.ndarray, offs: np.ndarray, inside: np.ndarray,
               alone: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each document the number of its first word (one
    more at the end). ``alone``: bytes that are words of their own."""
    m = inside[buf]
    n = len(m)
    begin, end = m.copy(), m.copy()
    begin[1:] &= ~m[:-1]
    end[:-1] &= ~m[1:]
    edges = offs[(offs > 0) & (offs < n)]
    begin[edges] = m[edges]
    end[edges - 1] = m[edges - 1]
    if alone is not None:
        a = alone[buf]
        begin |= a
        end |= a
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offs)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    p, inverse = powers(which, len(buf) + 1)
    sums = np.zeros(len(buf) + 1, U)
    np.cumsum(byte_values()[buf] * p[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


class Grams:
    """Hashes of word sequences of one slice: ``at(start, length)`` for arrays of both."""

    def __init__(self, words: np.ndarray, which: int = 1):
        p, self.inverse = powers(which, len(words) + 1)
        self.sums = np.zeros(len(words) + 1, U)
        np.cumsum(words * p[:-1], out=self.sums[1:])

    def at(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        h = (self.sums[start + length] - self.sums[start]) * self.inverse[start]
        return mix(h + np.asarray(length).astype(U) * U(_BASE))


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... (count[0] of them), first[1], ..."""
    total = int(count.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(count)
    return np.arange(total, dtype=np.int64) + np.repeat(first - (ends - count), count)


def list_array(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """A list column from its values and the length of each row."""
    offs = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offs[1:])
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), values)


def signed(h: np.ndarray) -> pa.Array:
    """64-bit hashes as Arrow longs."""
    return pa.array(np.ascontiguousarray(h).view(np.int64))


def load(block):
    """A broadcast's value in a task, without the handle keeping it: of several blocks a task
    holds one at a time."""
    value = block.value
    vars(block).pop("_value", None)
    return value
