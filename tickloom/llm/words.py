"""Words of ASCII letters, digits and non-ASCII characters, hashed batch by batch in numpy.

A-Z are lower-cased; a word is a longest run of 0-9, a-z and bytes of 0x80 and above. A
word's hash is a polynomial of its bytes modulo 2^64, mixed; equal words have equal hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
LOWER = np.arange(256, dtype=np.uint64)
LOWER[65:91] += 32
WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POW, _INV = _powers(BASE, PIECE + 1), _powers(INVERSE, PIECE + 1)


def _hash_piece(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    global _POW, _INV
    n = len(values)
    if n > len(_POW):
        _POW, _INV = _powers(BASE, 2 * n), _powers(INVERSE, 2 * n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((values + np.uint64(1)) * _POW[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _INV[starts])


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
    """Hashes of data[starts[i]:ends[i]], spans in order and apart; values: what stands for each element, else itself."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        low = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, low + PIECE, side="right")))
        piece = data[low : ends[j - 1]]
        out[i:j] = _hash_piece(piece.astype(np.uint64) if values is None else values[piece], starts[i:j] - low, ends[i:j] - low)
        i = j
    return out


def word_hashes(column: pa.StringArray, heads: tuple[int, ...] = ()) -> tuple:
    """(offsets, hashes): the words of text i are hashes[offsets[i]:offsets[i + 1]].

    With heads, a third value has for each of these lengths the hashes of the first so many bytes of all longer
    words, and where those of each word begin among them: (hashes, places), one place more than words.

    column: strings without nulls. Works through the bytes in pieces cut between words,
    so that a very long text needs no more memory than its hashes.
    """
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if len(column) == 0 or bounds[-1] == bounds[0]:
        none = np.zeros(len(column) + 1, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        return (*none, [(none[1], np.zeros(1, dtype=np.int64))] * len(heads)) if heads else none
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    inside = WORD[data]
    joined = inside[1:] & inside[:-1]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    joined[inner - 1] = False
    starts = np.flatnonzero(inside & np.concatenate(([True], ~joined)))
    ends = np.flatnonzero(inside & np.concatenate((~joined, [True]))) + 1
    found = np.searchsorted(starts, bounds), span_hashes(data, starts, ends, LOWER)
    if not heads:
        return found
    longer = [(n, ends - starts > n) for n in heads]
    return *found, [(span_hashes(data, starts[more], starts[more] + n, LOWER), np.concatenate(([0], np.cumsum(more)))) for n, more in longer]


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words, one for each first word; empty if there are fewer than k."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = hashes[:n].copy()
    for i in range(1, k):
        out *= np.uint64(BASE)
        out += hashes[i : i + n]
    return mix(out)
