"""Words, hashes and shingles of whole texts, computed on Arrow buffers with numpy.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``, with A-Z lower-cased. Its hash is a
polynomial over 64 bits, taken from one running sum over the bytes, so no Python string is made.
Different words share a hash with a chance of about 2^-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text hashed at a time; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Kinds of bytes: 0 between words; a word is a run of one kind.
WORDS = (~_SPACE).astype(np.uint8)
#: Letters (all bytes beyond ASCII count as such), digits and other signs are words of their own.
RUNS = WORDS * np.uint8(3)
RUNS[48:58] = 2
RUNS[128:] = 1
RUNS[65:91] = 1
RUNS[97:123] = 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits over 64 bits, one to one."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_VALUE = mix(np.arange(1, 257, dtype=_U))[_LOWER]
#: Byte values that keep upper and lower case apart.
CASED = mix(np.arange(1, 257, dtype=_U))
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """Powers 0 to n - 1 of the base, modulo 2^64; kept for slices of the usual size."""
    if n > 2 * SLICE_BYTES:
        steps = np.full(n, base, dtype=_U)
        steps[0] = 1
        return np.multiply.accumulate(steps)
    if base not in _powers:
        steps = np.full(2 * SLICE_BYTES, base, dtype=_U)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


def utf8(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string array; a null is empty."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if values.null_count:
        values = values.fill_null("")
    values = values.cast(pa.large_string())
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(values) + 1, values.offset * 8)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about SLICE_BYTES each, one row at least."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


def hashes(
    data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray = WORDS, values: np.ndarray = _VALUE
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, in order, and for each text the number of words before it (one more than texts)."""
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if not len(data):
        return np.zeros(0, _U), np.zeros(len(offsets), np.int64)
    kind = kinds[data]
    first = kind > 0
    last = first.copy()
    same = kind[1:] == kind[:-1]
    first[1:] &= ~same
    last[:-1] &= ~same
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = kind[edges] > 0
    last[edges - 1] = kind[edges - 1] > 0
    first, last = np.flatnonzero(first), np.flatnonzero(last)
    sums = np.cumsum(values[data] * _power(_BASE, len(data)), dtype=_U)
    before = np.where(first > 0, sums[first - 1], _U(0))
    words = mix((sums[last] - before) * _power(_INVERSE, len(data))[first])
    return words, np.searchsorted(first, offsets).astype(np.int64)


def ngrams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, by the place of its first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = words[:n]
    for k in range(1, size):
        out = mix(out * _U(0xD6E8FEB86659FD93) + words[k : k + n])
    return out


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingles of one text; a shorter text is one shingle, an empty one none."""
    if not len(words):
        return words
    if len(words) < size:
        return mix(ngrams(words, len(words)) + _U(len(words)))
    return np.unique(ngrams(words, size))


def word_slices(
    texts: pa.Array, kinds: np.ndarray = WORDS, values: np.ndarray = _VALUE
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For a column of texts: first row of a slice, its word hashes, and the words before each of its rows."""
    data, offsets = utf8(texts)
    for a, b in slices(offsets):
        yield a, *hashes(data, offsets[a : b + 1], kinds, values)


def as_long(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return np.ascontiguousarray(values).view(np.int64)
