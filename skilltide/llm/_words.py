"""Words and word hashes of a batch of texts, on the bytes of an Arrow string column.

A text is never turned into Python strings: the UTF-8 bytes of the column are looked up, cut into
words and hashed as arrays. Work is done in slices, so that memory follows the slice and the
longest word, not the batch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_WORDS = 100_000

# ASCII upper case to lower case; every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C13)
_MIX = (_U(0xFF51AFD7ED558CCD), _U(0xC4CEB9FE1A85EC53))
_STEP = _U(0xD6E8FEB86659FD93)
_BYTE_CODES = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE_INVERSE = _U(pow(int(_BASE), -1, 2**64))


def byte_class(keep) -> np.ndarray:
    """A table of which bytes belong to a word."""
    return np.array([bool(keep(b)) for b in range(256)])


ALPHANUMERIC = byte_class(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
NOT_SPACE = byte_class(lambda b: b != 32 and not 9 <= b <= 13)


def mix(h: np.ndarray) -> np.ndarray:
    """The finishing step of a 64-bit hash."""
    h = h ^ (h >> _U(33))
    h = h * _MIX[0]
    h = h ^ (h >> _U(33))
    h = h * _MIX[1]
    return h ^ (h >> _U(33))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(size, base)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins (one more than texts); null has none."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


@dataclass
class Words:
    """``start`` and ``end`` of each word in the bytes, and ``first``: the number of the first
    word of each text (one more than texts)."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def cut_words(data: np.ndarray, texts: np.ndarray, lowered: bool, table: np.ndarray) -> Words:
    inside = (table[LOWER] if lowered else table)[data]
    n = len(data)
    if n == 0:
        return Words(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts), np.int64))
    edge = np.zeros(n + 1, bool)
    edge[texts] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:n]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | edge[1:n]
    start = np.flatnonzero(opens)
    return Words(start, np.flatnonzero(closes) + 1, np.searchsorted(start, texts))


def hash_words(data: np.ndarray, words: Words, lowered: bool) -> np.ndarray:
    """A 64-bit hash per word: a polynomial in random byte codes, taken from running sums."""
    codes = _BYTE_CODES[LOWER] if lowered else _BYTE_CODES
    out = np.empty(len(words.start), np.uint64)
    for i in range(0, len(out), SLICE_WORDS):
        start, end = words.start[i : i + SLICE_WORDS], words.end[i : i + SLICE_WORDS]
        low = start[0]
        powers, inverse = _power_tables(int(end[-1] - low))
        sums = np.empty(int(end[-1] - low) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(codes[data[low : end[-1]]] * powers, out=sums[1:])
        part = (sums[end - low] - sums[start - low]) * inverse[start - low]
        out[i : i + SLICE_WORDS] = mix(part + (end - start).astype(np.uint64) * _STEP)
    return out


def chain(h: np.ndarray, n: int) -> np.ndarray:
    """A hash per run of ``n`` neighbours; runs may reach over the end of a text."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = h[: len(h) - n + 1].copy()
    for i in range(1, n):
        out = out * _STEP + h[i : len(h) - n + 1 + i]
    return mix(out + _U(n))


def slices(texts: np.ndarray, most: int = 1_000_000):
    """Ranges of texts with about ``most`` bytes each; a longer text is a range of its own."""
    i, n = 0, len(texts) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(texts, texts[i] + most, side="right")) - 1)
        yield i, j
        i = j


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Lists of the given lengths, cut from ``values``."""
    at = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values, kind))
