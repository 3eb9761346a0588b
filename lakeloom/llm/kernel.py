"""Vectorised word, shingle and sentence hashing over Arrow string columns.

Texts never become Python strings: the UTF-8 buffer of a batch is cut into
words with table lookups, each word gets a 64-bit polynomial hash, and shingles
are sums of word hashes times odd constants, all with numpy on whole batches.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_WRAP = (1 << 64) - 1
BLOCK = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def _series(seed: int, n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed))


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[U(1)], np.full(n - 1, U(base))]), dtype=U)


BASE = 0x9FB21C651E98DF25
ODD = _series(77, 64) | U(1)
_POWERS = _powers(BASE, 1 << 12)


def trimmed(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``f``, after which what a task freed goes back to the system: worker processes stay, and idle ones count beside busy ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(AttributeError, OSError):  # other C libraries than glibc
            ctypes.CDLL(None).malloc_trim(0)

    return run


class Alphabet:
    """Which bytes separate words, and the code of each byte inside a word."""

    def __init__(self, separators: bytes, lower: bool = True) -> None:
        code = _series(5, 256) | U(1)
        if lower:
            code[65:91] = code[97:123]
        self.sep = np.zeros(256, bool)
        self.sep[list(separators)] = True
        code[self.sep] = 0
        self.code = code


SPACES = b" \t\n\x0b\x0c\r"
#: Words between white space, A-Z lower-cased.
PLAIN = Alphabet(SPACES)
#: Words without ASCII punctuation.
LETTERS = Alphabet(SPACES + bytes(c for c in range(33, 127) if not chr(c).isalnum()))


def powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        _POWERS = _powers(BASE, 1 << int(n).bit_length())
    return _POWERS


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the offsets of the rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about ``BLOCK`` bytes; a longer row is a run of its own."""
    data, offsets = buffers(column)
    n, first = len(offsets) - 1, 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK, "right")) - 1)
        end = min(end, n)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def word_hashes(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet = PLAIN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, first byte of each word, word offsets of the rows)."""
    n = len(data)
    sep = alphabet.sep[data]
    before = np.ones(n + 1, bool)
    before[1:] = np.append(sep[:-1], True) if n else []
    before[offsets[:-1]] = True
    start = np.flatnonzero(~sep & before[:n])
    rows = np.searchsorted(start, offsets)
    if not len(start):
        return np.zeros(0, U), start, rows
    code = alphabet.code[data[start[0] :]]
    at = np.arange(start[0], n) - np.repeat(start, np.diff(np.append(start, n)))
    longest = int(at[~sep[start[0] :]].max()) + 1
    p = powers(longest)
    code *= p[np.minimum(at, longest - 1)]
    return mix(np.add.reduceat(code, start - start[0])), start, rows


def shingles(words: np.ndarray, rows: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes in text order, offsets of the rows); a row of 1 to k-1 words has one shingle, its whole sequence."""
    per = np.diff(rows)
    count = np.where(per >= k, per - k + 1, (per > 0).astype(per.dtype))
    at = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(at[-1], U)
    n = len(words)
    if n >= k:
        total = words[: n - k + 1] * ODD[0]
        for j in range(1, k):
            total += words[j : n - k + 1 + j] * ODD[j]
        row = np.repeat(np.arange(len(per)), per)[: n - k + 1]
        keep = np.flatnonzero(rows[1:][row] - np.arange(n - k + 1) >= k)
        r = row[keep]
        out[at[:-1][r] + keep - rows[:-1][r]] = total[keep]
    short = np.flatnonzero((per > 0) & (per < k))
    if len(short):
        total = np.zeros(len(short), U)
        for j in range(k - 1):
            has = per[short] > j
            total[has] += words[rows[:-1][short[has]] + j] * ODD[j]
        out[at[:-1][short]] = total + per[short].astype(U) * ODD[40]
    return mix(out), at


def shingle_rows(column: pa.Array, k: int = 5, alphabet: Alphabet = PLAIN) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, shingle hashes, row offsets) over the blocks of a column."""
    for first, end, data, offsets in blocks(column):
        h, _, rows = word_hashes(data, offsets, alphabet)
        s, at = shingles(h, rows, k)
        yield first, end, s, at


def distinct_sorted(s: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """Per row the ascending different hashes."""
    for i in range(len(at) - 1):
        yield np.unique(s[at[i] : at[i + 1]])


def word_stems(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet, lengths: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, row of each) of whole words, then of the first so many bytes of longer words."""
    whole, start, rows = word_hashes(data, offsets, alphabet)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    yield whole, row
    if not len(start):
        return
    code = alphabet.code[data[start[0] :]]
    sep = alphabet.sep[data[start[0] :]]
    size = np.diff(np.append(start, len(data)))
    at = np.arange(start[0], len(data)) - np.repeat(start, size)
    p = powers(max(lengths) + 1)
    for n in lengths:
        inside = np.where(at < n, code * p[np.minimum(at, n)], U(0))
        longer = np.flatnonzero((size > n) & ~sep[np.minimum(start - start[0] + n, len(sep) - 1)])
        yield mix(np.add.reduceat(inside, start - start[0])[longer] + ODD[n]), row[longer]


def sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, words, first byte, row offsets) of the sentences: words up to one that ends in . ! or ?, a line break, or the row's end."""
    h, start, rows = word_hashes(data, offsets)
    if not len(h):
        return h, np.zeros(0, np.int64), start, rows
    sep = PLAIN.sep[data]
    after = np.append(sep[1:], True)
    inner = offsets[1:-1]
    after[inner[(inner > 0)] - 1] = True
    last = data[np.flatnonzero(~sep & after)]
    breaks = np.cumsum(data == 10)
    ends = (last == 46) | (last == 33) | (last == 63)
    ends[:-1] |= breaks[start[1:]] > breaks[start[:-1]]
    ends[rows[1:][rows[1:] > rows[:-1]] - 1] = True
    first = np.concatenate([[0], np.flatnonzero(ends)[:-1] + 1])
    words = np.diff(np.append(first, len(h)))
    at = np.arange(len(h)) - np.repeat(first, words)
    total = mix(np.add.reduceat(h * powers(int(words.max()))[at], first))
    return total, words, start[first], np.searchsorted(first, rows)
