"""Words and word hashes of a whole Arrow text column at once, in numpy.

A column is one contiguous byte buffer plus offsets, so words are found and
hashed for all rows of a batch without a Python loop over rows or words.
Work is cut into runs of rows of about ``RUN_BYTES``; a longer text is a run
of its own whose bytes are handled piece by piece, cut between words, so
memory follows the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN_BYTES = 1 << 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_BASE_INV = _U(pow(int(_BASE), -1, 1 << 64))
_SHINGLE_BASE = _U(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def byte_set(ranges: list[tuple[int, int]]) -> np.ndarray:
    """Boolean table of the 256 byte values, true inside the given ranges."""
    out = np.zeros(256, bool)
    for lo, hi in ranges:
        out[lo:hi + 1] = True
    return out


#: Words are maximal runs of bytes that are not ASCII white space.
SPACED = ~byte_set([(0x20, 0x20), (0x09, 0x0D)])
#: Words are maximal runs of ASCII letters, digits and all bytes from 0x80 up.
ALNUM = byte_set([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: A random 64-bit value for each byte, the same for A-Z as for a-z.
BYTE_HASH = mix(np.arange(1, 257, dtype=_U) * _U(0xA24BAED4963EE407))[_LOWER]


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self):
        self.up = np.ones(1, _U)
        self.down = np.ones(1, _U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), RUN_BYTES + 1)
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.r_[_U(1), np.full(size - 1, _BASE)])
                self.down = np.cumprod(np.r_[_U(1), np.full(size - 1, _BASE_INV)])
        return self.up, self.down


_POWERS = _Powers()


@dataclass
class Run:
    """Consecutive rows of a batch: ``first[i]:first[i+1]`` are row i's words.
    ``stem`` has, for each wanted stem length, a hash of the first bytes of
    each word (0: the word is no longer than that)."""

    row0: int
    rows: int
    first: np.ndarray
    word: np.ndarray
    stem: np.ndarray


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The byte buffer and row offsets of a text column (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, off


def _pieces(data: np.ndarray, lo: int, hi: int, in_word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of a long text, cut behind a byte that is in no word."""
    while hi - lo > 4 * RUN_BYTES:
        cut = lo + 4 * RUN_BYTES
        while cut < hi and in_word[data[cut - 1]]:
            step = np.flatnonzero(~in_word[data[cut:min(hi, cut + RUN_BYTES)]])
            cut = cut + int(step[0]) + 1 if len(step) else min(hi, cut + RUN_BYTES)
        yield lo, cut
        lo = cut
    if hi > lo:
        yield lo, hi


def word_spans(data: np.ndarray, lo: int, hi: int, bounds: np.ndarray, in_word: np.ndarray):
    """Start and end offsets of the words in ``data[lo:hi]``; ``bounds`` are
    row offsets inside it, where words also end."""
    m = in_word[data[lo:hi]]
    start = m.copy()
    start[1:] &= ~m[:-1]
    inner = bounds[(bounds > lo) & (bounds < hi)] - lo
    start[inner] |= m[inner]
    end = m.copy()
    end[:-1] &= ~m[1:]
    end[inner - 1] |= m[inner - 1]
    return np.flatnonzero(start) + lo, np.flatnonzero(end) + lo + 1


def _hash_piece(data, lo, hi, bounds, in_word, stems):
    s, e = word_spans(data, lo, hi, bounds, in_word)
    up, down = _POWERS.get(hi - lo + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(hi - lo + 1, _U)
        np.cumsum(BYTE_HASH[data[lo:hi]] * up[:hi - lo], out=total[1:])
        h = mix((total[e - lo] - total[s - lo]) * down[s - lo])
        cut = np.zeros((len(stems), len(s)), _U)
        for i, n in enumerate(stems):
            long = np.flatnonzero(e - s > n)
            at = s[long] - lo
            cut[i, long] = mix((total[at + n] - total[at]) * down[at] + _U(n))
    return s, h, cut


def runs(column: pa.Array, in_word: np.ndarray, run_bytes: int = RUN_BYTES, stems: tuple[int, ...] = ()) -> Iterator[Run]:
    """Runs of rows with the hashes of their words."""
    data, off = text_bytes(column)
    n, row = len(off) - 1, 0
    while row < n:
        last = int(np.searchsorted(off, off[row] + run_bytes, side="right")) - 1
        last = min(max(last, row + 1), n)
        own = off[row:last + 1]
        starts, hashes, cuts = [np.zeros(0, np.int64)], [np.zeros(0, _U)], [np.zeros((len(stems), 0), _U)]
        for lo, hi in _pieces(data, int(own[0]), int(own[-1]), in_word):
            s, h, cut = _hash_piece(data, lo, hi, own, in_word, stems)
            starts.append(s)
            hashes.append(h)
            cuts.append(cut)
        first = np.searchsorted(np.concatenate(starts), own)
        yield Run(row, last - row, first, np.concatenate(hashes), np.concatenate(cuts, axis=1))
        row = last


class Lookup:
    """Sorted distinct hashes behind a small bitmap, which most others fail."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.bits = max(16, int(32 * max(len(self.hashes), 1)).bit_length())
        self.bitmap = np.zeros(1 << self.bits, bool)
        self.bitmap[(self.hashes >> _U(64 - self.bits)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in ``h``, indices of the hash found there)."""
        at = np.flatnonzero(self.bitmap[(h >> _U(64 - self.bits)).astype(np.int64)])
        if not len(at) or not len(self.hashes):
            return at[:0], at[:0]
        i = np.searchsorted(self.hashes, h[at])
        i[i == len(self.hashes)] = 0
        ok = self.hashes[i] == h[at]
        return at[ok], i[ok]


def shingles(word: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k`` consecutive words (``len(word) - k + 1`` of them)."""
    n = len(word) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    return shingle_of([word[j:j + n] for j in range(k)])


def shingle_of(words: list[np.ndarray]) -> np.ndarray:
    """Hash of the shingles whose j-th words are ``words[j]``."""
    with np.errstate(over="ignore"):
        acc = np.full(len(words[0]), _U(len(words)), _U)
        for w in words:
            acc = acc * _SHINGLE_BASE + w
        return mix(acc)


def shingle_sets(run: Run, k: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each row; a row with fewer
    words than ``k`` has its whole sequence as one shingle, or none."""
    every = shingles(run.word, k)
    first = run.first
    for i in range(run.rows):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= k:
            yield run.row0 + i, np.unique(every[a:b - k + 1])
        elif b > a:
            yield run.row0 + i, shingles(run.word[a:b], b - a)
        else:
            yield run.row0 + i, every[:0]
