"""Vectorised reading of whole texts out of Arrow columns.

A text column's bytes are looked at in place, some documents at a time, so that memory stays
bounded whatever the batch holds. Words are ``[^\\x20\\x09-\\x0D]+``; hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Documents are looked at together up to so many bytes; a longer one is read in parts.
CHUNK_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(BASE, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)
_POWERS = {"up": np.ones(1, U64), "down": np.ones(1, U64)}
MULTIPLIERS = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 63, 64, dtype=U64) * U64(2) + U64(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", BASE), ("down", _BASE_INVERSE)):
            p = np.full(size, U64(base))
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=U64)
    return _POWERS["up"], _POWERS["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over all others."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def bytes_and_bounds(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and where its rows begin; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    return (np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)), bounds


def portions(bounds: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold ``most`` bytes together, or one row."""
    at, n = 0, len(bounds) - 1
    while at < n:
        to = int(np.searchsorted(bounds, bounds[at] + most, "right")) - 1
        to = min(n, max(to, at + 1))
        yield at, to
        at = to


_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?")] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


def _part_marks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One mark behind a letter or digit becomes a word of its own."""
    last, one, two = data[ends - 1], data[np.maximum(ends - 2, 0)], data[np.maximum(ends - 3, 0)]
    size = ends - starts
    latin = (two == 0xC3) & (one >= 0x80) & (one != 0x97) & (one != 0xB7) & (size > 2)
    apart = np.flatnonzero(_MARK[last] & (size > 1) & (_ALNUM[one] | latin))
    at = ends[apart] - 1
    ends = ends.copy()
    ends[apart] -= 1
    return np.insert(starts, apart + 1, at), np.insert(ends, apart + 1, at + 1)


def _span_words(data: np.ndarray, cuts: np.ndarray, ends_word: np.ndarray, marks: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of ``data``; ``cuts`` are where rows begin."""
    inside = ~ends_word[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[cuts - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    if marks:
        starts, ends = _part_marks(data, starts, ends)
    up, down = _powers(len(data) + 1)
    total = np.empty(len(data) + 1, U64)
    total[0] = 0
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return starts, ends, mix(h ^ ((ends - starts).astype(U64) * U64(BASE)))


class Words:
    """The words of some rows: byte ``starts`` and ``ends`` in ``data``, ``hashes``, and ``first``,
    the index of each row's first word (one more entry than rows). With ``marks``, a mark that ends a word
    is a word of its own."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, fold: np.ndarray | None = LOWER, ends_word: np.ndarray = SPACE, marks: bool = False):
        lo, hi = int(bounds[0]), int(bounds[-1])
        data = data[lo:hi]
        self.data = fold[data] if fold is not None else data
        self.bounds = bounds - lo
        parts, at = [], 0
        while at < len(self.data) or not parts:
            to = min(len(self.data), at + CHUNK_BYTES)
            if to < len(self.data):  # a row longer than a chunk is cut between two words
                gaps = np.flatnonzero(ends_word[self.data[at:to]])
                if len(gaps):
                    to = at + int(gaps[-1]) + 1
                else:
                    rest = np.flatnonzero(ends_word[self.data[to:]])
                    later = self.bounds[self.bounds > at]
                    to = min(to + int(rest[0]) + 1 if len(rest) else len(self.data), int(later[0]) if len(later) else len(self.data))
            s, e, h = _span_words(self.data[at:to], self.bounds - at, ends_word, marks)
            parts.append((s + at, e + at, h))
            at = to
        self.starts, self.ends, self.hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
        self.first = np.searchsorted(self.starts, self.bounds)

    def grams(self, n: int) -> np.ndarray:
        """Hash of the ``n`` words from each word on; those that run over a row's end are junk."""
        k = max(0, len(self.hashes) - n + 1)
        out = np.zeros(k, U64)
        for j in range(n):
            out += self.hashes[j : j + k] * MULTIPLIERS[j]
        return mix(out)

    def shingle_sets(self, n: int = 5) -> Iterator[np.ndarray]:
        """For each row the sorted distinct hashes of its ``n``-word shingles; of fewer words, one."""
        grams = self.grams(n)
        for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True):
            if b - a >= n:
                s = np.sort(grams[a : b - n + 1])
                keep = np.empty(len(s), bool)
                keep[0] = True
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                yield s[keep]
            elif b > a:
                yield mix((self.hashes[a:b] * MULTIPLIERS[8 : 8 + b - a]).sum(keepdims=True, dtype=U64) + U64(b - a))
            else:
                yield np.zeros(0, U64)


def word_chunks(column: pa.Array, **how) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) for successive portions of a text column."""
    data, bounds = bytes_and_bounds(column)
    for a, b in portions(bounds):
        yield a, b, Words(data, bounds[a : b + 1], **how)
