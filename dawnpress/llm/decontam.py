"""Benchmark decontamination by greedy string tiling.

Texts are lower-cased (A-Z) words; ASCII punctuation separates words as white space does. A document
and a benchmark item are compared when they share a *seed*, a run of ``seed`` words. Tiling then marks
their longest common run of words that are not marked yet, again and again, until no run of ``seed``
words is left: windows of a search length are compared by running Karp-Rabin hashes, hits are grown
and the longest are marked first. The share of an item's words that are marked is its coverage; order
does not matter, so passages that were reordered or cut into pieces are caught.

Only words inside shared seeds can be marked, so a document is cut down to those before tiling: the
work of a pair follows what it shares and not the document's length. The benchmark is a stated query
set. It is read in blocks of about ``block`` items and ``BLOCK_BYTES`` at most, each sent to the scan whole; one scan per block covers
all documents, without a shuffle and without gathering the documents that share a passage.

Defined cases: a null or blank document or item matches nothing; an item with fewer words than a seed
is caught when the document holds it whole as a run of words; repeated rows are judged alike; an item
without item_id takes part in :func:`drop_leaks`, while :func:`leaks`, which names items, leaves it out; an empty
benchmark or corpus gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dawnpress.llm.textscan import LOWER, MULTIPLIERS, SPACE, U64, mix, word_chunks

SEED = 5
COVERAGE = 0.5
#: Items and bytes of a block.
BLOCK, BLOCK_BYTES = 20_000, 1 << 25

BREAKS = SPACE.copy()
BREAKS[[b for b in range(33, 127) if not chr(b).isalnum()]] = True

_KR = U64(0x100000001B3)


def _runs(h: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``n`` values, by doubling."""
    out, have, power = h, 1, _KR
    result, done = None, 0
    while True:
        if n & have:
            if result is None:
                result, done = out, have
            else:  # append a window of ``have`` values
                k = len(h) - done - have + 1
                result = result[:k] * power + out[done : done + k] if k > 0 else np.zeros(0, U64)
                done += have
        if 2 * have > n:
            return result
        k = len(out) - have
        out = out[:k] * power + out[have : have + k] if k > 0 else np.zeros(0, U64)
        with np.errstate(over="ignore"):
            power = power * power
        have *= 2


def _open(free: np.ndarray, n: int) -> np.ndarray:
    """Where windows of ``n`` free places begin."""
    taken = np.append(0, np.cumsum(~free))
    return np.flatnonzero(taken[n:] == taken[:-n])


def _longest(free: np.ndarray) -> int:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]])))
    return int((edges[1::2] - edges[::2]).max(initial=0))


def tile(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two word-hash sequences: (start in item, start in text, length).

    The longest run that both still have is found by halving: if there is one of a length, there is one of each
    shorter length, and hashes of all free windows of a length tell. All windows of that length are then tried in
    order, each with the places of the text that have its hash; a place that was marked is passed once. No pairs
    of windows are listed, so texts that repeat their words cost no more than others."""
    tiles: list[tuple[int, int, int]] = []
    free_i, free_t = np.ones(len(item), bool), np.ones(len(text), bool)

    def windows(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        a, b = _open(free_i, n), _open(free_t, n)
        return a, _runs(item, n)[a], b, _runs(text, n)[b]

    def common(n: int) -> bool:
        _, ha, _, hb = windows(n)
        return bool(np.isin(ha, hb).any())

    most = min(len(item), len(text))
    while (most := min(most, _longest(free_i), _longest(free_t))) >= least and common(least):
        low, high = least, most
        while low < high:
            n = (low + high + 1) // 2
            low, high = (n, high) if common(n) else (low, n - 1)
        n, most = low, low - 1
        a, ha, b, hb = windows(n)
        order = np.argsort(hb, kind="stable")
        b, hb = b[order], hb[order]
        first, stop = np.searchsorted(hb, ha, "left"), np.searchsorted(hb, ha, "right")
        some, begun, end = np.flatnonzero(stop > first), {}, -1
        for i, x, y in zip(a[some].tolist(), first[some].tolist(), stop[some].tolist(), strict=True):
            if i < end:
                continue
            k = begun.get(x, x)  # places before it are marked
            while k < y:
                j = int(b[k])
                if not free_t[j : j + n].all():
                    k += int(np.searchsorted(b[k:y], j + 1 + np.flatnonzero(~free_t[j : j + n])[-1]))
                    begun[x] = k
                elif np.array_equal(item[i : i + n], text[j : j + n]):
                    free_i[i : i + n] = free_t[j : j + n] = False
                    tiles.append((i, j, n))
                    end = i + n
                    break
                else:  # equal hashes of different words
                    k += 1
    return tiles


class Items:
    """A block of benchmark items, ready to be looked up by seed."""

    def __init__(self, ids: list[int], texts: list[str], seed: int):
        self.seed, self.ids, self.words = seed, ids, []
        for _, _, w in word_chunks(pa.array(texts, pa.string()), fold=LOWER, ends_word=BREAKS):
            self.words += [w.hashes[a:b] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        self.tables = []  # for each length of seed (shorter ones for shorter items): sorted hashes, item
        for n in range(1, seed + 1):
            rows = [(h, i) for i, w in enumerate(self.words) if (len(w) == n if n < seed else len(w) >= n) for h in np.unique(_gram(w, n)).tolist()]
            if rows:
                h = np.array([r[0] for r in rows], U64)
                order = np.argsort(h, kind="stable")
                self.tables.append((n, h[order], np.array([r[1] for r in rows], np.int64)[order]))


def _gram(h: np.ndarray, n: int) -> np.ndarray:
    k = max(0, len(h) - n + 1)
    out = np.zeros(k, U64)
    for j in range(n):
        out += h[j : j + k] * MULTIPLIERS[30 + j]
    return mix(out)


def _pairs(words, items: Items) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item, words marked, words of the item, tiles) for pairs of a chunk that share a seed."""
    row_end = words.first[1:]
    for n, known, owner in items.tables:
        grams = _gram(words.hashes, n)
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        hits = np.flatnonzero(known[at] == grams)
        rows = np.searchsorted(row_end, hits, "right")
        hits = hits[hits + n <= row_end[rows]]
        rows = np.searchsorted(row_end, hits, "right")
        # all items that hold a hit's seed
        lo, hi = np.searchsorted(known, grams[hits], "left"), np.searchsorted(known, grams[hits], "right")
        width = hi - lo
        item = owner[np.repeat(lo - np.cumsum(width) + width, width) + np.arange(width.sum())]
        row, hit = np.repeat(rows, width), np.repeat(hits, width)
        order = np.lexsort((hit, item, row))
        row, item, hit = row[order], item[order], hit[order]
        if not len(row):
            continue
        cuts = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (item[1:] != item[:-1])))
        for a, b in zip(cuts, [*cuts[1:], len(row)], strict=True):
            h = np.unique(hit[a:b])
            inside = np.unique((h[:, None] + np.arange(n)).ravel())
            gap = np.flatnonzero(np.diff(inside) > 1) + 1
            text = np.insert(words.hashes[inside], gap, np.arange(1, len(gap) + 1).astype(U64))  # a separator equals no word's hash
            w = items.words[item[a]]
            tiles = tile(w, text, n)
            yield int(row[a]), int(item[a]), sum(t[2] for t in tiles), len(w), len(tiles)


def _blocks(benchmark: DataFrame, block: int) -> Iterator[tuple[list[int], list[str]]]:
    rows = benchmark.select(F.col("item_id").cast("long"), "text").where("text is not null")
    total, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n = max(1, -(-total // block), -(-size // BLOCK_BYTES))
    for k in range(n if total else 0):
        got = (rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)).collect()
        yield [r[0] for r in got], [r[1] for r in got]


def leaks(docs: DataFrame, benchmark: DataFrame, seed: int = SEED, coverage: float = COVERAGE, block: int = BLOCK) -> DataFrame:
    """``doc_id, item_id, n_marked, n_words, n_tiles, coverage`` for each document and item whose
    coverage is ``coverage`` or more."""
    benchmark = benchmark.where("item_id is not null")
    schema = "doc_id long, item_id long, n_marked long, n_words long, n_tiles long, coverage double"
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for ids, texts in _blocks(benchmark, block):
        items = docs.sparkSession.sparkContext.broadcast(Items(ids, texts, seed))  # a block is bounded

        def scan(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                got = []
                doc = batch.column(0)
                for first, _, words in word_chunks(batch.column(1), fold=LOWER, ends_word=BREAKS):
                    for row, i, marked, n, tiles in _pairs(words, items.value):
                        if marked >= coverage * n:
                            got.append((doc[first + row].as_py(), items.value.ids[i], marked, n, tiles, marked / n))
                cols = list(zip(*got, strict=True)) or [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64() if k == 5 else pa.int64()) for k, c in enumerate(cols)], ["doc_id", "item_id", "n_marked", "n_words", "n_tiles", "coverage"])

        part = docs.mapInArrow(scan, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, seed: int = SEED, coverage: float = COVERAGE, block: int = BLOCK) -> DataFrame:
    """``docs`` without the rows that cover a benchmark item, with the same columns. Each row is judged by its own
    text where it stands, whatever its id: nothing is joined or shuffled."""
    for ids, texts in _blocks(benchmark, block):
        items = docs.sparkSession.sparkContext.broadcast(Items(ids, texts, seed))

        def keep(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(len(batch), bool)
                for first, _, words in word_chunks(batch.column("text"), fold=LOWER, ends_word=BREAKS):
                    for row, _, marked, n, _ in _pairs(words, items.value):
                        if marked >= coverage * n:
                            clean[first + row] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
