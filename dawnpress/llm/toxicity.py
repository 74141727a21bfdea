"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the presence of n-grams of 3 to 7 code points of the lower-cased text, in which each run of
white space is one blank and a blank stands before the first word. Fitting:

1. A bounded sample of labelled rows (``sample``, the least hashes of the training ids) is read.
2. In a table of fixed size (``2 ** BITS`` counters a class) n-grams are counted by class; the buckets
   that go with the label (chi-squared) are kept, at most ``FEATURES``.
3. The n-grams of those buckets, by their full 64-bit hashes, get class counts of their own and a
   log-count ratio ``r``; logistic regression is fitted on the presences scaled by ``r``.

Scoring is one pass over all documents: no shuffle, whole texts, nothing broadcast but the model (at
most ``FEATURES`` n-grams and a bitmap). Only n-grams of the dictionary count, so a long text is not
diluted by its ordinary words.

Defined cases: a null or empty text has no n-gram and gets the intercept's score; a null label or a
label without document trains nothing; a null doc_id is scored, is not held out and trains nothing; repeated labels of an id count once, as toxic if one is; with
one class or none the score is the share of toxic labels (0 without labels); labels, lang, source and
doc_id are no inputs of a score; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dawnpress.llm.textscan import MULTIPLIERS, U64
from dawnpress.plans.lineage import cut

SAMPLE = 40_000
SHORTEST, LONGEST = 3, 7
BITS, FEATURES, LEAST_CHI2 = 20, 4096, 20.0
#: Parts of the table of counters, which are summed apart.
TABLE_PARTS = 16
#: Code points of a text that are looked at together; parts overlap, so no n-gram is lost.
PART = 1 << 20


def _spread(h: np.ndarray) -> np.ndarray:
    h = h * U64(0xFF51AFD7ED558CCD)
    return (h ^ (h >> U64(32))) * U64(0x9E3779B97F4A7C15)


def ngrams(text: str | None) -> Iterator[np.ndarray]:
    """64-bit hashes of all n-grams of a text."""
    text = " " + " ".join((text or "").lower().split()) if text else ""
    for a in range(0, len(text), PART):
        c = np.frombuffer(text[a : a + PART + LONGEST - 1].encode("utf-32-le", "surrogatepass"), np.uint32).astype(U64)
        h = c * MULTIPLIERS[0]
        for n in range(2, LONGEST + 1):
            if len(c) < n:
                break
            h = h[:-1] + c[n - 1 :] * MULTIPLIERS[n - 1]
            if n >= SHORTEST:
                yield _spread(h[:PART] + MULTIPLIERS[40 + n])


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that trains nothing."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


@dataclass
class Model:
    hashes: np.ndarray  # sorted
    weights: np.ndarray
    intercept: float
    bitmap: np.ndarray  # by the first BITS of a hash

    def present(self, text: str | None) -> np.ndarray:
        """Indices of the dictionary's n-grams that a text has."""
        found = []
        for h in ngrams(text):
            h = h[self.bitmap[(h >> U64(64 - BITS)).astype(np.int64)]]
            if len(h):
                at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
                found.append(at[self.hashes[at] == h])
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def score(self, text: str | None) -> float:
        z = self.intercept + float(self.weights[self.present(text)].sum()) if len(self.hashes) else self.intercept
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def _chi2(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    n, have = n_pos + n_neg, pos + neg
    under = have * (n - have) * float(n_pos) * n_neg
    return np.where(under > 0, n * (pos * float(n_neg) - neg * float(n_pos)) ** 2 / np.maximum(under, 1), 0.0)


def _ratio(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    return np.log((pos + 1.0) / (n_pos + 2.0)) - np.log((neg + 1.0) / (n_neg + 2.0))


def _constant(p: float) -> Model:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return Model(np.zeros(0, U64), np.zeros(0), float(np.log(p / (1 - p))), np.zeros(1 << BITS, bool))


def _logistic(row: np.ndarray, col: np.ndarray, value: np.ndarray, y: np.ndarray, width: int, l2: float = 1e-3, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and intercept by gradient steps with adapted rates (Adam), full batch."""
    w, b = np.zeros(width), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, steps + 1):
        z = b + np.bincount(row, value * w[col], len(y))
        e = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y) / len(y)
        g = np.append(np.bincount(col, value * e[row], width) + l2 * w / len(y), e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = 5) -> Model:
    """The model from at most ``sample`` labelled rows outside the held-out fold."""
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # ids without a document would use up the sample
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = known.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(sample)
    rows = cut(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text"), "labelled")
    totals = {bool(r[0]): r[1] for r in rows.groupBy(F.col("toxic") > 0).count().collect()}
    n_pos, n_neg = totals.get(True, 0), totals.get(False, 0)
    if not n_pos or not n_neg:
        return _constant(1.0 if n_pos else 0.0)

    wide = (1 << BITS) // TABLE_PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((2, 1 << BITS), np.uint16), np.zeros(1 << BITS, bool)
        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for h in ngrams(text):
                    seen[(h >> U64(64 - BITS)).astype(np.int64)] = True
                u = np.flatnonzero(seen)
                total[int(y > 0), u] += 1  # a task has fewer rows than 2 ** 16: the sample is dealt over more tasks
                seen[u] = False
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TABLE_PARTS, dtype=np.int32)), pa.array([total[:, k * wide : (k + 1) * wide].tobytes() for k in range(TABLE_PARTS)], pa.binary())], ["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sums[part] = sums.get(part, 0) + np.frombuffer(x.as_buffer(), np.uint16).astype(np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["part", "counts"])

    schema = "part int, counts binary"
    dealt = rows.repartition(max(8, -(-sample // 5_000))).mapInArrow(count, schema)
    counts = np.zeros((2, 1 << BITS))
    for r in dealt.repartition(TABLE_PARTS, "part").mapInArrow(add, schema).collect():  # one table of fixed size
        counts[:, r["part"] * wide : (r["part"] + 1) * wide] = np.frombuffer(r["counts"], np.uint32).reshape(2, wide)
    chi2 = _chi2(counts[1], counts[0], n_pos, n_neg)
    best = np.argsort(-chi2, kind="stable")[:FEATURES]
    bitmap = np.zeros(1 << BITS, bool)
    bitmap[best[chi2[best] >= LEAST_CHI2]] = True

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                kept = [h[bitmap[(h >> U64(64 - BITS)).astype(np.int64)]] for h in ngrams(text)]
                out.append(np.unique(np.concatenate(kept)).tobytes() if kept else b"")
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), pa.array(out, pa.binary())], ["toxic", "grams"])

    got = rows.repartition(max(8, -(-sample // 5_000))).mapInArrow(gather, "toxic int, grams binary").collect()  # at most ``sample`` rows
    got.sort(key=lambda r: (r["toxic"], bytes(r["grams"])))  # the order of the sum does not depend on the tasks
    y = np.array([float(r["toxic"] > 0) for r in got])
    grams = [np.frombuffer(r["grams"], U64) for r in got]
    row = np.repeat(np.arange(len(got)), [len(g) for g in grams])
    hashes, col = np.unique(np.concatenate(grams), return_inverse=True)
    pos, neg = np.bincount(col, y[row], len(hashes)), np.bincount(col, 1 - y[row], len(hashes))
    chi2 = _chi2(pos, neg, n_pos, n_neg)
    order = np.argsort(-chi2, kind="stable")[:FEATURES]
    use = np.zeros(len(hashes), bool)
    use[order[chi2[order] >= LEAST_CHI2]] = True
    if not use.any():
        return _constant(n_pos / (n_pos + n_neg))
    r = _ratio(pos, neg, n_pos, n_neg)
    new = np.cumsum(use) - 1
    keep = use[col]
    w, b = _logistic(row[keep], new[col[keep]], r[col[keep]], y, int(use.sum()))
    bitmap = np.zeros(1 << BITS, bool)
    bitmap[(hashes[use] >> U64(64 - BITS)).astype(np.int64)] = True
    return Model(hashes[use], w * r[use], b, bitmap)


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **how) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs(doc_id, text)``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **how))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m.score(t.as_py()) for t in batch.column(1)], pa.float64())], ["doc_id", "score"])

    got = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double")
    return got.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
