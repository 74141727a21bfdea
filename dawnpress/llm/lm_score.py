"""LM scoring by masked pseudo-likelihood with a small bidirectional window network, in numpy.

Tokens are lower-cased words. Every word that makes up 2 ** -15 of the corpus (and occurs ``FREQUENT``
times) has an id of its own, so there are at most 2 ** 15 of them at any size; the others share ``OOV``
hashed ids. Each token is predicted from the ``SPAN`` tokens on either side: their embeddings, weighted
by place, are summed and squashed; a two-level softmax (class, then word in class) gives normalised
probabilities. A word without an id of its own has the probability of its hashed id times its share of
that id's tokens in the whole corpus, so every word is predicted as itself. A document's score is the
sum of its tokens' conditional log-probabilities.

Word counts cover all documents and stay a table; only frequent words and the hashed ids' totals reach
the driver. The softmax starts from the words' exact frequencies. Training covers all documents, too:
documents are dealt by their hash to shards (one for ``SHARD_TOKENS`` tokens, ``MOST_SHARDS`` at most), a
shard runs once over its tokens in the order of the hashes, in steps of ``BATCH`` places, and the
shards' weights are averaged by token count in the shards' order. So weights and scores follow from
the documents alone and not from files, partitions or the order in which tasks end. Scoring meets the counts by
share of the hash space, as they are never gathered in one place; its sums go back by chunk of documents.

Defined cases: a null or blank text has no token and the score 0, with a null mean; a null doc_id is
scored as any other; repeated rows are scored alike; an empty corpus scores nothing; texts are read
whole, whatever their length; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dawnpress.llm.textscan import U64, word_chunks
from dawnpress.plans.lineage import cut

OOV, DIM, SPAN = 64, 16, 3
BATCH, RATE = 8192, 0.1
#: Weights stay below ``LIMIT`` and biases above ``LEAST_BIAS`` (no word), so that no exponential
#: overflows; no probability is given as less than ``LEAST_P``.
LIMIT, LEAST_BIAS, LEAST_P = np.float32(4), np.float32(-1e4), np.float32(1e-30)

#: A word of so many tokens, and of so large a share of all (as a power of two), has an id of its own.
FREQUENT, SHARE_BITS = 20, 15
#: Tokens of a training shard, shards at most, and shards whose weights are summed by one task.
SHARD_TOKENS, MOST_SHARDS, FAN = 1 << 20, 4096, 64
#: Distinct words of a share of the hash space, and shares at most; both are powers of two.
SHARE_WORDS, MOST_SHARES = 1 << 18, 4096


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: the hash of each word of the corpus and how often it occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(w.hashes, return_counts=True) for _, _, w in word_chunks(batch.column(0))]
            if found:
                h, where = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
                n = np.bincount(where, np.concatenate([f[1] for f in found]), len(h)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["word", "n"])

    return docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Words with ids of their own, most frequent first, then the ``OOV`` hashed ids; how many tokens each
    id has; ``blank`` stands between documents."""

    def __init__(self, words: np.ndarray, tokens: np.ndarray, hashed: np.ndarray):
        self.order = np.argsort(words)
        self.words = words[self.order]
        self.tokens = np.concatenate([tokens, hashed]).astype(np.int64)
        self.hashed = hashed
        self.size = self.blank = len(words) + OOV

    def ids(self, h: np.ndarray) -> np.ndarray:
        out = self.size - OOV + (h % U64(OOV)).astype(np.int64)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            known = self.words[at] == h
            out[known] = self.order[at[known]]
        return out.astype(np.uint16)

    def stream(self, words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids with ``SPAN`` blanks before, between and behind rows, places of the tokens, row of each)."""
        n = np.diff(words.first)
        row = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(row)) + SPAN * (row + 1)
        out = np.full(len(row) + SPAN * (len(n) + 1), self.blank, np.uint16)
        out[place] = self.ids(words.hashes)
        return out, place, row


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, int]:
    """The vocabulary, and in how many shares the other words are met."""
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    least = max(FREQUENT, total >> SHARE_BITS)
    rows = sorted(counts.where(F.col("n") >= least).collect(), key=lambda r: (-r["n"], r["word"]))  # 2 ** SHARE_BITS at most
    hashed = np.zeros(OOV, np.int64)
    for r in counts.where(F.col("n") < least).groupBy(F.col("word").bitwiseAND(OOV - 1).alias("k")).agg(F.sum("n").alias("n")).collect():
        hashed[r["k"]] = r["n"]
    shares = 1 << max(0, (distinct // SHARE_WORDS).bit_length())
    words = np.array([r["word"] for r in rows], np.int64).view(U64)
    return Vocabulary(words, np.array([r["n"] for r in rows], np.int64), hashed), min(max(shares, OOV), MOST_SHARES)


OFFSETS = [o for o in range(-SPAN, SPAN + 1) if o]


class Network:
    """Weights: embeddings, a weight per place and dimension, classes, words in classes.

    It works on a piece of a stream of ids: all places but the outer ``SPAN`` are predicted."""

    def __init__(self, tokens: np.ndarray, seed: int = 3):
        self.size = len(tokens)
        self.classes = max(1, math.ceil(math.sqrt(self.size)))
        self.wide = -(-self.size // self.classes)
        r = np.random.Generator(np.random.PCG64(seed))
        f = lambda *s: r.normal(0, 0.1, s).astype(np.float32)
        mass = np.zeros(self.classes * self.wide)
        mass[: self.size] = tokens + 0.5
        mass = mass.reshape(self.classes, self.wide)
        with np.errstate(divide="ignore"):
            of_class, in_class = np.log(mass.sum(1) / mass.sum()), np.log(mass / np.maximum(mass.sum(1, keepdims=True), 0.5))
        self.p = [
            f(self.size + 1, DIM), np.ones((len(OFFSETS), DIM), np.float32), 0.1 * f(DIM, self.classes), np.maximum(of_class, LEAST_BIAS).astype(np.float32),
            0.1 * f(self.classes, DIM, self.wide), np.maximum(in_class, LEAST_BIAS).astype(np.float32),
        ]
        self.g = None
        self.rooms = [np.empty(BATCH * self.classes, np.float32), np.empty(BATCH * self.wide, np.float32)]

    def _hidden(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        e = self.p[0][ids]
        n = len(ids) - 2 * SPAN
        total, one = np.zeros((n, DIM), np.float32), np.empty((n, DIM), np.float32)
        for o, w in zip(OFFSETS, self.p[1], strict=True):
            total += np.multiply(e[SPAN + o : SPAN + o + n], w, out=one)
        return np.tanh(total, out=total), e

    @staticmethod
    def _odds(room: np.ndarray, h: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exponentials and their sum for each row; the weights' ``LIMIT`` keeps them finite. For steps only, whose
        rows follow from the shard: the linear algebra library adds in an order that follows from how many rows there are."""
        z = np.matmul(h, weights, out=room[: len(h) * len(bias)].reshape(len(h), len(bias)))
        z += bias
        np.exp(z, out=z)
        return z, z.sum(1)

    @staticmethod
    def _odds_down(room: np.ndarray, h: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of ``h`` by columns, which stand in columns of the result. A column's values do not depend on
        those beside it, so scores do not follow from how rows are dealt: all are added row by row. One column
        alone, which numpy would add up in another order, is taken twice."""
        n = h.shape[1]
        h = np.repeat(h, 2, axis=1) if n == 1 else h
        z = np.einsum("jk,ji->ki", weights, h, out=room[: len(bias) * h.shape[1]].reshape(len(bias), h.shape[1]))
        z += bias[:, None]
        np.exp(z, out=z)
        return z[:, :n], z.sum(0)[:n]

    def _by_class(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, slice]]]:
        """Places of a piece's words in the order of their classes, classes, words in class, and where the
        words of each class are."""
        target = ids[SPAN:-SPAN]
        cls = target // np.uint16(self.wide)
        order = np.argsort(cls, kind="stable")
        order = order[target[order] != self.size]
        cls = cls[order].astype(np.intp)
        cuts = np.searchsorted(cls, np.arange(self.classes + 1)).tolist()
        return order, cls, target[order] - cls * self.wide, [(k, slice(x, y)) for k, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if y > x]

    def log_probs(self, ids: np.ndarray) -> np.ndarray:
        """Of the id at each place but the outer ``SPAN``, given the ids around it; 0 for blanks."""
        out = np.zeros(max(0, len(ids) - 2 * SPAN))
        for a in range(0, len(out), BATCH):
            piece = ids[a : a + BATCH + 2 * SPAN]
            order, cls, inside, groups = self._by_class(piece)
            h = np.ascontiguousarray(self._hidden(piece)[0][order].T)
            z, total = self._odds_down(self.rooms[0], h, self.p[2], self.p[3])
            every = np.arange(len(total))
            p = z[cls, every] / total
            for k, rows in groups:
                z, total = self._odds_down(self.rooms[1], h[:, rows], self.p[4][k], self.p[5][k])
                p[rows] *= z[inside[rows], every[: len(total)]] / total
            out[a + order] = np.log(np.maximum(p, LEAST_P).astype(np.float64))
        return out

    def step(self, ids: np.ndarray) -> int:
        """One step over a piece, with rates adapted per weight; returns how many tokens were predicted."""
        if self.g is None:
            self.g = [np.full_like(x, 1e-6) for x in self.p]
        order, cls, inside, groups = self._by_class(ids)
        if not len(order):
            return 0
        every, e = self._hidden(ids)
        h, n = every[order], np.float32(1 / len(order))
        d, total = self._odds(self.rooms[0], h, self.p[2], self.p[3])
        d *= (n / total)[:, None]
        d[np.arange(len(d)), cls] -= n
        grads = [np.zeros_like(self.p[0]), np.zeros_like(self.p[1]), h.T @ d, d.sum(0), np.zeros_like(self.p[4]), np.zeros_like(self.p[5])]
        back = d @ self.p[2].T
        for k, rows in groups:
            q, total = self._odds(self.rooms[1], h[rows], self.p[4][k], self.p[5][k])
            q *= (n / total)[:, None]
            q[np.arange(len(q)), inside[rows]] -= n
            np.matmul(h[rows].T, q, out=grads[4][k])
            q.sum(0, out=grads[5][k])
            back[rows] += q @ self.p[4][k].T
        back *= 1 - h * h
        around, one, moved = np.zeros_like(every), np.empty_like(every), np.zeros_like(e)
        around[order] = back
        for j, (o, w) in enumerate(zip(OFFSETS, self.p[1], strict=True)):
            beside = slice(SPAN + o, SPAN + o + len(around))
            grads[1][j] = np.einsum("ij,ij->j", around, e[beside])
            moved[beside] += np.multiply(around, w, out=one)
        order = np.argsort(ids, kind="stable")
        words = ids[order]
        cuts = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
        grads[0][words[cuts]] = np.add.reduceat(moved[order], cuts, axis=0)
        for x, g, s in zip(self.p, grads, self.g, strict=True):
            s += g * g
            x -= RATE * g / np.sqrt(s)
            np.clip(x, LEAST_BIAS, LIMIT, out=x)
        return len(h)

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.p])

    def take(self, flat: np.ndarray) -> None:
        at = 0
        for k, x in enumerate(self.p):
            self.p[k] = flat[at : at + x.size].astype(np.float32).reshape(x.shape)
            at += x.size


_WEIGHTS = "shard int, n long, weights binary"


def _weights(shard: int, n: int, w: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([n]), pa.array([w.astype(np.float64).tobytes()], pa.binary())], ["shard", "n", "weights"])


def train(docs: DataFrame, vocab: Vocabulary, seed: int = 3) -> Network:
    """Weights averaged over the shards' passes over their tokens."""
    shards = min(MOST_SHARDS, max(1, -(-int(vocab.tokens.sum()) // SHARD_TOKENS)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, to, w in word_chunks(batch.column(1)):
                ids = vocab.ids(w.hashes)
                blobs = [ids[a:b].tobytes() for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, to - first), pa.array(blobs, pa.binary())], ["key", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, net, held, have, seen = None, None, [], 0, 0
        gap = np.full(SPAN, vocab.blank, np.uint16)
        for batch in batches:
            for shard, blob in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                if shard != at:
                    if net is not None:
                        yield _weights(at, seen + net.step(np.concatenate(held)), net.flat())
                    at, net, held, have, seen = shard, Network(vocab.tokens, seed), [gap], SPAN, 0
                held += [np.frombuffer(blob.as_buffer(), np.uint16), gap]
                have += len(held[-2]) + SPAN
                if have >= BATCH + 2 * SPAN:
                    stream, a = np.concatenate(held), 0
                    while len(stream) - a >= BATCH + 2 * SPAN:
                        seen += net.step(stream[a : a + BATCH + 2 * SPAN])
                        a += BATCH
                    held, have = [stream[a:]], len(stream) - a
        if net is not None:
            yield _weights(at, seen + net.step(np.concatenate(held)), net.flat())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total, seen = None, None, 0
        for batch in batches:
            for shard, n, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if at is not None and shard // FAN != at:
                    yield _weights(at, seen, total / seen)
                    total, seen = None, 0
                x = np.frombuffer(w.as_buffer(), np.float64) * n
                at, total, seen = shard // FAN, (x if total is None else total + x), seen + n
        if at is not None:
            yield _weights(at, seen, total / seen)

    net = Network(vocab.tokens, seed)
    # the id is part of the key: copies of one text, however many, are dealt to all shards
    keyed = docs.where("text is not null").select(F.xxhash64("doc_id", "text").alias("key"), "text")
    coded = keyed.mapInArrow(encode, "key long, ids binary").where("octet_length(ids) > 0")
    dealt = coded.select(F.pmod("key", F.lit(shards)).cast("int").alias("shard"), "key", "ids").repartitionById(shards, "shard")
    got = cut(dealt.sortWithinPartitions("shard", "key", "ids").mapInArrow(run, _WEIGHTS), "weights")
    while True:
        groups = -(-shards // FAN)
        got = got.repartitionById(groups, F.expr(f"shard div {FAN}").cast("int")).sortWithinPartitions("shard").mapInArrow(add, _WEIGHTS)
        shards = groups
        if shards == 1:
            break
    for r in got.collect():  # one row, of bounded size
        net.take(np.frombuffer(r["weights"], np.float64))
    return net


#: Rows that meet by share: counts (kind 0), words without an id (1), then what is known of a chunk (2).
_PARTS = "chunk long, share int, kind int, a binary, b binary, c binary"


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["chunk", "share", "kind", "a", "b", "c"])


def _view(x: pa.Scalar, kind) -> np.ndarray:
    return np.frombuffer(x.as_buffer(), kind)


def _by_share(h: np.ndarray, shares: int) -> list[tuple[int, np.ndarray]]:
    """Where the hashes of each share are, for shares that have any."""
    if not len(h):
        return []
    share = (h % U64(shares)).astype(np.uint16)
    order = np.argsort(share, kind="stable")
    cuts = np.flatnonzero(np.append(True, np.diff(share[order]) != 0))
    return [(int(share[order[a]]), order[a:b]) for a, b in zip(cuts, np.append(cuts[1:], len(order)), strict=True)]


def score_lm(docs: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, log_prob, mean_log_prob`` for each row of ``docs(doc_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = cut(word_counts(docs), "counts")
    vocab, shares = vocabulary(counts)
    return score_with(docs, counts, vocab, shares, train(docs, vocab))


def score_with(docs: DataFrame, counts: DataFrame, vocab: Vocabulary, shares: int, net: Network) -> DataFrame:
    """The scores by a trained network."""
    model = docs.sparkSession.sparkContext.broadcast((vocab, net.p))  # 2 ** SHARE_BITS words and the hashed ids

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = model.value[0]
        net = Network(vocab.tokens)
        net.p = model.value[1]
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, to, w in word_chunks(batch.column(1)):
                ids, place, row = vocab.stream(w)
                n = np.bincount(row, minlength=to - first).astype(np.int64)
                total = np.bincount(row, net.log_probs(ids)[place - SPAN], to - first).astype(np.float64)
                rare = np.flatnonzero(ids[place] >= vocab.size - OOV)
                h, row = w.hashes[rare], row[rare].astype(np.int32)
                known = batch.column(0).slice(first, to - first)
                out = [(chunk, k, 1, h[at].tobytes(), row[at].tobytes(), None) for k, at in _by_share(h, shares)]
                out.append((chunk, chunk % shares, 2, known.fill_null(0).to_numpy(zero_copy_only=False).tobytes(), known.is_null().to_numpy(zero_copy_only=False).tobytes(), n.tobytes() + total.tobytes()))
                yield _parts(out)
                chunk += 1

    def share_of_id(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words to the sum of their log-shares for each row of the chunk; a share's counts come first."""
        at, held, h, logs = None, [], None, None
        of_id = np.log(np.maximum(model.value[0].hashed, 1))
        for batch in batches:
            out = []
            for chunk, share, kind, a, b, c in zip(*(batch.column(k) if k > 2 else batch.column(k).to_pylist() for k in range(6)), strict=True):
                if kind == 0:
                    if share != at:
                        at, held = share, []
                    held.append((_view(a, U64), _view(b, np.int64)))
                    h = None
                elif kind == 1:
                    if h is None:
                        h, n = (np.concatenate(x) for x in zip(*held, strict=True))
                        order = np.argsort(h)
                        h, logs = h[order], np.log(n[order]) - of_id[at % OOV]
                    rows = _view(b, np.int32)
                    there, where = np.unique(rows, return_inverse=True)
                    out.append((chunk, share, 1, there.tobytes(), np.bincount(where, logs[np.searchsorted(h, _view(a, U64))]).tobytes(), None))
                else:
                    out.append((chunk, share, 2, a.as_py(), b.as_py(), c.as_py()))
            yield _parts(out)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A chunk's sums to its rows; what is known of it comes first."""
        at, held = None, None

        def done() -> pa.RecordBatch:
            ids, null, n, total = held
            mean = pa.array(np.divide(total, n, out=np.zeros_like(total), where=n > 0), mask=n == 0)
            return pa.RecordBatch.from_arrays([pa.array(ids, mask=null), pa.array(n), pa.array(total), mean], ["doc_id", "n_tokens", "log_prob", "mean_log_prob"])

        for batch in batches:
            for chunk, kind, a, b, c in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), *(batch.column(k) for k in (3, 4, 5)), strict=True):
                if kind == 2:
                    if held:
                        yield done()
                    ids, null = _view(a, np.int64), _view(b, bool)
                    at, held = chunk, (ids, null, _view(c, np.int64)[: len(ids)], _view(c, np.float64)[len(ids) :].copy())
                else:
                    assert chunk == at
                    held[3][_view(a, np.int32)] += _view(b, np.float64)
        if held:
            yield done()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts by share, a blob for each that a batch has."""
        for batch in batches:
            h, n = batch.column(0).to_numpy().view(U64), batch.column(1).to_numpy()
            yield _parts([(-1, k, 0, h[at].tobytes(), n[at].tobytes(), None) for k, at in _by_share(h, shares)])

    scored = docs.mapInArrow(score, _PARTS)
    met = counts.mapInArrow(packed, _PARTS).union(scored).repartitionById(shares, "share").sortWithinPartitions("share", "kind").mapInArrow(share_of_id, _PARTS)
    # sums are added in the order of shares, so that repeated rows and runs score alike
    return met.repartition("chunk").sortWithinPartitions("chunk", F.desc("kind"), "share").mapInArrow(add, "doc_id long, n_tokens long, log_prob double, mean_log_prob double")
