"""LM scoring against loops, and its independence of the layout."""

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dawnpress.llm import lm_score
from dawnpress.llm.textscan import U64, Words
from tests.llm.conftest import ODD


def hashes(text):
    data = np.frombuffer((text or "").encode(), np.uint8)
    return Words(data, np.array([0, len(data)])).hashes


def by_loops(text, words, net, n_of):
    """A document's score, token by token, from the weights and the corpus's counts."""
    known = {int(h): int(i) for h, i in zip(words.words, words.order, strict=True)}
    number = lambda h: known.get(int(h), words.size - lm_score.OOV + int(h) % lm_score.OOV)
    h = hashes(text)
    ids = [words.blank] * lm_score.SPAN + [number(x) for x in h] + [words.blank] * lm_score.SPAN
    embed, place, classes, bias, inside, in_bias = (x.astype(float) for x in net.p)
    total = 0.0
    for k, x in enumerate(h):
        at = k + lm_score.SPAN
        hidden = np.tanh(sum(embed[ids[at + o]] * place[j] for j, o in enumerate(lm_score.OFFSETS)))
        c, i = divmod(ids[at], net.wide)
        for z, want in ((hidden @ classes + bias, c), (hidden @ inside[c] + in_bias[c], i)):
            total += z[want] - math.log(np.exp(z).sum())
        if int(x) not in known:
            total += math.log(n_of[int(x)] / words.hashed[int(x) % lm_score.OOV])
    return total


@pytest.fixture(scope="module")
def model(docs):
    counts = lm_score.word_counts(docs).cache()
    words, shares = lm_score.vocabulary(counts)
    return counts, words, shares, lm_score.train(docs, words)


def test_counts(docs, model):
    want = collections.Counter(int(x) for r in docs.select("text").collect() for x in hashes(r["text"]))
    got = {int(np.int64(r["word"]).view(U64)): r["n"] for r in model[0].collect()}
    assert got == want
    words = model[1]
    least = max(lm_score.FREQUENT, sum(want.values()) >> lm_score.SHARE_BITS)
    assert set(words.words.tolist()) == {h for h, n in want.items() if n >= least}
    assert words.tokens.sum() == sum(want.values())


def test_scores_by_loops(docs, model):
    counts, words, shares, net = model
    n_of = {int(np.int64(r["word"]).view(U64)): r["n"] for r in counts.collect()}
    got = {r["doc_id"]: r for r in lm_score.score_with(docs, counts, words, shares, net).collect()}
    rows = sorted(docs.collect(), key=lambda r: len(r["text"] or ""))
    for r in rows[::8]:
        g = got[r["doc_id"]]
        assert g["n_tokens"] == len(hashes(r["text"]))
        assert g["log_prob"] == pytest.approx(by_loops(r["text"], words, net, n_of), rel=1e-4, abs=1e-3)


def test_better_than_frequencies(docs, model):
    counts, words, shares, net = model
    n = np.array([r["n"] for r in counts.collect()])
    mean = lm_score.score_with(docs, counts, words, shares, net).agg(F.sum("log_prob") / F.sum("n_tokens")).first()[0]
    assert (n * np.log(n / n.sum())).sum() / n.sum() < mean < 0


def test_probabilities_sum_to_one(model):
    _, words, _, net = model
    ids = np.array([words.blank] * 3 + [1, 2, 3] + [0] + [5, 7, 9] + [words.blank] * 3, np.uint16)
    total = 0.0
    for w in range(words.size):
        ids[6] = w
        total += math.exp(net.log_probs(ids)[6 - lm_score.SPAN])
    assert abs(total - 1) < 1e-4


def test_layout_does_not_matter(docs, monkeypatch):
    monkeypatch.setattr(lm_score, "SHARD_TOKENS", 1 << 14)  # several shards of a small table
    monkeypatch.setattr(lm_score, "FAN", 3)
    want = None
    for laid in (docs.coalesce(1), docs.repartition(4), docs.repartition(211, "n_chars")):
        got = {tuple(r) for r in lm_score.score_lm(laid).collect()}
        want = want or got
        assert got == want


def test_words_as_themselves(spark):
    often = " ".join(f"w{i}" for i in range(960))
    rare = [f"real{i}" for i in range(200)]
    rows = [(i, often) for i in range(30)] + [(100 + i, " ".join(rare)) for i in range(5)] + [(200 + i, f"{often} {rare[i]}") for i in range(20)] + [(300 + i, f"{often} zq{i}xk") for i in range(20)] + [(None, often), (400, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm_score.score_lm(docs).collect()}
    # a word that occurs once scores below one that occurs six times, by the logarithm of the counts
    real, junk = (np.mean([got[k + i]["log_prob"] for i in range(20)]) for k in (200, 300))
    assert abs((real - junk) - np.log(6)) < 1.0
    assert len(got) == 30 + 5 + 40 + 2 and got[None]["n_tokens"] == 960 and got[400]["log_prob"] == 0


def test_many_shares(docs, model, monkeypatch):
    counts, words, _, net = model
    want = {tuple(r) for r in lm_score.score_with(docs, counts, words, 64, net).select("doc_id", "n_tokens", F.round("log_prob", 6)).collect()}
    assert {tuple(r) for r in lm_score.score_with(docs, counts, words, 1024, net).select("doc_id", "n_tokens", F.round("log_prob", 6)).collect()} == want
    monkeypatch.setattr(lm_score, "SHARE_WORDS", 16)
    assert lm_score.vocabulary(counts)[1] > lm_score.OOV


def test_odd_rows(odd, empty):
    rows = lm_score.score_lm(odd).collect()
    assert len(rows) == len(ODD)
    by = {(r["doc_id"], r["n_tokens"]): r for r in rows}
    assert by[(1, 0)]["log_prob"] == 0 and by[(1, 0)]["mean_log_prob"] is None and by[(10, 60_000)]["log_prob"] < 0
    assert by[(5, 2)]["log_prob"] == by[(4, 2)]["log_prob"] == by[(None, 2)]["log_prob"]
    assert lm_score.score_lm(empty).count() == 0


def test_scores_do_not_follow_from_rows_beside(model):
    """Pieces of any length, so also classes with one word, score as the whole stream does."""
    _, words, _, net = model
    ids = np.random.default_rng(5).integers(0, words.size, 2000 + 2 * lm_score.SPAN).astype(np.uint16)
    whole = net.log_probs(ids)
    for n in (*range(1, 40), 100, 333, 1999):
        for at in (0, 7, 2000 - n):
            at = min(at, 2000 - n)
            assert (net.log_probs(ids[at : at + n + 2 * lm_score.SPAN]) == whole[at : at + n]).all()
