"""Titles that share only frequent tokens are linked like all others: queries over small tables against loops over every pair."""

import random
from collections import Counter
from datetime import date, datetime, timedelta
from itertools import combinations

import pytest

from dawnpress.functions import fixed_values as V
from dawnpress.operators import cluster
from dawnpress.queries import QUERIES

D = date(2024, 1, 2)


def made(seed, n=150):
    """Few words, and some titles many times; each edition has its own."""
    rng = random.Random(seed)
    words = [f"{a}{b}ot{c}" for a in "bdgk" for b in "aeiu" for c in "xyz"]
    stories = [rng.sample(words, 8) for _ in range(8)]
    out = {}
    for k in range(n):
        story = rng.choice(stories)
        out[k * 7 % n] = (D + timedelta(k % 2), list(dict.fromkeys(rng.choice([story[:5], story[:3], rng.sample(story, rng.randint(2, 8)) + rng.sample(words, rng.randint(0, 4))]))))
    return out


def brute(titles, threshold):
    """(a, b) -> (jaccard, overlap, rare)."""
    out = {}
    for day in {d for d, _ in titles.values()}:
        own = {i: set(w) for i, (d, w) in titles.items() if d == day}
        df = Counter(t for w in own.values() for t in w)
        rare = max(V.RARE_LEAST, int(len(own) * V.RARE_SHARE))
        for i, j in combinations(sorted(own), 2):
            s, n, r = len(own[i] & own[j]), min(len(own[i]), len(own[j])), sum(df[t] <= rare for t in own[i] & own[j])
            if n >= V.LEAST_TOKENS and (s / len(own[i] | own[j]) >= threshold or (r >= V.RARE_SHARED and s / n >= V.RARE_OVERLAP)):
                out[i, j] = (round(s / len(own[i] | own[j]), 9), round(s / n, 9), r)
    return out


def joined(ids, pairs):
    root = {i: i for i in ids}
    for a, b in sorted(pairs) * len(root):
        root[a] = root[b] = min(root[a], root[b])
        if all(root[a] == root[b] for a, b in pairs):
            break
    return root


@pytest.fixture
def tokens(spark, monkeypatch):
    """Small limits, so that tokens are hot and sets are dealt by parts and lists."""
    for where, name, value in ((V, "HOT_TOKEN", 9), (V, "RARE_LEAST", 6), (V, "RARE_SHARE", 0.08), (cluster, "PART", 7), (cluster, "LISTED", 3)):
        monkeypatch.setattr(where, name, value)
    return lambda titles: spark.createDataFrame([(d, i, w) for i, (d, w) in titles.items()], "grp date, article_id long, tokens array<string>")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """75 titles of the same four words beside one of their own, and 65 copies of another; each word is hot."""
    d = tmp_path_factory.mktemp("whole")
    titles = ["Laba bank naik saham", *(f"Laba bank naik saham unik{k}" for k in range(75)), *["OpenAI rilis chatbot nvidia"] * 65, "Gempa guncang kota"]
    docs = [(k, f"{t}\nisi berita", f"src{k % 7}", "id", len(t)) for k, t in enumerate(titles)]
    spark.createDataFrame(docs, "doc_id long, text string, source string, lang string, n int").coalesce(1).write.parquet(f"{d}/documents.parquet")
    at = datetime(2024, 1, 1, 12)
    spark.createDataFrame([(k, at + timedelta(minutes=k), "click") for k in range(len(titles))], "event_id long, ts timestamp_ntz, event_type string").coalesce(1).write.parquet(f"{d}/events.parquet")
    return str(d)


def test_similar_pairs(spark, tables):
    got = {(r["a"], r["b"]) for r in QUERIES["similar_pairs"](spark, tables).collect()}
    assert got == set(combinations(range(76), 2)) | set(combinations(range(76, 141), 2))


@pytest.mark.parametrize(("seed", "threshold"), [(1, 0.42), (2, 0.25), (3, 0.6)])
def test_all_pairs_by_brute_force(tokens, seed, threshold):
    titles = made(seed)
    rows = cluster.all_pairs(tokens(titles), threshold).collect()
    got = {(r["a"], r["b"]): (round(r["jaccard"], 9), round(r["overlap"], 9), r["rare"]) for r in rows}
    assert got == brute(titles, threshold) and len(rows) == len(got)
    assert cluster.similar_pairs(tokens(titles), threshold).count() < len(got)  # some share hot tokens alone


def test_components(spark, tables):
    got = {r["article_id"]: r["event_id"] for r in QUERIES["components"](spark, tables).collect()}
    assert got == {k: 0 if k < 76 else 76 if k < 141 else 141 for k in range(142)}


@pytest.mark.parametrize(("seed", "threshold"), [(4, 0.42), (5, 0.6)])
def test_clusters_by_brute_force(spark, tokens, seed, threshold):
    titles = {i: (d, w[:9] if i % 5 else []) for i, (d, w) in made(seed).items()}
    frame = tokens(titles)
    articles = frame.selectExpr("grp edition", "article_id", "array_join(tokens, ' ') title")
    same = {r["article_id"]: r["tokens"] for r in cluster.tokenise(articles).collect()}
    titles = {i: (d, same[i]) for i, (d, _) in titles.items()}
    got = {r["article_id"]: r["event_id"] for r in cluster.clusters(articles, threshold, whole=True).collect()}
    assert got == joined(titles, brute(titles, threshold)) and 5 < len(set(got.values())) < len(got) - 20
    capped = {r["article_id"]: r["event_id"] for r in cluster.clusters(articles, threshold).collect()}
    assert got != capped


def test_edition_sections(spark, tables):
    """Articles that share only frequent words are one event: the section has one row for each story, with all its media."""
    got = {(r["event_id"], r["n_media"]) for r in QUERIES["edition_sections"](spark, tables).collect()}
    assert got and got <= {(0, 7), (76, 7), (141, 1)}


def test_edition_compose(spark, tmp_path):
    """AI events that share only frequent words are merged: 70 with three words in common, which are too unlike for one event before."""
    made = [f"OpenAI nvidia chatbot {' '.join(f'kata{k}x{i}' for i in range(5))}" for k in range(70)]
    docs = [(k, f"{t}\nisi berita", f"src{k}", "id") for k, t in enumerate(made)]
    spark.createDataFrame(docs, "doc_id long, text string, source string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    at = datetime(2024, 1, 1, 12)
    spark.createDataFrame([(k, at + timedelta(minutes=k), "view") for k in range(70)], "event_id long, ts timestamp_ntz, event_type string").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    # 3 of 13 words are under the limit of 0.25, 3 of 9 of shorter ones are not
    assert len(QUERIES["edition_compose"](spark, str(tmp_path)).collect()) > 1
    short = [(k, f"OpenAI nvidia chatbot kata{k}x kata{k}y kata{k}z\nisi", f"src{k}", "id") for k in range(70)]
    spark.createDataFrame(short, "doc_id long, text string, source string, lang string").coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["edition_compose"](spark, str(tmp_path)).collect()
    assert [r["n_media"] for r in got] == [70]


def test_edition_pages(spark, tables):
    """The page tells each story once."""
    html = [r["html"] for r in QUERIES["edition_pages"](spark, tables).collect()]
    assert len(html) == 1 and sum(html[0].count(f"unik{k}<") for k in range(75)) <= 1
