"""Vector search, hard negatives and fill-in-middle against brute force, on the tables and on odd rows."""

import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pytest

from dawnpress.llm import ann, fim, hard_negatives, queries
from tests.llm.conftest import D, ODD

NAMED = {q.split("_")[0]: q for q in queries.QUERIES}


@pytest.mark.parametrize("name", ["op11_nearest_neighbours", "op12_fill_in_middle", "op13_hard_negatives"])
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"create view {t} as from '{D}/{t}.parquet'")
    want = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, D).select(*want.columns)
    flat = lambda rows: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)
    assert flat(map(tuple, got.collect())) == flat(want.fetchall())


# -- fill in middle --------------------------------------------------------------------------------


def brute_fim(doc_id, text):
    text = text or ""
    w = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(w) + 1), h[1] % (len(w) + 1)))
    p, m, s = "".join(w[:a]), "".join(w[a:b]), "".join(w[b:])
    if not text or any(x in text for x in fim.SENTINELS) or h[2] % 100 >= 90:
        return doc_id, len(w), "plain", None, None, text
    return (doc_id, len(w), *(("spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else ("psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")))


def test_fim_by_brute_force(spark, odd, empty):
    rng = random.Random(5)
    made = [(100 + k, "".join(rng.choice("abZ é漢💡\n<PSM>") for _ in range(rng.choice([1, 5, 1023, 1024, 1025, 5000])))) for k in range(120)]
    made += [(300, "a" * 5000), (301, "é" * 3000), (302, "x <P> y"), (303, "<" * 2000), (304, "ab\x00cd")]
    df = spark.createDataFrame(made, "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    rows = made + [(r[0], r[1]) for r in ODD]
    got = fim.fill_in_middle(df)
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    assert sorted(map(tuple, got.collect()), key=key) == sorted((brute_fim(*r) for r in rows), key=key)
    back = got.select("doc_id", fim.restore(got["output"], got["form"]).alias("text")).collect()
    assert sorted((str(r[0]), r[1]) for r in back) == sorted((str(i), t or "") for i, t in rows)
    assert {"plain", "psm", "spm"} == {r["form"] for r in got.select("form").distinct().collect()}
    assert fim.digests(empty).count() == 0


def test_only_owning_chunks_are_looked_at_again():
    """A cut's place follows from the counts and its own chunk: other chunks may hold anything by then."""
    text = ("word. " * 3000).encode()
    data, bounds = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    edges, first = fim.chunk_edges(bounds)
    tokens, points = fim.count_chunks(data, edges, len(text), bounds[:1])
    rank = np.array([7000])
    owner = np.searchsorted(np.append(0, np.cumsum(tokens)), rank[0], "right") - 1
    spoiled = np.full_like(data, 0)
    spoiled[edges[owner] - 1 : edges[owner] + fim.CHUNK] = data[edges[owner] - 1 : edges[owner] + fim.CHUNK]
    assert fim.locate(spoiled, edges, len(text), bounds[:1], tokens, points, rank)[0] == fim.locate(data, edges, len(text), bounds[:1], tokens, points, rank)[0]


def test_fim_sentinels_and_rates(spark, docs):
    made = fim.fill_in_middle(docs, seed=9, rate=100, spm_rate=100, sentinels=("[PRE]", "[SUF]", "[MID]"))
    assert {r["form"] for r in made.select("form").distinct().collect()} <= {"spm", "plain"}
    whole = docs.join(made.select("doc_id", fim.restore(made["output"], made["form"], ("[PRE]", "[SUF]", "[MID]")).alias("t")), "doc_id")
    assert whole.where("not (t <=> coalesce(text, ''))").count() == 0


# -- vectors ---------------------------------------------------------------------------------------


def vectors(n, d, seed, tight=0.0):
    rng = np.random.Generator(np.random.PCG64(seed))
    x = rng.standard_normal((n, d))
    x[: int(n * tight)] = rng.standard_normal(d) * 3 + 0.1 * x[: int(n * tight)]
    return x[rng.permutation(n)]


ODD_VECTORS = [
    (1000, None, 1), (1050, [0.0] * 4, 1), (1100, [1.0, None, 0.0, 0.0], 1), (1150, [float("nan"), 0.0, 0.0, 1.0], 2), (1200, [float("inf"), 0.0, 0.0, 1.0], 2),
    (1250, [1.0, 2.0], 3), (None, [0.5, 0.5, 0.1, 0.2], 1), (1300, [], 1), (1350, [0.1, 0.2, 0.3, 0.4], None), (50, [0.3, 0.1, -0.2, 0.4], 2), (50, [0.3, 0.1, -0.2, 0.4], 2),
    (1401, [0.3, 0.1, -0.2, 0.4], 2), (1402, [0.3, 0.1, -0.2, 0.4], 3), (1402, [0.3, 0.1, -0.2, 0.4], 3), (1403, [-0.3, -0.1, 0.2, -0.4], 2), (-100, [0.2, 0.2, -0.1, 0.3], 2),
]


@pytest.fixture(scope="module")
def odd_vectors(spark):
    rows = [(k, [float(v) for v in x], k % 3) for k, x in enumerate(vectors(200, 4, 2).round(1)) if k != 50] + ODD_VECTORS
    return rows, spark.createDataFrame([(*r, 1, "k", 0) for r in rows], "vec_id long, embedding array<double>, label int, bin int, kind string, key int")


def usable(rows, zero):
    return [(i, np.array(x), lab) for i, x, lab in rows if i is not None and x is not None and len(x) == 4 and all(v is not None and math.isfinite(v) for v in x) and (zero or any(x))]


def test_nearest_by_brute_force(odd_vectors):
    rows, df = odd_vectors
    fine, want = usable(rows, False), set()
    for i, q, _ in fine:
        if i % 50 == 0:
            near = sorted((-round(float(q @ x / (np.linalg.norm(q) * np.linalg.norm(x))), 9), j) for j, x, _ in fine if j != i)[:5]
            want |= {(i, k, j, -s) for k, (s, j) in enumerate(near, 1)}
    got = [(r[0], r[1], r[2], round(r[3], 9)) for r in ann.nearest(df).collect()]
    assert len(got) == len(set(got)) and {g[:1] + g[1:2] + g[3:] for g in got} == {w[:1] + w[1:2] + w[3:] for w in want}
    clear = {(w[0], w[3]) for w in want if [x[3] for x in want if x[0] == w[0]].count(w[3]) == 1}
    assert {g for g in got if (g[0], g[3]) in clear} == {w for w in want if (w[0], w[3]) in clear}


def test_nearest_short_tables(spark, odd_vectors):
    df = odd_vectors[1]
    assert ann.nearest(df.where("false")).count() == 0
    assert ann.nearest(df.where("vec_id = 50")).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r)[:3] for r in ann.nearest(few).orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 3), (0, 3, 2)]


def test_recall(spark):
    """At least 0.9 of the exact neighbours, among spread vectors and in a tight cluster of a third of them."""
    x = vectors(12_000, 48, 3, 1 / 3)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(7)
    got = {}
    for r in ann.nearest(df).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    hits, kinds = [], []
    for q in range(0, len(x), 50):
        s = u @ u[q]
        s[q] = -2
        near = np.argsort(-s)[:5]
        hits.append(len(got[q] & set(near.tolist())) / 5)
        kinds.append(s[near[0]] > 0.9)
    hits, kinds = np.array(hits), np.array(kinds)
    assert 0.2 < kinds.mean() < 0.5
    assert hits[kinds].mean() >= 0.9 and hits[~kinds].mean() >= 0.9


def test_anisotropic_codes_have_less_parallel_error():
    x = ann.unit(vectors(3000, 32, 4))
    index = ann.fit(x, len(x))
    at = ann._nearest(x, index.centroids)
    s, u = ann.rests(x, index, at)
    losses = []
    for eta in (1.0, 20.0):
        codes = ann.assign(u, x, index.books, np.full(len(x), eta, np.float32))
        e = u - index.books[np.arange(codes.shape[1]), codes].reshape(len(u), -1)
        losses.append(((e * x).sum(1) ** 2).mean())
    assert losses[1] < 0.3 * losses[0]


def test_table_scan_is_the_inner_product():
    x, q = ann.unit(vectors(500, 24, 5)), ann.unit(vectors(9, 24, 6))
    index = ann.fit(x, len(x))
    at, codes, size = ann.encode(x, index)
    table, worth = ann.tables(q, index.books)
    words = np.stack([codes & 15, codes >> 4], 2).reshape(len(x), -1)
    made = index.books[np.arange(words.shape[1]), words].reshape(len(x), -1)
    assert np.abs(ann.scan(codes, table) * worth - made @ q.T).max() < 1e-3


def test_hot_partitions_are_dealt():
    first, slices, n = ann.pack(np.array([3, 100, 0, 4, 4, 3]), 10)
    assert slices.tolist() == [1, 10, 1, 1, 1, 1] and n == 13
    assert first[1] == 1 and len({first[0], *range(1, 11), first[3]}) == 12


def brute_negatives(rows):
    fine = [(i, np.floor(256 * x), lab) for i, x, lab in usable(rows, True) if lab is not None]
    out, anchors = [], {(i, lab, tuple(y)) for i, y, lab in fine if i % 50 == 0}
    for i, lab, y in anchors:
        score = [(-int(np.array(y) @ z), j, m) for j, z, m in fine if j != i]
        for s, j, _ in sorted(t for t in score if t[2] == lab)[:5]:
            near = sorted(t for t in score if t[2] != lab and 50 * -s <= 100 * -t[0] <= 95 * -s)[:3]
            out += [(i, j, k, t[1], -s, -t[0]) for k, t in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("scale", [1, 2e6, 1e3])
def test_hard_negatives_by_brute_force(spark, odd_vectors, scale):
    """Also with components whose products are no longer exact in double precision, or do not fit 16 bits."""
    rows = [(i, None if x is None else [v if v is None else v * scale for v in x], lab) for i, x, lab in odd_vectors[0]]
    df = spark.createDataFrame([(*r, 1, "k", 0) for r in rows], odd_vectors[1].schema)
    assert sorted(map(tuple, hard_negatives.mine(df).collect())) == brute_negatives(rows)


def test_hard_negatives_in_many_cells(spark, monkeypatch):
    """Tight clusters, several groups and shares: the bounds prune, and nothing is lost."""
    rng = np.random.Generator(np.random.PCG64(8))
    centre = rng.standard_normal((12, 4)) * 4
    rows = [(k, (centre[k % 12] + 0.3 * rng.standard_normal(4)).tolist() if k != 150 else [0.0] * 4, int(rng.integers(0, 3))) for k in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want, sent = brute_negatives(rows), []
    monkeypatch.setattr(hard_negatives, "GROUP", 8)
    deal = hard_negatives._deal

    def counted(*args):
        out = deal(*args)
        sent.append((out.where("kind = 1").select("grp").count(), args[-1]))
        return out

    monkeypatch.setattr(hard_negatives, "_deal", counted)
    assert sorted(map(tuple, hard_negatives.mine(df).collect())) == want
    for n, groups in sent:
        assert groups > 4 and n < 0.8 * len(rows) * groups


def test_hard_negatives_short_tables(odd_vectors):
    df = odd_vectors[1]
    assert hard_negatives.mine(df.where("false")).count() == 0
    assert hard_negatives.mine(df.where("vec_id = 50")).count() == 0
    assert hard_negatives.mine(df.where("label is null")).count() == 0
