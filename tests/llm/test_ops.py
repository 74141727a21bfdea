"""The ten operators against brute force, on rows with every odd case."""

import collections
import hashlib
import time
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from dawnpress.llm import bwt_dedup, decontam, line_dedup, mixing, ngram_join, quality, queries, token_store, toxicity

from tests.llm.conftest import BASE, D, LONG, ODD


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def brute_classes(rows):
    sets, inverted, root = [], collections.defaultdict(list), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (_, t) in enumerate(rows):
        w = (t or "").encode().lower().split()
        s = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.append(s)
        hits = collections.Counter(b for g in s for b in inverted[g])
        for b, n in hits.items():
            if 100 * n >= 75 * (len(s) + len(sets[b]) - n):
                root[find(a)] = find(b)
        for g in s:
            inverted[g].append(a)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return collections.Counter((i, len(sets[a]), least.get(find(a)) if sets[a] else i) for a, (i, _) in enumerate(rows))


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_ngram_join(which, request):
    df = request.getfixturevalue(which)
    got = collections.Counter(tuple(r) for r in ngram_join.jaccard_classes(df).select("doc_id", "n_shingles", "component_id").collect())
    assert got == brute_classes(pairs(df))


def test_ngram_join_splits_islands(docs):
    whole = {tuple(r) for r in ngram_join.jaccard_classes(docs).collect()}
    assert {tuple(r) for r in ngram_join.jaccard_classes(docs, island_cap=1).collect()} == whole


def test_ngram_join_empty_and_kept(empty, odd):
    assert ngram_join.jaccard_classes(empty).count() == 0
    kept = ngram_join.keep_one_per_class(odd)
    assert kept.columns == odd.columns
    first = {(i, c) for i, n, c in brute_classes(pairs(odd)) if i is not None and i == c}
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == sorted(i for i, _ in first)


def test_ngram_join_of_hot_keys_and_rows_without_id(spark, docs, monkeypatch):
    from dawnpress.plans import skew

    whole = {tuple(r) for r in ngram_join.jaccard_classes(docs).collect()}
    monkeypatch.setattr(skew, "LEAST_ROWS", 1)
    monkeypatch.setattr(skew, "HOT_KEYS", 1 << 20)
    assert {tuple(r) for r in ngram_join.jaccard_classes(docs, island_shingles=50).collect()} == whole
    rows = [(None, BASE), (7, BASE.replace("word5x5", "zzz")), (9, BASE.replace("word90x90", "yyy")), (None, "a class of rows without any id at all here"), (None, "")]
    got = {tuple(r) for r in ngram_join.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(None, 116, 7), (7, 116, 7), (9, 116, 7), (None, 6, None), (None, 0, None)}


def test_tree_bound_loses_nothing():
    r = np.random.default_rng(3)
    base = [np.unique(r.integers(0, 1 << 60, 80, dtype=np.uint64)) for _ in range(30)]
    sets = []
    for b in base:
        for k in (0, 5, 12, 30):
            s = b.copy()
            s[:k] = r.integers(0, 1 << 60, k, dtype=np.uint64)
            sets.append(np.unique(s))
    links = {frozenset(x) for x in map(tuple, np.concatenate(list(ngram_join.CountTree(np.stack([np.bincount((s & np.uint64(15)).astype(int), minlength=16) for s in sets]), np.array([len(s) for s in sets])).candidates(3, 4))).tolist())}
    for i in range(len(sets)):
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if 4 * n >= 3 * (len(sets[i]) + len(sets[j]) - n):
                assert frozenset((i, j)) in links


def brute_repeats(rows, length=100):
    seen, out = {}, []
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (t or "").encode()
        cover = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if b[p : p + length] in seen:
                cover[p : p + length] = b"\1" * length
            seen.setdefault(b[p : p + length], 1)
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        out.append((i, len(b), sum(cover), sum(1 for j in range(len(cover)) if cover[j] and (not j or not cover[j - 1])), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_suffix_dedup(which, request):
    df = request.getfixturevalue(which)
    got = {tuple(r) for r in bwt_dedup.remove_repeats(df).collect()}
    assert got == set(brute_repeats(pairs(df)))


def test_suffix_dedup_empty_and_hot(empty, docs, monkeypatch):
    assert bwt_dedup.remove_repeats(empty).count() == 0
    want = {tuple(r) for r in bwt_dedup.remove_repeats(docs).collect()}
    monkeypatch.setattr(bwt_dedup, "HOT", 1)
    monkeypatch.setattr(bwt_dedup, "SHARD", 3)
    monkeypatch.setattr(bwt_dedup, "PART", 200)  # texts are scanned in many parts
    monkeypatch.setattr(bwt_dedup, "MOST_PARTS", 3)  # and a task takes several buckets
    assert {tuple(r) for r in bwt_dedup.remove_repeats(docs).collect()} == want


def test_merged_transforms():
    """Against sorted suffixes: the order's common prefixes, over texts with many repeats."""
    r = np.random.default_rng(2)
    words = [bytes(r.integers(97, 99, 12).astype(np.uint8)) for _ in range(3)]
    texts = [b"".join(words[k] for k in r.integers(0, 3, n)) for n in (4, 9, 1, 6, 6, 2, 7)]
    data, size = np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts])
    width, most = 2, 5
    start = np.cumsum(size) - size
    symbols = bwt_dedup._symbols(data, width)
    shards = [bwt_dedup.ShardTransform(symbols, start[a : a + 3], size[a : a + 3], width) for a in (0, 3, 6)]
    interleave, common = bwt_dedup.merge_transforms(shards, most)
    order = np.argsort(interleave, kind="stable")
    text, place = np.empty(len(common), int), np.empty(len(common), int)
    text[order] = np.concatenate([s.string + a for s, a in zip(shards, (0, 3, 6), strict=True)])
    place[order] = np.concatenate([s.place for s in shards])
    suffix = [[texts[t][p + k : p + k + width] for k in range(0, len(texts[t]) - p - width + 1, width)][:most] for t, p in zip(text, place, strict=True)]
    for k in range(1, len(suffix)):
        a, b = suffix[k - 1], suffix[k]
        same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert common[k] == same or (not a and not b and common[k] == 0)
    whole = [(tuple(x)) for x in suffix if len(x) == most]
    assert len({w for w in whole}) == sum(common[k] < most for k in range(len(suffix)) if len(suffix[k]) == most)


def test_covered_windows_of_equal_segments():
    r = np.random.default_rng(4)
    base = bytes(r.integers(97, 123, 400).astype(np.uint8))
    texts = {1: base[:150], 2: base[20:180], 3: base[:150], 9: base[:150], 11: base[300:400]}
    rows = np.zeros(5, bwt_dedup.SEGMENT)
    for k, (doc, t) in enumerate(texts.items()):
        rows[k]["doc"], rows[k]["n"], rows[k]["anchor"], rows[k]["same"] = doc, len(t) - 99, 7, zlib.crc32(t)
    data = np.frombuffer(b"".join(texts[d] for d in rows["doc"].tolist()), np.uint8)
    got = {tuple(x) for x in bwt_dedup.covered_windows(rows, data, 100, shard=1).tolist()}
    assert got == {(3, 0, 0, 51), (9, 0, 0, 51), (2, 0, 0, 31)}  # doc, version, from, windows


@pytest.mark.parametrize("which", ["odd", "docs", "empty"])
def test_token_store(spark, which, request, tmp_path):
    from tokenizers import Tokenizer

    df = request.getfixturevalue(which)
    tok = Tokenizer.from_file(queries.tokenizer_path())
    got = [tuple(r) for r in token_store.token_index(df, queries.tokenizer_path(), path=str(tmp_path)).collect()]
    want, start = [], 0
    store = sorted(((r["start"], r["doc_id"], r["ids"]) for r in token_store.read_documents(spark, str(tmp_path), 2).collect()))
    assert collections.Counter(map(lambda r: (r[0], r[2]), got)) == collections.Counter((i, len(tok.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in pairs(df))
    for at, i, ids in store:
        assert at == start
        start += len(ids)
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(got, key=lambda r: r[1]) == want
    texts = collections.Counter((i, tuple(tok.encode(t or "", add_special_tokens=False).ids) + (1,)) for i, t in pairs(df))
    assert texts == collections.Counter((i, tuple(ids)) for _, i, ids in store)


def test_token_store_hot_chunks(spark, tmp_path, docs, monkeypatch):
    from dawnpress.plans import skew

    want = {tuple(r) for r in token_store.token_index(docs, queries.tokenizer_path(), path=str(tmp_path / "a")).collect()}
    monkeypatch.setattr(skew, "LEAST_ROWS", 1)
    monkeypatch.setattr(skew, "HOT_KEYS", 1 << 20)
    assert {tuple(r) for r in token_store.token_index(docs, queries.tokenizer_path(), path=str(tmp_path / "b")).collect()} == want


def test_word_cache_on_marks():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from dawnpress.llm.textscan import word_chunks

    texts = ["don't stop, it's Ünï. été. »quoted«. x!! 3,5 a.b. <|endoftext|>. ﬁn. ×. '. ,'s J̌. é.", "", "…. a?b? ..a."]
    tok, enc = Tokenizer.from_file(queries.tokenizer_path()), token_store.WordEncoder(queries.tokenizer_path())
    for a, b, w in word_chunks(pa.array(texts), fold=None, marks=True):
        ids, bounds = enc.encode(w)
        for k in range(a, b):
            assert ids[bounds[k - a] : bounds[k - a + 1]].tolist() == tok.encode(texts[k], add_special_tokens=False).ids


def test_quality(spark, docs, odd, empty, tmp_path):
    for name, df in (("a", docs), ("b", odd), ("c", empty)):
        df.select("doc_id", "text").write.parquet(str(tmp_path / name))
        want = duckdb.sql(f"with documents as (from '{tmp_path / name}/*.parquet') " + quality.ORACLE.strip().replace("with d as", ", d as", 1))
        key = sorted(want.columns)
        got = quality.score_quality(df).select(key).collect()
        assert collections.Counter(map(tuple, got)) == collections.Counter(want.select(*(f'"{k}"' for k in key)).fetchall())
        assert quality.keep_good(df).count() == sum(r["kept"] for r in got) and quality.keep_good(df).columns == df.columns


def test_mixing(odd, docs, empty):
    assert mixing.mix(empty).count() == 0 and mixing.take_mix(empty).count() == 0
    for df in (odd, docs):
        rows = mixing.mix(df, leaf=8, fan=3).collect()
        assert len(rows) == df.count() and all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
        again = mixing.mix(df.repartition(3), leaf=8, fan=3).collect()
        assert collections.Counter(rows) == collections.Counter(again)
        by = collections.defaultdict(list)
        for r in rows:
            by[r["source"]].append(r)
        for rs in by.values():
            assert abs(sum(r["taken"] for r in rs) - rs[0]["target"]) <= max(r["size"] for r in rs)
        total = sum(r["size"] for r in rows)
        assert abs(sum(rs[0]["target"] for rs in by.values()) - min(total, 3 * total)) < 1e-6 * total
        assert mixing.take_mix(df).columns == df.columns
    assert mixing.share_out([10, 100], [5, 1], 1.0, 3) == [30.0, 80.0]


def test_mixing_of_many_sources(docs, monkeypatch):
    want = collections.Counter(map(tuple, mixing.mix(docs, leaf=8, fan=3).collect()))
    monkeypatch.setattr(mixing, "FEW", 3)
    assert collections.Counter(map(tuple, mixing.mix(docs, leaf=8, fan=3).collect())) == want


def test_mixing_keeps_expectations():
    """Each document is taken as often as it is due, on average over the luck, and the words stay."""
    r = np.random.default_rng(5)
    size, x = [3, 10, 7, 1, 25, 4], [0.2, 0.5, 0.9, 0.33, 0.6, 0.75]
    due, n = sum(a * b for a, b in zip(size, x, strict=True)), 20_000
    total = np.zeros(len(x))
    for _ in range(n):
        copies, held, f = mixing._settle(size, x, r.random(len(x)).tolist())
        got = np.array(copies, float)
        if held is not None:
            got[held] = f
        assert abs(got @ np.array(size) - due) < 1e-6
        total += got
    assert np.abs(total / n - x).max() < 0.02


def test_tiles_and_leaks(spark, odd, empty):
    assert sorted(decontam.tile(np.array([1, 2, 3, 4, 5, 6, 7, 8], np.uint64), np.array([5, 6, 7, 8, 99, 1, 2, 3, 4], np.uint64), 4)) == [(0, 5, 4), (4, 0, 4)]
    bench = spark.createDataFrame([(1, " ".join(BASE.split()[20:60])), (2, " ".join(BASE.split()[40:60] + BASE.split()[20:40])), (3, None), (4, ""), (5, "one two"), (6, "nowhere to be found in any text at all"), (None, BASE)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(odd, bench).collect()}
    assert got == {(d, i) for d in (6, 7, 8, 13) for i in (1, 2)} | {(d, 5) for d in (4, 5, None)}
    assert {(r["doc_id"], r["item_id"]) for r in decontam.leaks(odd, bench, block=2).collect()} == got
    assert decontam.leaks(empty, bench).count() == 0 and decontam.leaks(odd, bench.where("false")).count() == 0
    assert sorted(r["doc_id"] for r in decontam.drop_leaks(odd, bench).where("doc_id is not null").collect()) == [1, 2, 3, 9, 10, 11, 12, 14]


def brute_tiles(item, text, least):
    """The definition: mark the longest runs that are not marked yet, until none of ``least`` is left."""
    free_i, free_t, tiles = [True] * len(item), [True] * len(text), []
    while True:
        runs = collections.defaultdict(list)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and free_i[i + n] and free_t[j + n]:
                    n += 1
                runs[n].append((i, j))
        n = max(runs, default=0)
        if n < least:
            return tiles
        for i, j in runs[n]:
            if all(free_i[i : i + n]) and all(free_t[j : j + n]):
                free_i[i : i + n] = free_t[j : j + n] = [False] * n
                tiles.append((i, j, n))


def test_tiles_by_definition():
    r = np.random.default_rng(8)
    for _ in range(150):
        letters, least = int(r.integers(2, 7)), int(r.integers(1, 5))
        item, text = (r.integers(1, letters + 1, int(r.integers(1, 26))).astype(np.uint64) for _ in range(2))
        if r.random() < 0.5:  # a passage in two parts, the other way round
            k = len(item) // 2
            text = np.concatenate([text[:5], item[k:], text[5:], item[:k]])
        assert sorted(decontam.tile(item, text, least)) == sorted(brute_tiles(item.tolist(), text.tolist(), least))


def test_drop_leaks_of_items_without_id(spark):
    docs = spark.createDataFrame([(1, BASE), (2, "nothing of the benchmark is in this text")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, BASE), (None, None)], "item_id long, text string")
    assert [r["doc_id"] for r in decontam.drop_leaks(docs, bench).collect()] == [2]
    assert [r["doc_id"] for r in decontam.drop_leaks(docs, bench, block=1).collect()] == [2]


def test_drop_leaks_judges_rows(spark):
    """Rows without an id, and rows of one id, each by their own text; other columns stay as they are."""
    rows = [(None, BASE, 1), (None, "a clean row without an id", 2), (3, BASE, 3), (3, "the same id and a clean text", 4), (4, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(1, BASE)], "item_id long, text string")
    got = decontam.drop_leaks(docs, bench)
    assert got.schema == docs.schema and sorted(r["item_id"] for r in got.collect()) == [2, 4, 5]


@pytest.mark.parametrize("item, text", [([1] * 100 + [2], [1] * 20_000), ([1, 2, 3], [1, 2, 3, 1, 2, 3, 2]), (list(range(1, 51)), list(range(1, 51)))])
def test_tiles_of_repeated_words(item, text):
    """Texts that repeat their words cost no more than others, and tiles are right by their own definition."""
    item, text = np.array(item * (1000 // len(item)), np.uint64), np.array(text * (20_000 // len(text)), np.uint64)
    began = time.process_time()
    tiles = decontam.tile(item, text, 5)
    assert time.process_time() - began < 2
    assert [t[2] for t in tiles] == sorted((t[2] for t in tiles), reverse=True)
    assert all(np.array_equal(item[i : i + n], text[j : j + n]) for i, j, n in tiles)
    for k, m in ((0, len(item)), (1, len(text))):
        spans = sorted((t[k], t[k] + t[2]) for t in tiles)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] <= m


def test_tiles_of_three_letters():
    r = np.random.default_rng(3)
    for _ in range(20):
        item, text = (r.integers(1, 4, n).astype(np.uint64) for n in (60, 150))
        assert sorted(decontam.tile(item, text, 4)) == sorted(brute_tiles(item.tolist(), text.tolist(), 4))


def test_blocks_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 2000)
    bench = spark.createDataFrame([(k, f"{BASE} item {k}") for k in range(20)], "item_id long, text string")
    assert len([x for x in decontam._blocks(bench, 100) if x[0]]) > 5
    docs = spark.createDataFrame([(1, f"{BASE} item 7")], "doc_id long, text string")
    assert decontam.leaks(docs, bench).count() == 20


def test_line_dedup(spark, docs, odd, empty, tmp_path):
    for name, df in (("a", docs), ("b", odd.where("doc_id is not null and doc_id not in (10, 11)")), ("c", empty)):
        df.select("doc_id", "text").write.parquet(str(tmp_path / name))
        want = duckdb.sql(line_dedup.ORACLE.replace("from documents", f"from '{tmp_path / name}/*.parquet'")).df()
        got = line_dedup.near_lines(df).toPandas()
        assert set(map(tuple, got[list(want.columns)].values.tolist())) == set(map(tuple, want.values.tolist()))
        assert line_dedup.drop_near_lines(df).columns == df.columns


def test_line_dedup_earliest_true_copy(spark):
    a, d, b = "a1 a2 a3 x a4 a5 a6 a7 a8", "a1 a2 a3 a4 z a5 a6 a7 a8", "a1 a2 a3 a4 y a5 a6 a7 a8"
    base = "a1 a2 a3 a4 a5 a6 a7 a8"
    for lines, want in (([a, d, b], {(3, 2)}), ([a, base, b], {(2, 1), (3, 2)}), ([base, a, b], {(2, 1), (3, 1)})):
        rows = spark.createDataFrame([(i + 1, t) for i, t in enumerate(lines)], "doc_id long, text string")
        assert {(r["doc_id"], r["first_doc_id"]) for r in line_dedup.near_lines(rows).collect()} == want


@pytest.mark.parametrize("n", [8, 9, 12, 16, 40, 100])
def test_line_dedup_insertions(spark, n, monkeypatch):
    """A line with one word more, the line, and the line with another word more, at every place."""
    from dawnpress.plans import skew

    monkeypatch.setattr(skew, "LEAST_ROWS", 1)  # every line is hot
    rows, base = [], lambda k: [f"s{k}w{i}" for i in range(n)]
    for k in range(n + 1):
        w = base(k)
        rows += [(3 * k + i, " ".join(w[:k] + more + w[k:])) for i, more in enumerate((["foo"], [], ["bar"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["first_doc_id"]) for r in line_dedup.near_lines(df).collect()}
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    want = {(r[0], r[2]) for r in con.sql(line_dedup.ORACLE).fetchall()}
    assert got == want and len(got) == 2 * (n + 1)


def test_line_dedup_long_lines(spark):
    """SQL writes out every variant of a line, which 20,000 words do not allow: the answer is known here."""
    w = LONG.split()[:20_000]
    edits = [w, [*w[:9_999], "other", *w[10_000:]], [*w[:5], *w[6:]], [*w[:-1], "x", w[-1]], [*w[:10], "one", *w[11:500], "two", *w[501:]], w[1:-1]]
    rows = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(edits)], "doc_id long, text string")
    assert {(r["doc_id"], r["first_doc_id"]) for r in line_dedup.near_lines(rows).collect()} == {(1, 0), (2, 0), (3, 0)}


def test_line_dedup_near_copy_of_a_row_without_id(spark):
    t = "b1 b2 b3 b4 b5 b6 b7 b8 b9"
    rows = spark.createDataFrame([(None, t), (5, t), (7, t.replace("b4", "zz")), (8, "another line that has no copy at all here")], "doc_id long, text string")
    got = {(r["doc_id"], r["first_doc_id"]) for r in line_dedup.near_lines(rows).collect()}
    assert got == {(5, None), (7, None)}
    kept = {r["doc_id"]: r["text"] for r in line_dedup.drop_near_lines(rows).collect()}
    assert kept[None] == t and kept[5] == kept[7] == "" and kept[8] != ""


def auc(score, label):
    """Share of pairs of a toxic and another row that are in the right order."""
    order = np.argsort(score, kind="stable")
    s, y = np.array(score)[order], np.array(label)[order] > 0
    _, first, n = np.unique(s, return_index=True, return_counts=True)
    rank = np.repeat(first + (n - 1) / 2, n)
    return (rank[y].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (~y).sum())


def test_toxicity(spark, odd, empty):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert auc([0.1, 0.4, 0.4, 0.9], [0, 0, 1, 1]) == 0.875
    got = toxicity.score_toxicity(big, labels).join(labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id").where("held_out").collect()
    assert auc([r["score"] for r in got], [r["toxic"] for r in got]) > 0.8
    found, toxic, right = (sum(x) for x in zip(*((r["predicted"], r["toxic"], r["predicted"] * r["toxic"]) for r in got), strict=True))
    assert right / toxic > 0.6 and right / found > 0.8
    none = toxicity.score_toxicity(odd, labels.where("false")).collect()
    assert len(none) == len(ODD) and all(r["score"] < 0.01 and r["predicted"] == 0 for r in none)
    assert toxicity.score_toxicity(empty, labels).count() == 0


def test_toxicity_by_loops(spark, docs, monkeypatch):
    """Features, ratios and scores from the definition, n-gram by n-gram."""
    monkeypatch.setattr(toxicity, "LEAST_CHI2", 8.0)
    labels = spark.read.parquet(f"{D}/labels.parquet")
    model = toxicity.fit(docs, labels)
    trained = {r["doc_id"]: r["toxic"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1}
    texts = [(r["text"], trained[r["doc_id"]]) for r in docs.collect() if r["doc_id"] in trained]

    def grams(text):
        t = " " + " ".join((text or "").lower().split()) if text else ""
        return {t[k : k + n] for n in range(toxicity.SHORTEST, toxicity.LONGEST + 1) for k in range(len(t) - n + 1)}

    of = [(grams(t), y > 0) for t, y in texts]
    pos, neg = (collections.Counter(g for s, y in of if y == want for g in s) for want in (True, False))
    n_pos = sum(y for _, y in of)
    n_neg, n = len(of) - n_pos, len(of)
    chi2 = {g: n * (pos[g] * n_neg - neg[g] * n_pos) ** 2 / ((pos[g] + neg[g]) * (n - pos[g] - neg[g]) * n_pos * n_neg) for g in pos | neg if pos[g] + neg[g] < n}
    code = lambda g: int(list(toxicity.ngrams(g[1:]))[-1][0])  # of one that begins with a blank
    chosen = {g for g, c in chi2.items() if c >= 8}
    assert 0 < len(model.hashes) <= len(chosen)
    known = set(model.hashes.tolist())
    assert all(code(g) in known for g in sorted(chosen, key=chi2.get)[-20:] if g[0] == " ")
    for text, _ in texts[::10]:
        have = {h for x in toxicity.ngrams(text) for h in x.tolist()} & known
        z = model.intercept + sum(w for h, w in zip(model.hashes.tolist(), model.weights, strict=True) if h in have)
        assert abs(model.score(text) - 1 / (1 + np.exp(-z))) < 1e-9


def test_toxicity_ratios_by_definition(spark, docs, monkeypatch):
    """What the classifier is fitted on: presences scaled by log-count ratios, counted here n-gram by n-gram."""
    monkeypatch.setattr(toxicity, "LEAST_CHI2", 8.0)
    seen, fit = {}, toxicity._logistic

    def watched(row, col, value, y, width, **how):
        seen.update(zip(col.tolist(), value.tolist()), n=len(value), held=len(col))
        return fit(row, col, value, y, width, **how)

    monkeypatch.setattr(toxicity, "_logistic", watched)
    labels = spark.read.parquet(f"{D}/labels.parquet")
    model = toxicity.fit(docs, labels)
    trained = {r["doc_id"]: r["toxic"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1}
    sides = {True: [], False: []}
    for r in docs.collect():
        if r["doc_id"] in trained:
            t = " " + " ".join((r["text"] or "").lower().split()) if r["text"] else ""
            sides[trained[r["doc_id"]] > 0].append({t[k : k + n] for n in range(toxicity.SHORTEST, toxicity.LONGEST + 1) for k in range(len(t) - n + 1) if t[k] == " "})
    counts = {y: collections.Counter(g for s in sets for g in s) for y, sets in sides.items()}
    at, checked = {h: k for k, h in enumerate(model.hashes.tolist())}, 0
    for g in counts[True] | counts[False]:
        k = at.get(int(list(toxicity.ngrams(g[1:]))[-1][0])) if len(g) >= toxicity.SHORTEST and g == " " + " ".join(g.split()) else None
        if k is not None:
            share = lambda y: (counts[y][g] + 1) / (len(sides[y]) + 2)
            assert seen[k] == pytest.approx(np.log(share(True) / share(False)))
            checked += 1
    assert checked > 20


def test_toxicity_long_texts():
    model = toxicity.Model(np.sort(np.concatenate(list(toxicity.ngrams("moron")))), np.ones(15), 0.0, np.ones(1 << toxicity.BITS, bool))
    assert len(model.present("x" * 10 + " moron " + "y" * 10)) >= 10 and len(model.present(None)) == 0
    assert len(model.present("y " * (toxicity.PART // 2 - 2) + "moron")) >= 10  # over the seam of two parts


def test_ngram_join_tells_chance_from_copies(spark):
    """Long texts that share one passage of five words are no neighbours; near copies among them are."""
    words = lambda k: [f"w{k}x{i}" for i in range(100)]
    texts = [words(k)[:50] + words(k + 1)[:5] + words(k)[50:] for k in range(40)]
    texts.append(texts[7][:90] + ["other"] + texts[7][91:])
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5, "doc_id")
    found = ngram_join._prefixes(docs, 5, 3, 4, np.zeros(1 << ngram_join.SKETCH_BITS, np.uint8)).cache()
    name = {r["node"]: r["doc_id"] for r in found.where("kind = 0").collect()}
    near = {frozenset((name[r["u"]], name[r["v"]])) for r in ngram_join._chain(found.where("kind = 1")).collect()}
    assert near == {frozenset((7, 40))}
    classes = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_classes(docs).collect()}
    assert classes == {i: 7 if i == 40 else i for i in range(41)}


def test_components_run_once_what_finds_the_edges(spark):
    from dawnpress.plans.components import connected_components

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 5), (3, 1)], "u long, v long").mapInArrow(count, "u long, v long")
    assert sorted(map(tuple, connected_components(edges).collect())) == [(1, 1), (2, 1), (3, 1), (5, 5)]
    assert seen.value == 4
