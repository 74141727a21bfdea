"""Quality checks, vintages, themes, observed metrics, windows of streams and pages against small examples worked out by hand or by loops."""

import random
import time
from datetime import date, datetime, timedelta
from itertools import combinations
from pathlib import Path
from statistics import median

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from dawnpress.operators import cluster, edition, events, lsh, quality, report
from dawnpress.queries import articles
from dawnpress.sources import feeds
from dawnpress.streaming import stream

D = date(2024, 1, 1)


def day(n):
    return D + timedelta(days=n)


# -- values known on dates -------------------------------------------------------------------------


def test_known_at_by_loops(spark):
    rng, rows = random.Random(4), []
    for k in range(300):
        a = rng.choice([None, rng.randint(-50, 150)])
        b = rng.choice([None, (a or 0) + rng.randint(-3, 90)])
        rows.append((k % 11, k, None if a is None else day(a), None if b is None else day(b)))
    asked = [None, *map(day, [0, 0, 1, 31, 32, 33, 64, 99, 100])]
    series = spark.createDataFrame(rows, "key int, id int, release_date date, valid_until date")
    got = quality.known_at(series, spark.createDataFrame([(d,) for d in asked], "day date"), salts=3)
    want = sorted((d, r[1]) for d in {d for d in asked if d} for r in rows if r[2] and r[2] <= d and (r[3] is None or r[3] > d))
    assert sorted((r["day"], r["id"]) for r in got.collect()) == want and got.columns == ["day", *series.columns]
    one = quality.known_on(series, str(day(33)))
    assert sorted(r["id"] for r in one.collect()) == [i for d, i in want if d == day(33)]
    assert quality.known_at(series, spark.createDataFrame([(None,)], "day date")).count() == 0
    assert quality.known_at(series.where("false"), spark.createDataFrame([(D,)], "day date")).count() == 0


def test_reconcile(spark):
    rows = [("x", "bps", 2.0), ("x", "wb", 2.1), ("x", "imf", 3.0), ("y", "bps", 5.0), ("z", "bps", 0.0), ("z", "wb", 1.0), ("z", "imf", 0.0), ("x", "bps", 2.0), ("w", "bps", None)]
    got = {r["k"]: r for r in quality.reconcile(spark.createDataFrame(rows, "k string, source string, value double"), ["k"]).collect()}
    assert set(got) == {"x", "y", "z"}
    assert (got["x"]["middle"], got["x"]["n_sources"], got["x"]["off"]) == (2.1, 3, ["imf"]) and got["x"]["worst"] == pytest.approx(0.9 / 2.1)
    assert (got["y"]["worst"], got["y"]["off"]) == (0.0, []) and (got["z"]["middle"], got["z"]["worst"], got["z"]["off"]) == (0.0, float("inf"), ["wb"])


def test_theme_index_by_loops(spark):
    rng = random.Random(9)
    rows = [(day(rng.randint(0, 20)), rng.choice("ab"), rng.choice(["s1", "s2", "s3", None]), rng.choice([None, -2, 0, 1, 3])) for _ in range(250)]
    rows += [(day(15), "a", f"t{k}", 1) for k in range(60)] + [(None, "a", "s1", 1), (day(1), None, "s1", 1)]
    got = {(r["day"], r["theme"]): r for r in quality.theme_index(spark.createDataFrame(rows, "day date, theme string, domain string, score int"), days=5).collect()}
    for theme in "ab":
        before = []
        for d in sorted({r[0] for r in rows if r[1] == theme and r[0]}):
            own = [r for r in rows if r[:2] == (d, theme)]
            by = {}
            for r in own:
                by[r[2]] = by.get(r[2], 0) + (r[3] or 0)
            sides = [sum(v > 0 for v in by.values()), sum(v < 0 for v in by.values()), sum(v == 0 for v in by.values())]
            last = before[-5:]
            usual = median(last) if last else None
            spread = median(abs(x - usual) for x in last) if last else None
            x = got[d, theme]
            assert (x["n_articles"], x["n_sources"], x["usual"], x["spread"]) == (len(own), len(by), usual, spread)
            assert x["agreement"] == pytest.approx(max(sides) / len(by)) and x["tone"] == pytest.approx(sum(r[3] or 0 for r in own) / len(own))
            assert x["spike"] == bool(last and len(own) - usual > 3 * 1.4826 * spread and len(own) - usual >= 1)
            before.append(len(own))
    assert got[day(15), "a"]["spike"] and len(got) == sum(len({r[0] for r in rows if r[1] == t and r[0]}) for t in "ab")


# -- checks of stored tables -----------------------------------------------------------------------


def test_gaps_and_breaks(spark):
    rows = [("a", day(n), v) for n, v in ((0, 100.0), (1, 104.0), (2, 110.0), (5, 110.0), (6, 0.0), (7, 9.0))] + [("b", day(0), 1.0), ("b", day(0), 1.0), ("b", day(1), None)]
    df = spark.createDataFrame(rows, "k string, day date, v double")
    assert [(r["k"], r["day"], r["next_day"], r["n_missing"]) for r in quality.date_gaps(df, "day", ["k"]).collect()] == [("a", day(2), day(5), 2)]
    breaks = quality.range_breaks(df, "v", ["k"], "day").collect()
    assert sorted((r["day"], r["before"]) for r in breaks) == [(day(2), 104.0), (day(6), 110.0)]  # 4 % is none; a value of 0 has no range


def test_require_and_silent_failures(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    quality.require(df, 1, ["a", "b"])
    with pytest.raises(ValueError, match="fewer than 2"):
        quality.require(df, 2, ["a"])
    with pytest.raises(ValueError, match="missing columns"):
        quality.require(df, 1, ["a", "c"])
    rows = [("f", "galat", "200 tapi 0 item"), ("f", "galat", "200 tapi 0 item"), ("f", "ok", None), ("g", "galat", "HTTP 500"), ("h", "ok", "0 item"), ("i", "galat", None)]
    assert [tuple(r) for r in quality.silent_failures(spark.createDataFrame(rows, "feed string, status string, note string")).collect()] == [("f", 2)]


def test_cluster_order_and_section_counts(spark):
    rows = [(D, 5, 1, datetime(2024, 1, 1)), (D, 2, 3, datetime(2024, 1, 1)), (D, 9, 3, datetime(2024, 1, 2)), (D, 1, 3, datetime(2024, 1, 1)), (day(1), 7, 1, None)]
    got = events.cluster_order(spark.createDataFrame(rows, "edition date, event_id int, n_articles int, published_at timestamp_ntz"))
    assert sorted((r["edition"], r["position"], r["event_id"]) for r in got.collect()) == [(D, 1, 9), (D, 2, 1), (D, 3, 2), (D, 4, 5), (day(1), 1, 7)]
    shown = spark.createDataFrame([(D, "utama"), (D, "utama"), (D, "ai"), (day(1), "ai")], "edition date, section string")
    assert sorted(map(tuple, edition.section_counts(shown).collect())) == [(D, "ai", 1), (D, "utama", 2), (day(1), "ai", 1)]


def test_pages_are_written(spark, tmp_path):
    rows = [(D, '<a href="arsip/2024-01-01.html">x</a>'), (day(1), '<a href="arsip/2024-01-01.html">y</a>\n<p>')]
    report.write_pages(spark.createDataFrame(rows, "edition date, html string"), str(tmp_path / "site"))
    text = lambda p: "".join(f.read_text() for f in Path(tmp_path, "site", p).glob("*.txt"))
    assert text("index") == rows[1][1] + "\n"  # the newest, as it stands at the top
    assert text(f"arsip/page={D}") == '<a href="2024-01-01.html">x</a>\n' and text(f"arsip/page={day(1)}").startswith('<a href="2024-01-01.html">y')


# -- streams ---------------------------------------------------------------------------------------


def run(df, path, mode="append"):
    q = df.writeStream.format("memory").queryName(path.name.replace("-", "_")).outputMode(mode).option("checkpointLocation", str(path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(path.name.replace("-", "_")).collect()


def test_edition_windows_of_a_stream(spark, tmp_path):
    """A day from 22:00 UTC; a late article counts until the watermark has passed its window."""
    at = lambda d, h: datetime(2024, 1, d, h, 30)
    schema = "article_id long, domain string, published_at timestamp"
    files = [[(1, "a", at(2, 21)), (2, "a", at(2, 22)), (3, "b", at(3, 21)), (4, "b", None)], [(5, "c", at(2, 23)), (6, "c", at(9, 1))], [(9, "c", at(9, 2))], [(7, "d", at(2, 23)), (8, "d", at(20, 1))]]
    for k, rows in enumerate(files):
        f = tmp_path / f"f{k}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(f))
        for p in f.glob("*.parquet"):
            time.sleep(0.05)
            (tmp_path / "in").mkdir(exist_ok=True)
            p.rename(tmp_path / "in" / f"{k}.parquet")
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = {r["edition"]: (r["n_articles"], r["n_sources"]) for r in run(stream.edition_counts(source), tmp_path / "windows")}
    # 21:30 of the 2nd belongs to the window before; article 7 comes when its window is closed
    assert got[date(2024, 1, 3)] == (1, 1) and got[date(2024, 1, 4)] == (3, 3) and date(2024, 1, 21) not in got
    ids = sorted(r["article_id"] for r in run(stream.first_seen(source.where("published_at is not null").withColumn("article_id", F.col("article_id") % 4)), tmp_path / "first"))
    assert ids[:4] == [0, 1, 2, 3]


GOOD = b"<rss><channel><item><title>T</title><link>l</link></item><item><title>U</title><link>m</link></item></channel></rss>"
RAW = [("good", 200, GOOD), ("quiet", 200, b"<rss><channel></channel></rss>"), ("same", 304, b""), ("down", None, b""), ("gone", 404, b""), ("odd", 200, b"<html>sorry</html>")]


def raw_replies(spark, rows):
    at = datetime(2024, 1, 1)
    return spark.createDataFrame([(n, f"https://{n}/", "makro", 1.0, "id", s, at, None, None, "h", len(b), 0.1, b, None) for n, s, b in rows], feeds.RAW)


def test_silent_feeds_are_observed_in_flight(spark):
    seen = Observation()
    assert feeds.entries_of(feeds.observed(feeds.parse_replies(raw_replies(spark, RAW)), seen)).count() == 2
    assert seen.get == {"n_replies": 6, "n_items": 2, "n_failed": 2, "n_silent": 2, "silent": ["odd", "quiet"]}


def test_silent_feeds_of_a_stream(spark, tmp_path):
    told = []
    listener = feeds.SilentFeedListener("replies", lambda batch, names: told.append((batch, names)))
    spark.streams.addListener(listener)
    try:
        for k, rows in enumerate((RAW, RAW[:1], RAW[1:2])):
            raw_replies(spark, rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            source = spark.readStream.schema(feeds.RAW).parquet(str(tmp_path / "in"))
            q = feeds.entries_of(feeds.observed(feeds.parse_replies(source), "replies")).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
            q.awaitTermination()
        until = time.time() + 20
        while len(told) < 2 and time.time() < until:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert told == [(0, ["odd", "quiet"]), (2, ["quiet"])]


# -- approximate titles ----------------------------------------------------------------------------


def test_lsh_recall(spark):
    """At least 0.9 of all pairs over the threshold, those included whose shared tokens are all hot."""
    tokens = cluster.tokenise(articles(spark, "/root/testdata/sf0.1")).cache()
    sets = {}
    for r in tokens.collect():
        if len(r["tokens"]) >= 3:
            sets.setdefault((r["grp"], frozenset(r["tokens"])), []).append(r["article_id"])
    firsts = {}
    for (grp, words), ids in sets.items():
        firsts.setdefault(grp, []).append((min(ids), words))
    want = {tuple(sorted((i, j))) for rows in firsts.values() for (i, a), (j, b) in combinations(rows, 2) if len(a & b) >= 0.42 * len(a | b)}
    copies = {(min(ids), i) for ids in sets.values() for i in ids if i != min(ids)}
    got = {(r["a"], r["b"]): r["jaccard"] for r in lsh.lsh_pairs(tokens).collect()}
    assert len(want) > 20 and set(got) <= want | copies and copies <= set(got)
    assert len(want & set(got)) >= 0.9 * len(want)


def test_lsh_reaches_hot_tokens(spark):
    words = ["laba", "bank", "naik", "saham"]
    rows = [(k, " ".join([*words, f"unik{k}"]), D) for k in range(70)] + [(500 + k, " ".join(words), D) for k in range(30)] + [(900, "x", D), (901, None, D)]
    df = spark.createDataFrame(rows, "article_id long, title string, edition date")
    tokens = cluster.tokenise(df)
    assert cluster.similar_pairs(tokens).count() == 0  # each shared token is hot
    pairs = lsh.lsh_pairs(tokens).collect()
    assert sum(r["a"] == 500 and r["b"] > 500 for r in pairs) == 29  # copies, once each
    made = {}
    for r in lsh.lsh_clusters(tokens).collect():
        made.setdefault(r["event_id"], set()).add(r["article_id"])
    assert made[0] == {r[0] for r in rows if r[0] < 900} and made[900] == {900} and made[901] == {901}


# -- sources and annotations -----------------------------------------------------------------------


def test_source_status(spark):
    at = lambda h: datetime(2024, 1, 1, h)
    rows = [("up", 1, "galat", 0, "x"), ("up", 2, "ok", 4, None), ("up", 3, "304", 0, "same"), ("shaky", 1, "ok", 2, None), ("shaky", 2, "galat", 0, "HTTP 500"), ("never", 1, "galat", 0, "gone")]
    rows += [("gone", 1, "ok", 9, None), *(("gone", h, "galat", 0, f"e{h}") for h in (2, 3, 4))]
    df = spark.createDataFrame([(f, at(h), s, n, t) for f, h, s, n, t in rows] + [("up", None, "galat", 0, None)], "feed string, at timestamp, status string, n_items int, note string")
    got = {r["feed"]: (r["n_runs"], r["last_run"].hour, r["last_good"] and r["last_good"].hour, r["n_failed"], r["last_items"], r["level"]) for r in quality.source_status(df).collect()}
    assert got == {"up": (3, 3, 3, 0, 4, "ok"), "shaky": (2, 2, 1, 1, 2, "warn"), "never": (1, 1, None, 1, None, "down"), "gone": (4, 4, 1, 3, 9, "down")}
    assert quality.source_status(df.where("false")).count() == 0


def test_annotation_versions(spark):
    from dawnpress.operators import annotations as A

    df = spark.createDataFrame([(1, "BI rate naik, inflasi melonjak", None), (2, "Kapal tenggelam, puluhan penumpang hilang", ""), (3, None, None)], "article_id long, title string, summary string")
    one = A.annotate(df, "1", F.lit("2024-01-01"))
    got = {r["article_id"]: r for r in one.collect()}
    assert got[1]["topics"] == ["Kebijakan moneter", "Data makro"] and got[1]["label"] == "negatif" and got[2]["events"] == ["disaster"] and got[3]["label"] == "netral" and got[3]["topics"] == []
    two = one.withColumn("version", F.lit("2")).withColumn("label", F.when(F.col("article_id") == 1, "netral").otherwise(F.col("label"))).withColumn("score", F.col("score") + 1)
    assert A.new_annotations(one, two.unionByName(one)).count() == 3  # only the new version's
    compared = {r["label"]: tuple(r)[1:] for r in A.compare_versions(one.unionByName(two), "rules", "1", "2").collect()}
    assert compared == {"negatif": (1, 1, 0, 1.0), "netral": (2, 0, 0, 1.0)}
