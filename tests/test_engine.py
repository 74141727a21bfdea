"""Operators on small, freshly written cases."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from dawnpress import schema as S
from dawnpress.functions import rules, text as X
from dawnpress.operators import cluster, edition, report, translate
from dawnpress.plans.components import connected_components
from dawnpress.sources import feeds
from dawnpress.sources.store import Table


def one(spark, expr, **cols):
    return spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} string" for k in cols)).select(expr.alias("x")).first()["x"]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 200), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 200: 200}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("word,want", [("membangun", "bangun"), ("mengambil", "gambil"), ("harganya", "harga"), ("ikan", "ikan")])
def test_stem(spark, word, want):
    assert one(spark, X.stem(F.col("w")), w=word) == want


def test_url_and_text(spark):
    assert one(spark, X.canonical_url("u"), u="https://a.id/x?utm_source=f&id=3&ref=z&b=#top") == "https://a.id/x?id=3&b="
    assert one(spark, X.domain("u"), u="https://www.a.id:80/x") == "a.id:80"
    assert one(spark, X.clean_html("u"), u="<p>A &amp; B</p>  c ") == "A & B c"
    assert one(spark, X.clean_html("u"), u="<br>") is None
    assert one(spark, X.slug("u"), u="!!") == "tanpa-nama"
    assert one(spark, X.rfc822("u"), u="Mon, 09 Sep 2026 09:00:00 +0700") == datetime(2026, 9, 9, 2)
    assert one(spark, X.image_url("u"), u="https://a.id/p.JPG?x=1") and one(spark, X.image_url("u"), u="https://a.id/1x1.png") is None
    assert one(spark, X.dateline_free("u"), u="Bisnis.com, JAKARTA — Isi berita") == "Isi berita"


def test_window_depends_on_date_only(spark):
    assert edition.window_bounds(date(2026, 9, 9)) == ("2026-09-07 22:00:00", "2026-09-08 22:00:00")
    rows = spark.sql("select timestamp_ntz'2026-09-07 22:00:00' t union all select timestamp_ntz'2026-09-08 21:59:59' union all select timestamp_ntz'2026-09-08 22:00:00'").select(X.edition_date("t").alias("e"))
    assert sorted(r["e"] for r in rows.collect()) == [date(2026, 9, 9), date(2026, 9, 9), date(2026, 9, 10)]


def test_clusters(spark):
    titles = ["Harga beras naik tajam di Jakarta", "Beras naik tajam, harga di Jakarta melonjak", "Timnas menang lawan Vietnam", "Beras naik"]
    df = spark.createDataFrame([(i, t, date(2026, 9, 9)) for i, t in enumerate(titles)], "article_id long, title string, edition date")
    got = {r["article_id"]: r["event_id"] for r in cluster.clusters(df).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 3}


def art(i, title, category="makro", hour=3, dom=None, summary="isi", weight=1.0, lang="id"):
    dom = dom or f"d{i}.id"
    return (i, f"https://{dom}/{i}", dom, title, summary, datetime(2026, 9, 8, hour), category, weight, None, lang)


ARTICLE = "article_id long, url string, domain string, title string, summary string, published_at timestamp_ntz, category string, weight double, image string, lang string"


def test_edition_sections_and_page(spark):
    rows = [art(i, "Bank sentral umumkan BI rate baru hari Kamis") for i in range(3)]
    rows += [art(10 + i, f"Kabar daerah nomor {w} tentang jembatan desa", summary=None) for i, w in enumerate(["satu", "dua", "tiga"])]
    rows += [art(20, "Peresmian pabrik dan lomba"), art(21, "Coretax lambat, wajib pajak antre", "politik"), art(22, "Obrolan santai tetangga sambil minum", "politik", summary="tanpa kata kunci")]
    rows += [art(30, "OpenAI unveils new model for developers", "global", lang="en"), art(31, "OpenAI unveils model for new developers today", "global", lang="en")]
    shown = edition.compose(edition.with_edition(spark.createDataFrame(rows, ARTICLE))).cache()
    got = {r["event_id"]: r for r in shown.collect()}
    assert got[0]["section"] == "utama" and got[0]["impact"] == 3 and got[0]["n_media"] == 3
    assert 20 not in got and 22 not in got
    assert got[21]["section"] == "pajak" and got[30]["section"] == "ai" and 31 not in got
    cache = spark.createDataFrame([("OpenAI unveils new model for developers", "OpenAI <merilis> model")], "source string, result string")
    told = translate.apply_translations(shown, cache)
    page = report.pages(told, edition.totals(edition.with_edition(spark.createDataFrame(rows, ARTICLE)))).first()
    assert "OpenAI &lt;merilis&gt; model" in page["html"] and 'hreflang="en"' in page["html"] and "10:00 WIB" in page["html"]


def test_direction(spark):
    rows = [("Laba naik, utang bertambah", None, "netral"), ("Inflasi naik", None, "negatif"), ("Rupiah tidak melemah", None, "positif"), ("Penonton melonjak", None, "netral"), ("", None, "netral")]
    df = spark.createDataFrame([r[:2] for r in rows], "title string, summary string").select(rules.direction().alias("d"))
    assert [r["d"]["label"] for r in df.collect()] == [r[2] for r in rows]


RSS = b"""<rss xmlns:media="http://search.yahoo.com/mrss/"><channel><title>Kanal</title>
<item><title>Harga naik - Kabar</title><link>https://www.kabar.id/a?utm_source=x&amp;id=1</link><description>&lt;p&gt;Isi &amp;amp; isi&lt;/p&gt;</description><pubDate>Rab, 09 Sep 2026 09:00:00 +0700</pubDate><source url="https://www.kabar.id">Kabar</source><media:thumbnail url="https://k.id/p.jpg"/></item>
<item><title></title><link>https://kabar.id/b</link></item>
<item><title>Dua</title><link>https://kabar.id/c#top</link></item></channel></rss>"""


def test_collect_is_idempotent_and_isolated(spark, tmp_path):
    def transport(url, headers):
        if "down" in url:
            raise OSError("no route")
        if "empty" in url:
            return 200, {}, b"<rss><channel/></rss>"
        if headers.get("If-None-Match"):
            return 304, {}, b""
        return 200, {"etag": '"1"'}, RSS

    def client():
        return feeds.Client(transport, pause=0, sleep=lambda s: None)

    toml = "".join(f'[[feed]]\nnama = "{n}"\nurl = "https://{n}.id/rss"\nkategori = "makro"\n' for n in ("good", "down", "empty"))
    cat = feeds.catalogue(spark, toml)
    first = feeds.collect(spark, str(tmp_path), cat, client, "r1").first()
    assert (first["checked"], first["failed"], first["new"], first["all_failed"]) == (3, 2, 2, False)
    second = feeds.collect(spark, str(tmp_path), cat, client, "r2").first()
    assert (second["unchanged"], second["new"]) == (1, 0)
    rows = {r["title"]: r for r in Table(spark, f"{tmp_path}/article", S.ARTICLE).read().collect()}
    assert set(rows) == {"Harga naik", "Dua"}
    r = rows["Harga naik"]
    assert (r["url"], r["domain"], r["summary"], r["published_at"], r["image"]) == ("https://www.kabar.id/a?utm_source=x&id=1", "kabar.id", "Isi & isi", datetime(2026, 9, 9, 2), "https://k.id/p.jpg")
    assert feeds.reparse(spark, str(tmp_path)).first()["n_filled"] == 1


def test_client_retries():
    seen = []

    def transport(url, headers):
        seen.append(url)
        return (503, {}, b"") if len(seen) < 3 else (200, {}, b"x")

    assert feeds.Client(transport, pause=0, sleep=lambda s: None).get("https://a/")[2] == b"x" and len(seen) == 3
    with pytest.raises(UnicodeEncodeError):
        feeds.Client(transport, agent="é")


def test_translation_chain():
    def refuses(t):
        raise OSError("429")

    def odd(t):
        if t == "b":
            raise ValueError("?")
        return t.upper()

    assert translate.run_chain(["a", "b", "c"], [("x", refuses), ("y", odd)]) == [("a", "A", "y"), ("c", "C", "y")]
    assert translate.run_chain(["a"], [("x", refuses)]) == []
    assert translate.parse_chunks(json.dumps([[["Halo ", "x"], ["dunia", "y"]]]).encode()) == "Halo dunia"
    assert translate.parse_flat(b'[["halo","en"]]') == translate.parse_flat(b'["halo"]') == "halo"
    for bad in (b"<html>", b"[]", b"[[]]", b'[[[""]]]'):
        with pytest.raises(ValueError):
            translate.parse_chunks(bad)


def test_messages(spark):
    parts = report.split_message("\n".join(f"baris {i} " + "x" * 80 for i in range(200)))
    assert len(parts) > 1 and all(len(p) <= report.MESSAGE_LIMIT for p in parts) and parts[0].startswith(f"(1/{len(parts)})")
    assert all(len(p) <= report.MESSAGE_LIMIT for p in report.split_message("y" * 10_000))
    waits = []
    replies = iter([(429, '{"parameters": {"retry_after": 9999}}'), (200, "")])
    assert report.notify("hai", lambda t: next(replies), sleep=waits.append) and waits == [30.0]
    report.register_message_splitter(spark)
    assert spark.sql("select * from split_message('a', 10)").count() == 1


def test_calendar(spark):
    names = spark.createDataFrame([("2026-09-09.html",), ("2026-09-08.html",), ("index.html",), ("2026-13-01.html",)], "name string")
    days = report.edition_dates(names)
    assert days.count() == 2
    html = report.calendar_page(days).first()["html"]
    assert 'class="newest"><a href="2026-09-09.html">' in html and "Kemarin" in html and "2026-09-07.html" not in html
    assert report.calendar_page(days.where("false")).count() == 1


def test_stream_appends_once(spark, tmp_path):
    from dawnpress.streaming import stream

    rows = spark.createDataFrame([("a", datetime(2026, 9, 8, 3), "x"), ("b", datetime(2026, 9, 8, 23), "y")], "article_id string, published_at timestamp_ntz, domain string")
    src = str(tmp_path / "in")
    rows.write.parquet(src)
    rows.write.mode("append").parquet(src)
    table = Table(spark, str(tmp_path / "t"), S.ARTICLE)
    seen = []
    q = stream.append_and_recompose(stream.article_stream(spark, src, rows.schema.simpleString()[7:-1].replace(":", " ")), table, lambda df, days: seen.append((df.count(), days)), str(tmp_path / "c"))
    q.awaitTermination()
    assert table.read().count() == 2 and seen[-1] == (2, [date(2026, 9, 9), date(2026, 9, 10)])


def test_components_of_hubs(spark, monkeypatch):
    """A star, a long path, loops, repeats and null ends, with every key hot or none."""
    from dawnpress.plans import components, skew

    star = [(0, k) for k in range(1, 400)] + [(k, 0) for k in range(1, 50)]
    path = [(1000 + k, 1001 + k) for k in range(150)]
    edges = spark.createDataFrame([*star, *path, (5000, 5000), (0, 0), (None, 3), (7000, 7001)], "u long, v long")
    want = {(k, 0) for k in range(400)} | {(1000 + k, 1000) for k in range(151)} | {(5000, 5000), (7000, 7000), (7001, 7000)}
    for least, last in ((1000, 1 << 20), (1000, 30), (2, 0)):
        monkeypatch.setattr(skew, "LEAST_ROWS", least)
        monkeypatch.setattr(components, "LAST_EDGES", last)
        got = [tuple(r) for r in connected_components(edges).collect()]
        assert len(got) == len(want) and set(got) == want
    assert connected_components(edges.where("false")).count() == 0
    assert {tuple(r) for r in connected_components(edges.where("u = v")).collect()} == {(5000, 5000), (0, 0)}


def test_join_spread(spark, monkeypatch):
    from dawnpress.plans import skew

    monkeypatch.setattr(skew, "LEAST_ROWS", 10)
    many = spark.createDataFrame([(k % 3 if k < 200 else k, k) for k in range(260)], "k long, v long")
    one = spark.createDataFrame([(k, f"x{k}") for k in range(0, 300, 2)], "k long, name string")
    hot = skew.hot_keys(many.groupBy("k").count(), ["k"], "count")
    assert {r["k"] for r in hot} == {0, 1, 2}
    for how in ("inner", "left"):
        assert sorted(map(tuple, skew.join_spread(many, one, ["k"], hot, how).collect()), key=str) == sorted(map(tuple, many.join(one, "k", how).collect()), key=str)


def test_unescape(spark):
    import html

    texts = ["a &amp; b", "&lt;p&gt;", "&amp;lt;", "&copy;&middot;&eacute;", "&#39;&#x27;&#8230;&#128161;", "&#150;&#0;&#xD800;&#x110000;", "&notit; &notin; &ampx", "& &; &unknown; a&b", "&AMP &COPY", "&#1;x", "", "plain", "&"]
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    from dawnpress.functions.text import unescape

    got = dict(rows.select("t", unescape("t")).collect())
    assert got == {None: None} | {t: html.unescape(t) for t in texts}


def test_summary_is_the_content_and_compared_with_the_raw_title(spark):
    from dawnpress.sources import feeds

    body = b"""<rss xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel>
      <item><title>First of all</title><link>https://a.example/1</link><description>short</description><content:encoded>&lt;p&gt;the whole story&lt;/p&gt;</content:encoded></item>
      <item><title>Rock &amp;amp; roll</title><link>https://a.example/2</link><description>Rock &amp;amp; roll - and more</description></item></channel></rss>"""
    raw = spark.createDataFrame([("f", "makro", 1.0, "id", bytearray(body))], "name string, category string, weight double, lang string, body binary").withColumn("fetched_at", F.lit("2026-01-01").cast("timestamp_ntz"))
    got = {r["title"]: r["summary"] for r in feeds.to_articles(feeds.parse_feeds(raw)).collect()}
    # the second title is looked at as "rockamproll", which its summary "rockroll..." does not begin with
    assert got == {"First of all": "the whole story", "Rock & roll": "Rock & roll - and more"}


def test_table_survives_a_lost_writer(spark, tmp_path):
    from dawnpress.sources.store import Table

    t = Table(spark, str(tmp_path / "t"), "k long, v string")
    t.append(spark.createDataFrame([(1, "a")], "k long, v string"))
    half = tmp_path / "t" / "versions" / "000000002"
    half.mkdir()
    (half / "part-0.txt").write_text("nowhere")  # no _SUCCESS
    assert [tuple(r) for r in t.read().collect()] == [(1, "a")]
    assert t.append_ignore(spark.createDataFrame([(1, "b"), (2, "c")], "k long, v string"), "k", F.col("v")) == 1
    assert sorted(map(tuple, t.read().collect())) == [(1, "a"), (2, "c")]


def test_articles_do_not_send_whole_texts(spark):
    from dawnpress import queries

    plan = queries.articles(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Repartition") :].split("\n")
    assert "Project" in below[1] and "split(text" in below[1]  # titles are cut out before rows are dealt


def test_bitmaps_bound_what_titles_share(spark):
    """Titles that meet in one token and share no more are told by their bitmaps; the bound is never too low."""
    from itertools import combinations

    from dawnpress.operators import cluster

    titles = {k: [f"own{k}x{i}" for i in range(20)] + ["meets"] + (["p", "q", "r"] if k % 2 else []) for k in range(8)}
    tokens = spark.createDataFrame([("g", k, t) for k, t in titles.items()], "grp string, article_id long, tokens array<string>")
    each = tokens.selectExpr("article_id", "explode(tokens) token").groupBy("article_id").agg(F.count(F.lit(1)).alias("n"), *cluster.bitmap(F.xxhash64("token")))
    side = lambda k: each.select(F.col("article_id").alias(k), *(F.col(c).alias(f"{c}{k}") for c in each.columns[1:]))
    bound = {(r[0], r[1]): r[2] for r in side("a").join(side("b")).where("a < b").select("a", "b", F.col("na") - cluster.alone("a", "b")).collect()}
    for a, b in combinations(titles, 2):
        shared = len({*titles[a]} & {*titles[b]})
        assert shared <= bound[a, b] <= shared + 5


@pytest.mark.parametrize(("name", "most"), [("reroute_sections", 4), ("disaster_flag", 4)])
def test_texts_are_looked_through_once(spark, name, most):
    from dawnpress import queries

    # title and whole text, of the fixed headlines and of the documents
    plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("regexp_extract_all") <= most


def test_phrases_may_overlap(spark):
    phrases = ["suku bunga", "bunga acuan", "bunga", "acuan naik", "bunga acuan naik"]
    df = spark.createDataFrame([(" suku bunga acuan naik ",), (" bunga bunga acuan ",), ("  ",), (" sukubunga acuannaik ",)], "t string")
    assert [r[0] for r in df.select(rules.matches(F.col("t"), phrases)).collect()] == [["suku bunga", "bunga acuan naik", "acuan naik"], ["bunga", "bunga acuan"], [], []]


def test_tables_of_several_files_stay_where_they_are(spark, tmp_path):
    from dawnpress.plans.skew import spread

    cores = spark.sparkContext.defaultParallelism
    dealt = lambda path: "Repartition" in spread(spark.read.parquet(str(path)))._jdf.queryExecution().optimizedPlan().toString()
    rows = spark.range(10_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 40).alias("text"))
    rows.repartition(2 * cores).write.parquet(str(tmp_path / "even"))
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    rows.coalesce(1).write.parquet(str(tmp_path / "skewed"))
    rows.limit(2 * cores).repartition(2 * cores).write.mode("append").parquet(str(tmp_path / "skewed"))
    rows.where("false").write.parquet(str(tmp_path / "empty"))
    assert [dealt(tmp_path / k) for k in ("even", "one", "skewed")] == [False, True, True]
    assert spread(spark.read.parquet(str(tmp_path / "empty"))).count() == 0
    assert spread(spark.read.parquet(str(tmp_path / "skewed"))).count() == 10_000 + 2 * cores
