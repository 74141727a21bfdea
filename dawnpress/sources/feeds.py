"""Feeds: catalogue, conditional fetch, raw objects, parsing, and the collect and reparse jobs."""

from __future__ import annotations

import codecs
import hashlib
import html
import random
import re
import time
import tomllib
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from dawnpress import schema as S
from dawnpress.functions import fixed_values as V
from dawnpress.functions import text as X
from dawnpress.sources.store import Table, coverage, last_wins

#: (url, headers) -> (status, headers, body); raises OSError when there is no reply.
Transport = Callable[[str, dict[str, str]], tuple[int, dict[str, str], bytes]]

#: A raw reply.
RAW = "name string, url string, category string, weight double, lang string, status int, fetched_at timestamp_ntz, etag string, last_modified string, sha256 string, n_bytes int, duration double, body binary, note string"


def catalogue(spark: SparkSession, toml: str) -> DataFrame:
    """The feed list of a TOML text, with defaults."""
    rows = tomllib.loads(toml).get("feed", [])
    data = [(r["nama"], r["url"], r["kategori"], float(r.get("bobot", 1.0)), r.get("bahasa") or ("en" if r["kategori"] == "global" else "id"), r.get("catatan")) for r in rows]
    return spark.createDataFrame(data, S.FEED)


def backoff(attempt: int) -> float:
    return min(2 ** (attempt - 1), 8) + random.uniform(0, 0.5)


def urllib_transport(url: str, headers: dict[str, str]) -> tuple[int, dict[str, str], bytes]:
    import urllib.error
    import urllib.request

    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=30) as r:
            return r.status, {k.lower(): v for k, v in r.headers.items()}, r.read()
    except urllib.error.HTTPError as e:
        return e.code, {k.lower(): v for k, v in e.headers.items()}, b""


class Client:
    """Conditional GET with retries and one request a second per host."""

    def __init__(self, transport: Transport = urllib_transport, agent: str = "dawnpress/1.0", pause: float = 1.0, tries: int = 3, sleep: Callable[[float], None] = time.sleep):
        agent.encode("ascii")  # a header must be ASCII
        self.transport, self.agent, self.pause, self.tries, self.sleep, self.last = transport, agent, pause, tries, sleep, {}

    def get(self, url: str, etag: str | None = None, last_modified: str | None = None) -> tuple[int, dict[str, str], bytes]:
        headers = {"User-Agent": self.agent} | ({"If-None-Match": etag} if etag else {}) | ({"If-Modified-Since": last_modified} if last_modified else {})
        for attempt in range(1, self.tries + 1):
            host = urlsplit(url).netloc
            if (wait := self.pause - (time.monotonic() - self.last.get(host, -1e9))) > 0:
                self.sleep(wait)
            self.last[host] = time.monotonic()
            try:
                status, back, body = self.transport(url, headers)
            except OSError:
                if attempt == self.tries:
                    raise
                self.sleep(backoff(attempt))
                continue
            if status in V.RETRY_STATUS and attempt < self.tries:
                self.sleep(backoff(attempt))
                continue
            return status, back, body if status == 200 else b""
        raise OSError(url)


def fetch(feeds: DataFrame, state: DataFrame, client: Callable[[], Client]) -> DataFrame:
    """One raw row per feed. Feeds of a host are in one partition, one after the other; a feed that fails
    is a row with its error and never ends the run."""
    todo = feeds.join(state.select("url", "etag", "last_modified"), "url", "left").withColumn("host", F.regexp_extract("url", "://([^/]+)", 1))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = client()
        for frame in frames:
            rows = []
            for r in frame.itertuples():
                began, note, status, head, body = time.monotonic(), None, None, {}, b""
                try:
                    status, head, body = c.get(r.url, r.etag, r.last_modified)
                except Exception as e:  # noqa: BLE001  any failure is this feed's own
                    note = f"{type(e).__name__}: {e}"
                rows.append((r.name, r.url, r.category, r.weight, r.lang, status, datetime.now(timezone.utc).replace(tzinfo=None), head.get("etag"), head.get("last-modified"), hashlib.sha256(body).hexdigest(), len(body), time.monotonic() - began, body, note))
            yield pd.DataFrame(rows, columns=["name", "url", "category", "weight", "lang", "status", "fetched_at", "etag", "last_modified", "sha256", "n_bytes", "duration", "body", "note"])

    hosts = todo.repartition("host").select("name", "url", "category", "weight", "lang", "etag", "last_modified")
    return hosts.mapInPandas(run, RAW)


def write_bronze(raw: DataFrame, path: str) -> None:
    """Raw replies, partitioned by source, year and month; a reply is stored once per content and source."""
    raw.where("status = 200").dropDuplicates(["name", "sha256"]).withColumn("source", X.slug("name")).withColumn("year", F.date_format("fetched_at", "yyyy")).withColumn("month", F.date_format("fetched_at", "MM")).write.mode("append").partitionBy("source", "year", "month").parquet(path)


def read_bronze(spark: SparkSession, path: str, month: str | None = None) -> DataFrame:
    """Raw replies; ``month`` (``2026/09``) prunes partitions."""
    df = spark.read.schema(f"{RAW}, source string, year string, month string").parquet(path)
    if month:
        y, m = month.split("/")
        df = df.where((F.col("year") == y) & (F.col("month") == m))
    return df


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1].lower()


def _is_media(tag: str) -> bool:
    """Whether a tag belongs to the vocabulary of pictures and films."""
    return "media" in tag or "mrss" in tag.split("}")[0]


def decode(body: bytes) -> str:
    """The text of a feed: by its byte-order mark, as UTF-8 if it is that, as it declares, or as western text."""
    for mark, name in ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be")):
        if body.startswith(mark):
            return body[len(mark) :].decode(name, "replace")
    declared = re.match(rb"""\s*<\?xml[^>]*encoding=["']([A-Za-z0-9._-]+)""", body)
    for name in ("utf-8", declared[1].decode() if declared else "utf-8", "cp1252"):
        try:
            return body.decode(name)
        except (UnicodeDecodeError, LookupError):
            pass
    return body.decode("utf-8", "replace")


#: Elements of an entry whose start ends an element that was left open before them.
_FIELDS = {
    "title", "link", "description", "summary", "content", "encoded", "pubdate", "published", "updated", "date", "source", "enclosure", "thumbnail", "guid", "id", "author",
    "creator", "category", "comments", "group", "credit",
}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<raw>.*?)(?:\]\]>|\Z)|<[?!][^<>]*>?|<(?P<end>/?)(?P<name>[A-Za-z_][\w.:-]*)(?P<more>[^<>]*?)(?P<empty>/?)>|(?P<text>[^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"""([\w.:-]+)\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s"'>]+))""")


def lenient_entries(text: str) -> list[ET.Element]:
    """Entries of a feed that is no well-formed XML. A reader with three states: outside an entry, in one, and in
    one of its elements. An element ends with its tag, with the next element or with the entry; an entry ends with
    its tag, with the next entry or with the text. Other tags inside an element are its text, an ampersand may
    stand alone, and all entities of HTML are known."""
    out: list[ET.Element] = []
    entry = field = None
    parts: list[str] = []

    def close() -> None:
        nonlocal field
        if field is not None:
            field.text = "".join(parts)
            parts.clear()
            field = None

    for m in _TOKEN.finditer(text):
        name = (m["name"] or "").lower()
        prefix, _, local = name.rpartition(":")
        if name and not m["end"] and local in ("item", "entry"):
            close()
            out.append(entry := ET.Element(local))
        elif entry is None:
            continue
        elif name and m["end"] and local in ("item", "entry"):
            close()
            entry = None
        elif name and not m["end"] and local in _FIELDS and (field is None or field.tag != "content" or prefix):
            close()
            if local == "group":
                continue
            found = {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(m["more"])}
            field = ET.SubElement(entry, f"{{{prefix}}}{local}" if prefix else local, found)
            if m["empty"]:
                close()
        elif name and m["end"] and field is not None and _local(field.tag) == local:
            close()
        elif field is not None:
            parts.append(m["raw"] if m["raw"] is not None else html.unescape(m["text"]) if m["text"] else m[0] if name else "")
    close()
    return out


def parse_feed(body: bytes) -> list[dict]:
    """Entries of an RSS or Atom document, also of one that is no well-formed XML."""
    try:
        items: list[ET.Element] = [x for x in ET.fromstring(body).iter() if _local(x.tag) in ("item", "entry")]
    except (ET.ParseError, ValueError, LookupError):  # ValueError and LookupError: encodings that do not fit or exist
        items = lenient_entries(decode(body))
    out = []
    for item in items:
        e: dict = {"link": None, "title": None, "summary": None, "content": None, "published": None, "updated": None, "source": None, "source_url": None, "thumbs": [], "media": [], "enclosures": []}
        for x in item:
            tag, value = _local(x.tag), (x.text or "").strip()
            if tag == "link":
                e["link"] = e["link"] or x.get("href") or value
                if x.get("rel") == "enclosure":
                    e["enclosures"].append((x.get("href"), x.get("type")))
            elif tag == "title" and not _is_media(x.tag):
                e["title"] = value
            elif tag in ("description", "summary") and not _is_media(x.tag):
                e["summary"] = e["summary"] or value
            elif tag in ("encoded", "content") and value and not _is_media(x.tag):
                e["content"] = value
            elif tag in ("pubdate", "published", "date"):
                e["published"] = value
            elif tag == "updated":
                e["updated"] = value
            elif tag == "source":
                e["source"], e["source_url"] = value, x.get("url") or x.get("href")
            elif tag == "enclosure":
                e["enclosures"].append((x.get("url"), x.get("type")))
            if tag == "thumbnail":
                e["thumbs"].append(x.get("url"))
            if _is_media(x.tag):
                for m in x.iter():
                    if _local(m.tag) == "content" and m.get("url"):
                        e["media"].append((m.get("url"), m.get("medium")))
        out.append(e)
    return out


_IMG = re.compile(r"""<img[^>]+src=["']([^"']+)["']""", re.I)


def image_candidates(e: dict) -> list[str]:
    """Picture URLs of an entry, best first."""
    got = [*e["thumbs"], *(u for u, m in e["media"] if m in (None, "", "image")), *(u for u, t in e["enclosures"] if not t or t.startswith("image/"))]
    for part in (e["content"], e["summary"]):
        got += [html.unescape(u) for u in _IMG.findall(part or "")]
    return [u for u in got if u]


_ENTRY = "pos int, link string, raw_title string, raw_summary string, raw_time string, source string, source_url string, images array<string>"
_REPLY = "feed string, category string, weight double, lang string, fetched_at timestamp_ntz, status int, note string"


def parse_replies(raw: DataFrame) -> DataFrame:
    """Raw replies with their ``entries``. Feeds are small and often malformed: they are parsed a reply at a time in
    Python; everything behind is column expressions. Only good replies have entries."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            entries = []
            for status, body in zip(frame["status"], frame.pop("body"), strict=True):
                rows = []
                for k, e in enumerate(parse_feed(bytes(body)) if status == 200 and body is not None else []):
                    plain = html.unescape(re.sub("<[^>]+>", " ", e["content"] or e["summary"] or ""))
                    rows.append({"pos": k, "link": e["link"], "raw_title": e["title"], "raw_summary": plain, "raw_time": e["published"] or e["updated"], "source": e["source"], "source_url": e["source_url"], "images": image_candidates(e)})
                entries.append(rows)
            yield frame.assign(entries=entries)

    replies = raw.select(F.col("name").alias("feed"), "category", "weight", "lang", "fetched_at", "status", "note", "body")
    return replies.mapInPandas(run, f"{_REPLY}, entries array<struct<{', '.join(x.replace(' ', ': ', 1) for x in _ENTRY.split(', '))}>>")


def entries_of(replies: DataFrame) -> DataFrame:
    return replies.select("feed", "category", "weight", "lang", "fetched_at", F.explode("entries").alias("e")).select("feed", "category", "weight", "lang", "fetched_at", "e.*")


def parse_feeds(raw: DataFrame) -> DataFrame:
    """Raw replies to entries. Replies that are stored are good ones, and need no status."""
    missing = {c: v for c, v in (("status", F.lit(200)), ("note", F.lit(None).cast("string"))) if c not in raw.columns}
    return entries_of(parse_replies(raw.withColumns(missing) if missing else raw))


def observed(replies: DataFrame, observation: Observation | str) -> DataFrame:
    """``replies`` (of :func:`parse_replies`), which tell as they pass: how many there are, how many entries they have,
    how many failed, and which feeds are silent, that is answered well and brought nothing. Nothing is read a
    second time; the list of feeds has one name at most for each of the catalogue's."""
    n = F.size("entries")
    silent = (F.col("status") == 200) & (n == 0)
    return replies.observe(
        observation, F.count(F.lit(1)).alias("n_replies"), F.coalesce(F.sum(n), F.lit(0)).alias("n_items"), F.count_if(F.col("status").isNull() | ~F.col("status").isin(200, 304)).alias("n_failed"),
        F.count_if(silent).alias("n_silent"), F.array_sort(F.collect_set(F.when(silent, F.col("feed")))).alias("silent"),
    )


class SilentFeedListener(StreamingQueryListener):
    """Tells ``report(batch, feeds)`` of each batch of a stream whose :func:`observed` replies, under ``name``, have
    silent feeds."""

    def __init__(self, name: str, report: Callable[[int, list[str]], None]):
        self.name, self.report = name, report

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        if seen is not None and seen["n_silent"]:
            self.report(event.progress.batchId, list(seen["silent"]))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def to_articles(entries: DataFrame) -> DataFrame:
    """Entries to article rows (with ``pos`` for the order in the feed); those without link or title go."""
    e = entries.where((F.trim("link") != "") & (F.trim("raw_title") != ""))
    tidy = X.strip(F.regexp_replace("raw_summary", r"(?U)\s+", " "))
    e = e.withColumn("plain", F.when(tidy != "", F.substring(tidy, 1, V.SUMMARY_CHARS)))
    # a summary is compared with the title before its entities are undone
    e = e.withColumn("bare", X.without_source("raw_title", "source")).withColumn("shown", X.unescape("bare"))
    images = F.filter(F.transform("images", X.image_url), lambda u: u.isNotNull())
    return e.select(
        X.url_id("link").alias("article_id"), X.strip_fragment("link").alias("url"), X.domain(F.coalesce(F.when(F.col("source_url") != "", F.col("source_url")), F.col("link"))).alias("domain"),
        F.col("shown").alias("title"), X.useful_summary("plain", "bare").alias("summary"), X.rfc822("raw_time").alias("published_at"), "fetched_at", "feed", "category",
        F.coalesce("weight", F.lit(1.0)).alias("weight"), F.get(images, F.lit(0)).alias("image"), F.coalesce("lang", F.when(F.col("category") == "global", "en").otherwise("id")).alias("lang"), "pos",
    )


def run_metrics(raw: DataFrame, entries: DataFrame, added: DataFrame, run_id: str) -> DataFrame:
    """A row per feed. A reply without entries is a failure, although its status is 200."""
    items = entries.groupBy("feed").agg(F.count(F.lit(1)).cast("int").alias("n_items"))
    new = added.groupBy("feed").agg(F.count(F.lit(1)).cast("int").alias("n_new"))
    m = raw.select(F.col("name").alias("feed"), "status", "fetched_at", "duration", "note").join(items, "feed", "left").join(new, "feed", "left").na.fill(0, ["n_items", "n_new"])
    status = F.when(F.col("status") == 304, "304").when((F.col("status") == 200) & (F.col("n_items") > 0), "ok").otherwise("galat")
    note = F.coalesce("note", F.when((F.col("status") == 200) & (F.col("n_items") == 0), "200 tapi 0 item"), F.when(~F.col("status").isin(200, 304), F.concat(F.lit("HTTP "), F.col("status").cast("string"))))
    return m.select(F.lit(run_id).alias("run_id"), "feed", F.col("fetched_at").alias("at"), status.alias("status"), "n_items", "n_new", "duration", note.alias("note"))


def run_summary(metrics: DataFrame) -> DataFrame:
    """Per run: checked, unchanged, failed, items, new, and whether every feed failed (the exit flag)."""
    return metrics.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("checked"), F.count_if(F.col("status") == "304").alias("unchanged"), F.count_if(F.col("status") == "galat").alias("failed"),
        F.sum("n_items").cast("long").alias("items"), F.sum("n_new").cast("long").alias("new"), F.bool_and(F.col("status") == "galat").alias("all_failed"),
    )


def collect(spark: SparkSession, root: str, feeds: DataFrame, client: Callable[[], Client], run_id: str, report: Callable[[list[str]], None] | None = None) -> DataFrame:
    """The collect job; returns the run's summary row. ``report`` is told of silent feeds as soon as replies are parsed."""
    articles, state, metrics = (Table(spark, f"{root}/{n}", s) for n, s in (("article", S.ARTICLE), ("feed_state", S.FEED_STATE), ("run_metric", S.RUN_METRIC)))
    stage = f"{root}/runs/{run_id}"
    fetch(feeds, state.read(), client).write.parquet(stage)  # each feed is asked once
    raw = spark.read.parquet(stage)
    write_bronze(raw, f"{root}/bronze")
    seen = Observation()
    observed(parse_replies(raw), seen).write.parquet(f"{stage}-parsed")  # and is parsed once
    if report and seen.get["silent"]:
        report(seen.get["silent"])
    entries = entries_of(spark.read.parquet(f"{stage}-parsed"))
    found = to_articles(entries)
    before = articles.read().select("article_id")
    articles.append_ignore(found, "article_id", F.struct("feed", "pos"))
    added = articles.read().join(before, "article_id", "left_anti")
    rows = run_metrics(raw, entries, added, run_id)
    metrics.append(rows)
    good = rows.where("status <> 'galat'").select("feed")
    state.upsert(raw.join(good, raw["name"] == good["feed"]).where("status = 200").select("url", "etag", "last_modified", F.col("sha256").alias("body_hash"), F.col("fetched_at").alias("last_success")), "url", "last_success")
    return run_summary(metrics.read().where(F.col("run_id") == run_id))


def reparse(spark: SparkSession, root: str, month: str | None = None) -> DataFrame:
    """Fill missing images from the raw replies, newest reply last; returns the coverage."""
    articles = Table(spark, f"{root}/article", S.ARTICLE)
    found = to_articles(parse_feeds(read_bronze(spark, f"{root}/bronze", month)))
    articles.fill_null(last_wins(found.withColumn("o", F.concat_ws("/", X.slug("feed"), F.col("fetched_at").cast("string"))), "article_id", "image", "o"), "article_id", "image")
    return coverage(articles.read(), "image")
