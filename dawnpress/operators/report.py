"""Pages, calendar and messages, one row per page."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dawnpress.functions import fixed_values as V
from dawnpress.functions import text as X

MESSAGE_LIMIT = 4096


def _opt(c: Column, make: Callable[[Column], Column]) -> Column:
    return F.when(c.isNotNull(), make(c))


def item_html(n: int = 5) -> Column:
    """One event: the section's first as a card with its picture, the others numbered from 2."""
    e = X.escape_html
    title = F.coalesce(F.col("title"), F.lit(""))
    link = F.concat(F.lit('<a href="'), e("url"), F.when(F.col("title_original").isNotNull(), '" hreflang="en">').otherwise('">'), e(title), F.lit("</a>"))
    badge = F.create_map(*(F.lit(x) for kv in V.BADGES.items() for x in kv))
    meta = F.concat_ws(
        " · ", F.when(F.col("impact") == 3, "dampak tinggi"), F.concat(badge[F.col("sentiment")], F.lit(" "), F.col("sentiment")),
        F.when(F.col("n_media") > 1, F.concat(F.col("n_media").cast("string"), F.lit(" media"))), e("domain"), F.concat(X.local_time("published_at"), F.lit(" WIB")), F.when(F.col("title_original").isNotNull(), "terjemahan"),
    )
    more = F.greatest(F.size("also") - n, F.lit(0))
    also = F.when(F.size("also") > 0, F.concat(F.lit('<p class="also">juga: '), F.array_join(F.transform(F.slice("also", 1, n), lambda x: F.concat(F.lit('<a href="'), e(x["url"]), F.lit('">'), e(x["domain"]), F.lit("</a>"))), ", "), F.when(more > 0, F.concat(F.lit(" +"), more.cast("string"), F.lit(" lagi"))).otherwise(""), F.lit("</p>")))
    summary = _opt(F.col("summary"), lambda s: F.concat(F.lit("<p>"), e(X.dateline_free(s)), F.lit("</p>")))
    reason = _opt(F.col("reason"), lambda r: F.concat(F.lit("<em>"), e(r), F.lit("</em>")))
    image = _opt(F.col("image"), lambda i: F.concat(F.lit('<img src="'), e(i), F.lit('" alt="" loading="lazy">')))
    lead = (F.col("rank") == 1) | (F.col("section") == V.TOP_SECTION)
    body = F.concat_ws("", F.lit("<h3>"), link, F.lit("</h3>"), F.lit('<p class="meta">'), meta, F.lit("</p>"), reason, summary, also)
    return F.when(lead, F.concat_ws("", F.lit('<article class="card">'), image, body, F.lit("</article>"))).otherwise(F.concat_ws("", F.lit('<article class="item"><span>'), F.lpad(F.col("rank").cast("string"), 2, "0"), F.lit("</span>"), body, F.lit("</article>")))


def pages(shown: DataFrame, totals: DataFrame) -> DataFrame:
    """``edition, html, n_shown`` for each edition of displayed events."""
    if "title_original" not in shown.columns:
        shown = shown.withColumn("title_original", F.lit(None).cast("string"))
    number = F.create_map(*(F.lit(x) for i, k in enumerate(V.SECTIONS) for x in (k, i)))
    head = F.create_map(*(F.lit(x) for k, v in V.SECTIONS.items() for x in (k, v[0])))
    note = F.create_map(*(F.lit(x) for k, v in V.SECTIONS.items() for x in (k, v[1])))
    items = shown.select("edition", "section", "rank", item_html().alias("item"))
    parts = items.groupBy("edition", "section").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "item"))), lambda x: x["item"]), "\n").alias("body"), F.count(F.lit(1)).alias("n"))
    block = F.concat(F.lit('<section id="'), F.col("section"), F.lit('"><h2>'), X.escape_html(head[F.col("section")]), F.lit("</h2><p>"), X.escape_html(note[F.col("section")]), F.lit("</p>\n"), F.col("body"), F.lit("\n</section>"))
    nav = F.concat(F.lit('<a href="#'), F.col("section"), F.lit('">'), X.escape_html(head[F.col("section")]), F.lit(" ("), F.col("n").cast("string"), F.lit(")</a>"))
    whole = parts.select("edition", "n", number[F.col("section")].alias("o"), block.alias("block"), nav.alias("nav")).groupBy("edition").agg(F.array_sort(F.collect_list(F.struct("o", "nav", "block"))).alias("s"), F.sum("n").alias("n_shown"))
    dates = whole.select(F.date_add("edition", 1).alias("edition"), F.lit(True).alias("has_previous"))
    j = whole.join(totals, "edition", "left").join(dates, "edition", "left")
    before = F.when(F.col("has_previous"), F.concat(F.lit('<a href="arsip/'), F.date_sub("edition", 1).cast("string"), F.lit('.html">Edisi sebelumnya</a>')))
    join = lambda k, sep: F.array_join(F.transform("s", lambda x: x[k]), sep)
    html = F.concat_ws(
        "\n", F.lit('<!doctype html><html lang="id"><head><meta charset="utf-8"><title>'), X.long_date("edition"), F.lit("</title></head><body><h1>"), X.long_date("edition"), F.lit("</h1><p>"),
        F.concat(F.coalesce(F.col("n_articles"), F.lit(0)).cast("string"), F.lit(" artikel, "), F.coalesce(F.col("n_sources"), F.lit(0)).cast("string"), F.lit(" sumber</p>")), F.lit('<a href="arsip/index.html">Arsip</a>'), before, F.lit("<nav>"), join("nav", " "), F.lit("</nav>"), join("block", "\n"), F.lit("</body></html>"),
    )
    return j.select("edition", html.alias("html"), "n_shown")


def archive_form(html: str | Column) -> Column:
    """A page as it stands inside the archive folder."""
    return F.replace(F.col(html) if isinstance(html, str) else html, F.lit('href="arsip/'), F.lit('href="'))


def write_pages(made: DataFrame, path: str) -> None:
    """Archive pages and the newest as index, as text files per edition."""
    made.select(F.col("edition").cast("string").alias("page"), archive_form("html").alias("value")).write.mode("overwrite").partitionBy("page").text(f"{path}/arsip")
    made.orderBy(F.desc("edition")).limit(1).select(F.col("html").alias("value")).write.mode("overwrite").text(f"{path}/index")


# -- calendar ----------------------------------------------------------------------------------


def edition_dates(names: DataFrame) -> DataFrame:
    """Dates of archive file names (``name``); names that are no date are skipped."""
    return names.select(F.try_to_date(F.regexp_extract("name", r"(?:^|/)(\d{4}-\d{2}-\d{2})\.html$", 1), "yyyy-MM-dd").alias("day")).where("day is not null").distinct()


def calendar_grid(days: DataFrame) -> DataFrame:
    """``month, day, week, weekday, state`` for each cell of each month that has an edition, Monday first;
    state: blank (another month's day), none, edition, newest."""
    months = days.select(F.trunc("day", "month").alias("month")).distinct()
    first = F.date_sub("month", F.weekday("month"))
    last = F.last_day("month")
    cells = months.select("month", F.explode(F.sequence(first, F.date_add(last, 6 - F.weekday(last)))).alias("day"))
    have = days.select("day", F.lit(True).alias("has")).crossJoin(F.broadcast(days.agg(F.max("day").alias("newest"))))  # one row
    state = F.when(F.trunc("day", "month") != F.col("month"), "blank").when(F.col("has").isNull(), "none").when(F.col("day") == F.col("newest"), "newest").otherwise("edition")
    return cells.join(have, "day", "left").select("month", "day", F.floor(F.datediff("day", first) / 7).cast("int").alias("week"), F.weekday("day").alias("weekday"), state.alias("state"))


def shortcuts(days: DataFrame) -> DataFrame:
    """Editions a few days before the newest, where they exist."""
    offsets = F.array(*(F.struct(F.lit(n).alias("n"), F.lit(label).alias("label")) for n, label in V.SHORTCUTS))
    wanted = days.agg(F.max("day").alias("newest")).select(F.explode(offsets).alias("o"), "newest").select("o.n", "o.label", F.date_sub("newest", F.col("o.n")).alias("day"))
    return wanted.join(days, "day", "left_semi").select(F.col("n").alias("days_back"), "label", "day")


def editions_per_month(days: DataFrame) -> DataFrame:
    return days.groupBy(F.trunc("day", "month").alias("month")).agg(F.count(F.lit(1)).alias("n_editions"), F.min("day").alias("first_day"), F.max("day").alias("last_day")).orderBy(F.desc("month"))


def calendar_page(days: DataFrame) -> DataFrame:
    """The whole calendar as one row."""
    g = calendar_grid(days)
    cell = F.when(F.col("state") == "blank", "<td></td>").when(F.col("state") == "none", F.concat(F.lit("<td>"), F.dayofmonth("day").cast("string"), F.lit("</td>"))).otherwise(F.concat(F.lit("<td"), F.when(F.col("state") == "newest", ' class="newest"').otherwise(""), F.lit('><a href="'), F.col("day").cast("string"), F.lit('.html">'), F.dayofmonth("day").cast("string"), F.lit("</a></td>")))
    weeks = g.groupBy("month", "week").agg(F.concat(F.lit("<tr>"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("weekday", cell.alias("c")))), lambda x: x["c"]), ""), F.lit("</tr>")).alias("row"))
    title = F.concat(F.element_at(F.array(*map(F.lit, V.MONTHS)), F.month("month")), F.lit(" "), F.year("month").cast("string"))
    head = "<tr>" + "".join(f'<th abbr="{d}">{s}</th>' for s, d in zip(V.SHORT_DAYS, V.DAYS, strict=True)) + "</tr>"
    tables = weeks.groupBy("month").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("week", "row"))), lambda x: x["row"]), "\n").alias("rows")).select("month", F.concat(F.lit("<h2>"), title, F.lit("</h2><table>" + head), F.col("rows"), F.lit("</table>")).alias("t"))
    body = tables.agg(F.array_join(F.transform(F.reverse(F.array_sort(F.collect_list(F.struct("month", "t")))), lambda x: x["t"]), "\n").alias("body"))
    links = shortcuts(days).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("days_back", "label", "day"))), lambda x: F.concat(F.lit('<a href="'), x["day"].cast("string"), F.lit('.html">'), x["label"], F.lit("</a>"))), " ").alias("links"))
    return body.crossJoin(links).select(F.concat_ws("\n", F.lit('<!doctype html><html lang="id"><body><h1>Arsip</h1><p>'), "links", F.lit("</p>"), "body", F.lit("</body></html>")).alias("html"))


# -- messages ----------------------------------------------------------------------------------


def split_message(text: str, limit: int = MESSAGE_LIMIT) -> list[str]:
    """Parts of at most ``limit`` characters, cut at line ends, marked (i/n); long lines are cut hard."""
    if len(text) <= limit:
        return [text]
    room, parts, now = limit - 16, [], ""
    for line in text.split("\n"):
        while len(line) > room:
            if now:
                parts.append(now)
                now = ""
            parts.append(line[:room])
            line = line[room:]
        if now and len(now) + 1 + len(line) > room:
            parts.append(now)
            now = line
        else:
            now = f"{now}\n{line}" if now else line
    parts += [now] if now else []
    return [f"({i}/{len(parts)})\n{p}" for i, p in enumerate(parts, 1)]


def register_message_splitter(spark: SparkSession, name: str = "split_message") -> None:
    """A table function ``split_message(text, most)`` of ``part, n_parts, body``."""
    from pyspark.sql.functions import udtf

    class Splitter:
        def eval(self, text: str, most: int):
            got = split_message(text or "", most)
            for i, p in enumerate(got, 1):
                yield i, len(got), p

    spark.udtf.register(name, udtf(Splitter, returnType="part int, n_parts int, body string"))


def retry_after(reply: str | Column) -> Column:
    """Seconds to wait after a 429, at most 30; null where the reply does not say."""
    return F.least(F.get_json_object(reply, "$.parameters.retry_after").try_cast("double"), F.lit(30.0))


def notify(text: str, send: Callable[[str], tuple[int, str]] | None, show: Callable[[str], None] = print, sleep: Callable[[float], None] = lambda s: None, tries: int = 3) -> bool:
    """Send a text in parts; without a channel, or when it fails, show it. Never raises."""
    import json

    if send is None:
        show(text)
        return False
    for part in split_message(text):
        for attempt in range(tries):
            try:
                status, body = send(part)
            except Exception:  # noqa: BLE001  a channel's failure is not the job's
                status, body = 599, ""
            if status == 200:
                break
            try:
                wait = min(float(json.loads(body)["parameters"]["retry_after"]), 30.0)
            except (ValueError, KeyError, TypeError):
                wait = float(2**attempt)
            sleep(wait)
        else:
            show(part)
            return False
    return True


def failure_text(kind: str, source: str | Column, message: str | Column, run_id: str | Column) -> Column:
    """A row's operations message."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.concat_ws("\n", F.concat(F.lit(f"[{kind}] "), c(source)), c(message), F.concat(F.lit("run: "), c(run_id)))

