"""Composing editions: window, events, merged AI coverage, scores, routing, sections."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dawnpress.functions import fixed_values as V
from dawnpress.functions import rules
from dawnpress.functions.text import edition_date
from dawnpress.operators.cluster import clusters
from dawnpress.operators.events import events_of
from dawnpress.plans.lineage import cut


def window_bounds(day: date) -> tuple[str, str]:
    """Naive UTC bounds [day-2 22:00, day-1 22:00) of an edition, from its date alone."""
    from datetime import timedelta

    return f"{day - timedelta(days=2)} 22:00:00", f"{day - timedelta(days=1)} 22:00:00"


def in_window(articles: DataFrame, day: date) -> DataFrame:
    """Articles of one edition; a range predicate that reaches the scan. Null times never qualify."""
    low, high = window_bounds(day)
    return articles.where((F.col("published_at") >= F.lit(low).cast("timestamp_ntz")) & (F.col("published_at") < F.lit(high).cast("timestamp_ntz"))).withColumn("edition", F.lit(day))


def with_edition(articles: DataFrame) -> DataFrame:
    """All articles with the edition that each belongs to."""
    return articles.where("published_at is not null").withColumn("edition", edition_date("published_at"))


def with_defaults(articles: DataFrame) -> DataFrame:
    """Language of rows that were stored before it was: by category."""
    return articles.withColumn("lang", F.coalesce("lang", F.when(F.col("category") == "global", "en").otherwise("id"))).withColumn("weight", F.coalesce("weight", F.lit(1.0)))


def merge_ai(events: DataFrame, threshold: float = V.AI_THRESHOLD) -> DataFrame:
    """Second clustering, looser, among the events that the AI section will take."""
    pool = cut(events.where(rules.ai_pool(hits=_hits(events))), "pool")
    groups = clusters(pool.select("edition", F.col("event_id").alias("article_id"), "title"), threshold, whole=True).select(F.col("article_id").alias("event_id"), F.col("event_id").alias("merged"))
    m = pool.join(groups, "event_id")
    lead = F.struct(F.col("n_media"), F.col("published_at"), (-F.col("event_id")).alias("i"))
    heads = m.groupBy("edition", "merged").agg(F.max_by("event_id", lead).alias("head"), F.max("weight").alias("weight"), F.sum("n_articles").alias("n_articles"), F.count(F.lit(1)).alias("n")).where("n > 1")
    links = (
        m.join(heads.select("edition", "merged", "head"), ["edition", "merged"])
        .select("head", F.struct("n_media", "published_at", (-F.col("event_id")).alias("i")).alias("o"), F.explode(F.concat(F.array(F.struct("domain", "url", F.lit(1).alias("own"))), F.transform("also", lambda x: F.struct(x["domain"].alias("domain"), x["url"].alias("url"), F.lit(0).alias("own"))))).alias("l"))
        .groupBy("head", "l.domain").agg(F.max_by("l.url", F.struct("o", "l.own")).alias("url"))
        .groupBy("head").agg(F.array_sort(F.collect_list(F.struct("domain", "url"))).alias("links"))
    )
    change = heads.select("head", F.col("weight").alias("__weight"), F.col("n_articles").alias("__n")).join(links, "head")
    absorbed = m.join(heads.select("edition", "merged", "head"), ["edition", "merged"]).where("event_id <> head").select("event_id")
    kept = events.join(absorbed, "event_id", "left_anti").join(change, F.col("event_id") == F.col("head"), "left")
    merged = F.col("head").isNotNull()
    return kept.select(
        *(F.col(c) for c in events.columns if c not in ("weight", "also", "n_media", "n_articles")),
        F.coalesce("__weight", "weight").alias("weight"), F.coalesce("__n", "n_articles").alias("n_articles"),
        F.when(merged, F.filter("links", lambda x: x["domain"] != F.col("domain"))).otherwise(F.col("also")).alias("also"),
        F.when(merged, F.size("links").cast("long")).otherwise(F.col("n_media")).alias("n_media"),
    )


def with_hits(events: DataFrame) -> DataFrame:
    """Events with the phrases that all rules look at."""
    return events.withColumn("hits", rules.found())


def _hits(events: DataFrame) -> Column | None:
    return F.col("hits") if "hits" in events.columns else None


def score(events: DataFrame) -> DataFrame:
    """Impact, reason and direction."""
    return events.withColumn("__i", rules.impact(hits=_hits(events))).withColumn("__d", rules.direction()).select(
        *events.columns, F.col("__i.impact").alias("impact"), F.col("__i.reason").alias("reason"), F.col("__d.label").alias("sentiment"), F.col("__d.score").alias("direction_score"), F.col("__d.trigger").alias("trigger")
    )


def reroute(events: DataFrame) -> DataFrame:
    """Tax stories to the tax section, then AI stories to the AI section; reasons and impact follow."""
    columns = [c for c in events.columns if c not in ("category", "impact", "reason")]
    t = events.withColumn("__t", rules.tax_class(hits=_hits(events)))
    moves = (F.col("category") == "pajak") | (F.col("__t.is_tax") & F.col("category").isin(V.TAX_MOVES_FROM))
    level = F.when(moves & (F.col("impact") == 1) & ~F.col("__t.regional"), 2).otherwise(F.col("impact"))
    t = t.select(
        *columns, F.when(moves, "pajak").otherwise(F.col("category")).alias("category"), level.alias("impact"),
        F.when(moves & F.col("__t.topic").isNotNull() & (level != 3), F.col("__t.topic")).otherwise(F.col("reason")).alias("reason"), F.when(moves, F.col("__t")).alias("tax"),
    )
    a = t.withColumn("__a", rules.ai_class(hits=_hits(events)))
    moves = (F.col("category") == "ai") | (F.col("category").isin(V.AI_MOVES_FROM) & F.col("__a.is_ai"))
    wide = moves & (F.col("impact") == 3) & (F.col("reason") == V.LABELS["wide"])
    level = F.when(F.coalesce(wide, F.lit(False)), 2).otherwise(F.col("impact"))
    reason = F.when(F.coalesce(wide, F.lit(False)), V.LABELS["wider"]).otherwise(F.col("reason"))
    return a.select(
        *columns, "tax", F.when(moves, "ai").otherwise(F.col("category")).alias("category"), level.alias("impact"),
        F.when(moves & F.col("__a.topic").isNotNull() & (level != 3), F.col("__a.topic")).otherwise(reason).alias("reason"), F.when(moves, F.col("__a")).alias("ai"),
    )


def passes(hits: Column | None = None) -> Column:
    no = lambda c: ~F.coalesce(c, F.lit(False))
    return rules.relevant(hits=hits) & (F.col("impact") != 0) & no(F.col("tax.discard")) & no(F.col("ai.discard") | ~F.col("ai.is_ai"))


def order_keys() -> list[Column]:
    topicless = (F.col("tax").isNotNull() & F.col("tax.topic").isNull()) | (F.col("tax").isNull() & F.col("ai").isNotNull() & F.col("ai.topic").isNull())
    return [F.coalesce(F.col("tax.regional"), F.lit(False)).asc(), F.desc("impact"), (F.col("n_media") * F.col("weight")).desc(), topicless.asc(), F.desc_nulls_last("published_at"), F.asc("event_id")]


def sections(events: DataFrame) -> DataFrame:
    """The displayed events with ``section`` and ``rank``. Events of the top block leave their own section;
    those that overflow it return to theirs. Each ranking is a top-k, which Spark limits before it shuffles."""
    return _ranked(events.where(passes(_hits(events))))


def _ranked(ok: DataFrame) -> DataFrame:
    limits = F.create_map(*(F.lit(x) for kv in V.SECTION_LIMITS.items() for x in kv))
    top = ok.where("impact = 3").withColumn("rank", F.row_number().over(Window.partitionBy("edition").orderBy(*order_keys()))).where(F.col("rank") <= V.TOP_LIMIT).withColumn("section", F.lit(V.TOP_SECTION))
    rest = ok.join(top.select("edition", "event_id"), ["edition", "event_id"], "left_anti").where(F.col("category").isin(list(V.SECTION_LIMITS)))
    rest = rest.withColumn("rank", F.row_number().over(Window.partitionBy("edition", "category").orderBy(*order_keys()))).where(F.col("rank") <= max(V.SECTION_LIMITS.values())).where(F.col("rank") <= limits[F.col("category")]).withColumn("section", F.col("category"))
    return top.unionByName(rest)


def compose(articles: DataFrame, merge: bool = True) -> DataFrame:
    """All editions of ``articles(article_id, url, domain, title, summary, published_at, category, weight,
    image, lang, edition)``: events, merged, scored, routed and ranked. Each step is read more than once
    by the next, so it is written first; texts are looked through once, and what comes of it is written with
    the events, so that a filter that Spark moves below the rules repeats only comparisons of short arrays."""
    events = cut(with_hits(events_of(with_defaults(articles), whole=True)), "events")
    merged = merge_ai(events) if merge else events
    scored = cut(score(merged), "scored")
    return _ranked(cut(reroute(scored).where(passes(F.col("hits"))).drop("hits"), "routed"))


def totals(articles: DataFrame) -> DataFrame:
    return articles.groupBy("edition").agg(F.count_distinct("domain").alias("n_sources"), F.count(F.lit(1)).alias("n_articles"))


def section_counts(shown: DataFrame) -> DataFrame:
    return shown.groupBy("edition", "section").agg(F.count(F.lit(1)).alias("n_shown"))
