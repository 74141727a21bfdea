"""Checks over stored tables, values known on a date, and daily theme figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def known_on(series: DataFrame, day: str | Column, released: str = "release_date", until: str = "valid_until") -> DataFrame:
    """The rows of a bitemporal series that were known on a date."""
    d = F.lit(day).cast("date") if isinstance(day, str) else day
    return series.where((F.col(released) <= d) & (F.col(until).isNull() | (F.col(until) > d)))


def with_validity(series: DataFrame, key: list[str], released: str = "release_date") -> DataFrame:
    """``valid_until``: when the next revision of the same key was released."""
    return series.withColumn("valid_until", F.lead(released).over(Window.partitionBy(*key).orderBy(released)))


def known_at(series: DataFrame, dates: DataFrame, day: str = "day", released: str = "release_date", until: str = "valid_until", width: int = 32, salts: int = 16) -> DataFrame:
    """For each date of ``dates(day)`` the rows of a bitemporal series that were known on it, with the date.

    A range join by buckets of ``width`` days: a row goes to the buckets that its time of validity meets, cut to
    the first and the last date asked for, a date to its own. Rows of a bucket are dealt to ``salts`` tasks, so
    that a time in which very many rows are valid is no task's alone; a date goes to each of them. Null or
    repeated dates count once or not at all; a row without a release date is never known."""
    asked = dates.select(F.col(day).cast("date").alias("__day")).where("__day is not null").distinct()
    span = asked.agg(F.min("__day").alias("low"), F.max("__day").alias("high")).first()
    if span["low"] is None:
        return series.limit(0).select(F.lit(None).cast("date").alias(day), *series.columns)
    low, high = F.lit(span["low"]), F.lit(span["high"])
    number = lambda c: F.floor(F.unix_date(c) / width)
    met = series.withColumn("__from", F.greatest(F.col(released).cast("date"), low)).withColumn("__to", F.least(F.coalesce(F.date_sub(F.col(until).cast("date"), 1), high), high)).where(F.col(released).isNotNull() & (F.col("__from") <= F.col("__to")))
    rows = met.withColumn("__bucket", F.explode(F.sequence(number("__from"), number("__to")))).withColumn("__salt", F.pmod(F.xxhash64(*series.columns), F.lit(salts)).cast("int"))
    days = asked.withColumn("__bucket", number("__day")).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    found = rows.join(days, ["__bucket", "__salt"]).where("__day between __from and __to")
    return found.select(F.col("__day").alias(day), *series.columns)


def reconcile(values: DataFrame, by: list[str], source: str = "source", value: str = "value", tolerance: float = 0.05) -> DataFrame:
    """For each ``by`` how well its sources agree: ``middle`` (the median of their values), ``n_sources``, ``worst`` (the
    largest distance from the middle, as a share of it) and the sources that are further off than
    ``tolerance``. A source's repeated values are averaged first; null values count as missing. One source agrees
    with itself; where the middle is 0 any other value is off."""
    each = values.where(F.col(value).isNotNull()).groupBy(*by, source).agg(F.avg(value).alias("v"))
    # a list of one value for each source
    one = each.groupBy(*by).agg(F.median("v").alias("middle"), F.count(F.lit(1)).alias("n_sources"), F.collect_list(F.struct(F.col(source).alias("source"), F.col("v").alias("v"))).alias("l"))
    off = lambda x: F.when(x["v"] == F.col("middle"), 0.0).when(F.col("middle") == 0, float("inf")).otherwise(F.abs(x["v"] - F.col("middle")) / F.abs("middle"))
    return one.select(
        *by, "middle", "n_sources", F.array_max(F.transform("l", off)).alias("worst"),
        F.array_sort(F.transform(F.filter("l", lambda x: off(x) > tolerance), lambda x: x["source"])).alias("off"),
    )


def _middle(values: Column) -> Column:
    """The median of a short array, null if it is empty."""
    s, n = F.array_sort(values), F.size(values)
    at = lambda k: F.get(s, F.floor(k).cast("int"))
    return (at((n - 1) / 2) + at(n / 2)) / 2


def theme_index(marked: DataFrame, days: int = 28, factor: float = 3.0) -> DataFrame:
    """Daily figures of each theme out of ``marked(day, theme, domain, score)``, a row for each article and theme:
    ``n_articles``, ``n_sources``, ``tone`` (mean score), ``agreement`` (the share of sources on the side that most
    take, by the sum of their scores: up, down or neither), ``usual`` and ``spread`` (median and median absolute
    deviation of the ``days`` rows before) and ``spike`` (over ``usual`` by ``factor`` times 1.4826 ``spread``, and by
    one article at least).

    Articles are summed up by source, then by theme, both before the shuffle; the baseline looks at one row a
    day. A theme's first day has no baseline and is no spike; rows without day or theme are left out; a null
    domain is one source; a null score counts as 0."""
    each = marked.where("day is not null and theme is not null").groupBy("day", "theme", "domain").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("score", F.lit(0))).alias("s"))
    side = lambda c: F.count_if(c)
    one = each.groupBy("day", "theme").agg(
        F.sum("n").alias("n_articles"), F.count(F.lit(1)).alias("n_sources"), (F.sum("s") / F.sum("n")).alias("tone"),
        (F.greatest(side(F.col("s") > 0), side(F.col("s") < 0), side(F.col("s") == 0)) / F.count(F.lit(1))).alias("agreement"),
    )
    before = F.collect_list("n_articles").over(Window.partitionBy("theme").orderBy("day").rowsBetween(-days, -1))  # at most `days` numbers
    known = one.withColumn("before", before).withColumn("usual", _middle(F.col("before"))).withColumn("spread", _middle(F.transform("before", lambda x: F.abs(x - F.col("usual")))))
    over = F.col("n_articles") - F.col("usual")
    return known.withColumn("spike", F.coalesce((over > factor * 1.4826 * F.col("spread")) & (over >= 1), F.lit(False))).drop("before")


def date_gaps(days: DataFrame, column: str, by: list[str]) -> DataFrame:
    """Dates after which the series misses some."""
    return days.select(*by, F.col(column).alias("day")).distinct().withColumn("next_day", F.lead("day").over(Window.partitionBy(*by).orderBy("day"))).where(F.datediff("next_day", "day") > 1).withColumn("n_missing", F.datediff("next_day", "day") - 1)


def range_breaks(df: DataFrame, column: str, by: list[str], order: str, share: float = 0.05) -> DataFrame:
    """Rows whose value leaves the one before by more than ``share``."""
    before = F.lag(column).over(Window.partitionBy(*by).orderBy(order))
    return df.withColumn("before", before).where((F.col("before") != 0) & (F.abs(F.col(column) - F.col("before")) > share * F.abs("before")))


def volume_spikes(counts: DataFrame, by: list[str], day: str, n: str, days: int = 7, factor: float = 2.0) -> DataFrame:
    """Days whose count is over ``factor`` times the mean of the ``days`` before."""
    mean = F.avg(n).over(Window.partitionBy(*by).orderBy(day).rowsBetween(-days, -1))
    return counts.withColumn("usual", mean).where(F.col(n) > factor * F.col("usual"))


def silent_failures(metrics: DataFrame) -> DataFrame:
    """Feeds that answer well but bring nothing."""
    return metrics.groupBy("feed").agg(F.count_if((F.col("status") == "galat") & F.col("note").contains("0 item")).alias("n_silent")).where("n_silent > 0")


def source_status(metrics: DataFrame, down: int = 3) -> DataFrame:
    """Each feed's state after all its runs (``feed, at, status, n_items, note``): runs, the last run and the last good
    one (also one that found nothing new), failures since, items of the last good run with any, the last note, and
    ``level``: ``down`` after ``down`` failures in a row or without any good run, ``warn`` after fewer, else ``ok``.
    Runs without a time are left out."""
    good = F.col("status") != "galat"
    last = F.max(F.when(good, F.col("at"))).over(Window.partitionBy("feed"))
    each = metrics.where("at is not null").withColumn("last_good", last)
    one = each.groupBy("feed").agg(
        F.count(F.lit(1)).alias("n_runs"), F.max("at").alias("last_run"), F.first("last_good").alias("last_good"),
        F.count_if(F.col("last_good").isNull() | (F.col("at") > F.col("last_good"))).alias("n_failed"),
        F.max_by(F.when(F.col("n_items") > 0, F.col("n_items")), F.when(F.col("n_items") > 0, F.col("at"))).alias("last_items"), F.max_by("note", "at").alias("note"),
    )
    level = F.when(F.col("last_good").isNull() | (F.col("n_failed") >= down), "down").when(F.col("n_failed") > 0, "warn").otherwise("ok")
    return one.withColumn("level", level)


def require(df: DataFrame, least: int, columns: list[str]) -> None:
    """Raise if a table is too short or lacks a column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    if df.limit(least).count() < least:
        raise ValueError(f"fewer than {least} rows")
