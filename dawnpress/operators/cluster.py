"""Clustering of titles: blocked similarity join on rare tokens, verification, connected components.

Everything is keyed by ``group`` (an edition), so many editions are clustered in one plan and the
document frequencies, the rarity limit and the hot-token cut are each edition's own.

There are two joins. In :func:`linked` a token with more than ``HOT_TOKEN`` titles makes no candidates, so that titles which
share only such tokens are never compared. :func:`set_links` has no such cut and finds every pair that links: titles with
the same tokens are one set, and of each set only the tokens have to meet without which it cannot link (its prefix,
rarest tokens first), however many titles have them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dawnpress.functions import fixed_values as V
from dawnpress.functions.text import title_tokens
from dawnpress.plans.components import connected_components
from dawnpress.plans.lineage import cut
from dawnpress.plans.skew import hot_keys, join_spread


def tokenise(articles: DataFrame, group: str = "edition") -> DataFrame:
    """``group, article_id, tokens``."""
    return articles.select(F.col(group).alias("grp"), "article_id", title_tokens("title").alias("tokens"))


def token_frequency(tokens: DataFrame) -> DataFrame:
    return tokens.select("grp", F.explode("tokens").alias("token")).groupBy("grp", "token").agg(F.count(F.lit(1)).alias("df"))


def rarity(tokens: DataFrame) -> DataFrame:
    n = tokens.groupBy("grp").agg(F.count(F.lit(1)).alias("n_titles"))
    return n.withColumn("rare_cut", F.greatest(F.lit(V.RARE_LEAST), F.floor(F.col("n_titles") * V.RARE_SHARE)).cast("long"))


def candidate_pairs(tokens: DataFrame, df: DataFrame) -> DataFrame:
    """``grp, a, b`` (a < b) for titles of enough tokens that share a token which is not hot."""
    ok = tokens.where(F.size("tokens") >= V.LEAST_TOKENS).select("grp", "article_id", F.explode("tokens").alias("token"))
    blocks = ok.join(df.where((F.col("df") <= V.HOT_TOKEN) & (F.col("df") > 1)).select("grp", "token"), ["grp", "token"])
    left, right = blocks.withColumnRenamed("article_id", "a"), blocks.withColumnRenamed("article_id", "b")
    return left.join(right, ["grp", "token"]).where("a < b").select("grp", "a", "b").distinct()


#: 64-bit words of a title's bitmap.
WORDS = 8


def bitmap(number: Column) -> list[Column]:
    """Aggregates ``w0, w1..``: a bitmap of 64-bit hashes."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(number, 8).bitwiseAND(F.lit(63)).cast("int"))
    return [F.bit_or(F.when(F.shiftright(number, 1).bitwiseAND(F.lit(WORDS - 1)) == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"w{k}") for k in range(WORDS)]


def alone(x: str, y: str) -> Column:
    """How many bits of the bitmap with suffix ``x`` are not in that with ``y``: so many tokens at least are not shared."""
    bits = [F.bit_count(F.col(f"w{k}{x}").bitwiseAND(F.bitwise_not(F.col(f"w{k}{y}")))) for k in range(WORDS)]
    return sum(bits[1:], bits[0])


def marked_tokens(tokens: DataFrame, df: DataFrame, rare_cut: DataFrame, *flags: str) -> DataFrame:
    """``grp, article_id, n, cold, hot, w0, w1..``: each title's shared tokens (two titles have them at least) with
    whether they are rare, apart by whether they make candidates; ``n`` counts all its tokens. The words are a
    bitmap of the hashes of the shared tokens."""
    each = tokens.select("grp", "article_id", F.size("tokens").alias("n"), *flags, F.explode("tokens").alias("token"))
    known = each.join(df.where("df > 1"), ["grp", "token"]).join(F.broadcast(rare_cut), "grp")
    rare, hot = F.col("df") <= F.col("rare_cut"), F.col("df") > V.HOT_TOKEN
    number = F.xxhash64("token").bitwiseAND(F.lit(-2)).bitwiseOR(rare.cast("long"))
    return known.groupBy("grp", "article_id", "n", *flags).agg(  # nulls are left out of a list
        F.collect_list(F.when(~hot, F.struct("token", rare.alias("rare")))).alias("cold"), F.collect_list(F.when(hot, number)).alias("hot"),
        *bitmap(number),
    )


def linked(marked: DataFrame, threshold: float, wanted: Column | None = None, *flags: str) -> DataFrame:
    """``grp, a, b, jaccard, overlap, rare`` for the pairs that link, out of :func:`marked_tokens`. Where two titles meet
    their bitmaps bound from above how many tokens they share (a bit of one title alone is a token of it alone), so
    that a pair that cannot link is never sent on. Shared tokens of the others are counted; only a pair
    that its hot tokens can still decide looks at them. ``wanted`` says by the flags of both sides
    (``xa`` and ``xb``) which pairs are looked at."""
    rare_ones = lambda x: F.size(F.filter(x, lambda h: h.bitwiseAND(F.lit(1)) == 1))
    rows = marked.where(F.col("n") >= V.LEAST_TOKENS)
    words = [f"w{k}" for k in range(WORDS)]
    rare_cold = F.size(F.filter("cold", lambda x: x["rare"]))
    blocks = rows.select("grp", "article_id", "n", *flags, F.size("hot").alias("h"), rare_ones("hot").alias("rh"), F.size("cold").alias("c"), rare_cold.alias("rc"), *words, F.explode("cold").alias("t"))
    # both sides have the same columns, so they are shuffled once
    side = lambda k: blocks.select("grp", F.col("t.token").alias("token"), F.col("t.rare").alias(f"rare{k}"), F.col("article_id").alias(k), *(F.col(c).alias(f"{c}{k}") for c in ("n", "h", "rh", "c", "rc", *words, *flags)))
    meet = side("a").join(side("b"), ["grp", "token"]).where("a < b")
    if wanted is not None:
        meet = meet.where(wanted)
    most = F.least(F.col("ca") + F.col("ha") - alone("a", "b"), F.col("cb") + F.col("hb") - alone("b", "a"))

    def links(s: Column, r: Column) -> Column:
        return (s / (F.col("na") + F.col("nb") - s) >= threshold) | ((r >= V.RARE_SHARED) & (s / F.least("na", "nb") >= V.RARE_OVERLAP))

    # the least of shared tokens with which `links` can hold, a little below it; the bound stands in the filter once, as long code is not compiled
    enough_rare = F.least(F.col("rca") + F.col("rha"), F.col("rcb") + F.col("rhb")) >= V.RARE_SHARED
    least = F.least(F.lit(threshold / (1 + threshold)) * (F.col("na") + F.col("nb")), F.when(enough_rare, V.RARE_OVERLAP * F.least("na", "nb"))) - F.lit(1e-6)
    meet = meet.where(most >= least)
    pairs = meet.groupBy("grp", "a", "b", "na", "nb", "ha", "hb", "rha", "rhb").agg(F.count(F.lit(1)).alias("s"), F.count_if("rarea").alias("r"))
    more = F.least("ha", "hb")
    open_pairs = pairs.where(links(F.col("s") + more, F.col("r") + F.least("rha", "rhb")))
    few = lambda k: rows.where(F.size("hot") > 0).select("grp", F.col("article_id").alias(k), F.col("hot").alias(f"hot{k}"))
    looked = open_pairs.where(more > 0).join(few("a"), ["grp", "a"]).join(few("b"), ["grp", "b"]).withColumn("both", F.array_intersect("hota", "hotb"))
    looked = looked.select(*open_pairs.columns[:9], (F.col("s") + F.size("both")).alias("s"), (F.col("r") + rare_ones("both")).alias("r"))
    found = open_pairs.where(more == 0).unionByName(looked).where(links(F.col("s"), F.col("r")))
    return found.select("grp", "a", "b", (F.col("s") / (F.col("na") + F.col("nb") - F.col("s"))).alias("jaccard"), (F.col("s") / F.least("na", "nb")).alias("overlap"), F.col("r").cast("int").alias("rare"))


def similar_pairs(tokens: DataFrame, threshold: float = V.THRESHOLD) -> DataFrame:
    """``grp, a, b, jaccard, overlap, rare`` for the pairs that link. Titles are split once and written."""
    tokens = cut(tokens, "tokens")
    return linked(cut(marked_tokens(tokens, token_frequency(tokens), rarity(tokens)), "marked"), threshold)


#: So many sets of one token meet in one place; a token with more of them is dealt by pairs of parts.
PART = 1000
#: For copies with a few words changed: minima of hashes, by which sets that are likely alike find a common neighbour.
BANDS, ROWS = 8, 2
#: So many articles of a set are listed in one row when its pairs are written out.
LISTED = 256


def title_sets(tokens: DataFrame) -> DataFrame:
    """``grp, first, words, n, k``: each set of tokens with its smallest article and how many titles have it."""
    each = tokens.where("grp is not null and article_id is not null").where(F.size("tokens") > 0).select("grp", "article_id", F.array_sort("tokens").alias("words"))
    return each.groupBy("grp", "words").agg(F.min("article_id").alias("first"), F.count(F.lit(1)).alias("k")).withColumn("n", F.size("words"))


def copies(tokens: DataFrame, sets: DataFrame) -> DataFrame:
    """``grp, first, article_id``: the titles of sets that several titles of enough tokens have."""
    many = sets.where((F.col("k") > 1) & (F.col("n") >= V.LEAST_TOKENS))
    each = tokens.where(F.size("tokens") >= V.LEAST_TOKENS).select("grp", F.array_sort("tokens").alias("words"), "article_id")
    return join_spread(each, many.select("grp", "words", "first"), ["grp", "words"], hot_keys(many.select("grp", "words", "k"), ["grp", "words"], "k")).select("grp", "first", "article_id")


def marked_sets(sets: DataFrame, rare_cut: DataFrame, threshold: float) -> DataFrame:
    """``grp, first, k, n, rare, shared, rc, met, w0, w1..`` of the sets of enough tokens. ``shared`` are the numbers of the tokens
    that another set has too, odd where they are rare; ``rc`` and ``rare`` count the rare ones of them and of all.
    ``met`` are those by which the set is found, as structs of how many sets have it and its number.

    Tokens are in one order in all sets of a group: those of few sets first. Sets with a Jaccard similarity of ``t`` share
    ``t * n`` tokens at least, so that the first token which they share is no later than ``n - ceil(t * n)`` in either;
    of three or more shared rare tokens, the first is before the last two rare ones of either."""
    each = sets.select("grp", "first", "k", "n", F.explode("words").alias("token"))
    df = each.groupBy("grp", "token").agg(F.sum("k").alias("df"), F.count_if(F.col("n") >= V.LEAST_TOKENS).alias("sets"))
    known = each.where(F.col("n") >= V.LEAST_TOKENS).join(df, ["grp", "token"]).join(F.broadcast(rare_cut), "grp")
    rare, several = F.col("df") <= F.col("rare_cut"), F.col("sets") > 1
    number = F.xxhash64("token").bitwiseAND(F.lit(-2)).bitwiseOR(rare.cast("long"))
    found = known.groupBy("grp", "first", "k", "n").agg(
        F.count_if(rare).alias("rare"), F.array_sort(F.collect_list(F.when(several, F.struct("sets", number.alias("x"))))).alias("s"), *bitmap(F.when(several, number)),
    )
    rare_ones = F.filter("s", lambda t: t["x"].bitwiseAND(F.lit(1)) == 1)
    head = lambda c, n: F.slice(c, F.lit(1), F.greatest(n.cast("int"), F.lit(0)))
    most = F.size("s") - F.ceil(F.col("n") * threshold - F.lit(1e-6)) + 1  # tokens that no other set has come first
    return found.select(
        "grp", "first", "k", "n", "rare", F.transform("s", lambda t: t["x"]).alias("shared"), F.size(rare_ones).alias("rc"),
        F.array_union(head(F.col("s"), most), head(rare_ones, F.size(rare_ones) - (V.RARE_SHARED - 1))).alias("met"), *(f"w{k}" for k in range(WORDS)),
    )


def _links(s: Column, r: Column, threshold: float) -> Column:
    return (s / (F.col("na") + F.col("nb") - s) >= threshold) | ((r >= V.RARE_SHARED) & (s / F.least("na", "nb") >= V.RARE_OVERLAP))


def _verified(pairs: DataFrame, marked: DataFrame, threshold: float) -> DataFrame:
    """Those of ``pairs(grp, a, b)`` that link, with ``jaccard, overlap, rare``."""
    side = lambda k: marked.select("grp", F.col("first").alias(k), F.col("n").alias(f"n{k}"), F.col("shared").alias(f"shared{k}"))
    both = pairs.join(side("a"), ["grp", "a"]).join(side("b"), ["grp", "b"]).select("grp", "a", "b", "na", "nb", F.array_intersect("shareda", "sharedb").alias("both"))
    counted = both.select("grp", "a", "b", "na", "nb", F.size("both").alias("s"), F.size(F.filter("both", lambda h: h.bitwiseAND(F.lit(1)) == 1)).alias("r"))
    return counted.where(_links(F.col("s"), F.col("r"), threshold)).select(
        "grp", "a", "b", (F.col("s") / (F.col("na") + F.col("nb") - F.col("s"))).alias("jaccard"), (F.col("s") / F.least("na", "nb")).alias("overlap"), F.col("r").alias("rare")
    )


def set_links(marked: DataFrame, threshold: float) -> DataFrame:
    """``grp, a, b, jaccard, overlap, rare`` for all pairs of sets (named by their first articles, a < b) that link, out of
    :func:`marked_sets`. Where it has a column ``own``, pairs with the same are left out."""
    words = [f"w{k}" for k in range(WORDS)]
    own = [c for c in ("own",) if c in marked.columns]
    each = marked.select("grp", "first", "n", F.size("shared").alias("c"), "rc", *words, *own, F.explode("met").alias("t"))
    # each two parts of a token's sets meet in one place, and so does each part with itself
    parts = F.ceil(F.col("t.sets") / PART)
    dealt = each.withColumn("part", F.pmod(F.xxhash64("first"), parts)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    known = ["n", "c", "rc", "part", *words, *own]
    keys = ["grp", "token", "low", "high"]
    side = lambda k: dealt.select("grp", F.col("t.x").alias("token"), F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), F.col("first").alias(k), *(F.col(x).alias(f"{x}{k}") for x in known))
    meet = side("a").join(side("b"), keys).where("a < b and (low = high or parta <> partb)")
    if own:
        meet = meet.where("owna <> ownb")
    most = F.least(F.col("ca") - alone("a", "b"), F.col("cb") - alone("b", "a"))
    least = F.least(F.lit(threshold / (1 + threshold)) * (F.col("na") + F.col("nb")), F.when(F.least("rca", "rcb") >= V.RARE_SHARED, V.RARE_OVERLAP * F.least("na", "nb"))) - F.lit(1e-6)
    return _verified(meet.where(most >= least).select("grp", "a", "b").distinct(), marked, threshold)


def _neighbours(marked: DataFrame, threshold: float) -> DataFrame:
    """``grp, a, b`` for some of the pairs that link: of the sets with the same minima of hashes, each with the smallest."""
    least = lambda k: F.array_min(F.transform("shared", lambda x: F.xxhash64(F.lit(k), x)))
    bands = F.array(*(F.xxhash64(F.lit(b), *(least(b * ROWS + r) for r in range(ROWS))) for b in range(BANDS)))
    keys = marked.where(F.size("shared") > 0).select("grp", "first", F.explode(bands).alias("band"))
    heads = keys.groupBy("grp", "band").agg(F.min("first").alias("a"), F.count(F.lit(1)).alias("m")).where("m > 1")
    pairs = join_spread(keys, heads.drop("m"), ["grp", "band"], hot_keys(heads.select("grp", "band", "m"), ["grp", "band"], "m")).where("a < first")
    return _verified(pairs.select("grp", "a", F.col("first").alias("b")).distinct(), marked, threshold).select("grp", "a", "b")


def _marked(tokens: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    sets = cut(title_sets(tokens), "sets")
    return sets, cut(marked_sets(sets, rarity(tokens).drop("n_titles"), threshold), "marked")


def all_pairs(tokens: DataFrame, threshold: float = V.THRESHOLD) -> DataFrame:
    """As :func:`similar_pairs`, for every pair that links, however frequent the tokens are that it shares. Pairs of sets
    are found first, then written out for the titles that have them: lists of titles are dealt to all tasks."""
    tokens = cut(tokens, "tokens")
    sets, marked = _marked(tokens, threshold)
    same = marked.where("k > 1").select("grp", F.col("first").alias("a"), F.col("first").alias("b"), F.lit(1.0).alias("jaccard"), F.lit(1.0).alias("overlap"), F.col("rare").cast("int").alias("rare"))
    links = cut(set_links(marked, threshold).unionByName(same), "links")
    listed = copies(tokens, sets).join(sets.where("k > 1").select("grp", "first", F.ceil(F.col("k") / LISTED).alias("lists")), ["grp", "first"])
    lists = cut(listed.groupBy("grp", "first", F.pmod(F.xxhash64("article_id"), F.col("lists")).alias("list")).agg(F.collect_list("article_id").alias("ids")), "lists")
    of = lambda k: lists.select("grp", F.col("first").alias(k), F.col("ids").alias(f"ids{k}"))
    wide = links.join(of("a"), ["grp", "a"], "left").join(of("b"), ["grp", "b"], "left")
    one = wide.where("idsa is null and idsb is null").select("grp", "a", "b", "jaccard", "overlap", "rare")
    tasks = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # named, as few lists make many pairs and would else be put together
    several = wide.where("idsa is not null or idsb is not null").repartition(tasks, F.xxhash64("a", "b", "idsa", "idsb"))
    each = several.select("grp", F.col("a").alias("fa"), F.col("b").alias("fb"), F.explode(F.coalesce("idsa", F.array("a"))).alias("x"), F.coalesce("idsb", F.array("b")).alias("idsb"), "jaccard", "overlap", "rare")
    each = each.select("grp", "fa", "fb", "x", F.explode("idsb").alias("y"), "jaccard", "overlap", "rare").where("x < y or fa <> fb")
    return one.unionByName(each.select("grp", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "jaccard", "overlap", "rare"))


def joining_pairs(tokens: DataFrame, threshold: float = V.THRESHOLD) -> DataFrame:
    """``a, b``: pairs that link, enough of them that whatever :func:`all_pairs` joins is joined. Copies are linked to the
    first of their set. Sets that a common neighbour joins are not compared with one another, all others are."""
    tokens = cut(tokens, "tokens")
    sets, marked = _marked(tokens, threshold)
    near = cut(_neighbours(marked, threshold), "near")
    own = connected_components(near, "a", "b").withColumnRenamed("node", "first").withColumnRenamed("component", "own")
    apart = cut(marked.join(own, "first", "left").withColumn("own", F.coalesce("own", "first")), "apart")
    found = set_links(apart, threshold).select("a", "b").unionByName(near.select("a", "b"))
    return found.unionByName(copies(tokens, sets).where("first <> article_id").select(F.col("first").alias("a"), F.col("article_id").alias("b")))


def clusters(articles: DataFrame, threshold: float = V.THRESHOLD, group: str = "edition", whole: bool = False) -> DataFrame:
    """``article_id, event_id`` for each article; ``event_id`` is the cluster's smallest article id. ``whole`` without
    the cut of hot tokens."""
    pairs = (joining_pairs if whole else similar_pairs)(tokenise(articles, group), threshold)
    linked = connected_components(pairs, "a", "b")
    return articles.select("article_id").join(linked.withColumnRenamed("node", "article_id"), "article_id", "left").select("article_id", F.coalesce("component", "article_id").alias("event_id"))
