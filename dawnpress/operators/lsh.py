"""Similar titles by MinHash: an approximate way beside the exact join of :mod:`cluster`, which is the default.

The exact join makes candidates of titles that share a token which is not hot; titles whose only shared tokens
are hot never meet there. Here each title has a signature of ``BANDS * ROWS`` minima of hashes of its tokens, and
titles that agree in a whole band meet, however frequent their tokens are: with Jaccard similarity s the
chance is ``1 - (1 - s ** ROWS) ** BANDS`` (0.99 at the threshold of 0.42). Every pair that meets is
verified by its exact similarity, so no false pair is returned. A bitmap of its tokens goes with a title, so that
most pairs that are not similar are told where they meet and never sent on.

Titles with equal tokens have equal signatures and would all meet: one of them (the smallest id) stands for all,
and the others are linked to it, so that a group of copies costs as many links as it has members.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dawnpress.functions import fixed_values as V
from dawnpress.operators.cluster import WORDS, alone, bitmap
from dawnpress.plans.components import connected_components
from dawnpress.plans.lineage import cut
from dawnpress.plans.skew import hot_keys, join_spread

BANDS, ROWS = 24, 2


def signatures(tokens: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``grp, article_id, bands, n, w0, w1..``: a hash for each band, the number of tokens and their bitmap, of ``tokens(grp, article_id, tokens)``. The minima combine
    before the shuffle."""
    each = tokens.select("grp", "article_id", F.explode("tokens").alias("token"))
    least = each.groupBy("grp", "article_id").agg(*(F.min(F.xxhash64(F.lit(k), "token")).alias(f"m{k}") for k in range(bands * rows)), F.count(F.lit(1)).alias("n"), *bitmap(F.xxhash64("token")))
    return least.select("grp", "article_id", F.array(*(F.xxhash64(F.lit(b), *(f"m{b * rows + r}" for r in range(rows))) for b in range(bands))).alias("bands"), "n", *(f"w{k}" for k in range(WORDS)))


def lsh_pairs(tokens: DataFrame, threshold: float = V.THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``grp, a, b, jaccard`` for titles of enough tokens: copies with the first of them, and other pairs of such
    firsts that are similar."""
    enough = cut(tokens.where(F.size("tokens") >= V.LEAST_TOKENS).withColumn("set", F.xxhash64(F.array_sort("tokens"))), "titles")
    groups = cut(enough.groupBy("grp", "set").agg(F.min("article_id").alias("first"), F.count(F.lit(1)).alias("n")), "sets")
    named = join_spread(enough.select("grp", "set", "article_id"), groups.drop("n"), ["grp", "set"], hot_keys(groups, ["grp", "set"]))
    copies = named.where("article_id <> first").select("grp", F.col("first").alias("a"), F.col("article_id").alias("b"), F.lit(1.0).alias("jaccard"))
    firsts = enough.join(groups.select("grp", F.col("first").alias("article_id")), ["grp", "article_id"], "left_semi").select("grp", "article_id", "tokens")
    known = ["n", *(f"w{k}" for k in range(WORDS))]
    keys = cut(signatures(firsts, bands, rows), "signatures").select("grp", "article_id", *known, F.posexplode("bands").alias("band", "key"))
    side = lambda k: keys.select("grp", "band", "key", F.col("article_id").alias(k), *(F.col(c).alias(f"{c}{k}") for c in known))
    most = F.least(F.col("na") - alone("a", "b"), F.col("nb") - alone("b", "a"))
    fits = most >= F.lit(threshold / (1 + threshold)) * (F.col("na") + F.col("nb")) - F.lit(1e-6)
    met = side("a").join(side("b"), ["grp", "band", "key"]).where("a < b").where(fits).select("grp", "a", "b").distinct()
    text = lambda k: firsts.select("grp", F.col("article_id").alias(k), F.col("tokens").alias(f"t{k}"))
    shared, both = F.size(F.array_intersect("ta", "tb")), F.size("ta") + F.size("tb")
    scored = met.join(text("a"), ["grp", "a"]).join(text("b"), ["grp", "b"]).select("grp", "a", "b", (shared / (both - shared)).alias("jaccard"))
    return scored.where(F.col("jaccard") >= threshold).unionByName(copies)


def lsh_clusters(tokens: DataFrame, threshold: float = V.THRESHOLD) -> DataFrame:
    """``article_id, event_id`` for each article, as :func:`cluster.clusters` returns them."""
    linked = connected_components(lsh_pairs(tokens, threshold), "a", "b")
    return tokens.select("article_id").join(linked.withColumnRenamed("node", "article_id"), "article_id", "left").select("article_id", F.coalesce("component", "article_id").alias("event_id"))
