"""Clusters kept up to date as articles arrive, late ones included.

State is three tables in a folder, each with a partition for every edition: the tokens of titles, the links
between articles, and the cluster of each article. A batch reads and writes the editions that it touches and
no others. After any sequence of batches the tables are what clustering all articles at once gives:

1. New articles change how many titles have a token, and with it which tokens make candidates and which are
   rare. Old articles with a token for which either changes are *moved*.
2. Pairs with a new article and pairs of two moved ones are looked at; the links of all others stay.
3. A cluster that lost a link is taken apart and put together from its links; in all others new links
   only join the names of clusters, so the graph that is settled has as many nodes as the batch has ends.

The order in which tables are written (clusters, links, tokens) makes a batch that was lost on the way, or that
is run again, come to the same end: its articles count as new until their tokens are stored.

Rows without edition or id are not clustered; of repeated ids the first title in order counts, and one that
is stored in the same edition already stays as it is. An article must keep its edition.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dawnpress.functions import fixed_values as V
from dawnpress.operators.cluster import linked, marked_tokens, tokenise
from dawnpress.plans.components import connected_components
from dawnpress.plans.lineage import cut, drop
from dawnpress.sources.store import first_per_key

TABLES = {"tokens": "article_id {id}, tokens array<string>", "edges": "a {id}, b {id}", "clusters": "article_id {id}, event_id {id}"}
#: Tasks that write an edition.
WRITERS = 4


def _rare_cut(n: Column) -> Column:
    return F.greatest(F.lit(V.RARE_LEAST), F.floor(n * V.RARE_SHARE)).cast("long")


class ClusterState:
    """The state in ``path``; ``id_type`` is the type of article ids."""

    def __init__(self, spark: SparkSession, path: str, threshold: float = V.THRESHOLD, id_type: str = "long"):
        self.spark, self.path, self.threshold, self.id_type = spark, path.rstrip("/"), threshold, id_type

    def read(self, table: str, editions: list[date] | None = None) -> DataFrame:
        """A table; only the partitions of ``editions`` if they are named."""
        schema = f"{TABLES[table].format(id=self.id_type)}, grp date"
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.schema(schema).parquet(f"{self.path}/{table}")
        df = df if editions is None else df.where(F.col("grp").isin(editions))
        return df.where("a is not null") if table == "edges" else df

    def _write(self, table: str, df: DataFrame) -> None:
        """Replaces the partitions that ``df`` has rows of."""
        key = F.pmod(F.xxhash64(*[c for c in df.columns if c in ("a", "article_id")]), F.lit(WRITERS))
        df.repartition("grp", key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("grp").parquet(f"{self.path}/{table}")

    def clusters(self) -> DataFrame:
        """``article_id, event_id`` of all articles."""
        return self.read("clusters").select("article_id", "event_id")

    def update(self, articles: DataFrame) -> list[date]:
        """Take in ``articles(article_id, title, edition)``; returns the editions that it touches."""
        came = articles.where("article_id is not null and edition is not null")
        touched = sorted(r[0] for r in came.select("edition").distinct().collect())  # dates of a batch
        if not touched:
            return []
        stored = self.read("tokens", touched)
        first = first_per_key(came, "article_id", F.struct(F.col("title").isNull(), "title")).join(stored.select("article_id"), "article_id", "left_anti")
        fresh = tokenise(first).withColumn("new", F.lit(True))
        everything = cut(stored.select("grp", "article_id", "tokens", F.lit(False).alias("new")).unionByName(fresh), "tokens")
        marked, keep = self._mark(everything)
        wanted = F.col("newa") | F.col("newb") | (F.col("moveda") & F.col("movedb"))
        found = cut(linked(marked, self.threshold, wanted, "new", "moved").select("grp", "a", "b"), "found")
        edges = self.read("edges", touched)
        flags = marked.select("grp", "article_id", "new", "moved")
        side = lambda k: flags.select("grp", F.col("article_id").alias(k), F.col("new").alias(f"new{k}"), F.col("moved").alias(f"moved{k}"))
        known = cut(edges.join(side("a"), ["grp", "a"]).join(side("b"), ["grp", "b"]).withColumn("again", wanted).select("grp", "a", "b", "again"), "known")
        kept, lost = known.where("not again").select("grp", "a", "b"), known.where("again").join(found, ["grp", "a", "b"], "left_anti")
        clusters = cut(self._label(everything, touched, kept, found, lost), "clusters")
        ends = self.spark.createDataFrame([(None, None, d) for d in touched], f"a {self.id_type}, b {self.id_type}, grp date")  # an edition whose last link goes is written too
        links = cut(kept.unionByName(found).unionByName(ends.select("grp", "a", "b")), "links")
        self._write("clusters", clusters)
        self._write("edges", links)
        self._write("tokens", everything.select("article_id", "tokens", "grp"))
        drop(self.spark, everything, found, known, clusters, links, *keep)
        return touched

    def _mark(self, tokens: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
        """:func:`marked_tokens` with whether an article is new or moved; and the tables to delete afterwards."""
        each = tokens.select("grp", "article_id", "new", F.explode("tokens").alias("token"))
        df = cut(each.groupBy("grp", "token").agg(F.count(F.lit(1)).alias("df"), F.count_if(~F.col("new")).alias("old")).where("df > 1"), "df")
        titles = tokens.groupBy("grp").agg(_rare_cut(F.count(F.lit(1))).alias("rare_cut"), _rare_cut(F.count_if(~F.col("new"))).alias("old_cut"))
        hot, rare = (F.col("old") <= V.HOT_TOKEN) != (F.col("df") <= V.HOT_TOKEN), (F.col("old") <= F.col("old_cut")) != (F.col("df") <= F.col("rare_cut"))
        changed = df.where("old > 1").join(F.broadcast(titles), "grp").where(hot | rare).select("grp", "token")
        moved = each.where("not new").join(changed, ["grp", "token"]).select("grp", "article_id").distinct().withColumn("moved", F.lit(True))
        flagged = tokens.join(moved, ["grp", "article_id"], "left").withColumn("moved", F.coalesce("moved", F.lit(False)))
        marked = cut(marked_tokens(flagged, df.drop("old"), titles.drop("old_cut"), "new", "moved"), "marked")
        return marked, [df, marked]

    def _label(self, tokens: DataFrame, touched: list[date], kept: DataFrame, found: DataFrame, lost: DataFrame) -> DataFrame:
        """``article_id, event_id, grp`` of all articles of the touched editions."""
        old = self.read("clusters", touched).select("article_id", "event_id")
        named = tokens.join(old, "article_id", "left").select("grp", "article_id", "new", "event_id")
        # clusters that lost a link: their articles stand for themselves, all others for their cluster
        broken = lost.select(F.explode(F.array("a", "b")).alias("article_id")).distinct().join(old, "article_id").select("event_id").distinct().withColumn("broken", F.lit(True))
        nodes = cut(
            named.join(broken, "event_id", "left")
            .select("grp", "article_id", F.coalesce("broken", F.lit(False)).alias("broken"), F.when(F.col("broken") | F.col("new") | F.col("event_id").isNull(), F.col("article_id")).otherwise(F.col("event_id")).alias("node")), "nodes",
        )
        end = lambda k: nodes.select(F.col("article_id").alias(k), F.col("node").alias(f"n{k}"), F.col("broken").alias(f"broken{k}"))
        inner = kept.join(end("a").where("brokena"), "a").join(end("b"), "b")
        outer = found.join(end("a"), "a").join(end("b"), "b")
        joined = connected_components(inner.select("na", "nb").unionByName(outer.select("na", "nb")), "na", "nb")
        return nodes.join(joined.withColumnRenamed("component", "event_id"), "node", "left").select("article_id", F.coalesce("event_id", "node").alias("event_id"), "grp")
