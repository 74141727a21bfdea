"""Connected components by repeated contraction, with DataFrame operations only.

Each round points every node at the smallest node of its closed neighbourhood (in a hashed order,
so that long paths contract by a constant share), renames both ends of all edges and drops loops
and repeats. The graph shrinks geometrically; no round gathers the neighbours of a node in one
place: ``min`` combines before the shuffle, and the edges of a node with very many of them stay where
they are when they are renamed. Every round is written to the shared folder, so a lost executor
repeats one round at most. What is left when ``LAST_EDGES`` edges are, one task settles. Names are then carried back from the last round to the first; what is no
longer read is deleted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from dawnpress.plans.lineage import cut, drop
from dawnpress.plans.skew import hot_keys, join_spread

MAX_ROUNDS = 200
#: So many edges (16 MB) are settled by one task.
LAST_EDGES = 1 << 20


def _settled(edges: DataFrame) -> DataFrame:
    """``u, p``: each node with the smallest node that it reaches, by a single task."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))  # the caller has counted edges
        ends = np.concatenate([table.column(k).to_numpy() for k in ("u", "v")])
        nodes, at = np.unique(ends, return_inverse=True)
        a, b = np.split(at, 2)
        label = np.arange(len(nodes))
        while True:
            x, y = label[a], label[b]
            if np.array_equal(x, y):
                break
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))  # a root joins a smaller one
            while not np.array_equal(up := label[label], label):
                label = up
        kind = pa_schema.field("u").type
        yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array(nodes[label], kind)], ["u", "p"])

    pa_schema = to_arrow_schema(edges.schema)
    kind = edges.schema["u"].dataType.simpleString()
    return edges.coalesce(1).mapInArrow(settle, f"u {kind}, p {kind}")


def connected_components(edges: DataFrame, src: str = "u", dst: str = "v") -> DataFrame:
    """``(node, component)`` for each node that has an edge; ``component`` is its smallest node.

    Loops and repeated edges are allowed; edges with a null end are ignored; an empty table gives
    an empty result.
    """
    pairs = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null")
    given, rounds = cut(pairs.distinct(), "edges"), []  # what finds the pairs runs once
    spark = given.sparkSession
    single = cut(given.where("u = v").select(F.col("u").alias("node")), "loops")
    current = given.where("u <> v")
    while n := current.count():
        if n <= LAST_EDGES:
            rounds.append(cut(_settled(current), "parents"))
            break
        if len(rounds) == MAX_ROUNDS:
            raise RuntimeError("components did not settle")
        order = lambda c, r=len(rounds) // 2: F.struct(F.xxhash64(F.lit(r), F.col(c)).alias("h"), F.col(c).alias("x"))
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        best = both.groupBy("u").agg(F.min(order("v")).alias("m"), F.count(F.lit(1)).alias("n"))
        parents = cut(best.select("u", F.least("m", order("u"))["x"].alias("p"), "n"), "parents")
        hot = hot_keys(parents, ["u"])
        pu, pv = (parents.select(F.col("u").alias(k), F.col("p").alias(f"p{k}")) for k in ("u", "v"))
        moved = join_spread(join_spread(current, pu, ["u"], hot), pv, ["v"], hot).where("pu <> pv")
        after = cut(moved.select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct(), "edges")
        drop(spark, current)
        rounds.append(parents)
        current = after
    drop(spark, current)
    if not rounds:
        return single.select("node", F.col("node").alias("component"))
    # a round's nodes are those of the rounds after it and the ones that they were renamed from
    roots = rounds[-1].select(F.col("u").alias("node"), F.col("p").alias("root"))
    for k, parents in enumerate(reversed(rounds[:-1])):
        up = parents.select(F.col("u").alias("node"), "p")
        hot = hot_keys(up.groupBy("p").agg(F.count(F.lit(1)).alias("n")), ["p"])
        found = cut(join_spread(up, roots.select(F.col("node").alias("p"), "root"), ["p"], hot, "left").select("node", F.coalesce("root", "p").alias("root")), "roots")
        if k:
            drop(spark, roots)
        roots = found
    least = cut(roots.groupBy("root").agg(F.min("node").alias("component"), F.count(F.lit(1)).alias("n")), "least")
    named = join_spread(roots, least.drop("n"), ["root"], hot_keys(least, ["root"])).select("node", "component")
    alone = single.join(roots, "node", "left_anti").select("node", F.col("node").alias("component"))
    out = cut(named.unionByName(alone), "components")
    drop(spark, least, single, *rounds, *([roots] if len(rounds) > 1 else []))
    return out
