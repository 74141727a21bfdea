"""Hard negatives by an exact kNN join over Voronoi partitions.

A row's components become whole numbers (``floor(scale * x)``), so scores (inner products) are exact. Rows
are augmented by ``sqrt(M^2 - |x|^2)``, where no row is longer than M. Anchors are stretched by ``t`` to the
length M and augmented by 0: then ``|a' - x'|^2 = 2 M^2 - 2 t (a . x)``, and the highest scores are the
smallest distances.

1. Pivots are fitted on a bounded sample; every row gets the cell of its nearest pivot and its distance to it.
   So do anchors, with pivots of their own; cells of anchors are packed into groups of at most about ``GROUP`` anchors, whatever the
   table's size.
2. Of each cell and label, the number of rows and the largest distance are summed up. They bound how far the
   last positive of the anchors of a cell can be, and with the triangle inequality between which distances
   from its pivot a row of a cell must lie to serve a group. Only such rows are sent to the group.
3. A group's anchors meet their rows in several tasks, each with a share of the rows: a task holds the
   group's anchors and takes the rows as they come. The best of all shares follow from a window whose limit
   is applied before the shuffle.
4. Positives known, each anchor's negatives lie in a band of scores, so in a band of distances: rows are
   routed once more by the bounds of these bands, and each anchor keeps the first few of each band.

Where directions have no structure the bounds prune little, and each group sees nearly all rows: an exact
join has no other way then. Nothing is broadcast but pivots and, while Spark holds it small enough, the table
of bounds; no cell, label or vector is gathered in one task.

Defined cases: rows with a null vec_id, label or vector, a null or non-finite component, another number of
components than most, or a squared length of 2^62 or more take no part; an anchor is each distinct
(vec_id, label, vector); rows with the anchor's own vec_id are neither its positives nor its negatives; of other
rows, repeated ones count each for itself; ties go to the smaller vec_id; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dawnpress.llm.ann import kmeans, pack, sample_rows
from dawnpress.plans.lineage import cut

SAMPLE, PIVOTS, PER_PIVOT = 1 << 12, 64, 64
#: Anchors of a group, rows of one share of a group's rows, scores that are held together.
GROUP, SHARE, BLOCK = 1 << 13, 1 << 20, 1 << 20
#: Whole numbers up to which doubles are exact; squared lengths that are scored at all.
EXACT, MOST = float(1 << 53), float(1 << 62)
OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def whole(column: pa.Array, dim: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Places and whole-number vectors of rows of ``dim`` finite components."""
    size = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(size == dim)
    x = column.take(pa.array(at)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(at), dim)
    with np.errstate(over="ignore", invalid="ignore"):
        y = np.floor(scale * x)
        fine = (y * y).sum(1) < MOST  # false for nan and infinity
    return at[fine], y[fine]


def augmented(y: np.ndarray, bound: float) -> np.ndarray:
    return np.concatenate([y, np.sqrt(np.maximum(bound - (y * y).sum(1), 0))[:, None]], 1)


def nearest_pivot(z: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cell = np.argmax(z @ pivots.T - (pivots * pivots).sum(1) / 2, 1)
    return cell, np.sqrt(((z - pivots[cell]) ** 2).sum(1))


def stretched(y: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Points of anchors and by how much they are stretched (0 for a zero vector, which is as far as M from all rows)."""
    size = np.sqrt((y * y).sum(1))
    t = np.where(size > 0, np.sqrt(bound) / np.maximum(size, 1.0), 0.0)
    return np.pad(y * t[:, None], ((0, 0), (0, 1))), t


def _cells(vectors: DataFrame, dim: int, scale: float, pivots: np.ndarray, own_pivots: np.ndarray, bound: float, width: str, every: int) -> DataFrame:
    """Every row that takes part, with its cell and distance; anchors also with those of their own point."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch in batches:
            at, y = whole(batch.column("embedding"), dim, scale)
            if len(at):
                ids = batch.column("vec_id").take(pa.array(at))
                cell, dist = nearest_pivot(augmented(y, bound), pivots)
                point, t = stretched(y, bound)
                own, near = nearest_pivot(point, own_pivots)
                other = ids.to_numpy() % every != 0
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, batch.column("label").take(pa.array(at)), pa.array(np.arange(turn, turn + len(at))), pa.array(cell.astype(np.int32)), pa.array(dist),
                        pa.array(own.astype(np.int32), mask=other), pa.array(near, mask=other), pa.array(t, mask=other), pa.array([r.tobytes() for r in y.astype(width)], pa.binary()),
                    ],
                    ["vec_id", "label", "turn", "cell", "dist", "own", "near", "stretch", "vector"],
                )
            turn += len(batch)

    return vectors.mapInArrow(rows, "vec_id long, label long, turn long, cell int, dist double, own int, near double, stretch double, vector binary")


class Anchors:
    """A group's anchors with, for each of their slots, a band of scores and the ``k`` best rows so far.

    Rows must come in order of id: a later one then needs a higher score than the last of a full list."""

    def __init__(self, ids, labels, keys, x, low, high, k: int, same: bool):
        self.ids, self.labels, self.keys, self.x, self.k, self.same = ids, labels, keys, x, k, same
        self.high, self.slots = high, low.shape[1]
        self.last = low - 1  # a score must be above it
        self.score = np.zeros((low.size, k), x.dtype)
        self.found, self.n = np.zeros((low.size, k), np.int64), np.zeros(low.size, np.int64)

    def meet(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        at, step = 0, 64
        while at < len(ids):
            part = slice(at, at + step)
            self._block(ids[part], labels[part], x[part])
            at, step = at + step, max(64, min(2 * step, BLOCK // max(1, len(self.ids))))

    def _block(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        s = self.x @ x.T
        fit = ((self.labels[:, None] == labels) == self.same) & (self.ids[:, None] != ids) & (s > self.last.min(1)[:, None])
        r, c = np.nonzero(fit)
        v = s[r, c]
        for j in range(self.slots):
            m = (v > self.last[r, j]) & (v <= self.high[r, j])
            if m.any():
                self._keep(r[m] * self.slots + j, v[m], ids[c[m]])

    def _keep(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(slot)
        held = np.repeat(touched, self.n[touched])
        inside = np.arange(len(held)) - np.repeat(np.cumsum(self.n[touched]) - self.n[touched], self.n[touched])
        slot, score, ids = np.append(held, slot), np.append(self.score[held, inside], score), np.append(self.found[held, inside], ids)
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.searchsorted(slot, touched)
        place = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        keep = place < self.k
        self.score[slot[keep], place[keep]], self.found[slot[keep], place[keep]] = score[keep], ids[keep]
        self.n[touched] = np.minimum(np.diff(np.append(first, len(slot))), self.k)
        full = touched[self.n[touched] == self.k]
        a, j = np.divmod(full, self.slots)
        self.last[a, j] = np.maximum(self.last[a, j], self.score[full, -1])

    def result(self) -> pa.RecordBatch:
        slot = np.repeat(np.arange(len(self.n)), self.n)
        place = np.arange(len(slot)) - np.repeat(np.cumsum(self.n) - self.n, self.n)
        a = slot // self.slots
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[a]), pa.array(self.keys[a]), pa.array((slot % self.slots).astype(np.int32)), pa.array(self.found[slot, place]), pa.array(self.score[slot, place].astype(np.int64))],
            ["anchor_id", "key", "slot", "vec_id", "score"],
        )


def local_join(dealt: DataFrame, dim: int, width: str, exact: bool, k: int, same: bool) -> DataFrame:
    """``anchor_id, key, slot, vec_id, score``: the best rows of each share, out of a group's anchors followed by
    the share's rows."""
    kind = np.float64 if exact else np.int64
    none, every = (-np.inf, np.inf) if exact else (np.iinfo(np.int64).min + 2, np.iinfo(np.int64).max)

    def vectors(column: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), width).reshape(len(column), dim).astype(kind)

    def bands(column: pa.Array, slots: int, missing) -> np.ndarray:
        out = np.full((len(column), slots), missing, kind)
        for i, x in enumerate(column.to_pylist()):
            out[i, : len(x)] = x
        return out

    def gather(runs: list[pa.RecordBatch]) -> Anchors:
        t = pa.Table.from_batches(runs).combine_chunks()
        low, high = t["low"].combine_chunks(), t["high"].combine_chunks()
        if low.null_count:  # one slot, without a band
            low, high = np.full((len(t), 1), none, kind), np.full((len(t), 1), every, kind)
        else:
            slots = max(map(len, low.to_pylist()))
            low, high = bands(low, slots, 1), bands(high, slots, 0)
        return Anchors(t["vec_id"].to_numpy(), t["label"].to_numpy(), t["key"].to_numpy(), vectors(t["vector"].combine_chunks()), low, high, k, same)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, anchors = None, [], None
        for batch in batches:
            g, s, c = (batch.column(x).to_numpy() for x in ("grp", "share", "kind"))
            edges = np.flatnonzero((np.diff(g) != 0) | (np.diff(s) != 0) | (np.diff(c) != 0)) + 1
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(g)], strict=True):
                if (g[lo], s[lo]) != at:
                    if anchors:
                        yield anchors.result()
                    at, held, anchors = (g[lo], s[lo]), [], None
                run = batch.slice(lo, hi - lo)
                if c[lo] == 0:
                    held.append(run)
                elif held:
                    anchors = anchors or gather(held)
                    anchors.meet(run.column("vec_id").to_numpy(), run.column("label").to_numpy(), vectors(run.column("vector")))
        if anchors:
            yield anchors.result()

    return dealt.mapInArrow(rows, "anchor_id long, key long, slot int, vec_id long, score long")


def _routes(bounds: DataFrame, apart: DataFrame, groups: DataFrame, by: list[str], slack: float) -> DataFrame:
    """Between which distances from its pivot a row of ``cell`` (and label) may serve a group. ``bounds`` has for
    cells of anchors ``own`` the largest distance ``u`` of an anchor, and how near (``near``) and far (``far``)
    the rows that serve can be from one."""
    low = F.greatest(F.col("apart") - F.col("u") - F.col("far"), F.col("near") - F.col("apart") - F.col("u")) - slack
    return (
        bounds.join(apart, "own").join(groups, "own").groupBy("cell", "grp", *by)
        .agg(F.min(low).alias("least"), F.max(F.col("far") + F.col("apart") + F.col("u") + slack).alias("most"))
    )


def _deal(anchors: DataFrame, cells: DataFrame, routes: DataFrame, by: list[str], shares: int, n_groups: int) -> DataFrame:
    """Anchors, once for each share of their group, and the rows that may serve the group, by group and share."""
    spark = anchors.sparkSession
    first = anchors.select("grp", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"), F.lit(0).alias("kind"), "vec_id", "label", "key", "vector", "low", "high")
    served = cells.join(cut(routes, "routes"), ["cell", *by]).where("dist >= least and dist <= most").select(
        "grp", F.pmod(F.xxhash64("turn", "vec_id"), F.lit(shares)).cast("int").alias("share"), F.lit(1).alias("kind"), "vec_id", "label", F.lit(0).cast("long").alias("key"), "vector",
        F.lit(None).cast("array<long>").alias("low"), F.lit(None).cast("array<long>").alias("high"),
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return first.unionByName(served).repartition(int(np.clip(n_groups * shares, tasks, 8 * tasks)), "grp", "share").sortWithinPartitions("grp", "share", "kind", "vec_id")


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "key", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0, column: str = "embedding") -> DataFrame:
    """For each anchor (``vec_id`` divisible by ``every``) its first ``positives`` of the same label, and for each of
    them the first ``negatives`` of another label whose score is ``low`` to ``high`` percent of the positive's."""
    spark = vectors.sparkSession
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col(column).alias("embedding")).where("vec_id is not null and label is not null")
    # how long vectors are: an upper bound of the squared length after rounding
    grown = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + F.pow(F.abs(x.cast("double") * scale) + 1, 2))
    fine = vectors.where("size(embedding) > 0").select(F.size("embedding").alias("d"), grown.alias("b")).where((F.col("b") < MOST) & ~F.isnan("b"))
    seen = fine.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.max("b").alias("b")).orderBy(F.desc("n"), "d").first()
    if seen is None:
        return spark.createDataFrame([], OUT)
    dim, n_rows, bound = seen["d"], seen["n"], float(np.ceil(seen["b"]))
    exact = bound < EXACT
    width = "<i2" if bound < (1 << 15) ** 2 else "<f8" if exact else "<i8"
    y = whole(sample_rows(vectors, n_rows, SAMPLE)["embedding"].combine_chunks(), dim, scale)[1]
    if not len(y):  # of a short table
        y = whole(vectors.limit(SAMPLE).toArrow()["embedding"].combine_chunks(), dim, scale)[1]
    y = y if len(y) else np.zeros((1, dim))
    n_pivots = int(min(PIVOTS, max(1, len(y) // PER_PIVOT)))
    pivots, own_pivots = (kmeans(z, n_pivots).astype(np.float64) for z in (augmented(y, bound), stretched(y, bound)[0]))
    slack = 1e-5 * float(np.sqrt(bound))
    cells = cut(_cells(vectors, dim, scale, pivots, own_pivots, bound, width, every), "cells")

    anchors = cells.where(F.col("vec_id") % every == 0).select("vec_id", "label", "own", "near", "stretch", "vector").distinct()
    anchors = cut(anchors.withColumn("key", F.xxhash64("label", "vector")), "anchors")
    counts = np.zeros(len(own_pivots), np.int64)
    for r in anchors.groupBy("own").agg(F.count(F.lit(1)).alias("n")).collect():  # at most PIVOTS rows
        counts[r["own"]] = r["n"]
    first, slices, n_groups = pack(counts, GROUP)
    shares = max(1, -(-2 * spark.sparkContext.defaultParallelism // max(n_groups, 1)), -(-n_rows // SHARE))
    places = spark.createDataFrame([(p, int(first[p]), int(slices[p])) for p in range(len(own_pivots))], "own int, first int, slices int")
    far = np.sqrt(np.maximum(((own_pivots[:, None] - pivots[None]) ** 2).sum(2), 0))
    apart = spark.createDataFrame([(i, j, float(far[i, j])) for i in range(len(own_pivots)) for j in range(len(pivots))], "own int, cell int, apart double")
    groups = places.select("own", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("slices") - 1)).alias("grp"))
    grouped = anchors.join(F.broadcast(places), "own").withColumn("grp", (F.col("first") + F.pmod("key", "slices")).cast("int")).drop("first", "slices")

    # how far the last positive can be: cells of the label, from the one that must be nearest on, until they hold enough
    sums = cells.groupBy("cell", "label").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("d"))
    asked = anchors.groupBy("own", "label").agg(F.max("near").alias("u"))
    reach = asked.join(sums, "label").join(apart, ["own", "cell"]).withColumn("far", F.col("apart") + F.col("u") + F.col("d") + slack)
    so_far = F.sum("n").over(Window.partitionBy("own", "label").orderBy("far", "cell"))
    enough = reach.withColumn("n", so_far).groupBy("own", "label").agg(F.first("u").alias("u"), F.coalesce(F.min(F.when(F.col("n") > positives, F.col("far"))), F.lit(float("inf"))).alias("far"))
    routes = _routes(enough.withColumn("near", F.lit(0.0)), apart, groups, ["label"], slack)
    no_band = grouped.withColumn("low", F.lit(None).cast("array<long>")).withColumn("high", F.lit(None).cast("array<long>"))
    best = _first(local_join(_deal(no_band, cells, routes, ["label"], shares, n_groups), dim, width, exact, positives, True), positives)
    best = cut(best.select("anchor_id", "key", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # 50 p <= 100 s <= 95 p in whole numbers
    p = F.col("positive_score").cast("decimal(20,0)")
    floor, top = -F.floor(-(p * low) / 100), F.floor(p * high / 100)
    bands = best.groupBy(F.col("anchor_id").alias("vec_id"), "key").agg(F.sort_array(F.collect_list(F.struct("slot", floor.cast("long").alias("low"), top.cast("long").alias("high")))).alias("b"))  # at most `positives` each
    banded = cut(grouped.join(bands, ["vec_id", "key"]).withColumn("low", F.col("b.low")).withColumn("high", F.col("b.high")).drop("b").where(F.exists(F.arrays_zip("low", "high"), lambda x: x["low"] <= x["high"])), "bands")
    # the band of distances of an anchor's negatives
    distance = lambda s: F.sqrt(F.when(F.col("stretch") == 0, bound).otherwise(F.greatest(F.lit(2 * bound) - 2 * F.col("stretch") * s.cast("double"), F.lit(0.0))))
    asked = banded.groupBy("own").agg(F.max("near").alias("u"), F.max(distance(F.array_min("low"))).alias("far"), F.min(distance(F.array_max("high"))).alias("__near")).withColumnRenamed("__near", "near")
    routes = _routes(asked, apart, groups, [], slack)
    found = _first(local_join(_deal(banded, cells, routes, [], shares, n_groups), dim, width, exact, negatives, False), negatives)
    return found.withColumnRenamed("vec_id", "negative_id").withColumnRenamed("score", "negative_score").join(best, ["anchor_id", "key", "slot"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def moved_labels(vectors: DataFrame, every: int = 7, n_labels: int = 10) -> DataFrame:
    """Rows whose id is divisible by ``every`` get the next label."""
    return vectors.withColumn("label", F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % n_labels).otherwise(F.col("label")))


ORACLE = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, cast(list_inner_product(a.e, c.e) as bigint) as score
  from v a join v c on a.vec_id <> c.vec_id where a.vec_id % 50 = 0
), p as (
  select * from (select *, row_number() over (partition by anchor_id order by score desc, vec_id) as place from s where same) where place <= 5
), n as (
  select p.anchor_id, p.vec_id as positive_id, p.place, p.score as positive_score, s.vec_id as negative_id, s.score as negative_score,
    row_number() over (partition by p.anchor_id, p.place order by s.score desc, s.vec_id) as rank
  from p join s on s.anchor_id = p.anchor_id and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score
)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from n where rank <= 3
"""
