"""N-gram Jaccard join: every document's near-duplicate class, exact, by count-vector R-trees.

A document is the set of hashes of its five-word shingles. Equal sets are one node. The steps:

1. A fixed-size count sketch over all documents gives every shingle an estimated frequency. It only
   sets an order (rare first), so its errors cost time and never a link.
2. Two sets with Jaccard similarity t or more share a shingle of their *prefixes* in that order: the
   smaller set's first ``a - ceil(2ta/(1+t)) + 1`` and the larger set's first ``b - ceil(tb) + 1``.
   Prefixes longer by ``c - 1`` share ``c`` shingles; ``c`` grows with the set (``_need``), so texts that
   share a few shingles by chance, which more and more do as a corpus grows, are told apart. Of a
   shingle with up to ``GROUP`` nodes all pairs are counted, and pairs with fewer than ``c`` shared shingles
   are dropped; the nodes of a more frequent one are chained, whatever else they share. Connected nodes are
   *islands*. No link leaves an island. What a batch holds more than ``GROUP`` times is chained there, so a
   shingle that a third of all documents hold sends one row per batch and size class.
3. Inside an island each node's shingles are hashed into groups; the group counts are a point. Points
   are packed into an R-tree. The summed coordinate minima of two points bound the overlap of the two
   sets from above, those of a point and a box's upper corner bound it for the whole box. Pairs that
   survive are verified on the sets. Pairs already in one component are skipped: links are kept as a
   spanning forest, never as all pairs.
   An island over ``island_cap`` nodes or ``island_shingles`` shingles is split by a salt; each pair of salts is a unit of its own, so
   that a task stays bounded and no pair is lost.
4. Components of the links give each document its class.

Defined cases: null or blank text has no shingle (``n_shingles`` 0) and is a class of its own; fewer
than five words are one shingle; repeated rows are rows of the same class; a null ``doc_id`` row links
as any other and gets its class's smallest id that is not null (null if there is none); other columns of the input are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dawnpress.llm.textscan import MULTIPLIERS, mix, word_chunks
from dawnpress.plans.components import connected_components
from dawnpress.plans.lineage import cut, drop
from dawnpress.plans.skew import hot_keys, join_spread

SKETCH_BITS = 22
SKETCH_PARTS = 64
LEAF = 16
#: (point, box) pairs that are compared at once.
FRONTIER = 1 << 13
#: So many nodes of a prefix shingle are met in pairs; more are chained.
GROUP = 32


def _node(s: np.ndarray) -> int:
    """One id for a set: equal sets have equal ids."""
    return int(mix(mix(s * MULTIPLIERS[20]).sum(keepdims=True, dtype=np.uint64) ^ (s[:1] * np.uint64(0) + np.uint64(len(s))) * MULTIPLIERS[21])[0].astype(np.int64))


def _need(n: int) -> int:
    """How many shingles of their prefixes a set of ``n`` shingles and a larger one that is similar share at least."""
    return 1 + min(n // 16, 15)


def _sketch(docs: DataFrame, shingle: int) -> np.ndarray:
    """How many documents hold a shingle of each counter; the size is fixed, all documents count."""
    size = (1 << SKETCH_BITS) // SKETCH_PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.uint16)
        for batch in batches:
            for _, _, words in word_chunks(batch.column(0)):
                for s in words.shingle_sets(shingle):
                    at = (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)  # sorted, and hardly ever twice
                    total[at] += total[at] < 0xFFFF
        rows = [(i, total[i * size : (i + 1) * size].tobytes()) for i in range(SKETCH_PARTS) if total[i * size : (i + 1) * size].any()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = np.frombuffer(counts.as_buffer(), np.uint16).astype(np.uint32)
                sums[part] = np.minimum(sums[part].astype(np.uint64) + x, 0xFFFFFFFF).astype(np.uint32) if part in sums else x
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["part", "counts"])

    schema = "part int, counts binary"
    parts = docs.select("text").mapInArrow(count, schema).repartition(SKETCH_PARTS, "part").mapInArrow(add, schema)
    total = np.zeros(1 << SKETCH_BITS, np.uint32)
    for r in parts.collect():  # at most 2 ** SKETCH_BITS counters of four bytes
        total[r["part"] * size : (r["part"] + 1) * size] = np.frombuffer(r["counts"], np.uint32)
    # Counts only order the shingles: their logarithms fit a byte.
    return np.minimum(np.log2(total + 1.0) * 8, 255).astype(np.uint8)


def _prefixes(docs: DataFrame, shingle: int, num: int, den: int, rank: np.ndarray) -> DataFrame:
    """Per document its node and size (kind 0); per prefix shingle, size class and node a row with :func:`_need`
    as ``n``, or one row with 0 for a shingle that more than ``GROUP`` nodes of the batch hold (kind 1); edges
    between those nodes (kind 2)."""
    bits = np.uint64(64 - SKETCH_BITS)
    step = math.log(den / num)
    shared = docs.sparkSession.sparkContext.broadcast(rank)  # 2 ** SKETCH_BITS bytes

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = shared.value
        for batch in batches:
            nodes, sizes, keys, owner, short = [], [], [], [], []
            seen: dict[int, int] = {}
            for _, _, words in word_chunks(batch.column(1)):
                for s in words.shingle_sets(shingle):
                    n = len(s)
                    sizes.append(n)
                    if not n:
                        nodes.append(None)
                        continue
                    node = _node(s)
                    nodes.append(node)
                    if node in seen:
                        continue
                    seen[node] = n
                    s = s[np.argsort(rank[(s >> bits).astype(np.int64)], kind="stable")]
                    probe = n - -(-num * n // den) + _need(n)
                    index = n - -(-2 * num * n // (num + den)) + _need(n)
                    keys.append(s[:probe])
                    owner.append(np.full(min(probe, n), node, np.int64))
                    short.append(np.arange(min(probe, n)) < index)
            rows = len(nodes)
            none = lambda t, k: pa.nulls(k, t)
            names = ["kind", "doc_id", "n", "node", "other", "key", "cls", "short"]

            def table(kind, doc, n, node, other, key, cls, short, k):
                return pa.RecordBatch.from_arrays([pa.array(np.full(k, kind, np.int32)), doc, n, node, other, key, cls, short], names)

            yield table(0, batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), none(pa.int64(), rows), none(pa.int64(), rows), none(pa.int32(), rows), none(pa.bool_(), rows), rows)
            if not keys:
                continue
            key, own, idx = np.concatenate(keys), np.concatenate(owner), np.concatenate(short)
            counts = np.repeat([seen[int(x[0])] for x in owner], [len(x) for x in owner])
            cls = np.floor(np.log(counts) / step).astype(np.int32)
            need = np.minimum(counts // 16, 15) + 1
            order = np.lexsort((own, cls, key))
            key, own, idx, cls, need = key[order], own[order], idx[order], cls[order], need[order]
            first = np.ones(len(key), bool)
            first[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
            at = np.flatnonzero(first)
            held = np.diff(np.append(at, len(key)))
            many = np.repeat(held > GROUP, held)
            idx = np.where(many, np.repeat(np.maximum.reduceat(idx, at), held), idx)
            rep = np.repeat(own[at], held)
            out = first | ~many
            k = int(out.sum())
            yield table(1, none(pa.int64(), k), pa.array(np.where(many, 0, need)[out]), pa.array(own[out]), none(pa.int64(), k), pa.array(key[out].view(np.int64)), pa.array(cls[out]), pa.array(idx[out]), k)
            pairs = np.unique(np.stack([own, rep])[:, many & (own != rep)], axis=1)
            if k := pairs.shape[1]:
                yield table(2, none(pa.int64(), k), none(pa.int64(), k), pa.array(pairs[0]), pa.array(pairs[1]), none(pa.int64(), k), none(pa.int32(), k), none(pa.bool_(), k), k)

    schema = "kind int, doc_id long, n long, node long, other long, key long, cls int, short boolean"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(emit, schema)


def _summed(edges: np.ndarray) -> np.ndarray:
    """Rows ``u, v, count, need``, one for each pair."""
    if not len(edges):
        return edges
    edges = edges[np.lexsort((edges[:, 1], edges[:, 0]))]
    at = np.flatnonzero(np.append(True, (edges[1:, :2] != edges[:-1, :2]).any(axis=1)))
    return np.column_stack([edges[at, :2], np.add.reduceat(edges[:, 2], at), np.maximum.reduceat(edges[:, 3], at)])


def _runs(key: np.ndarray, cls: np.ndarray, own: np.ndarray, short: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Rows ``u, v, count, need`` of the nodes that share shingles of their prefixes and have like sizes."""
    order = np.lexsort((need, own, cls, key))
    key, cls, own, short, need = key[order], cls[order], own[order], short[order], need[order]
    at = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (own[1:] != own[:-1])))  # a set may be in many batches
    short = np.maximum.reduceat(short, at)
    key, cls, own, need = key[at], cls[at], own[at], need[at]
    begins = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (cls[1:] - cls[:-1] > 1)))
    length = np.diff(np.append(begins, len(key)))
    live = np.maximum.reduceat(short, begins) & (length > 1)
    many = (length > GROUP) | (np.minimum.reduceat(need, begins) == 0)
    row, left = np.arange(len(key)), np.repeat(begins + length, length) - np.arange(len(key)) - 1
    found = []

    def add(i: np.ndarray, j: np.ndarray, count: int) -> None:
        ends = np.sort(np.stack([own[i], own[j]], axis=1), axis=1)
        found.append(np.column_stack([ends, np.full(len(i), count), np.minimum(need[i], need[j])]))

    i = row[np.repeat(live & many, length) & (left > 0)]
    add(i, i + 1, 16)  # as many as any pair needs
    i = row[np.repeat(live & ~many, length)]
    for off in range(1, GROUP):
        i = i[left[i] >= off]
        ok = (cls[i + off] - cls[i] <= 1) & (short[i] | short[i + off])
        add(i[ok], i[ok] + off, 1)
    return _summed(np.concatenate(found))


def _chain(keys: DataFrame) -> DataFrame:
    """Edges between nodes that share enough prefix shingles, or a frequent one, and have like sizes. A near-duplicate
    class shares many shingles, which are spread over all partitions: each partition packs its edges by
    bucket, and a bucket's edges are unpacked where all their repeats have met."""
    buckets = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [[], [], [], [], []]
        for batch in batches:
            for x, c in zip(got, batch.columns, strict=True):
                x.append(c.to_numpy(zero_copy_only=False))
        if got[0]:
            edges = _runs(*(np.concatenate(x) for x in got))
            where = np.mod(edges[:, 0], buckets)
            edges = edges[np.argsort(where, kind="stable")]
            which, at = np.unique(np.sort(where), return_index=True)
            for k, mine in zip(which.tolist(), np.split(edges, at[1:]) if len(edges) else [], strict=True):  # a partition may have no edge
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([np.ascontiguousarray(mine).tobytes()], pa.binary())], ["bucket", "edges"])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.zeros((0, 4), np.int64)
        for batch in batches:
            got = [np.frombuffer(x.as_buffer(), np.int64).reshape(-1, 4) for x in batch.column(1)]
            edges = _summed(np.concatenate([edges, *got]))
        edges = edges[edges[:, 2] >= edges[:, 3]]
        yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], ["u", "v"])

    # Shares of the key space are small enough for one task each; no key's group is gathered but as
    # ``GROUP`` rows per batch and size class.
    packed = keys.select("key", "cls", "node", "short", "n").repartition("key").mapInArrow(link, "bucket long, edges binary")
    return packed.repartition(buckets, "bucket").mapInArrow(unpack, "u long, v long")


# -- the R-tree -------------------------------------------------------------------------------


class CountTree:
    """An R-tree, packed bottom-up, over group-count points. ``levels`` go from leaves to the root: for
    each box the upper corner, the least and most set size, and the range of its children."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = np.concatenate(self._pack(points, sizes, np.arange(len(points))))
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels = []
        upper, least, most = self.points, self.sizes, self.sizes
        while len(upper) > 1 or not self.levels:
            at = np.arange(0, len(upper), LEAF)
            self.levels.append((u := np.maximum.reduceat(upper, at, axis=0), lo := np.minimum.reduceat(least, at), hi := np.maximum.reduceat(most, at), at, np.append(at[1:], len(upper))))
            upper, least, most = u, lo, hi

    @classmethod
    def _pack(cls, points: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
        if len(rows) <= LEAF:
            return [rows]
        spread = points[rows].var(axis=0)
        dim = int(spread.argmax())
        value = sizes[rows] if sizes[rows].var() > spread[dim] * 4 else points[rows, dim]
        half = LEAF * max(1, round(len(rows) / LEAF / 2))
        split = np.argpartition(value, half) if half < len(rows) else np.arange(len(rows))
        return cls._pack(points, sizes, rows[split[:half]]) + cls._pack(points, sizes, rows[split[half:]])

    def candidates(self, num: int, den: int) -> Iterator[np.ndarray]:
        """Pairs (later, earlier in tree order) whose bound admits similarity ``num / den``."""
        stack = [(len(self.levels) - 1, np.arange(len(self.points)), np.zeros(len(self.points), np.int64))]
        while stack:
            level, q, box = stack.pop()
            if len(q) > FRONTIER:
                h = len(q) // 2
                stack += [(level, q[h:], box[h:]), (level, q[:h], box[:h])]
                continue
            upper, least, most, lo, hi = self.levels[level]
            n = self.sizes[q]
            ok = (den * most[box] >= num * n) & (num * least[box] <= den * n)
            q, box, n = q[ok], box[ok], n[ok]
            # overlap >= t/(1+t) (|a|+|b|), and |b| is at least the box's least and t|a|
            other = np.maximum(least[box], -(-num * n // den))
            ok = (num + den) * np.minimum(self.points[q], upper[box]).sum(1) >= num * (n + other)
            q, box = q[ok], box[ok]
            width = hi[box] - lo[box]
            q2 = np.repeat(q, width)
            child = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + np.repeat(lo[box], width)
            if level:
                stack.append((level - 1, q2, child))
                continue
            keep = child < q2
            q2, child = q2[keep], child[keep]
            for i in range(0, len(q2), FRONTIER):
                a, b = q2[i : i + FRONTIER], child[i : i + FRONTIER]
                na, nb = self.sizes[a], self.sizes[b]
                ok = (den * na >= num * nb) & (den * nb >= num * na) & ((num + den) * np.minimum(self.points[a], self.points[b]).sum(1) >= num * (na + nb))
                if ok.any():
                    yield np.stack([self.order[a[ok]], self.order[b[ok]]], axis=1)


def tree_links(sets: list[np.ndarray], num: int, den: int, part: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``sets``. With ``part``, pairs inside part 1 are left to
    another unit and pairs inside part 0 too."""
    m = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, m)
    groups = 1 << int(np.clip(math.ceil(math.log2(np.median(sizes) / 4 + 1)), 4, 9))
    which = (np.concatenate(sets) & np.uint64(groups - 1)).astype(np.int64)
    points = np.bincount(np.repeat(np.arange(m), sizes) * groups + which, minlength=m * groups).reshape(m, groups).astype(np.int32)
    root = list(range(m))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    links = []
    for pairs in CountTree(points, sizes).candidates(num, den):
        if part is not None:
            pairs = pairs[part[pairs[:, 0]] != part[pairs[:, 1]]]
        for i, j in pairs.tolist():
            if (a := find(i)) == (b := find(j)):
                continue
            x, y = sets[i], sets[j]
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            both = int(np.count_nonzero(y[at] == x))
            if den * both >= num * (len(x) + len(y) - both):
                root[a] = b
                links.append((i, j))
    return links


def _verify(units: DataFrame, shingle: int, num: int, den: int) -> DataFrame:
    """Links inside each unit; rows of a unit are in one partition, one after the other."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, nodes, sets, parts = None, [], [], []

        def close() -> pa.RecordBatch:
            two = np.array(parts) if len(set(parts)) > 1 else None
            got = tree_links(sets, num, den, two) if len(sets) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([nodes[i] for i, _ in got], pa.int64()), pa.array([nodes[j] for _, j in got], pa.int64())], ["u", "v"])

        for batch in batches:
            u, n, p = (batch.column(i).to_pylist() for i in range(3))
            at = 0
            for _, _, words in word_chunks(batch.column(3)):
                for s in words.shingle_sets(shingle):
                    if u[at] != unit:
                        if len(sets) > 1:
                            yield close()
                        unit, nodes, sets, parts = u[at], [], [], []
                    if _node(s) == n[at]:  # else another text of a repeated doc_id
                        nodes.append(n[at])
                        sets.append(s)
                        parts.append(p[at])
                    at += 1
        if len(sets) > 1:
            yield close()

    return units.repartition("unit").sortWithinPartitions("unit").mapInArrow(join, "u long, v long")


def _nameless(docs: DataFrame, shingle: int) -> DataFrame:
    """``node, text`` of the rows without a ``doc_id``, a row for each node."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = [_node(s) if len(s) else None for _, _, words in word_chunks(batch.column(0)) for s in words.shingle_sets(shingle)]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), batch.column(0).cast(pa.string())], ["node", "text"])

    return docs.where("doc_id is null").select("text").mapInArrow(name, "node long, text string").groupBy("node").agg(F.min("text").alias("text"))


def jaccard_classes(docs: DataFrame, shingle: int = 5, num: int = 3, den: int = 4, island_cap: int = 4096, island_shingles: int = 4_000_000) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each row of ``docs(doc_id, text)``; two rows link when
    the Jaccard similarity of their sets is ``num / den`` or more."""
    rank = _sketch(docs, shingle)
    found = cut(_prefixes(docs, shingle, num, den, rank), "prefixes")
    nodes = cut(found.where("kind = 0").select("doc_id", "n", "node"), "rows")
    near = found.where("kind = 2").select(F.col("node").alias("u"), F.col("other").alias("v"))
    islands = connected_components(near.union(_chain(found.where("kind = 1"))))
    drop(docs.sparkSession, found)

    stands = cut(nodes.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("rows"), F.first("n").alias("n")), "nodes")
    placed = cut(islands.join(stands, "node"), "islands")
    size = placed.groupBy("component").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("all"))
    size = cut(size.select("component", "m", F.ceil(F.greatest(F.col("m") / F.lit(island_cap), F.col("all") / F.lit(island_shingles))).cast("int").alias("salts")), "sizes")
    # component, then the salts of the two halves; a node of salt s belongs to each pair with s
    own = F.pmod(F.xxhash64("node"), F.col("salts")).cast("int")
    salted = (
        join_spread(placed, size.drop("m"), ["component"], hot_keys(size, ["component"], "m")).withColumn("own", own)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        .select("node", "doc_id", F.struct("component", F.least("own", "with").alias("a"), F.greatest("own", "with").alias("b")).alias("unit"), F.when(F.col("own") == F.col("with"), 0).otherwise(F.when(F.col("own") < F.col("with"), 1).otherwise(2)).alias("part"))
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    met = salted.join(texts, "doc_id").select("unit", "node", "part", "text")
    met = met.unionByName(salted.where("doc_id is null").join(_nameless(docs, shingle), "node").select("unit", "node", "part", "text"))
    units = met.select(F.concat_ws("/", F.col("unit.component"), F.col("unit.a"), F.col("unit.b")).alias("unit"), "node", "part", "text")
    links = cut(_verify(units, shingle, num, den), "links")
    drop(docs.sparkSession, islands, placed, size)

    # a class's smallest id meets its nodes, then the nodes' rows; a class or a node may have any number
    comp = connected_components(links)
    classes = cut(stands.join(comp, "node").select("component", "node", "doc_id"), "classes")
    least = cut(classes.groupBy("component").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("m")), "least")
    linked = join_spread(classes, least.drop("m"), ["component"], hot_keys(least, ["component"], "m")).select("node", "first_id")
    first = cut(stands.join(linked, "node", "left").select("node", F.coalesce("first_id", "doc_id").alias("first_id")), "first")
    drop(docs.sparkSession, links, comp, classes, least)
    rows = join_spread(nodes.where("node is not null"), first, ["node"], hot_keys(stands, ["node"], "rows"))
    blank = nodes.where("node is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.col("first_id").alias("component_id")).unionByName(blank)


def keep_one_per_class(docs: DataFrame, **how) -> DataFrame:
    """``docs`` without the documents that are not the first (smallest ``doc_id``) of their class.
    ``doc_id`` is taken as the key: of repeated rows of one id, the one whose text has the least hash stays. Rows
    without text stay, and so do rows without a ``doc_id``."""
    kept = jaccard_classes(docs, **how).where("doc_id = component_id").select(F.col("doc_id").alias("__first"))
    named = docs.join(kept, F.col("doc_id") == F.col("__first"), "left_semi")
    least = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    named = named.withColumn("__place", F.row_number().over(least)).where("__place = 1").drop("__place")
    return named.unionByName(docs.where("doc_id is null"))
