"""Approximate nearest neighbours by cosine: score-aware anisotropic quantisation, four-bit table scans,
exact reranking.

Vectors are scaled to unit length, so that the largest cosine is the largest inner product.

Fitting, on a bounded sample (``SAMPLE`` rows, by hash):

1. k-means gives at most ``PARTITIONS`` partitions, one for ``PER_PARTITION`` rows.
2. A row's rest (row less centroid) is a length and a direction. Directions are quantised two dimensions at a
   time with 16 codewords each. The loss of an error ``e`` of a row ``x`` is ``|e|^2 + (eta - 1) (e . x)^2``:
   what is parallel to the row counts ``eta`` times, as it moves the scores of the queries that matter;
   ``eta = (d - 1) T^2 / (1 - T^2)``, where T is the score from which queries matter. T follows from how
   tight the row's partition is: neighbours in a tight one have scores close to 1.
3. How many partitions a query probes is calibrated: enough that ``COVERED`` of the sample's own nearest
   neighbours lie in them. Where partitions prune nothing (directions without any structure), a query
   probes nearly all of them and the scan is one over all rows, in blocks.

Every row is indexed: partition, codes (two to a byte), length (the one with the least loss) and the vector
itself. Partitions are packed into bins of at most about ``BIN`` rows, whatever the table's size: a partition
that holds a third of all rows is dealt to as many bins as it needs. A query goes to each bin that has one of
its partitions. A task reads a bin's rows, then its queries as they come, adds up table entries for each of
them, keeps the ``RERANK`` best rows of the bin and ranks these by their exact scores in double precision. The
best of all bins follow from a window whose limit is applied before the shuffle. Nothing is broadcast but
centroids and codebooks (at most ``PARTITIONS`` rows) and one number a partition.

Defined cases: rows without vec_id, with a null, zero or non-finite vector or one with a null component, and
vectors not as long as most are take no part; a query is each distinct (vec_id, vector) whose id is divisible
by ``every``; rows with the query's own id are no candidates, whatever their vector; all other rows are,
repeated ones each for itself; ties go to the smaller vec_id; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dawnpress.plans.lineage import cut

SAMPLE, PARTITIONS, PER_PARTITION = 1 << 14, 1 << 10, 256
#: Rows of a bin at most and at least, rows of a bin that are ranked exactly, share of the sample's neighbours in
#: the partitions probed.
BIN, LEAST_BIN, RERANK, COVERED = 1 << 15, 1 << 10, 128, 0.99
#: Partitions probed hold this many rows at least.
LEAST_ROWS = 64
#: Dimensions of a codeword; codewords (four bits).
PER_CODE, WORDS = 2, 16
LEAST_T, MOST_T, MOST_ETA = 0.2, 0.9995, 32.0
#: Queries and rows that are looked at together.
QUERIES, ROWS = 128, 2048


# -- vectors ---------------------------------------------------------------------------------------


def matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and vectors (in double precision) of the rows with ``dim`` components and a finite length over 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(size == dim)
    values = column.take(pa.array(at)).flatten()
    x = values.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(at), dim)  # a null becomes nan
    with np.errstate(over="ignore", invalid="ignore"):
        size = lengths(x)
    fine = np.isfinite(size) & (size > 0)
    return at[fine], x[fine]


def lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("nd,nd->n", x, x))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, in single precision; dimensions filled up to a multiple of four."""
    x = x / np.abs(x).max(1, keepdims=True)
    x = x / lengths(x)[:, None]
    return np.pad(x, ((0, 0), (0, -x.shape[1] % (2 * PER_CODE)))).astype(np.float32)


# -- fitting and encoding --------------------------------------------------------------------------


@dataclass
class Index:
    """What is fitted: centroids, codebooks (subspace, word, dimension), T and eta by partition, probes."""

    dim: int
    centroids: np.ndarray
    books: np.ndarray
    eta: np.ndarray
    probes: int = 1


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    half = (c * c).sum(1) / 2
    return np.concatenate([np.argmax(x[k : k + 8192] @ c.T - half, 1) for k in range(0, len(x), 8192)]) if len(x) else np.zeros(0, np.int64)


def _means(x: np.ndarray, at: np.ndarray, old: np.ndarray) -> np.ndarray:
    n = np.bincount(at, minlength=len(old))
    order = np.argsort(at, kind="stable")
    sums = np.zeros(old.shape, np.float64)
    some = np.flatnonzero(n)
    sums[some] = np.add.reduceat(x[order].astype(np.float64), (np.cumsum(n) - n)[some])
    return np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], old).astype(np.float32)


def kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(3))
    c = x[np.sort(rng.choice(len(x), min(k, len(x)), replace=False))].copy()
    for _ in range(rounds):
        c = _means(x, _nearest(x, c), c)
    return c


def _split(x: np.ndarray) -> np.ndarray:
    return x.reshape(len(x), -1, PER_CODE)


def rests(x: np.ndarray, index: Index, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and directions of rows less their centroids."""
    r = x - index.centroids[at]
    s = np.sqrt((r * r).sum(1))
    return s, np.where(s[:, None] > 1e-7, r / np.maximum(s, 1e-7)[:, None], 0)


def assign(u: np.ndarray, x: np.ndarray, books: np.ndarray, eta: np.ndarray, sweeps: int = 2) -> np.ndarray:
    """Codewords of directions ``u`` of rows ``x``, by coordinate descent on the anisotropic loss."""
    us, xs = _split(u), _split(x)
    n, m = us.shape[:2]
    codes, par = np.zeros((n, m), np.uint8), np.zeros((n, m), np.float32)
    near = [((us[:, j, None] - books[j]) ** 2).sum(2) for j in range(m)]
    along = [((us[:, j, None] - books[j]) * xs[:, j, None]).sum(2) for j in range(m)]
    rows = np.arange(n)
    for j in range(m):
        codes[:, j] = near[j].argmin(1)
        par[:, j] = along[j][rows, codes[:, j]]
    total, more = par.sum(1), (eta - 1)[:, None]
    for _ in range(sweeps):
        for j in range(m):
            rest = total - par[:, j]
            codes[:, j] = (near[j] + more * (rest[:, None] + along[j]) ** 2).argmin(1)
            par[:, j] = along[j][rows, codes[:, j]]
            total = rest + par[:, j]
    return codes


def fit_books(u: np.ndarray, x: np.ndarray, eta: float, rounds: int = 4) -> np.ndarray:
    """Codebooks with the least anisotropic loss: codewords and assignments by turns. A codeword solves
    ``sum(I + (eta - 1) x x') c = sum(u + (eta - 1) x (rest + x . u))`` over its rows."""
    us, xs = _split(u), _split(x)
    books = np.stack([kmeans(us[:, j], WORDS) if len(us) >= WORDS else np.resize(us[:, j], (WORDS, PER_CODE)) for j in range(us.shape[1])]).astype(np.float32)
    etas = np.full(len(u), eta, np.float32)
    for _ in range(rounds):
        codes = assign(u, x, books, etas, 1)
        par = np.stack([((us[:, j] - books[j][codes[:, j]]) * xs[:, j]).sum(1) for j in range(us.shape[1])], 1)
        total = par.sum(1)
        for j in range(us.shape[1]):
            c, a = codes[:, j], xs[:, j].astype(np.float64)
            left = np.eye(PER_CODE) + (eta - 1) * a[:, :, None] * a[:, None, :]
            right = us[:, j] + (eta - 1) * a * (total - par[:, j] + (a * us[:, j]).sum(1))[:, None]
            total_of = lambda v, c=c: np.stack([np.bincount(c, y, WORDS) for y in v.reshape(len(v), -1).T], 1).reshape(WORDS, *v.shape[1:])
            A, b = total_of(left), total_of(right)
            some = np.bincount(c, minlength=WORDS) > 0
            books[j][some] = np.linalg.solve(A[some], b[some][:, :, None])[:, :, 0]
            new = ((us[:, j] - books[j][c]) * xs[:, j]).sum(1)
            total += new - par[:, j]
            par[:, j] = new
    return books


def encode(x: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Partition, packed codes and length of each row."""
    at, m = _nearest(x, index.centroids), x.shape[1] // PER_CODE
    packed, size = np.zeros((len(x), m // 2), np.uint8), np.zeros(len(x), np.float32)
    for k in range(0, len(x), ROWS):
        part = slice(k, k + ROWS)
        s, u = rests(x[part], index, at[part])
        codes = assign(u, x[part], index.books, np.minimum(index.eta[at[part]], MOST_ETA))
        made = index.books[np.arange(m), codes].reshape(len(u), -1)
        more, xm = index.eta[at[part]] - 1, (x[part] * made).sum(1)
        # the length with the least loss, for the codes chosen
        size[part] = s * ((u * made).sum(1) + more * xm * (x[part] * u).sum(1)) / np.maximum((made * made).sum(1) + more * xm * xm, 1e-9)
        packed[part] = codes[:, ::2] | codes[:, 1::2] << 4
    return at.astype(np.int32), packed, size


def eta_of(t: np.ndarray | float, dim: int) -> np.ndarray:
    return np.maximum((dim - 1) * t**2 / (1 - t**2), 1)


def fit(x: np.ndarray, n_rows: int) -> Index:
    """An index out of a sample of unit rows of a table of ``n_rows``."""
    k = int(min(PARTITIONS, max(1, n_rows // PER_PARTITION), max(1, len(x) // 16)))
    index = Index(x.shape[1], kmeans(x, k), np.zeros(0), np.zeros(0))
    at = _nearest(x, index.centroids)
    s, u = rests(x, index, at)
    n = np.bincount(at, minlength=k)
    tight = np.bincount(at, s * s, minlength=k) / np.maximum(n, 1)
    index.eta = eta_of(np.clip(1 - tight, LEAST_T, MOST_T), x.shape[1]).astype(np.float32)
    index.books = fit_books(u, x, float(eta_of(LEAST_T, x.shape[1])))
    # calibration: the rank of the partition of each of a query's neighbours in the sample
    asked = np.linspace(0, len(x) - 1, min(512, len(x))).astype(int)
    score = x[asked] @ x.T
    score[np.arange(len(asked)), asked] = -np.inf
    near = np.argsort(-score, 1)[:, :5]
    c = x[asked] @ index.centroids.T
    rank = (c[:, None, :] > np.take_along_axis(c, at[near], 1)[:, :, None]).sum(2)
    index.probes = int(np.sort(rank.ravel())[min(rank.size - 1, int(COVERED * rank.size))]) + 1
    return index


def probed(q: np.ndarray, index: Index, n: np.ndarray) -> np.ndarray:
    """Which partitions each query probes: those of the highest scores, until there are enough of them and
    of their rows (``n`` by partition)."""
    order = np.argsort(-(q @ index.centroids.T), 1, kind="stable")
    before = np.cumsum(n[order], 1) - n[order]
    out = np.zeros(order.shape, bool)
    np.put_along_axis(out, order, (np.arange(order.shape[1]) < index.probes) | (before < LEAST_ROWS), 1)
    return out


# -- scanning --------------------------------------------------------------------------------------


def tables(q: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each pair of subspaces (a byte of codes) the sums of its 256 entries by query, as 16-bit integers
    whose total cannot overflow, and what one unit is worth for each query."""
    one = np.einsum("qmd,mkd->mkq", _split(q), books)  # subspace, word, query
    two = (one[1::2, :, None] + one[::2, None, :]).reshape(-1, WORDS * WORDS, len(q))
    worth = np.maximum(np.abs(two).max(1).sum(0), 1e-9) / 32000
    return np.round(two / worth).astype(np.int16), worth.astype(np.float32)


def scan(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sums of table entries, row by query."""
    out = np.zeros((len(codes), table.shape[2]), np.int16)
    held = np.empty((min(ROWS, len(codes)), table.shape[2]), np.int16)
    for k in range(0, len(codes), ROWS):
        part = out[k : k + ROWS]
        for j in range(codes.shape[1]):
            part += np.take(table[j], codes[k : k + ROWS, j], 0, out=held[: len(part)])
    return out


@dataclass
class Bin:
    """The rows of a bin, in order of partition and id."""

    ids: np.ndarray
    part: np.ndarray
    codes: np.ndarray
    size: np.ndarray
    x: np.ndarray

    def search(self, index: Index, counts: np.ndarray, ids: np.ndarray, q: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query its ``k`` best rows here: place of the query, ids and exact scores."""
        parts, first = np.unique(self.part, return_index=True)
        stops, n = np.append(first[1:], len(self.ids)), len(self.ids)
        norm = lengths(self.x)
        for at in range(0, len(q), QUERIES):
            block = q[at : at + QUERIES]
            scaled = unit(block)
            probes, centres = probed(scaled, index, counts)[:, parts], scaled @ index.centroids[parts].T
            table, worth = tables(scaled, index.books)
            # scores as whole numbers above the place from behind: of equal rows the smaller id is kept
            keys = np.full((len(block), n), -1, np.int64)
            for p, (a, b) in enumerate(zip(first.tolist(), stops.tolist(), strict=True)):
                who = np.flatnonzero(probes[:, p])
                if len(who):
                    whole = len(who) == len(block)
                    sums = scan(self.codes[a:b], table if whole else np.ascontiguousarray(table[:, :, who]))
                    about = (centres[who, p] + sums * (worth[who] * self.size[a:b, None])).T
                    level = (np.clip(about + 3, 0, 6) * (1 << 20)).astype(np.int64)
                    keys[slice(None) if whole else who, a:b] = (level << 20) | (n - 1 - np.arange(a, b))
            keys[ids[at : at + QUERIES, None] == self.ids] = -1  # the query's own rows
            top = min(RERANK, n)
            best = np.argpartition(-keys, top - 1, 1)[:, :top]
            dots = np.einsum("qrd,qd->qr", self.x[best], block)
            score = dots / (norm[best] * lengths(block)[:, None])
            score[np.take_along_axis(keys, best, 1) < 0] = -np.inf
            for i in range(len(block)):
                order = np.lexsort((self.ids[best[i]], -score[i]))[:k]
                order = order[score[i][order] > -np.inf]
                yield at + i, self.ids[best[i]][order], score[i][order]


# -- on Spark --------------------------------------------------------------------------------------


def usual_size(vectors: DataFrame, column: str) -> tuple[int, int]:
    """How many components most vectors have (of equally many, the fewer), and how many such rows there are."""
    row = vectors.where(f"{column} is not null and size({column}) > 0").groupBy(F.size(column).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    return (row["d"], row["n"]) if row else (0, 0)


def sample_rows(vectors: DataFrame, n_rows: int, n: int) -> pa.Table:
    """About ``n`` rows (at most 1.5 times as many), chosen by a random number that follows from the place of a row."""
    return vectors.where(F.rand(11) < min(1.0, n / max(n_rows, 1))).limit(n + n // 2).toArrow()


def _index_rows(vectors: DataFrame, index: Index, width: str) -> DataFrame:
    """``part, turn, vec_id, size, codes, vector`` of every row that takes part."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch in batches:
            at, x = matrix(batch.column(1), index.dim)
            if len(at):
                part, codes, size = encode(unit(x), index)
                put = lambda a: pa.array([r.tobytes() for r in a], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.arange(turn, turn + len(at))), batch.column(0).take(pa.array(at)), pa.array(size), put(codes), put(x.astype(width))], ["part", "turn", "vec_id", "size", "codes", "vector"])
            turn += len(batch)

    return vectors.mapInArrow(rows, "part int, turn long, vec_id long, size float, codes binary, vector binary")


def pack(counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The first bin of each partition, over how many bins it is dealt, and the number of bins. Small partitions
    share a bin; one with more than ``most`` rows has bins of its own."""
    first, slices, bins, room = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64), 0, 0
    for p, n in enumerate(counts.tolist()):
        if n > most:
            first[p], slices[p] = bins, -(-n // most)
            bins, room = bins + int(slices[p]), 0
        elif n > room:
            first[p], bins, room = bins, bins + 1, most - n
        else:
            first[p], room = bins - 1, room - n
    return first, slices, bins


def _ask(queries: DataFrame, index: Index, counts: np.ndarray, first: np.ndarray, slices: np.ndarray, width: str) -> DataFrame:
    """``bins`` of each query."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k in range(0, len(batch), ROWS):
                part = batch.column(1)[k : k + ROWS]
                q = np.frombuffer(b"".join(part.to_pylist()), width).reshape(len(part), index.dim)
                for hit in probed(unit(q.astype(np.float64)), index, counts) & (counts > 0):
                    p = np.flatnonzero(hit)
                    out.append(np.unique(np.repeat(first[p], slices[p]) + np.arange(slices[p].sum()) - np.repeat(np.cumsum(slices[p]) - slices[p], slices[p])).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], ["vec_id", "vector", "bins"])

    return queries.mapInArrow(rows, "vec_id long, vector binary, bins array<int>")


def search(dealt: DataFrame, index: Index, counts: np.ndarray, width: str, k: int) -> DataFrame:
    """``query_id, query, vec_id, score``: the best of each bin, out of its rows followed by its queries."""

    def vectors(column: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), width).reshape(len(column), index.dim).astype(np.float64)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, ready = -1, [], None
        for batch in batches:
            b, kind = batch.column("bin").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero((np.diff(b) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(b)], strict=True):
                if b[lo] != at:
                    at, held, ready = b[lo], [], None
                run = batch.slice(lo, hi - lo)
                if kind[lo] == 0:
                    codes = np.frombuffer(b"".join(run.column("codes").to_pylist()), np.uint8).reshape(hi - lo, -1)
                    held.append((run.column("vec_id").to_numpy(), run.column("part").to_numpy(), codes, run.column("size").to_numpy(), vectors(run.column("vector"))))
                    continue
                if not held:
                    continue
                ready = ready or Bin(*map(np.concatenate, zip(*held, strict=True)))
                asked = run.column("vec_id").to_numpy()
                found = list(ready.search(index, counts, asked, vectors(run.column("vector")), k))
                n = [len(f[1]) for f in found]
                who = pa.array(np.repeat([f[0] for f in found], n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked).take(who), run.column("vector").take(who), pa.array(np.concatenate([f[1] for f in found])), pa.array(np.concatenate([f[2] for f in found]))],
                    ["query_id", "query", "vec_id", "score"],
                )

    found = dealt.mapInArrow(rows, "query_id long, query binary, vec_id long, score double")
    return found.select("query_id", F.xxhash64("query").alias("query"), "vec_id", "score")


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, column: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row whose ``vec_id`` is divisible by ``every``."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).alias("embedding")).where("vec_id is not null")
    width = "<f4" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"
    dim, n_rows = usual_size(vectors, "embedding")
    seen = matrix(sample_rows(vectors, n_rows, SAMPLE).column("embedding"), dim)[1] if dim else ()
    if not len(seen):  # of a short table
        seen = matrix(vectors.limit(SAMPLE).toArrow().column("embedding"), dim)[1] if dim else ()
    if not len(seen):
        return spark.createDataFrame([], schema)
    index = fit(unit(seen), n_rows)
    index.dim = dim
    stored = cut(_index_rows(vectors, index, width), "ann-index")
    counts = np.zeros(len(index.centroids), np.int64)
    for r in stored.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect():  # at most PARTITIONS rows
        counts[r["part"]] = r["n"]
    most = int(np.clip(counts.sum() // (2 * spark.sparkContext.defaultParallelism), LEAST_BIN, BIN))
    first, slices, n_bins = pack(counts, most)
    places = spark.createDataFrame([(p, int(first[p]), int(slices[p])) for p in range(len(counts))], "part int, first int, slices int")
    bins = stored.join(F.broadcast(places), "part").select(
        (F.col("first") + F.pmod(F.xxhash64("turn", "vec_id"), "slices")).cast("int").alias("bin"), F.lit(0).alias("kind"), "part", "vec_id", "size", "codes", "vector"
    )
    queries = stored.where(F.col("vec_id") % every == 0).select("vec_id", "vector").distinct()
    asked = _ask(queries, index, counts, first, slices, width).select(
        F.explode("bins").alias("bin"), F.lit(1).alias("kind"), F.lit(0).alias("part"), "vec_id", F.lit(0).cast("float").alias("size"), F.lit(b"").alias("codes"), "vector"
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = bins.unionByName(asked).repartition(int(np.clip(n_bins, tasks, 8 * tasks)), "bin").sortWithinPartitions("bin", "kind", "part", "vec_id")
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return search(dealt, index, counts, width, k).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: The exact answer, which the index reaches on small tables and comes close to on large ones.
ORACLE = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
), s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e) / (sqrt(list_inner_product(q.e, q.e)) * sqrt(list_inner_product(c.e, c.e))) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0
), r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5
"""
