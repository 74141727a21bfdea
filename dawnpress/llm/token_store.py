"""Token-ID output: a content-addressed store of token chunks.

Every document's ids (its text by a public tokenizer, then an end id) are a stream. A rolling hash over
the last ``WINDOW`` ids cuts it where the ids themselves say so, so that equal passages give equal
chunks wherever they stand. A chunk is stored once, under its digest; a document is a *recipe*, the list
of its chunks' digests, with a Merkle root over them; the recipes are written in ascending ``doc_id``
order with the running position ``start``; a manifest holds a Merkle root per recipe file and one over
all. Everything is written by Spark's own writers, so a lost executor costs its tasks only.

Layout of a store: ``objects`` (kind 0 recipe, kind 1 chunk; payload: ids little-endian, 16 bits where
the vocabulary fits), ``recipes`` (sorted), ``manifest``.

Reading back checks each chunk against its digest and each recipe against its root. The ids' CRC-32 of
a document is put together from its chunks' by the usual combination over GF(2), so no document is
gathered in one place; :func:`read_documents` rebuilds whole documents.

Defined cases: a null or empty text is the end id alone; repeated rows are documents of their own, next
to each other; null ``doc_id`` comes first; an empty table gives an empty store; a hot chunk or recipe is
sent once per task; other columns are not looked at. Texts are read whole, whatever their length.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from dawnpress.llm.textscan import U64, mix, word_chunks
from dawnpress.plans.lineage import table_path
from dawnpress.plans.skew import hot_keys, join_spread

WINDOW, MEAN, LEAST, MOST = 16, 512, 64, 4096
DIGEST = 20
#: Digests that a task and words that a worker remember; more are sent or looked up again.
REMEMBER, CACHE = 200_000, 1_500_000


class WordEncoder:
    """Ids of whole texts through a cache of words. The tokenizer drops white space and splits at it and
    between letters and marks, so the ids of a text are those of its parts, one after the other. A
    worker keeps its encoder over all its tasks; the cache holds ``CACHE`` parts at most."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self._clear()

    def _clear(self) -> None:
        self.known, self.begin, self.length = np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.int32)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        length = np.fromiter(map(len, got), np.int32, len(got))
        ids = np.fromiter(chain.from_iterable(got), np.int32, int(length.sum()))
        begin = len(self.ids) + np.cumsum(length) - length
        self.ids = np.concatenate([self.ids, ids])
        at = np.searchsorted(self.known, hashes)  # both are sorted
        self.known, self.begin, self.length = (np.insert(x, at, y) for x, y in ((self.known, hashes), (self.begin, begin), (self.length, length)))

    def encode(self, words) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a chunk of rows, and where each row begins."""
        if len(self.known) > CACHE:
            self._clear()
        unique, at, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, unique)
        have = np.zeros(len(unique), bool)
        inside = place < len(self.known)
        have[inside] = self.known[place[inside]] == unique[inside]
        new = np.flatnonzero(~have)
        if len(new):
            raw = words.data.tobytes()
            spans = zip(words.starts[at[new]].tolist(), words.ends[at[new]].tolist(), strict=True)
            self._learn(unique[new], [raw[a:b].decode("utf-8", "replace") for a, b in spans])
            place = np.searchsorted(self.known, unique)
        begin, length = self.begin[place][inverse], self.length[place][inverse]
        ends = np.cumsum(length, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(begin - ends + length, length) + np.arange(total)]
        return ids, np.append(0, ends)[words.first]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder_for(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def cut_points(ids: np.ndarray) -> list[int]:
    """Ends of the chunks of one stream."""
    n = len(ids)
    if n <= LEAST:
        return [n]
    h = ids.astype(U64) * U64(0x9E3779B97F4A7C15)
    power, have = U64(0x100000001B3), 1
    with np.errstate(over="ignore"):
        while have < WINDOW and len(h) > have:
            h = h[:-have] * power + h[have:]
            power, have = power * power, have * 2
    ends = (np.flatnonzero(mix(h) % U64(MEAN) == 0) + have).tolist()
    out, last = [], 0
    for e in [*ends, n]:
        while e - last > MOST:
            last += MOST
            out.append(last)
        if e - last >= LEAST or (e == n and e > last):
            out.append(e)
            last = e
    return out


def merkle(leaves: list[bytes]) -> bytes:
    """Root over digests: pairs are hashed until one is left; an odd one moves up as it is."""
    level = [hashlib.sha256(b"\0" + x).digest() for x in leaves] or [hashlib.sha256(b"").digest()]
    while len(level) > 1:
        pairs = [hashlib.sha256(b"\1" + a + b).digest() for a, b in zip(level[::2], level[1::2], strict=False)]
        level = pairs + level[len(pairs) * 2 :]
    return level[0]


_OBJECT = "kind int, key binary, doc_id long, n_tokens long, root binary, payload binary"


def _objects(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sent = encoder_for(tokenizer), set()
        wide = encoder.width if end_id < 1 << 16 else np.dtype("<u4")
        for batch in batches:
            doc = batch.column(0).to_pylist()
            for first, to, words in word_chunks(batch.column(1), fold=None, marks=True):
                ids, bounds = encoder.encode(words)
                kind, key, did, count, roots, payload = [], [], [], [], [], []
                for row in range(first, to):
                    stream = np.append(ids[bounds[row - first] : bounds[row - first + 1]], end_id).astype(wide)
                    digests, at = [], 0
                    for e in cut_points(stream):
                        part = stream[at:e].tobytes()
                        digests.append(d := hashlib.blake2b(part, digest_size=DIGEST).digest())
                        at = e
                        if d not in sent:
                            sent.add(d)
                            kind.append(1), key.append(d), did.append(None), count.append(len(part) // wide.itemsize), roots.append(None), payload.append(part)
                    root = merkle(digests)
                    kind.append(0), key.append(root), did.append(doc[row]), count.append(len(stream)), roots.append(root), payload.append(b"".join(digests))
                if len(sent) > REMEMBER:
                    sent.clear()
                yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(key, pa.binary()), pa.array(did, pa.int64()), pa.array(count, pa.int64()), pa.array(roots, pa.binary()), pa.array(payload, pa.binary())], ["kind", "key", "doc_id", "n_tokens", "root", "payload"])

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # of this partition's share of the digests
        for batch in batches:
            keep = []
            for kind, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keep.append(kind == 0 or key not in seen)
                if kind:
                    seen.add(key)
            yield batch.filter(pa.array(keep, pa.bool_()))

    # recipes of equal texts share a key; they are dealt by their ids beside it
    made = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, _OBJECT)
    return made.repartition("key", "doc_id").mapInArrow(once, _OBJECT)


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> str:
    """Write the store of ``docs(doc_id, text)`` under ``path``; returns the manifest's root in hex."""
    spark = docs.sparkSession
    _objects(docs, tokenizer, end_id).write.parquet(f"{path}/objects")
    recipes = spark.read.parquet(f"{path}/objects").where("kind = 0").select("doc_id", "root", "n_tokens", F.col("payload").alias("recipe"))

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column(2).to_numpy()
            ends = at + np.cumsum(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(n), part, np.int32)), pa.array(ends - n)], ["doc_id", "root", "n_tokens", "recipe", "part", "before"])
            at = int(ends[-1]) if len(ends) else at

    p = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = recipes.repartitionByRange(p, F.col("doc_id").asc_nulls_first(), F.col("root")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "root")
    ordered.mapInArrow(running, "doc_id long, root binary, n_tokens long, recipe binary, part int, before long").write.parquet(f"{path}/recipes")
    files = spark.read.parquet(f"{path}/recipes").groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_docs")).orderBy("part")

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaves, part = [], None
        for batch in batches:  # one partition's recipes, in order
            for k, r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k != part and leaves:
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([merkle(leaves)], pa.binary())], ["part", "root"])
                    leaves = []
                part = k
                leaves.append(r)
        if leaves:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([merkle(leaves)], pa.binary())], ["part", "root"])

    by_file = spark.read.parquet(f"{path}/recipes").select("part", "root", "before").repartition("part").sortWithinPartitions("part", "before").select("part", "root").mapInArrow(roots, "part int, root binary")
    rows = sorted(files.join(by_file, "part").collect(), key=lambda r: r["part"])  # one row per recipe file
    top, start, out = merkle([bytes(r["root"]) for r in rows]), 0, []
    for r in rows:
        out.append((r["part"], r["n_docs"], r["n_tokens"], start, bytes(r["root"]), top))
        start += r["n_tokens"]
    spark.createDataFrame(out, "part int, n_docs long, n_tokens long, start long, root binary, store_root binary").coalesce(1).write.parquet(f"{path}/manifest")
    return top.hex()


def _crc_tables() -> list[np.ndarray]:
    """For each k, tables that move a CRC-32 past 2 ** k zero bytes, one byte of the CRC at a time."""
    step = np.zeros((4, 256), np.uint32)
    for byte in range(4):
        for v in range(256):
            c = v << (8 * byte)
            for _ in range(8):
                c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
            step[byte, v] = c
    tables = [step]
    while len(tables) < 40:
        tables.append(_move(tables[-1], tables[-1].ravel()).reshape(4, 256))
    return tables


def _move(t: np.ndarray, c: np.ndarray) -> np.ndarray:
    return t[0][c & 255] ^ t[1][(c >> 8) & 255] ^ t[2][(c >> 16) & 255] ^ t[3][c >> 24]


def combine_crcs(crc: np.ndarray, n_bytes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """CRC-32 of each run of parts (``first``: where runs begin) from the parts' CRCs and lengths."""
    ends = np.cumsum(n_bytes)
    run_end = np.repeat(ends[np.append(first[1:], len(crc)) - 1], np.diff(np.append(first, len(crc))))
    after, crc = run_end - ends, crc.astype(np.uint32).copy()
    for k, t in enumerate(_crc_tables()):
        sel = np.flatnonzero((after >> k) & 1)
        if len(sel):
            crc[sel] = _move(t, crc[sel])
    return np.bitwise_xor.reduceat(crc, first)


def _width(spark: SparkSession, tokenizer: str, end_id: int) -> int:
    return 2 if encoder_for(tokenizer).width.itemsize == 2 and end_id < 1 << 16 else 4


def _hot(listed: DataFrame) -> list[Row]:
    """Chunks that many recipes hold."""
    return hot_keys(listed.groupBy("key").agg(F.count(F.lit(1)).alias("n")), ["key"])


def read_index(spark: SparkSession, path: str, width: int) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from a store's files, which are checked on the way."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs, counts = [], []
            for key, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if hashlib.blake2b(x, digest_size=DIGEST).digest() != key:
                    raise ValueError(f"chunk {key.hex()} is damaged")
                crcs.append(zlib.crc32(np.frombuffer(x, f"<u{width}").astype("<u4").tobytes()))
                counts.append(len(x) // width)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(crcs, pa.int64())], ["key", "n", "crc"])

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, start, n_tokens, root, parts = (batch.column(i) for i in range(5))
            lists = parts.to_pylist()
            if not lists:
                continue
            size = np.array([len(x) for x in lists])
            first = np.append(0, np.cumsum(size)[:-1])
            flat = [p for x in lists for p in x]
            n, crc = np.array([p["n"] for p in flat], np.int64), np.array([p["crc"] for p in flat], np.int64)
            for r, x, n_tok, total in zip(root.to_pylist(), lists, n_tokens.to_pylist(), np.add.reduceat(n, first).tolist(), strict=True):
                if total != n_tok or merkle([p["key"] for p in x]) != r:
                    raise ValueError("a recipe does not match its chunks")
            yield pa.RecordBatch.from_arrays([doc, start, n_tokens, pa.array(combine_crcs(crc, 4 * n, first).astype(np.int64))], ["doc_id", "start", "n_tokens", "ids_crc32"])

    chunks = spark.read.parquet(f"{path}/objects").where("kind = 1").select("key", "payload").mapInArrow(check, "key binary, n long, crc long")
    manifest = spark.read.parquet(f"{path}/manifest").select("part", F.col("start").alias("__start"))
    recipes = spark.read.parquet(f"{path}/recipes").join(manifest, "part").select("doc_id", (F.col("__start") + F.col("before")).alias("start"), "n_tokens", "root", "recipe")
    digest = F.transform(F.sequence(F.lit(0), (F.length("recipe") / F.lit(DIGEST)).cast("int") - 1), lambda i: F.substring(F.col("recipe"), i * DIGEST + 1, F.lit(DIGEST)))
    listed = recipes.select("doc_id", "start", "n_tokens", "root", F.posexplode(digest).alias("pos", "key"))
    # a document's position is its own: it names the row
    whole = join_spread(listed, chunks, ["key"], _hot(listed)).groupBy("start").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_tokens").alias("n_tokens"), F.first("root").alias("root"),
        F.sort_array(F.collect_list(F.struct("pos", "key", "n", "crc"))).alias("parts"),
    )
    return whole.select("doc_id", "start", "n_tokens", "root", "parts").mapInArrow(put_together, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(spark: SparkSession, path: str, width: int) -> DataFrame:
    """``doc_id, start, ids``: whole documents from a store's files."""
    chunks = spark.read.parquet(f"{path}/objects").where("kind = 1").select("key", "payload")
    manifest = spark.read.parquet(f"{path}/manifest").select("part", F.col("start").alias("__start"))
    recipes = spark.read.parquet(f"{path}/recipes").join(manifest, "part").select("doc_id", (F.col("__start") + F.col("before")).alias("start"), "recipe")
    digest = F.transform(F.sequence(F.lit(0), (F.length("recipe") / F.lit(DIGEST)).cast("int") - 1), lambda i: F.substring(F.col("recipe"), i * DIGEST + 1, F.lit(DIGEST)))
    listed = recipes.select("doc_id", "start", F.posexplode(digest).alias("pos", "key"))
    whole = join_spread(listed, chunks, ["key"], _hot(listed)).groupBy("start").agg(
        F.first("doc_id").alias("doc_id"), F.transform(F.sort_array(F.collect_list(F.struct("pos", "payload"))), lambda x: x["payload"]).alias("parts")
    )

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [np.frombuffer(b"".join(x), f"<u{width}").astype(np.int32) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got, pa.list_(pa.int32()))], ["doc_id", "start", "ids"])

    return whole.select("doc_id", "start", "parts").mapInArrow(ids, "doc_id long, start long, ids array<int>")


def token_index(docs: DataFrame, tokenizer: str, end_id: int = 1, path: str | None = None) -> DataFrame:
    """Write a store of ``docs`` (in the shared folder unless ``path`` is given), read it back and return
    ``doc_id, start, n_tokens, ids_crc32``."""
    spark = docs.sparkSession
    path = path or table_path(spark, "token-store")
    write_store(docs, path, tokenizer, end_id)
    return read_index(spark, path, _width(spark, tokenizer, end_id))
