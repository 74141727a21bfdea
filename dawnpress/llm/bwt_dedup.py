"""Suffix-array dedup: bytes covered by a string of ``length`` bytes that also starts earlier.

A *window* is ``length`` bytes at one position of one document. The steps:

1. Screening. Every window names its anchor: the least-hashed 32 bytes inside it (the leftmost of
   equals). Equal windows have equal anchors at equal places, so windows whose anchor occurs once are
   unique. Consecutive windows with one anchor are a *segment*. Of segments with the same bytes (equal
   64-bit hashes) the earliest is the *representative*; the others are covered as a whole and go straight to
   their documents, as places: they do not come through the transforms.
2. Representatives that share an anchor with others are dealt to buckets of anchors and
   cut into shards. Each shard gets its suffix order and its Burrows-Wheeler transform, over symbols of
   25 bytes (numbered by their hashes). The shards' transforms are merged by refining their
   interleave: a stable pass over the current interleave sorts it by one more symbol, without sorting the
   suffixes again. The pass in which a border between two neighbours appears is the length of their
   common prefix. Where it reaches ``length`` bytes, neighbours are one repeated interval. Every window of an
   interval but the earliest is covered.
3. Covered windows meet their documents' texts again, which are cut and hashed.

Everything that one task gathers at once is a bucket: the anchors' and documents' hash spaces are split
in proportion to the corpus, and a task takes several buckets one after the other (``MOST_PARTS`` tasks).
Copies inside a batch get their representative before the shuffle, so an anchor in a third of all
documents sends one row per batch and different segment. An anchor with over
``HOT`` different segments is dealt by single windows: the windows' own hashes name the buckets, copies
inside a batch and equal segments are covered at once, and the rest goes through the transforms.

Defined cases: null counts as empty; documents under ``length`` bytes lose nothing; rows that repeat
a ``doc_id`` with the same text are one document and lose the same bytes, with another text they are
documents of their own, in the order of their texts' hashes; a null ``doc_id`` comes first; an empty
table gives an empty result; very long texts are scanned in parts; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dawnpress.llm.textscan import _BYTE, MULTIPLIERS, U64, _powers, bytes_and_bounds, mix, portions
from dawnpress.plans.lineage import cut

GRAM = 32
NULL_ID = -(1 << 63)
#: Windows that are scanned at once; text bytes for each bucket; strings of a shard.
PART, BUCKET_BYTES, SHARD = 1 << 20, 12 << 20, 512
#: Tasks of a stage at most; each takes its buckets one after the other.
MOST_PARTS = 8192
#: Bytes of a symbol; open bytes of a bucket; different segments around an anchor that are dealt by
#: single windows instead.
WIDTH, OPEN_BYTES, HOT = 25, 1 << 18, 4096

#: A run of ``n`` windows from ``at`` on in version ``ver`` of document ``doc``.
RUN = np.dtype([("doc", "<i8"), ("ver", "<u4"), ("at", "<i4"), ("n", "<i4")])
SEGMENT = np.dtype([*RUN.descr, ("anchor", "<u8"), ("same", "<u8")])


def pack(rows: np.ndarray) -> bytes:
    """Fields one after the other, each with its bytes regrouped, which compresses well."""
    return b"".join(np.ascontiguousarray(rows[f]).view(np.uint8).reshape(len(rows), -1).T.tobytes() for f in rows.dtype.names)


def unpack(blob, kind: np.dtype) -> np.ndarray:
    raw = np.frombuffer(blob, np.uint8)
    n = len(raw) // kind.itemsize
    out, at = np.empty(n, kind), 0
    for f in kind.names:
        size = kind[f].itemsize
        out[f] = np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(kind[f]).ravel()
        at += n * size
    return out


def segments(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, anchor hash, content hash) of the segments of one text or part of it."""
    n = len(data) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, U64),) * 2
    up, down = _powers(len(data) + 1)
    total = np.empty(len(data) + 1, U64)
    total[0] = 0
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    grams = mix((total[GRAM:] - total[:-GRAM]) * down[: len(data) - GRAM + 1])
    bits = U64(max(1, int(len(grams)).bit_length()))
    key = (grams >> bits << bits) | np.arange(len(grams), dtype=U64)
    span, have = length - GRAM + 1, 1
    least = key
    while 2 * have <= span:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < span:
        least = np.minimum(least[: n], least[span - have : span - have + n])
    where = (least & ((U64(1) << bits) - U64(1))).astype(np.int64)
    start = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
    count = np.diff(np.append(start, n))
    body = (total[start + count + length - 1] - total[start]) * down[start]
    return start, count, grams[where[start]], mix(body ^ (count.astype(U64) * U64(0x9E3779B97F4A7C15)))


def _scan(docs: DataFrame, length: int, buckets: int, groups: int, versions: bool) -> DataFrame:
    """Representatives by anchor bucket (kind 0) and runs of their later copies by document bucket (kind 1), as far as
    a batch knows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(NULL_ID).to_numpy()
            data, bounds = bytes_and_bounds(batch.column(1))
            got = []
            for row in range(len(ids)):
                lo, hi = int(bounds[row]), int(bounds[row + 1])
                text = data[lo:hi]
                ver = version(text) if versions else 0
                for a in range(0, max(0, len(text) - length + 1), PART):
                    start, count, anchor, same = segments(text[a : a + PART + length - 1], length)
                    s = np.empty(len(start), SEGMENT)
                    s["doc"], s["ver"], s["at"], s["n"], s["anchor"], s["same"] = ids[row], ver, start + a, count, anchor, same
                    got.append(s)
            if not got:
                continue
            s = np.concatenate(got)
            first, again = earliest(s)
            yield from _emit([(0, first, first["anchor"] % U64(buckets)), (1, runs(again), np.mod(again["doc"], groups))])

    return docs.mapInArrow(scan, _BLOBS)


_BLOBS = "kind int, bucket long, rows binary"
_PIECES = f"{_BLOBS}, bytes binary"


def _emit(parts) -> Iterator[pa.RecordBatch]:
    for kind, rows, where in parts:
        if not len(rows):
            continue
        order = np.argsort(where, kind="stable")
        rows, where = rows[order], where[order]
        cuts = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
        blobs = [pack(rows[a:b]) for a, b in zip(cuts, [*cuts[1:], len(rows)], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cuts), kind, np.int32)), pa.array(where[cuts].astype(np.int64)), pa.array(blobs, pa.binary())], ["kind", "bucket", "rows"])


def version(text: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(text.tobytes(), digest_size=4).digest(), "little")


def runs(s: np.ndarray) -> np.ndarray:
    out = np.empty(len(s), RUN)
    for f in RUN.names:
        out[f] = s[f]
    return out


def earliest(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The earliest of each kind of segment, and all later copies."""
    s = s[np.lexsort((s["at"], s["ver"], s["doc"], s["same"], s["anchor"]))]
    new = np.ones(len(s), bool)
    new[1:] = (s["same"][1:] != s["same"][:-1]) | (s["anchor"][1:] != s["anchor"][:-1])
    here = np.zeros(len(s), bool)  # the very same place, seen twice in repeated rows
    here[1:] = ~new[1:] & (s["doc"][1:] == s["doc"][:-1]) & (s["ver"][1:] == s["ver"][:-1]) & (s["at"][1:] == s["at"][:-1])
    lead = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
    at_lead = (s["doc"] == s["doc"][lead]) & (s["ver"] == s["ver"][lead]) & (s["at"] == s["at"][lead])
    return s[new], s[~new & ~here & ~at_lead]


def _dealt(blobs: DataFrame, buckets: int) -> DataFrame:
    return blobs.repartition(min(buckets, MOST_PARTS), "bucket").sortWithinPartitions("bucket", "kind")


def _passed(bucket: int, rows: pa.Scalar) -> pa.RecordBatch:
    """Runs that are covered already go on as they are."""
    return pa.RecordBatch.from_arrays([pa.array([1], pa.int32()), pa.array([bucket], pa.int64()), pa.array([rows.as_py()], pa.binary())], ["kind", "bucket", "rows"])


def _settle(blobs: DataFrame, buckets: int, groups: int) -> DataFrame:
    """kind 1: covered runs; kind 2: representatives to open; both by document bucket. A task holds one row for each
    batch and different segment of a bucket; copies inside batches only pass."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for kind, bucket, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if bucket != at and held:
                    yield from close(held)
                    held = []
                at = bucket
                if kind == 1:
                    yield _passed(bucket, rows)
                else:
                    held.append(unpack(rows.as_buffer(), SEGMENT))
        if held:
            yield from close(held)

    def close(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        first, again = earliest(np.concatenate(held))
        same = first["anchor"][1:] == first["anchor"][:-1]
        many = np.append(False, same) | np.append(same, False)
        _, which, count = np.unique(first["anchor"], return_inverse=True, return_counts=True)
        first["same"][count[which] > HOT] = 0
        opened = first[many]
        yield from _emit([(1, runs(again), np.mod(again["doc"], groups)), (2, opened, np.mod(opened["doc"], groups))])

    return _dealt(blobs, buckets).mapInArrow(settle, _BLOBS)


def _beside_texts(blobs: DataFrame, docs: DataFrame, groups: int) -> DataFrame:
    """Texts and the blobs of their document bucket in one partition, the blobs of a bucket first."""
    texts = docs.select(F.pmod(F.coalesce("doc_id", F.lit(NULL_ID)), F.lit(groups)).alias("bucket"), F.lit(9).alias("kind"), "doc_id", "text", F.lit(None).cast("binary").alias("rows"))
    rows = blobs.select("bucket", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), "rows")
    return _dealt(texts.unionByName(rows), groups)


def _with_rows(batches: Iterator[pa.RecordBatch], kind: np.dtype, versions: bool) -> Iterator[tuple[int | None, np.ndarray, np.ndarray]]:
    """(doc_id, text, rows of the document in order) for each text."""
    at, held, rows = None, [], None
    for batch in batches:
        bucket, tag, ids = (batch.column(i).to_pylist() for i in (0, 1, 2))
        data, bounds = bytes_and_bounds(batch.column(3))
        blobs = batch.column(4)
        for i in range(len(bucket)):
            if bucket[i] != at:
                at, held, rows = bucket[i], [], None
            if tag[i] == 0:
                held.append(unpack(blobs[i].as_buffer(), kind))
                continue
            if rows is None:
                rows = np.concatenate(held) if held else np.zeros(0, kind)
                rows = rows[np.lexsort((rows["at"], rows["ver"], rows["doc"]))]
            text = data[int(bounds[i]) : int(bounds[i + 1])]
            doc = NULL_ID if ids[i] is None else ids[i]
            a, b = np.searchsorted(rows["doc"], [doc, doc], "left")[0], np.searchsorted(rows["doc"], doc, "right")
            mine = rows[a:b]
            if versions and len(mine):
                mine = mine[mine["ver"] == version(text)]
            yield ids[i], text, mine


def _pieces(blobs: DataFrame, docs: DataFrame, groups: int, buckets: int, length: int, versions: bool) -> DataFrame:
    """kind 2: open segments with their bytes, by anchor bucket. Those around a hot anchor are dealt out as
    single windows, by the windows' own hashes; copies inside a batch are covered at once (kind 1)."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segs, texts, size = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            s = np.concatenate(segs)
            number = np.arange(len(s))
            hot = (s["n"] == 1) & (s["same"] == s["anchor"])
            if hot.any():
                first, again = earliest(s[hot])
                for x in _emit([(1, runs(again), np.mod(again["doc"], groups))]):
                    yield x.append_column("bytes", pa.nulls(len(x), pa.binary()))
                # earliest() sorts: find the kept rows' texts again by place
                where = {k: i for k, i in zip(zip(s["doc"].tolist(), s["ver"].tolist(), s["at"].tolist(), strict=True), number.tolist(), strict=True) if hot[i]}
                number = np.concatenate([number[~hot], np.array([where[k] for k in zip(first["doc"].tolist(), first["ver"].tolist(), first["at"].tolist(), strict=True)], np.int64)])
            where = (s["anchor"][number] % U64(buckets)).astype(np.int64)
            number = number[np.argsort(where, kind="stable")]
            where = np.sort(where)
            cuts = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
            parts = [number[a:b] for a, b in zip(cuts, [*cuts[1:], len(number)], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(parts), 2, np.int32)), pa.array(where[cuts]), pa.array([pack(s[k]) for k in parts], pa.binary()), pa.array([b"".join(texts[i] for i in k) for k in parts], pa.binary())], ["kind", "bucket", "rows", "bytes"])

        for _, text, mine in _with_rows(batches, SEGMENT, versions):
            if not len(mine):
                continue
            raw = text.tobytes()
            for s in (mine[mine["same"] != 0], _windows(mine[mine["same"] == 0], raw, length)):
                if len(s):
                    segs.append(s)
                    texts += [raw[a : a + n + length - 1] for a, n in zip(s["at"].tolist(), s["n"].tolist(), strict=True)]
                    size += int(s["n"].sum()) + length * len(s)
            if size > 8 << 20:
                yield from flush()
                segs, texts, size = [], [], 0
        if segs:
            yield from flush()

    return _beside_texts(blobs, docs, groups).mapInArrow(fetch, _PIECES)


def _windows(s: np.ndarray, raw: bytes, length: int) -> np.ndarray:
    """The single windows of segments, each with its own hash as anchor."""
    n = s["n"].astype(np.int64)
    out = np.repeat(s, n)
    out["at"] += (np.arange(len(out)) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32)
    out["n"] = 1
    own = [int.from_bytes(hashlib.blake2b(raw[a : a + length], digest_size=8).digest(), "little") | 1 for a in out["at"].tolist()]
    out["anchor"] = out["same"] = np.array(own, U64)
    return out


def stable_order(x: np.ndarray, most: int | None = None) -> np.ndarray:
    """The stable order of values that are not negative, digit by digit of 16 bits."""
    most = int(x.max(initial=0)) if most is None else most
    order = np.argsort(x.astype(np.uint16), kind="stable")
    shift = 16
    while most >> shift:
        order = order[np.argsort((x >> x.dtype.type(shift)).astype(np.uint16)[order], kind="stable")]
        shift += 16
    return order


# -- transforms of shards and their merge -------------------------------------------------------


class ShardTransform:
    """Suffix order and Burrows-Wheeler transform of some strings, over symbols of ``width`` bytes.

    Each string is read from each of its first ``width`` bytes on, so that a suffix starts at every byte.
    ``symbols`` numbers the ``width`` bytes at each place of ``data`` from 1 on; equal bytes have equal
    numbers, and the numbers' order is the order of the suffixes. Symbol 0 ends a reading; ends are told
    apart by the reading's number."""

    def __init__(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int):
        m = len(starts)
        shift = np.repeat(np.arange(width), m)
        count = (np.tile(sizes, width) - shift) // width  # whole symbols of each reading
        readings = len(count)
        n = count + 1
        base = np.cumsum(n) - n
        total = int(n.sum())
        reading = np.repeat(np.arange(readings), n)
        offset = np.arange(total) - base[reading]
        end = offset == count[reading]
        place = shift[reading] + width * offset
        symbol = symbols[np.minimum(np.tile(starts, width)[reading] + place, len(symbols) - 1)]
        symbol[end] = 0
        # suffix order by doubling; ends rank below all symbols, in the readings' order
        rank = symbol.astype(np.int64) + readings
        rank[end] = np.arange(readings)
        left = count[reading] - offset  # symbols before the end
        reach = 1
        while True:
            key = rank * (np.int64(rank.max()) + 2)
            far = np.flatnonzero(left >= reach)
            key[far] += rank[far + reach] + 1
            order = stable_order(key)
            key = key[order]
            new = np.ones(total, bool)
            new[1:] = key[1:] != key[:-1]
            rank[order] = np.cumsum(new) - 1
            if new.all():
                break
            reach *= 2
        before = symbol[order - 1]
        before[offset[order] == 0] = 0
        self.transform = before
        self.string = (reading % m)[order].astype(np.int32)
        self.place = place[order].astype(np.int32)
        self.ends = readings


def merge_transforms(shards: list[ShardTransform], symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """(interleave, for each suffix the symbols that it shares with the one before it, ``symbols`` at most),
    by iterative refinement."""
    sizes = [len(s.transform) for s in shards]
    total, ends = sum(sizes), sum(s.ends for s in shards)
    kind = np.uint8 if len(shards) < 256 else np.uint16
    bwt = np.concatenate([s.transform for s in shards])
    interleave = np.repeat(np.arange(len(shards)), sizes).astype(kind)
    block = np.zeros(total, np.int32)
    common = np.full(total, symbols, np.int16)
    common[0] = 0
    first_ends = np.repeat(np.arange(len(shards)), [s.ends for s in shards]).astype(kind)
    here, highest = np.empty(total, bwt.dtype), int(bwt.max(initial=0))
    for done in range(symbols):
        here[np.argsort(interleave, kind="stable")] = bwt
        moved = stable_order(here, highest)
        symbol, was = here[moved], block[moved]
        interleave = interleave[moved]
        interleave[:ends] = first_ends
        border = np.empty(total, bool)
        border[0] = True
        np.not_equal(was[1:], was[:-1], out=border[1:])
        border[1:] |= symbol[1:] != symbol[:-1]
        border[: min(ends + 1, total)] = True
        common[border & (common == symbols)] = done  # a border stays where it appeared
        block = np.cumsum(border, dtype=np.int32)
        if block[-1] == total:
            break
    return interleave, common


def _symbols(data: np.ndarray, width: int) -> np.ndarray:
    """A number from 1 on for the ``width`` bytes at each place; equal bytes have equal numbers."""
    up, down = _powers(len(data) + 1)
    total = np.empty(len(data) + 1, U64)
    total[0] = 0
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    h = mix((total[width:] - total[:-width]) * down[: len(data) - width + 1])
    order = stable_order(h)
    new = np.ones(len(h), bool)
    new[1:] = h[order[1:]] != h[order[:-1]]
    number = np.empty(len(h), np.uint32)
    number[order] = np.cumsum(new)
    return number if number.max(initial=0) > 65535 else number.astype(np.uint16)


def symbol_width(length: int) -> int:
    """The widest symbol up to ``WIDTH`` bytes that ``length`` is a multiple of."""
    return next(w for w in range(min(WIDTH, length), 0, -1) if length % w == 0)


def covered_windows(segs: np.ndarray, data: np.ndarray, length: int, shard: int | None = None) -> np.ndarray:
    """Runs of windows that an earlier equal window covers, of the segments ``segs`` (bytes one after the other
    in ``data``)."""
    shard = shard or SHARD
    size = segs["n"].astype(np.int64) + length - 1
    start = np.cumsum(size) - size
    width = symbol_width(length)
    symbols = _symbols(data, width)
    cuts = list(range(0, len(segs), shard))
    shards = [ShardTransform(symbols, start[a : a + shard], size[a : a + shard], width) for a in cuts]
    interleave, common = merge_transforms(shards, length // width)
    order = np.argsort(interleave, kind="stable")
    seg, place = np.empty(len(common), np.int64), np.empty(len(common), np.int64)
    seg[order] = np.concatenate([s.string + a for s, a in zip(shards, cuts, strict=True)])
    place[order] = np.concatenate([s.place for s in shards])
    block = np.cumsum(common < length // width)
    ok = place < segs["n"][seg]
    block, seg, place = block[ok], seg[ok], place[ok]
    shared = np.bincount(block)[block] > 1
    block, seg, place = block[shared], seg[shared], place[shared]
    doc, ver, at = segs["doc"][seg], segs["ver"][seg], segs["at"][seg] + place
    by = np.lexsort((at, ver, doc, block))
    block, doc, ver, at = block[by], doc[by], ver[by], at[by]
    lead = np.maximum.accumulate(np.where(np.append(True, block[1:] != block[:-1]), np.arange(len(block)), 0))
    later = (doc != doc[lead]) | (ver != ver[lead]) | (at != at[lead])
    out = np.empty(int(later.sum()), RUN)
    out["doc"], out["ver"], out["at"], out["n"] = doc[later], ver[later], at[later], 1
    return join_runs(out)


def join_runs(r: np.ndarray) -> np.ndarray:
    """Runs sorted and joined where they meet or overlap."""
    if not len(r):
        return r
    r = r[np.lexsort((r["at"], r["ver"], r["doc"]))]
    reach = r["at"].astype(np.int64) + r["n"]
    own = np.append(True, (r["doc"][1:] != r["doc"][:-1]) | (r["ver"][1:] != r["ver"][:-1]))
    group = np.cumsum(own) - 1
    # the furthest end so far in the same document
    far = np.maximum.accumulate(reach + group * (1 << 33)) - group * (1 << 33)
    new = own.copy()
    new[1:] |= r["at"][1:] > far[:-1]
    k = np.flatnonzero(new)
    out = r[k].copy()
    out["n"] = far[np.append(k[1:], len(r)) - 1] - out["at"]
    return out


def _merge(pieces: DataFrame, buckets: int, groups: int, length: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, segs, texts = None, [], []
        for batch in batches:
            for kind, bucket, rows, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if bucket != at and segs:
                    yield from close(segs, texts)
                    segs, texts = [], []
                at = bucket
                if kind == 1:
                    yield _passed(bucket, rows)
                    continue
                segs.append(unpack(rows.as_buffer(), SEGMENT))
                texts.append(np.frombuffer(raw.as_buffer(), np.uint8))
        if segs:
            yield from close(segs, texts)

    def close(segs: list[np.ndarray], texts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found = covered_windows(np.concatenate(segs), np.concatenate(texts), length)
        yield from _emit([(1, found, np.mod(found["doc"], groups))])

    return _dealt(pieces, buckets).mapInArrow(work, _BLOBS)


def _finish(runs_by_doc: DataFrame, docs: DataFrame, groups: int, length: int, versions: bool) -> DataFrame:
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for doc, text, mine in _with_rows(batches, RUN, versions):
            removed = spans = 0
            raw = text.tobytes()
            if len(mine):
                mine = mine.copy()
                mine["n"] += length - 1
                mine = join_runs(mine)
                removed, spans = int(mine["n"].sum()), len(mine)
                at, parts = 0, []
                for a, n in zip(mine["at"].tolist(), mine["n"].tolist(), strict=True):
                    parts.append(raw[at:a])
                    at = a + n
                raw = b"".join([*parts, raw[at:]])
            out.append((doc, len(text), removed, spans, hashlib.sha256(raw).hexdigest()))
            if len(out) == 10_000:
                yield table(out)
                out = []
        yield table(out)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == 4 else pa.int64()) for k, c in enumerate(cols)], names)

    return _beside_texts(runs_by_doc, docs, groups).mapInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for each row of ``docs(doc_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text")), F.count(F.lit(1)), F.count("doc_id")).first()
    ids = docs.where("doc_id is not null").select("doc_id").distinct().count()
    versions = ids < size[1]  # some ids repeat, or more than one is null
    buckets = max(8, -(-int(size[0] or 0) // BUCKET_BYTES))
    groups = max(8, -(-int(size[0] or 0) // BUCKET_BYTES))
    settled = cut(_settle(_scan(docs, length, buckets, groups, versions), buckets, groups), "settled")
    opened = settled.where("kind = 2")
    packed = opened.agg(F.sum(F.length("rows"))).first()[0] or 0
    open_buckets = max(8, -(-int(packed) // SEGMENT.itemsize * (length + GRAM) // OPEN_BYTES))
    merged = cut(_merge(_pieces(opened, docs, groups, open_buckets, length, versions), open_buckets, groups, length), "merged")
    return _finish(settled.where("kind = 1").unionByName(merged), docs, groups, length, versions)
