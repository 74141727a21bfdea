"""Fill-in-middle: whole texts cut in three at random tokens and put together in another order.

Tokens are runs of ASCII letters and all other single code points, so a token begins at each code point
but a letter behind a letter: a predicate of two neighbouring bytes. Texts are decomposed into chunks of
``CHUNK`` bytes that overlap by the byte before them:

1. The predicate is counted in each chunk, whatever the other chunks hold, a slab of chunks at a time.
2. Prefix sums over the chunks give each text's number of tokens and, for both cut ranks, the chunk that
   owns the token that begins there.
3. Only the owning chunks are looked at again, to find the byte and the code point of each cut.

Nothing is shuffled; a task holds one batch of rows and slabs of ``textscan.CHUNK_BYTES``.

Defined cases: a null text is empty and plain; a null doc_id is hashed as the empty text; repeated rows are
cut alike, each for itself; a text that holds a sentinel is plain; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dawnpress.llm.textscan import CHUNK_BYTES, bytes_and_bounds, portions

#: Bytes of a chunk.
CHUNK = 1 << 10
SENTINELS = ("<P>", "<S>", "<M>")
#: Percentages: of texts that are cut, and of those with the suffix first.
RATE, SPM_RATE = 90, 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LEADS = (np.arange(256) & 0xC0) != 0x80


def draws(doc_id: Column, seed: int = 1, n: int = 4) -> list[Column]:
    """``n`` unsigned integers of 32 bits that follow from the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(n)]


def _begins(data: np.ndarray, before: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Whether a token begins at each byte, out of the byte before it; ``fresh`` bytes have none."""
    return _LEADS[data] & ~(_LETTER[data] & _LETTER[before] & ~fresh)


def chunk_edges(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where chunks begin, and the first chunk of each text (and one more)."""
    each = -(-np.diff(bounds) // CHUNK)
    first = np.append(0, np.cumsum(each))
    inside = np.arange(first[-1]) - np.repeat(first[:-1], each)
    return np.repeat(bounds[:-1], each) + inside * CHUNK, first


def count_chunks(data: np.ndarray, edges: np.ndarray, end: int, text_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and code points that begin in each chunk, by slabs of chunks."""
    tokens, points = np.zeros(len(edges), np.int64), np.zeros(len(edges), np.int64)
    stops, per = np.append(edges[1:], end), max(1, CHUNK_BYTES // CHUNK)
    for k in range(0, len(edges), per):
        a, b = int(edges[k]), int(stops[min(k + per, len(edges)) - 1])
        here = data[a:b]
        before = np.empty_like(here)
        before[1:], before[0] = here[:-1], data[a - 1] if a else 0
        fresh = np.zeros(b - a, bool)
        fresh[text_starts[np.searchsorted(text_starts, a) : np.searchsorted(text_starts, b)] - a] = True
        at = edges[k : k + per] - a
        tokens[k : k + per] = np.add.reduceat(_begins(here, before, fresh).astype(np.int64), at)
        points[k : k + per] = np.add.reduceat(_LEADS[here].astype(np.int64), at)
    return tokens, points


def locate(data: np.ndarray, edges: np.ndarray, end: int, text_starts: np.ndarray, tokens: np.ndarray, points: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte at which each token of a rank (counted over all texts, ascending not needed) begins, and the
    code points of all chunks before that byte; only the chunks that own one are looked at."""
    cum = np.append(0, np.cumsum(tokens))
    owner = np.searchsorted(cum, rank, "right") - 1
    owners, which = np.unique(owner, return_inverse=True)
    stops = np.append(edges[1:], end)
    size = stops[owners] - edges[owners]
    shift = np.append(0, np.cumsum(size))
    place = np.arange(shift[-1]) - np.repeat(shift[:-1], size) + np.repeat(edges[owners], size)
    fresh = np.isin(place, text_starts)
    begins = _begins(data[place], data[np.maximum(place - 1, 0)], fresh)
    found = np.flatnonzero(begins)
    first = np.append(0, np.cumsum(tokens[owners]))[:-1]
    at = found[first[which] + rank - cum[owner]]
    leads = np.append(0, np.cumsum(_LEADS[data[place]]))
    before = np.append(0, np.cumsum(points))[owner] + leads[at] - leads[shift[which]]
    return place[at], before


def cut_texts(data: np.ndarray, bounds: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each text: tokens, both cuts as bytes and as code points from its start, and its code points."""
    edges, first = chunk_edges(bounds)
    end, text_starts = int(bounds[-1]), bounds[:-1][np.diff(bounds) > 0]
    tokens, points = count_chunks(data, edges, end, text_starts)
    total, chars = np.append(0, np.cumsum(tokens)), np.append(0, np.cumsum(points))
    n, n_chars = total[first[1:]] - total[first[:-1]], chars[first[1:]] - chars[first[:-1]]
    one, two = h1 % (n + 1), h2 % (n + 1)
    cuts = []
    for r in (np.minimum(one, two), np.maximum(one, two)):
        byte, point = np.diff(bounds), n_chars.copy()  # a cut behind the last token
        inner = np.flatnonzero(r < n)
        if len(inner):
            b, p = locate(data, edges, end, text_starts, tokens, points, total[first[inner]] + r[inner])
            byte[inner], point[inner] = b - bounds[inner], p - chars[first[inner]]
        cuts += [byte, point]
    return n, *cuts, n_chars


def fill_in_middle(docs: DataFrame, seed: int = 1, rate: int = RATE, spm_rate: int = SPM_RATE, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for each row of ``docs(doc_id, text)``: its
    tokens, ``plain``, ``psm`` or ``spm``, the code points of the first two parts (null if plain) and the text
    put together. ``sentinels`` stand before prefix, suffix and middle."""
    marks = [s.encode() for s in sentinels]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").fill_null("")
            data, bounds = bytes_and_bounds(texts)
            h1, h2, h3, h4 = (batch.column(f"h{k}").to_numpy() for k in range(1, 5))
            plain = (np.diff(bounds) == 0) | (h3 % 100 >= rate)
            for s in sentinels:
                plain |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
            for a, b in portions(bounds):
                lo, hi = int(bounds[a]), int(bounds[b])
                n, b1, p1, b2, p2, _ = cut_texts(data[lo:hi], bounds[a : b + 1] - lo, h1[a:b], h2[a:b])
                spm, out = h4[a:b] % 100 < spm_rate, []
                for k, text in enumerate(texts[a:b].cast(pa.large_binary()).to_pylist()):
                    if not plain[a + k]:
                        x, y = b1[k], b2[k]
                        p, m, s = marks[0] + text[:x], marks[2] + text[x:y], marks[1] + text[y:]
                        text = b"".join((s, p, m) if spm[k] else (p, s, m))
                    out.append(text)
                form = np.where(plain[a:b], "plain", np.where(spm, "spm", "psm"))
                nulls = plain[a:b]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[a:b], pa.array(n), pa.array(form.tolist(), pa.string()), pa.array(p1, mask=nulls), pa.array(p2 - p1, mask=nulls),
                        pa.array(out, pa.binary()).view(pa.string()),
                    ],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), *(h.alias(f"h{k}") for k, h in enumerate(draws(F.col("doc_id"), seed), 1)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that ``output`` was made of."""
    part = lambda k: F.get(F.split(output, "|".join(f"\\Q{s}\\E" for s in sentinels), -1), F.lit(k))
    return F.when(form == "psm", F.concat(part(1), part(3), part(2))).when(form == "spm", F.concat(part(2), part(3), part(1))).otherwise(output)


def digests(docs: DataFrame) -> DataFrame:
    """The result of the contract: each text's form and lengths, with hashes of the output and of what
    :func:`restore` makes of it."""
    made = fill_in_middle(docs)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


_H = "cast(concat('0x', substr(sha256('1:' || coalesce(cast(doc_id as varchar), '')), {at}, 8)) as bigint)"
ORACLE = f"""
with d as (
  select doc_id, coalesce(text, '') as t, {_H.format(at=1)} as h1, {_H.format(at=9)} as h2, {_H.format(at=17)} as h3, {_H.format(at=25)} as h4,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as w
  from documents
), c as (
  select *, len(w) as n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) as a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) as b,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= {RATE} then 'plain' when h4 % 100 < {SPM_RATE} then 'spm' else 'psm' end as form
  from d
), x as (
  select doc_id, n, form, t, array_to_string(w[1:a], '') as p, array_to_string(w[a + 1:b], '') as m, array_to_string(w[b + 1:n], '') as s from c
)
select doc_id, cast(n as bigint) as n, form,
  case when form <> 'plain' then cast(length(p) as bigint) end as prefix_chars, case when form <> 'plain' then cast(length(m) as bigint) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then concat('<P>', p, '<S>', s, '<M>', m) else concat('<S>', s, '<P>', p, '<M>', m) end) as output_sha256,
  sha256(t) as restored_sha256
from x
"""
