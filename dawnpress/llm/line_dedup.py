"""Line dedup by a deletion-neighbourhood join, with DataFrame functions only.

A line is the lower-cased sequence of its words. A line of ``least`` words or more is a near copy of
another when one word inserted, deleted or replaced makes them equal; shorter lines must be equal. Every
line that has an equal or near copy earlier in the corpus (smaller doc_id, then line number) is removed;
lines are judged on the input, not on what is left.

1. Lines are reduced to two 64-bit hashes; equal lines combine to the earliest before anything else.
2. One edit leaves one half of a line alone, so near copies share the hash of a half (by the shorter
   line's length). Lines without a shared half have no near copy and go no further. The same holds for
   the other half, and so on: after ``LEVELS`` halvings a small region is left that may differ.
3. Lines that still share all but their regions emit a key for each word deleted in the region: with its
   place, for replacements; without it, beside the whole region's key, for insertions. Equal keys join;
   per key only the earliest line is gathered (``min`` combines before the shuffle): no key emits pairs.
   Keys of insertions gather the earliest shorter and the earliest longer line apart, and only a shorter
   and a longer line meet: two longer lines that each lose a word are two edits apart. So all that meet
   are near copies (up to equal hashes), and the earliest of them over all keys is the one to compare.
4. The two lines' words are compared and the earliest line is kept.

Defined cases: null text and lines without words are no lines; repeated rows are at the same place and
do not remove each other; rows without a doc_id come before all others and are at one place, and
:func:`drop_near_lines`, which cannot name them, leaves their texts as they are; an empty table gives an empty result; lines may have any length; other
columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dawnpress.plans.lineage import cut
from dawnpress.plans.skew import hot_keys, join_spread

#: Halvings of a line before its variants are written out.
LEVELS = 5

#: White space inside a text that is not one space between words (lines stay apart).
_GAP = r"[\x20\x09\x0B-\x0D]{2,}|[\x09\x0B-\x0D]"


def _lines(docs: DataFrame) -> DataFrame:
    """``doc_id, line_no, line``: lines that have words, lower-cased, one space between words. Texts are
    cleaned whole, once, and no line becomes an array of words here."""
    clean = F.regexp_replace(F.lower("text"), _GAP, " ")
    return docs.select("doc_id", F.posexplode(F.split(clean, "\n")).alias("line_no", "line")).select("doc_id", "line_no", F.trim("line").alias("line")).where("line <> ''")


def _half_keys(lines: DataFrame, least: int) -> DataFrame:
    """``e1, e2, place, keys``: two hashes of each line and the keys of its halves, by its own length and
    by one word less (as :func:`_halve` splits the first states). Of both lengths, the even one's halves are
    the other's but for one word at the middle: the line is cut once."""
    n, q, blob = F.col("n"), F.col("q"), lambda c: F.col(c).cast("binary")
    cutter = lambda c, k: F.call_function("substring_index", F.col(c), F.lit(" "), k)
    size = F.octet_length
    sized = lines.select("doc_id", "line_no", "line", (size("line") - size(F.replace("line", F.lit(" "))) + 1).alias("n"))
    headed = sized.withColumn("q", F.floor(n / 2).cast("int")).withColumn("head", cutter("line", q))
    halved = headed.withColumn("tail", F.substring(blob("line"), size("head") + F.when(q > 0, 2).otherwise(1), size("line")).cast("string"))
    less_head = F.when(n % 2 == 0, F.substring(blob("head"), F.lit(1), F.greatest(size("head") - size(cutter("head", F.lit(-1))) - 1, F.lit(0)))).otherwise(blob("head"))
    less_tail = F.when(n % 2 == 1, F.substring(blob("tail"), size(cutter("tail", F.lit(1))) + 2, size("tail"))).otherwise(blob("tail"))
    key = lambda side, m, part: F.when(m >= least, F.xxhash64(F.lit(side), m, part))
    keys = F.array_compact(F.array(key("p", n, blob("head")), key("s", n, blob("tail")), key("p", n - 1, less_head), key("s", n - 1, less_tail)))
    return halved.select(F.xxhash64("line").alias("e1"), F.xxhash64(F.lit(1), "line").alias("e2"), F.struct("doc_id", "line_no").alias("place"), keys.alias("keys"))


def _states(w: Column, least: int) -> Column:
    """What a line could share with a near copy, before any of it is known: by the shorter line's length,
    its own or one less, the region of words that may differ and how long the shorter line's is."""
    of = lambda n: F.struct(F.xxhash64(F.lit("n"), n).alias("key"), n.alias("n"), F.lit(0).alias("start"), F.size(w).alias("end"), n.alias("m"))
    return F.filter(F.array(of(F.size(w)), of(F.size(w) - 1)), lambda s: s["n"] >= least)


def _halve(w: Column, states: Column) -> Column:
    """One edit leaves one half of the region alone: its hash joins the key, the other half is the region."""

    def halves(s: Column) -> Column:
        q = F.floor(s["m"] / 2).cast("int")
        r = s["m"] - q
        head = F.xxhash64(F.lit("p"), s["key"], q, F.array_join(F.slice(w, s["start"] + 1, q), " "))
        tail = F.xxhash64(F.lit("s"), s["key"], q, F.array_join(F.slice(w, s["end"] - r + 1, r), " "))
        make = lambda key, start, end, m: F.struct(key.alias("key"), s["n"].alias("n"), start.alias("start"), end.alias("end"), m.alias("m"))
        return F.array(make(head, s["start"] + q, s["end"], r), make(tail, s["start"], s["end"] - r, q))

    return F.flatten(F.transform(states, halves))


def near_lines(docs: DataFrame, least: int = 8) -> DataFrame:
    """``doc_id, line_no, first_doc_id, first_line_no`` for each removed line; the last two name the
    earliest line that it is a copy or near copy of."""
    lines = cut(_half_keys(_lines(docs), least), "lines")
    firsts = cut(lines.groupBy("e1", "e2").agg(F.min("place").alias("place"), F.first("keys").alias("keys"), F.count(F.lit(1)).alias("n")), "firsts")

    def shared(rows: DataFrame) -> DataFrame:
        """Rows whose key another line has, too."""
        return rows.join(rows.groupBy("key").agg(F.min("e1").alias("a"), F.max("e1").alias("b")).where("a <> b").select("key"), "key")

    # Only two numbers a key are shuffled; the lines of the documents that hold a hit are fetched again,
    # documents and hits meeting by doc_id alone. Hits grow with the corpus: no plan broadcasts them.
    hits = shared(firsts.select("e1", F.explode("keys").alias("key"))).select("e1").distinct()
    # A missing doc_id meets as -1: what else has that number is told apart by the line's hash.
    known = lambda c: F.coalesce(c, F.lit(-1)).alias("doc_id")
    first = cut(firsts.join(hits, "e1", "left_semi").select("e1", "e2", "place", known("place.doc_id"), "place.line_no"), "hits")
    held = docs.select(known("doc_id"), "text").join(first.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi")
    opened = cut(
        first.hint("merge").join(_lines(held), ["doc_id", "line_no"]).where(F.xxhash64("line") == F.col("e1")).select("e1", "e2", "place", F.split("line", " ").alias("w")), "open"
    )

    states = _states(F.col("w"), least)
    for _ in range(LEVELS):
        states = _halve(F.col("w"), states)
    close = cut(shared(opened.select("e1", "e2", F.explode(states).alias("s")).select("e1", "e2", "s.*")).groupBy("e1", "e2").agg(F.collect_set(F.struct("key", "n", "start", "end")).alias("states")), "close")
    one = opened.join(close, ["e1", "e2"]).select("e1", "e2", "place", F.size("w").alias("size"), F.explode("states").alias("s"), "w").select("e1", "e2", "place", "size", F.col("s.key").alias("state"), "s.n", F.slice("w", F.col("s.start") + 1, F.col("s.end") - F.col("s.start")).alias("r"))
    less = lambda i: F.concat_ws(" ", F.slice("r", F.lit(1), i), F.slice("r", i + 2, F.greatest(F.size("r") - i - 1, F.lit(0))))
    spots = F.when(F.size("r") > 0, F.sequence(F.lit(0), F.size("r") - 1)).otherwise(F.array().cast("array<int>"))
    own = F.concat(F.transform(spots, lambda i: F.xxhash64(F.lit("r"), "state", i, less(i))), F.array(F.xxhash64(F.lit("i"), "state", F.concat_ws(" ", "r"))))
    own = F.transform(own, lambda key, i: F.struct(key.alias("key"), F.when(i < F.size("r"), "r").otherwise("s").alias("role")))
    longer = F.transform(spots, lambda i: F.struct(F.xxhash64(F.lit("i"), "state", less(i)).alias("key"), F.lit("l").alias("role")))
    variants = F.when(F.col("size") == F.col("n"), own).otherwise(longer)
    keyed = cut(one.select("e1", "e2", "place", F.explode(F.array_distinct(variants)).alias("v")).select("e1", "e2", "place", "v.key", "v.role"), "variants")
    line = F.struct("place", "e1", "e2")
    met = keyed.groupBy("key").agg(F.min(F.when(F.col("role") != "l", line)).alias("even"), F.min(F.when(F.col("role") == "l", line)).alias("longer"), F.max("e1").alias("most"), F.min("e1").alias("least")).where("most <> least").select("key", "even", "longer")
    facing = keyed.join(met, "key").select("e1", "e2", "place", F.when(F.col("role") == "s", F.col("longer")).otherwise(F.col("even")).alias("first"))
    near = cut(facing.where("first.place < place").groupBy("e1", "e2").agg(F.min("first").alias("first")), "near")

    side = lambda p: opened.select(F.col("e1").alias(f"{p}1"), F.col("e2").alias(f"{p}2"), F.col("w").alias(f"{p}w"))
    pairs = near.select("e1", "e2", "first").join(side("x"), (F.col("e1") == F.col("x1")) & (F.col("e2") == F.col("x2"))).join(side("y"), (F.col("first.e1") == F.col("y1")) & (F.col("first.e2") == F.col("y2")))
    proved = cut(pairs.where(within_one("xw", "yw")).groupBy("e1", "e2").agg(F.min("first.place").alias("near")), "proved")  # once, though rows repeat

    keep = firsts.select("e1", "e2", F.col("place").alias("first")).join(proved, ["e1", "e2"], "left").select("e1", "e2", F.coalesce(F.least("near", "first"), "first").alias("first"))
    # a line may be in any share of all documents
    met = join_spread(lines.select("e1", "e2", "place"), keep, ["e1", "e2"], hot_keys(firsts, ["e1", "e2"]))
    return met.where("first < place").select("place.doc_id", "place.line_no", F.col("first.doc_id").alias("first_doc_id"), F.col("first.line_no").alias("first_line_no"))


def within_one(a: str, b: str) -> Column:
    """Whether two word arrays are at most one edit apart."""
    na, nb = F.size(a), F.size(b)
    short = F.least(na, nb)
    differs = F.filter(F.sequence(F.lit(0), short), lambda i: (i >= short) | (F.get(a, i) != F.get(b, i)))
    head = F.element_at(differs, 1)  # words that agree from the front
    rest = lambda x, n, skip: F.slice(x, head + skip + 1, F.greatest(n - head - skip, F.lit(0)))
    return (
        F.when((na == nb) & (head >= short), True)
        .when(na == nb, rest(a, na, 1) == rest(b, nb, 1))
        .when(na == nb + 1, rest(a, na, 1) == rest(b, nb, 0))
        .when(nb == na + 1, rest(a, na, 0) == rest(b, nb, 1))
        .otherwise(False)
    )


def drop_near_lines(docs: DataFrame, least: int = 8) -> DataFrame:
    """``docs`` with the removed lines taken out of their texts, with the same columns."""
    gone = near_lines(docs, least).groupBy("doc_id").agg(F.collect_set("line_no").alias("__gone")).withColumnRenamed("doc_id", "__doc")
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.coalesce(F.array_contains("__gone", i), F.lit(False))), "\n")
    joined = docs.join(gone, docs["doc_id"] == gone["__doc"], "left")
    return joined.withColumn("text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept)).select(docs.columns)


ORACLE = r"""
with l as (select doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 line_no, unnest(string_split(text, chr(10))) line from documents where text is not null),
w as (select distinct doc_id, line_no::int line_no, regexp_extract_all(lower(line), '[^\x20\x09-\x0D]+') w from l where regexp_matches(line, '[^\x20\x09-\x0D]')),
f as (select w, min(struct_pack(doc_id, line_no)) p, len(w) n from w group by w),
d as (select w, p, n, i, list_concat(w[1:i - 1], w[i + 1:]) v from (select *, unnest(range(1, n + 1)) i from f where n >= 8)),
pairs as (
  select a.w, b.p from d a join d b on a.v = b.v and a.i = b.i and a.n = b.n and b.p < a.p
  union all select a.w, b.p from d a join f b on a.v = b.w and b.n >= 8 and b.p < a.p
  union all select a.w, b.p from f a join d b on b.v = a.w and a.n >= 8 and b.p < a.p),
m as (select w, min(p) p from (select w, p from f union all select w, p from pairs) group by w)
select w.doc_id, w.line_no, m.p.doc_id first_doc_id, m.p.line_no first_line_no from w join m using (w)
where m.p < struct_pack(doc_id := w.doc_id, line_no := w.line_no)
"""
