"""Mixing sources to target weights by pivotal dependent rounding.

A source's target is its weight's share of all words, at most ``most`` times its own words; what the
bound takes away is shared again by weight. Each of its documents is then due ``target / size`` copies:
the whole part always, the fractional part by rounding. Rounding is pivotal: two documents with
fractional copies exchange mass (in words, so that their words together stay the same) at random until
one of them is integral, with each document's expectation unchanged. Leaves of bounded size round
their documents one after the other and hand on the one document that is left fractional; a reduction
tree combines those residuals, ``fan`` at a time, until one per source is left, which is rounded by
itself. So a source's words differ from its target by less than one document's size.

All random numbers are hashes of ids, texts and a seed, and every order is total, so reruns agree.

Defined cases: a null or blank text has size 0 and is taken 0 words; a null source is a source of its
own, last in the order of weights; a null doc_id is told apart by its text; repeated rows are rounded as
separate documents, all in one leaf if they are equal in id and text; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dawnpress.plans.lineage import cut

_WORD = r"[^\x20\x09-\x0D]+"
_UNIT = float(1 << 53)
#: Sources whose targets are broadcast at most, and into how many parts a source is split beyond that.
FEW, SALTS = 100_000, 64


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, source, size``: the text's hash and the number of words of the whole text."""
    return docs.select("doc_id", F.xxhash64("text").alias("mark"), "source", F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long").alias("size"))


def share_out(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """Targets: ``share`` of all sizes by weight, none above ``most`` times its size, the excess shared
    again by weight among the others until none is above."""
    left, free, out = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while free:
        total = sum(weights[i] for i in free)
        over = {i for i in free if left * weights[i] / total >= most * sizes[i]}
        if not over:
            for i in free:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = float(most * sizes[i])
        left -= sum(out[i] for i in over)
        free -= over
    return out


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0, most: float = 3.0, leaf: int = 4096) -> list[tuple[str | None, int, float, int]]:
    """(source, source_size, target, leaves) for each source."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    rows = sorted((r for r in by.collect()), key=lambda r: (r["source"] is None, r["source"] or ""))  # a row per source
    got = share_out([r["source_size"] for r in rows], [weights[i % len(weights)] for i in range(len(rows))], share, most)
    return [(r["source"], r["source_size"], t, -(-r["n"] // leaf)) for r, t in zip(rows, got, strict=True)]


def _with_targets(sizes: DataFrame, rows: list[tuple]) -> DataFrame:
    """``sizes`` with its source's size, target and leaves. A source may hold any share of the rows: up to
    ``FEW`` sources are broadcast, and of more, each one's target is sent to ``SALTS`` tasks."""
    t = sizes.sparkSession.createDataFrame(rows, "__s string, source_size long, target double, leaves long")
    if len(rows) <= FEW:
        return sizes.join(F.broadcast(t), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    t = t.withColumn("__k", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = sizes.withColumn("__j", F.pmod(F.xxhash64("doc_id", "mark"), F.lit(SALTS)).cast("int"))
    return salted.join(t, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__j") == F.col("__k"))).drop("__s", "__j", "__k")


def _settle(size: list[int], x: list[float], luck: list[float]) -> tuple[list[int], int | None, float]:
    """Round all but one: copies by row (0 or 1), the row that stays fractional, and its fraction."""
    copies, held, f = [0] * len(x), None, 0.0
    for j, fj in enumerate(x):
        if fj <= 0.0 or fj >= 1.0:
            copies[j] = int(fj >= 1.0)
            continue
        if held is None:
            held, f = j, fj
            continue
        a, b = size[held], size[j]
        give, take = min((1 - f) * a, fj * b), min(f * a, (1 - fj) * b)  # words to the held one, or from it
        move = give if luck[j] * (give + take) < take else -take
        fi, fj = f + move / a, fj - move / b
        # the end that was reached is set exactly
        if move > 0:
            first = (1 - f) * a <= fj * b + move and (1 - f) * a <= give
            fi, fj = (1.0, max(0.0, fj)) if first else (fi, 0.0)
        else:
            first = f * a <= take
            fi, fj = (0.0, min(1.0, fj)) if first else (fi, 1.0)
        if fi <= 0.0 or fi >= 1.0:
            copies[held] = int(fi >= 1.0)
            held, f = (j, fj) if 0.0 < fj < 1.0 else (None, 0.0)
            if held is None:
                copies[j] = int(fj >= 1.0)
        else:
            copies[j] = int(fj >= 1.0)
            f = fi
    return copies, held, f


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0, most: float = 3.0, seed: int = 17, leaf: int = 4096, fan: int = 64) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` (and ``source, mark, copies``) for each row of
    ``docs(doc_id, text, source)``."""
    sizes = cut(sized(docs), "sizes")
    return _mix_sizes(sizes, weights, share, most, seed, leaf, fan)


def _mix_sizes(sizes: DataFrame, weights, share, most, seed, leaf, fan) -> DataFrame:
    sources = targets(sizes, weights, share, most, leaf)
    due = _with_targets(sizes, sources)
    due = due.withColumn("each", F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)))
    due = due.withColumn("whole", F.floor("each").cast("long")).withColumn("x", F.when(F.col("size") > 0, F.col("each") - F.floor("each")).otherwise(0.0))
    rest = due.select(
        "doc_id", "mark", "source", "size", "source_size", "target", "whole", "x", "leaves",
        F.pmod(F.xxhash64(F.lit(seed), "doc_id", "mark"), F.col("leaves")).alias("at"),
    )
    schema = rest.drop("leaves", "at").schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ")
    out_schema = schema + ", leaves long, at long, extra long"

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "order", "doc_id", "mark", "x"], ascending=[False, True, True, True, True], kind="stable").reset_index(drop=True)
        copies, held, f = _settle(pdf["size"].tolist(), pdf["x"].tolist(), pdf["luck"].tolist())
        pdf["extra"] = pd.array(copies, "Int64")
        if held is not None:
            pdf.loc[held, "x"] = f
            pdf.loc[held, "extra"] = pd.NA
        return pdf.drop(columns=["order", "luck"])

    parts: list[DataFrame] = []
    level, top = 0, max((r[3] for r in sources), default=0)
    while True:
        luck = (F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "doc_id", "mark"), F.lit(1 << 53)) / F.lit(_UNIT)).alias("luck")
        order = F.xxhash64(F.lit(seed), F.lit(level), F.lit("o"), "doc_id", "mark").alias("order")
        done = cut(rest.select("*", order, luck).groupBy("source", "at").applyInPandas(settle, out_schema), f"round{level}")
        if top <= 1:
            parts.append(done)
            break
        parts.append(done.where("extra is not null"))
        top = -(-top // fan)
        rest = done.where("extra is null").drop("extra").withColumn("at", F.floor(F.col("at") / F.lit(fan)).cast("long"))
        level += 1
    alone = F.pmod(F.xxhash64(F.lit(seed), F.lit("last"), "doc_id", "mark"), F.lit(1 << 53)) / F.lit(_UNIT)
    parts[-1] = parts[-1].withColumn("extra", F.coalesce("extra", (alone < F.col("x")).cast("long")))
    got = parts[0]
    for p in parts[1:]:
        got = got.unionByName(p)
    copies = F.col("whole") + F.when(F.col("size") > 0, F.col("extra")).otherwise(0)
    return got.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), "source", "mark", copies.alias("copies"))


def take_mix(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with the same columns. Documents without
    words are taken once: they weigh nothing. Rows are told apart by ``doc_id``, the text's hash and their
    place among equal ones."""
    key = ["doc_id", "mark", "source", "size"]
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("__row"), docs["doc_id"].alias("doc_id"), F.xxhash64(docs["text"]).alias("mark"), docs["source"].alias("source"), F.coalesce(F.regexp_count(docs["text"], F.lit(_WORD)), F.lit(0)).cast("long").alias("size"))
    plan = mix(docs, **how).select(*key, F.when(F.col("size") > 0, F.col("copies")).otherwise(1).alias("__n"))
    place = lambda *order: F.row_number().over(Window.partitionBy(*key).orderBy(*order)).alias("__k")
    plan = plan.select(*(F.col(c).alias(f"__{c}") for c in key), "__n", place(F.desc("__n")))
    rows = rows.select("*", place(F.xxhash64("__row.text")))
    same = F.lit(True)
    for c in (*key, "k"):
        mine = F.col(c) if c != "k" else F.col("__k")
        same = same & (rows["__k" if c == "k" else c].eqNullSafe(plan[f"__{c}"]))
    got = rows.join(plan, same).where("__n > 0")
    return got.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n")))).select("__row.*")
