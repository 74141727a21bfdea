"""Quality rules: a threshold table compiled into one projection, without user functions.

Words are ``[^\\x20\\x09-\\x0D]+``. Every measure is a built-in expression over one row, so the scan,
the measures and the verdict are one stage without a shuffle, whatever the number of rows.

Defined cases: a null text measures as an empty one (0 everywhere, rejected by the base rule); texts
of any length are measured whole (repeats are found by sorting, not by comparing all pairs); repeated
rows are judged alike; other columns, whatever their names, pass through :func:`keep_good` untouched.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORD = r"[^\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"

#: Very frequent words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in is that it for on with as be this by are from at or an "
    "le la les de des du un une et en est que qui dans par pour sur au ce il "
    "der die das und von den zu mit ist ein eine im auf nicht für dem es sich "
    "el los las del y en un una se por con para su al lo como más o es no"
).split()


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie in ``[low, high]``; None leaves an end open."""

    measure: str
    low: float | None = None
    high: float | None = None


#: The threshold table. Ratios are per word, per character or per line; see ``MEASURES``.
RULES = (
    Rule("mean_word_chars", 2.0, 15.0),
    Rule("symbol_ratio", None, 0.06),
    Rule("stop_word_ratio", 0.02, None),
    Rule("dup_line_ratio", None, 0.50),
    Rule("words_per_line", 2.0, None),
)

#: Measures over the base columns; a ratio over nothing is 0.
MEASURES: dict[str, Callable[[], Column]] = {
    "mean_word_chars": lambda: F.coalesce(F.try_divide("word_chars", "n_words"), F.lit(0.0)),
    "symbol_ratio": lambda: F.coalesce(F.try_divide("n_symbols", "word_chars"), F.lit(0.0)),
    "stop_word_ratio": lambda: F.coalesce(F.try_divide("n_stop_words", "n_words"), F.lit(0.0)),
    "dup_line_ratio": lambda: F.coalesce(F.try_divide("n_dup_lines", "n_lines"), F.lit(0.0)),
    "words_per_line": lambda: F.coalesce(F.try_divide("n_words", "n_lines"), F.lit(0.0)),
}

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once for the row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the row."""
    at = lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    starts = F.sequence(F.lit(0), F.size(words) - 3)
    hashed = F.transform(starts, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def covered(windows: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(windows, k)["g"] == x["g"], F.lit(False))
        twice = F.filter(windows, lambda x, k: same(x, k - 1) | same(x, k + 1))
        return _let(
            F.array_sort(F.transform(twice, lambda x: x["i"])),
            lambda p: F.aggregate(F.transform(p, lambda i, k: F.coalesce(F.least(F.get(p, k + 1) - i, F.lit(3)), F.lit(3))), F.lit(0), lambda a, x: a + x),
        )

    def exact(h: Column) -> Column:
        windows = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), at(i).alias("g"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_let(windows, covered))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(_let(hashed, exact))


def measure(docs: DataFrame, keep: list[str | Column] | None = None) -> DataFrame:
    """The base columns, ``n_lines`` and ``n_stop_words`` beside the columns ``keep`` over ``docs``."""
    text, keep = F.coalesce(F.col("text"), F.lit("")), keep or ["doc_id"]
    got = docs.select(*(k for k in keep if isinstance(k, str)), text.alias("__t"))
    got = got.withColumn("__w", F.regexp_extract_all("__t", F.lit(_WORD), F.lit(0)))
    got = got.withColumn("__l", F.filter(F.split("__t", "\n"), lambda x: x.rlike(_WORD)))
    n = lambda c: c.cast("long")
    return got.select(
        *keep,
        n(F.size("__w")).alias("n_words"),
        n(F.length(F.translate("__t", " \t\n\x0b\x0c\r", ""))).alias("word_chars"),
        n(F.length("__t") - F.length(F.translate("__t", _SYMBOLS, ""))).alias("n_symbols"),
        n(F.size("__l") - F.size(F.array_distinct("__l"))).alias("n_dup_lines"),
        n(_repeat_words(F.col("__w"))).alias("n_repeat_words"),
        n(F.size("__l")).alias("n_lines"),
        n(F.size(F.filter("__w", lambda w: F.lower(w).isin(STOP_WORDS)))).alias("n_stop_words"),
    )


def verdict(rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """``base_failed`` and ``kept`` over the columns of :func:`measure`."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    good = ~base
    for r in rules:
        value = MEASURES[r.measure]()
        for bound, ok in ((r.low, value >= F.lit(r.low)), (r.high, value <= F.lit(r.high))):
            good = good & ok if bound is not None else good
    return base, good


def score_quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, the base columns, ``base_failed`` and ``kept`` for each row of ``docs``."""
    base, good = verdict(rules)
    return measure(docs).select("doc_id", *BASE, base.alias("base_failed"), good.alias("kept"), "n_lines", "n_stop_words")


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the same columns."""
    whole = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("__row"), docs["text"].alias("text"))
    # The running number keeps the filter above the measures: pushed below, each of its mentions of a
    # measure would become a copy of that measure's expression.
    return measure(whole, ["__row", F.monotonically_increasing_id().alias("__n")]).where(verdict(rules)[1] & (F.col("__n") >= 0)).select("__row.*")


ORACLE = r"""
with d as (select doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) l
           from documents),
g as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] g from (select doc_id, w, unnest(range(1, len(w) - 1)) i from d where len(w) >= 3)),
r as (select doc_id, i from (select *, count(*) over (partition by doc_id, g) n from g) where n > 1),
c as (select doc_id, count(distinct p) n from (select doc_id, unnest([i, i + 1, i + 2]) p from r) group by doc_id),
m as (select d.doc_id, len(w)::bigint n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::bigint word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint n_symbols,
             (len(l) - len(list_distinct(l)))::bigint n_dup_lines, coalesce(c.n, 0)::bigint n_repeat_words, len(l)::bigint n_lines,
             len(list_filter(w, lambda x: lower(x) in ({STOP})))::bigint n_stop_words
      from d left join c using (doc_id)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and coalesce(word_chars::double / nullif(n_words, 0), 0) between 2 and 15
       and coalesce(n_symbols::double / nullif(word_chars, 0), 0) <= 0.06::double
       and coalesce(n_stop_words::double / nullif(n_words, 0), 0) >= 0.02::double
       and coalesce(n_dup_lines::double / nullif(n_lines, 0), 0) <= 0.50::double
       and coalesce(n_words::double / nullif(n_lines, 0), 0) >= 2 kept, n_lines, n_stop_words
from b
""".replace("{STOP}", ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS)))
