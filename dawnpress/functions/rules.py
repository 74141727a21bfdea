"""Rule classifiers compiled into column expressions: impact, direction, tax, AI, disaster.

The phrases of all lists are looked up at once (:func:`matches`): one pattern, a prefix tree of all phrases,
goes over a text's padded words and gives the longest phrase that begins at each word. A list is hit when one
of these is on it or begins with a phrase of it, which is known beforehand (:func:`_covering`). Rules then only
compare short arrays. :func:`found` is a text's part that all rules share: a caller that applies several
writes it once.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from dawnpress.functions import fixed_values as V
from dawnpress.functions.text import padded, word_list


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


# -- looking up phrases ----------------------------------------------------------------------------


def _tree(phrases: Iterable[str]) -> str:
    """A pattern for any of the phrases, the longest first, in which common beginnings are read once."""
    by: dict[str, set[str]] = {}
    for p in phrases:
        by.setdefault(p[:1], set()).add(p[1:])
    end = by.pop("", None)
    if not by:
        return ""
    ways = [re.escape(c) + _tree(rest) for c, rest in sorted(by.items())]
    whole = ways[0] if len(ways) == 1 and end is None else f"(?:{'|'.join(ways)})"
    return whole + ("?" if end is not None else "")


@cache
def _pattern(phrases: frozenset[str]) -> str:
    # only the blank before a phrase is consumed, so phrases may overlap
    return f" (?=({_tree(phrases)}) )"


def matches(text: Column, phrases: Iterable[str]) -> Column:
    """The longest of ``phrases`` that begins at each word of a padded text, in the text's order."""
    return F.regexp_extract_all(text, F.lit(_pattern(frozenset(phrases))), F.lit(1))


def _covering(phrases: Iterable[str], known: Iterable[str]) -> list[str]:
    """The known phrases whose match says that one of ``phrases`` is there: they are it or begin with its words."""
    return sorted(k for k in known if any(k == p or k.startswith(f"{p} ") for p in phrases))


def _groups(*lists) -> frozenset[str]:
    out: set[str] = set()
    for x in lists:
        for p in x.values() if isinstance(x, dict) else [x]:
            out.update(p)
    return frozenset(out)


#: All phrases that rules look for, in titles and in whole texts.
PHRASES = _groups(
    V.BIG_PHRASES, V.MEDIUM_PHRASES, V.DISCARD_PHRASES, V.ACCIDENT_PHRASES, V.DISASTER_EVENTS, V.DISASTER_SCALE, V.TAX_MARKERS, V.TAX_AMBIGUOUS, list(V.TAX_AMBIGUOUS),
    V.TAX_REGIONAL, V.TAX_DISCARD, V.TAX_TOPICS, V.AI_MARKERS, V.AI_AMBIGUOUS, list(V.AI_AMBIGUOUS), V.AI_DISCARD, V.AI_TOPICS, V.CENTRAL_BANK_WORDS, V.POLITICS_WORDS,
)


def found(title: str = "title", summary: str = "summary") -> Column:
    """``struct(head, whole)``: the phrases of the title and of the title with summary."""
    return F.struct(matches(padded(title), PHRASES).alias("head"), matches(padded(title, summary), PHRASES).alias("whole"))


def _texts(title: str, summary: str, hits: Column | None, body) -> Column:
    """``body`` of the phrases of the title and of the title with summary."""
    return body(hits["head"], hits["whole"]) if hits is not None else _let(found(title, summary), lambda t: body(t["head"], t["whole"]))


def _has(hits: Column, phrases: Iterable[str], known: Iterable[str] = PHRASES) -> Column:
    """Whether one of the phrases is among a text's matches of ``known`` ones."""
    return F.arrays_overlap(hits, F.array(*map(F.lit, _covering(phrases, known))))


def _label(hits: Column, groups: dict[str, list[str]], known: Iterable[str] = PHRASES) -> Column:
    return F.coalesce(*(F.when(_has(hits, p, known), F.lit(label)) for label, p in groups.items()))


def has_phrase(text: Column, phrases: list[str]) -> Column:
    return F.size(matches(text, phrases)) > 0


def first_label(text: Column, groups: dict[str, list[str]]) -> Column:
    known = _groups(groups)
    return _let(matches(text, known), lambda t: _label(t, groups, known))


def _disaster(whole: Column) -> Column:
    return _has(whole, V.DISASTER_EVENTS) & _has(whole, V.DISASTER_SCALE)


def disaster(title: str = "title", summary: str = "summary", hits: Column | None = None) -> Column:
    return _texts(title, summary, hits, lambda head, whole: _disaster(whole))


def impact(title: str = "title", summary: str = "summary", n_media: str = "n_media", weight: str = "weight", hits: Column | None = None) -> Column:
    """``struct(impact, reason)``; 0 discards."""
    primary = F.col(weight) >= V.PRIMARY_WEIGHT
    level = lambda n, reason: F.struct(F.lit(n).alias("impact"), reason.cast("string").alias("reason"))

    def lists(whole: Column) -> Column:
        return F.struct(
            _label(whole, V.BIG_PHRASES).alias("big"), _label(whole, V.MEDIUM_PHRASES).alias("medium"), _disaster(whole).alias("crash"),
            _has(whole, V.DISCARD_PHRASES).alias("discard"), _has(whole, V.ACCIDENT_PHRASES).alias("accident"),
        )

    def judge(x: Column) -> Column:
        noise = x["big"].isNull() & (x["discard"] | (~x["crash"] & x["accident"]))
        return (
            F.when(noise, level(0, F.lit(None)))
            .when(x["big"].isNotNull() | (F.col(n_media) >= V.WIDE_MEDIA), level(3, F.coalesce(x["big"], F.lit(V.LABELS["wide"]))))
            .when(x["crash"], level(2, F.lit(V.LABELS["disaster"])))
            .when(x["medium"].isNotNull(), level(2, x["medium"]))
            .when((F.col(n_media) >= V.SOME_MEDIA) | primary, level(2, F.when(primary, V.LABELS["primary"]).otherwise(V.LABELS["wider"])))
            .otherwise(level(1, F.lit(None)))
        )

    return _let(_texts(title, summary, hits, lambda head, whole: lists(whole)), judge)


def _any_marker(title: Column, whole: Column, markers: list[str], ambiguous: dict[str, list[str]], companions: bool) -> Column:
    out = _has(title, markers)
    for word, others in ambiguous.items():
        beside = _has(whole, others)
        out = out | (_has(title, [word]) & (beside if companions else ~beside))
    return out


def _ends(column: str, ends: list[str]) -> Column:
    out = F.lit(False)
    for e in ends:
        out = out | F.col(column).endswith(e)
    return out


def _is_tax(head: Column, whole: Column, domain: str) -> Column:
    return ~F.col(domain).isin(V.TAX_FOREIGN) & _any_marker(head, whole, V.TAX_MARKERS, V.TAX_AMBIGUOUS, False)


def _is_ai(head: Column, whole: Column, title: str) -> Column:
    return F.col(title).rlike(V.AI_CAPITALS) | _any_marker(head, whole, V.AI_MARKERS, V.AI_AMBIGUOUS, True)


def _ai_discard(head: Column, title: str, domain: str) -> Column:
    return _has(head, V.AI_DISCARD) | F.col(domain).isin(V.AI_DISCARD_DOMAINS) | _ends(domain, V.AI_DISCARD_ENDS) | F.col(title).rlike(r"(?U)(\.\.\.|…)\s*$")


def tax_class(title: str = "title", summary: str = "summary", domain: str = "domain", hits: Column | None = None) -> Column:
    """``struct(is_tax, regional, discard, topic)``."""

    def judge(head: Column, whole: Column) -> Column:
        regional = _has(whole, V.TAX_REGIONAL) | _ends(domain, V.REGIONAL_DOMAINS)
        return F.struct(
            _is_tax(head, whole, domain).alias("is_tax"), regional.alias("regional"), _has(head, V.TAX_DISCARD).alias("discard"),
            F.when(regional, V.TAX_REGIONAL_TOPIC).otherwise(_label(whole, V.TAX_TOPICS)).alias("topic"),
        )

    return _texts(title, summary, hits, judge)


def ai_class(title: str = "title", summary: str = "summary", domain: str = "domain", hits: Column | None = None) -> Column:
    """``struct(is_ai, discard, topic)``."""
    return _texts(title, summary, hits, lambda head, whole: F.struct(_is_ai(head, whole, title).alias("is_ai"), _ai_discard(head, title, domain).alias("discard"), _label(whole, V.AI_TOPICS).alias("topic")))


def ai_pool(category: str = "category", title: str = "title", summary: str = "summary", domain: str = "domain", hits: Column | None = None) -> Column:
    """Whether the AI section will take an event, which the tax section has not taken first."""

    def judge(head: Column, whole: Column) -> Column:
        candidate = (F.col(category) == "ai") | F.col(category).isin(V.AI_MOVES_FROM)
        to_tax = F.col(category).isin(V.TAX_MOVES_FROM) & _is_tax(head, whole, domain)
        return candidate & _is_ai(head, whole, title) & ~_ai_discard(head, title, domain) & ~to_tax

    return _texts(title, summary, hits, judge)


def relevant(category: str = "category", title: str = "title", summary: str = "summary", domain: str = "domain", hits: Column | None = None) -> Column:
    bank = F.col(domain).isin(V.CENTRAL_BANKS)
    judge = lambda head, whole: F.when(bank, _has(head, V.CENTRAL_BANK_WORDS)).when(F.col(category) == "politik", _has(whole, V.POLITICS_WORDS) | _disaster(whole)).otherwise(F.lit(True))
    return _texts(title, summary, hits, judge)


def themes(title: str = "title", summary: str = "summary", hits: Column | None = None) -> Column:
    """The labels of all groups of impact phrases that an article has one of."""
    groups = V.BIG_PHRASES | V.MEDIUM_PHRASES
    return _texts(title, summary, hits, lambda head, whole: F.filter(F.array(*(F.when(_has(whole, p), F.lit(k)) for k, p in groups.items())), lambda x: x.isNotNull()))


# -- direction (sentiment) -------------------------------------------------------------------------


def _set(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def _before(w: Column, i: Column, n: int) -> Column:
    """The ``n`` words before place ``i`` (from 0), in their order."""
    start = F.greatest(i - n, F.lit(0))
    return F.slice(w, start + 1, i - start)


_DIRECTED = _groups(V.POSITIVE_PHRASES, V.NEGATIVE_PHRASES)


def _phrases(w: Column, hits: Column, phrases: list[str], sign: int) -> Column:
    """Triggers of fixed phrases, in the list's order, then by place; only phrases among the matches are looked for."""
    negated = lambda i: F.arrays_overlap(_before(w, i, V.NEGATION_REACH), _set(V.NEGATIONS))

    def of(p: Column) -> Column:
        parts = F.split(p, " ")
        n = F.size(parts)
        at = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: (F.get(w, i) == F.get(parts, F.lit(0))) & (F.slice(w, i + 1, n) == parts))
        return F.transform(at, lambda i: F.struct(F.when(negated(i), -sign).otherwise(sign).alias("sign"), p.alias("name")))

    present = F.filter(_set(phrases), lambda p: F.exists(hits, lambda h: (h == p) | F.startswith(h, F.concat(p, F.lit(" ")))))
    return F.flatten(F.transform(present, of))


def _directions(w: Column) -> Column:
    at = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.get(w, i).isin(V.UP_WORDS + V.DOWN_WORDS))
    pick = lambda side, words: F.get(F.filter(side, lambda k: k.isin(words)), F.lit(0))

    def of(i: Column) -> Column:
        left = F.reverse(_before(w, i, V.LEFT_REACH))
        right = F.slice(w, i + 2, V.RIGHT_REACH)
        found = lambda s, words, good: F.when(pick(s, words).isNotNull(), F.struct(pick(s, words).alias("name"), F.lit(good).alias("good")))
        subject = F.coalesce(*(found(s, words, good) for s in (left, right) for words, good in ((V.BAD_SUBJECTS, False), (V.GOOD_SUBJECTS, True))))
        flip = F.arrays_overlap(_before(w, i, V.NEGATION_REACH), _set(V.NEGATIONS + V.REVERSERS))
        sign = F.when((F.get(w, i).isin(V.UP_WORDS) == subject["good"]) != flip, 1).otherwise(-1)
        return F.when(subject.isNotNull(), F.struct(sign.alias("sign"), F.concat_ws(" ", subject["name"], F.get(w, i)).alias("name")))

    return F.filter(F.transform(at, of), lambda x: x.isNotNull())


def _triggers(text: str | Column) -> Column:
    kind = "array<struct<sign:int,name:string>>"
    none = F.array().cast(kind)

    def every(t: Column) -> Column:
        w, hits = t["words"], t["hits"]
        fixed = F.when(F.size(hits) > 0, F.concat(_phrases(w, hits, V.POSITIVE_PHRASES, 1), _phrases(w, hits, V.NEGATIVE_PHRASES, -1)).cast(kind)).otherwise(none)
        moving = F.when(F.arrays_overlap(w, _set(V.UP_WORDS + V.DOWN_WORDS)), _directions(w).cast(kind)).otherwise(none)
        return F.concat(fixed, moving)

    return _let(F.struct(word_list(text).alias("words"), matches(padded(text), _DIRECTED).alias("hits")), every)


def direction(title: str = "title", summary: str = "summary") -> Column:
    """``struct(label, score, trigger)``: the title's triggers count twice the summary's."""
    total = lambda t: F.aggregate(t, F.lit(0), lambda a, x: a + x["sign"])

    def judge(t: Column) -> Column:
        score = total(t["a"]) * V.TITLE_WEIGHT + total(t["b"]) * V.SUMMARY_WEIGHT
        return F.struct(
            F.when(score > 0, "positif").when(score < 0, "negatif").otherwise("netral").alias("label"), score.alias("score"),
            F.when(score != 0, F.coalesce(F.get(t["a"], F.lit(0))["name"], F.get(t["b"], F.lit(0))["name"])).alias("trigger"),
        )

    return _let(F.struct(_triggers(title).alias("a"), _triggers(summary).alias("b")), judge)
