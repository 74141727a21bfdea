"""Column expressions over titles, summaries, URLs and times. All are built in; none calls Python."""

from __future__ import annotations

import html
import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from dawnpress.functions import fixed_values as V

NOT_ALNUM = r"[^\p{L}\p{N}]+"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def padded(*parts: str | Column) -> Column:
    """Lower-cased words between single blanks, so that `` phrase `` is found on whole words only."""
    text = F.concat_ws(" ", *(F.coalesce(_c(p), F.lit("")) for p in parts))
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), NOT_ALNUM, " ")), F.lit(" "))


def word_list(*parts: str | Column) -> Column:
    return F.filter(F.split(padded(*parts), " "), lambda w: w != "")


def stem(word: Column) -> Column:
    """At most one suffix, then at most one prefix, each leaving enough; too short a rest is undone. The first
    that fits counts: of suffixes the list has the longer ones first, so it is the one with the shortest rest."""
    cut = F.regexp_replace(word, f"^(.{{{V.STEM_REST},}}?)(?:{'|'.join(V.SUFFIXES)})$", "$1")
    out = F.regexp_replace(cut, f"^(?:{'|'.join(V.PREFIXES)})(?=.{{{V.STEM_REST}}})", "")
    return F.when(F.length(out) < V.STEM_LEAST, word).otherwise(out) if V.STEM_REST < V.STEM_LEAST else out


def title_tokens(title: str | Column) -> Column:
    """Distinct stems of a title's words, without short and stop words."""
    words = F.split(F.lower(F.coalesce(_c(title), F.lit(""))), V.NOT_TOKEN)
    kept = F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin(V.STOP_WORDS))
    return F.array_distinct(F.filter(F.transform(kept, stem), lambda w: ~w.isin(V.STOP_WORDS)))


def canonical_url(url: str | Column) -> Column:
    """Without fragment and without tracking or empty parameters; the rest in its order."""
    bare = F.substring_index(_c(url), "#", 1)
    base = F.substring_index(bare, "?", 1)
    query = F.when(F.instr(bare, "?") > 0, F.substring(bare, F.length(base) + 2, F.length(bare))).otherwise("")
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.exists(F.array(*map(F.lit, V.DROPPED_PARAMS)), lambda d: F.startswith(F.lower(p), d)))
    return F.when(F.size(kept) > 0, F.concat(base, F.lit("?"), F.array_join(kept, "&"))).otherwise(base)


def url_id(url: str | Column) -> Column:
    return F.sha2(canonical_url(url), 256)


def domain(url: str | Column) -> Column:
    return F.regexp_replace(F.regexp_extract(_c(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1), r"^www\.", "")


def strip_fragment(url: str | Column) -> Column:
    return F.substring_index(_c(url), "#", 1)


def strip(text: str | Column) -> Column:
    return F.regexp_replace(_c(text), r"(?U)^\s+|\s+$", "")


#: Python's own tables of HTML: names that end in ``;``, older names that need none (the longest that
#: fits counts), and what stands for code points that HTML does not allow.
_NAMED = {k[:-1]: v for k, v in html5.items() if k.endswith(";")}
_BARE = {k: v for k, v in html5.items() if not k.endswith(";")}
_CODES = {str(k): v for k, v in html._invalid_charrefs.items()} | {str(k): "" for k in html._invalid_codepoints if k not in html._invalid_charrefs}
_BARE_NAME = f"^({'|'.join(sorted(_BARE, key=lambda k: (-len(k), k)))})"


def _table(rows: dict[str, str]) -> Column:
    return F.from_json(F.lit(json.dumps(rows)), "map<string,string>")


def unescape(text: str | Column) -> Column:
    """All named and numeric entities, one level of them."""

    def one(part: Column) -> Column:
        number = F.regexp_extract(part, "^#([0-9]{1,9}|[xX][0-9A-Fa-f]{1,8});?", 1)
        name, bare = F.regexp_extract(part, "^([A-Za-z][A-Za-z0-9]{0,31});", 1), F.regexp_extract(part, _BARE_NAME, 1)
        code = F.when(F.lower(F.substring(number, 1, 1)) == "x", F.conv(F.substring(number, 2, 9), 16, 10)).otherwise(number).cast("long")
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        by_code = (
            F.when(F.element_at(_table(_CODES), code.cast("string")).isNotNull(), F.element_at(_table(_CODES), code.cast("string")))
            .when((code > 0x10FFFF) | code.between(0xD800, 0xDFFF), F.lit("\ufffd")).otherwise(char)
        )
        rest = lambda used: F.substring(part, used + 1, F.length(part))
        return (
            F.when(number != "", F.concat(by_code, rest(F.length(F.regexp_extract(part, "^#[xX]?[0-9A-Fa-f]+;?", 0)))))
            .when((name != "") & F.element_at(_table(_NAMED), name).isNotNull(), F.concat(F.element_at(_table(_NAMED), name), rest(F.length(name) + 1)))
            .when(bare != "", F.concat(F.element_at(_table(_BARE), bare), rest(F.length(bare))))
            .otherwise(F.concat(F.lit("&"), part))
        )

    parts = F.split(_c(text), "&")
    undone = F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), one), ""))
    return F.when(F.contains(_c(text), F.lit("&")), undone).otherwise(_c(text))


def clean_html(text: str | Column, most: int = V.SUMMARY_CHARS) -> Column:
    """Plain text of a summary, at most ``most`` characters; null where nothing is left."""
    plain = unescape(F.regexp_replace(_c(text), "<[^>]+>", " "))
    tidy = strip(F.regexp_replace(plain, r"(?U)\s+", " "))
    return F.when(tidy != "", F.substring(tidy, 1, most))


def without_source(title: str | Column, source: str | Column) -> Column:
    """A title without its publisher's name at the end."""
    tail = F.concat(F.lit(" - "), _c(source))
    cut = F.when(_c(source).isNotNull() & (_c(source) != "") & F.endswith(_c(title), tail), F.substring(_c(title), F.lit(1), F.length(_c(title)) - F.length(tail))).otherwise(_c(title))
    return strip(cut)


def drop_source_suffix(title: str | Column, source: str | Column) -> Column:
    return unescape(without_source(title, source))


def useful_summary(summary: str | Column, title: str | Column) -> Column:
    """Null where the summary only repeats the title's start."""
    plain = lambda x: F.regexp_replace(F.lower(x), NOT_ALNUM, "")
    return F.when(~F.startswith(plain(_c(summary)), F.substring(plain(_c(title)), 1, 60)), _c(summary))


def image_url(url: str | Column) -> Column:
    """The URL if it is a picture and no tracker, else null."""
    low = F.lower(_c(url))
    path = F.substring_index(low, "?", 1)
    ok = (F.startswith(low, F.lit("http://")) | F.startswith(low, F.lit("https://"))) & F.exists(F.array(*map(F.lit, V.IMAGE_ENDS)), lambda e: F.endswith(path, e)) & ~F.exists(F.array(*map(F.lit, V.TRACKERS)), lambda t: F.contains(low, t))
    return F.when(ok, _c(url))


def slug(text: str | Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(_c(text)), r"[^\p{L}\p{N}\-_]", "-"), "^-+|-+$", "")
    return F.coalesce(F.when(s != "", s), F.lit("tanpa-nama"))


def rfc822(text: str | Column) -> Column:
    """A feed's date as naive UTC; the weekday, which is often wrong, is not looked at."""
    bare = F.regexp_replace(F.trim(_c(text)), r"^\w+,\s*", "")
    zoned = F.coalesce(F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss z")), F.try_to_timestamp(_c(text)))
    return zoned.cast("timestamp_ntz")


def dateline_free(text: str | Column) -> Column:
    return F.regexp_replace(_c(text), r"(?U)^(?:[A-Z][\w.]*,?\s+){1,6}[—–-]\s+", "")


def escape_html(text: str | Column) -> Column:
    out = _c(text)
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def local_time(ts: str | Column) -> Column:
    return F.coalesce(F.date_format(_c(ts) + F.expr("interval 7 hours"), "HH:mm"), F.lit("—"))


def long_date(d: str | Column) -> Column:
    pick = lambda names, i: F.element_at(F.array(*map(F.lit, names)), i)
    return F.concat(pick(V.DAYS, F.weekday(_c(d)) + 1), F.lit(", "), F.dayofmonth(_c(d)).cast("string"), F.lit(" "), pick(V.MONTHS, F.month(_c(d))), F.lit(" "), F.year(_c(d)).cast("string"))


def edition_date(ts: str | Column) -> Column:
    """The edition whose window [D-2 22:00, D-1 22:00) UTC holds a time."""
    return F.date_add((_c(ts) + F.expr("interval 2 hours")).cast("date"), 1)


def percent(part: Column, total: Column) -> Column:
    return F.floor(100 * part / F.greatest(total, F.lit(1))).cast("long")
