"""Secret scans: findings of a broad pattern, cleared of false positives by a random forest.

Candidates are of two kinds: a run of ``LEAST`` characters or more of ``[A-Za-z0-9+/_-]`` that holds a
digit and a letter, wherever it stands; and, where the word itself or one of the two before it names a
secret, any run of ``SHORT`` characters or more, of letters, digits or symbols alone, too. A candidate's
measures are built-in expressions over it, the word it stands in (its *path*: URLs, file names, mail
addresses) and the words around it. The forest is fitted in numpy on the driver, from labelled findings,
and compiled into one SQL expression: the scan is one projection over the documents, without a shuffle
and without user functions.

Labelled findings are rows of (candidate, path, before, after, label). Without any of the caller's,
:func:`labelled_findings` makes a set of a fixed size from a seed. The fit reads at most ``SAMPLE`` rows.

Defined cases: null and blank texts have no candidate; texts of any length are scanned whole; findings of
rows without a doc_id have none; repeated rows give repeated findings; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import random
import re
import string
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST, SHORT, SAMPLE, TREES, DEPTH = 20, 6, 10_000, 15, 6
#: Padding belongs to a run only where it ends it: ``name=value`` is two runs.
RUN = rf"[A-Za-z0-9+/_\-]{{{LEAST},}}={{0,2}}(?![A-Za-z0-9])"
BESIDE = rf"[A-Za-z0-9!@#$%^&*+/_.~?\-]{{{SHORT},}}={{0,2}}(?![A-Za-z0-9])"
_WORDS = r"[\x20\x09-\x0D]+"

#: Words that name secrets, words that stand beside harmless identifiers, and common words
#: and parts of identifiers. Names count as whole words: not the auth of author or the order of border.
NEAR = r"(?i)(?<![A-Za-z])(token|secret|password|passwd|passphrase|pwd|api[_-]?key|access[_-]?key|private[_-]?key|secret[_-]?key|auth[_-]?token|access[_-]?token|credential|auth|bearer)s?(?![A-Za-z])"
HARMLESS = r"(?i)(?<![A-Za-z])(sha\d*|md5|checksum|digest|commit|revision|etag|uuid|guid|build|hash|version|example|sample|dummy|test|placeholder|isbn|order|ticket)(?![A-Za-z])"
DICTIONARY = (
    r"(?i)(the|and|for|with|from|this|that|not|key|name|value|file|data|user|time|code|page|test|example|index|image|content|config|main|public|static|home|path|item|list|view|your|here|insert|change|release"
    r"|version|report|document|summary|chapter|section|table|figure|password|token|secret|required|invalid|incorrect|expired|missing|reset|policy|manager|null|none|true|false|string|empty|hidden|forgot|forgotten"
    r"|optional|default|input|protected|private|access|login|field|must|should|contain|characters|letter|digit|string|enter|choose|basic|header|request|service|system|meeting|economy|recipe|number|count|length)"
)


@dataclass(frozen=True)
class Measure:
    """A measure as a column over (candidate, path, before, after), and as a function of the same."""

    name: str
    column: object
    plain: object


def _count(pattern: str, x: str) -> int:
    return len(re.findall(pattern, x))


_CHANGE = r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"
_LAST = r"\S+\s*[=:]+\s*\S+$"
MEASURES = (
    Measure("length", lambda c, p, b, a: F.length(c), lambda c, p, b, a: len(c)),
    Measure("transitions", lambda c, p, b, a: F.regexp_count(c, F.lit(_CHANGE)) / F.length(c), lambda c, p, b, a: _count(_CHANGE, c) / len(c)),
    Measure("digits", lambda c, p, b, a: F.regexp_count(c, F.lit("[0-9]")) / F.length(c), lambda c, p, b, a: _count("[0-9]", c) / len(c)),
    Measure("dictionary", lambda c, p, b, a: 1 - F.length(F.regexp_replace(c, DICTIONARY, "")) / F.length(c), lambda c, p, b, a: 1 - len(re.sub(DICTIONARY, "", c)) / len(c)),
    Measure("symbols", lambda c, p, b, a: F.regexp_count(c, F.lit(r"[!@#$%^&*.~?]")) / F.length(c), lambda c, p, b, a: _count(r"[!@#$%^&*.~?]", c) / len(c)),
    Measure("upper", lambda c, p, b, a: F.regexp_count(c, F.lit("[A-Z]")) / F.length(c), lambda c, p, b, a: _count("[A-Z]", c) / len(c)),
    Measure("quoted", lambda c, p, b, a: F.regexp_like(p, F.lit("[\"'`]")).cast("int"), lambda c, p, b, a: int(bool(re.search("[\"'`]", p)))),
    Measure("named_last", lambda c, p, b, a: F.regexp_like(F.regexp_extract(F.concat_ws(" ", b, p), _LAST, 0), F.lit(NEAR)).cast("int"), lambda c, p, b, a: int(bool(re.search(NEAR, m.group(0) if (m := re.search(_LAST, b + " " + p)) else "")))),
    Measure("repeats", lambda c, p, b, a: F.regexp_count(c, F.lit(r"(.)\1\1")), lambda c, p, b, a: _count(r"(.)\1\1", c)),
    Measure("separators", lambda c, p, b, a: F.regexp_count(c, F.lit("[/_=+-]")) / F.length(c), lambda c, p, b, a: _count("[/_=+-]", c) / len(c)),
    Measure("in_path", lambda c, p, b, a: F.regexp_like(p, F.lit(r"://|@|\.[A-Za-z]{2,5}\b")).cast("int"), lambda c, p, b, a: int(bool(re.search(r"://|@|\.[A-Za-z]{2,5}\b", p)))),
    Measure("near", lambda c, p, b, a: F.regexp_like(F.concat_ws(" ", b, p), F.lit(NEAR)).cast("int"), lambda c, p, b, a: int(bool(re.search(NEAR, b + " " + p)))),
    Measure("assigned", lambda c, p, b, a: F.regexp_like(F.concat_ws(" ", b, p), F.lit(r"[=:]")).cast("int"), lambda c, p, b, a: int(bool(re.search("[=:]", b + " " + p)))),
    Measure("harmless", lambda c, p, b, a: F.regexp_like(F.concat_ws(" ", b, p, a), F.lit(HARMLESS)).cast("int"), lambda c, p, b, a: int(bool(re.search(HARMLESS, " ".join((b, p, a)))))),
)


def labelled_findings(n: int = 6000, seed: int = 9) -> list[tuple[str, str, str, str, int]]:
    """(candidate, path, before, after, label): half of them secrets, half harmless look-alikes."""
    r = random.Random(seed)
    pick = lambda chars, lo, hi: "".join(r.choices(chars, k=r.randint(lo, hi)))
    low, digits, alnum = string.ascii_lowercase, string.digits, string.ascii_letters + string.digits
    hexa, base64, symbols = "0123456789abcdef", alnum + "+/", "!@#$%^&*?"
    names = "token secret password api_key API_KEY access_key TOKEN auth Bearer credential passwd pwd passphrase private-key".split()
    parts = "user report summary chapter index image content static release version document table home page example".split()
    states = "required incorrect reset manager policy expired missing invalid economy recipe meeting null none protected default change length".split()
    filler = lambda: pick(low, 2, 9)
    word = lambda: r.choice((filler() + filler(), r.choice(parts), r.choice(states), pick(low, 6, 10)))
    out = []

    def long_secret() -> str:
        kind = r.randrange(5)
        return (pick(hexa, 32, 64), pick(alnum, 20, 48), pick(base64, 24, 64), pick(hexa.upper(), 32, 64), r.choice(("AK", "pk_", "sk_")) + pick(alnum, 20, 36))[kind]

    def password() -> str:
        kind = r.randrange(4)
        return (
            pick(low, 4, 9).capitalize() + pick(digits, 1, 4) + r.choice(("", "!", "#", "?")), pick(low, 5, 9) + pick(digits, 1, 4), pick(alnum + symbols, 8, 16),
            "".join(r.choice((c, c.upper(), r.choice(digits + symbols))) for c in pick(low, 8, 14)),
        )[kind]

    while len(out) < n:
        after = filler()
        if len(out) % 2:
            c = long_secret() if r.random() < 0.5 else password()
            name, sign, quote = r.choice(names), r.choice(("=", ":")), r.choice(("", '"', "'"))
            form = r.randrange(5)
            if form == 0:
                row = (c, quote + c + quote, f"{name} {sign}", after, 1)
            elif form == 1:
                row = (c, quote + c + quote + r.choice(("", ",", ";")), f"{filler()} {name}{sign}", after, 1)
            elif form == 2:
                row = (c, f"{name}{sign}{quote}{c}{quote}", f"{filler()} {filler()}", after, 1)
            elif form == 3 and len(c) >= LEAST:
                row = (c, quote + c + quote, f"{r.choice((name, 'Authorization:'))} {r.choice(('Bearer', name))}", after, 1)
            else:
                row = (c, quote + c + quote, f"{name} {r.choice(('is', 'was', sign))}", after, 1)
        else:
            kind = r.randrange(9)
            if kind == 0:  # digests of files and commits
                c = pick(hexa, 32, 64)
                row = (c, c, r.choice(("sha256 :", "commit", "checksum =", "etag :", "digest :", "md5 =")), after, 0)
            elif kind == 1:  # addresses
                c = "/".join(r.choices(parts, k=4)) + pick(digits, 2, 6)
                row = (c, f"https://{filler()}.com/{c}.html", filler(), after, 0)
            elif kind == 2:  # identifiers
                c = "-".join(pick(hexa, k, k) for k in (8, 4, 4, 4, 12))
                row = (c, c, r.choice(("uuid :", "order", "build =", filler())), after, 0)
            elif kind == 3:  # names made of words
                c = "_".join(r.choices(parts, k=5)) + str(r.randint(1, 99))
                row = (c, c, filler() + r.choice(("", " =")), after, 0)
            elif kind == 4:  # placeholders
                c = r.choice((r.choice("xX0*") * r.randint(6, 40), r.choice(("YOUR", "your", "insert", "MY")) + r.choice(("_", "-")) + r.choice(names) + r.choice(("", "_here", "-here")), "example" + pick(digits, 1, 3)))
                row = (c, r.choice(("", '"')) + c, r.choice(("token =", "password :", "api_key =", "secret =", "password is")), after, 0)
            elif kind == 5:  # ordinary long words that run into a number
                c = pick(low, 20, 34) + pick(digits, 1, 2)
                row = (c, c + r.choice(("", ".", "@mail.example.com")), filler(), after, 0)
            elif kind == 6:  # a name of secrets in a sentence
                c = word()
                row = (c, c + r.choice(("", ".", ",")), f"{filler()} {r.choice(names)}", after, 0)
            elif kind == 7:
                c = word()
                row = (c, c + r.choice(("", ".", ",")), f"{r.choice(names)} {r.choice((filler(), 'is', 'was', 'must', 'and'))}", after, 0)
            else:  # states and types where a value could stand
                c = r.choice((r.choice(states), r.choice(states) + "-" + r.choice(states), "String", "getenv", "process.env." + r.choice(names).upper(), "config." + r.choice(names), r.choice(names) + "_" + r.choice(parts)))
                row = (c, c + r.choice(("", ";", ",")), f"{r.choice(names)} {r.choice(('=', ':', 'is'))}", after, 0)
        if len(row[0]) >= SHORT:
            out.append(row)
    return out


def fit_forest(rows: list[tuple[str, str, str, str, int]], seed: int = 1) -> list:
    """Trees as nested (measure, border, below, above), leaves as the share of secrets."""
    rows = rows[:SAMPLE]
    x = np.array([[m.plain(*r[:4]) for m in MEASURES] for r in rows], float).reshape(len(rows), len(MEASURES))
    y = np.array([r[4] for r in rows], float)
    rng = np.random.Generator(np.random.PCG64(seed))

    def grow(i: np.ndarray, depth: int):
        p = y[i].mean()
        if depth == 0 or p in (0.0, 1.0) or len(i) < 8:
            return round(float(p), 6)
        best = None
        for f in rng.choice(len(MEASURES), 4, replace=False):
            v = x[i, f]
            for border in np.unique(np.quantile(v, np.linspace(0.05, 0.95, 15))):
                low = v <= border
                k = low.sum()
                if 0 < k < len(i):
                    a, b = y[i[low]].mean(), y[i[~low]].mean()
                    impurity = k * a * (1 - a) + (len(i) - k) * b * (1 - b)
                    if best is None or impurity < best[0]:
                        best = (impurity, int(f), float(border), low)
        if best is None:
            return round(float(p), 6)
        return (best[1], best[2], grow(i[best[3]], depth - 1), grow(i[~best[3]], depth - 1))

    return [grow(rng.integers(0, len(rows), len(rows)), DEPTH) for _ in range(TREES)] if rows else [0.0]


def forest_score(forest: list, measures: list[float]) -> float:
    def walk(t):
        while isinstance(t, tuple):
            t = t[2] if measures[t[0]] <= t[1] else t[3]
        return t

    return sum(walk(t) for t in forest) / len(forest)


def forest_nodes(forest: list) -> tuple[list[int], list[list]]:
    """The roots of the trees, and all nodes in five lists: measure, border, node below, node above, share. A leaf
    leads to itself."""
    roots, nodes = [], [[], [], [], [], []]

    def put(t) -> int:
        at = len(nodes[0])
        for x, v in zip(nodes, (t[0], t[1], at, at, 0.0) if isinstance(t, tuple) else (0, 0.0, at, at, float(t)), strict=True):
            x.append(v)
        if isinstance(t, tuple):
            nodes[2][at], nodes[3][at] = put(t[2]), put(t[3])
        return at

    for t in forest:
        roots.append(put(t))
    return roots, nodes


def forest_column(forest: list, measures: list[Column]) -> Column:
    """The forest as one expression: nodes are constant arrays, along which each tree is walked. Its size does not
    grow with the forest, as nested conditions would, which no longer compile beyond 64 KB of code."""
    roots, nodes = forest_nodes(forest)
    fixed = lambda x, kind: F.split(F.lit(",".join(map(repr, x))), ",").cast(f"array<{kind}>")  # noqa: E731  folded into a constant
    measure, border, below, above, share = (fixed(x, k) for x, k in zip(nodes, ("int", "double", "int", "int", "double"), strict=True))
    values = F.array(*measures)
    step = lambda n, _: F.when(F.get(values, F.get(measure, n)) <= F.get(border, n), F.get(below, n)).otherwise(F.get(above, n))
    walk = lambda root: F.aggregate(F.sequence(F.lit(1), F.lit(DEPTH)), root, step)
    return F.aggregate(fixed(roots, "int"), F.lit(0.0), lambda total, root: total + F.get(share, walk(root))) / len(forest)


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, word_no, candidate, path, before, after`` for every run that the patterns find."""
    suspect = docs.select("doc_id", "text").where(F.col("text").rlike(RUN) | F.col("text").rlike(NEAR))
    words = suspect.select("doc_id", F.filter(F.split("text", _WORDS), lambda w: w != "").alias("w"))
    where = lambda p: F.filter(F.transform("w", lambda w, i: F.when(w.rlike(p), i)), lambda i: i.isNotNull())
    found = words.select("doc_id", "w", where(RUN).alias("runs"), where(NEAR).alias("names"))
    beside = F.array_distinct(F.flatten(F.transform("names", lambda i: F.filter(F.array(i, i + 1, i + 2), lambda k: k < F.size("w")))))
    each = found.select("doc_id", "w", beside.alias("beside"), "runs").select("doc_id", "w", "beside", F.explode(F.array_union("runs", "beside")).alias("word_no"))
    near = lambda k: F.coalesce(F.get("w", F.col("word_no") + k), F.lit(""))
    rows = each.select(
        "doc_id", "word_no", F.array_contains("beside", F.col("word_no")).alias("named"), near(0).alias("path"), F.concat_ws(" ", near(-2), near(-1)).alias("before"), near(1).alias("after"),
    )
    mixed = F.filter(F.regexp_extract_all("path", F.lit(RUN), F.lit(0)), lambda c: c.rlike("[0-9]") & c.rlike("[A-Za-z]"))
    runs = F.when(F.col("named"), F.regexp_extract_all("path", F.lit(BESIDE), F.lit(0))).otherwise(mixed)
    return rows.select("doc_id", "word_no", F.explode(runs).alias("candidate"), "path", "before", "after")


def scan_secrets(docs: DataFrame, findings: list[tuple[str, str, str, str, int]] | None = None, threshold: float = 0.5, keep_all: bool = False) -> DataFrame:
    """``doc_id, word_no, kind, n_chars, fingerprint, score`` for each finding that the forest keeps
    (``keep_all``: for every candidate). The secret itself is not repeated: ``fingerprint`` is the start of its hash."""
    forest = fit_forest(labelled_findings() if findings is None else findings)
    c = candidates(docs)
    args = [F.col(x) for x in ("candidate", "path", "before", "after")]
    measured = c.select("doc_id", "word_no", "candidate", *(m.column(*args).cast("double").alias(f"m{i}") for i, m in enumerate(MEASURES)))
    measured = measured.select("doc_id", "word_no", "candidate", F.array(*(f"m{i}" for i in range(len(MEASURES)))).alias("m"))
    scored = measured.withColumn("score", F.round(forest_column(forest, [F.get("m", F.lit(i)) for i in range(len(MEASURES))]), 6))
    kind = F.when(F.col("candidate").rlike("^[0-9a-fA-F]+$"), "hex").when(F.col("candidate").rlike("^[A-Za-z0-9]+$"), "alphanumeric").otherwise("mixed")
    kept = scored if keep_all else scored.where(F.col("score") >= threshold)
    return kept.select("doc_id", F.col("word_no").cast("long").alias("word_no"), kind.alias("kind"), F.length("candidate").cast("long").alias("n_chars"), F.substring(F.sha2("candidate", 256), 1, 16).alias("fingerprint"), "score")
