"""The second clustering among AI events, and the edition made of it, against loops over every pair."""

import random
from collections import Counter
from datetime import date, datetime, timedelta
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from dawnpress.functions import fixed_values as V
from dawnpress.functions import rules
from dawnpress.functions.text import title_tokens
from dawnpress.operators import edition

SCHEMA = """edition date, event_id long, title string, url string, domain string, summary string, published_at timestamp_ntz, image string, lang string, category string, n_media long,
    weight double, also array<struct<domain: string, url: string>>, n_articles long"""


def made(seed):
    rng, rows = random.Random(seed), []
    stories = [rng.sample("model chip dana riset pusat data hukum paten robot suara gambar mesin bahasa kantor sekolah pabrik bursa saham mobil dokter".split(), 5) for _ in range(9)]
    for k in range(90):
        story = rng.choice(stories)
        words = rng.sample(story, rng.randint(2, 5)) + rng.sample("harian cepat besar rahasia lokal murah global ramai".split(), rng.randint(0, 3)) + rng.choices(["openai", "nvidia", "beras", "chatgpt"], k=1)
        own = rng.choice("abcdef")
        also = [(f"{d}.id", f"https://{d}.id/{k}x") for d in rng.sample("abcdefgh", rng.randint(0, 3)) if d != own]
        rows.append(
            (date(2024, 1, 1 + k % 2), k * 13 % 97, " ".join(words), f"https://{own}.id/{k}", f"{own}.id", None, datetime(2024, 1, 1) + timedelta(minutes=rng.randint(0, 50)), None, "id",
             rng.choice(["global", "makro", "pasar", "ai"]), len(also) + 1, rng.choice([1.0, 1.5, 2.0]), sorted(also), rng.randint(1, 9))
        )
    return rows


def similar(a, b, df, cut, threshold):
    shared = a & b
    if not any(df[t] <= V.HOT_TOKEN for t in shared):
        return False
    rare = sum(df[t] <= cut for t in shared)
    return len(shared) / len(a | b) >= threshold or (rare >= V.RARE_SHARED and len(shared) / min(len(a), len(b)) >= V.RARE_OVERLAP)


def brute(events, pool, tokens):
    """event_id -> (weight, n_media, n_articles, also) of the events that stay."""
    by, out = {e["event_id"]: e for e in events}, {}
    root = {i: i for i in pool}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for day in {e["edition"] for e in events}:
        own = [i for i in pool if by[i]["edition"] == day]
        df = Counter(t for i in own for t in tokens[i])
        cut = max(V.RARE_LEAST, int(len(own) * V.RARE_SHARE))
        for i, j in combinations(own, 2):
            if min(len(tokens[i]), len(tokens[j])) >= V.LEAST_TOKENS and similar(tokens[i], tokens[j], df, cut, V.AI_THRESHOLD):
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in by:
        groups.setdefault(find(i) if i in root else i, []).append(by[i])
    for g in groups.values():
        order = lambda e: (e["n_media"], e["published_at"], -e["event_id"])
        head = max(g, key=order)
        if len(g) == 1:
            out[head["event_id"]] = (head["weight"], head["n_media"], head["n_articles"], [tuple(x) for x in head["also"]])
            continue
        links = {}
        for e in g:
            for own, (d, u) in [(1, (e["domain"], e["url"])), *((0, tuple(x)) for x in e["also"])]:
                links[d] = max(links.get(d, ((0, datetime.min, 0), 0, "")), (order(e), own, u))
        also = sorted((d, x[2]) for d, x in links.items() if d != head["domain"])
        out[head["event_id"]] = (max(e["weight"] for e in g), len(links), sum(e["n_articles"] for e in g), also)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_merge_by_brute_force(spark, seed):
    df = edition.with_hits(spark.createDataFrame(made(seed), SCHEMA)).cache()
    rows = df.select("*", rules.ai_pool(hits=F.col("hits")).alias("pool"), title_tokens("title").alias("tokens")).collect()
    want = brute(rows, [r["event_id"] for r in rows if r["pool"]], {r["event_id"]: set(r["tokens"]) for r in rows})
    got = {r["event_id"]: (r["weight"], r["n_media"], r["n_articles"], [tuple(x) for x in r["also"]]) for r in edition.merge_ai(df).collect()}
    assert got == want and len(want) < len(rows) - 5 and sum(r["pool"] for r in rows) > 30


def test_compose_after_the_merge(spark):
    """Sections of whole editions: ranks by the keys of the order, limits, and no event twice."""
    rows = []
    for k, (day, i, title, url, domain, summary, at, image, lang, category, *_rest) in enumerate(made(3)):
        day_at = datetime(day.year, day.month, day.day) - timedelta(days=1, minutes=k)
        rows.append((i, url, domain, title, summary, day_at, category, 1.0, image, lang, day))
    articles = spark.createDataFrame(rows, "article_id long, url string, domain string, title string, summary string, published_at timestamp_ntz, category string, weight double, image string, lang string, edition date")
    shown = edition.compose(articles).collect()
    assert len({(r["edition"], r["event_id"]) for r in shown}) == len(shown) > 10
    by = {}
    for r in sorted(shown, key=lambda r: r["rank"]):
        by.setdefault((r["edition"], r["section"]), []).append(r)
    limits = V.SECTION_LIMITS | {V.TOP_SECTION: V.TOP_LIMIT}
    for (_, section), rs in by.items():
        assert [r["rank"] for r in rs] == list(range(1, len(rs) + 1)) and len(rs) <= limits[section]
        assert [(-r["impact"], -r["n_media"] * r["weight"]) for r in rs] == sorted((-r["impact"], -r["n_media"] * r["weight"]) for r in rs)
        assert all(r["impact"] == 3 for r in rs) if section == V.TOP_SECTION else all(r["category"] == section for r in rs)
    assert all(r["ai"] is not None and r["ai"]["is_ai"] for r in shown if r["section"] == "ai") and any(r["section"] == "ai" for r in shown)
