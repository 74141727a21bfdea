"""Every query with SQL against DuckDB over the small tables."""

import duckdb
import pandas as pd
import pytest

from dawnpress.queries import ORACLES, QUERIES

D = "/root/testdata/sf0.001"


def normal(df):
    def one(v):
        if isinstance(v, float):
            return "nan" if v != v else repr(round(v, 9))
        if v is None or v is pd.NaT:
            return "nan"
        s = str(v)
        return s[:-9] if s.endswith(" 00:00:00") else s

    return sorted(tuple(one(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in "documents events pages labels orders lineitem".split():
        c.sql(f"create view {t} as select * from '{D}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    a, b = QUERIES[name](spark, D).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(a.columns) == sorted(b.columns)
    assert normal(a) == normal(b)


def test_whole_titles(spark, duck):
    first = dict(duck.sql("select doc_id, string_split(text, chr(10))[1] from documents").fetchall())
    shown = [(r["event_id"], r["title"]) for r in QUERIES["edition_compose"](spark, D).collect()]
    lines = set(first.values())
    assert all(t in lines for _, t in shown) and any(len(t) > 120 for _, t in shown)


def test_calendar_page_of_all_events(spark, duck):
    days = [str(r[0]) for r in duck.sql("select distinct cast(ts + interval 2 hour as date) + 1 from events where ts is not null").fetchall()]
    html = QUERIES["calendar_page"](spark, D).first()["html"]
    assert all(f'href="{day}.html"' in html for day in days)
