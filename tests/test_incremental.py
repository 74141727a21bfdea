"""Clusters kept batch by batch against clustering all rows, with lost batches and with editions that must not be read."""

import random
from datetime import date
from pathlib import Path

import pytest

from dawnpress.functions import fixed_values as V
from dawnpress.operators import cluster
from dawnpress.operators.incremental import ClusterState

DAYS = [date(2024, 1, d) for d in (1, 2, 3)]
SCHEMA = "article_id long, title string, edition date"


def titles(n, seed):
    """Few words, so that tokens become hot and stop being rare as articles come."""
    rng = random.Random(seed)
    words = [f"{a}{b}ot{c}" for a in "bdgk" for b in "aeiu" for c in "xyz"]
    stories = [rng.sample(words, 6) for _ in range(12)]
    out = []
    for k in range(n):
        story = rng.choice(stories)
        out.append((k * 7 % n, " ".join(rng.sample(story, rng.randint(2, 6)) + rng.sample(words, rng.randint(0, 3))), rng.choice(DAYS)))
    return out


def of(df):
    return sorted(map(tuple, df.select("article_id", "event_id").collect()))


@pytest.fixture
def tight(monkeypatch):
    monkeypatch.setattr(V, "HOT_TOKEN", 9)
    monkeypatch.setattr(V, "RARE_LEAST", 3)
    monkeypatch.setattr(V, "RARE_SHARE", 0.08)


def test_batches_equal_all_rows(spark, tight, tmp_path):
    rows = titles(150, 1)
    state = ClusterState(spark, f"file://{tmp_path}/s", 0.5)
    cuts, changed = [0, 70, 71, 150], 0
    before = {}
    for a, b in zip(cuts, cuts[1:]):
        batch = spark.createDataFrame([*rows[a:b], *rows[max(0, a - 3) : a], (None, "x", DAYS[0]), (999, "x", None)], SCHEMA)  # some come again
        assert state.update(batch) == sorted({r[2] for r in rows[max(0, a - 3) : b]})
        now = dict(of(state.clusters()))
        assert sorted(now.items()) == of(cluster.clusters(spark.createDataFrame(rows[:b], SCHEMA), 0.5))
        apart = {}
        for k, e in before.items():
            apart.setdefault(e, set()).add(now[k])
        changed += sum(len(x) > 1 for x in apart.values())
        before = now
    assert changed  # a cluster came apart as its tokens became common


@pytest.mark.parametrize("lost", ["clusters", "edges", "tokens"])
def test_a_lost_batch_runs_again(spark, tight, tmp_path, lost, monkeypatch):
    rows = titles(110, 2)
    state = ClusterState(spark, f"file://{tmp_path}/s", 0.5)
    state.update(spark.createDataFrame(rows[:60], SCHEMA))
    write, late = state._write, spark.createDataFrame(rows[60:], SCHEMA)

    def fails(table, df):
        if table == lost:
            raise OSError("lost")
        write(table, df)

    state._write = fails
    with pytest.raises(OSError):
        state.update(late)
    state._write = write
    state.update(late)
    assert of(state.clusters()) == of(cluster.clusters(spark.createDataFrame(rows, SCHEMA), 0.5))
    assert state.update(late) and of(state.clusters()) == of(cluster.clusters(spark.createDataFrame(rows, SCHEMA), 0.5))


def test_only_touched_editions_are_read(spark, tmp_path):
    rows = titles(60, 3)
    state = ClusterState(spark, f"file://{tmp_path}/s")
    state.update(spark.createDataFrame(rows, SCHEMA))
    for table in ("tokens", "edges", "clusters"):
        for f in Path(tmp_path, "s", table, f"grp={DAYS[0]}").glob("*.parquet"):
            f.write_bytes(b"unreadable")
            f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    late = [(1000, rows[0][1], DAYS[1]), (1001, "quite other words here", DAYS[1])]
    assert state.update(spark.createDataFrame(late, SCHEMA)) == [DAYS[1]]
    day = [r for r in rows + late if r[2] == DAYS[1]]
    assert of(state.read("clusters", [DAYS[1]])) == of(cluster.clusters(spark.createDataFrame(day, SCHEMA)))


def test_nothing_comes(spark, tmp_path):
    state = ClusterState(spark, f"file://{tmp_path}/s")
    assert state.update(spark.createDataFrame([], SCHEMA)) == [] and state.clusters().count() == 0
    assert state.update(spark.createDataFrame([(1, None, DAYS[0]), (2, "", DAYS[0])], SCHEMA)) == [DAYS[0]]
    assert of(state.clusters()) == [(1, 1), (2, 2)]


def test_clusters_follow_a_stream(spark, tmp_path):
    """Late articles of an edition that was clustered before change its clusters, and only it is recomposed."""
    from dawnpress.streaming.stream import article_stream, follow_clusters

    at = "timestamp_ntz '2024-01-0{} 12:00:00'"
    batches = [[(3, "Harga beras naik tajam pekan ini", 1), (4, "Gempa besar guncang kota", 2)], [(1, "Harga beras naik tajam di pasar pekan", 1)]]
    schema, told = "article_id long, title string, published_at timestamp_ntz", []
    state = ClusterState(spark, f"file://{tmp_path}/s")
    for rows in batches:
        spark.sql(" union all ".join(f"select {i}L article_id, '{t}' title, {at.format(d)} published_at" for i, t, d in rows)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        follow_clusters(article_stream(spark, str(tmp_path / "in"), schema), state, told.append, str(tmp_path / "c")).awaitTermination()
    assert told == [[date(2024, 1, 2), date(2024, 1, 3)], [date(2024, 1, 2)]]
    assert of(state.clusters()) == [(1, 1), (3, 1), (4, 4)]
