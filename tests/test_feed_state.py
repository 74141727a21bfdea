"""Feed states in a stream: late rows, restarts and silent feeds, against an upsert of all replies at once."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dawnpress.sources import store
from dawnpress.streaming import feed_state

T0 = datetime(2024, 1, 1)


def reply(url, hours, status=200, items=1, etag=None):
    return url, status, T0 + timedelta(hours=hours) if hours is not None else None, etag or f"e{hours}", None, f"h{hours}", items


ROUNDS = [
    [reply("a", 0), reply("b", 1), reply("c", 2, 404), reply("d", 1, items=0), (None, *reply("x", 1)[1:]), reply("x", None)],
    [reply("a", 30), reply("b", 0.5), reply("a", 20), reply("d", 31, 304)],  # late ones do not replace later ones
    [reply("a", 60), reply("c", 80), reply("a", 60, etag="zz")],
    [reply("a", 160), reply("b", 139)],  # c and d are silent by then, b was and is no longer
]


@pytest.fixture(scope="module")
def rounds(spark, tmp_path_factory):
    """The states after each round, each run from the checkpoint of the one before."""
    top, out = tmp_path_factory.mktemp("feeds"), []
    for k, rows in enumerate(ROUNDS):
        spark.createDataFrame(rows, feed_state.REPLY).coalesce(1).write.mode("append").parquet(str(top / "replies"))
        stream = spark.readStream.schema(feed_state.REPLY).parquet(str(top / "replies"))
        df = feed_state.run_feed_states(stream, f"file://{top}/out", timedelta(days=2), "1 day")
        out.append({r["url"]: r.asDict() for r in df.collect()})
    changes = spark.read.schema(feed_state.CHANGE).parquet(str(top / "out" / "changes")).collect()
    return out, changes


def test_equal_to_an_upsert_of_all(spark, rounds):
    for k, states in enumerate(rounds[0]):
        rows = [r for part in ROUNDS[: k + 1] for r in part if r[0] and r[2] and r[1] == 200]
        good = spark.createDataFrame(rows, feed_state.REPLY).select("url", "etag", "last_modified", "body_hash", F.col("at").alias("last_success"), F.struct("at", "etag").alias("o"))
        want = store.upsert(good.where("false"), good, "url", "o").collect()
        assert {u: (s["at"], s["etag"], s["last_modified"], s["body_hash"]) for u, s in states.items()} == {r["url"]: (r["last_success"], r["etag"], r["last_modified"], r["body_hash"]) for r in want}


def test_silent_feeds(rounds):
    states, changes = rounds
    assert states[0]["d"]["last_item"] is None and not any(s["silent"] for s in states[0].values())
    last = states[-1]
    # the watermark is a day behind hour 160: c brought its last item at hour 80, d none at all
    assert {u for u, s in last.items() if s["silent"]} == {"c"}
    reported = sorted((r["url"], r["at"] - r["last_item"]) for r in changes if r["kind"] == "silent")
    assert ("b", timedelta(days=2)) in reported and all(gap == timedelta(days=2) for _, gap in reported)
    assert len(reported) == len(set((r["url"], r["last_item"]) for r in changes if r["kind"] == "silent"))  # once for each silence


def test_a_repeated_round_changes_nothing(spark, tmp_path):
    rows = spark.createDataFrame(ROUNDS[0], feed_state.REPLY)
    rows.write.parquet(str(tmp_path / "r"))
    run = lambda: feed_state.run_feed_states(spark.readStream.schema(feed_state.REPLY).parquet(str(tmp_path / "r")), f"file://{tmp_path}/o").orderBy("url").collect()
    first = run()
    assert run() == first
    rows.write.mode("append").parquet(str(tmp_path / "r"))  # the same replies once more
    assert run() == first
