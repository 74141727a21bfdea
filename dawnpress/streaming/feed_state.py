"""State of each feed kept in a stream, and feeds that fall silent.

One state a feed: what its last good reply said (etag, last-modified, hash, time), and when it last brought an
item. Replies may come late and in any order; the latest good reply counts, as :func:`store.upsert` of all
replies at once would have it. A timer in event time is set for ``quiet`` after a feed's last item and moved on by
a later one; when the watermark passes it, the feed is reported as silent, once for each silence.

State is kept by Spark's state store (RocksDB) by key, so it grows with the number of feeds and not with
replies, and is restored from the checkpoint after a loss.

Rows without url or time are left out; replies that were not good (status other than 200) change nothing; of
two good replies of one time the larger (etag, last-modified, hash) counts, nulls as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

REPLY = "url string, status int, at timestamp, etag string, last_modified string, body_hash string, n_items int"
CHANGE = "url string, kind string, at timestamp, etag string, last_modified string, body_hash string, last_item timestamp"
_STATE = "at timestamp, etag string, last_modified string, body_hash string, last_item timestamp"
_MARKS = ["etag", "last_modified", "body_hash"]


def _text(x: Any) -> str:
    return x if isinstance(x, str) else ""


def _utc(x: Any):
    """A time as the state store takes it, and comparable: without zone, None if missing."""
    if x is None or x is pd.NaT:
        return None
    t = pd.Timestamp(x)
    return (t.tz_convert("UTC").tz_localize(None) if t.tzinfo else t).to_pydatetime()


class FeedProcessor(StatefulProcessor):
    def __init__(self, quiet: timedelta):
        self.quiet = quiet

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("feed", _STATE)

    def _wake(self, item) -> None:
        """One timer a feed, ``quiet`` after its last item."""
        for t in self.handle.listTimers():
            self.handle.deleteTimer(t)
        if item is not None:
            self.handle.registerTimer(int(pd.Timestamp(item + self.quiet, tz="UTC").timestamp() * 1000))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        old = self.state.get() if self.state.exists() else None
        at, marks, item = (_utc(old[0]), tuple(map(_text, old[1:4])), _utc(old[4])) if old else (None, ("", "", ""), None)
        best, last = (at, marks), item
        for frame in rows:
            good = frame[(frame["status"] == 200) & frame["at"].notna()]
            for t, *m in zip(good["at"], *(good[c] for c in _MARKS)):
                new = (_utc(t), tuple(map(_text, m)))
                best = new if best[0] is None or new > best else best
            items = good.loc[good["n_items"] > 0, "at"]
            if len(items):
                last = max(x for x in (last, _utc(items.max())) if x is not None)
        if best == (at, marks) and last == item:
            return
        named = [x or None for x in best[1]]
        self.state.update((best[0], *named, last))
        if last != item:
            self._wake(last)
        yield self._row(key, "state", best[0], named, last)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        at, etag, modified, body, item = self.state.get()
        due = pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms").to_pydatetime()
        yield self._row(key, "silent", due, [etag, modified, body], _utc(item))

    @staticmethod
    def _row(key: Any, kind: str, at, marks: list, item) -> pd.DataFrame:
        return pd.DataFrame({"url": [key[0]], "kind": [kind], "at": [pd.Timestamp(at)], **{c: [m] for c, m in zip(_MARKS, marks)}, "last_item": [pd.Timestamp(item) if item is not None else pd.NaT]})

    def close(self) -> None:
        pass


def feed_changes(replies: DataFrame, quiet: timedelta = timedelta(days=3), late: str = "2 days") -> DataFrame:
    """A stream of :data:`CHANGE` rows out of a stream of :data:`REPLY` rows: ``state`` whenever a feed's state
    changes, ``silent`` when it has brought no item for ``quiet``."""
    known = replies.where("url is not null and at is not null").withWatermark("at", late)
    return known.groupBy("url").transformWithStateInPandas(FeedProcessor(quiet), CHANGE, "Update", "EventTime")


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that timers need; set before a query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def current_states(changes: DataFrame) -> DataFrame:
    """``url, at, etag, last_modified, body_hash, last_item, silent`` out of all changes: the last state of each feed,
    and whether it has been reported as silent since its last item."""
    order = F.struct("at", *(F.coalesce(c, F.lit("")).alias(c) for c in _MARKS), F.coalesce("last_item", F.lit("0001-01-01").cast("timestamp")).alias("i"))
    state = changes.where("kind = 'state'").groupBy("url").agg(F.max_by(F.struct("at", *_MARKS), order).alias("s"), F.max("last_item").alias("last_item"))
    quiet = changes.where("kind = 'silent'").groupBy("url").agg(F.max("last_item").alias("quiet"))
    return state.join(quiet, "url", "left").select("url", "s.*", "last_item", F.coalesce(F.col("quiet") == F.col("last_item"), F.lit(False)).alias("silent"))


def run_feed_states(replies: DataFrame, path: str, quiet: timedelta = timedelta(days=3), late: str = "2 days") -> DataFrame:
    """Run the stream over what has come so far, append its changes under ``path`` and return the states. Called
    again with the same ``path`` it goes on from its checkpoint."""
    spark = replies.sparkSession
    use_rocksdb(spark)
    q = feed_changes(replies, quiet, late).writeStream.foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{path}/changes/batch={n}")).outputMode("update").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return current_states(spark.read.schema(CHANGE).parquet(f"{path}/changes"))
