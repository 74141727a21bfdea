"""Feeds as a data source of Spark: ``spark.read`` and ``spark.readStream.format("feeds")``.

Each poll asks every feed once, with the etag and last-modified of the poll before. A partition is the feeds of one
host, asked one after the other, with a pause between them; hosts are asked in parallel by the executors.

A poll has a folder under ``store``, one file for each host. Whoever reads a host first asks its feeds and puts
replies, etags and bodies into the host's file, which appears whole or not at all; a batch that is read again after
a loss finds the file and asks nobody. The stream's offset is the number of the poll, which names the etags
that stand in its files; a committed poll's bodies are read no more, and polls before the last two are deleted.

Options: ``store`` (a folder that driver and executors share, by any path Arrow's file systems know), ``feeds``
(a catalogue as TOML text), ``client`` (``module:name`` of a function without arguments that returns a
:class:`feeds.Client`; the default asks by HTTP). A feed that cannot be asked is a row with a note; the last reply's
etags stay. A catalogue may change between polls.
"""

from __future__ import annotations

import base64
import hashlib
import importlib
import json
import time
import tomllib
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import urlsplit

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "poll int, name string, url string, category string, status int, fetched_at timestamp, etag string, last_modified string, sha256 string, n_bytes int, body binary, note string"


class HostPartition(InputPartition):
    def __init__(self, poll: int, host: str, feeds: list[dict]):
        super().__init__(host)
        self.poll, self.host, self.feeds = poll, host, feeds


class Store:
    """The files of polls."""

    def __init__(self, path: str):
        self.fs, self.root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)

    def _names(self, path: str) -> list[str]:
        return [f.base_name for f in self.fs.get_file_info(fs.FileSelector(path, allow_not_found=True))]

    def polls(self) -> list[int]:
        return sorted(int(n) for n in self._names(self.root) if n.isdigit())

    def path(self, poll: int, host: str) -> str:
        return f"{self.root}/{poll:09d}/{hashlib.sha256(host.encode()).hexdigest()[:32]}.json"

    def get(self, poll: int, host: str) -> list[dict] | None:
        path = self.path(poll, host)
        if self.fs.get_file_info(path).type == fs.FileType.NotFound:
            return None
        with self.fs.open_input_stream(path) as f:
            return json.loads(f.read())

    def put(self, poll: int, host: str, replies: list[dict]) -> None:
        path = self.path(poll, host)
        self.fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        part = f"{path}.{time.time_ns()}.part"
        with self.fs.open_output_stream(part) as f:
            f.write(json.dumps(replies).encode())
        self.fs.move(part, path)

    def latest(self, poll: int, host: str) -> dict[str, dict]:
        """The newest replies of a host's feeds before a poll, by url."""
        for n in reversed([p for p in self.polls() if p < poll]):
            if (got := self.get(n, host)) is not None:
                return {r["url"]: r for r in got}
        return {}

    def forget(self, before: int) -> None:
        """Delete polls that are no longer looked at; a host's file stays until a later poll has one."""
        polls = self.polls()
        kept = {n for p in polls if p >= before for n in self._names(f"{self.root}/{p:09d}")}
        for p in reversed([p for p in polls if p < before]):
            names = self._names(f"{self.root}/{p:09d}")
            for n in names:
                if n in kept or n.endswith(".part"):
                    self.fs.delete_file(f"{self.root}/{p:09d}/{n}")
            kept.update(names)
            if not self._names(f"{self.root}/{p:09d}"):
                self.fs.delete_dir(f"{self.root}/{p:09d}")


def _client(name: str):
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)()


class _Reader:
    """What both readers share; it is sent to executors."""

    def __init__(self, options: dict):
        self.store = options["store"]
        self.feeds = tomllib.loads(options["feeds"]).get("feed", [])
        self.client = options.get("client", "dawnpress.sources.feeds:Client")

    def hosts(self, poll: int) -> list[HostPartition]:
        by: dict[str, list[dict]] = {}
        for f in self.feeds:
            by.setdefault(urlsplit(f["url"]).netloc, []).append(f)
        return [HostPartition(poll, h, x) for h, x in sorted(by.items())]

    def read(self, partition: HostPartition) -> Iterator[tuple]:
        store = Store(self.store)
        replies = store.get(partition.poll, partition.host)
        if replies is None:
            replies = self._ask(partition, store.latest(partition.poll, partition.host))
            store.put(partition.poll, partition.host, replies)
        for r in replies:
            body = base64.b64decode(r["body"])
            yield (
                partition.poll, r["name"], r["url"], r["category"], r["status"], datetime.fromisoformat(r["at"]), r["etag"], r["last_modified"],
                r["sha256"], len(body), body, r["note"],
            )

    def _ask(self, partition: HostPartition, before: dict[str, dict]) -> list[dict]:
        client, out = _client(self.client), []
        for f in partition.feeds:
            old = before.get(f["url"], {})
            status, head, body, note = None, {}, b"", None
            try:
                status, head, body = client.get(f["url"], old.get("etag"), old.get("last_modified"))
            except Exception as e:  # noqa: BLE001  any failure is this feed's own
                note = f"{type(e).__name__}: {e}"
            kept = old if status != 200 else {"etag": head.get("etag"), "last_modified": head.get("last-modified"), "sha256": hashlib.sha256(body).hexdigest()}
            out.append(
                {"name": f["nama"], "url": f["url"], "category": f["kategori"], "status": status, "at": datetime.now(timezone.utc).isoformat(), "note": note, "body": base64.b64encode(body).decode()}
                | {k: kept.get(k) for k in ("etag", "last_modified", "sha256")}
            )
        return out


class FeedReader(_Reader, DataSourceReader):
    """One new poll each time a plan is made of it."""

    def partitions(self) -> list[HostPartition]:
        return self.hosts(max(Store(self.store).polls(), default=0) + 1)


class FeedStreamReader(_Reader, DataSourceStreamReader):
    """One poll a batch: the poll after the newest that has a file."""

    def initialOffset(self) -> dict:
        return {"poll": 0}

    def latestOffset(self) -> dict:
        return {"poll": max(Store(self.store).polls(), default=0) + 1}

    def partitions(self, start: dict, end: dict) -> list[HostPartition]:
        # polls between the two have no file: nobody asked, so there is nothing to tell of them
        known = set(Store(self.store).polls())
        return [p for n in range(start["poll"] + 1, end["poll"] + 1) if n == end["poll"] or n in known for p in self.hosts(n)]

    def commit(self, end: dict) -> None:
        Store(self.store).forget(end["poll"] - 1)


class FeedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "feeds"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FeedReader:
        return FeedReader(self.options)

    def streamReader(self, schema) -> FeedStreamReader:
        return FeedStreamReader(self.options)


def register(spark) -> None:
    spark.dataSource.register(FeedSource)
