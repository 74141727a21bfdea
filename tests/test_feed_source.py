"""The feed source against a server that counts what it is asked."""

import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from dawnpress.sources import feed_source
from dawnpress.sources.feed_source import Store


class Server:
    def __init__(self):
        self.pages, self.asked, outer = {}, [], self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self):
                tag, seen = outer.pages.get(self.path), self.headers.get("If-None-Match")
                outer.asked.append((self.headers["Host"].split(":")[0], self.path, seen))
                status = 404 if tag is None else 304 if tag == seen else 200
                self.send_response(status)
                if status == 200:
                    body = f"<rss>{self.path} {tag}</rss>".encode()
                    self.send_header("ETag", tag)
                    self.send_header("Content-Length", str(len(body)))
                self.end_headers()
                if status == 200:
                    self.wfile.write(body)

            def log_message(self, *a):
                pass

        self.http = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.http.serve_forever, daemon=True).start()

    def catalogue(self, *feeds):
        return "\n".join(f'[[feed]]\nnama = "{h}{p}"\nurl = "http://{h}:{self.http.server_port}{p}"\nkategori = "makro"' for h, p in feeds)


@pytest.fixture
def server():
    s = Server()
    yield s
    s.http.shutdown()


def quick():
    """The client of these tests: no pauses."""
    from dawnpress.sources.feeds import Client

    return Client(pause=0, tries=1, sleep=lambda s: None)


FEEDS = [("127.0.0.1", "/a"), ("127.0.0.1", "/b"), ("localhost", "/c"), ("localhost", "/gone")]


@pytest.fixture
def poll(spark, server, tmp_path):
    feed_source.register(spark)
    toml, rows = server.catalogue(*FEEDS), []

    def run(fails=False, feeds=None):
        """One trigger; what it delivered."""
        rows.clear()

        def batch(df, n):
            got = [(r["url"].rsplit("/", 1)[1], r["status"], r["etag"], bytes(r["body"])) for r in df.collect()]
            if fails:
                raise OSError("lost")
            rows.extend(got)

        stream = spark.readStream.format("feeds").option("store", f"file://{tmp_path}/store").option("feeds", feeds or toml).option("client", "tests.test_feed_source:quick").load()
        q = stream.writeStream.foreachBatch(batch).option("checkpointLocation", str(tmp_path / "c")).trigger(once=True).start()
        try:
            q.awaitTermination()
        except Exception:
            assert fails
        return sorted(rows)

    return run


def test_polls_send_etags(server, poll):
    server.pages |= {"/a": '"1"', "/b": '"1"', "/c": '"1"'}
    first = poll()
    assert [r[:3] for r in first] == [("a", 200, '"1"'), ("b", 200, '"1"'), ("c", 200, '"1"'), ("gone", 404, None)]
    assert first[0][3] == b'<rss>/a "1"</rss>'
    server.pages["/b"] = '"2"'
    assert [r[:3] for r in poll()] == [("a", 304, '"1"'), ("b", 200, '"2"'), ("c", 304, '"1"'), ("gone", 404, None)]
    assert [r[:3] for r in poll()] == [("a", 304, '"1"'), ("b", 304, '"2"'), ("c", 304, '"1"'), ("gone", 404, None)]
    assert sorted(x[1:] for x in server.asked[-4:]) == [("/a", '"1"'), ("/b", '"2"'), ("/c", '"1"'), ("/gone", None)]


def test_a_lost_batch_asks_nobody_twice(server, poll):
    server.pages |= {"/a": '"1"', "/b": '"1"', "/c": '"1"'}
    poll()
    server.pages["/a"] = '"2"'
    before = len(server.asked)
    assert poll(fails=True) == [] and len(server.asked) == before + 4
    server.pages["/a"] = '"3"'  # the lost batch tells what was there when it was asked
    assert [r[:3] for r in poll()][0] == ("a", 200, '"2"')
    lost = server.asked[before + 4 :]
    assert all(x[2] != '"1"' or x[1] != "/a" for x in lost)  # nobody asked for it with the etag before
    while (got := poll())[0][2] != '"3"':
        pass
    assert got[0][:3] == ("a", 200, '"3"')


def test_hosts_are_partitions(spark, server, tmp_path):
    feed_source.register(spark)
    server.pages |= {"/a": '"1"'}
    read = lambda: spark.read.format("feeds").option("store", str(tmp_path)).option("feeds", server.catalogue(*FEEDS)).option("client", "tests.test_feed_source:quick").load()
    df = read()
    assert df.rdd.getNumPartitions() == 2
    assert sorted((r["url"].rsplit("/", 1)[1], r["status"]) for r in df.collect()) == [("a", 200), ("b", 404), ("c", 404), ("gone", 404)]
    assert len({r["poll"] for r in read().collect()}) == 1
    server.http.shutdown()
    server.http.server_close()
    down = read().where("url like '%/a'").collect()
    assert down[0]["status"] is None and down[0]["note"] and down[0]["etag"] == '"1"'  # a failure keeps what is known


def test_old_polls_are_deleted(tmp_path):
    s = Store(str(tmp_path))
    for p in (1, 2, 3, 4):
        s.put(p, "x", [{"url": "u", "etag": str(p)}])
    s.put(1, "rare", [{"url": "r", "etag": "old"}])
    s.forget(3)
    assert s.polls() == [1, 3, 4] and s.get(1, "x") is None and s.latest(9, "rare") == {"r": {"url": "r", "etag": "old"}}
    assert s.latest(4, "x")["u"]["etag"] == "3" and s.latest(3, "x") == {}
