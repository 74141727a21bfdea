"""Feeds that are no well-formed XML."""

import pytest

from dawnpress.sources.feeds import decode, lenient_entries, parse_feed

GOOD = """<?xml version="1.0" encoding="UTF-8"?><rss xmlns:media="http://search.yahoo.com/mrss/" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>Kanal</title>
<item><title>Satu &amp; dua</title><link>https://a.example/1</link><description><![CDATA[<p>Isi <b>satu</b></p>]]></description><pubDate>Wed, 10 Sep 2026 01:02:03 +0700</pubDate>
<media:content url="https://a.example/1.jpg" medium="image"><media:title>Judul foto</media:title></media:content><source url="https://b.example">B</source></item>
<item><title>Tiga</title><link>https://a.example/2</link><content:encoded>&lt;img src="https://a.example/2.png"&gt; teks</content:encoded><enclosure url="https://a.example/2.mp3" type="audio/mpeg"/></item>
</channel></rss>"""


def brief(entries):
    return [(e["link"], e["title"], e["summary"], e["content"], e["published"], e["source"], e["source_url"], e["media"], e["enclosures"]) for e in entries]


WANT = brief(parse_feed(GOOD.encode()))


def test_strict_reading():
    assert [w[:2] for w in WANT] == [("https://a.example/1", "Satu & dua"), ("https://a.example/2", "Tiga")]
    assert WANT[0][2] == "<p>Isi <b>satu</b></p>" and WANT[0][7] == [("https://a.example/1.jpg", "image")] and WANT[0][5:7] == ("B", "https://b.example")
    assert WANT[1][3] == '<img src="https://a.example/2.png"> teks' and WANT[1][8] == [("https://a.example/2.mp3", "audio/mpeg")]


@pytest.mark.parametrize(
    "name, change",
    {
        "as it is": lambda t: t,
        "bare ampersand": lambda t: t.replace("&amp;", "&"),
        "unknown entity": lambda t: t.replace("Kanal", "Kanal&nbsp;&hellip;"),
        "no declared prefix": lambda t: t.replace('xmlns:media="http://search.yahoo.com/mrss/"', ""),
        "unclosed title": lambda t: t.replace("Tiga</title>", "Tiga"),
        "unclosed entry": lambda t: t.replace("</item>\n<item>", "\n<item>"),
        "cut off": lambda t: t[: t.index("</channel>")].rsplit("</item>", 1)[0],
        "junk before": lambda t: "Warning: cache miss\n" + t,
        "junk behind": lambda t: t + "<script>x</script>",
        "attributes without quotes": lambda t: t.replace('medium="image"', "medium=image"),
        "bare markup": lambda t: t.replace("<![CDATA[", "").replace("]]>", "").replace("<channel>", "<channel><br>"),
        "control character": lambda t: t.replace("Kanal", "Ka\x0bnal"),
        "wrong end": lambda t: t.replace("</description>", "</description></p>"),
        "comment": lambda t: t.replace("<channel>", "<channel><!-- <item> & -->").replace("Kanal", "&"),
    }.items(),
)
def test_broken_feeds_give_the_same_entries(name, change):
    text = change(GOOD)
    got = brief(parse_feed(text.encode()))
    if name == "unclosed title":  # blanks before the next element stay at the ends, which are cut
        got = [tuple(x.strip() if isinstance(x, str) else x for x in e) for e in got]
    assert got == WANT
    assert len(lenient_entries(text)) == 2  # also where the strict way works


def test_encodings():
    line = "<rss><channel><item><title>Café – naïve</title><link>l</link></item></channel></rss>"
    title = lambda b: [e["title"] for e in parse_feed(b)]
    assert title(line.encode()) == title(b"\xef\xbb\xbf" + line.encode()) == title(line.encode("utf-16")) == ["Café – naïve"]
    declared = lambda name: f'<?xml version="1.0" encoding="{name}"?>'
    assert title(declared("windows-1252").encode() + line.encode("cp1252")) == ["Café – naïve"]
    assert title(declared("utf-8").encode() + line.encode("cp1252")) == ["Café – naïve"]  # says UTF-8 and is not
    assert title(declared("no-such-code").encode() + line.encode()) == ["Café – naïve"]
    assert title(line.encode("cp1252")) == ["Café – naïve"]
    assert decode(b"") == "" and parse_feed(b"") == [] and parse_feed(b"\x00\xff<item") == [] and parse_feed(b"not a feed") == []


def test_atom():
    text = '<feed xmlns="http://www.w3.org/2005/Atom"><title>T & T</title><entry><title type="html">Judul &amp; isi</title><link rel="alternate" href="https://a.example/x?a=1&b=2"/><updated>2026-09-10T00:00:00Z</updated><content type="html">&lt;p&gt;x&lt;/p&gt;</content></entry></feed>'
    (e,) = parse_feed(text.encode())
    assert (e["link"], e["title"], e["updated"], e["content"]) == ("https://a.example/x?a=1&b=2", "Judul & isi", "2026-09-10T00:00:00Z", "<p>x</p>")
