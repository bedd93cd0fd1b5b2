import base64
import hashlib
import random
import time
from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark.sql import functions as F

from tributary.llm import warc

PAGE = """<!DOCTYPE html><html lang="fr"><head><title>A &amp; B</title><style>p{}</style>
<script>var t="</p><a href='/no'>";</script></head><body><nav><a href="/x?a=1&amp;b=2">x</a></nav>
<!-- <a href="/hidden">h</a> --><p>One<b>two</b>&nbsp;three<br>four <a class=c href='b.html#f'>l</a></body></html>"""


class Reading(HTMLParser):
    """Text and links of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.links, self.hidden = [], [], False

    def handle_starttag(self, tag, attrs):
        self.hidden = tag in ("script", "style")
        if tag == "a":
            self.links += [v for k, v in attrs if k == "href"]
        if tag in ("p", "br", "div", "li", "html", "title"):
            self.parts.append("\n")

    def handle_endtag(self, tag):
        if self.hidden:
            self.parts.append(" ")
        self.hidden = False
        if tag in ("p", "div", "title"):
            self.parts.append("\n")

    def handle_comment(self, data):
        self.parts.append(" ")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def parse(record):
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    length = int(headers["Content-Length"])
    assert lines[0] == "WARC/1.1" and rest[length:] == b"\r\n\r\n"
    return headers, rest[:length]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_type", F.lit("clash"))


def test_records_round_trip(spark):
    rows = warc.derive_records(pages(spark, [(7, "http://e.org/d/p", PAGE)])).collect()
    assert [r.record_type for r in rows] == ["response", "metadata", "conversion"]
    original, *rows = rows
    source = warc.response(7, "http://e.org/d/p", PAGE)
    told = dict(source["headers"])
    assert original.record == warc.serialise(source["headers"], source["block"]) and original.refers_to is None
    for r in rows:
        headers, block = parse(r.record)
        assert headers["WARC-Type"] == r.record_type
        assert headers["WARC-Record-ID"] == r.record_id
        assert headers["WARC-Refers-To"] == r.refers_to == source["record_id"]
        assert headers["WARC-Target-URI"] == r.target_uri == "http://e.org/d/p"
        assert headers["WARC-Date"] == told["WARC-Date"]
        assert headers["WARC-Block-Digest"] == r.block_digest == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
        assert r.source_payload_digest == told["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(PAGE.encode()).digest()).decode()
        assert r.content_length == len(block) and r.n_links == 2
    fields = parse(rows[0].record)[1].decode().split("\r\n")
    assert "title: A & B" in fields and "language: fr" in fields
    assert "source-http-header: Content-Type: text/html; charset=utf-8" in fields
    assert [f for f in fields if f.startswith("outlink")] == ["outlink: http://e.org/x?a=1&b=2", "outlink: http://e.org/d/b.html#f"]
    assert parse(rows[1].record)[1].decode() == "A & B\nx\nOnetwo three\nfour l"
    assert len({r.record_id for r in rows} | {source["record_id"]}) == 3


def test_response_record_is_whole():
    source = warc.response(1, "http://e.org", PAGE)
    headers, block = parse(warc.serialise(source["headers"], source["block"]))
    assert headers["WARC-Type"] == "response" and block.partition(b"\r\n\r\n")[2] == PAGE.encode()


def test_odd_pages(spark):
    rows = [
        (None, None, None), (1, "http://[bad", "<a href='x'>y</a>"), (2, "u", ""), (2, "u", ""), (3, "u", "<p>open <b"),
        (4, "u", "<script>never closed"), (5, "u", "<!-- never closed <p>x"), (6, "u", "a < b and c > d"),
        (7, "u", "<a " * 30_000), (8, "u\r\nX: y", "z"),
    ]
    found = warc.derive_records(pages(spark, rows)).collect()
    assert len(found) == 3 * len(rows)
    assert {r.refers_to for r in found} - {None} == {r.record_id for r in found if r.record_type == "response"}
    texts = {r.page_id: parse(r.record)[1].decode() for r in found if r.record_type == "conversion"}
    assert texts == {None: "", 1: "y", 2: "", 3: "open", 4: "", 5: "", 6: "a < b and c > d", 7: "", 8: "z"}
    for r in found:
        headers, _ = parse(r.record)
        assert headers["WARC-Target-URI"] == r.target_uri
    assert warc.derive_records(pages(spark, [])).collect() == []


def test_given_responses_keep_what_they_say(spark):
    block = b"HTTP/1.1 404 Not Found\r\nServer: x\r\nContent-Type: text/html\r\n\r\n" + PAGE.encode()
    headers = [
        ("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:1>"), ("WARC-Target-URI", "<http://e.org/d/p>"),
        ("WARC-Date", "2024-05-06T07:08:09Z"), ("WARC-Payload-Digest", "sha1:GIVEN"),
    ]
    other = warc.serialise([("WARC-Type", "request"), ("WARC-Record-ID", "<urn:uuid:2>")], b"GET /")
    bare = warc.serialise([("WARC-Type", "response")], b"HTTP/1.1 200 OK\r\n\r\nhi")
    rows = [(1, warc.serialise(headers, block)), (2, other), (3, None), (4, b"junk"), (5, warc.serialise(headers, block)[:-40]), (6, bare)]
    df = spark.createDataFrame(rows, "page_id long, record binary").withColumn("record_type", F.lit("clash"))
    found = {(r.page_id, r.record_type): r for r in warc.derive_from_responses(df).collect()}
    assert sorted(found) == sorted((p, t) for p in (1, 6) for t in ("response", "metadata", "conversion"))
    assert found[1, "response"].record == warc.serialise(headers, block)
    for kind in ("metadata", "conversion"):
        told, own = parse(found[1, kind].record)
        assert told["WARC-Refers-To"] == "<urn:uuid:1>" and told["WARC-Date"] == "2024-05-06T07:08:09Z"
        assert found[1, kind].source_payload_digest == "sha1:GIVEN"
        assert found[6, kind].refers_to == found[6, "response"].record_id != found[1, kind].refers_to
    fields = parse(found[1, "metadata"].record)[1].decode().split("\r\n")
    assert "source-http-status: HTTP/1.1 404 Not Found" in fields and "source-http-header: Server: x" in fields
    assert parse(found[1, "conversion"].record)[0]["WARC-Source-Payload-Digest"] == "sha1:GIVEN"


def test_like_a_parser(spark):
    """Random pages against an independent reading by the standard library's parser."""
    r = random.Random(5)
    pieces = ["<p>", "</p>", "<b>", "</b>", "<br/>", " one", "two ", "&amp;", "&lt;x", "<a href='/q?a=1&amp;b=2'>", "</a>", '<A class=c HREF="z">', "<div id=\"d\">",
              "</div>", "<!-- <p>no <a href='n'> -->", "<script>var a = '<a href=s>';</script>", "<style>p {}</style>", "\n", "<li>", "<img src=i alt='href=no'>", "<a name=x>", "5 < 6"]
    for _ in range(200):
        page = "<html lang=en><title>T &amp; t</title>" + "".join(r.choices(pieces, k=r.randrange(40)))
        own = Reading()
        own.feed(page)
        own.close()
        text = [" ".join(x.split()) for x in "".join(own.parts).split("\n")]
        assert warc.page_text(page) == "\n".join(x for x in text if x)
        assert warc.page_fields(page, "http://e.org/d/") == ("T & t", "en", [urljoin("http://e.org/d/", x) for x in own.links])


def test_pages_are_scanned_in_linear_time():
    for piece in ("<a ", "<html ", "<!--", "<script>", "<title>", "</title ", "</", "<a href='", "<a href= ", "a=", "<", "<a href=x", "<p <b >"):
        for page in (piece * (1_000_000 // len(piece)), "<a " + piece * (1_000_000 // len(piece)), "<script>" + piece * (1_000_000 // len(piece))):
            start = time.perf_counter()
            warc.page_fields(page, "http://e.org/")
            warc.page_text(page)
            assert time.perf_counter() - start < 8, piece


def test_digests_only(spark):
    df = pages(spark, [(7, "http://e.org/d/p", PAGE), (8, None, None)])
    whole = {(r.page_id, r.record_type): hashlib.sha256(r.record).hexdigest() for r in warc.derive_records(df).collect()}
    assert whole == {(r.page_id, r.record_type): r.record_sha256 for r in warc.derive_records(df, digests_only=True).collect()}
