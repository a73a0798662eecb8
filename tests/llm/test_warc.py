import base64
import gzip
import hashlib
import json
import zlib

from html.parser import HTMLParser
from time import process_time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from transitlake.llm import warc as W

PAGE = """<!DOCTYPE html><html lang="DE"><head><title>A &amp; B
 c</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><a href="/x?a=1&amp;b=2">x</a></nav><!-- <p>no</p> -->
<h1>Head</h1><p>One <b>two</b>&nbsp;three<br>four</p><p>five &lt; six &euro;</p><ul><li>a<li>b</ul><a href='/y'>y</a><a href=/z>z</a><a href="/y">y</a><footer>foot</footer></body></html>"""


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_records_round_trip():
    a, b = W.record([("WARC-Type", "response"), ("X", "é: 1")], b"one\r\n\r\ntwo"), W.record([("WARC-Type", "request")], b"")
    assert list(W.parse(a + b)) == [({"warc-type": "response", "x": "é: 1", "content-length": "10"}, b"one\r\n\r\ntwo"), ({"warc-type": "request", "content-length": "0"}, b"")]
    assert list(W.parse(b"")) == []
    for broken in (b"junk", a[:-8], b"WARC/1.1\r\nContent-Length: 99\r\n\r\nx"):
        with pytest.raises((ValueError, KeyError)):
            list(W.parse(broken))


def test_derivatives_are_linked():
    data = W.response("http://x.org/é", PAGE, "7", "2024-02-03T04:05:06Z")
    ((headers, block),) = W.parse(data)
    (meta, fields), (conv, text) = W.derivatives(headers, block)
    for h, made, kind in ((dict(meta), fields, "metadata"), (dict(conv), text, "conversion")):
        assert h["WARC-Type"] == kind and h["WARC-Refers-To"] == headers["warc-record-id"] and h["WARC-Target-URI"] == "http://x.org/é" and h["WARC-Date"] == "2024-02-03T04:05:06Z"
        assert h["WARC-Source-Payload-Digest"] == headers["warc-payload-digest"] == sha1(PAGE.encode()) and h["WARC-Block-Digest"] == sha1(made)
    assert dict(meta)["WARC-Record-ID"] != dict(conv)["WARC-Record-ID"] != headers["warc-record-id"]
    said = json.loads(fields)
    assert said["title"] == "A & B c" and said["lang"] == "de" and said["links"] == ["/x?a=1&b=2", "/y", "/z"] and said["status"] == "HTTP/1.1 200 OK"
    assert ["Content-Type", "text/html; charset=utf-8"] in said["http-headers"] and said["block-digest"] == sha1(block)
    assert text.decode() == "Head\nOne two three\nfour\nfive < six €\na\nb\nyzy"


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("plain", "plain"), ("<p>a", "a"), ("a < b > c", "a < b > c"), ("<script>never closed", ""), ("<!-- open", ""), ("x<br/>y", "x\ny"), ("<p title='>'>q", "'>q"), ("&#233;&eacute;&bogus;", "éé&bogus;"), ("<" * 50_000, "<" * 50_000),
])
def test_plain_text(page, text):
    assert W.plain_text(page) == text


def test_other_charsets():
    block = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\n\r\n<p>é</p>".encode("latin-1")
    assert W.derivatives({"warc-record-id": "r"}, block)[1][1].decode() == "é"
    assert W.derivatives({"warc-record-id": "r"}, b"no head")[1][1] == b""


def test_query_and_edge_cases(spark):
    rows = [(1, "http://a/", PAGE, "w"), (1, "http://a/", PAGE, None), (2, None, None, "x"), (None, "u\r\nX: y", "<p>z</p>", "y"), (3, "http://b/", "", "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, warc string")
    got = W.build(W.responses(df)).collect()
    assert len(got) == 2 * len(rows) and len({r.record_id for r in got}) == 2 * len(rows) - 2  # repeated rows repeat their records
    for r in got:
        ((h, block),) = W.parse(bytes(r.warc))
        assert h["warc-record-id"] == r.record_id and h["warc-refers-to"] == r.refers_to and block.decode() == r.block and r.content_length == len(block) and r.block_digest == sha1(block)
    assert {r.block for r in got if r.warc_type == "conversion" and r.page_id in (2, 3)} == {""}
    assert W.build(W.responses(df.limit(0))).collect() == []
    both = spark.createDataFrame([(1, W.response("u", "<p>a", "1") + W.record([("WARC-Type", "request")], b"x")), (2, None), (3, b"")], "page_id long, warc binary")
    assert W.build(both).count() == 2
    good = W.response("u", "<p>a", "1")
    no_id, no_length = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nab\r\n\r\n", b"WARC/1.1\r\nWARC-Type: response\r\n\r\nab\r\n\r\n"
    broken = spark.createDataFrame([(1, b"junk"), (2, b"junk\r\n" + good), (3, good[:-8]), (4, no_id + good), (5, no_length + good), (6, gzip.compress(good) + gzip.compress(good)[:-9]), (7, gzip.compress(good) + b"x")], "page_id long, warc binary")
    got = W.build(broken).collect()
    assert {i: sorted(r.warc_type for r in got if r.page_id == i) for i in range(1, 8)} == {1: ["error"], 3: ["error"], **{i: ["conversion", "error", "metadata"] for i in (2, 4, 5, 7)}, 6: ["conversion"] * 2 + ["metadata"] * 2}
    assert {r.block for r in got if r.warc_type == "error"} == {"no record at byte 0", "the record at byte 0 is cut short", "a response without WARC-Record-ID", "the record at byte 0 has no length"}


@pytest.mark.parametrize(("page", "text"), [
    ("<body><form action=/x><p>prose <b>here</b></p><select><option>no</select><textarea>no</textarea><button>no</button><p>more</p></form></body>", "prose here\nmore"),
    ("a<svg width='1'/>b<p>c", "a b\nc"), ("a<object data=x />b", "a b"), ("a<svg>b<p>c", "ab\nc"), ("a<object data=x>b<p>c", "ab\nc"), ("a<template>b", "ab"), ("a<svg><path d='M0'/><text>no</text></svg>b", "a b"),
    ("<svg/><p>one</p><svg><text>no</text></svg><p>two", "one\ntwo"), ("<nav>no</nav>b<footer>no</footer>c", "b\nc"), ("<script/>no", ""),
])
def test_prose_is_kept(page, text):
    assert W.plain_text(page) == text


UNITS = ["<svg>", "<svg/>", "<nav>", "<object/", "<a ", "<a href=", "<a href='", "<a href=x>", "<form><a href=x>", "<script", "<script>", "</script ", "<!--", "<title", "<title>", "<html lang=", "<p ", "</", "< ", "<", "<nav></nav>", "&amp", "<textarea></textarea >"]


@pytest.mark.parametrize("unit", UNITS)
def test_hostile_pages_take_linear_time(unit):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + (unit * (2_000_000 // len(unit))).encode()
    began = process_time()
    W.derivatives({"warc-record-id": "r"}, block)
    assert process_time() - began < 30


class Plain(HTMLParser):
    """The visible lines and the links of a well-formed page, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.text, self.links = 0, [], []

    def handle_starttag(self, tag, attrs):
        self.links += [v for k, v in attrs if tag == "a" and k == "href"]
        if tag in W._SILENT:
            self.text.append(" " if tag in ("svg", "script", "style") else "\n")
            self.depth += 1
        elif tag in W._BLOCKS and not self.depth:
            self.text.append("\n")

    def handle_endtag(self, tag):
        if tag in W._SILENT:
            self.depth -= 1
        elif tag in W._BLOCKS and not self.depth:
            self.text.append("\n")

    def handle_data(self, data):
        if not self.depth:
            self.text.append(data)


def element(children):
    names = st.sampled_from(["p", "div", "b", "i", "span", "ul", "li", "h1", "form", "section", "a href='/é?x=1&amp;y=2'", 'a class="k" href="/z"', "table", "td"])
    return st.builds(lambda n, kids: f"<{n}>{''.join(kids)}</{n.split()[0]}>", names, st.lists(children, max_size=4))


LEAF = st.sampled_from(["word ", "é &amp; ß", " \n ", "&lt;p&gt;", "<br>", "<hr/>", "<!-- a <b> comment -->", "<script>if (a < b) '</p>'</script>", "<style>p{}</style>", "<nav>menu <b>x</b></nav>", "<footer>foot</footer>", "<svg><text>no</text></svg>", "<img src='x'>", "漢字", "1 &#62; 2"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.recursive(LEAF, element, max_leaves=12), max_size=5).map("".join))
def test_equals_a_parser(page):
    parser = Plain()
    parser.feed(page)
    parser.close()
    lines = [" ".join(x.split()) for x in "".join(parser.text).split("\n")]
    assert W.plain_text(page) == "\n".join(x for x in lines if x)
    assert W.page_facts(page, W.tags(page))[2] == list(dict.fromkeys(parser.links))


@pytest.mark.parametrize(("page", "text"), [("<script>var a = '<!--';</script><p>x", "x"), ("<nav-item>x</nav-item>", "x"), ("<a href='/x?a>b'>y</a>", "b'>y"), ("a<p", "a"), ("<title>t", "t")])
def test_odd_pages(page, text):
    assert W.plain_text(page) == text


def test_links_keep_their_quoted_ends():
    page = "<a href='/x?a>b'>y</a><a href=\"/open>z</a><a href=/plain>"
    assert W.page_facts(page, W.tags(page))[2] == ["/x?a>b", "/open", "/plain"]


def test_odd_codecs_do_not_fail():
    for name in ("idna", "undefined", "punycode", "base64", "rot13", "utf-16", "unicode_escape"):
        (_, _), (_, text) = W.derivatives({"warc-record-id": "r"}, f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset={name}\r\n\r\n<p>\\ud800 x\xff".encode("latin-1"))
        text.decode()


def test_files_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://a/{i}", PAGE if i % 2 else None) for i in range(7)] + [(99, "u", "<p>é")], "page_id long, url string, html string").repartition(3)
    derived = W.build(W.responses(pages))
    wrote = W.write_files(derived, f"file://{tmp_path}/out").collect()
    assert sum(r.n_records for r in wrote) == 16 and len(list((tmp_path / "out").iterdir())) == len(wrote)
    found = [x for r in W.read_files(spark, str(tmp_path / "out")).collect() for part in W.members(bytes(r.warc)) for x in W.parse(part)]
    assert sorted((h["warc-record-id"], b.decode()) for h, b in found) == sorted((r.record_id, r.block) for r in derived.collect())
    # responses as files, a member each, one of them plain
    for i, data in enumerate([W.response("u", "<p>a", "1"), W.response("v", "<p>b", "2")]):
        (tmp_path / f"in{i}.warc{'.gz' * i}").write_bytes(gzip.compress(data) + gzip.compress(W.response("w", "<p>c", "3")) if i else data)
    assert sorted(r.block for r in W.build(W.read_files(spark, str(tmp_path), "in*")).where("warc_type = 'conversion'").collect()) == ["a", "b", "c"]
    assert W.write_files(derived.limit(0), f"file://{tmp_path}/none").collect() == []


def chunked(data, n=7):
    return b"".join(b"%x;x=1\r\n%b\r\n" % (len(data[i : i + n]), data[i : i + n]) for i in range(0, len(data), n)) + b"0\r\nTrailer: x\r\n\r\n"


RAW = "<title>T</title><p>é prose</p>".encode()
DEFLATE = zlib.compressobj(wbits=-15)
BARE = DEFLATE.compress(RAW) + DEFLATE.flush()


@pytest.mark.parametrize(("names", "body"), [
    ("Transfer-Encoding: chunked", chunked(RAW)), ("Content-Encoding: gzip", gzip.compress(RAW)), ("content-encoding: X-GZIP", gzip.compress(RAW[:9]) + gzip.compress(RAW[9:])), ("Content-Encoding: deflate", zlib.compress(RAW)), ("Content-Encoding: deflate", BARE),
    ("Content-Encoding: gzip\r\nTransfer-Encoding: chunked", chunked(gzip.compress(RAW))), ("Transfer-Encoding: gzip, chunked", chunked(gzip.compress(RAW))), ("Content-Encoding: deflate, gzip", gzip.compress(zlib.compress(RAW))),
    ("Content-Encoding: gzip", RAW), ("Transfer-Encoding: chunked", RAW), ("Content-Encoding: br", RAW),
])
def test_encodings_are_undone(names, body):
    block = f"HTTP/1.1 200 OK\r\n{names}\r\n\r\n".encode() + body
    (_, fields), (conv, text) = W.derivatives({"warc-record-id": "r", "warc-ip-address": "10.0.0.1", "x-own": "é"}, block)
    assert text.decode() == "T\né prose" and json.loads(fields)["title"] == "T"
    assert json.loads(fields)["payload-digest"] == sha1(body) and json.loads(fields)["warc-headers"] == [["warc-record-id", "r"], ["warc-ip-address", "10.0.0.1"], ["x-own", "é"]]
