"""WARC derivatives: from response records, linked metadata and plain-text conversion records.

Records follow WARC/1.1. A response holds the HTTP message as it came; its derivatives name it in ``WARC-Refers-To`` and
repeat its target, date and payload digest, so that each can be traced without the other. Pages are read in one pass over
their tags, whose time grows with the page's length only, whatever the page holds. Files are plain or gzip, a member for each
record; a record that is broken is reported in a row of its own, and reading goes on with the next.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tokens import file_system, put

VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("b7f3f1de-6d31-5b0e-9a52-0c1f6a5f2a10")
# HTML elements that hold no prose, and those that begin a line of their own.
_SILENT = frozenset("script style noscript template svg math iframe object head nav footer aside button select textarea".split())
_BLOCKS = frozenset("address article blockquote br caption dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hr li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
# What HTML never reads as markup runs to its end tag or the text's end, slash or not; other elements end at their tag if
# it closes itself or nothing closes them.
_RAW = {name: re.compile(rf"</{name}\s*>", re.I) for name in "script style noscript iframe textarea".split()}
_INLINE = frozenset("template svg math object".split())
_CHUNK = re.compile(rb"([0-9A-Fa-f]{1,16})[ \t]*(?:;[^\r\n]*)?\r\n")
_NAME = re.compile(r"(/?)([A-Za-z][^\s/>]*)")
_END_TITLE = re.compile(r"</title\s*>", re.I)
_HREF = re.compile(r"\bhref\s*=\s*", re.I)
_LANG = re.compile(r"\blang\s*=\s*[\"']?([A-Za-z-]+)", re.I)


def record_id(*parts: str) -> str:
    """A record's URI, always the same for the same parts, so that a task that runs again gives the same records."""
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(0).join(parts))}>"


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record: version, headers, an empty line, the block, two empty lines."""
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def records(data: bytes) -> Iterator[tuple[dict[str, str] | None, bytes]]:
    """The records of a WARC file: headers by name, in lower case, and block; for what cannot be one, None and what is wrong.

    After a broken record reading goes on with the next line that begins one.
    """
    at = 0
    while at < len(data):
        stop = data.find(b"\r\n\r\n", at) if data.startswith(b"WARC/", at) else -1
        wrong = f"no record at byte {at}"
        if stop >= 0:
            lines = data[at:stop].decode("utf-8", "replace").split("\r\n")
            headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            length = headers.get("content-length", "")
            if not (length.isascii() and length.isdigit()):
                wrong = f"the record at byte {at} has no length"
            elif stop + 4 + int(length) > len(data):
                wrong = f"the record at byte {at} is cut short"
            else:
                end = stop + 4 + int(length)
                yield headers, data[stop + 4 : end]
                at = end + 4 if data.startswith(b"\r\n\r\n", end) else end + 2 * data.startswith(b"\r\n", end)
                continue
        yield None, wrong.encode()
        following = data.find(b"\r\nWARC/", at)
        at = following + 2 if following >= 0 else len(data)


def members(data: bytes) -> Iterator[bytes]:
    """A file's contents: of a gzip one each member for itself, of another the whole. A broken member gives what could be read, and ends the file."""
    at, step = 0, 1 << 16
    while data[at : at + 2] == b"\x1f\x8b":
        d, out = zlib.decompressobj(31), []
        try:
            while at < len(data) and not d.eof:
                out.append(d.decompress(data[at : at + step]))
                at = min(at + step, len(data)) - len(d.unused_data)
        except zlib.error:
            at = len(data)
        yield b"".join(out)
    if at < len(data):
        yield data[at:]


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of a WARC file; what cannot be one raises ValueError."""
    for headers, block in records(data):
        if headers is None:
            raise ValueError(block.decode())
        yield headers, block


def response(url: str, page: str, key: str, date: str = DATE) -> bytes:
    """A response record around a stored page, as a crawler would have written it."""
    body = page.encode("utf-8", "replace")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body) + body
    return record(
        [("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", key, url, page)), ("WARC-Date", date), ("WARC-Target-URI", _one_line(url)), ("WARC-Payload-Digest", digest(body)), ("WARC-Block-Digest", digest(block)), ("Content-Type", "application/http; msgtype=response")], block
    )


def _one_line(s: str) -> str:
    return re.sub(r"[\r\n]+", " ", s)


def http_parts(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers in their order, body."""
    head, _, body = block.partition(b"\r\n\r\n")
    first, *rest = head.decode("latin-1").split("\r\n")
    return first, [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in rest)], body


#: A tag: where it starts and ends, whether it is an end tag, its name in lower case (empty for what is never read: comments
#: and raw elements whole), where its attributes start.
Tag = tuple[int, int, bool, str, int]


def tags(page: str) -> list[Tag]:
    """All tags of a page, in order. One without its ``>`` goes to the text's end."""
    out: list[Tag] = []
    at, close = page.find("<"), -1
    while at >= 0:
        m = _NAME.match(page, at + 1)
        if page.startswith("<!--", at):
            stop = page.find("-->", at + 4)
            stop = stop + 3 if stop >= 0 else len(page)
            out.append((at, stop, False, "", stop))
        elif m or page[at + 1 : at + 2] in ("/", "!", "?"):
            if close < at:
                close = page.find(">", at)
                close = close if close >= 0 else len(page)
            stop, name = min(close + 1, len(page)), m[2].lower() if m else "!"
            if m and not m[1] and name in _RAW and close < len(page):
                end = _RAW[name].search(page, stop)
                stop = end.end() if end else len(page)
                out.append((at, stop, False, "", stop))
            else:
                out.append((at, stop, bool(m and m[1]), name if close < len(page) else "!", m.end() if m else stop))
        else:
            stop = at + 1
        at = page.find("<", stop)
    return out


def _dechunked(body: bytes) -> bytes:
    """A body without its chunked framing; what is not framed so stays, and what a broken frame held is kept."""
    out, at = [], 0
    while m := _CHUNK.match(body, at):
        n = int(m[1], 16)
        if n == 0:
            return b"".join(out)
        out.append(body[m.end() : m.end() + n])
        at = m.end() + n
        at += 2 * (body[at : at + 2] == b"\r\n")
    return b"".join([*out, body[at:]])


def _inflated(body: bytes, wbits: int) -> bytes:
    """All members of a compressed body; of a broken one what could be read."""
    out = []
    while body:
        d = zlib.decompressobj(wbits)
        try:
            for i in range(0, len(body), 1 << 16):
                out.append(d.decompress(body[i : i + (1 << 16)]))
                if d.eof:
                    rest = d.unused_data + body[i + (1 << 16) :]
                    break
            else:
                rest = b""
        except zlib.error:
            return b"".join(out)
        body = rest if rest[:2] == b"\x1f\x8b" else b""
    return b"".join(out)


def decoded_body(headers: list[tuple[str, str]], body: bytes) -> bytes:
    """The body without its Transfer- and Content-Encodings: chunked, gzip and deflate, the last first. Others, and bodies that a crawler stored decoded, stay."""
    for wanted in ("transfer-encoding", "content-encoding"):
        codings = [c.strip().lower() for k, v in headers if k.lower() == wanted for c in v.split(",")]
        for coding in reversed(codings):
            if coding == "chunked":
                body = _dechunked(body)
            elif coding in ("gzip", "x-gzip") and body[:2] == b"\x1f\x8b":
                body = _inflated(body, 31)
            elif coding == "deflate":
                # a zlib stream says so in its first two bytes; some servers send the bare one
                framed = len(body) > 1 and body[0] & 15 == 8 and (body[0] << 8 | body[1]) % 31 == 0
                body = _inflated(body, 15 if framed else -15) or body
    return body


def plain_text(page: str, found: list[Tag] | None = None) -> str:
    """The visible prose of a page: no scripts, styles, menus, footers, controls of forms, drawings, embedded objects or comments; one line for each block, spaces made one.

    A silent element goes from its tag to the first end tag of its name; a tag that nothing closes is left to stand alone.
    ``found`` are the page's tags, if they are known.
    """
    found = tags(page) if found is None else found
    closing: dict[str, int] = {}
    after = []  # the end of the first end tag from each tag on, of that tag's name
    for _, end, last, name, _ in reversed(found):
        if last:
            closing[name] = end
        after.append(closing.get(name, 0))
    out, at = [], 0
    for (start, end, last, name, _), stop in zip(found, reversed(after), strict=True):
        if start < at:
            continue
        out.append(page[at:start])
        at = end
        if not name:
            out.append("" if page.startswith("<!--", start) else " ")
        elif name in _INLINE and not last and page.startswith("/>", end - 2):
            out.append(" ")
        elif name in _SILENT and not last and stop:
            out.append(" " if name in _INLINE else "\n")
            at = stop
        elif name in _BLOCKS:
            out.append("\n")
    lines = (" ".join(x.split()) for x in html.unescape("".join([*out, page[at:]])).split("\n"))
    return "\n".join(x for x in lines if x)


def page_facts(page: str, found: list[Tag]) -> tuple[str | None, str | None, list[str]]:
    """A page's title, its language and its links, each once, in order."""
    title = lang = None
    links: dict[str, None] = {}
    quotes = {"'": -1, '"': -1}
    for _, end, last, name, attributes in found:
        if last:
            continue
        if name == "title" and title is None:
            stop = _END_TITLE.search(page, end)
            title = " ".join(html.unescape(page[end : stop.start() if stop else len(page)]).split())
        elif name == "html" and lang is None:
            m = _LANG.search(page, attributes, end)
            lang = m[1].lower() if m else None
        elif name == "a" and (m := _HREF.search(page, attributes, end)):
            mark, at = page[m.end() : m.end() + 1], m.end() + 1
            if mark in quotes:
                if quotes[mark] < at:
                    quotes[mark] = page.find(mark, at)
                    quotes[mark] = quotes[mark] if quotes[mark] >= 0 else len(page)
                stop = quotes[mark] if quotes[mark] < len(page) else end - 1
                links[html.unescape(page[at:stop])] = None
            elif value := re.match(r"[^\s>]+", page[m.end() : end]):
                links[html.unescape(value[0])] = None
    return title, lang, list(links)


def _charset(headers: list[tuple[str, str]]) -> str:
    for k, v in headers:
        if k.lower() == "content-type" and (m := re.search(r"charset=\"?([\w.:-]+)", v, re.I)):
            try:
                "".encode(m[1])
                return m[1]
            except LookupError:
                pass
    return "utf-8"


def derivatives(headers: dict[str, str], block: bytes) -> list[tuple[list[tuple[str, str]], bytes]]:
    """The metadata and the conversion record of a response record, as headers and block. The metadata holds all of the source's WARC and HTTP headers."""
    source, url, date = headers["warc-record-id"], headers.get("warc-target-uri", ""), headers.get("warc-date", DATE)
    status, http, body = http_parts(block)
    data = decoded_body(http, body)
    try:
        page = data.decode(_charset(http), "replace")
    except ValueError:  # some codecs know no replacement
        page = data.decode("utf-8", "replace")
    payload = headers.get("warc-payload-digest") or digest(body)
    found = tags(page)
    title, lang, links = page_facts(page, found)
    fields = {
        "status": status, "warc-headers": [[k, v] for k, v in headers.items()], "http-headers": http, "block-digest": headers.get("warc-block-digest") or digest(block), "payload-digest": payload,
        "title": title, "lang": lang, "links": links,
    }
    meta, text = json.dumps(fields, ensure_ascii=False).encode("utf-8", "replace"), plain_text(page, found).encode("utf-8", "replace")
    out = []
    for kind, data, content in (("metadata", meta, "application/json"), ("conversion", text, "text/plain; charset=utf-8")):
        out.append(([("WARC-Type", kind), ("WARC-Record-ID", record_id(kind, source)), ("WARC-Refers-To", source), ("WARC-Refers-To-Target-URI", url), ("WARC-Refers-To-Date", date), ("WARC-Date", date), ("WARC-Target-URI", url), ("WARC-Source-Payload-Digest", payload), ("WARC-Block-Digest", digest(data)), ("Content-Type", content)], data))
    return out


def responses(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, warc): each stored page as a response record. A null url or page is empty; other columns are ignored."""
    own = pages.select(F.col(page_id).alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"), F.coalesce(F.col(page), F.lit("")).alias("page"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, texts = (batch.column(i).to_pylist() for i in range(3))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([response(u, t, str(i)) for i, u, t in zip(ids, urls, texts, strict=True)], pa.binary())], ["page_id", "warc"])

    return own.mapInArrow(run, f"page_id {own.schema['page_id'].dataType.simpleString()}, warc binary")


def build(files: DataFrame) -> DataFrame:
    """From (page_id, warc): two rows per response record found there, its metadata and its conversion.

    (page_id, warc_type, record_id, refers_to, target_uri, warc_date, payload_digest, block_digest, content_length, block,
    warc). ``warc`` can be plain or gzip. Records of other kinds give nothing, nor does null or empty data; a response without
    an HTTP head has an empty body and gives an empty conversion. What is no whole record, or a response without an id, gives
    one row of type ``error``, whose block says what is wrong; the others of the file are read. Rows that repeat give the
    same records again; other columns are ignored.
    """
    kind = files.schema["page_id"].dataType.simpleString()
    names = ["page_id", "warc_type", "record_id", "refers_to", "target_uri", "warc_date", "payload_digest", "block_digest", "content_length", "block", "warc"]

    def rows_of(data: bytes) -> Iterator[tuple]:
        for part in members(data):
            for headers, block in records(part):
                if headers is None or headers.get("warc-type") == "response" and not headers.get("warc-record-id"):
                    yield ("error", *[None] * 7, block.decode() if headers is None else "a response without WARC-Record-ID", None)
                elif headers.get("warc-type") == "response":
                    for new, made in derivatives(headers, block):
                        h = dict(new)
                        yield h["WARC-Type"], h["WARC-Record-ID"], h["WARC-Refers-To"], h["WARC-Target-URI"], h["WARC-Date"], h["WARC-Source-Payload-Digest"], h["WARC-Block-Digest"], len(made), made.decode(), record(new, made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 7 + [pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            rows, at, size = [], [], 0

            def given() -> pa.RecordBatch:
                columns = list(zip(*rows, strict=True))
                out = pa.RecordBatch.from_arrays([batch.column("page_id").take(pa.array(at, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names)
                rows.clear()
                at.clear()
                return out

            for i in range(batch.num_rows):
                for row in rows_of(batch.column("warc")[i].as_py() or b""):
                    rows.append(row)
                    at.append(i)
                    size += len(row[-1] or b"")
                    if size >= 1 << 24:
                        yield given()
                        size = 0
            if rows:
                yield given()

    return files.select("page_id", "warc").mapInArrow(run, f"page_id {kind}, warc_type string, record_id string, refers_to string, target_uri string, warc_date string, payload_digest string, block_digest string, content_length long, block string, warc binary")


def read_files(spark: SparkSession, path: str, pattern: str = "*.warc*") -> DataFrame:
    """(page_id, warc): the files below a path, plain or gzip, each named by its path; a task may take several, none is split."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("page_id"), F.col("content").alias("warc"))


def write_files(derived: DataFrame, folder: str) -> DataFrame:
    """Writes the records of ``build`` as ``part-00000.warc.gz`` and so on, a gzip member each, a file a partition; (file, n_records).

    Rows of type ``error`` are left out. A task that runs again writes the same file; a partition without records writes none.
    """
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        name, n = f"{base}/part-{TaskContext.get().partitionId():05d}.warc.gz", 0

        def written() -> Iterator[bytes]:
            nonlocal n
            for batch in batches:
                for x in batch.column("warc"):
                    n += 1
                    yield gzip.compress(x.as_py(), 6, mtime=0)

        put(fs, name, written())
        if n:
            yield pa.RecordBatch.from_pydict({"file": [name], "n_records": [n]})
        else:
            fs.delete_file(name)

    return derived.where("warc IS NOT NULL").select("warc").mapInArrow(run, "file string, n_records long")
