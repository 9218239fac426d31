"""WARC derivatives: metadata and plain-text conversion records of response records.

A response record holds a page's HTTP response.  From each one two records are derived: ``metadata``
(application/warc-fields: the source's HTTP headers, digests, title, language and links) and
``conversion`` (text/plain).  Both name their source in WARC-Refers-To, with its target URI and date, and
carry digests of their own; ids are uuid5 of what they stand for, so a task that runs again writes the same.

Text: comments, scripts, styles, templates and the title are left out, block tags end a line, entities are
resolved, white space is collapsed, and empty lines are dropped.  A page is read in one pass from left to
right, in time linear in its length whatever it holds.

Edge cases: a null html is an empty payload and a null url a record without a target; pages with equal
page_id, url and html have equal records (each row its own); unclosed comments, tags and hidden elements run
to the end; quotes count after "=" only, and an unclosed one is an ordinary character; a record's fields may
repeat, in any case and with or without a space after the colon, and the first counts; bytes that aren't UTF-8 can't occur in a string column and are replaced when records are read from files;
an empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinsift.llm.textkit import slices

DATE = "2024-01-01T00:00:00Z"
# Elements whose content is no text, and those that end a line.
HIDDEN = ("script", "style", "template", "noscript", "title")
BLOCKS = frozenset(
    ("p", "div", "br", "li", "ul", "ol", "dl", "dt", "dd", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "td", "th", "table", "section", "article", "header", "footer", "nav", "main", "aside", "blockquote")
    + ("pre", "hr", "figure", "form", "body", "head", "html")
)
_NAME = re.compile(r"[a-z][a-z0-9:-]*", re.I)
_MARK = re.compile(r">|=\s*+([\"'])")
_CLOSE = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in HIDDEN}
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])([^\s=\"'<>/]++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))")


@dataclass
class Page:
    text: str
    title: str | None
    language: str | None
    links: list[str]


def read_page(page: str) -> Page:
    """Text, title, language and links of a page."""
    out, links = [], []
    title = language = None
    unclosed: set[str] = set()  # quotes that don't occur any more
    at, n = 0, len(page)
    while at < n:
        begin = page.find("<", at)
        if begin < 0:
            out.append(page[at:])
            break
        out.append(page[at:begin])
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = n if end < 0 else end + 3
            continue
        closing = page.startswith("/", begin + 1)
        name = _NAME.match(page, begin + 1 + closing)
        if name is None and not closing and not page.startswith(("!", "?"), begin + 1):
            out.append("<")  # no tag
            at = begin + 1
            continue
        at = name.end() if name else begin + 2
        while True:
            mark = _MARK.search(page, at)
            if mark is None:
                at = end = n
                break
            at, quote = mark.end(), mark[1]
            if quote is None:
                end = at - 1
                break
            if quote not in unclosed:
                close = page.find(quote, at)
                if close < 0:
                    unclosed.add(quote)
                else:
                    at = close + 1
        if name is None:
            continue
        tag = name[0].lower()
        if tag in BLOCKS:
            out.append("\n")
        if closing:
            continue
        if tag == "a" or (tag == "html" and language is None):
            for key, *values in _ATTRIBUTE.findall(page, name.end(), end):
                value = html.unescape("".join(values))
                if tag == "a" and key.lower() == "href":
                    links.append(value)
                    break
                if tag == "html" and key.lower() == "lang" and value:
                    language = value
                    break
        if tag in HIDDEN:
            close = _CLOSE[tag].search(page, at)
            inner, at = page[at : close.start() if close else n], close.start() if close else n
            if tag == "title" and title is None and close:
                title = " ".join(html.unescape(inner).split())
    lines = (" ".join(line.split()) for line in html.unescape("".join(out)).split("\n"))
    return Page("\n".join(line for line in lines if line), title, language, links)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record's bytes; Content-Length and the block digest are added."""
    fields = [*fields, ("WARC-Block-Digest", digest(block)), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {clean(v)}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def clean(value: str) -> str:
    """A header's value on one line."""
    return re.sub(r"[\r\n]+", " ", value)


class Fields(list):
    """Header fields in their order, as (name, value); a name may repeat."""

    @classmethod
    def of(cls, head: bytes) -> Fields:
        """Of a record's lines up to the empty one."""
        lines = head.decode(errors="replace").rstrip("\r\n").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record")
        fields = cls()
        for line in lines[1:]:
            if line[:1] in (" ", "\t") and fields:  # goes on with the line before
                fields[-1] = (fields[-1][0], f"{fields[-1][1]} {line.strip()}")
            else:
                name, _, value = line.partition(":")
                fields.append((name.strip(), value.strip()))
        return fields

    def get(self, name: str) -> str | None:
        """The first value of a name."""
        return next((v for k, v in self if k.lower() == name.lower()), None)

    def length(self) -> int:
        return int(self.get("Content-Length") or 0)


def parse(data: bytes, at: int = 0) -> tuple[Fields, bytes, int]:
    """Fields, block and end of the record at a place."""
    end = data.index(b"\r\n\r\n", at)
    fields = Fields.of(data[at:end])
    start, size = end + 4, fields.length()
    return fields, data[start : start + size], start + size + 4


def response(page_id: int | None, url: str | None, page: str | None) -> bytes:
    """A page's response record."""
    payload = (page or "").encode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    target = [("WARC-Target-URI", url)] if url else []
    paid = digest(payload)
    return record([("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", str(page_id), url or "", paid)), *target, ("WARC-Date", DATE), ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", paid)], head + payload)


def derive(source: bytes) -> list[bytes]:
    """The metadata and the conversion record of a response record."""
    fields, block, _ = parse(source)
    head, _, payload = block.partition(b"\r\n\r\n")
    page = payload.decode(errors="replace")
    own, uri = fields.get("WARC-Record-ID") or "", fields.get("WARC-Target-URI")
    found = read_page(page)
    linked = [("WARC-Refers-To", own), *((f"WARC-Refers-To-{k}", v) for k in ("Target-URI", "Date") if (v := fields.get(f"WARC-{k}")) is not None)]
    target = [("WARC-Target-URI", uri)] if uri is not None else []
    notes = [("source-block-digest", fields.get("WARC-Block-Digest") or ""), ("source-payload-digest", fields.get("WARC-Payload-Digest") or "")]
    notes += [("http-status", head.split(b"\r\n")[0].decode(errors="replace"))] + [("http-header", x.decode(errors="replace")) for x in head.split(b"\r\n")[1:]]
    if found.title is not None:
        notes.append(("title", found.title))
    if found.language is not None:
        notes.append(("language", found.language))
    notes += [("outlink", f"{x} L a/@href") for x in found.links]
    body = "".join(f"{k}: {clean(v)}\r\n" for k, v in notes).encode()
    text = found.text.encode()
    return [
        record([("WARC-Type", "metadata"), ("WARC-Record-ID", record_id("metadata", own)), *target, ("WARC-Date", DATE), *linked, ("Content-Type", "application/warc-fields")], body),
        record([("WARC-Type", "conversion"), ("WARC-Record-ID", record_id("conversion", own)), *target, ("WARC-Date", DATE), *linked, ("Content-Type", "text/plain; charset=utf-8"), ("WARC-Payload-Digest", digest(text))], text),
    ]


_COLUMNS = [("page_id", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()), ("content_type", pa.string()), ("content_length", pa.int64()), ("block_digest", pa.string()), ("payload_digest", pa.string()), ("content", pa.string()), ("record", pa.binary())]
SCHEMA = "page_id long, record_type string, record_id string, refers_to string, target_uri string, content_type string, content_length long, block_digest string, payload_digest string, content string, record binary"


def row(page_id: int | None, data: bytes) -> tuple:
    f, block, _ = parse(data)
    content = None if f.get("WARC-Type") == "response" else block.decode(errors="replace")
    return page_id, f.get("WARC-Type"), f.get("WARC-Record-ID"), f.get("WARC-Refers-To"), f.get("WARC-Target-URI"), f.get("Content-Type"), len(block), f.get("WARC-Block-Digest"), f.get("WARC-Payload-Digest"), content, data


def rows(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) if found else [()] * len(_COLUMNS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _COLUMNS, strict=True)], [n for n, _ in _COLUMNS])


def build(pages: DataFrame) -> DataFrame:
    """The response records of pages (page_id, url, html) and their derivatives; one map, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            found = []
            for page_id, url, page in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                source = response(page_id, url, page)
                found += [row(page_id, x) for x in (source, *derive(source))]
            yield rows(found)

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, SCHEMA)


def write_warc(records: DataFrame, path: str) -> None:
    """Writes records to .warc.gz files (a gzip member each) below path, a file per task."""
    from kinsift.llm.token_store import place

    system, folder = place(path)
    system.create_dir(folder, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = place(path)
        name = f"{uuid.uuid4().hex}.warc.gz"
        n = 0
        with system.open_output_stream(f"{folder}/{name}", compression=None) as out:
            for batch in batches:
                for x in batch.column(0):
                    out.write(gzip.compress(x.as_py(), mtime=0))
                    n += 1
        yield pa.RecordBatch.from_pydict({"file": [name], "n": [n]}, pa.schema([("file", pa.string()), ("n", pa.int64())]))

    files = records.select("record").mapInArrow(run, "file string, n long").collect()
    with system.open_output_stream(f"{folder}/files.txt", compression=None) as out:  # what succeeded
        out.write("\n".join(sorted(f.file for f in files if f.n)).encode())


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of a folder that write_warc has written (page_id: null)."""
    from kinsift.llm.token_store import place

    system, folder = place(path)
    with system.open_input_stream(f"{folder}/files.txt", compression=None) as f:
        names = [x for x in f.read().decode().split("\n") if x]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = place(path)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_input_stream(f"{folder}/{name}", compression=None) as f, gzip.open(f) as unpacked:
                    found, size = [], 0
                    while head := read_head(unpacked):
                        data = head + unpacked.read(Fields.of(head).length() + 4)
                        found.append(row(None, data))
                        size += len(data)
                        if size > 4 << 20:
                            yield rows(found)
                            found, size = [], 0
                    yield rows(found)

    return spark.createDataFrame([(n,) for n in names], "file string").repartition(max(1, len(names))).mapInArrow(run, SCHEMA)


def read_head(file) -> bytes:
    """A record's header lines with the empty line after them, or nothing at the end."""
    lines = []
    while line := file.readline():
        lines.append(line)
        if line == b"\r\n":
            break
    return b"".join(lines)


def op9_warc_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of all pages, without their bytes."""
    return build(spark.read.parquet(f"{sf_dir}/pages.parquet")).drop("record")
