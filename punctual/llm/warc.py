"""WARC derivatives: metadata and plain-text conversion records of response records.

A response record holds an HTTP message. From each come a metadata record (the
source's headers and digests, as ``application/warc-fields``) and a conversion
record (the page's text), both naming the response in ``WARC-Refers-To``.
Record identifiers are name-based, so reruns give the same ones.

``read`` takes the records of WARC files, ``derived`` their derivatives. Pages
without a WARC file (a url and its html) become response records first, and
those come out beside what refers to them.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm.common import bounded_batches, chunks

#: Name space of the record identifiers.
SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:punctual:warc")
#: The date of records whose source gives none.
EPOCH = "1970-01-01T00:00:00Z"
#: What hides text up to its end: comments and elements without text of their own.
_HIDING = re.compile(rb"<(?:!--|(script|style|noscript|template|svg)\b)", re.I)
_BREAK = re.compile(rb"</?(?:p|div|br|li|ul|ol|tr|table|h[1-6]|section|article|header|footer|nav|main|aside|blockquote|pre|title|head|body|form|option|dd|dt|dl|hr)\b[^>]*>", re.I)
_TAG = re.compile(rb"<[/!?a-zA-Z][^>]*>")


@dataclass
class Record:
    headers: list[tuple[str, str]]
    block: bytes = b""
    extra: dict = field(default_factory=dict, compare=False)

    def get(self, name: str) -> str | None:
        return next((v for k, v in self.headers if k.lower() == name.lower()), None)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def identifier(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, chr(31).join(map(str, parts)))}>"


def one_line(value: str) -> str:
    """A header's value: control characters would end or split it."""
    return re.sub(r"[\x00-\x1f\x7f]+", " ", value).strip()


def response(uri: str | None, body: bytes, key: object, date: str = EPOCH, headers: list[tuple[str, str]] | None = None) -> Record:
    """A response record around a page."""
    http = [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(body)))] if headers is None else headers
    block = b"HTTP/1.1 200 OK\r\n" + b"".join(f"{k}: {one_line(v)}\r\n".encode() for k, v in http) + b"\r\n" + body
    return Record([("WARC-Type", "response"), ("WARC-Record-ID", identifier("response", key, uri)), *([("WARC-Target-URI", one_line(uri))] if uri else []), ("WARC-Date", date), ("WARC-Payload-Digest", digest(body)), ("WARC-Block-Digest", digest(block)), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))], block)


def http_of(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and body; a block without a head is all body."""
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"HTTP/"):
        return "", [], block
    first, *rest = head.split(b"\r\n")
    pairs = [line.split(b":", 1) for line in rest if b":" in line]
    return first.decode("latin-1"), [(k.decode("latin-1").strip(), v.decode("latin-1").strip()) for k, v in pairs], body


def _shown(page: bytes) -> bytes:
    """The page without comments and hidden elements; one that nothing closes hides the rest. Linear in the page."""
    lower, out, at = page.lower(), [], 0
    while found := _HIDING.search(page, at):
        out.append(page[at : found.start()])
        name = found[1]
        if name is None:
            end = lower.find(b"-->", found.end())
            at = end + 3 if end >= 0 else len(page)
            continue
        mark, at = b"</" + name.lower(), found.end()
        while (at := lower.find(mark, at)) >= 0:
            at += len(mark)
            if lower[at : at + 1] in (b"", b">", b"/", b" ", b"\t", b"\n", b"\r", b"\f"):
                end = lower.find(b">", at)
                at = end + 1 if end >= 0 else len(page)
                break
        else:
            at = len(page)
    return b" ".join([*out, page[at:]])


def plain_text(page: bytes) -> str:
    """The page's text: no scripts, styles and comments; a line for each block, blanks run together."""
    shown = _shown(page)
    tagged, rest = shown[: shown.rfind(b">") + 1], shown[shown.rfind(b">") + 1 :]  # behind the last bracket no tag ends
    text = html.unescape((_TAG.sub(b"", _BREAK.sub(b"\n", tagged)) + rest).decode("utf-8", "replace"))
    lines = (" ".join(line.split()) for line in text.split("\n"))
    return "\n".join(line for line in lines if line)


def derive(source: Record) -> tuple[Record, Record]:
    """The metadata and the conversion record of a response."""
    target, of = source.get("WARC-Record-ID") or "", [(n, source.get(n)) for n in ("WARC-Target-URI", "WARC-Date")]
    kept = [(k, v) for k, v in of if v is not None]
    status, http, body = http_of(source.block)
    text = plain_text(body).encode()
    fields = [("status", status), *((f"http-{k.lower()}", v) for k, v in http), ("source-content-type", source.get("Content-Type") or ""), ("source-payload-digest", source.get("WARC-Payload-Digest") or digest(body)), ("source-block-digest", source.get("WARC-Block-Digest") or digest(source.block)), ("text-digest", digest(text)), ("text-length", str(len(text)))]
    block = b"".join(f"{k}: {one_line(v)}\r\n".encode() for k, v in fields)
    out = []
    for kind, content, media in (("metadata", block, "application/warc-fields"), ("conversion", text, "text/plain; charset=utf-8")):
        out.append(Record([("WARC-Type", kind), ("WARC-Record-ID", identifier(kind, target)), ("WARC-Refers-To", target), *kept, ("WARC-Block-Digest", digest(content)), ("Content-Type", media), ("Content-Length", str(len(content)))], content))
    return out[0], out[1]


def dumps(records: list[Record], compress: bool = True) -> bytes:
    """WARC 1.1 bytes, a gzip member for each record."""
    out = []
    for r in records:
        raw = b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in r.headers) + b"\r\n" + r.block + b"\r\n\r\n"
        out.append(gzip.compress(raw, 6, mtime=0) if compress else raw)
    return b"".join(out)


def loads(data: bytes) -> list[Record]:
    """The records of WARC bytes, compressed or not; a broken end raises ValueError."""
    data, out, at = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data, [], 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        lines = data[at:end].decode("utf-8").split("\r\n")[1:]
        headers = [tuple(x.strip() for x in line.split(":", 1)) for line in lines]
        size = int(dict((k.lower(), v) for k, v in headers)["content-length"])
        block = data[end + 4 : end + 4 + size]
        if len(block) < size or data[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is cut off")
        out.append(Record(headers, block))
        at = end + 8 + size
    return out


def _members(data: Iterator[bytes]) -> Iterator[Record]:
    """The records of a stream of WARC bytes, compressed or not, holding one record at a time."""
    held, unzip, zipped = bytearray(), None, None
    for piece in data:
        if zipped is None:
            zipped = piece[:2] == b"\x1f\x8b"
        while piece:
            if not zipped:
                held += piece
                piece = b""
            else:
                unzip = unzip or zlib.decompressobj(31)
                held += unzip.decompress(piece)
                piece = unzip.unused_data
                unzip = None if unzip.eof else unzip
            yield from _whole(held)
    if held.strip():
        raise ValueError("the last record is cut off")


def _whole(held: bytearray) -> Iterator[Record]:
    """Take the records off the front that are there whole."""
    while (end := held.find(b"\r\n\r\n")) >= 0:
        if not held.startswith(b"WARC/"):
            raise ValueError("no record where one should start")
        headers = [tuple(x.strip() for x in line.split(":", 1)) for line in held[:end].decode("utf-8").split("\r\n")[1:]]
        size = int(dict((k.lower(), v) for k, v in headers)["content-length"])
        if len(held) < end + 8 + size:
            return
        block = bytes(held[end + 4 : end + 4 + size])
        if held[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError("a record is longer than it says")
        del held[: end + 8 + size]
        yield Record(headers, block)


RECORDS = "file string, headers array<struct<name:string,value:string>>, block binary"


def read(spark: SparkSession, path: str, pattern: str = "*.warc*") -> DataFrame:
    """(file, headers, block): the records of the WARC files below ``path``, plain or in gzip members; a broken end raises ValueError.

    A file is one row of the binary source, so it may have 2 GB at most; its
    records are unpacked one by one.
    """
    kind = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                view = data.as_buffer()
                pieces = (view.slice(a, min(1 << 20, view.size - a)).to_pybytes() for a in range(0, view.size, 1 << 20))
                for r in _members(pieces):
                    heads = [{"name": k, "value": v} for k, v in r.headers]
                    yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([heads], kind), pa.array([r.block], pa.binary())], names=["file", "headers", "block"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(unpacked, RECORDS)


_NAMES = ["warc_type", "record_id", "refers_to", "target_uri", "block_digest", "payload_digest", "source_block_digest", "content_type", "content_length", "block"]
_FIELDS = "warc_type string, record_id string, refers_to string, target_uri string, block_digest string, payload_digest string, source_block_digest string, content_type string, content_length long, block string"
SHAPE = f"page_id long, {_FIELDS}"


def _row(r: Record, source: Record) -> tuple:
    payload = source.get("WARC-Payload-Digest") or digest(http_of(source.block)[2])
    return r.get("WARC-Type"), r.get("WARC-Record-ID"), r.get("WARC-Refers-To"), r.get("WARC-Target-URI"), r.get("WARC-Block-Digest") or digest(r.block), payload, source.get("WARC-Block-Digest") or digest(source.block), r.get("Content-Type"), len(r.block), r.block.decode("utf-8", "replace")


def _table(rows: list[tuple], first: str, kind: pa.DataType) -> pa.RecordBatch:
    kinds = [kind, *(pa.int64() if n == "content_length" else pa.string() for n in _NAMES)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[first, *_NAMES])


def _of_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "html", 2 << 20):
        rows = []
        for page, uri, body in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            source = response(uri, (body or "").encode(), page)
            rows += [(page, *_row(r, source)) for r in (source, *derive(source))]
        yield _table(rows, "page_id", pa.int64())


def _of_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, heads, block in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            source = Record([(h["name"], h["value"]) for h in heads or []], block or b"")
            if (source.get("WARC-Type") or "").lower() == "response":
                yield _table([(file, *_row(r, source)) for r in derive(source)], "file", pa.string())


def derived(records: DataFrame) -> DataFrame:
    """Two rows, metadata and conversion, for each response among ``records`` (file, headers, block), as ``read`` gives them.

    Records of other kinds give nothing. Where the source names no digest, its
    block's is computed. Other columns are ignored.
    """
    return records.select("file", "headers", "block").mapInArrow(_of_records, f"file string, {_FIELDS}")


def derivatives(pages: DataFrame) -> DataFrame:
    """Three rows for each row of ``pages`` (page_id, url, html): the response record, and the metadata and conversion that refer to it.

    Pages carry no date and no HTTP headers: the records' date is 1970 and the
    message has the headers that the page implies. A null page is an empty one; a
    null url leaves out the target. Repeated rows give repeated records with the
    same identifiers. Other columns are ignored.
    """
    bounded_batches(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(_of_pages, SHAPE)


def write(pages: DataFrame, path: str) -> None:
    """(page_id, warc): for each page the bytes of its three records, gzip members, as Parquet; ``loads`` reads them."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "html", 2 << 20):
            out = []
            for page, uri, body in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                source = response(uri, (body or "").encode(), page)
                out.append(dumps([source, *derive(source)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["page_id", "warc"])

    pages.select("page_id", "url", "html").mapInArrow(members, "page_id long, warc binary").write.parquet(path)
