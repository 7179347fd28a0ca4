"""WARC derivatives: metadata and plain-text conversion records made from response records."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.tasks import Batches, map_batches

VERSION = "WARC/1.0"
# Record ids are drawn from these names, so a repeated task makes the same records.
SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:lakeloom:warc")
DATE = "1970-01-01T00:00:00Z"

Headers = list[tuple[str, str]]

_CHARSET = re.compile(rb"charset=[\"']?([A-Za-z0-9_.:-]+)", re.I)
_HIDDEN = frozenset("script style noscript template head".split())
_BREAKS = frozenset("p div section article main header footer nav aside h1 h2 h3 h4 h5 h6 ul ol li table tr td th br hr pre blockquote".split())


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*names: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, ' '.join(names))}>"


def one_line(value: str) -> str:
    return " ".join(value.split())


def record(headers: Headers, block: bytes) -> bytes:
    """A record in the file format: version, header lines, empty line, block, two line ends."""
    lines = [VERSION, *[f"{k}: {one_line(v)}" for k, v in headers], f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "replace") + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[Headers, bytes]:
    """Headers and block of one record; a gzip member is opened first. Raises ValueError if it is none."""
    if raw[:2] == b"\x1f\x8b":
        raw = gzip.decompress(raw)
    head, found, rest = raw.partition(b"\r\n\r\n")
    first, _, lines = head.decode("utf-8", "replace").partition("\r\n")
    if not found or not first.startswith("WARC/"):
        raise ValueError("no WARC record")
    headers = fields(lines)
    length = get(headers, "Content-Length")
    if length is None or not length.isdigit() or len(rest) < int(length):
        raise ValueError("a record without its whole block")
    return headers, rest[: int(length)]


def fields(lines: str) -> Headers:
    """Name and value of header lines; a line that starts with white space continues the one before."""
    found: Headers = []
    for line in lines.split("\r\n"):
        if line[:1] in (" ", "\t") and found:
            found[-1] = (found[-1][0], f"{found[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            found.append((name.strip(), value.strip()))
    return found


def get(headers: Headers, name: str) -> str | None:
    return next((v for k, v in headers if k.lower() == name.lower()), None)


def payload(block: bytes) -> tuple[str, Headers, bytes]:
    """Status line, HTTP headers and body of a response; chunks are joined and compression is undone."""
    head, _, body = block.partition(b"\r\n\r\n")
    status, _, lines = head.decode("iso-8859-1").partition("\r\n")
    headers = fields(lines)
    if "chunked" in (get(headers, "Transfer-Encoding") or "").lower():
        joined, rest = [], body
        while rest:
            size, _, rest = rest.partition(b"\r\n")
            try:
                n = int(size.split(b";")[0], 16)
            except ValueError:
                break
            if not n:
                break
            joined.append(rest[:n])
            rest = rest[n + 2 :]
        body = b"".join(joined)
    packed = (get(headers, "Content-Encoding") or "").lower()
    try:
        if packed == "gzip":
            body = gzip.decompress(body)
        elif packed == "deflate":
            body = zlib.decompress(body)
    except (OSError, EOFError, zlib.error):
        pass  # kept as it came: the record stays, its text is what the bytes give
    return status, headers, body


class _Plain(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.hidden, self.lines, self.title, self.in_title = 0, [""], "", False

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in _HIDDEN and tag != "head"
        self.in_title = tag == "title"
        if tag in _BREAKS:
            self.lines.append("")

    def handle_endtag(self, tag):
        self.hidden = max(0, self.hidden - (tag in _HIDDEN and tag != "head"))
        if tag == "title":
            self.in_title = False
        if tag in _BREAKS:
            self.lines.append("")

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        elif not self.hidden:
            self.lines[-1] += data


def plain_text(headers: Headers, body: bytes) -> tuple[str, str]:
    """Title and text of a body: visible text of HTML, one line per block; other text as it is; else empty."""
    kind = (get(headers, "Content-Type") or "text/html").lower()
    named = _CHARSET.search(kind.encode()) or _CHARSET.search(body[:2048])
    try:
        text = body.decode(named[1].decode() if named else "utf-8", "replace")
    except LookupError:
        text = body.decode("utf-8", "replace")
    if "html" not in kind:
        return "", text if kind.startswith("text/") else ""
    reader = _Plain()
    reader.feed(text)
    reader.close()
    lines = [one_line(x) for x in reader.lines]
    return one_line(reader.title), "\n".join(x for x in lines if x)


def derive(raw: bytes) -> list[dict]:
    """The metadata and the conversion record of a response record; records of other types give none.

    Both refer to the response by its id and carry its target, date and payload digest; the metadata block holds
    the response's status line, its HTTP headers in their order, and both its digests. A digest that does not fit
    its bytes is passed on as found, and ``digest-verified`` in the metadata says so.
    """
    headers, block = parse(raw)
    if get(headers, "WARC-Type") != "response":
        return []
    source = get(headers, "WARC-Record-ID") or record_id("response", digest(block))
    status, http, body = payload(block)
    plain = block.partition(b"\r\n\r\n")[2]
    stated = get(headers, "WARC-Payload-Digest")
    paid = stated or digest(plain)
    fits = stated is None or not stated.startswith("sha1:") or stated == digest(plain)
    stated_block = get(headers, "WARC-Block-Digest")
    fits = fits and (stated_block is None or not stated_block.startswith("sha1:") or stated_block == digest(block))
    title, text = plain_text(http, body)
    target, date = get(headers, "WARC-Target-URI") or "", get(headers, "WARC-Date") or DATE
    about = [
        ("status", status), *[(f"http-{k.lower()}", v) for k, v in http], ("title", title),
        ("source-payload-digest", paid), ("source-block-digest", stated_block or digest(block)),
        ("digest-verified", "yes" if fits else "no"), ("text-length", str(len(text))),
    ]
    meta = "".join(f"{k}: {one_line(v)}\r\n" for k, v in about).encode("utf-8", "replace")
    made = []
    for kind, mime, content in (("metadata", "application/warc-fields", meta), ("conversion", "text/plain", text.encode("utf-8", "replace"))):
        name = record_id(kind, source, target)
        lines = [
            ("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Refers-To", source),
            ("WARC-Source-Payload-Digest", paid), ("WARC-Block-Digest", digest(content)), ("Content-Type", mime),
        ]
        other = record_id("conversion" if kind == "metadata" else "metadata", source, target)
        lines.insert(5, ("WARC-Concurrent-To", other))
        made.append(
            {"type": kind, "record_id": name, "refers_to": source, "target_uri": target, "date": date, "payload_digest": paid,
             "block_digest": digest(content), "content_length": len(content), "record": record(lines, content)}
        )
    return made


def response(key: str, url: str, html: str) -> bytes:
    """A response record around a stored page, as a crawler would have written it."""
    body = html.encode("utf-8", "surrogatepass")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    block = head + body
    named = [
        ("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", key, url, digest(body))), ("WARC-Date", DATE),
        ("WARC-Target-URI", url), ("WARC-Payload-Digest", digest(body)), ("WARC-Block-Digest", digest(block)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return record(named, block)


FIELDS = "type string, record_id string, refers_to string, target_uri string, date string, payload_digest string, block_digest string, content_length bigint, record binary"


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, warc): one response record per page. Null url and html count as empty; a null key is named apart from every text."""
    rows = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
    kind = rows.schema["key"].dataType.simpleString()

    def work(batches: Batches) -> Batches:
        for batch in batches:
            made = [response("\0" if k is None else str(k), u or "", h or "") for k, u, h in zip(*[c.to_pylist() for c in batch.columns])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["key", "warc"])

    return map_batches(rows, work, f"key {kind}, warc binary", 500)


def derivatives(records: DataFrame, key: str = "key", warc: str = "warc") -> DataFrame:
    """Two derived records per response: the key, the fields of the record, and the record's bytes.

    Bytes that are no WARC record, and null ones, give one row of type ``error`` with nothing else; records that are
    no responses give no row. Repeated records are derived as often as they come and get equal ids, as equal records
    do. The ``record`` bytes in any order make a valid file.
    """
    rows = records.select(F.col(f"`{key}`").alias("key"), F.col(f"`{warc}`").alias("warc"))
    kind = rows.schema["key"].dataType.simpleString()

    def work(batches: Batches) -> Batches:
        for batch in batches:
            out = []
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    out += [{"key": k, **made} for made in derive(raw or b"")]
                except (ValueError, OSError, EOFError, zlib.error):
                    out.append({"key": k, "type": "error"})
            names = ["key", *[f.split()[0] for f in FIELDS.split(", ")]]
            kinds = [batch.schema[0].type] + [{"bigint": pa.int64(), "binary": pa.binary()}.get(f.split()[1], pa.string()) for f in FIELDS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in out], t) for n, t in zip(names, kinds)], names)

    return map_batches(rows, work, f"key {kind}, {FIELDS}", 500)
