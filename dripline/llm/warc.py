"""WARC derivatives: metadata and plain-text conversion records from response records.

Each response gives one metadata and one conversion record. Both refer to the response by its
record id and keep its target address and date; the metadata block keeps the source's HTTP
headers and digests, the title and the links out. Ids follow from the source's id, so a task
that runs again writes the same records. Records are serialised as gzip members, which may be
joined to files in any number, and parsed back.
"""

from __future__ import annotations

import base64
import codecs
import gzip
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dripline.llm.common import map_rows, rows

DATE = "2024-01-01T00:00:00Z"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
# Elements whose text is not shown, and those that end a line.
HIDDEN = {"script", "style", "noscript", "template"}
BREAKS = set("p div br li ul ol tr table h1 h2 h3 h4 h5 h6 article section nav header footer title blockquote pre hr head body".split())
_NAME = re.compile("/?([a-z][a-z0-9]*)")
_HREF = re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
#: Codecs that are no charsets of pages.
NO_CHARSET = {"idna", "punycode", "undefined", "unicode_escape", "raw_unicode_escape", "mbcs", "oem"}
_CHARSET = re.compile(rb"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, ' '.join(parts))}>"


def _line(value: str) -> str:
    """A header value may not break its line."""
    return re.sub(r"[\r\n]+", " ", value) if "\n" in value or "\r" in value else value


def _lower(text: str) -> str:
    """A-Z in lower case; all else, and so every place, stays. Bytes do that far faster than a mapping."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC/1.1 record; type, length and block digest are added to the headers."""
    named = [("WARC-Type", kind), *headers, ("WARC-Block-Digest", digest(block)), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {_line(v)}\r\n" for k, v in named)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 1) -> bytes:
    return gzip.compress(data, level, mtime=0)


def opened(raw: bytes | None) -> bytes:
    """The content of gzip members; a corrupt or cut member, and what follows it, gives nothing."""
    out = []
    while raw:
        one = zlib.decompressobj(31)
        try:
            out.append(one.decompress(raw))
        except zlib.error:
            break
        if not one.eof:
            out.pop()
            break
        raw = one.unused_data
    return b"".join(out)


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of a decompressed stream.

    A record whose length is no number is passed over, and the last block may be cut short.
    """
    at = 0
    while (start := data.find(b"WARC/1.", at)) >= 0:
        end = data.find(b"\r\n\r\n", start)
        if end < 0:
            return
        lines = data[start:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        length = headers.get("content-length", "0")
        if not (length.isascii() and length.isdigit()):
            at = end + 4
            continue
        size = int(length)
        yield headers, data[end + 4 : end + 4 + size]
        at = end + 4 + size


def http_parts(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload of an HTTP response; without a header all is payload."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    head, found, body = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")
    pairs = [(k.strip(), v.strip()) for k, c, v in (x.partition(":") for x in lines[1:]) if c]
    return lines[0], pairs, body if found else b""


def payload(http: list[tuple[str, str]], body: bytes) -> bytes:
    """The body without its transfer and content codings; what can't be undone stays as it is."""
    named = {k.lower(): v.lower() for k, v in http}
    if "chunked" in named.get("transfer-encoding", ""):
        body = _dechunked(body)
    for coding in reversed([c.strip() for c in named.get("content-encoding", "").split(",")]):
        if coding in ("gzip", "x-gzip", "deflate"):
            for bits in (47, -15):  # with a zlib or gzip header, or bare
                try:
                    body = zlib.decompressobj(bits).decompress(body)
                    break
                except zlib.error:
                    pass
    return body


def _dechunked(body: bytes) -> bytes:
    out, at = [], 0
    while (end := body.find(b"\r\n", at, at + 1000)) >= 0:
        size = body[at:end].split(b";")[0].strip()
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size):
            return body if not out else b"".join(out)
        if not int(size, 16):
            break
        out.append(body[end + 2 : end + 2 + int(size, 16)])
        at = end + 4 + int(size, 16)
    return b"".join(out) if out else body


def decoded(body: bytes, kind: str) -> tuple[str, str]:
    """The payload as text, and its charset: of the header, of the page's start, else UTF-8."""
    m = _CHARSET.search(kind.encode()) or _CHARSET.search(body[:2048])
    name = m[1].decode().lower() if m else "utf-8"
    try:
        known = codecs.lookup(name)
        if known._is_text_encoding and known.name.replace("-", "_") not in NO_CHARSET:
            return body.decode(name, "replace"), name
    except (LookupError, UnicodeError, ValueError):
        pass
    return body.decode("utf-8", "replace"), "utf-8"


def scanned(page: str) -> tuple[str, str, list[str]]:
    """Shown text with entities, title and links of a page, in one pass from tag to tag.

    A tag ends at the next ``>``; without one, the rest is text. Comments and hidden elements that
    don't end hide the rest.
    """
    low, end = _lower(page), len(page)
    out, links, title, at = [], [], None, 0
    while (i := page.find("<", at)) >= 0:
        if page.startswith("<!--", i):
            out += [page[at:i], " "]
            j = page.find("-->", i + 4)
            at = end if j < 0 else j + 3
            continue
        c = low[i + 1 : i + 2]
        if not ("a" <= c <= "z" or c and c in "/!?"):
            out.append(page[at : i + 1])
            at = i + 1
            continue
        if (j := page.find(">", i + 1)) < 0:
            break
        out.append(page[at:i])
        at, m = j + 1, _NAME.match(low, i + 1)
        name, opens = m[1] if m else "", c != "/"
        if name in BREAKS:
            out.append("\n")
        if opens and name in HIDDEN:
            out.append(" ")
            close = low.find(f"</{name}", at)
            close = -1 if close < 0 else page.find(">", close)
            at = end if close < 0 else close + 1
        elif opens and name == "a":
            if m := _HREF.search(page, i, j + 1):
                links.append(m[1] or m[2] or m[3] or "")
        elif opens and name == "title" and title is None:
            close = low.find("</title", at)
            title = page[at:close] if close >= 0 else ""
    return "".join([*out, page[at:]]), title or "", links


def _lines(shown: str) -> str:
    lines = (" ".join(x.split()) for x in html.unescape(shown).split("\n"))
    return "\n".join(x for x in lines if x)


def plain_text(page: str) -> str:
    """Shown text of a page, one line for each block, without blank lines."""
    return _lines(scanned(page)[0])


def derivatives(headers: dict[str, str], block: bytes) -> list[tuple[str, bytes]]:
    """The metadata and the conversion record of one response."""
    source, uri, date = (headers.get(k, "") for k in ("warc-record-id", "warc-target-uri", "warc-date"))
    status, http, body = http_parts(block)
    kind = next((v for k, v in http if k.lower() == "content-type"), "")
    page, charset = decoded(payload(http, body), kind)
    shown, title, links = scanned(page)
    own = headers.get("warc-payload-digest") or digest(body)
    fields = [("source-block-digest", headers.get("warc-block-digest") or digest(block)), ("source-payload-digest", own)]
    fields += [("http-status", status)] if status else []
    fields += [(f"http-header-{k.lower()}", v) for k, v in http]
    fields += [("charset", charset), ("title", " ".join(html.unescape(title).split()))]
    fields += [("outlink", html.unescape(link)) for link in links]
    note = "".join(f"{k}: {_line(v)}\r\n" for k, v in fields).encode("utf-8", "replace")
    shared = [("WARC-Refers-To", source), ("WARC-Target-URI", uri), ("WARC-Date", date)]
    refers = [("WARC-Refers-To-Payload-Digest", own)]
    first, second = record_id(source, "metadata"), record_id(source, "conversion")
    return [
        ("metadata", record("metadata", [("WARC-Record-ID", first), *shared, *refers, ("WARC-Concurrent-To", second), ("Content-Type", "application/warc-fields")], note)),
        ("conversion", record("conversion", [("WARC-Record-ID", second), *shared, *refers, ("WARC-Concurrent-To", first), ("Content-Type", "text/plain; charset=utf-8")], _lines(shown).encode("utf-8", "replace"))),
    ]


def response_members(pages: DataFrame) -> DataFrame:
    """``page_id, member``: a gzip response record for each row of ``page_id, url, html``.

    A null page is an empty payload, a null address an empty one.
    """

    def make():
        def step(batch):
            out = []
            for page, url, text in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                body, url = (text or "").encode(), url or ""
                block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body
                named = [("WARC-Record-ID", record_id(str(page), url)), ("WARC-Target-URI", url), ("WARC-Date", DATE)]
                named += [("WARC-Payload-Digest", digest(body)), ("Content-Type", "application/http; msgtype=response")]
                out.append(member(record("response", named, block)))
            yield rows(page_id=batch.column("page_id").cast(pa.int64()), member=pa.array(out, pa.binary()))

        return step

    return map_rows(pages.select("page_id", "url", "html"), make, "page_id long, member binary")


def derived(responses: DataFrame) -> DataFrame:
    """``page_id, kind, member`` from gzip records in ``page_id, member``; only responses give any."""

    def make():
        def step(batch):
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                ids, kinds, out = [], [], []
                for page, raw in zip(*(part.column(c).to_pylist() for c in ("page_id", "member"))):
                    for headers, block in parsed(opened(raw)):
                        if headers.get("warc-type") == "response":
                            for kind, data in derivatives(headers, block):
                                ids.append(page)
                                kinds.append(kind)
                                out.append(member(data))
                yield rows(page_id=pa.array(ids, pa.int64()), kind=pa.array(kinds, pa.string()), member=pa.array(out, pa.binary()))

        return step

    return map_rows(responses.select("page_id", "member"), make, "page_id long, kind string, member binary")


def read_records(members: DataFrame) -> DataFrame:
    """Headers and block of the records in ``page_id, member``."""

    def make():
        def step(batch):
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                found = [
                    (page, h, b)
                    for page, raw in zip(*(part.column(c).to_pylist() for c in ("page_id", "member")))
                    for h, b in parsed(opened(raw))
                ]
                text = lambda name: pa.array([h.get(name) for _, h, _ in found], pa.string())
                yield rows(
                    page_id=pa.array([p for p, _, _ in found], pa.int64()), warc_type=text("warc-type"), record_id=text("warc-record-id"),
                    refers_to=text("warc-refers-to"), target_uri=text("warc-target-uri"), warc_date=text("warc-date"),
                    content_type=text("content-type"), source_digest=text("warc-refers-to-payload-digest"), block_digest=text("warc-block-digest"),
                    digest_holds=pa.array([h.get("warc-block-digest") == digest(b) for _, h, b in found], pa.bool_()),
                    block=pa.array([b for _, _, b in found], pa.binary()),
                )

        return step

    schema = "page_id long, warc_type string, record_id string, refers_to string, target_uri string, warc_date string"
    schema += ", content_type string, source_digest string, block_digest string, digest_holds boolean, block binary"
    return map_rows(members.select("page_id", "member"), make, schema)


def write_members(members: DataFrame, folder: str) -> None:
    """Gzip members as binary rows of a table, in the order of page and record kind."""
    members.write.parquet(folder)


def read_warc_files(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, member`` from .warc or .warc.gz files; page_id is null, one row a file."""
    files = spark.read.format("binaryFile").load(path)

    def make():
        def step(batch):
            out = []
            for raw in batch.column("content").to_pylist():
                out.append(raw if raw[:2] == b"\x1f\x8b" else gzip.compress(raw, 1, mtime=0))
            yield rows(page_id=pa.nulls(len(out), pa.int64()), member=pa.array(out, pa.binary()))

        return step

    return map_rows(files.select("content"), make, "page_id long, member binary")


def page_derivatives(pages: DataFrame) -> DataFrame:
    """Both derivatives of every page, serialised as records and parsed again: headers, size and digests.

    Repeated pages give equal records. An empty table gives no rows.
    """
    read = read_records(derived(response_members(pages)))
    return read.select(
        "page_id", "warc_type", "record_id", "refers_to", "target_uri", "warc_date", "content_type", "source_digest",
        "block_digest", "digest_holds", F.length("block").cast("long").alias("n_bytes"), F.sha2("block", 256).alias("block_sha256"),
    )
