"""WARC derivatives: linked metadata and plain-text conversion records of responses."""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import json
import re
import uuid
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

VERSION = b"WARC/1.1"
RECORD = "record_id string, record_type string, refers_to string, target_uri string, date string, content_type string, headers map<string,string>, content binary"
HEADERS = pa.map_(pa.string(), pa.string())
TYPES = [pa.string()] * 6 + [HEADERS, pa.binary()]
NAMES = [part.split()[0] for part in RECORD.split(", ")]

#: Hidden parts: comments and elements whose content is never shown. The head is not among them (its end tag may be
#: left out, and then nothing would tell where it ends); of its elements only the title holds text, and it is hidden here.
HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|title)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.I | re.S)
#: Elements that begin a new line.
BLOCK = re.compile(
    r"</?(?:address|article|aside|blockquote|br|caption|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)\b[^>]*>", re.I)
TAG = re.compile(r"<(?:[a-zA-Z/!?][^>]*(?:>|\Z))")
TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.I | re.S)
META = re.compile(r"<meta\b([^>]*)>", re.I)
LINK = re.compile(r"<(a|area|link|img|script|iframe)\b([^>]*)>", re.I)
ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)
SCRIPTS = re.compile(r"<(script|style)\b([^>]*)>.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)", re.I | re.S)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def urn(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def split_http(block: bytes) -> tuple[str, dict[str, str], bytes]:
    """Status line, header fields (lower-case names, repeated ones joined by commas) and payload of an HTTP message."""
    head, gap, payload = block.partition(b"\r\n\r\n")
    if not gap and not block.startswith(b"HTTP/"):
        return "", {}, block
    status, *lines = head.decode("latin-1").split("\r\n")
    fields: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if colon:
            name, value = name.strip().lower(), value.strip()
            fields[name] = f"{fields[name]}, {value}" if name in fields else value
    return status, fields, payload


def decoded(payload: bytes, fields: dict[str, str]) -> str:
    """Text of a payload by the charset of its header, else of its markup, else UTF-8; bad bytes become U+FFFD."""
    named = CHARSET.search(fields.get("content-type", "")) or CHARSET.search(payload[:2048].decode("latin-1"))
    try:
        return payload.decode(named.group(1) if named else "utf-8", "replace")
    except (LookupError, ValueError):  # unknown codecs, and codecs such as undefined or idna that refuse bytes
        return payload.decode("utf-8", "replace")


def _line(text: str) -> str:
    return " ".join(html.unescape(TAG.sub("", text)).split())


def plain_text(page: str) -> str:
    """Visible text: one line for each block element, blanks run together, references resolved, empty lines left out."""
    body = BLOCK.sub("\n", HIDDEN.sub(" ", page).replace("\r", " ").replace("\n", " "))
    return "\n".join(line for part in body.split("\n") if (line := _line(part)))


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def description(page: str, status: str, fields: dict[str, str], uri: str, response: dict[str, str]) -> dict:
    """Content of a metadata record: the source's headers and digests, title, meta elements and links."""
    markup = SCRIPTS.sub(lambda m: f"<{m[1]}{m[2]}>" if m[1] else "", page)
    title = TITLE.search(markup)
    metas = [a for m in META.finditer(markup) if (a := _attributes(m[1]))]
    links = []
    for m in LINK.finditer(markup):
        own = _attributes(m[2])
        target = own.get("href", own.get("src"))
        if target is not None:
            try:
                target = urljoin(uri, target)
            except ValueError:
                pass
            links.append({"element": m[1].lower(), "url": target})
    return {"warc-header": response, "http-status": status, "http-headers": fields, "title": _line(title[1]) if title else None, "metas": metas, "links": links}


def _record(kind: str, record_id: str, refers_to: str | None, uri: str, date: str, content_type: str, content: bytes, more: dict[str, str]) -> tuple:
    headers = {"WARC-Type": kind, "WARC-Record-ID": record_id}
    headers |= {"WARC-Refers-To": refers_to} if refers_to else {}
    headers |= {"WARC-Target-URI": uri, "WARC-Date": date, "Content-Type": content_type, "Content-Length": str(len(content)), "WARC-Block-Digest": digest(content)} | more
    return record_id, kind, refers_to, uri, date, content_type, list(headers.items()), content


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * len(NAMES), TYPES)], NAMES)


def responses_of(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records of (page_id, url, html): HTTP header and UTF-8 payload, with their digests.

    The record id follows from page_id, url and payload. A null url is an empty target, a null html an empty payload. Repeated
    rows give repeated records.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for page_id, url, text in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                payload, uri = (text or "").encode("utf-8", "surrogatepass"), url or ""
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
                own = digest(payload)
                rows.append(_record("response", urn(f"{page_id} {uri} {own}"), None, uri, date, "application/http; msgtype=response", head + payload, {"WARC-Payload-Digest": own}))
            yield _batch(rows)

    return pages.select(F.col("page_id").cast("string"), "url", "html").mapInArrow(run, RECORD)


def derive(records: DataFrame) -> DataFrame:
    """Two records for each response: ``metadata`` (JSON) and ``conversion`` (plain text), both referring to it.

    Both keep the response's target and date and refer to its record id; the metadata holds all WARC and HTTP headers of the source,
    digests included, and the conversion repeats the source's payload digest as WARC-Source-Payload-Digest. A payload digest is computed when the
    source has none. Content-Length and WARC-Block-Digest of both are those of their own content. Records of other types give
    nothing; null ids, targets, dates, headers or contents count as empty. Repeated responses give repeated derivatives with equal ids.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                source, uri, date = row["record_id"] or "", row["target_uri"] or "", row["date"] or ""
                given = {k: v for k, v in row["headers"] or []}
                status, fields, payload = split_http(row["content"] or b"")
                page = decoded(payload, fields)
                own = given.get("WARC-Payload-Digest") or digest(payload)
                about = json.dumps(description(page, status, fields, uri, given), ensure_ascii=False, sort_keys=True).encode("utf-8", "surrogatepass")
                text = plain_text(page).encode("utf-8", "surrogatepass")
                link = {"WARC-Source-Payload-Digest": own}
                rows.append(_record("metadata", urn(source + " metadata"), source, uri, date, "application/json", about, link))
                rows.append(_record("conversion", urn(source + " conversion"), source, uri, date, "text/plain; charset=utf-8", text, link))
            yield _batch(rows)

    return records.where("record_type = 'response'").select(*NAMES).mapInArrow(run, RECORD)


def encoded(headers: dict[str, str], content: bytes) -> bytes:
    """One record as a gzip member."""
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in headers.items())
    return gzip.compress(VERSION + b"\r\n" + lines + b"\r\n" + content + b"\r\n\r\n", mtime=0)


def encode(records: DataFrame) -> DataFrame:
    """(record_id, member): records as gzip members, which put together in any order make a WARC file."""

    def run(batches):
        for batch in batches:
            members = [encoded(dict(h or []), c or b"") for h, c in zip(batch.column("headers").to_pylist(), batch.column("content").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("record_id"), pa.array(members, pa.binary())], ["record_id", "member"])

    return records.select("record_id", "headers", "content").mapInArrow(run, "record_id string, member binary")


def parsed(data: bytes):
    """Records of a WARC file or member, compressed or not."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while (begin := data.find(b"WARC/", at)) >= 0:
        end = data.find(b"\r\n\r\n", begin)
        if end < 0:
            return
        headers = {}
        for line in data[begin:end].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            headers[name.strip()] = value.strip()
        given = headers.get("Content-Length", "0").strip()
        if given.isdigit():
            length = int(given)
        else:  # an unreadable length: the block runs to the next record or the end
            following = data.find(b"\r\n\r\nWARC/", end + 4)
            length = (following if following >= 0 else len(data)) - end - 4
        yield headers, data[end + 4 : end + 4 + length]
        at = end + 4 + length


def decode(files: DataFrame) -> DataFrame:
    """Records of (content binary), such as Spark's binaryFile source reads."""

    def run(batches):
        for batch in batches:
            rows = []
            for data in batch.column("content"):
                for headers, content in parsed(data.as_py() or b""):
                    get = headers.get
                    rows.append((get("WARC-Record-ID"), get("WARC-Type"), get("WARC-Refers-To"), get("WARC-Target-URI"), get("WARC-Date"), get("Content-Type"), list(headers.items()), content))
            yield _batch(rows)

    return files.select("content").mapInArrow(run, RECORD)
