"""WARC derivatives: metadata and plain-text conversion records made from response records and linked to them."""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmart.llm.common import pick

RECORD = "record_id string, type string, target_uri string, date string, headers map<string,string>, block binary"
DERIVED = (
    "source_id string, record_id string, type string, refers_to string, target_uri string, date string, content_type string, "
    "content_length long, block_digest string, payload_digest string, headers map<string,string>, block binary"
)
_NAMED = ("WARC-Type", "WARC-Record-ID", "WARC-Target-URI", "WARC-Date", "Content-Length")
_SOURCE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the standard name space of addresses
_END = b"\r\n\r\n"


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def name(*parts: str) -> str:
    """A record id that follows from what the record is made of, so that a repeated run gives the same."""
    return f"<urn:uuid:{uuid.uuid5(_SOURCE, chr(10).join(parts))}>"


# --- plain text -------------------------------------------------------------------------------

# No pattern looks further than the next `<` for the end of a tag, so that pages without `>` are read in one linear scan too.
_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<[!?][^<>]*(?:>|(?=<)|\Z)", re.DOTALL | re.IGNORECASE)
# Without an end tag only the tag is left out, not the page behind it.
_UNSEEN = re.compile(r"<(/?)(noscript|template)\b[^<>]*>?", re.IGNORECASE)
# The head ends at its end tag or at the first element that belongs to the body; of its text only the title is no text of the page.
_HEAD_END = re.compile(r"</head\b|<(?!(?:html|head|title|meta|link|base|noscript|template)\b)[a-z]", re.IGNORECASE)
_TITLE = re.compile(r"<title\b[^<>]*>", re.IGNORECASE)
_TITLE_END = re.compile(r"</title\s*>", re.IGNORECASE)
_INLINE = re.compile(
    r"</?(?:a|abbr|b|big|cite|code|em|font|i|kbd|mark|q|s|small|span|strong|sub|sup|time|u|var|wbr)\b[^<>]*(?:>|(?=<)|\Z)", re.IGNORECASE
)
_TAG = re.compile(r"</?[a-zA-Z](?:\"[^\"]*\"|'[^']*'|[^'\"<>])*+(?:>|(?=<)|\Z)|</?[a-zA-Z][^<>]*>?")
_LINK = re.compile(r"<a\b[^<>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'<>]+))", re.IGNORECASE)


def _title(page: str) -> tuple[int, int, int, int] | None:
    """Where the first title is: its start tag, its text and its end. Without an end tag its text ends at the next tag."""
    start = _TITLE.search(page)
    if start is None:
        return None
    end = _TITLE_END.search(page, start.end())
    if end:
        return start.start(), start.end(), end.start(), end.end()
    following = page.find("<", start.end())
    following = len(page) if following < 0 else following
    return start.start(), start.end(), following, following


def _without_unseen(page: str) -> str:
    """The page without elements that are not shown: from the outermost start tag that has an end tag to that."""
    open_: dict[str, list[int]] = {"noscript": [], "template": []}
    spans: list[tuple[int, int]] = []
    for m in _UNSEEN.finditer(page):
        starts = open_[m[2].lower()]
        if not m[1]:
            starts.append(m.start())
        elif starts:
            start = starts.pop()
            while spans and spans[-1][0] >= start:
                spans.pop()
            spans.append((start, m.end()))
    parts, at = [], 0
    for start, end in spans:
        if end > at:
            parts.append(page[at : max(at, start)])
            at = end
    return "\0".join([*parts, page[at:]])


def plain_text(page: str) -> str:
    """All text of a page, a line per block."""
    seen = _without_unseen(_HIDDEN.sub("\0", page))
    title, end = _title(seen), _HEAD_END.search(seen)
    if title and (end is None or title[0] < end.start()):
        seen = f"{seen[: title[0]]}\0{seen[title[3] :]}"
    bare = _TAG.sub("\0", _INLINE.sub("", seen))
    lines = (" ".join(html.unescape(line).split()) for line in bare.split("\0"))
    return "\n".join(line for line in lines if line)


# --- one response -----------------------------------------------------------------------------


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload. Without an empty line there is no payload, without `HTTP/` in front no header."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    head, _, payload = block.partition(_END)
    lines = head.decode("latin-1").split("\r\n")
    headers = [tuple(x.strip() for x in line.split(":", 1)) for line in lines[1:] if ":" in line]
    return lines[0], headers, payload


_CHUNK = re.compile(rb"([0-9A-Fa-f]{1,16})[ \t]*(?:;[^\r\n]*)?\r?\n")


def unchunked(payload: bytes) -> bytes:
    """The payload without the sizes of its chunks; as it is if it does not start with one. A torn last chunk is kept."""
    parts, at = [], 0
    while m := _CHUNK.match(payload, at):
        size = int(m[1], 16)
        parts.append(payload[m.end() : m.end() + size])
        at = m.end() + size
        if not size or at >= len(payload):
            return b"".join(parts)
        end = 2 if payload[at : at + 2] == b"\r\n" else 1 if payload[at : at + 1] == b"\n" else 0
        if not end:
            return payload
        at += end
    return b"".join(parts) if parts and at >= len(payload) else payload


def inflated(payload: bytes, coding: str) -> bytes:
    """The payload without one content coding (gzip, deflate, zstd), as far as it can be read; as it is if it cannot or the coding is another."""
    if coding in ("gzip", "x-gzip", "deflate"):
        for bits in (zlib.MAX_WBITS | 32, -zlib.MAX_WBITS):  # with a gzip or zlib header, without any
            out, rest = [], payload
            try:
                while rest:
                    one = zlib.decompressobj(bits)
                    for at in range(0, len(rest), 1 << 16):  # in pieces, so that what stands before a broken place is kept
                        out.append(one.decompress(rest[at : at + (1 << 16)]))
                        if one.eof:
                            break
                    rest = one.unused_data + rest[at + (1 << 16) :] if one.eof else b""
            except zlib.error:
                pass
            if any(out):
                return b"".join(out)
    elif coding == "zstd":
        out = []
        try:
            reader = zstandard.ZstdDecompressor().stream_reader(payload, read_across_frames=True)
            while part := reader.read(1 << 16):
                out.append(part)
        except zstandard.ZstdError:
            pass
        if out:
            return b"".join(out)
    return payload


def _codings(value: str | None) -> list[str]:
    return [c.strip().lower() for c in (value or "").split(",") if c.strip()]


def derive_one(record_id: str, uri: str | None, date: str | None, headers: dict[str, str], block: bytes) -> list[tuple]:
    """The metadata and, for textual payloads, the conversion record of a response."""
    status, http, payload = split_http(block or b"")
    known: dict[str, str] = {}
    for k, v in http:  # a repeated header is a list
        known[k.lower()] = f"{known[k.lower()]}, {v}" if k.lower() in ("transfer-encoding", "content-encoding") and k.lower() in known else v
    if "chunked" in _codings(known.get("transfer-encoding")):
        payload = unchunked(payload)
    kind = known.get("content-type", "text/html")
    source = {f"X-Source-{k}": v for k, v in sorted((headers or {}).items()) if v is not None}
    payload_digest = (headers or {}).get("WARC-Payload-Digest") or digest(payload)
    links = {"WARC-Refers-To": record_id, "WARC-Refers-To-Payload-Digest": payload_digest}
    links |= {"WARC-Refers-To-Target-URI": uri} if uri else {}
    links |= {"WARC-Refers-To-Date": date} if date else {}
    textual = kind.lower().startswith("text/") or "html" in kind.lower() or "xml" in kind.lower()
    charset = re.search(r"charset=\"?([\w.:-]+)", kind, re.IGNORECASE)
    body = payload
    for coding in reversed(_codings(known.get("content-encoding"))) if textual else ():
        body = inflated(body, coding)
    try:
        page = body.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        page = body.decode("utf-8", "replace")
    conversion = name("conversion", record_id, payload_digest)
    title = _title(page) if textual else None
    fields = [("source-status", status), ("source-payload-digest", payload_digest), ("source-payload-length", str(len(payload)))]
    fields += [(f"source-http-{k.lower()}", v) for k, v in http]
    if textual:
        fields += [("conversion", conversion), ("title", " ".join(html.unescape(page[title[1] : title[2]]).split()) if title else "")]
        fields += [("outlink", " ".join(html.unescape(m[1] or m[2] or m[3] or "").split())) for m in _LINK.finditer(page)]
    meta = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    out = [_record(record_id, name("metadata", record_id, payload_digest), "metadata", uri, date, "application/warc-fields", meta, links | source)]
    if textual:
        text = plain_text(page).encode("utf-8", "replace")
        out.append(_record(record_id, conversion, "conversion", uri, date, "text/plain; charset=utf-8", text, links | source))
    return out


def _record(source_id, record_id, type_, uri, date, content_type, block, headers) -> tuple:
    own = digest(block)
    every = headers | {"Content-Type": content_type, "WARC-Block-Digest": own, "WARC-Payload-Digest": own}
    return (source_id, record_id, type_, source_id, uri, date, content_type, len(block), own, own, list(every.items()), block)


# --- on Spark ---------------------------------------------------------------------------------


def derive(records: DataFrame) -> DataFrame:
    """Metadata and conversion records (see DERIVED) of the response records among `records` (see RECORD).

    Both name their response in WARC-Refers-To, with its address, date and
    payload digest, and repeat its other headers as X-Source-*. The metadata
    record lists status, HTTP headers, title and links and names the conversion
    record; a payload that is no text has no conversion record. Ids follow from
    the response's id and payload, so a repeated run or row gives the same ones.
    A null block is an empty response, a response without id is named after its
    address and block, null headers are none, other record types are passed
    over, further columns are left out. No shuffle.
    """

    def run(batches):
        for batch in batches:
            out = []
            for record_id, uri, date, headers, block in zip(*[c.to_pylist() for c in batch.columns]):
                record_id = record_id or name("response", uri or "", digest(block or b""))
                out += derive_one(record_id, uri, date, dict(headers or ()), block or b"")
                if sum(len(r[-1]) for r in out[-64:]) > 1 << 23 or len(out) >= 4096:
                    yield _batch(out)
                    out = []
            yield _batch(out)

    chosen = pick(records, *[c.split()[0] for c in RECORD.split(", ")]).where("type = 'response'").drop("type")
    return chosen.mapInArrow(run, DERIVED)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    text = pa.string()
    kinds = [text] * 7 + [pa.int64(), text, text, pa.map_(text, text), pa.binary()]
    names = [c.split()[0] for c in DERIVED.split(", ")]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def responses(pages: DataFrame, date: str) -> DataFrame:
    """`pages` (page_id, url, html) as response records, as a crawler would have written them; the id is the header X-Page-ID, a null page is empty."""

    def run(batches):
        for batch in batches:
            rows = []
            for page_id, url, page in zip(*[c.to_pylist() for c in batch.columns]):
                body = (page or "").encode("utf-8", "replace")
                block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % len(body) + _END + body
                headers = {"X-Page-ID": str(page_id)} if page_id is not None else {}
                headers |= {"Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": digest(body), "WARC-Block-Digest": digest(block)}
                rows.append((name("page", str(page_id), url or "", digest(body)), "response", url, date, list(headers.items()), block))
            kinds = [*[pa.string()] * 4, pa.map_(pa.string(), pa.string()), pa.binary()]
            names = [c.split()[0] for c in RECORD.split(", ")]
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return pick(pages, "page_id", "url", "html").mapInArrow(run, RECORD)


def write(records: DataFrame, path: str, per_file: int = 20_000, **options: str) -> None:
    """Records (RECORD or DERIVED) as WARC files of at most `per_file` records; pass compression="gzip" for gzip.

    The text writer's separator is the one between WARC records. A header of several lines is
    written once per line, as `read` returns headers that repeat. A gzip file is one stream.
    """
    fixed = [("WARC-Type", "type"), ("WARC-Record-ID", "record_id"), ("WARC-Target-URI", "target_uri"), ("WARC-Date", "date")]
    line = lambda key, value: F.when(value.isNotNull(), F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))).otherwise("")
    head = F.concat(F.lit("WARC/1.1\r\n"), *[line(k, F.col(c)) for k, c in fixed])
    rest = F.array_join(F.transform(F.array_sort(F.map_entries(F.coalesce("headers", F.create_map().cast("map<string,string>")))),
                                    lambda e: F.concat(e["key"], F.lit(": "), F.replace(F.coalesce(e["value"], F.lit("")), F.lit("\n"),
                                                       F.concat(F.lit("\r\n"), e["key"], F.lit(": "))), F.lit("\r\n"))), "")
    block = F.coalesce(F.col("block"), F.lit(b""))
    length = F.concat(F.lit("Content-Length: "), F.length(block).cast("string"), F.lit("\r\n\r\n"))
    whole = F.concat(F.concat(head, rest, length).cast("binary"), block).cast("string")
    out = records.select(whole.alias("value")).write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", per_file)
    out.options(**options).text(path)


BROKEN = "file string, at long, reason string, length long"


def read(spark: SparkSession, path: str) -> DataFrame:
    """The whole records of WARC files (see RECORD), plain or gzip; what is broken is left to `read_broken`.

    A file is one task and has to fit into its memory. Values of a header that
    repeats are the lines of one value.
    """

    def run(batches):
        for batch in batches:
            for content in batch.column(0).to_pylist():
                for rows in _some((r for r in parse(content) if isinstance(r, tuple)), 1000):
                    kinds = [*[pa.string()] * 4, pa.map_(pa.string(), pa.string()), pa.binary()]
                    names = [c.split()[0] for c in RECORD.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, RECORD)


def read_broken(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, reason, length): the pieces of WARC files that are no whole records, by their place in the unpacked file."""

    def run(batches):
        for batch in batches:
            for file, content in zip(*[c.to_pylist() for c in batch.columns]):
                for rows in _some(([file, *r.place] for r in parse(content) if isinstance(r, Broken)), 1000):
                    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in BROKEN.split(", ")])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, BROKEN)


def _some(rows: Iterator, n: int) -> Iterator[list]:
    part = []
    for row in rows:
        part.append(row)
        if len(part) == n:
            yield part
            part = []
    if part:
        yield part


@dataclass(frozen=True)
class Broken:
    """A piece of a file that is no whole record: where it starts, what is wrong, how long it is."""

    place: tuple[int, str, int]


def parse(content: bytes) -> Iterator[tuple | Broken]:
    """Records of one file, by their Content-Length, and the pieces between them that are none.

    Behind a broken record reading goes on at the next line that starts like one.
    """
    if content[:2] == b"\x1f\x8b":
        content = inflated(content, "gzip")
    at, size = 0, len(content)
    while at < size:
        blank = _BLANK.match(content, at).end()
        if blank == size:
            return
        at, reason, headers, start, length = blank, None, {}, blank, 0
        end = content.find(_END, at)
        if not content.startswith(b"WARC/", at):
            reason = "no record"
        elif end < 0:
            reason = "torn header"
        else:
            for line in content[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
                key, parted, value = line.partition(":")
                if parted:
                    key, value = key.strip(), value.strip()
                    headers[key] = f"{headers[key]}\n{value}" if key in headers else value
            start, said = end + len(_END), headers.pop("Content-Length", "")
            if not re.fullmatch(r"[0-9]{1,18}", said):
                reason = "no length"
            else:
                length = int(said)
                reason = "torn block" if start + length > size else None
        if reason:
            following = _START.search(content, at + 1)
            after = following.start() if following else size
            yield Broken((at, reason, after - at))
            at = after
            continue
        at = start + length
        fixed = [headers.pop(k, None) for k in ("WARC-Record-ID", "WARC-Type", "WARC-Target-URI", "WARC-Date")]
        yield (*fixed, list(headers.items()), content[start:at])


_BLANK = re.compile(rb"[\r\n]*")
_START = re.compile(rb"(?<=\n)WARC/[0-9]")
