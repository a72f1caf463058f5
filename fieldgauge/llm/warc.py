"""Metadata and conversion records derived from WARC responses."""

from __future__ import annotations

import base64
import codecs
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldgauge.llm.html_blocks import blocks

RECORDS = T.StructType(
    [
        T.StructField("warc_type", T.StringType()),
        T.StructField("warc_record_id", T.StringType()),
        T.StructField("warc_refers_to", T.StringType()),
        T.StructField("warc_target_uri", T.StringType()),
        T.StructField("warc_date", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("content_length", T.LongType()),
        T.StructField("warc_block_digest", T.StringType()),
        T.StructField("source_block_digest", T.StringType()),
        T.StructField("source_payload_digest", T.StringType()),
        T.StructField("source_headers", T.StringType()),
        T.StructField("block", T.StringType()),
    ]
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(kind: str, of: str) -> str:
    """The id of a derived record: a name-based UUID, so reruns give the same."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind} {of}')}>"


def split_response(block: bytes) -> tuple[str, bytes]:
    """Status line and headers, and payload, of an HTTP response; without an empty line all is payload."""
    head, gap, payload = block.partition(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or not gap:
        return "", block
    return head.decode("latin-1"), payload


def _header(headers: str, name: str) -> str | None:
    for line in headers.split("\r\n")[1:]:
        key, colon, value = line.partition(":")
        if colon and key.strip().lower() == name:
            return value.strip()
    return None


def _charset(content_type: str | None) -> str:
    for part in (content_type or "").split(";")[1:]:
        key, _, value = part.partition("=")
        if key.strip().lower() == "charset":
            try:
                name = codecs.lookup(value.strip(" \"'")).name
                b"".decode(name)  # refused by codecs that are not of text
            except (LookupError, ValueError):  # a zero character is no LookupError
                break
            return name
    return "utf-8"


def _decoded(payload: bytes, charset: str) -> str:
    """The payload as text that has a form in UTF-8; what can't be decoded is replaced."""
    try:
        text = payload.decode(charset, "replace")
    except (LookupError, ValueError):  # codecs that know no replacement, or refuse every input
        text = payload.decode("utf-8", "replace")
    return text.encode("utf-8", "replace").decode("utf-8")


def _dechunked(payload: bytes) -> bytes:
    """The body of a chunked transfer; what does not follow the form ends it."""
    found, at = [], 0
    while True:
        end = payload.find(b"\r\n", at)
        size = payload[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not size or not all(c in b"0123456789abcdefABCDEF" for c in size) or int(size, 16) == 0:
            return b"".join(found)
        begin = end + 2
        found.append(payload[begin : begin + int(size, 16)])
        at = begin + int(size, 16) + 2


def _body(headers: str, payload: bytes) -> bytes:
    """The payload without its transfer and content encoding, as far as it follows them."""
    if "chunked" in (_header(headers, "transfer-encoding") or "").lower():
        payload = _dechunked(payload)
    encoding = (_header(headers, "content-encoding") or "").strip().lower()
    if encoding in ("gzip", "x-gzip", "deflate"):
        for bits in (47, -15):  # with a header of either kind, then without
            inflater = zlib.decompressobj(bits)
            try:
                return inflater.decompress(payload) + inflater.flush()
            except zlib.error:
                continue
    return payload


def derive(source_id: str | None, uri: str | None, date: str | None, block: bytes | None) -> list[tuple]:
    """The metadata and the conversion record of one response."""
    block = block or b""
    source_id = source_id or record_id("response", f"{uri} {date} {digest(block)}")
    headers, payload = split_response(block)
    content_type = _header(headers, "content-type")
    page = _decoded(_body(headers, payload), _charset(content_type))
    text = "\n".join(b.text for b in blocks(page))
    source = (digest(block), digest(payload), headers or None)
    fields = [
        f"via: {source_id}",
        f"sourceStatus: {headers.split(chr(13))[0]}" if headers else "sourceStatus:",
        f"sourceContentType: {content_type or ''}",
        f"sourceBlockDigest: {source[0]}",
        f"sourcePayloadDigest: {source[1]}",
        f"payloadLength: {len(payload)}",
        f"conversionLength: {len(text.encode())}",
    ]
    metadata = "\r\n".join(fields) + "\r\n"

    def record(kind: str, of_type: str, content: str) -> tuple:
        data = content.encode()
        own = record_id(kind, source_id)
        return (kind, own, source_id, uri, date, of_type, len(data), digest(data), *source, content)

    return [record("metadata", "application/warc-fields", metadata), record("conversion", "text/plain; charset=utf-8", text)]


def _derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for begin in range(0, whole.num_rows, 512):
            batch = whole.slice(begin, 512)
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            found = [r for row in rows for r in derive(*row)]
            columns = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64() if f.name == "content_length" else pa.string()) for c, f in zip(columns, RECORDS, strict=True)],
                names=RECORDS.names,
            )


def build_derivatives(responses: DataFrame) -> DataFrame:
    """A metadata and a conversion record for each response (warc_record_id, warc_target_uri, warc_date, block).

    Both refer to the response and keep its URI and date, its HTTP headers as they were,
    and digests (SHA-1, base 32) of its block and payload; the conversion holds all
    visible text of the payload, a block a line, once its transfer and content encoding
    (chunks, gzip, deflate) are undone and its charset is read; an unknown charset counts
    as UTF-8, and what can't be decoded is replaced. A response without an id is named after
    its URI, date and content. Null blocks count as empty and give an empty conversion;
    a block without HTTP headers is all payload. Repeated responses give repeated
    records; other columns are not read; an empty table gives an empty table.
    """
    names = ("warc_record_id", "warc_target_uri", "warc_date", "block")
    plain = responses.select(*[F.col(n).cast("binary" if n == "block" else "string") for n in names])
    return plain.mapInArrow(_derive, RECORDS)


def responses_of_pages(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Pages (page_id, url, html) as the responses a crawl would have stored."""
    head = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    return pages.select(
        F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")).alias("warc_record_id"),
        F.col("url").alias("warc_target_uri"),
        F.lit(date).alias("warc_date"),
        F.concat(head, F.coalesce("html", F.lit(""))).cast("binary").alias("block"),
    )
