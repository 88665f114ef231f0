"""WARC archives: write pages as records, read them back, reassemble segmented ones.

A page is one HTTP response with chunked transfer framing. Among pages of equal payload one is
written in full (a response), the others refer to it (revisit). A record longer than ``segment``
bytes is cut into continuation records: the first carries segment number 1, the others name the
first as their origin, the last also the total length. Reading groups continuations by that
origin, orders them by number, verifies the total length, joins them, and takes the framing off.

Archives are ordinary files in the shared folder: Spark's text writer writes each record's bytes as they
are, its line separator being the two line ends that the format wants behind a record. A file is
read by one task, and its size is bounded by ``per_file`` records of ``segment`` bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, mapped, remove, rows_of, scratch

VERSION, CRLF = b"WARC/1.1", b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
RECORD = "record_id string, kind string, origin string, segment int, total long, uri string, refers_to string, digest string, whole boolean, block binary, error string"


class Damaged(ValueError):
    """The bytes break the format."""


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = 4096) -> bytes:
    """HTTP/1.1 chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(payload[k : k + size]), payload[k : k + size]) for k in range(0, len(payload), size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """Takes the framing off; extensions and trailers are passed over."""
    at, out = 0, []
    while True:
        end = body.find(CRLF, at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            raise Damaged(f"no chunk size at {at}")
        n, at = int(size, 16), end + 2
        if not n:
            return b"".join(out)
        if body[at + n : at + n + 2] != CRLF:
            raise Damaged(f"the chunk at {at} is cut off")
        out.append(body[at : at + n])
        at += n + 2


def http_payload(block: bytes) -> bytes:
    """The payload of an HTTP response message."""
    head, found, body = block.partition(CRLF * 2)
    if not found or not head.startswith(b"HTTP/"):
        raise Damaged("no HTTP head")
    return unchunked(body) if re.search(rb"\r\ntransfer-encoding:[ \t]*chunked", head, re.I) else body


def record(headers: dict[str, str], block: bytes) -> bytes:
    """A record without the two line ends behind it."""
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers.items()), b"Content-Length: %d" % len(block)]
    return CRLF.join(lines) + CRLF * 2 + block


def segments(headers: dict[str, str], block: bytes, size: int) -> list[bytes]:
    """The record, in continuation records if its block is longer than ``size``."""
    if len(block) <= size:
        return [record(headers, block)]
    first, out = headers["WARC-Record-ID"], []
    for k, at in enumerate(range(0, len(block), size)):
        own = headers | {"WARC-Segment-Number": "1"}
        if k:
            name = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{first}/{k + 1}')}>"
            own = {"WARC-Type": "continuation", "WARC-Record-ID": name, "WARC-Date": DATE, "WARC-Segment-Number": str(k + 1), "WARC-Segment-Origin-ID": first}
            if at + size >= len(block):
                own["WARC-Segment-Total-Length"] = str(len(block))
        out.append(record(own, block[at : at + size]))
    return out


def records(data: bytes):
    """(headers, block) of each record of an uncompressed archive. Damaged where the bytes break the format."""
    at = 0
    while at < len(data):
        head = data.find(CRLF * 2, at)
        if head < 0 or not data.startswith(b"WARC/", at):
            raise Damaged(f"no record at {at}")
        lines = re.sub(rb"\r\n[ \t]+", b" ", data[at:head]).split(CRLF)
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.decode("utf-8", "replace").partition(":") for x in lines[1:])}
        if not headers.get("content-length", "").isdigit():
            raise Damaged(f"the record at {at} has no length")
        end = head + 4 + int(headers["content-length"])
        if end > len(data):
            raise Damaged(f"the record at {at} is cut off")
        yield headers, data[head + 4 : end]
        at = end
        while data.startswith(CRLF, at):
            at += 2


def page_uri(page) -> str:
    return f"urn:page:{page}"


def write(pages: DataFrame, path: str, segment: int = 16_384, per_file: int = 1_000) -> None:
    """Write ``pages`` (page_id, url, html) as gzipped archives into the folder ``path``.

    Of pages of equal payload that with the largest page_id is a response; rows that repeat that page_id and payload
    are responses too. Pages meet by digest only; winners are pre-aggregated, and the rows of a payload that very many
    pages share may be split among tasks. A null html is an empty payload.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("sha1"))
    kept = rows.groupBy("sha1").agg(F.max("page_id").alias("kept_page"))
    full = F.col("page_id").eqNullSafe(F.col("kept_page"))
    placed = rows.join(kept, "sha1").select("page_id", "url", F.when(full, F.col("html")).alias("html"), "sha1", F.monotonically_increasing_id().alias("row"), "kept_page")

    def run(batches):
        for b in batches:
            out = []
            for page, url, text, sha1, row, kept_page in rows_of(b, *b.schema.names):
                headers = {"WARC-Type": "response", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}/{row}')}>", "WARC-Date": DATE, "WARC-Target-URI": page_uri(page), "X-Page-URL": re.sub(r"\s+", " ", url), "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()}
                if text is None:
                    headers |= {"WARC-Type": "revisit", "WARC-Profile": PROFILE, "WARC-Refers-To-Target-URI": page_uri(kept_page), "WARC-Refers-To-Date": DATE}
                    out.append(record(headers, b""))
                else:
                    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(text.encode("utf-8", "surrogatepass"))
                    out += segments(headers | {"Content-Type": "application/http; msgtype=response"}, block, segment)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    made = mapped(placed, run, "record binary")
    made.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records (RECORD) of the archives in a folder, gzipped or not. One row with ``error`` for a damaged rest of a file.

    whole: it isn't a segment of a longer record.
    """

    def run(batches):
        for b in batches:
            for (data,) in rows_of(b, "content"):
                out = []
                try:
                    for h, block in records(unzipped(data)):
                        number = h.get("warc-segment-number", "")
                        if number and not (number.isdigit() and int(number) < 1 << 31) or len(h.get("warc-segment-total-length", "")) > 18:
                            raise Damaged(f"a segment's number or total length is none: {h.get('warc-record-id', '')}")
                        rid = h.get("warc-record-id", "")
                        out.append((rid, h.get("warc-type"), h.get("warc-segment-origin-id") or rid, int(number or 1), int(h["warc-segment-total-length"]) if "warc-segment-total-length" in h else None, h.get("warc-target-uri"), h.get("warc-refers-to-target-uri"), h.get("warc-payload-digest", "").removeprefix("sha1:") or None, not number, block, None))
                except (Damaged, ValueError) as e:
                    out.append((None,) * 10 + (str(e),))
                for at in range(0, len(out), 500):
                    cols = list(zip(*out[at : at + 500]))
                    types = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.binary(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [x.split()[0] for x in RECORD.split(", ")])

    return mapped(spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content"), run, RECORD)


def unzipped(data: bytes) -> bytes:
    """Gzip members one behind the other; other bytes as they are. Damaged where a member is broken or cut off."""
    if data[:2] != b"\x1f\x8b":
        return data
    out, at = [], 0
    while data:
        d = zlib.decompressobj(31)
        try:
            out.append(d.decompress(data))
        except zlib.error as e:
            raise Damaged(f"member {at} isn't gzip: {e}") from e
        if not d.eof:
            raise Damaged(f"member {at} is cut off")
        data, at = d.unused_data, at + 1
    return b"".join(out)


def reassemble(rows: DataFrame) -> DataFrame:
    """Records (RECORD) with segmented ones joined: record_id, kind, uri, refers_to, digest, block, error.

    Only segments are grouped, by their origin, so a group is one record. error, and a null block: a number is missing
    or there twice, the total length is missing or differs, or there is no first segment.
    """
    columns = ["record_id", "kind", "uri", "refers_to", "digest", "block", "error"]
    whole = rows.where(F.col("whole") | F.col("error").isNotNull()).select(columns)
    parts = F.sort_array(F.collect_list(F.struct("segment", "kind", "total", "uri", "refers_to", "digest", "block")))
    grouped = rows.where(~F.col("whole")).groupBy("origin").agg(parts.alias("p"))
    block = F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["block"]))
    ordered = F.transform("p", lambda x: x["segment"]) == F.sequence(F.lit(1), F.size("p"))
    error = F.when(~ordered, F.lit("segments are missing or repeated")).when(F.element_at("p", -1)["total"].isNull() | (F.element_at("p", -1)["total"] != F.length("block")), F.lit("the total length differs"))
    joined = grouped.withColumn("block", block).withColumn("error", error).select(
        F.col("origin").alias("record_id"), *(F.element_at("p", 1)[c].alias(c) for c in ("kind", "uri", "refers_to", "digest")), F.when(F.col("error").isNull(), F.col("block")).alias("block"), "error"
    )
    return whole.unionByName(joined)


def payloads(found: DataFrame, with_payload: bool = False) -> DataFrame:
    """Of reassembled records: record_id, kind, uri, refers_to, digest, payload_bytes, payload_digest, error (and payload).

    payload_bytes and payload_digest are those of the decoded payload, null for revisits. error: it can't be decoded,
    or its digest isn't the one that the record gives.
    """
    names = ["record_id", "kind", "uri", "refers_to", "digest"]

    def run(batches):
        for b in batches:
            out = []
            for *head, block, error in rows_of(b, *names, "block", "error"):
                payload = None
                if head[1] == "response" and error is None:
                    try:
                        payload = http_payload(block)
                        if head[4] and digest_of(payload) != head[4]:
                            error = "the payload's digest differs"
                    except Damaged as e:
                        error = str(e)
                out.append((*head, None if payload is None else len(payload), None if payload is None else digest_of(payload), error, payload))
            cols = list(zip(*out)) if out else [()] * 9
            types = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.string(), pa.binary()]
            n = 8 + with_payload
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols[:n], types)], [*names, "payload_bytes", "payload_digest", "error", "payload"][:n])

    return mapped(found.select(*names, "block", "error"), run, "record_id string, kind string, uri string, refers_to string, digest string, payload_bytes long, payload_digest string, error string" + ", payload binary" * with_payload)


def round_trip(pages: DataFrame, segment: int = 16_384, per_file: int = 1_000) -> DataFrame:
    """Write ``pages``, read the archives back, and report each page from what was read.

    One row per row of ``pages``: page_id, payload_bytes and payload_digest of the full payload, record_type, refers_to
    (the response's page_id, for revisits), error. A revisit's payload is looked up in the response that it refers to, by page and digest.
    Null html is an empty payload; a null page_id stays null; an empty table gives an empty one; other columns aren't read.
    """
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    try:
        write(pages, path, segment, per_file)
        found = cut(payloads(reassemble(read(spark, path))))  # no payloads: a short row per page
    finally:
        remove(spark, path)
    page = lambda uri: F.expr(f"try_cast(substr({uri}, 10) as {pages.schema['page_id'].dataType.simpleString()})")
    full = found.where("kind = 'response' AND error IS NULL").groupBy(F.col("uri").alias("to_uri"), F.col("payload_digest").alias("to_digest")).agg(F.max("payload_bytes").alias("to_bytes"))
    responses = found.where("kind = 'response'").select(page("uri").alias("page_id"), "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast(pages.schema["page_id"].dataType).alias("refers_to"), "error")
    revisits = found.where("kind = 'revisit'").join(full, (F.col("refers_to") == F.col("to_uri")) & (F.col("digest") == F.col("to_digest")), "left")
    wrong = F.when(F.col("to_uri").isNull(), F.lit("the response that it refers to is missing"))
    revisits = revisits.select(page("uri").alias("page_id"), F.col("to_bytes").alias("payload_bytes"), F.col("to_digest").alias("payload_digest"), F.lit("revisit").alias("record_type"), page("refers_to").alias("refers_to"), F.coalesce("error", wrong).alias("error"))
    damaged = found.where("kind is null").select(F.lit(None).cast(pages.schema["page_id"].dataType).alias("page_id"), "payload_bytes", "payload_digest", F.lit(None).cast("string").alias("record_type"), F.lit(None).cast(pages.schema["page_id"].dataType).alias("refers_to"), "error")
    return responses.unionByName(revisits).unionByName(damaged)


#: The contract's rows. Base32 by fives of hexadecimal digits: 20 bits are four digits of base 32.
ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS s, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  translate(array_to_string(list_transform(range(8), lambda i: lpad(to_base(('0x' || substr(s, (5 * i + 1)::INT, 5))::BIGINT, 32), 4, '0')), ''), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to,
  CAST(NULL AS VARCHAR) AS error
FROM d
"""
