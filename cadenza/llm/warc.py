"""Operator 6: WARC archives with per-record gzip members, and a reader that salvages damaged ones.

Writing: a page is a WARC/1.1 record, its payload the html in UTF-8. Of records with equal payloads of at
least 100 bytes, the one with the smallest page_id is a response and the others revisit it. Each
record is a gzip member of its own. A member ends in the top byte of its length, which is zero below 16 MB;
Spark's text writer puts that byte after each row (as its line separator), and a longer record is
followed by the zero as padding, which gzip readers skip.

Reading: a record is checked by its member's CRC, its headers, its block's length and its digests. A member may hold
any number of records, and records may stand outside of members. When a check fails, the reader looks for the next WARC
version line, inside the member's content or outside, or the next gzip magic from which a valid record can be read, goes on
there, and reports the bytes between as a gap. Of a damaged or cut-off member the records that were unpacked before the
damage are kept. Records and gaps come from one pass. A gap inside a member has the member's offset in the file and
counts bytes of its content.

A null html counts as empty. Repeated rows stay; equal page_ids with equal payloads are all responses if
theirs is the smallest id. A null page_id is written as an empty field, read back as null, and never the
target of a revisit. A null url is written as an empty target. An empty table gives no records. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import logging
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, work_folder, written

LEAST_BYTES = 100
MEMBER_LEVEL = 6
#: The reader holds a file in memory.
RECORDS_PER_FILE = 10_000
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, file string, offset long, payload binary"
FOUND = RECORDS + ", bytes long, reason string"
MOST_HEADERS = 1 << 16
#: What comes out of a step of so many packed bytes is lost if the step meets damage.
STEP = 1 << 10
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
_LINE = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """The bytes of one record; ``first``: the page_id of the response it revisits."""
    block = b"" if first is not None else payload
    field = "" if page_id is None else str(page_id)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{field}>",
        f"WARC-Target-URI: {re.sub(r'[\r\n]+', ' ', url or '')}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{digest if first is None else hashlib.sha256(block).hexdigest()}",
        f"X-Payload-Length: {len(payload)}",
        *([f"WARC-Refers-To: <urn:page:{first}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if first is not None else []),
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(MEMBER_LEVEL, zlib.DEFLATED, 31)
    packed = packer.compress(data) + packer.flush()
    return packed[:-1] if packed[-1] == 0 else packed  # the writer adds the zero


def with_firsts(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, first): ``first`` is null for responses."""
    p = pages.select(F.col("page_id").cast("long"), "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    p = p.withColumn("digest", F.sha2("payload", 256))
    firsts = p.where(F.octet_length("payload") >= LEAST_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    # short payloads get keys of their own, so that they don't meet
    key = F.when(F.octet_length("payload") >= LEAST_BYTES, F.col("digest")).otherwise(F.concat_ws("-", F.lit("short"), F.xxhash64("page_id", "url")))
    p = p.withColumn("key", key).join(firsts.select(F.col("digest").alias("key"), "first"), "key", "left")
    return p.select("page_id", "url", "payload", "digest", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("first"))


def write_warc(pages: DataFrame, path: str) -> None:
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([member(record(r["page_id"], r["url"], r["payload"], r["digest"], r["first"])) for r in rows], pa.binary())], ["member"])

    records = with_firsts(pages).mapInArrow(packed, "member binary").select(F.col("member").cast("string").alias("value"))
    records.write.option("lineSep", "\0").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _parse(data: bytes, at: int) -> tuple[dict[bytes, bytes], bytes, int] | None:
    """Headers, block and end of the record at ``at``; None if it is damaged."""
    if not data.startswith(VERSION, at) or (end := data.find(b"\r\n\r\n", at, at + MOST_HEADERS)) < 0:
        return None
    headers = {k.strip().lower(): v for k, v in _LINE.findall(data, data.find(b"\r\n", at) + 2, end + 2)}
    length = headers.get(b"content-length", b"")
    if not length.isdigit() or len(length) > 18:
        return None
    start, after = end + 4, end + 4 + int(length)
    if data[after : after + 4] != b"\r\n\r\n":
        return None
    block = data[start:after]
    told = [headers.get(b"warc-block-digest", b"")]
    if headers.get(b"warc-type") == b"response" and not headers.get(b"content-type", b"").startswith(b"application/http"):
        told.append(headers.get(b"warc-payload-digest", b""))  # the block is the payload
    if (told := {t[7:] for t in told if t.startswith(b"sha256:")}) and told != {hashlib.sha256(block).hexdigest().encode()}:
        return None
    return headers, block, after + 4


def _unpack(data: bytes, at: int) -> tuple[bytes, int, str]:
    """The content of the gzip member at ``at``, its length in the file and what is wrong with it, if anything."""
    unpacker, out, to = zlib.decompressobj(31), [], at
    view = memoryview(data)
    while not unpacker.eof:
        if to >= len(data):
            return b"".join(out), len(data) - at, "the member is cut off"
        try:
            out.append(unpacker.decompress(view[to : to + STEP]))
        except zlib.error as e:
            return b"".join(out), 0, f"the member is damaged: {e}"
        to += STEP
    return b"".join(out), min(to, len(data)) - len(unpacker.unused_data) - at, ""


def _records(data: bytes, at: int) -> Iterator[tuple[int, int, dict[bytes, bytes] | str, bytes]]:
    """(offset, bytes, headers, block) of the records in ``data`` and (offset, bytes, reason, b"") of what lies between."""
    while at < len(data):
        if found := _parse(data, at):
            yield at, found[2] - at, found[0], found[1]
            at = found[2]
            continue
        why = "the record is damaged" if data.startswith(VERSION, at) else "no record starts here"
        bad = at
        while (at := data.find(VERSION, at + 1)) > 0 and not _parse(data, at):
            pass
        at = len(data) if at < 0 else at
        yield bad, at - bad, why, b""


def salvage(data: bytes) -> Iterator[tuple[int, int, dict[bytes, bytes] | str, bytes]]:
    """(offset, bytes, headers, block) of each valid record and (offset, bytes, reason, b"") of each gap.

    The first record of a member has the member's bytes, the others of it 0, as have all of a member that is a gap."""
    at, bad, reason = 0, None, ""
    while at < len(data):
        size, why, found = 0, "no record starts here", []
        if data.startswith(MAGIC, at):
            text, size, why = _unpack(data, at)
            found = [(at, 0 if isinstance(what, dict) else n, what, block) for _, n, what, block in _records(text, 0)]
            if why:  # keep what came before the damage; the rest of the member is a gap
                found, size = [x for x in found if isinstance(x[2], dict)], 0
            elif not any(isinstance(x[2], dict) for x in found):
                found, why = [], "the record is damaged"
            else:
                first = next(i for i, x in enumerate(found) if isinstance(x[2], dict))
                found[first] = at, size, *found[first][2:]
        elif one := _parse(data, at):
            size, found = one[2] - at, [(at, one[2] - at, one[0], one[1])]
        elif data.startswith(VERSION, at):
            why = "the record is damaged"
        elif data[at] == 0 and bad is None:  # padding
            at += 1
            continue
        if bad is not None and found:
            yield bad, at - bad, reason, b""
            bad = None
        yield from found
        if size and found:
            at += size
            continue
        if bad is None:
            bad, reason = at, why
        at = min((x for x in (data.find(MAGIC, at + 1), data.find(VERSION, at + 1)) if x > 0), default=len(data))
    if bad is not None:
        yield bad, len(data) - bad, reason, b""


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> tuple[DataFrame, DataFrame]:
    """(records, gaps) of all archives in ``path``, found in one pass and written to the shared folder.

    Records: the valid ones; a revisit's payload is null. Gaps: the quarantined byte ranges and why each begins.
    """
    names, types = zip(*(c.split() for c in FOUND.split(", ")))
    arrow = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def row(file: str, offset: int, size: int, headers: dict[bytes, bytes] | str, block: bytes) -> tuple:
        if isinstance(headers, str):
            return None, None, None, None, None, None, file, offset, None, size, headers
        text = {k.decode("utf-8", "replace"): v.decode("utf-8", "replace") for k, v in headers.items()}
        number = lambda name: int(m[1]) if (m := re.search(r"<urn:page:(-?\d+)>", text.get(name, ""))) else None
        kind = text.get("warc-type", "")
        length = int(n) if (n := text.get("x-payload-length", "")).isdigit() else len(block)
        payload = block if payloads and kind != "revisit" else None
        return number("warc-record-id"), text.get("warc-target-uri"), length, text.get("warc-payload-digest", "").removeprefix("sha256:"), kind, number("warc-refers-to"), file, offset, payload, size, None

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                out = []
                for item in salvage(data.as_py()):
                    out.append(row(file, *item))
                    if len(out) == 500:
                        yield pa.RecordBatch.from_arrays([pa.array(c, arrow[t]) for c, t in zip(zip(*out), types)], names)
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, arrow[t]) for c, t in zip(zip(*out), types)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    found = written(files.select("path", "content").mapInArrow(parse, FOUND), "archives")
    return found.where("reason is null").drop("bytes", "reason"), found.where("reason is not null").select("file", "offset", "bytes", "reason")


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    return read_archives(spark, path, payloads)[0]


def read_gaps(spark: SparkSession, path: str) -> DataFrame:
    return read_archives(spark, path, False)[1]


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    records, gaps = read_archives(spark, path, payloads=False)
    if n := gaps.count():
        logging.getLogger(__name__).warning("%d byte ranges of %s could not be read", n, path)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha256(encode(coalesce(html, ''))) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE octet_length(b) >= 100 GROUP BY d)
SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, p.d AS payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d AND octet_length(b) >= 100
"""
