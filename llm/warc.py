"""WARC archives: a deduplicating writer and a salvage reader.

Writing: each record is a gzip member of its own, in files of bounded record count under a shared folder. Members are made
in Arrow batches and written by Spark's text writer, whose line separator is set to the bytes of an empty gzip member,
so a file is a plain sequence of members on any file system that Spark writes to. Of records with equal
payloads of at least MIN_REVISIT bytes the one with the smallest id is the response and the others revisit it.

Reading: a reader walks members and, in uncompressed stretches, version lines. Each record is checked (gzip CRC, headers,
Content-Length, end mark, payload digest). After a failed check it searches for the next member or version line from which
a record passes, goes on there, and logs the bytes between as a quarantined gap (path, offset, length, reason). Inside a
member the search goes on over the inflated bytes, so each record that passes is kept; a gap there also has its offset and
length in them (inner_offset, inner_length), while offset and length are the member's. A member that is cut short or broken
gives the records of what could be inflated, and a gap from there on without inner_length. What came out of a broken member
(bad code or CRC) passes only with a payload digest that agrees; a cut-short one's records are checked like plain ones, and
the one that ends where the inflated bytes end, with nothing behind it, stays in the gap.

Null payload: empty. Null url or id: the header is left out (the id reads back as null). Repeated rows (same id and payload)
are each a response, as each has the smallest id. Control characters in a url are percent-encoded. Extra columns are left
alone; an empty table gives an archive without records.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import read_table, salted_left_join
from moodwire.streaming.replay import scratch_path

MIN_REVISIT = 100
#: An empty gzip member: what stands between records, as Latin-1 characters.
SEPARATOR = bytes.fromhex("1f8b080000000000000303000000000000000000")
RECORDS_PER_FILE = 4000
DATE = "1970-01-01T00:00:00Z"
_MAGIC, _VERSION = b"\x1f\x8b\x08", b"WARC/1."
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_LINE = re.compile(rb"WARC/1\.[01]\r\n")
BROKEN, CUT = "bad gzip member", "gzip member cut short"
READ_SCHEMA = ("path string, offset long, length long, reason string, record_type string, page_id long, uri string, "
               "refers_to long, payload_digest string, payload_bytes long, payload binary, inner_offset long, inner_length long")


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id, url: str | None, payload: bytes, digest: str, first, date: str = DATE) -> bytes:
    """One uncompressed record; ``first`` is the id of the response that it revisits, or None."""
    head = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    if first is not None:
        head += [f"WARC-Refers-To: {record_id(first)}", f"X-Refers-To-Page-Id: {first}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        payload = b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + payload + b"\r\n\r\n"


def member(raw: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def _parse(data: bytes, at: int, proof: bool = False) -> tuple[dict, bytes, int]:
    """The record that starts at ``at``: headers, block, end. Raises ValueError if a check fails, with ``proof`` also if
    there is no payload digest to check."""
    if not data.startswith(_VERSION, at):
        raise ValueError("no version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise ValueError("headers without end")
    head = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("bad header line")
        head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    size = head.get("content-length", "")
    if not size.isdigit():
        raise ValueError("no Content-Length")
    stop = end + 4 + int(size)
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise ValueError("block shorter or longer than Content-Length")
    block = data[end + 4:stop]
    if head.get("warc-type") != "revisit" and head.get("warc-payload-digest", "").startswith("sha256:"):
        if hashlib.sha256(block).hexdigest() != head["warc-payload-digest"][7:].lower():
            raise ValueError("payload digest differs")
    elif proof:
        raise ValueError("no payload digest to check in a broken member")
    return head, block, stop + 4


def _drained(z, piece) -> bytes:
    """What ``z`` makes of ``piece`` before it fails there."""
    out = []
    while len(piece) > 1:
        half, trial = piece[:len(piece) // 2], z.copy()
        try:
            out.append(trial.decompress(half))
        except zlib.error:
            piece = half
        else:
            z, piece = trial, piece[len(half):]
    try:
        while x := z.decompress(piece, 1):
            out.append(x)
            piece = z.unconsumed_tail
    except zlib.error:
        pass
    return b"".join(out)


def _inflate(data: bytes, at: int, window: int = 1 << 16) -> tuple[bytes, int, str]:
    """What the member at ``at`` holds, its end, and what is wrong with it; fed in windows, so that what follows is not copied
    for each member."""
    z, out, view = zlib.decompressobj(31), [], memoryview(data)
    while at < len(data) and not z.eof:
        # A failing call loses what it inflated: a copy from before it takes its place.
        before = z.copy()
        try:
            out.append(z.decompress(view[at:at + window]))
        except zlib.error:
            out.append(_drained(before, view[at:at + window]))
            return b"".join(out), len(data), BROKEN
        at += window
    if not z.eof:
        return b"".join(out), len(data), CUT
    return b"".join(out), min(at, len(data)) - len(z.unused_data), ""


def _inside(plain: bytes, bad: str) -> list[tuple]:
    """(headers, block) of the records in a member's inflated bytes and (reason, offset, length) of the gaps between them."""
    found, at, gap, why = [], 0, None, ""
    while at < len(plain):
        try:
            head, block, end = _parse(plain, at, bad == BROKEN)
            if bad == CUT and end == len(plain):
                raise ValueError(CUT)
        except ValueError as e:
            if gap is None:
                gap, why = at, str(e)
            nxt = _LINE.search(plain, at + 1)
            at = nxt.start() if nxt else len(plain)
            continue
        if gap is not None:
            found.append((why, gap, at - gap))
            gap = None
        found.append((head, block))
        at = end
    if gap is not None:
        found.append((why, gap, len(plain) - gap))
    return found


def _step(data: bytes, at: int) -> tuple[list[tuple], int, str]:
    """What the member or plain record at ``at`` gives (see _inside), where to go on, and what is wrong if it isn't whole or
    gives no record."""
    if not data.startswith(_MAGIC, at):
        try:
            head, block, end = _parse(data, at)
        except ValueError as e:
            return [], at + 1, str(e)
        return [(head, block)], end, ""
    plain, end, bad = _inflate(data, at)
    found = _inside(plain, bad)
    any_record = any(len(x) == 2 for x in found)
    if bad:
        return [*found, (bad, len(plain), None)] if any_record else [], at + 1, bad
    return (found, end, "") if any_record or not found else ([], end, found[0][0])


def _placed(found: list[tuple], at: int, length: int):
    for x in found:
        yield ("record", at, length, *x) if len(x) == 2 else ("gap", at, length, *x)


def salvage(data: bytes):
    """Yields ("record", offset, length, headers, block) and ("gap", offset, length, reason, inner offset, inner length), in
    order, covering all bytes. The inner values are None in a gap that covers its bytes as a whole; a member that is not
    whole reaches to the next that gives a record, and its records and gaps all have that offset and length."""
    at, gap, held = 0, None, []
    while at < len(data):
        found, go, bad = _step(data, at)
        if gap is not None and (found or not bad):
            yield from _placed(held, gap, at - gap)
            gap = None
        if not bad:
            yield from _placed(found, at, go - at)
            at = go
            continue
        if gap is None:
            gap, held = at, found or [(bad, None, None)]
        nxt = _START.search(data, go)
        at = nxt.start() if nxt else len(data)
    if gap is not None:
        yield from _placed(held, gap, len(data) - gap)


def _number(text: str | None):
    return int(text) if text and re.fullmatch(r"-?[0-9]+", text) else None


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the archives under ``path`` and, with record_type null, the quarantined gaps."""
    def run(batches):
        for b in batches:
            for p, data in zip(b.column("path"), b.column("content")):
                rows = []
                size = 0
                for kind, at, n, *rest in salvage(data.as_py()):
                    if kind == "gap":
                        rows.append((p.as_py(), at, n, rest[0], None, None, None, None, None, None, None, *rest[1:]))
                    else:
                        head, block = rest
                        revisit = head.get("warc-type") == "revisit"
                        digest = head.get("warc-payload-digest", "").removeprefix("sha256:") if revisit else hashlib.sha256(block).hexdigest()
                        rows.append((p.as_py(), at, n, None, head.get("warc-type"), _number(head.get("x-page-id")), head.get("warc-target-uri"),
                                     _number(head.get("x-refers-to-page-id")), digest,
                                     _number(head.get("x-payload-length")) if revisit else len(block), block if payloads else None, None, None))
                        size += len(block) if payloads else 0
                    if len(rows) >= 10_000 or size > 1 << 24:
                        yield pack(rows)
                        rows, size = [], 0
                if rows:
                    yield pack(rows)

    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(),
             pa.int64(), pa.int64()]
    names = [c.split()[0] for c in READ_SCHEMA.split(", ")]

    def pack(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(run, READ_SCHEMA)


def _member_batches(batches):
    for b in batches:
        out = []
        for i, url, html, digest, first in zip(*(b.column(c) for c in ("page_id", "url", "payload", "digest", "first"))):
            out.append(member(record(i.as_py(), url.as_py(), html.as_py(), digest.as_py(), first.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def write(pages: DataFrame, path: str) -> None:
    """Archive ``pages`` (page_id, url, html) under ``path``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # Counted before anything is shuffled; only payloads that occur again have a row.
    again = (rows.where(F.octet_length("payload") >= MIN_REVISIT).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    rows = salted_left_join(rows, again, ["digest"], F.col("page_id"))
    rows = rows.withColumn("first", F.when(F.col("page_id").isNull() | (F.col("first") != F.col("page_id")), F.col("first")))
    members = rows.mapInArrow(_member_batches, "value binary").select(F.col("value").cast("string").alias("value"))
    (members.write.option("lineSep", SEPARATOR.decode("latin-1")).option("encoding", "ISO-8859-1")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as WARC records, read the archives back, and return what the records say."""
    path = scratch_path(spark, "llm-warc")
    write(read_table(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    return read(spark, path, payloads=False).where("record_type is not null").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""
