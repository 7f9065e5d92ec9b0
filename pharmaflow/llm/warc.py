"""Op 6, WARC archives in Zstandard: one frame per record, dictionary first.

An archive is a skippable frame (0x184D2A5D) with the dictionary, then a Zstandard frame
for each record. The reader loads the dictionary from the leading frame, walks the
block headers to find where each frame ends, decodes one frame at a time and checks
version, required headers, lengths and the payload's digest; anything wrong raises.

Of equal payloads of at least ``min_payload`` bytes the one with the smallest page id is a
response, the others are revisit records that carry its id, digest and length but not
its bytes; smaller payloads are always responses.

Scale: digests are counted map-side, so a payload that a third of the pages share costs a
row per task, and only digests that repeat are joined back. Tasks write archives of about
``ARCHIVE`` bytes through Spark's file writer (a row is an archive, one row per file, committed
like any Spark output), so the folder may be on any file system that Spark reaches.
The row separator is an empty skippable frame, which readers pass over.
The dictionary comes from at most ``SAMPLE_PAGES`` pages of ``SAMPLE_CHARS`` characters.

Defined cases: NULL html is the empty payload; a NULL url leaves its header out; pages
that repeat the smallest id are all responses; payloads whose pages have no id at all are
responses; an empty table gives archives without records and an empty result; further
columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path
from .common import register, saved, table

ARCHIVE = 16 << 20  # bytes after which a task begins a new archive
MIN_PAYLOAD = 100
SAMPLE_PAGES, SAMPLE_CHARS, DICT_BYTES = 200, 20_000, 16_384
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the WARC 1.1 and Zstandard formats.
VERSION = b"WARC/1.1"
DICT_MAGIC, SKIP_MAGICS, FRAME_MAGIC = 0x184D2A5D, range(0x184D2A50, 0x184D2A60), 0xFD2FB528
EMPTY_FRAME = "P*M\x18\0\0\0\0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id: str | None, url: str | None, payload: bytes, digest: str, length: int, refers_to: str | None) -> bytes:
    """A WARC record; ``refers_to`` makes it a revisit without the payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", "".join(c if "!" <= c != "\x7f" else quote(c) for c in url)))
    if refers_to is None:
        block += payload
    else:
        head += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    head += [("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(length)),
             ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in head) + b"\r\n" + block + b"\r\n\r\n"


def skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


def frame_end(data, at: int) -> int:
    """Where the Zstandard frame at ``at`` ends, from its block headers."""
    head = bytes(data[at:at + 18])
    params = zstandard.get_frame_parameters(head)
    at += zstandard.frame_header_size(head)
    while True:
        if at + 3 > len(data):
            raise ValueError("archive ends inside a frame")
        h = int.from_bytes(data[at:at + 3], "little")
        at += 3 + (1 if (h >> 1) & 3 == 1 else h >> 3)
        if h & 1:
            break
    at += 4 if params.has_checksum else 0
    if at > len(data):
        raise ValueError("archive ends inside a frame")
    return at


def records(data: bytes):
    """The decoded records of an archive."""
    view, at, reader = memoryview(data), 0, None
    while at < len(view):
        if at + 8 > len(view):
            raise ValueError("archive ends inside a frame header")
        magic, size = struct.unpack_from("<II", view, at)
        if magic in SKIP_MAGICS:
            if at == 0 and magic == DICT_MAGIC:
                content = bytes(view[8:8 + size])
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content)) if content \
                    else zstandard.ZstdDecompressor()
            at += 8 + size
            continue
        if magic != FRAME_MAGIC or reader is None:
            raise ValueError("not a record frame" if reader else "no dictionary frame at the start")
        end = frame_end(view, at)
        yield reader.decompress(bytes(view[at:end]))
        at = end


def parse(rec: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record, checked."""
    head, found, rest = rec.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not found or lines[0].encode() != VERSION:
        raise ValueError("bad version line")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    missing = {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length", "WARC-Payload-Digest", "X-Payload-Length"} - headers.keys()
    if missing or len(headers) != len(lines) - 1:
        raise ValueError(f"headers missing or repeated: {sorted(missing)}")
    n = int(headers["Content-Length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError("Content-Length differs from the block")
    payload = rest[:n].partition(b"\r\n\r\n")[2]
    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response":
        if len(payload) != int(headers["X-Payload-Length"]) or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"payload of {headers['WARC-Record-ID']} differs from its digest or length")
    elif kind != "revisit" or "WARC-Refers-To" not in headers or payload:
        raise ValueError(f"bad {kind} record {headers['WARC-Record-ID']}")
    return headers, payload


def dictionary(pages: DataFrame, html_col: str = "html") -> bytes:
    """Trained on a bounded sample; empty where there is too little to learn from."""
    rows = pages.where(F.length(html_col) > 0).select(F.substring(html_col, 1, SAMPLE_CHARS)).limit(SAMPLE_PAGES).collect()
    samples = [r[0].encode() for r in rows]
    if len(samples) < 16:
        return b""
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, sum(map(len, samples)) // 4), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _archives(words: bytes, size: int):
    def run(batches):
        data = zstandard.ZstdCompressionDict(words) if words else None
        writer = zstandard.ZstdCompressor(level=3, dict_data=data, write_checksum=True)
        start = skippable(DICT_MAGIC, words)
        out, room = [start], len(start)
        for b in batches:
            cols = [b.column(c) for c in ("id", "url", "payload", "digest", "n", "refers")]
            for row in zip(*cols):
                frame = writer.compress(record(*(x.as_py() for x in row)))
                out.append(frame)
                room += len(frame)
                if room >= size:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(out)], pa.binary())], ["archive"])
                    out, room = [start], len(start)
        if len(out) > 1:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(out)], pa.binary())], ["archive"])
    return run


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_payload: int = MIN_PAYLOAD, archive: int = ARCHIVE) -> None:
    """Write ``pages`` as archives to the new folder ``path``."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    d = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"),
                     F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("n"))
    same = saved(d.where(F.col("n") >= min_payload).groupBy("digest").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("k")).where("k > 1").select("digest", "first"), "warc-same")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    d = d.join(same, "digest", "left").select(
        F.col("id").cast("string").alias("id"), "url", F.when(revisit, F.lit(b"")).otherwise(F.col("payload")).alias("payload"),
        "digest", "n", F.when(revisit, F.col("first").cast("string")).alias("refers"))
    rows = d.mapInArrow(_archives(dictionary(pages, html_col), archive), "archive binary")
    # the text writer puts a string's bytes out as they are
    (rows.select(F.col("archive").cast("string").alias("value")).write
     .option("maxRecordsPerFile", 1).option("lineSep", EMPTY_FRAME).text(path))


def _parsed(batches):
    for b in batches:
        for data in b.column("content"):
            rows, room = [], 0
            for rec in records(data.as_buffer().to_pybytes()):
                h, body = parse(rec)
                name = lambda k: h[k].removeprefix("<urn:page:").removesuffix(">") if k in h else None
                rows.append((name("WARC-Record-ID") or None, h.get("WARC-Target-URI"), h["WARC-Type"], int(h["X-Payload-Length"]),
                             h["WARC-Payload-Digest"].removeprefix("sha256:"), name("WARC-Refers-To"), body))
                room += len(body)
                if room >= ARCHIVE:
                    yield _batch(rows)
                    rows, room = [], 0
            if rows:
                yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary())
    names = ["id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(id, url, record_type, payload_bytes, payload_digest, refers_to, payload) of
    every record; a revisit's payload is empty."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(_parsed, "id string, url string, record_type string, payload_bytes long, payload_digest string, "
                                     "refers_to string, payload binary")


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS n, sha256(h) AS digest FROM p),
g AS (SELECT digest, min(page_id) AS first FROM d WHERE n >= {MIN_PAYLOAD} GROUP BY digest)
SELECT d.page_id, n AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN first IS NULL OR d.page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN d.page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM d LEFT JOIN g USING (digest)
"""


@register("op6_warc", SQL)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the archives."""
    path = scratch_path(spark, f"warc-{uuid.uuid4().hex[:12]}")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).select(
        F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))
