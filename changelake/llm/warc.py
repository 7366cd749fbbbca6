"""WARC archives: written from pages, read back, and assembled into one nested row per capture.

Every page becomes three records: a request, a response (or a revisit, if a page with a smaller page_id has the same
payload) and a metadata record. Response, revisit and metadata name the request's record in WARC-Concurrent-To. Reading
parses and checks every record on its own and joins the records of a capture by that identifier, so a capture may be
spread over archives. Archives are gzip members one after another, one per record, in rows of a Parquet table in the
shared folder, which Spark's committer writes whole or not at all.

Defined results: null html is the empty payload, null url an empty one; pages with a null page_id rank behind all others
of the same payload and, without any other, are responses; repeated rows are captures of their own, and each row that
has the smallest page_id of its payload is a response; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, sized, tune, written

ARCHIVE_BYTES = 4 << 20
#: An archive is inflated in pieces of this size.
FEED = 1 << 13
LEVEL = 4
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "archive string, record_id string, capture_id string, type string, target_uri string, date string, payload_digest string, payload_bytes long, refers_to_id string, page_id long, refers_to long, payload binary"


class Damaged(ValueError):
    """A record breaks the format, or a digest is wrong."""


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(repr(parts).encode()).digest())}>"


def record(kind: str, rid: str, block: bytes, content_type: str, extra: list[tuple[str, str]]) -> bytes:
    """One gzip member that holds one WARC/1.1 record."""
    fields = [("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Date", DATE), *extra, ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Type", content_type), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v) + "\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def records(page_id, url, html: bytes, first, unique) -> bytes:
    """The three records of a capture; first is the page_id of the response if this page revisits it."""
    uri = "".join(c for c in url or "" if c > " ")
    host, _, path = uri.partition("//")[2].partition("/")
    request, sha = record_id("request", unique, page_id), digest(html)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n".encode()
    common = [("WARC-Target-URI", uri), ("WARC-Concurrent-To", request)]
    out = [record("request", request, f"GET /{path.partition('#')[0]} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode(), "application/http;msgtype=request", common[:1])]
    if first is None:
        out.append(record("response", record_id("response", page_id, sha), head + html, "application/http;msgtype=response", [*common, ("WARC-Payload-Digest", f"sha1:{sha}")]))
    else:
        out.append(record("revisit", record_id("revisit", unique, page_id), head, "application/http;msgtype=response", [*common, ("WARC-Payload-Digest", f"sha1:{sha}"), ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id("response", first, sha))]))
    about = "".join(f"{k}: {v}\r\n" for k, v in (("pageId", page_id), ("refersTo", first)) if v is not None)
    out.append(record("metadata", record_id("metadata", unique, page_id), about.encode(), "application/warc-fields", common))
    return b"".join(out)


def members(archive: bytes, name: str):
    """The gzip members of an archive, inflated. zlib copies what it was given beyond a member's end, so it gets small pieces:
    with all the rest of the archive each time, the copies would grow with the square of the archive's size."""
    rest, at = memoryview(archive), 0
    while at < len(rest):
        inflate, out = zlib.decompressobj(31), []
        while not inflate.eof:
            piece = rest[at : at + FEED]
            if not piece:
                raise Damaged(f"{name} ends inside a record")
            out.append(inflate.decompress(piece))
            at += len(piece) - len(inflate.unused_data)
        yield b"".join(out)


def parse(archive: bytes, name: str, with_payload: bool):
    """The records of an archive as tuples of RECORD; digests and lengths are verified."""
    for data in members(archive, name):
        head, _, body = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/1."):
            raise Damaged(f"{name} holds something else than WARC records")
        f = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        block = body[: int(f["content-length"])]
        if len(block) != int(f["content-length"]) or f.get("warc-block-digest", "").removeprefix("sha1:") not in ("", digest(block)):
            raise Damaged(f"a block of {name} is damaged")
        kind, payload, size, page, first = f["warc-type"], None, None, None, None
        if kind in ("response", "revisit"):
            http, _, payload = block.partition(b"\r\n\r\n")
            if kind == "response":
                size = len(payload)
                if f["warc-payload-digest"] != f"sha1:{digest(payload)}":
                    raise Damaged(f"a payload of {name} is damaged")
            else:
                size = int(next(x for x in http.decode().split("\r\n") if x.lower().startswith("content-length:")).partition(":")[2])
                payload = None
        elif kind == "metadata":
            about = dict(x.split(": ", 1) for x in block.decode().split("\r\n") if ": " in x)
            page, first = (int(about[k]) if k in about else None for k in ("pageId", "refersTo"))
        rid = f["warc-record-id"]
        yield (name, rid, f.get("warc-concurrent-to", rid), kind, f.get("warc-target-uri"), f["warc-date"], f.get("warc-payload-digest", "").removeprefix("sha1:") or None, size, f.get("warc-refers-to"), page, first, payload if with_payload else None)


def write(pages: DataFrame, out: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Writes the archives: a table of archive (its name) and data. Payloads under least_bytes are never revisits."""
    spark = pages.sparkSession
    tune(spark)
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html).alias("sha"), F.octet_length(html).alias("n"))
    first = rows.where(F.col("n") >= least_bytes).groupBy("sha", "n").agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    first = written(first, "revisits")
    rows = rows.join(sized(first, 64), ["sha", "n"], "left")
    revisits = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    rows = rows.select("page_id", "url", "html", revisits.alias("first"))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, k, held, size = TaskContext.get().partitionId(), 0, [], 0

        def done():
            return pa.RecordBatch.from_arrays([pa.array([f"pages-{part:06d}-{k:05d}.warc.gz"]), pa.array([b"".join(held)], pa.binary())], names=["archive", "data"])

        nth = 0
        for batch in batches:
            for page_id, url, body, to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(records(page_id, url, body, to, (part, nth)))
                size += len(held[-1])
                nth += 1
                if size >= ARCHIVE_BYTES:
                    yield done()
                    k, held, size = k + 1, [], 0
        if held:
            yield done()

    return written(rows.mapInArrow(lean(run), "archive string, data binary"), "warc", out)


def read(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the archives."""
    tune(archives.sparkSession)

    def run(batches):
        import pyarrow as pa

        names = [f.split()[0] for f in RECORD.split(", ")]
        kinds = [pa.binary() if "binary" in f else pa.int64() if "long" in f else pa.string() for f in RECORD.split(", ")]
        for batch in batches:
            for name, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held, size = [], 0
                for r in parse(data, name, with_payload):
                    held.append(r)
                    size += len(r[-1] or b"") + 500
                    if size > 2 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)

    return archives.select("archive", "data").mapInArrow(lean(run), RECORD)


def captures(found: DataFrame) -> DataFrame:
    """One nested row per capture: its request, its response or revisit, and its metadata."""
    def of(*kinds, fields):
        return F.max(F.when(F.col("type").isin(*kinds), F.struct(*fields)))

    return found.groupBy("capture_id").agg(
        of("request", fields=["record_id", "target_uri", "date", "archive"]).alias("request"),
        of("response", "revisit", fields=["record_id", "type", "target_uri", "date", "payload_digest", "payload_bytes", "refers_to_id", "archive", "payload"]).alias("response"),
        of("metadata", fields=["record_id", "page_id", "refers_to", "archive"]).alias("metadata"),
    )


def op10_warc_captures(spark, sf_dir: str) -> DataFrame:
    found = captures(read(write(spark.read.parquet(f"{sf_dir}/pages.parquet")), with_payload=False))
    return found.select("metadata.page_id", "response.payload_bytes", "response.payload_digest", F.col("response.type").alias("record_type"), "metadata.refers_to")
