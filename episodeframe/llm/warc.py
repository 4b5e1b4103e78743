"""WARC archives: one gzip member per record, written and read by Spark tasks.

The reader is splittable although gzip is not: a task gets a byte range, looks
for the gzip magic, takes a candidate for a record only if it decodes to a WARC
header, and owns the records that start inside its range.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodeframe.llm.common import cut_lineage, shared_path

MAGIC = b"\x1f\x8b\x08"
_HEAD = 1 << 16  # most bytes of a member decoded to see its header
_CHUNK = 1 << 20
_SPACE = re.compile(r"[\x00-\x20\x7f]")
_FILES = "path string, bytes long, records long"
_RECORDS = ("path string, at long, page_id long, url string, record_type string, refers_to long, payload binary, "
            "payload_bytes long, payload_digest string")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, revisit: bool,
                 refers_to: int | None) -> bytes:
    """One uncompressed WARC/1.1 record; a revisit has no payload of its own."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    target = _SPACE.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else None
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{uuid.uuid4().urn}>",
             "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http;msgtype=response",
             f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    lines += [f"X-Page-Id: {page_id}"] if page_id is not None else []
    lines += [f"WARC-Target-URI: {target}"] if target is not None else []
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        lines += [f"X-Refers-To-Page-Id: {refers_to}"] if refers_to is not None else []
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  least_bytes: int = 0, broadcast_rows: int = 200_000) -> DataFrame:
    """(page_id, url, payload, revisit, refers_to): of equal payloads of at
    least ``least_bytes`` the rows with the smallest id are responses, all
    others revisit them.  Only payloads that occur more than once are joined;
    up to ``broadcast_rows`` of them are broadcast, more are joined by digest."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.unhex(F.sha1("payload"))).withColumn("n", F.octet_length("payload"))
    first = cut_lineage(rows.where(F.col("n") >= least_bytes).groupBy(F.col("sha").alias("s"), F.col("n").alias("m"))
                        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1"))
    few = F.broadcast(first) if first.count() <= broadcast_rows else first
    out = rows.join(few, (F.col("sha") == F.col("s")) & (F.col("n") == F.col("m")), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return out.select("page_id", "url", "payload", revisit.alias("revisit"),
                      F.when(revisit, F.col("first")).alias("refers_to"))


def write(records: DataFrame, folder: str) -> DataFrame:
    """Write (page_id, url, payload, revisit, refers_to) as ``.warc.gz`` files
    below ``folder`` (a URI that all executors reach), one per task; returns the
    stored manifest (path, bytes, records).  Names are unique per attempt and
    only finished attempts are listed, so a repeated task leaves no double."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, n, size = None, f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
        for batch in batches:
            for page_id, url, payload, revisit, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    fs, name = _open(path)
                    fs.create_dir(name.rpartition("/")[0], recursive=True)
                    out = fs.open_output_stream(name, compression=None)
                member = gzip_member(record_bytes(page_id, url, payload, base32_sha1(payload), revisit, refers_to))
                out.write(member)
                n, size = n + 1, size + len(member)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [n]})

    return cut_lineage(records.select("page_id", "url", "payload", "revisit", "refers_to").mapInArrow(run, _FILES))


class _Window:
    """Bytes of a file from a moving start, read in chunks as they are needed."""

    def __init__(self, file, size: int):
        self.file, self.size, self.low, self.data = file, size, 0, b""

    def get(self, at: int, n: int) -> bytes:
        n = max(0, min(n, self.size - at))
        if at < self.low or at + n > self.low + len(self.data):
            self.file.seek(at)
            self.low, self.data = at, self.file.read(min(max(n, _CHUNK), self.size - at))
        return self.data[at - self.low:at - self.low + n]


def _header_at(window: _Window, at: int) -> bool:
    """Whether the bytes decode as a gzip member that begins a WARC record."""
    try:
        d = zlib.decompressobj(31)
        return d.decompress(window.get(at, 4096), 16).startswith(b"WARC/1.")
    except zlib.error:
        return False


def _member(window: _Window, at: int) -> tuple[bytes, int] | None:
    """Decoded member and the place behind it; None if it is broken."""
    d, parts, here = zlib.decompressobj(31), [], at
    try:
        while not d.eof:
            part = window.get(here, _HEAD)
            if not part:
                return None
            parts.append(d.decompress(part))
            here += len(part)
    except zlib.error:
        return None
    return b"".join(parts), here - len(d.unused_data)


def parse(record: bytes) -> dict | None:
    """Fields of a decoded record; None unless it is whole."""
    head, sep, rest = record.partition(b"\r\n\r\n")
    if not sep or not head.startswith(b"WARC/1."):
        return None
    lines = dict(x.split(": ", 1) for x in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in x)
    h = {k.lower(): v for k, v in lines.items()}
    n = int(h.get("content-length", -1))
    if n < 0 or rest[n:n + 4] != b"\r\n\r\n":
        return None
    kind, block = h.get("warc-type"), rest[:n]
    number = lambda k: int(h[k]) if k in h else None
    out = {"page_id": number("x-page-id"), "url": h.get("warc-target-uri"), "record_type": kind,
           "refers_to": number("x-refers-to-page-id"), "payload": None, "payload_bytes": number("x-payload-length"),
           "payload_digest": h.get("warc-payload-digest", "sha1:").removeprefix("sha1:")}
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        digest = base32_sha1(payload)
        if out["payload_digest"] and out["payload_digest"] != digest:
            raise ValueError(f"payload of page {out['page_id']} does not match its digest")
        out |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": digest}
    return out


def records_in(path: str, low: int, high: int) -> Iterator[dict]:
    """Records of a file that start in bytes [low, high)."""
    fs, name = _open(path)
    with fs.open_input_file(name) as file:
        window, at = _Window(file, file.size()), low
        high = min(high, window.size)
        while at < high:
            # a member may begin just below ``high`` with its magic across it
            near = window.get(at, min(_CHUNK, high - at) + len(MAGIC) - 1)
            k = near.find(MAGIC)
            if k < 0 or at + k >= high:
                if at + len(near) >= high or not near:
                    return
                at += max(1, len(near) - len(MAGIC) + 1)
                continue
            at += k
            found = _member(window, at) if _header_at(window, at) else None
            fields = parse(found[0]) if found else None
            if fields is None:
                at += 1  # the magic by chance, or a broken member
                continue
            yield {"path": path, "at": at, **fields}
            at = found[1]


def read(files: DataFrame, split_bytes: int = 8 << 20) -> DataFrame:
    """Records of the archives in ``files`` (path, bytes), one task per byte
    range: path, ``at`` (its first byte), page_id, url, record_type, refers_to,
    payload (null for a revisit), payload_bytes, payload_digest.

    Every record is read exactly once, by the range in which it starts.  Empty
    files give none; ranges without a record give none; broken members and
    bytes that are no member are skipped; a payload that does not match its
    digest is an error.
    """
    ranges = (files.where("bytes > 0").select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1,
                                                                           F.lit(split_bytes).cast("long"))).alias("low")))
    # a fixed number of tasks: by their few bytes the ranges would all be merged into one
    tasks = files.agg(F.coalesce(F.sum(F.ceil(F.col("bytes") / split_bytes)), F.lit(1))).first()[0]
    ranges = ranges.repartition(max(1, tasks)).select("path", "low", (F.col("low") + split_bytes).alias("high"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("at", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
        for batch in batches:
            for path, low, high in zip(*(c.to_pylist() for c in batch.columns)):
                rows, size = [], 0
                for r in records_in(path, low, high):
                    rows.append(r)
                    size += len(r["payload"] or b"") + 200
                    if size > 16 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return ranges.mapInArrow(run, _RECORDS)


def archive(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
            payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write one record per row of ``pages`` and return the manifest.

    The payload is the text in UTF-8 (null: empty).  Null urls give records
    without a target, null ids records without an id, which revisit the
    smallest id of an equal payload; rows that repeat the smallest id are all
    responses; an empty table writes no file.  Control characters and blanks
    of a url are percent-encoded.  ``folder`` defaults to one in the shared
    checkpoint folder; other columns are not read.
    """
    folder = folder or shared_path(pages.sparkSession, "warc")
    if "://" not in folder:
        folder = re.sub(r"^file:/*", "/", folder) if folder.startswith("file:") else folder
    return write(with_revisits(pages, id_col, url_col, payload_col, least_bytes), folder)
