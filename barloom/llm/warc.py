"""WARC archives: a writer of one gzip member per record, and a splittable reader.

The reader's tasks get byte ranges. A task looks for the magic bytes of a gzip member
from the start of its range, takes a candidate for a record only if it decodes to a WARC
header, and owns the records whose first byte lies in its range; it reads beyond the end
of the range to finish the last one. No index and no common file cursor is needed.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import map_arrow, materialize, named, slices

#: A task begins another file after so many bytes.
FILE_BYTES = 256 << 20
READ_BYTES = 1 << 20
#: Compressed bytes given to the decoder at once.
FEED_BYTES = 1 << 14
#: A header longer than this is none.
HEADER_BYTES = 1 << 20
MAX_TASKS = 20_000

# The format's names.
_MAGIC = b"\x1f\x8b\x08"
_VERSION = "WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Headers of this writer: the page of a record, and the page whose record it refers to.
_PAGE_ID = "X-Page-ID"
_REFERS_PAGE = "X-Refers-To-Page-ID"


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """The store and the path of a folder or file, by its URI."""
    if uri.startswith("s3a://"):
        uri = "s3://" + uri[6:]
    return fs.FileSystem.from_uri(uri)


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _record_id(page_id: int | None, digest: str, target: str | None) -> str:
    """The id of the response of a page and payload, or of a revisit, which has a target too."""
    name = f"{page_id}/{digest}" + (f"/{target}" if target is not None else "")
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """One record as a gzip member; ``first`` is the page that a revisit refers to."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if first is None else b"")
    kind = "response" if first is None else "revisit"
    target = urllib.parse.quote(url or "", safe=":/?#[]@!$&'()*+,;=%~")
    lines = [
        _VERSION,
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_record_id(page_id, digest, None if first is None else target)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"{_PAGE_ID}: {page_id}")
    if first is not None:
        refers = [f"WARC-Refers-To: {_record_id(first, digest, None)}", f"{_REFERS_PAGE}: {first}"]
        lines += [*refers, f"WARC-Profile: {_PROFILE}"]
    header = "\r\n".join(lines) + "\r\n\r\n"
    return gzip.compress(header.encode() + block + b"\r\n\r\n", compresslevel=6, mtime=0)


def write_warc(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 0,
) -> DataFrame:
    """Write a record per row below ``folder``; the files made, as (path, bytes).

    Of rows with equal payloads of at least ``least_bytes`` bytes the smallest id is a
    response and the others revisit it. A null payload is empty. Rows without an id, and
    rows that repeat the smallest id, are responses if no other row can be referred to.
    Extra columns are not read. A file is named by its attempt and counts only once its
    task has ended, so attempts that are lost or run twice leave nothing behind that a
    reader of the returned table would see.
    """
    rows = pages.select(
        named(id_col).cast("long").alias("page_id"),
        named(url_col).cast("string").alias("url"),
        F.coalesce(named(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    # Partial minima first, so that a payload of a third of all rows is no burden.
    firsts = (
        rows.where(F.length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    first = F.when(F.col("first").eqNullSafe(F.col("page_id")), None).otherwise(F.col("first"))
    laid = rows.join(firsts, "digest", "left").select(
        "page_id", "payload", "url", "digest", first.alias("first")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        task = TaskContext.get()
        made: list[tuple[str, int]] = []
        out = None
        for batch in slices(batches):
            for page, payload, url, digest, before in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"part-{task.partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    out, size = store.open_output_stream(f"{base}/{name}", compression=None), 0
                member = _record(page, url, payload, base32(digest), before)
                out.write(member)
                size += len(member)
                if size >= FILE_BYTES:
                    out.close()
                    made.append((f"{folder}/{name}", size))
                    out = None
        if out is not None:
            out.close()
            made.append((f"{folder}/{name}", size))
        yield pa.RecordBatch.from_arrays(
            [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())],
            names=["path", "bytes"],
        )

    return materialize(map_arrow(laid, run, "path string, bytes long"), "warc-files")


def list_warc(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes) of archives by a path or glob; contents are not read."""
    found = spark.read.format("binaryFile").load(path)
    return found.select("path", F.col("length").alias("bytes"))


def _records(store: fs.FileSystem, path: str, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, decoded record) of the records that begin in [start, end).

    Bytes of the file are read once, but for those behind a member that is no record.
    """
    with store.open_input_file(path) as file:
        size = file.size()

        def read(position: int) -> bytes:
            if position >= size:
                return b""
            file.seek(position)
            return file.read(min(READ_BYTES, size - position))

        # The buffer holds the file from ``base`` on, and is searched from ``at`` on.
        base, buffer, at = start, b"", 0
        while base + at < end:
            found = buffer.find(_MAGIC, at)
            if found < 0:
                # The last bytes may begin a magic that the next read completes.
                keep = max(at, len(buffer) - len(_MAGIC) + 1)
                following = read(base + len(buffer))
                if not following:
                    break
                base, buffer, at = base + keep, buffer[keep:] + following, 0
                continue
            if base + found >= end:
                break
            record, after, last, rest = _member(buffer, found, base, read)
            if record is None:
                at = found + 1
                continue
            yield base + found, record
            base, buffer, at = last, rest, after - last


def _member(
    buffer: bytes, at: int, base: int, read: Callable[[int], bytes]
) -> tuple[bytes | None, int, int, bytes]:
    """The record of the gzip member at ``at`` of ``buffer``, or None if it is none.

    With it come the place in the file behind the member, and the last bytes read of the
    file with their place.
    """
    decoder, parts, head, valid = zlib.decompressobj(31), [], b"", False
    place, none = base + at, (None, 0, 0, b"")
    while True:
        view = memoryview(buffer)
        for begin in range(at, len(view), FEED_BYTES):
            fed = view[begin : begin + FEED_BYTES]
            try:
                data = decoder.decompress(fed)
            except zlib.error:
                return none
            place += len(fed)
            parts.append(data)
            if not valid:
                head += data
                if not head.startswith(b"WARC/"[: len(head)]):
                    return none
                valid = b"\r\n\r\n" in head
                if not valid and len(head) > HEADER_BYTES:
                    return none
            if decoder.eof:
                record = b"".join(parts) if valid else None
                return record, place - len(decoder.unused_data), base, buffer
        base, at = base + len(buffer), 0
        buffer = read(base)
        if not buffer:
            return none


def _parsed(record: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """WARC headers by lower-case name, the HTTP header, the payload."""
    head, _, rest = record.partition(b"\r\n\r\n")
    headers = {}
    for line in head.decode(errors="replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        headers[name.strip().lower()] = value.strip()
    block = rest[: int(headers.get("content-length") or 0)]
    http, _, payload = block.partition(b"\r\n\r\n")
    return headers, http, payload


def _number(text: str | None) -> int | None:
    return int(text) if text and text.lstrip("-").isdigit() else None


_ROW = (
    "path string, offset long, record_type string, page_id long, refers_to long, url string, "
    "payload_bytes long, payload_digest string, intact boolean, record_id string, refers_to_record string"
)


def read_warc(files: DataFrame, split_bytes: int | None = None, payload: bool = False) -> DataFrame:
    """Records of archives given as (path, bytes), read in ranges of ``split_bytes``.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload, also for
    revisits, whose payload is not stored; ``intact`` tells whether a stored payload has
    the digest that its header names. ``record_id`` and ``refers_to_record`` are the ids that
    the headers give; ``page_id`` and ``refers_to`` are null in archives of other writers.
    With ``payload`` the bytes follow as ``payload``
    (null for revisits). Without ``split_bytes`` Spark's own split size is used. Bytes
    that belong to no valid record are passed over.
    """
    spark = files.sparkSession
    if split_bytes is None:
        given = spark.conf.get("spark.sql.files.maxPartitionBytes")
        split_bytes = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(given))
    ranges = files.where("bytes > 0").select(
        "path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes))).alias("start")
    )
    tasks = max(1, min(MAX_TASKS, ranges.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                store, local = _open(path)
                rows, held = [], 0
                for offset, record in _records(store, local, start, min(start + split_bytes, size)):
                    headers, http, body = _parsed(record)
                    revisit = headers.get("warc-type") == "revisit"
                    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
                    length = len(body)
                    if revisit:
                        fields = [h.partition(":") for h in http.decode(errors="replace").lower().split("\r\n")]
                        length = next((int(v) for k, _, v in fields if k == "content-length"), 0)
                    intact = revisit or base64.b32encode(hashlib.sha1(body).digest()).decode() == digest
                    rows.append(
                        (
                            path,
                            offset,
                            headers.get("warc-type"),
                            _number(headers.get(_PAGE_ID.lower())),
                            _number(headers.get(_REFERS_PAGE.lower())),
                            headers.get("warc-target-uri"),
                            length,
                            digest,
                            intact,
                            headers.get("warc-record-id"),
                            headers.get("warc-refers-to"),
                            *([None if revisit else body] if payload else []),
                        )
                    )
                    held += len(body) if payload else 256
                    if held >= 8 << 20:
                        yield _batch(rows, payload)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, payload)

    spread = ranges.repartition(tasks)
    return map_arrow(spread, run, _ROW + (", payload binary" if payload else ""))


def _batch(rows: list[tuple], payload: bool) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.bool_()]
    kinds += [pa.string(), pa.string()]
    kinds += [pa.binary()] * payload
    names = [c.split()[0] for c in _ROW.split(", ")] + ["payload"] * payload
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
