"""WARC archives: writing segmented, chunked records and putting them together again."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.files import Attempt, place_of, shared_folder
from tidemark.operators.lookup import lookup_join
from tidemark.session import staged

# Bytes of a record's block after which it is continued in another record, of an HTTP chunk,
# and of an archive after which the next one begins.
SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
ARCHIVE_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"

_ARCHIVES = "name string, records long"
_RECORDS = (
    "origin string, segment long, total long, record_type string, record_id string, "
    "refers_to string, digest string, block binary"
)

_LOGICAL = (
    "record_id string, record_type string, refers_to string, page_id long, first_id long, "
    "digest string, payload binary, error string"
)


@dataclass(frozen=True)
class Archives:
    folder: str
    names: DataFrame


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_archives(
    pages: DataFrame,
    payload: Column,
    page_id: str = "page_id",
    url: str = "url",
    least_bytes: int = 0,
    folder: str | None = None,
    segment_bytes: int = SEGMENT_BYTES,
) -> Archives:
    """A record for every row; a payload met before (from ``least_bytes`` on) is a revisit.

    Of rows with equal payloads the one with the smallest id is the response (a null id is
    larger than all others, and of rows with one id one is chosen); revisits name it and carry
    no payload.  Payloads (null: empty) are framed as HTTP responses in chunks; a block longer
    than ``segment_bytes`` is continued in further records, which may be in later archives.
    A null url is empty; other columns are ignored; without pages there are no archives.
    """
    body = F.coalesce(payload.cast("binary"), F.lit("").cast("binary"))
    rows = staged(
        pages.select(
            F.col(page_id).cast("long").alias("page_id"),
            F.col(url).alias("url"),
            body.alias("body"),
            F.unhex(F.sha1(body)).alias("sha"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "pages",
    )
    counted = F.octet_length("body") >= least_bytes
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "row")
    repeated = (
        rows.where(counted)
        .groupBy("sha")
        .agg(F.min(order).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("sha", F.col("first.page_id").alias("first_id"), F.col("first.row").alias("first_row"))
    )
    revisit = counted & F.col("first_row").isNotNull() & (F.col("first_row") != F.col("row"))
    marked = lookup_join(rows, staged(repeated, "repeated"), ["sha"], "left", [F.col("row")])
    records = marked.select(
        "page_id",
        "url",
        "row",
        "sha",
        F.when(revisit, F.col("first_row")).alias("first_row"),
        F.when(revisit, F.col("first_id")).alias("first_id"),
        F.when(~revisit | F.col("first_row").isNull(), F.col("body")).alias("body"),
    )
    target = folder or shared_folder(pages.sparkSession, "archives")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _write(batches, target, segment_bytes)

    return Archives(target, staged(records.mapInArrow(run, _ARCHIVES), "archive-names"))


def _write(batches, folder: str, segment_bytes: int):
    part = TaskContext.get().partitionId()
    attempt, names, counts = Attempt(folder), [], []
    waiting = (r for batch in batches for row in batch.to_pylist() for r in _records(row, segment_bytes))
    record = next(waiting, None)
    while record is not None:
        name, size, count = f"{part}-{len(names)}.warc.gz", 0, 0
        with attempt.create(name) as stream:
            while record is not None and size < ARCHIVE_BYTES:
                member = gzip.compress(record, 1, mtime=0)  # each record can be read alone
                stream.write(member)
                size, count = size + len(member), count + 1
                record = next(waiting, None)
        names.append(name)
        counts.append(count)
    attempt.publish()
    yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string()), "records": pa.array(counts, pa.int64())})


def _records(row: dict, segment_bytes: int) -> Iterator[bytes]:
    """The record of a page and its continuations."""
    digest = base64.b32encode(row["sha"]).decode()
    head = [
        ("WARC-Record-ID", f"<urn:row:{row['row']}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", re.sub(r"[\r\n]", " ", row["url"] or "")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if row["page_id"] is not None:
        head.append(("Page-ID", str(row["page_id"])))
    if row["first_row"] is not None:
        head.append(("WARC-Refers-To", f"<urn:row:{row['first_row']}>"))
        if row["first_id"] is not None:
            head.append(("Refers-To-Page-ID", str(row["first_id"])))
        yield _record("revisit", head, b"HTTP/1.1 200 OK\r\n\r\n")
        return
    body = row["body"]
    framed = [b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nTransfer-Encoding: chunked\r\n\r\n"]
    for at in range(0, len(body), CHUNK_BYTES):
        chunk = body[at : at + CHUNK_BYTES]
        framed.append(b"%x\r\n%b\r\n" % (len(chunk), chunk))
    framed.append(b"0\r\n\r\n")
    block = b"".join(framed)
    if len(block) <= segment_bytes:
        yield _record("response", head, block)
        return
    cuts = range(0, len(block), segment_bytes)
    for number, at in enumerate(cuts, 1):
        part, last = block[at : at + segment_bytes], number == len(cuts)
        own = head if number == 1 else [("WARC-Record-ID", f"<urn:row:{row['row']}/{number}>"), ("WARC-Date", DATE)]
        own = [*own, ("WARC-Segment-Number", str(number))]
        if number > 1:
            own.append(("WARC-Segment-Origin-ID", f"<urn:row:{row['row']}>"))
        if last:
            own.append(("WARC-Segment-Total-Length", str(len(block))))
        yield _record("response" if number == 1 else "continuation", own, part)


def _record(kind: str, head: list[tuple[str, str]], block: bytes) -> bytes:
    fields = [("WARC-Type", kind), *head, ("Content-Length", str(len(block)))]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def read_archives(spark: SparkSession, archives: Archives) -> DataFrame:
    """The records of the archives in one pass over each, dealt one archive after the other.

    A segment of a record comes as it stands, with its ``block``.  Any other record is decoded
    where it is read: ``block`` is null, and there are the payload's ``bytes`` and ``sha``, or an
    ``error`` if it is not whole.  No archives, no rows.
    """
    folder, count = archives.folder, archives.names.count()
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                yield from _read(folder, name)

    # A number of its own: adaptive execution would merge tasks by the size of the names.
    dealt = archives.names.select("name").repartition(min(max(count, 1), most))
    return dealt.mapInArrow(run, f"{_RECORDS}, page_id long, first_id long, bytes long, sha binary, error string")


def _read(folder: str, name: str, rows: int = 500):
    system, path = place_of(f"{folder}/{name}")
    found: list[dict] = []
    with system.open_input_stream(path) as raw, gzip.open(raw) as plain:
        stream = io.BufferedReader(plain, 1 << 20)
        while start := stream.readline():
            if not start.strip():
                continue
            if not start.startswith(b"WARC/"):
                raise ValueError(f"{name}: no record where one should begin")
            head: dict[str, str] = {}
            while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
                field, _, value = line.decode().partition(":")
                head[field.strip().lower()] = value.strip()
            length = int(head["content-length"])
            block = stream.read(length)
            if len(block) != length:
                raise ValueError(f"{name}: a record ends early")
            row = _row(head, block)
            if "warc-segment-number" not in head:
                row |= _described(_logical([row], False)) | {"block": None}
            found.append(row)
            if len(found) == rows:
                yield _batch(found)
                found = []
    yield _batch(found)


def _row(head: dict[str, str], block: bytes) -> dict:
    number = lambda name: int(head[name]) if name in head else None
    record_id = head["warc-record-id"]
    return {
        "origin": head.get("warc-segment-origin-id", record_id),
        "segment": number("warc-segment-number") or 1,
        "total": number("warc-segment-total-length"),
        "record_type": head["warc-type"],
        "record_id": record_id,
        "refers_to": head.get("warc-refers-to"),
        "digest": head.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "block": block,
        "page_id": number("page-id"),
        "first_id": number("refers-to-page-id"),
    }


_ROW = pa.schema(
    [
        *[(name, pa.string()) for name in ("origin",)],
        ("segment", pa.int64()),
        ("total", pa.int64()),
        *[(name, pa.string()) for name in ("record_type", "record_id", "refers_to", "digest")],
        ("block", pa.binary()),
        ("page_id", pa.int64()),
        ("first_id", pa.int64()),
        ("bytes", pa.int64()),
        ("sha", pa.binary()),
        ("error", pa.string()),
    ]
)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ROW)


def reassemble(records: DataFrame) -> DataFrame:
    """One row per segmented record: segments put together, verified, and the payload decoded.

    Segments are dealt by the record they continue and read in order of their number, so a
    task holds one record at a time.  A gap, a missing or wrong total length, or broken chunks
    make ``error`` say so and the payload null; that goes for a first segment on its own too.
    """
    ordered = records.repartition("origin").sortWithinPartitions("origin", "segment")
    return ordered.mapInArrow(_reassemble, _LOGICAL)


def _reassemble(batches):
    held: list[dict] = []
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if held and held[0]["origin"] != row["origin"]:
                done.append(_logical(held, True))
                held = []
            held.append(row)
        yield _logical_batch(done)
    if held:
        yield _logical_batch([_logical(held, True)])


def _logical(parts: list[dict], segmented: bool) -> dict:
    first, block = parts[0], b"".join(p["block"] for p in parts)
    error, payload = None, None
    if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
        error = "segments are missing or repeated"
    elif segmented and parts[-1]["total"] != len(block):
        error = "total length differs"
    elif first["record_type"] == "response":
        try:
            payload = decode_http(block)
        except ValueError as wrong:
            error = str(wrong)
    keys = ("record_id", "record_type", "refers_to", "page_id", "first_id", "digest")
    return {k: first[k] for k in keys} | {"payload": payload, "error": error}


def _described(record: dict) -> dict:
    payload = record["payload"]
    if payload is None:
        return {"bytes": None, "sha": None, "error": record["error"]}
    return {"bytes": len(payload), "sha": hashlib.sha1(payload).digest(), "error": record["error"]}


def _logical_batch(rows: list[dict]) -> pa.RecordBatch:
    text = ("record_id", "record_type", "refers_to", "digest", "error")
    columns = {
        name: pa.array(
            [r[name] for r in rows],
            pa.string() if name in text else pa.binary() if name == "payload" else pa.int64(),
        )
        for name in ("record_id", "record_type", "refers_to", "page_id", "first_id", "digest", "payload", "error")
    }
    return pa.RecordBatch.from_pydict(columns)


def decode_http(block: bytes) -> bytes:
    """The body of an HTTP message; chunked framing is taken off."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("the HTTP header does not end")
    if not re.search(rb"(?im)^transfer-encoding:.*\bchunked\b", head):
        return body
    chunks, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("a chunk has no size")
        try:
            size = int(body[at:end].partition(b";")[0], 16)
        except ValueError:
            raise ValueError("a chunk size is no number") from None
        if size == 0:
            return b"".join(chunks)
        chunk = body[end + 2 : end + 2 + size]
        if len(chunk) != size or body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("a chunk ends early")
        chunks.append(chunk)
        at = end + 4 + size


def archived_pages(spark: SparkSession, archives: Archives) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` from the archives.

    Sizes and digests are those of the decoded payloads; a revisit has those of the response
    it names, however many name the same.  Any record that is not whole fails the read.  Null and
    repeated page ids are rows like others; archives without records give no rows.
    """
    read = staged(read_archives(spark, archives), "read")
    parts = reassemble(read.where("block IS NOT NULL").drop("bytes", "sha", "error"))
    names = ["record_id", "record_type", "refers_to", "page_id", "first_id", "bytes", "sha", "error"]
    joined = parts.withColumns(
        {"bytes": F.octet_length("payload").cast("long"), "sha": F.unhex(F.sha1("payload"))}
    )
    everything = read.where("block IS NULL").select(*names).unionAll(joined.select(*names))
    whole = F.when(F.col("error").isNull(), F.col("record_type"))
    failed = F.raise_error(F.concat("record_id", F.lit(": "), "error"))
    found = staged(everything.withColumn("record_type", whole.otherwise(failed)).drop("error"), "records")
    revisits = found.where("record_type = 'revisit'").drop("bytes", "sha")
    responses = found.where("record_type = 'response'")
    # Only responses that are named are looked up; names are reduced before they are shuffled.
    wanted = revisits.select(F.col("refers_to").alias("record_id")).distinct()
    named = responses.join(wanted, "record_id", "left_semi")
    named = staged(named.select(F.col("record_id").alias("refers_to"), "bytes", "sha"), "named")
    again = lookup_join(revisits, named, ["refers_to"], "left", [F.col("record_id")])
    both = responses.unionByName(again)
    return both.mapInArrow(
        _shown,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long",
    )


def _shown(batches):
    for batch in batches:
        digests = [None if s is None else base64.b32encode(s).decode() for s in batch.column("sha").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("bytes"),
                pa.array(digests, pa.string()),
                batch.column("record_type"),
                batch.column("first_id"),
            ],
            ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
        )
