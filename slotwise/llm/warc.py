"""WARC archives: one gzip member per record, written by tasks and read back in sequence.

A task writes its records to archives of bounded size in a shared folder, through
`pyarrow.fs`, so any store that it knows will do. The written paths come back as rows
and are kept in a table: archives of lost or repeated attempts are not in it and are
never read. The reader holds one compressed block and one record at a time: it inflates
member by member, frames each block by Content-Length and checks both digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from slotwise.llm.common import written
from slotwise.session import new_work_dir

# Payloads below this many bytes are always stored whole.
REVISIT_BYTES = 1000
# A new archive begins once this many compressed bytes are written.
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 16
LEVEL = 3

HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def plan_records(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, payload, digest, refers_to, revisit) to be written.

    Of pages with equal payloads of at least `REVISIT_BYTES` those with the largest
    page_id are responses, the others revisit it. Null ids are smaller than any other
    and are never referred to: a group without any id is all responses.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    )
    # Equal payloads are told by their SHA-256; short ones get no key and meet nobody.
    long_enough = F.octet_length("payload") >= REVISIT_BYTES
    rows = rows.withColumn("key", F.when(long_enough, F.sha2("payload", 256)))
    first = rows.filter(F.col("key").isNotNull()).groupBy("key").agg(F.max("page_id").alias("last_id"), F.count(F.lit(1)).alias("n"))
    # Only groups with a copy in them need to be known to their pages.
    first = first.filter("n > 1").select("key", "last_id")
    revisit = F.col("last_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last_id"))
    return rows.join(first, "key", "left").select(
        "page_id", "url", "payload", F.sha1("payload").alias("digest"),
        F.when(revisit, F.col("last_id")).alias("refers_to"), revisit.alias("revisit"),
    )


def _b32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """The bytes of one uncompressed record."""
    block = HTTP_HEAD if revisit else HTTP_HEAD + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
    ]
    if url:
        # A line break in an address must not begin a header of its own.
        clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {clean}")
    if revisit:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += [
        f"WARC-Payload-Digest: sha1:{_b32(digest)}",
        f"WARC-Block-Digest: sha1:{_b32(hashlib.sha1(block).hexdigest())}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the planned records below ``folder`` (a URI); rows (path, records, bytes)."""

    def write(batches):
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, path, count, size = None, "", 0, 0

        def closed():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [count], "bytes": [size]}, schema)

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to", "revisit")]
            for i in range(batch.num_rows):
                if out is None:
                    path, count, size = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(path, compression=None)  # members are compressed here
                squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = squeeze.compress(record(*(c[i].as_py() for c in columns))) + squeeze.flush()
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    schema = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
    return written(records.mapInArrow(write, "path string, records long, bytes long"), "warc-archives")


def inflated(stream, read_bytes: int = READ_BYTES):
    """Yield (piece, is_end_of_member) of a file of gzip members."""
    member, begun = zlib.decompressobj(31), False
    while data := stream.read(read_bytes):
        more = True
        while more:
            piece = member.decompress(data, read_bytes)
            ends = member.eof
            yield piece, ends
            if ends:
                data, member = member.unused_data, zlib.decompressobj(31)
                begun, more = False, bool(data)
            else:
                # A full piece may leave output behind though all input is taken in.
                data, begun = member.unconsumed_tail, True
                more = bool(data) or len(piece) == read_bytes
    if begun:
        raise ValueError("the archive ends within a record")


def read_records(stream, read_bytes: int = READ_BYTES):
    """Yield (headers, block, problem) of each record, one held at a time.

    ``headers`` has lower-case names. ``problem`` is null for a good record, else what is
    wrong with it; the reader goes on with the next member.
    """
    held = bytearray()
    for piece, ends in inflated(stream, read_bytes):
        held += piece
        if ends:
            yield _parsed(bytes(held))
            held.clear()


def _parsed(raw: bytes) -> tuple[dict[str, str], bytes, str | None]:
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    if not found or not lines[0].startswith("WARC/"):
        return headers, b"", "not a WARC record"
    if not headers.get("content-length", "").isdigit():
        return headers, b"", "no content length"
    n = int(headers["content-length"])
    if rest[n:] != b"\r\n\r\n":
        return headers, rest[:n], "the content length does not frame the block"
    block = rest[:n]
    if headers.get("warc-block-digest") != f"sha1:{_b32(hashlib.sha1(block).hexdigest())}":
        return headers, block, "the block digest differs"
    if headers.get("warc-type") == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if headers.get("warc-payload-digest") != f"sha1:{_b32(hashlib.sha1(payload).hexdigest())}":
            return headers, block, "the payload digest differs"
    return headers, block, None


def _page(urn: str | None) -> int | None:
    digits = re.fullmatch(r"<urn:x-page:(-?\d+)>", urn or "")
    return int(digits[1]) if digits else None


def read_archives(spark: SparkSession, archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Records of the listed archives: page_id, url, record_type, refers_to, payload_digest,
    payload_bytes (of the stored payload), problem and, if asked for, payload."""

    def read(batches):
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                with store.open_input_file(path) as stream:
                    for headers, block, problem in read_records(stream):
                        payload = block.partition(b"\r\n\r\n")[2]
                        digest = headers.get("warc-payload-digest", "").partition(":")[2]
                        row = {
                            "page_id": _page(headers.get("warc-record-id")),
                            "url": headers.get("warc-target-uri"),
                            "record_type": headers.get("warc-type"),
                            "refers_to": _page(headers.get("warc-refers-to")),
                            "payload_digest": base64.b32decode(digest).hex() if len(digest) == 32 else None,
                            "payload_bytes": len(payload),
                            "problem": problem,
                        }
                        if payloads:
                            row["payload"] = payload
                        rows.append(row)
                        size += len(payload)
                        if size > 8 << 20 or len(rows) == 4096:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    fields = [
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("problem", pa.string()),
    ]
    kinds = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, problem string"
    if payloads:
        fields, kinds = [*fields, ("payload", pa.binary())], kinds + ", payload binary"
    schema = pa.schema(fields)
    # Archives are of even size, so one task each spreads the reading evenly.
    listed = archives.select("path")
    return listed.repartition(max(1, listed.count())).mapInArrow(read, kinds)


def round_trip(spark: SparkSession, pages: DataFrame, payloads: bool = True, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives and read them back.

    Columns of `read_archives`; payload_bytes of a revisit is that of the response it
    refers to, found by id and digest. Null html is an empty payload, a null id is read
    back as null, a null address has no target header, repeated rows give repeated
    records. No rows give no archives and no rows. Other columns are ignored.
    """
    folder = new_work_dir(spark, "warc")
    archives = write_archives(plan_records(pages), folder, archive_bytes)
    read = read_archives(spark, archives, folder, payloads)
    if not payloads:
        read = written(read, "warc-records")
    whole = read.filter("NOT record_type <=> 'revisit'")
    lengths = whole.select(
        F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("full_bytes")
    ).distinct()
    again = (
        read.filter("record_type = 'revisit'")
        .join(lengths, ["refers_to", "payload_digest"], "left")
        .withColumn("problem", F.coalesce("problem", F.when(F.col("full_bytes").isNull(), "no such response")))
        .withColumn("payload_bytes", F.col("full_bytes"))
    )
    return whole.unionByName(again.select(*whole.columns))
