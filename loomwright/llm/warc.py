"""WARC archives through a table of record chunks.

A record is never held as a whole: it is a run of rows ``(record, chunk number, bytes)`` of
at most ``chunk_bytes``, on the way into an archive and on the way out. The rows that come
out carry the length and the digest of the payload up to and with their chunk, so the last
row of a record has those of the whole payload.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..paths import shared_dir
from .common import staged
from .files import opened, written

CHUNK_BYTES = 256 << 10
RESPONSE, REVISIT = "response", "revisit"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# The archives hold copies of a table that has no times.
DATE = "1970-01-01T00:00:00Z"
RECORDS = (
    "page_id long, record_id string, url string, record_type string, refers_to string, "
    "chunk_no int, last boolean, payload_bytes long, payload_digest string, chunk binary"
)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_chunks(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES, least_bytes: int = 0) -> DataFrame:
    """The chunk table of a record for each row of ``pages`` (``page_id, url, html``).

    Of the rows with equal payloads of at least ``least_bytes``, the one with the largest
    ``page_id`` is a response and the others revisit it; their chunk is empty. A null
    ``html`` is an empty payload, null ids count as the smallest, and of rows with the same
    id and payload one counts as the largest. Chunks of a record are neighbours in order.

    A record is named by what is in its row, and rows that are equal by a number, so names do not
    depend on how rows are dealt to tasks and every pass over ``pages`` gives the same ones. Equal
    payloads are sent once.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("size"))
    # A null address is another one than an empty address.
    inside = F.sha1(F.concat("sha1", F.lit(":"), F.col("size").cast("string"), F.lit(":"), F.coalesce(F.concat(F.lit("u"), "url"), F.lit(""))))
    base = F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(":"), inside)
    rows = rows.withColumn("base", base)
    same = [F.first(c).alias(c) for c in ("page_id", "url", "sha1", "size")]
    # Aggregates are written before they are joined, so that Spark can split a payload of very many pages.
    facts = staged(rows.groupBy("base").agg(*same, F.count("*").alias("copies")), "pages")
    keeper = F.max(F.struct("page_id", "base")).alias("keeper")
    keepers = staged(facts.where(F.col("size") >= least_bytes).groupBy("sha1", "size").agg(keeper), "keepers")
    roles = facts.join(keepers, ["sha1", "size"], "left").select(*facts.columns, F.col("keeper.base").alias("kept"))
    # Rows whose payload is written: all small ones, and one of each large one.
    whole = F.col("kept").isNull() | (F.col("kept") == F.col("base"))
    bodies = rows.select("base", "payload").join(roles.where(whole).select("base"), "base", "left_semi").dropDuplicates(["base"])
    joined = roles.join(bodies, "base", "left").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    first = F.col("kept").isNull() | ((F.col("kept") == F.col("base")) & (F.col("copy") == 0))
    joined = joined.withColumn("refers_to", F.when(~first, F.concat("kept", F.lit(":0"))))
    joined = joined.withColumn("payload", F.when(first, F.col("payload")).otherwise(F.lit(b"")))
    last = F.greatest(F.ceil(F.octet_length("payload") / chunk_bytes) - 1, F.lit(0)).cast("int")
    return (
        joined.withColumn("record_id", F.concat("base", F.lit(":"), F.col("copy").cast("string")))
        .withColumn("last_chunk", last)
        .withColumn("chunk_no", F.explode(F.sequence(F.lit(0), "last_chunk")))
        .select(
            *("page_id", "record_id", "url", "refers_to", "sha1", "size", "chunk_no"),
            (F.col("chunk_no") == F.col("last_chunk")).alias("last"),
            F.substring("payload", F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes)).alias("chunk"),
        )
    )


def _head(record_id: str, url: str | None, refers_to: str | None, sha1: str, size: int) -> bytes:
    """Everything of a record before its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    fields = {
        "WARC-Type": REVISIT if refers_to else RESPONSE,
        "WARC-Record-ID": f"<{record_id}>",
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha1:{base32(bytes.fromhex(sha1))}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(http) + (0 if refers_to else size)),
    }
    if url is not None:
        # Control characters and blanks cannot stand in a field.
        fields["WARC-Target-URI"] = re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url)
    if refers_to:
        fields |= {"WARC-Refers-To": f"<{refers_to}>", "WARC-Profile": PROFILE}
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + http


def write_archives(chunks: DataFrame, path: str) -> DataFrame:
    """Write the records of a chunk table to archives under ``path``, one for each task, each
    record compressed on its own. Returns a row for each archive: ``path, records``. Archives
    appear whole or not at all; a payload that is not what its digest says is an error."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{path}/{TaskContext.get().partitionId():06d}.warc.gz"
        records = 0
        columns = ("record_id", "url", "refers_to", "sha1", "size", "chunk_no", "last", "chunk")
        with written(name) as out:
            packer = sha = None
            for batch in batches:
                values = zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
                for record_id, url, refers_to, sha1, size, chunk_no, last, chunk in values:
                    if not chunk_no:
                        packer, sha = zlib.compressobj(3, wbits=31), hashlib.sha1()
                        out.write(packer.compress(_head(record_id, url, refers_to, sha1, size)))
                        records += 1
                    sha.update(chunk)
                    out.write(packer.compress(chunk))
                    if last:
                        if not refers_to and sha.hexdigest() != sha1:
                            raise ValueError(f"chunks of {record_id} are not in order")
                        out.write(packer.compress(b"\r\n\r\n") + packer.flush())
        yield pa.RecordBatch.from_pydict({"path": [name], "records": pa.array([records], pa.int64())})

    return staged(chunks.mapInArrow(write, "path string, records long"), "archives")


def _fields(stream: io.BufferedReader) -> dict[str, str]:
    """Named fields up to the blank line."""
    out = {}
    while line := stream.readline().rstrip(b"\r\n"):
        name, _, value = line.partition(b":")
        out[name.decode().lower()] = value.strip().decode("utf-8", "replace")
    return out


def stream_records(stream: io.BufferedReader, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple]:
    """The chunk rows of an archive. Memory holds one chunk."""
    while version := stream.readline():
        if not version.strip():
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should start")
        fields = _fields(stream)
        kind, left = fields["warc-type"], int(fields["content-length"])
        head = [stream.readline()]
        while head[-1].strip():
            head.append(stream.readline())
        left -= sum(map(len, head))
        http = _fields(io.BufferedReader(io.BytesIO(b"".join(head[1:]))))
        record_id, refers_to = fields["warc-record-id"][1:-1], fields.get("warc-refers-to", "<>")[1:-1] or None
        page_id = record_id.split(":")[2]
        own = (int(page_id) if page_id else None, record_id, fields.get("warc-target-uri"), kind, refers_to)
        stated = fields["warc-payload-digest"].removeprefix("sha1:")
        if kind == REVISIT:
            yield *own, 0, True, int(http["content-length"]), stated, b""
            stream.read(left)
            continue
        sha, done, number = hashlib.sha1(), 0, 0
        while True:
            chunk = stream.read(min(chunk_bytes, left))
            if len(chunk) < min(chunk_bytes, left):
                raise ValueError(f"{record_id} is cut short")
            sha.update(chunk)
            left -= len(chunk)
            done += len(chunk)
            digest = base32(sha.digest())
            if not left and digest != stated:
                raise ValueError(f"the payload of {record_id} is not what its digest says")
            yield *own, number, not left, done, digest, chunk
            number += 1
            if not left:
                break


def read_archives(archives: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of archives (a column ``path``): a task streams one archive at a time."""
    names = [part.split()[0] for part in RECORDS.split(", ")]
    kinds = [pa.int64(), *[pa.string()] * 4, pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.binary()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with opened(path) as file, gzip.GzipFile(fileobj=file) as plain:
                    rows, held = [], 0
                    for row in stream_records(io.BufferedReader(plain, 1 << 16), chunk_bytes):
                        rows.append(row)
                        held += len(row[-1]) + 200
                        if held >= 4 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch_of(rows)

    spread = archives.select("path").repartition(max(archives.count(), 1), "path")
    return spread.mapInArrow(read, RECORDS)


def archive(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write a record for every page to a new folder, and return the archives."""
    return write_archives(record_chunks(pages, least_bytes=least_bytes), shared_dir(pages.sparkSession, "warc"))


def page_of(record: str):
    """The ``page_id`` within the name of a record."""
    return F.split_part(F.col(record), F.lit(":"), F.lit(3)).try_cast("long")
