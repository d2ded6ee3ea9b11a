"""WARC archives: a deterministic sharded writer, and the reader.

Records are range-sorted by page id; each task writes its range to files that are rolled
by compressed size, headers and digests being made anew from the payload. Every file is
committed by a rename from a temporary name and listed in a manifest with its digest; the
reader takes what the manifest lists and checks file, block and payload digests.

Of records with equal payloads (of at least ``least_bytes``) that with the largest page id
is a response; the others are revisits of it. Who refers to whom is decided on digests
alone; the decisions ride along in the same range sort as small rows before the pages they
concern, so page texts are shuffled once.

A null html is an empty payload. Repeated rows: the first of equal rows is the response.
A row with a null id is a revisit if another row with its payload has an id, else a
response. An empty table makes no file. Only page_id, url and html are read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import commit_manifest, listed_files, shared_folder, stage, write_file

ROLL_BYTES = 16_000_000
LEVEL = 4
#: The date in every record header; a parameter, so that equal input gives equal files.
DATE = "2024-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, part int, seq int, n_records long, bytes long, sha1 string"
READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, file string"
_CHUNK = 16_384


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page:{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record. A revisit has the response's header but not its payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Page-ID: {'' if page_id is None else page_id}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {''.join(url.split())}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"WARC-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join([*lines, "", ""]).encode() + block + b"\r\n\r\n"


def _info(name: str) -> bytes:
    body = f"format: WARC File Format 1.1\r\nfilename: {name}\r\n".encode()
    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(NAMESPACE, name)}>\r\nWARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)  # a gzip member without time or name
    return pack.compress(data) + pack.flush()


def members(data: bytes) -> Iterator[bytes]:
    """The gzip members of a file, one after another, without copying the rest each time."""
    view, at = memoryview(data), 0
    while at < len(view):
        unpack = zlib.decompressobj(31)
        out = []
        while not unpack.eof and at < len(view):
            piece = view[at : at + _CHUNK]
            out.append(unpack.decompress(piece))
            at += len(piece)
        at -= len(unpack.unused_data)
        if not unpack.eof:
            raise ValueError("truncated archive")
        yield b"".join(out)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of a record, with the block digest checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    block = rest[: int(headers["Content-Length"])]
    if "WARC-Block-Digest" in headers and headers["WARC-Block-Digest"] != f"sha1:{sha1_base32(block)}":
        raise ValueError("block digest differs")
    return headers, block


def roles(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, sha1, refers_to) of the revisits, from (page_id, sha1, size): digests only."""
    large = pages.filter(F.col("size") >= least_bytes).select("page_id", "sha1")
    winners = stage(large.groupBy("sha1").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1 and refers_to is not null"), "warc-winners")
    return large.join(winners.select("sha1", "refers_to"), "sha1").select("page_id", "sha1", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write the archives to ``folder``; returns the stored manifest (one row per file)."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    decided = roles(rows.select("page_id", "sha1", F.octet_length("payload").alias("size")), least_bytes)
    union = rows.select("page_id", "sha1", F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast("long").alias("refers_to")).union(
        decided.select("page_id", "sha1", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "refers_to")
    )
    # Equal keys never part in a range sort: a page meets the row that decides on it.
    key = [F.col("page_id").asc_nulls_first(), F.col("sha1")]
    ordered = union.repartitionByRange(*key).sortWithinPartitions(*key, F.col("kind"), F.col("url").asc_nulls_first())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        size = 0
        decision: tuple | None = None  # (page_id, sha1, refers_to) of the key just met
        met: tuple | None = None

        def close() -> pa.RecordBatch:
            nonlocal seq, held, size
            name = f"part-{part:06d}-{seq:05d}.warc.gz"
            data = b"".join([_member(_info(name)), *held])
            write_file(folder, name, data)
            out = pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(held)], pa.int64()), pa.array([len(data)], pa.int64()), pa.array([hashlib.sha1(data).hexdigest()])],
                names=["file", "part", "seq", "n_records", "bytes", "sha1"],
            )
            seq, held, size = seq + 1, [], 0
            return out

        for batch in batches:
            for page_id, sha1, kind, url, body, refers in zip(*[c.to_pylist() for c in batch.columns]):
                if kind == 0:
                    decision = (page_id, sha1, refers)
                    continue
                digest = sha1_base32(body)
                refers = decision[2] if decision and decision[:2] == (page_id, sha1) else None
                if refers is not None and refers == page_id and met != (page_id, sha1):
                    refers = None  # the response itself
                met = (page_id, sha1)
                held.append(_member(record(page_id, url, body, digest, refers)))
                size += len(held[-1])
                if size >= roll_bytes:
                    yield close()
        if held:
            yield close()

    return commit_manifest(ordered.mapInArrow(write, MANIFEST), folder)


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per response or revisit record of the files that the manifest lists.

    A missing file, one that is not listed or one whose digest differs stops the read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content, sha1 in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                data = content.as_buffer()
                if hashlib.sha1(data).hexdigest() != sha1:
                    raise ValueError(f"digest of {path} differs from the manifest")
                out: list[tuple] = []
                for member in members(memoryview(data)):
                    headers, block = parse(member)
                    kind = headers["WARC-Type"]
                    if kind not in ("response", "revisit"):
                        continue
                    http, _, body = block.partition(b"\r\n\r\n")
                    length = int(http.rpartition(b"Content-Length: ")[2])
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and (len(body) != length or sha1_base32(body) != digest):
                        raise ValueError(f"payload digest differs in {path}")
                    page, refers = headers["WARC-Page-ID"], headers.get("WARC-Refers-To-Page-ID")
                    out.append((int(page) if page else None, headers.get("WARC-Target-URI"), length, digest, kind, int(refers) if refers else None, path.rsplit("/", 1)[-1]))
                columns = list(zip(*out)) if out else [[]] * 7
                types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "file"]
                )

    if manifest.isEmpty():
        return spark.createDataFrame([], READ)
    return listed_files(spark, folder, "*.warc.gz", manifest, "sha1").mapInArrow(read, READ)


def archive_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write all pages to archives in a fresh shared folder and read them back."""
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    return read_archives(spark, folder, write_archives(pages, folder, least_bytes))
