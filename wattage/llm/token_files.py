"""Token-ID output: documents to patched frame-of-reference id files, and back.

``write_token_files`` range-sorts documents by id, encodes every whole text once in
the task that writes it and rolls files by number of ids; ``read_token_files`` reads
them with Spark's binary reader. Texts may be null (empty), empty or very long, ids
may repeat (ordered by a hash of the text) or be null (first); an empty table makes
no file and no row. Columns other than the two named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .blocks import decode_file, encode_file
from .common import commit_manifest, listed_files, shared_folder, text_hash, write_file
from .tokens import encoder

# Ids per file: 16 MB raw. A file is closed after the document that reaches it.
FILE_IDS = 4_000_000
# Texts encoded at once inside a task.
TEXTS_AT_ONCE = 2_000
MANIFEST = "file string, part int, seq int, n_docs long, n_ids long, crc32 long"
READ = "file string, doc_id long, row long, start_in_file long, n_tokens long, ids_crc32 long"


def write_token_files(
    docs: DataFrame, folder: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    tokenizer: str | None = None, file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write the id files to ``folder``; returns the stored manifest (one row per file).

    Each document's ids are followed by ``end_id``. File names depend only on the
    partition and the position in it, so a repeated task replaces its own files.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        from pyspark import TaskContext

        part, encode, seq = TaskContext.get().partitionId(), encoder(tokenizer), 0
        names: list = []
        counts: list = []
        pieces: list = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal seq, names, counts, pieces, held
            data = encode_file(names, np.concatenate(counts), np.concatenate(pieces))
            name = f"part-{part:06d}-{seq:05d}.pfor"
            write_file(folder, name, data)
            row = pa.RecordBatch.from_pylist(
                [{"file": name, "part": part, "seq": seq, "n_docs": len(names), "n_ids": held, "crc32": zlib.crc32(data)}],
                schema=pa.schema([("file", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("crc32", pa.int64())]),
            )
            seq, names, counts, pieces, held = seq + 1, [], [], [], 0
            return row

        for batch in batches:
            ids_all = batch.column(0).to_pylist()
            for lo in range(0, batch.num_rows, TEXTS_AT_ONCE):
                n, ids = encode.encode(batch.column(1).slice(lo, TEXTS_AT_ONCE))
                ends = np.cumsum(n)
                ids, n = np.insert(ids, ends, end_id), n + 1
                ends, first, low = np.cumsum(n), 0, 0
                while first < len(n):
                    last = first + int(np.searchsorted(ends[first:] - low, file_ids - held)) + 1
                    last = min(last, len(n))
                    high = int(ends[last - 1])
                    names += ids_all[lo + first : lo + last]
                    counts.append(n[first:last])
                    pieces.append(ids[low:high])
                    held += high - low
                    first, low = last, high
                    if held >= file_ids:
                        yield close()
        if names:
            yield close()

    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keyed = keyed.select("doc_id", "text", text_hash().alias("tie"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    sorted_docs = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return commit_manifest(sorted_docs.mapInArrow(write, MANIFEST), folder)


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per document of the files named by the manifest.

    A missing file, one that is not named or one whose crc32 differs stops the read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            for path, content, crc32 in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                data = content.as_buffer()
                if zlib.crc32(data) != crc32:
                    raise ValueError(f"crc32 of {path} differs from the manifest")
                doc_ids, null, n, ids = decode_file(memoryview(data))
                raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                ends = np.cumsum(n)
                starts = ends - n
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path.rsplit("/", 1)[-1]] * len(n), pa.string()),
                        pa.array(doc_ids, pa.int64(), mask=null),
                        pa.array(np.arange(len(n))),
                        pa.array(starts),
                        pa.array(n),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["file", "doc_id", "row", "start_in_file", "n_tokens", "ids_crc32"],
                )

    if manifest.isEmpty():
        return spark.createDataFrame([], READ)
    return listed_files(spark, folder, "*.pfor", manifest, "crc32").mapInArrow(read, READ)


def file_starts(manifest: DataFrame) -> DataFrame:
    """(file, first): ids in all files before it.

    Running sums inside each writing task's files, plus the running sum of the
    tasks' totals: the only rows that meet in one place are one per writing task.
    """
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = parts.select(
        F.col("part").alias("p"),
        (F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("ids")).alias("before"),
    )
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_ids")
    return manifest.withColumn("within", within).join(before, F.col("part") == F.col("p")).select("file", (F.col("before") + F.col("within")).alias("first"))


def token_files(docs: DataFrame, end_id: int, tokenizer: str | None = None) -> DataFrame:
    """Write the corpus as id files into a fresh shared folder and read them back.

    Returns doc_id, start (ids of all documents before it), n_tokens (with the end
    id), ids_crc32 (of the little-endian 32-bit ids) and the file that holds it.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-files")
    manifest = write_token_files(docs, folder, end_id, tokenizer=tokenizer)
    rows = read_token_files(spark, folder, manifest)
    starts = file_starts(manifest)
    return rows.join(starts, "file").select(
        "doc_id", (F.col("first") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32", "file"
    )
