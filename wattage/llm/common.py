"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, job_scratch, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage, so a lost executor costs a re-read rather than a re-run, and
    fixes the rows that several later steps read.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_apart(spark: SparkSession, make: Callable[[], list[DataFrame]], *names: str) -> list[DataFrame]:
    """``stage`` for each frame that ``make`` returns; what ``make`` itself stored is removed then.

    Only the frames returned are read later, so the disk of the way there is free again."""
    paths = [scratch_path(spark, name) for name in names]
    with job_scratch(spark):
        frames = make()
        for df, path in zip(frames, paths, strict=True):
            df.write.parquet(path)
    return [spark.read.schema(df.schema).parquet(path) for df, path in zip(frames, paths)]


def shared_folder(spark: SparkSession, name: str) -> str:
    """URI of a fresh folder that driver and executors share."""
    ensure_checkpoint_dir(spark)
    return scratch_path(spark, name)


def file_system(uri: str):
    """(file system, path) for a folder URI, usable inside a task."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, name: str, data: bytes) -> None:
    """Commit one file: whole under a temporary name, then renamed.

    A retried or speculative attempt writes the same bytes under its own temporary
    name, so whichever renames last leaves the same file.
    """
    import uuid

    files, base = file_system(uri)
    files.create_dir(base, recursive=True)
    temporary = f"{base}/_temporary-{uuid.uuid4().hex}"
    with files.open_output_stream(temporary) as out:
        out.write(data)
    files.move(temporary, f"{base}/{name}")


def commit_manifest(manifest: DataFrame, folder: str) -> DataFrame:
    """Write the files and, last and beside them, the manifest that names them; returns it as stored."""
    path = f"{folder}/_manifest"
    manifest.write.parquet(path)
    return manifest.sparkSession.read.schema(manifest.schema).parquet(path)


def listed_files(spark: SparkSession, folder: str, pattern: str, manifest: DataFrame, digest: str) -> DataFrame:
    """(path, content, digest) of the files of ``folder`` that the manifest (file, digest) names.

    Raises if a file of the manifest is missing, or one is there that it does not name."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    name = F.element_at(F.split("path", "/"), -1).alias("name")
    wanted = manifest.select(F.col("file").alias("name"), F.col(digest).alias("digest"))
    there = files.select(name, F.lit(True).alias("there"))  # names only
    wrong = wanted.join(there, "name", "full_outer").filter("there is null or digest is null").select("name", "there").limit(10).collect()
    if wrong:
        told = ", ".join(f"{r['name']} is {'not named' if r['there'] else 'missing'}" for r in wrong)
        raise ValueError(f"files of {folder} differ from the manifest: {told}")
    return files.select("path", "content", name).join(wanted, "name").select("path", "content", "digest")


def text_hash(text: str = "text"):
    """64-bit key of a whole text; null and empty differ from each other and from any other text."""
    return F.xxhash64(F.col(text), F.col(text).isNull())


def ascii_lower(column):
    """Lower-case A-Z only: other letters keep their case, as the word contracts ask."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into at most ``rows`` rows each."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)
