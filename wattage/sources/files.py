"""Small control files (pointers, journal entries) on the warehouse's file system."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the visible entries of a folder, sorted; none if it does not exist."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n for n in found if n[0] not in "._")


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that must not exist yet: whole under a hidden name, then renamed."""
    folder, _, name = path.rpartition("/")
    fs, target = _fs(spark, path)
    temporary = _fs(spark, f"{folder}/_{uuid.uuid4().hex}-{name}")[1]
    fs.mkdirs(target.getParent())
    stream = fs.create(temporary, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(target):
        fs.delete(temporary, False)
        raise FileExistsError(path)
    if not fs.rename(temporary, target):
        raise OSError(f"could not rename {temporary} to {path}")


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
