"""Stored tables: the day-partitioned raw table and fully rebuilt marts.

Writes never read and overwrite the same path in one plan: a merge is written to
a staging folder next to the table first and then moved in with dynamic
partition overwrite, which replaces only the days the batch touched.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import day_start, ts_literal, utc_now
from ..operators.sizing import small_side
from ..operators.upsert import dedupe_batch, upsert
from ..schemas import RAW_KEY, RAW_READINGS
from ..session import ensure_checkpoint_dir, path_exists

PARTITION = "period_day"
RAW_STORED = T.StructType([*RAW_READINGS.fields, T.StructField(PARTITION, T.DateType(), True)])
#: Where and when a reading landed (file time, file, split); stored beside the readings, not part of them.
LANDING = "landing"
_LANDING = T.StructType([T.StructField("at", T.TimestampType()), T.StructField("file", T.StringType()), T.StructField("block", T.LongType())])
RAW_UPDATE_COLS = ("respondent_name", "data_type_name", "value", "value_units")


def scan_raw(spark: SparkSession, path: str) -> DataFrame:
    """The raw table with its declared schema (filters on ``period_day`` prune folders)."""
    return spark.read.schema(RAW_STORED).parquet(path)


def _scan_landed(spark: SparkSession, path: str) -> DataFrame:
    """``scan_raw`` with the landing of each reading (null where a table has none)."""
    return spark.read.schema(T.StructType([*RAW_STORED.fields, T.StructField(LANDING, _LANDING)])).parquet(path)


def with_partition(df: DataFrame) -> DataFrame:
    return df.withColumn(PARTITION, day_start("period_date").cast("date"))


def write_raw(df: DataFrame, path: str, as_of: dt.datetime | None = None) -> None:
    """Write readings by day; only the days present in ``df`` are replaced.

    ``loaded_at`` takes ``as_of`` where the batch has none (the declared default).
    """
    if "loaded_at" not in df.columns:
        df = df.withColumn("loaded_at", ts_literal(as_of or utc_now()))
    out = with_partition(df.select(*[f.name for f in RAW_READINGS.fields], *[c for c in (LANDING,) if c in df.columns]))
    # Range partitions over (day, region, hour): each task writes a few day folders
    # (few files), and a day holding a third of all rows is split over many tasks
    # instead of landing in one as hash partitioning by day would do.
    _overwrite_days(out.repartitionByRange(PARTITION, "respondent", "period_date"), path)


#: A touched day is rewritten in files of about this size.
DAY_FILE_BYTES = 128_000_000


def _packed(staged: DataFrame, path: str) -> DataFrame:
    """Staged days dealt out to as many tasks as their bytes fill files of ``DAY_FILE_BYTES``.

    However many small files staging wrote, a day ends in one, or in as many as its size asks for.
    """
    spark = staged.sparkSession
    sizes = day_files(spark, path).select(F.col(PARTITION).alias("_day"), F.greatest(F.lit(1), F.ceil(F.col("n_bytes") / DAY_FILE_BYTES)).cast("int").alias("_files"))
    sizes = sizes.checkpoint(eager=True)  # a row per day
    total = sizes.agg(F.sum("_files")).first()[0] or 1
    part = F.pmod(F.xxhash64("respondent", "period_date", "data_type"), F.col("_files"))
    dealt = staged.join(F.broadcast(sizes), F.col(PARTITION) == F.col("_day")).withColumn("_part", part)
    tasks = min(int(total), max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return dealt.repartition(tasks, PARTITION, "_part").drop("_day", "_files", "_part")


def _overwrite_days(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION).parquet(path)


def write_rejects(rejects: DataFrame, path: str, run: str) -> DataFrame:
    """Store a run's rejects in the run's own folder: a repeated run replaces it."""
    folder = f"{path.rstrip('/')}/run={run}"
    rejects.write.mode("overwrite").parquet(folder)
    return rejects.sparkSession.read.parquet(folder)


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """(path, time, size) of the files under ``landing``; contents are not read."""
    files = spark.read.format("binaryFile").load(landing)
    return files.select("path", F.col("modificationTime").alias("time"), F.col("length").alias("size"))


def day_files(spark: SparkSession, path: str) -> DataFrame:
    """(period_day, n_files, n_bytes) of the raw table's day folders; files are listed, not opened."""
    stored = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    days = stored.select(F.col(PARTITION).cast("date").alias(PARTITION), "length").groupBy(PARTITION)
    return days.agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))


LEDGER = "path string, time timestamp, size long"


def new_files(spark: SparkSession, landing: str, ledger: str) -> DataFrame:
    """Landed files that the ledger does not hold as they are now (a changed file is new)."""
    files = landed_files(spark, landing)
    if not path_exists(spark, ledger):
        return files
    return files.join(spark.read.schema(LEDGER).parquet(ledger), ["path", "time", "size"], "left_anti")


def add_to_ledger(files: DataFrame, ledger: str) -> None:
    """Append loaded files; a file noted twice does no harm."""
    files.write.mode("append").parquet(ledger)


def materialise(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Full rebuild of a mart or work table; returns the stored table for reuse.

    Written beside the table and swapped in whole, so a day with no rows left keeps
    no stale folder and a failed rebuild leaves the old table. ``partition_by`` splits
    the folder by a column (the fact by ``date_key``) so day-bounded readers prune."""
    return stage_and_replace(df, path, partition_by)


replace_table = materialise


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _previous(path: str) -> str:
    return f"{path.rstrip('/')}__previous"


def _rename(fs, source, target) -> None:
    """Rename or raise: some file systems report a failed rename by returning false."""
    if not fs.rename(source, target):
        raise OSError(f"could not rename {source} to {target}")


def restore_table(spark: SparkSession, path: str) -> bool:
    """Whether the table at ``path`` exists, after undoing a swap that stopped
    between its two renames (the previous, complete table is put back)."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return True
    prev = _fs(spark, _previous(path))[1]
    if fs.exists(prev):
        _rename(fs, prev, p)
        return True
    return False


def stage_and_replace(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Replace the table at ``path`` with ``df``, also when ``df`` reads ``path``.

    The new rows are written completely to a staging folder; then two renames
    swap it in (table -> previous, staging -> table) and the previous copy is
    removed. The table is never deleted before its replacement is whole: each
    rename is checked, a failed one puts the old table back, and a run that stops
    between the renames is undone by ``restore_table``.
    """
    spark = df.sparkSession
    restore_table(spark, path)
    staging = _staging_path(path)
    try:
        writer = df.write.mode("overwrite")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(staging)
        fs, p = _fs(spark, path)
        prev = _fs(spark, _previous(path))[1]
        if fs.exists(prev):  # left by a swap that finished its renames but not its clean-up
            fs.delete(prev, True)
        if fs.exists(p):
            _rename(fs, p, prev)
        try:
            _rename(fs, _fs(spark, staging)[1], p)
        except Exception:
            restore_table(spark, path)
            raise
    except Exception:
        drop_folder(spark, staging)
        raise
    fs.delete(prev, True)
    return spark.read.parquet(path)


def replace_days(df: DataFrame, path: str, days: DataFrame, by: str) -> DataFrame:
    """Replace the folders of ``days`` (column ``by``) in a table partitioned by ``by``.

    ``df`` holds rows of those days only. It is staged whole, then moved in day by
    day; a day without rows left loses its folder. The result is the same if the
    call is repeated after a failure.
    """
    spark = df.sparkSession
    staging = _staging_path(path)
    try:
        df.write.mode("overwrite").partitionBy(by).parquet(staging)
        staged = spark.read.schema(df.schema).parquet(staging)
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
        # Usually none: a day whose last clean reading was corrected away.
        gone = days.select(by).distinct().join(staged.select(by).distinct(), by, "left_anti").collect()
        for row in gone:
            drop_folder(spark, f"{path.rstrip('/')}/{by}={row[0]}")
    finally:
        drop_folder(spark, staging)
    return spark.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a staging folder this library wrote."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _staging_path(path: str) -> str:
    return f"{path.rstrip('/')}__staging-{uuid.uuid4().hex}"


def upsert_raw(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    as_of: dt.datetime,
    keys: Sequence[str] = RAW_KEY,
    order: Sequence[str] | None = None,
    exists: bool | None = None,
) -> DataFrame:
    """Merge a batch of readings into the raw table at ``path``.

    Of several readings of a key in the batch the newest wins: the last in the order
    of landing (column ``landed``, see ``open_pages``), or by ``order``. Across batches
    likewise: a key keeps the landing it came from, and an older landing, loaded again,
    does not undo a later one's correction. Matched keys
    take the batch's name, type name, value and unit and ``loaded_at = as_of``; new
    keys are inserted with ``loaded_at = as_of``. The batch is evaluated once. Only
    the touched days are read (a join on the batch's days, after pruning folders by
    its first and last), merged, staged, and moved in; running it twice changes
    nothing more.
    """
    if order is None:
        order = ("landed",) if "landed" in batch.columns else ()
    ensure_checkpoint_dir(spark)
    batch = dedupe_batch(batch.drop("loaded_at"), keys, order)
    landing = F.lit(None)
    if "landed" in batch.columns:
        landing = F.struct(F.col("landed._at").alias("at"), F.col("landed._file").alias("file"), F.col("landed._block").alias("block"))
    batch = batch.withColumn(LANDING, landing.cast(_LANDING)).drop("landed").checkpoint(eager=True)
    stamp = ts_literal(as_of)
    if exists is None:
        exists = path_exists(spark, path)
    if not exists:
        write_raw(batch.withColumn("loaded_at", stamp), path)
        return scan_raw(spark, path)
    days = with_partition(batch).select(PARTITION).distinct()
    first, last = days.agg(F.min(PARTITION), F.max(PARTITION)).first()
    if first is None:
        return scan_raw(spark, path)
    near = _scan_landed(spark, path).filter(F.col(PARTITION).between(F.lit(first), F.lit(last)))
    target = near.join(small_side(days, materialised=True), PARTITION, "left_semi").drop(PARTITION)
    merged = upsert(
        target, batch, keys, RAW_UPDATE_COLS, on_match={"loaded_at": stamp}, on_insert={"loaded_at": stamp}, version=LANDING
    )
    staging = _staging_path(path)
    try:
        write_raw(merged, staging)
        # Dynamic overwrite replaces only the staged days, file by file as staged;
        # replaying the same batch after a failure merges the same rows again.
        _overwrite_days(_packed(_scan_landed(spark, staging), staging), path)
    finally:
        drop_folder(spark, staging)
    return scan_raw(spark, path)
