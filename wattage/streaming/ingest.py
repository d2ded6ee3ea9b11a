"""Incremental load: every landed page file once, merged idempotently.

A file stream source picks up new page files; each micro-batch is opened,
normalised, cleared of unkeyable rows and malformed pages and merged into the raw
table by ``upsert_raw``, the reading that landed last winning. A micro-batch
replayed after a failure merges the same rows again and replaces its own folder of
rejects, so both sinks are effectively exactly-once. The days it touches go into the
warehouse's journal before the merge, as a batch load's do, so the next refresh of the
marts takes them in; the entry is named by the stream's id (kept in its checkpoint) and
the micro-batch's number, so a replay repeats the entry and no other stream shares it.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import utc_now
from ..schemas import CORRUPT, PAGE_AS_READ
from ..sources import journal
from ..sources.files import read_text
from ..sources.pages import normalise, only_regions, open_pages, page_source, split_rejects
from ..sources.tables import upsert_raw, write_rejects


def page_stream(spark: SparkSession, in_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed pages with where they landed, as a stream."""
    reader = spark.readStream.schema(PAGE_AS_READ).option("columnNameOfCorruptRecord", CORRUPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return page_source(reader.json(in_dir))


#: The raw table's folder in a warehouse (see ``plans.jobs``).
RAW_FOLDER = "raw_readings"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream whose checkpoint this is; it stays over restarts."""
    return json.loads(read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def ingest_stream(
    spark: SparkSession,
    in_dir: str,
    raw_path: str,
    checkpoint: str,
    as_of: dt.datetime | None = None,
    regions: tuple[str, ...] | None = None,
    rejects_path: str | None = None,
    max_files_per_trigger: int | None = None,
    processing_time: str | None = None,
    warehouse: str | None = None,
):
    """Run the load over all files available now and stop (``availableNow``), or,
    with ``processing_time`` (e.g. ``"1 hour"``), keep running and pick up new
    files on that schedule.

    Returns the ``StreamingQuery`` (finished in the first mode, running in the
    second). ``as_of`` stamps ``loaded_at`` (default: the start of each micro-batch).
    Rejected rows go with their reason to ``rejects_path`` (default: beside the raw
    table), a folder per micro-batch. ``warehouse`` is the one whose journal gets the days;
    by default that around a raw table named ``raw_readings``, and none otherwise.
    """
    parent, _, folder = raw_path.rstrip("/").rpartition("/")
    if warehouse is None and folder == RAW_FOLDER:
        warehouse = parent
    rejects = rejects_path or f"{raw_path.rstrip('/')}_rejects"
    pages = page_stream(spark, in_dir, max_files_per_trigger)

    def merge(batch: DataFrame, batch_id: int) -> None:
        # Several actions read the micro-batch; it is parsed once and kept for
        # them (lost blocks are recomputed from the batch's fixed file list).
        readings = normalise(open_pages(batch), landing=True).persist()
        try:
            good, bad = split_rejects(readings)
            write_rejects(bad, rejects, f"{batch_id:09d}")
            if regions:
                good = only_regions(good, regions)
            # At most as many days as the calendar has.
            days = [r[0] for r in good.select(F.to_date("period_date")).distinct().collect()]
            if days:
                stamp, entry = as_of or utc_now(), None
                if warehouse is not None:
                    entry = journal.open_entry(spark, warehouse, f"stream-{stream_id(spark, checkpoint)}-{batch_id:09d}", days, stamp)
                upsert_raw(spark, raw_path, good, stamp)
                if entry is not None:
                    journal.close_entry(spark, warehouse, entry)
        finally:
            readings.unpersist()

    writer = pages.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    if processing_time:
        return writer.trigger(processingTime=processing_time).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
