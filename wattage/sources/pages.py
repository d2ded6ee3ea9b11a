"""Landed pages of the readings service: read, open, normalise, reject, cap.

The reference fetched pages over HTTP on one machine; here pages are files that
land in a directory and Spark reads them in parallel splits. Write one page per
line (JSON Lines) where possible: a ``multiLine`` file cannot be split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.time import day_start, parse_period
from ..operators.sizing import small_side
from ..schemas import CORRUPT, PAGE_AS_READ

# Unit used when a reading carries none; the regions the load asks for.
DEFAULT_UNITS = "MWh"
REQUESTED_REGIONS = ("US48", "CISO", "MISO", "PJM")

# A period outside these years is no reading of this service; it bounds the calendar too.
PLAUSIBLE_YEARS = (1900, 2199)


def page_source(frame: DataFrame) -> DataFrame:
    """The pages of a file source with where each one landed (file time, file, split)."""
    meta = F.col("_metadata")
    return frame.select(
        "response", CORRUPT,
        meta["file_modification_time"].alias("_at"), meta["file_path"].alias("_file"), meta["file_block_start"].alias("_block"),
    )


def open_pages(pages: DataFrame) -> DataFrame:
    """One row per reading of ``response.data`` (hyphenated names kept).

    ``landed`` orders readings as they landed: file time, file, split, page in the
    split, position in the page. A page that is not JSON of the page shape, or that
    has no data list, gives one row without a reading and its text in ``page``.
    """
    # Row numbers grow inside a split, which is read by one task from its start on.
    numbered = pages.withColumn("_row", F.monotonically_increasing_id())
    unreadable = F.col(CORRUPT).isNotNull() | F.col("response").isNull() | F.col("response.data").isNull()
    text = F.when(unreadable, F.coalesce(F.col(CORRUPT), F.to_json("response"), F.lit("")))
    rows = numbered.select("_at", "_file", "_block", "_row", text.alias("page"), F.posexplode_outer(F.when(~unreadable, F.col("response.data"))).alias("_pos", "r"))
    rows = rows.filter(F.col("page").isNotNull() | F.col("_pos").isNotNull())  # an empty page has no readings
    landed = F.struct("_at", "_file", "_block", "_row", "_pos")
    return rows.select("r.*", "page", landed.alias("landed"))


def read_pages(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Read pages (of a folder, a pattern or a list of files) with the fixed page schema (no inference) and open them.

    A page that spans lines needs ``multi_line``; read line by line, each of its lines
    is a malformed page and ends up among the rejects.
    """
    return open_pages(page_source(spark.read.schema(PAGE_AS_READ).option("columnNameOfCorruptRecord", CORRUPT).json(path, multiLine=multi_line)))


def write_pages(readings: DataFrame, path: str, page_size: int = 5000) -> None:
    """Land readings (service text form) as pages of at most ``page_size`` readings,
    one JSON page per line.

    A page is a run of consecutive rows of one input partition, so every group
    is bounded by ``page_size`` by construction, whatever the key skew.
    """
    fields = [F.col(f"`{c}`") for c in readings.columns]
    pid = F.spark_partition_id()
    index = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    rows = readings.select(
        pid.alias("_part"), F.floor(index / page_size).alias("_page"), F.struct(*fields).alias("_r")
    )
    pages = rows.groupBy("_part", "_page").agg(F.collect_list("_r").alias("data"), F.count(F.lit(1)).alias("_n"))
    out = pages.select(F.struct(F.col("_n").cast("string").alias("total"), F.col("data")).alias("response"))
    out.write.mode("overwrite").json(path)


def only_regions(df: DataFrame, regions: Sequence[str] = REQUESTED_REGIONS, col: str = "respondent") -> DataFrame:
    return df.filter(F.col(col).isin(list(regions)))


def normalise(readings: DataFrame, landing: bool = False) -> DataFrame:
    """Service fields -> raw batch columns: period parsed, names unhyphenated,
    value as double (bad text -> NULL), unit defaulted to MWh. ``landing`` keeps the
    columns ``page`` and ``landed`` of ``open_pages``."""
    return readings.select(
        parse_period(F.col("period")).alias("period_date"),
        F.col("respondent"),
        F.col("`respondent-name`").alias("respondent_name"),
        F.col("type").alias("data_type"),
        F.col("`type-name`").alias("data_type_name"),
        F.col("value").try_cast("double").alias("value"),
        F.coalesce(F.col("`value-units`"), F.lit(DEFAULT_UNITS)).alias("value_units"),
        *(["page", "landed"] if landing else []),
    )


def _reason(columns: Sequence[str]):
    first, last = PLAUSIBLE_YEARS
    period = F.col("period_date")
    reason = (
        F.when(period.isNull() | ~F.year(period).between(first, last), F.lit("period"))
        .when(F.col("respondent").isNull() | (F.col("respondent") == ""), F.lit("respondent"))
        .when(F.col("data_type").isNull() | (F.col("data_type") == ""), F.lit("data_type"))
    )
    return F.when(F.col("page").isNotNull(), F.lit("page")).otherwise(reason) if "page" in columns else reason


def split_rejects(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejects): malformed pages and rows without a plausible period, a region
    or a type are set aside with a ``reason``; the rest of the batch goes on.

    Split before any filter by region, or a row without a region is lost."""
    tagged = batch.withColumn("reason", _reason(batch.columns))
    good = tagged.filter(F.col("reason").isNull()).drop("reason", "page")
    return good, tagged.filter(F.col("reason").isNotNull()).drop("landed")


def newest_per_region(df: DataFrame, n: int = 50_000, col: str = "respondent", ts: str = "period_date", tie: Sequence[str] | None = None) -> DataFrame:
    """The ``n`` newest readings of each region (period descending, then ``tie``;
    by default every other column, so the choice is the same on every run).

    A region can hold a third of all rows, so no window runs over a whole region:
    rows are counted per (region, hour bucket of ``ts``), a running count over that
    small table (regions x hours, whatever the timestamp precision) finds each
    region's cut hour, hours before it are kept whole, and only the rows of the
    one cut hour per region are ranked. De-duplicate first: an hour then holds a
    row per reading type.
    """
    if tie is None:
        tie = [c for c in ("data_type", *sorted(df.columns)) if c in df.columns and c not in (col, ts)]
    hour = F.date_trunc("HOUR", F.col(ts)).cast("timestamp_ntz")
    tagged = df.withColumn("_hour", hour)
    per_hour = tagged.groupBy(col, "_hour").agg(F.count(F.lit(1)).alias("_n"))
    newer_first = Window.partitionBy(col).orderBy(F.col("_hour").desc()).rowsBetween(Window.unboundedPreceding, -1)
    cum = per_hour.select(col, "_hour", "_n", F.coalesce(F.sum("_n").over(newer_first), F.lit(0)).alias("_before")).filter(
        F.col("_before") < n
    )
    # Hours fully inside the cap, and the cut hour with the number of rows still allowed.
    marks = cum.select(col, "_hour", F.when(F.col("_before") + F.col("_n") <= n, F.lit(None)).otherwise(F.lit(n) - F.col("_before")).alias("_room"))
    kept = tagged.join(small_side(marks), [col, "_hour"], "inner")
    whole = kept.filter(F.col("_room").isNull())
    cut = kept.filter(F.col("_room").isNotNull())
    rank = F.row_number().over(Window.partitionBy(col, "_hour").orderBy(F.col(ts).desc(), *[F.col(c).desc() for c in tie]))
    part = cut.withColumn("_rk", rank).filter(F.col("_rk") <= F.col("_room")).drop("_rk")
    return whole.unionByName(part).select(*df.columns)


def add_day(df: DataFrame, c: str = "period_date", name: str = "period_day") -> DataFrame:
    """Partition column of the raw table: the reading's day."""
    return df.withColumn(name, day_start(c).cast("date"))
