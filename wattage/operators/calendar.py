"""Calendar generator: a day spine and the date dimension built on it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import date_key, date_literal, day_of_week0

# The calendar of the reference starts 2023-01-01 and ends 2026-12-31.
CALENDAR_START = dt.date(2023, 1, 1)
CALENDAR_END = dt.date(2026, 12, 31)


def _as_date(d: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(d) if isinstance(d, str) else d


def calendar_days(start: dt.date | str = CALENDAR_START, end: dt.date | str = CALENDAR_END) -> int:
    """Number of rows ``date_spine`` yields; the size bound used before broadcasting."""
    return max((_as_date(end) - _as_date(start)).days + 1, 0)


def date_spine(spark: SparkSession, start: dt.date | str = CALENDAR_START, end: dt.date | str = CALENDAR_END) -> DataFrame:
    """One row per day in ``[start, end]``; ``spark.range`` splits it across tasks."""
    n = calendar_days(start, end)
    return spark.range(n).select(F.date_add(date_literal(_as_date(start)), F.col("id").cast("int")).alias("date_value"))


def dim_date(
    spark: SparkSession,
    start: dt.date | str = CALENDAR_START,
    end: dt.date | str = CALENDAR_END,
    holidays: DataFrame | None = None,
) -> DataFrame:
    """Calendar dimension with 12 attributes.

    ``holidays`` (a frame with a ``date_value`` date column) sets ``is_holiday``;
    without it every day is a working day, as in the reference.
    """
    d = F.col("date_value")
    cal = date_spine(spark, start, end).select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day"),
        day_of_week0(d).alias("day_of_week"),
        F.date_format(d, "E").alias("day_name"),
        day_of_week0(d).isin(0, 6).alias("is_weekend"),
    )
    if holidays is None:
        return cal.withColumn("is_holiday", F.lit(False))
    marks = holidays.select(F.col("date_value").cast("date").alias("date_value")).distinct().withColumn("_h", F.lit(True))
    return cal.join(marks, "date_value", "left").select(
        *[c for c in cal.columns], F.coalesce(F.col("_h"), F.lit(False)).alias("is_holiday")
    )


def calendar_head(dd: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` calendar rows by date (top-k, no full sort)."""
    return dd.orderBy("date_value").limit(n)


def calendar_bounds(
    readings: DataFrame,
    c: str = "period_date",
    start: dt.date | str | None = CALENDAR_START,
    end: dt.date | str | None = CALENDAR_END,
) -> tuple[dt.date, dt.date]:
    """Calendar range that covers ``[start, end]`` and the data plus one year ahead;
    with ``None`` for both the data alone decides (the default range if it is empty).

    One aggregate job; only the two bounding dates reach the driver. The load rejects
    periods outside plausible years, so the range has at most some 110,000 days.
    """
    day = F.to_date(F.col(c))
    lo, hi = readings.agg(F.min(day), F.add_months(F.max(day), 12)).first()
    if lo is None:
        return _as_date(start or CALENDAR_START), _as_date(end or CALENDAR_END)
    return min(lo, _as_date(start or lo)), max(hi, _as_date(end or hi))


def extended(dd: DataFrame, start: dt.date, end: dt.date, holidays: DataFrame | None = None) -> DataFrame | None:
    """``dd`` with the days of ``[start, end]`` it lacks, or None if it has them all.

    Keys are dates written as numbers, so no stored key changes."""
    lo, hi = dd.agg(F.min("date_value"), F.max("date_value")).first()
    if lo is not None and lo <= start and end <= hi:
        return None
    whole = dim_date(dd.sparkSession, min(start, lo or start), max(end, hi or end), holidays)
    return dd.unionByName(whole.join(dd.select("date_value"), "date_value", "left_anti").select(dd.columns))
