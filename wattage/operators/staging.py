"""Staging: the cleaned hourly view and its hour x region aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import day_of_week0, day_start


def with_time_parts(df: DataFrame, c: str = "period_date") -> DataFrame:
    """Add hour, day, month, year and day_of_week (Sunday = 0)."""
    return df.select(
        "*",
        F.hour(c).alias("hour"),
        F.dayofmonth(c).alias("day"),
        F.month(c).alias("month"),
        F.year(c).alias("year"),
        day_of_week0(c).alias("day_of_week"),
    )


def with_day(df: DataFrame, c: str = "period_date", name: str = "date_value") -> DataFrame:
    """Add the reading's day (midnight, ``timestamp_ntz``)."""
    return df.withColumn(name, day_start(c))


def clean_reading():
    """The staging filter: value present and positive, period present."""
    return F.col("value").isNotNull() & (F.col("value") > 0) & F.col("period_date").isNotNull()


# Staging columns that are raw columns under another name.
STG_FROM_RAW = {"demand_value": "value"}


def stg_hourly(raw: DataFrame, data_type: str | None = None) -> DataFrame:
    """Clean readings: value present and positive, period present; time parts added.

    The filter sits directly on the scan so Catalyst pushes it into the parquet
    reader. Every reading type is kept unless ``data_type`` names one (the
    reference aggregates all types as demand).
    """
    rows = raw.filter(clean_reading())
    if data_type is not None:
        rows = rows.filter(F.col("data_type") == data_type)
    p = F.col("period_date")
    return rows.select(
        "period_date",
        "respondent",
        "respondent_name",
        "data_type",
        "data_type_name",
        F.col("value").alias("demand_value"),
        "value_units",
        "loaded_at",
        F.hour(p).alias("hour"),
        F.dayofmonth(p).alias("day"),
        F.month(p).alias("month"),
        F.year(p).alias("year"),
        day_of_week0(p).alias("day_of_week"),
        day_start(p).alias("date_value"),
    )


def demand_by_region(stg: DataFrame) -> DataFrame:
    """Hour x region totals (partial aggregation on the map side, then final)."""
    v = F.col("demand_value")
    return stg.groupBy("period_date", "respondent", "respondent_name").agg(
        F.sum(v).alias("total_demand"),
        F.avg(v).alias("avg_demand"),
        F.max(v).alias("max_demand"),
        F.min(v).alias("min_demand"),
        F.count(F.lit(1)).alias("record_count"),
    )
