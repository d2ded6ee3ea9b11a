"""Summary marts over staging and the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import day_start, ts_literal
from .keys import grouped_key
from .sizing import small_side


def daily_demand(stg: DataFrame) -> DataFrame:
    """Day x region: average, min, max, total and number of hourly readings."""
    v = F.col("demand_value")
    return stg.groupBy(day_start("period_date").alias("period_day"), "respondent", "respondent_name").agg(
        F.avg(v).alias("avg_demand_mw"),
        F.min(v).alias("min_demand_mw"),
        F.max(v).alias("max_demand_mw"),
        F.sum(v).alias("total_demand_mwh"),
        F.count(F.lit(1)).alias("hourly_record_count"),
    )


def daily_from_hourly(by_region: DataFrame) -> DataFrame:
    """``daily_demand`` rolled up from the hour x region aggregate (``demand_by_region``).

    Sums, counts, minima and maxima roll up exactly; the average is total / count.
    The hourly aggregate has one row per region and hour, so a job that already
    stores it builds the daily mart without scanning the readings again.
    """
    g = by_region.groupBy(day_start("period_date").alias("period_day"), "respondent", "respondent_name").agg(
        F.sum("total_demand").alias("total_demand_mwh"),
        F.sum("record_count").alias("hourly_record_count"),
        F.min("min_demand").alias("min_demand_mw"),
        F.max("max_demand").alias("max_demand_mw"),
    )
    return g.select(
        "period_day", "respondent", "respondent_name",
        (F.col("total_demand_mwh") / F.col("hourly_record_count")).alias("avg_demand_mw"),
        "min_demand_mw", "max_demand_mw", "total_demand_mwh", "hourly_record_count",
    )


def forecast_vs_actual(stg: DataFrame) -> DataFrame:
    """The reference publishes ``daily_demand`` a second time under this name; the
    comparison the name promises is ``forecast.with_actuals``."""
    return daily_demand(stg)


SUMMARY_COLUMNS = (
    "period_date", "region", "hour", "day_of_week", "is_weekend",
    "total_demand", "avg_demand", "max_demand", "min_demand", "demand_variance",
)


def demand_summary_rows(fct: DataFrame, dr: DataFrame, dd: DataFrame) -> DataFrame:
    """Hour x region x calendar: sum, avg, max, min, sample variance, number of readings.

    ``fct`` needs ``period_date, region_key, date_key, hour, demand_value``; the
    fact key is not needed, so pass ``fct_hourly_rows`` to skip numbering facts.
    """
    regions = dr.select("region_key", F.col("respondent").alias("region"))
    days = small_side(dd.select("date_key", "day_of_week", "is_weekend"), materialised=True)
    v = F.col("demand_value")
    return (
        fct.select("period_date", "region_key", "date_key", "hour", "demand_value")
        .join(regions, "region_key", "left")
        .join(days, "date_key", "left")
        .groupBy("period_date", "region", "hour", "day_of_week", "is_weekend")
        .agg(
            F.sum(v).alias("total_demand"),
            F.avg(v).alias("avg_demand"),
            F.max(v).alias("max_demand"),
            F.min(v).alias("min_demand"),
            F.var_samp(v).alias("demand_variance"),
            F.count(F.lit(1)).alias("record_count"),
        )
    )


def demand_summary(
    fct: DataFrame,
    dr: DataFrame,
    dd: DataFrame,
    as_of: dt.datetime,
    keep_record_count: bool = False,
) -> DataFrame:
    """``demand_summary_rows`` with ``summary_key`` (dense, by period then region) and a stamp."""
    keyed = grouped_key(demand_summary_rows(fct, dr, dd), "period_date", ["region"], name="summary_key")
    cols = ["summary_key", *SUMMARY_COLUMNS]
    if keep_record_count:
        cols.append("record_count")
    return keyed.select(*cols, ts_literal(as_of).alias("created_at"))
