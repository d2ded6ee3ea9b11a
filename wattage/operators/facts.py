"""Hourly fact: staging rows with region and calendar surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import grouped_key
from .sizing import small_side

FACT_COLUMNS = ("period_date", "date_key", "region_key", "hour", "demand_value", "demand_units", "loaded_at")

# Total order of the fact key: the reference orders by (period_date, region_key),
# which ties when one hour has several reading types; the type and the region
# code break the tie.
FACT_ORDER = ("period_date", "region_key", "data_type", "respondent")


def fct_hourly_rows(stg: DataFrame, dr: DataFrame, dd: DataFrame) -> DataFrame:
    """Fact rows without the surrogate key (keeps ``data_type``/``respondent`` for ordering).

    The calendar (a range or a stored table) is counted before it is broadcast. The region
    dimension is broadcast when it says so: ``dim_region`` hints it after counting
    it, a stored dimension is sized by its files; a larger one is shuffle-joined.
    The day of the reading is cast to ``date`` once so the calendar join compares dates.
    """
    regions = dr.select("respondent", "region_key")
    days = small_side(dd.select(F.col("date_value").alias("_day"), "date_key"), materialised=True)
    return (
        stg.select(
            "period_date",
            "respondent",
            "data_type",
            "hour",
            "demand_value",
            F.col("value_units").alias("demand_units"),
            "loaded_at",
            F.col("date_value").cast("date").alias("_day"),
        )
        .join(regions, "respondent", "left")
        .join(days, "_day", "left")
        .select(*FACT_COLUMNS, "data_type", "respondent")
    )


def fct_hourly(stg: DataFrame, dr: DataFrame, dd: DataFrame) -> DataFrame:
    """demand_key (dense, by period then region), then the fact columns."""
    rows = fct_hourly_rows(stg, dr, dd)
    keyed = grouped_key(rows, "period_date", list(FACT_ORDER), name="demand_key")
    return keyed.select("demand_key", *FACT_COLUMNS)
