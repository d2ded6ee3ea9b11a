"""Region dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import ts_literal
from .keys import dense_key
from .sizing import small_side

# Fixed value: the one region code labelled National; every other one is Regional.
NATIONAL_REGION = "US48"


def region_type(respondent: str = "respondent", national: str = NATIONAL_REGION):
    return F.when(F.col(respondent) == national, F.lit("National")).otherwise(F.lit("Regional"))


def region_pairs(stg: DataFrame, one_row_per_respondent: bool = False) -> DataFrame:
    """Distinct (respondent, respondent_name).

    ``one_row_per_respondent`` keeps only the name of the newest reading
    (``loaded_at``, then the name) so a renamed region does not double facts.
    """
    if not one_row_per_respondent:
        return stg.select("respondent", "respondent_name").distinct()
    latest = F.max_by(F.col("respondent_name"), F.struct(F.col("loaded_at"), F.col("respondent_name")))
    return stg.groupBy("respondent").agg(latest.alias("respondent_name"))


def dim_region(
    stg: DataFrame,
    as_of: dt.datetime,
    one_row_per_respondent: bool = False,
    national: str = NATIONAL_REGION,
) -> DataFrame:
    """region_key (by respondent, then name), respondent, name, type, created_at.

    The distinct (code, name) pairs are numbered by ``dense_key``, which stores them
    once; the dimension carries a broadcast hint where its measured size allows.
    """
    pairs = region_pairs(stg, one_row_per_respondent).withColumn("region_type", region_type(national=national))
    keyed = small_side(dense_key(pairs, ["respondent", "respondent_name"], name="region_key"), materialised=True)
    return keyed.select(
        "region_key", "respondent", "respondent_name", "region_type", ts_literal(as_of).alias("created_at")
    )

