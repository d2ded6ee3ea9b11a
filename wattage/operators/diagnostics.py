"""Diagnostics over the layers: counts, coverage, drop-off between layers, previews."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import ts_literal


def coverage(df: DataFrame, key: str, ts: str, count_name: str = "n_rows", first_name: str = "earliest", last_name: str = "latest") -> DataFrame:
    """Per key: row count, first and last timestamp."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias(count_name), F.min(ts).alias(first_name), F.max(ts).alias(last_name)
    )


def key_counts(df: DataFrame, key: str, count_name: str = "n_rows") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name))


def region_counts(fct: DataFrame, dr: DataFrame) -> DataFrame:
    """Fact rows per region (inner join to the dimension), largest first."""
    regions = dr.select("region_key", "respondent")
    return (
        fct.select("region_key")
        .join(regions, "region_key", "inner")
        .groupBy("respondent")
        .agg(F.count(F.lit(1)).alias("record_count"))
        .orderBy(F.desc("record_count"), "respondent")
    )


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """One row per named layer with its row count; one job for all layers."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("layer"), "n_rows") for name, df in layers.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def layer_dropoff(raw: DataFrame, stg: DataFrame, fct: DataFrame, dr: DataFrame) -> DataFrame:
    """Rows per region in raw, staging and fact (via the dimension): where rows are lost."""
    regions = dr.select("region_key", "respondent")
    r = key_counts(raw, "respondent", "raw_count")
    s = key_counts(stg, "respondent", "staging_count")
    f = key_counts(fct.select("region_key").join(regions, "region_key", "inner"), "respondent", "fact_count")
    out = r.join(s, "respondent", "full_outer").join(f, "respondent", "full_outer")
    return out.select(
        "respondent",
        F.coalesce("raw_count", F.lit(0)).alias("raw_count"),
        F.coalesce("staging_count", F.lit(0)).alias("staging_count"),
        F.coalesce("fact_count", F.lit(0)).alias("fact_count"),
    )


def loaded_on(df: DataFrame, day: dt.date) -> DataFrame:
    """Rows whose ``loaded_at`` falls on ``day``."""
    return df.filter(F.to_date("loaded_at") == F.lit(day.isoformat()).cast("date"))


def run_rows(df: DataFrame, run_date: dt.datetime) -> DataFrame:
    """Rows generated by the run at ``run_date``."""
    return df.filter(F.col("generated_at") == ts_literal(run_date))
