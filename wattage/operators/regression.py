"""Mergeable state of the trend + weekday model, and its evaluation from many origins.

The model of ``forecast.fit_trend_weekday`` (a line over the day number, the mean residual of
each weekday, the deviation of what is left) needs no points, only sums of n, x, y, xx, xy and
yy per series and weekday. Sums add up: a day's state comes from the daily mart, a training
window is the sum of its days, and a later window is an earlier one plus the days since. x is
a whole day number, so its sums are exact; products with y are centred after summing.

``backtest`` makes use of that: running sums over the days give the state at every origin, so
forecasts from several origins are one plan over (series, day) rows, not a fit per origin.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import day_of_week0
from .forecast import MIN_POINTS, trailing_days

SUMS = ("n", "sx", "sxx", "sy", "sxy", "syy")
EPOCH = "2000-01-01"


def day_number(c: str) -> Column:
    """Whole days since 2000-01-01 (long)."""
    return F.datediff(F.col(c).cast("date"), F.lit(EPOCH).cast("date")).cast("long")


def train_from_daily(daily: DataFrame, dr: DataFrame, run_date: dt.datetime, days: int = 90) -> DataFrame:
    """``forecast.train_daily`` from the daily mart: (date, avg_demand_mw, region), without the hourly fact.

    A region whose name changed has a row per name and day; their totals and counts add up.
    Regions that the dimension does not hold drop out, as there.
    """
    regions = dr.select(F.col("respondent").alias("region")).distinct()
    window = trailing_days(daily, "period_day", run_date, days).withColumnRenamed("respondent", "region")
    sums = window.join(regions, "region", "left_semi").groupBy(F.col("period_day").alias("date"), "region").agg(
        F.sum("total_demand_mwh").alias("_total"), F.sum("hourly_record_count").alias("_n")
    )
    return sums.select("date", (F.col("_total") / F.col("_n")).alias("avg_demand_mw"), "region")


def day_state(train: DataFrame) -> DataFrame:
    """State of each (region, date): day_of_week and the sums over its points (one, or more if a day repeats)."""
    x, y = F.col("_x"), F.col("avg_demand_mw")
    rows = train.filter(y.isNotNull()).select("region", "date", "avg_demand_mw", day_number("date").alias("_x"), day_of_week0("date").alias("day_of_week"))
    return rows.groupBy("region", "date", "day_of_week").agg(
        F.count(F.lit(1)).alias("n"), F.sum(x).alias("sx"), F.sum(x * x).alias("sxx"), F.sum(y).alias("sy"), F.sum(x * y).alias("sxy"), F.sum(y * y).alias("syy"),
    )


def merge_states(state: DataFrame, *by: str) -> DataFrame:
    """Sum states over everything but ``by``; states of any days, windows or merges of them add up alike."""
    return state.groupBy(*by).agg(*[F.sum(c).alias(c) for c in SUMS])


def _centred(a: str, b: str, ab: str) -> Column:
    """Sum of products about the means."""
    return F.col(ab) - F.col(a) * F.col(b) / F.col("n")


def fit_states(state: DataFrame, *series: str) -> tuple[DataFrame, DataFrame]:
    """(lines, effects) from states by ``series`` and day_of_week.

    Lines: slope, intercept, sigma, n_points. Effects: the weekday's mean residual. Equal to
    fitting the points; a series of one day has no slope, and no forecast.
    """
    whole = merge_states(state, *series)
    line = whole.select(
        *series, F.col("n").alias("n_points"), (F.col("sx") / F.col("n")).alias("_mx"), (F.col("sy") / F.col("n")).alias("_my"),
        F.try_divide(_centred("sx", "sy", "sxy"), _centred("sx", "sx", "sxx")).alias("slope"),
    )
    by_day = merge_states(state, *series, "day_of_week").join(line, list(series))
    # A weekday's mean residual is its mean point's distance from the line, and what is left of a
    # point then is its distance from the weekday's mean less slope times that of its day.
    effect = (F.col("sy") / F.col("n") - F.col("_my")) - F.col("slope") * (F.col("sx") / F.col("n") - F.col("_mx"))
    left = _centred("sy", "sy", "syy") - 2 * F.col("slope") * _centred("sx", "sy", "sxy") + F.col("slope") * F.col("slope") * _centred("sx", "sx", "sxx")
    effects = by_day.select(*series, "day_of_week", effect.alias("effect"), left.alias("_left"))
    sigma = effects.groupBy(*series).agg(F.sum("_left").alias("_left"))
    # Rounding may leave a sum of squares just under nought.
    lines = line.join(sigma, list(series)).select(
        *series, "slope", (F.col("_my") - F.col("slope") * F.col("_mx")).alias("intercept"),
        F.sqrt(F.try_divide(F.greatest("_left", F.lit(0.0)), F.col("n_points") - 1)).alias("sigma"), "n_points",
    )
    return lines, effects.drop("_left")


def origins(train: DataFrame, count: int, every: int, horizon: int) -> DataFrame:
    """(region, origin): ``count`` cut days per series, ``every`` days apart, the last one ``horizon`` days before its end."""
    last = train.groupBy("region").agg(F.max("date").alias("_last"))
    steps = F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("_i")
    rows = last.select("region", "_last", steps)
    return rows.select("region", F.date_sub(F.col("_last").cast("date"), F.lit(horizon) + F.col("_i") * every).cast("timestamp_ntz").alias("origin"))


def backtest(train: DataFrame, count: int = 4, every: int = 7, horizon: int = 7, min_points: int = MIN_POINTS) -> DataFrame:
    """Forecasts made at several origins against what came: region, origin, step, date, actual, forecast, sigma.

    Each origin's model knows the days up to it; days without a reading in the ``horizon`` days
    after it give no row, origins with fewer than ``min_points`` days before them none at all.
    A weekday never seen before its origin has effect 0.
    """
    cuts = origins(train, count, every, horizon)
    # Running sums per weekday: the row of the last such day up to an origin holds the state at it.
    upto = Window.partitionBy("region", "day_of_week").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    running = day_state(train).select("region", "day_of_week", "date", *[F.sum(c).over(upto).alias(c) for c in SUMS])
    at = running.join(cuts, "region").filter(F.col("date") <= F.col("origin"))
    at = at.groupBy("region", "origin", "day_of_week").agg(F.max_by(F.struct(*SUMS), "date").alias("s")).select("region", "origin", "day_of_week", "s.*")
    lines, effects = fit_states(at, "region", "origin")
    lines = lines.filter((F.col("n_points") >= min_points) & F.col("slope").isNotNull())
    ahead = F.datediff(F.col("date").cast("date"), F.col("origin").cast("date"))
    held = train.select("region", "date", F.col("avg_demand_mw").alias("actual")).join(cuts, "region").withColumn("step", ahead)
    held = held.filter(F.col("step").between(1, horizon)).withColumn("day_of_week", day_of_week0("date"))
    scored = held.join(lines, ["region", "origin"]).join(effects, ["region", "origin", "day_of_week"], "left")
    forecast = F.col("slope") * day_number("date") + F.col("intercept") + F.coalesce("effect", F.lit(0.0))
    return scored.select("region", "origin", "step", "date", "actual", forecast.alias("forecast"), "sigma")


def errors_by_step(scored: DataFrame) -> DataFrame:
    """region, step, n_origins, MAE, RMSE and bias (mean of actual - forecast) of ``backtest`` rows."""
    e = F.col("actual") - F.col("forecast")
    return scored.groupBy("region", "step").agg(
        F.count(F.lit(1)).alias("n_origins"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias")
    )
