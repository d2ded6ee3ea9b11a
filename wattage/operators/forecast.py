"""Daily forecasts for every series at once, as grouped aggregates.

Method (Hyndman & Athanasopoulos, *Forecasting: Principles and Practice*):
per series a least-squares line over the day number, a weekday effect = mean
residual per weekday, and a normal prediction interval from the sample standard
deviation of what is left. Every step is a ``groupBy`` over (series, day) rows,
so the work is split by series and day and never gathered in one task.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from statistics import NormalDist

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import day_of_week0, day_start, model_version, ts_literal
from ..session import ensure_checkpoint_dir

# Day numbers count from this origin (keeps the regression sums small).
DAY_ORIGIN = dt.date(2000, 1, 1)
MIN_POINTS = 14


def z_value(interval: float) -> float:
    """Two-sided normal quantile of a prediction interval (0.95 -> 1.95996...)."""
    return NormalDist().inv_cdf(0.5 + interval / 2.0)


def _day_number(c: str) -> F.Column:
    return F.datediff(F.col(c).cast("date"), F.lit(DAY_ORIGIN.isoformat()).cast("date")).cast("double")


def trailing_days(df: DataFrame, c: str, run_date: dt.datetime, days: int = 90) -> DataFrame:
    """Rows with ``c`` in the half-open window ``[run - days, run)``."""
    run = ts_literal(run_date)
    start = ts_literal(run_date - dt.timedelta(days=days))
    return df.filter((F.col(c) >= start) & (F.col(c) < run))


def train_daily(fct: DataFrame, dr: DataFrame, run_date: dt.datetime, days: int = 90) -> DataFrame:
    """Daily mean demand per region over the ``days`` before ``run_date`` (date, avg_demand_mw, region).

    Facts without a region in the dimension drop out (inner join), as in the reference.
    """
    regions = dr.select("region_key", F.col("respondent").alias("region"))
    if "date_key" in fct.columns:
        # Same window on the calendar key as well: a fact stored by date_key then
        # reads only the folders of those days (NULL keys: readings past the calendar).
        lo = int((run_date - dt.timedelta(days=days)).strftime("%Y%m%d"))
        fct = fct.filter(F.col("date_key").isNull() | F.col("date_key").between(lo, int(run_date.strftime("%Y%m%d"))))
    window = trailing_days(fct.select("period_date", "region_key", "demand_value"), "period_date", run_date, days)
    return (
        window.join(regions, "region_key", "inner")
        .groupBy(day_start("period_date").alias("date"), "region")
        .agg(F.avg("demand_value").alias("avg_demand_mw"))
    )


def usable_series(train: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """Training rows of series with at least ``min_points`` days (others are skipped).

    A count over each series' rows (at most one per day, so every window is
    small) keeps this to one pass over the training set.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy("region"))
    return train.withColumn("_n", n).filter(F.col("_n") >= min_points).drop("_n")


def skipped_series(train: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """Series that are too short to fit: region, n_points."""
    return train.groupBy("region").agg(F.count(F.lit(1)).alias("n_points")).filter(F.col("n_points") < min_points)


@dataclass(frozen=True)
class TrendWeekdayModel:
    series: DataFrame  # region, slope, intercept, sigma, last_date, n_points
    weekday: DataFrame  # region, day_of_week, effect


def fit_trend_weekday(train: DataFrame) -> TrendWeekdayModel:
    """Fit line + weekday effect per series; ``train`` has (date, avg_demand_mw, region).

    The (series, day) points are few (series x days) but are read by three
    aggregates; they are checkpointed once so the facts behind them are scanned
    once, not once per aggregate.
    """
    ensure_checkpoint_dir(train.sparkSession)
    pts = train.select(
        "region", "date", _day_number("date").alias("x"), F.col("avg_demand_mw").alias("y"), day_of_week0("date").alias("day_of_week")
    ).checkpoint(eager=True)
    line = pts.groupBy("region").agg(
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        F.max("date").alias("last_date"),
        F.count(F.lit(1)).alias("n_points"),
    )
    resid = pts.join(line.select("region", "slope", "intercept"), "region").select(
        "region", "day_of_week", (F.col("y") - (F.col("slope") * F.col("x") + F.col("intercept"))).alias("e")
    )
    weekday = resid.groupBy("region", "day_of_week").agg(F.avg("e").alias("effect"))
    sigma = (
        resid.join(weekday, ["region", "day_of_week"])
        .groupBy("region")
        .agg(F.stddev_samp(F.col("e") - F.col("effect")).alias("sigma"))
    )
    series = line.join(sigma, "region", "left").select("region", "slope", "intercept", "sigma", "last_date", "n_points")
    return TrendWeekdayModel(series, weekday)


def predict(model: TrendWeekdayModel, horizon: int = 7, interval: float = 0.95) -> DataFrame:
    """``horizon`` daily steps after each series' last day with a normal interval.

    Columns: series, ts, step, forecast, lower_bound, upper_bound (``step`` is the
    horizon in days). A weekday never seen in training gets effect 0.
    """
    ahead = model.series.select("region", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"), "last_date")
    days = ahead.select("region", F.date_add(F.col("last_date").cast("date"), F.col("step")).cast("timestamp_ntz").alias("ts"))
    return predict_at(model, days, interval)


def predict_at(model: TrendWeekdayModel, days: DataFrame, interval: float = 0.95) -> DataFrame:
    """The model's values on given ``days`` (region, ts), whatever gaps lie between."""
    z = z_value(interval)
    series = model.series.select("region", "slope", "intercept", "sigma", "last_date")
    steps = days.join(series, "region").select(
        "region", "slope", "intercept", "sigma", "ts",
        F.datediff(F.col("ts").cast("date"), F.col("last_date").cast("date")).alias("step"),
        day_of_week0("ts").alias("day_of_week"), _day_number("ts").alias("x"),
    )
    fc = steps.join(model.weekday, ["region", "day_of_week"], "left").select(
        F.col("region").alias("series"),
        "ts",
        "step",
        (F.col("slope") * F.col("x") + F.col("intercept") + F.coalesce(F.col("effect"), F.lit(0.0))).alias("forecast"),
        "sigma",
    )
    half = F.lit(z) * F.col("sigma")
    return fc.select(
        "series", "ts", "step", "forecast",
        (F.col("forecast") - half).alias("lower_bound"),
        (F.col("forecast") + half).alias("upper_bound"),
    )


def forecast_rows(pred: DataFrame, run_date: dt.datetime) -> DataFrame:
    """Shape predictions as forecast rows: region, forecast_date, forecast, bounds, generated_at."""
    return pred.select(
        F.replace(F.col("series"), F.lit('"'), F.lit("")).alias("region"),
        F.col("ts").alias("forecast_date"),
        "forecast",
        "lower_bound",
        "upper_bound",
        ts_literal(run_date).alias("generated_at"),
    )


def forecast_run(train: DataFrame, run_date: dt.datetime, horizon: int = 7, interval: float = 0.95, min_points: int = MIN_POINTS) -> DataFrame:
    """Skip short series, fit, predict and shape in one lazy plan."""
    model = fit_trend_weekday(usable_series(train, min_points))
    return forecast_rows(predict(model, horizon, interval), run_date)


def as_results(rows: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Forecast rows in the results table layout (``actual`` empty, stamped ``loaded_at``)."""
    return rows.select(
        "region", "forecast_date", F.lit(None).cast("double").alias("actual"), "forecast", "lower_bound", "upper_bound",
        "generated_at", ts_literal(as_of).alias("loaded_at"),
    )


def holdout(train: DataFrame, days: int) -> tuple[DataFrame, DataFrame]:
    """(earlier rows, rows of each series' last ``days`` calendar days)."""
    last = train.groupBy("region").agg(F.max("date").alias("_last"))
    held = F.col("date") > F.date_add(F.col("_last").cast("date"), -days).cast("timestamp_ntz")
    tagged = train.join(last, "region").withColumn("_hold", held)
    return tagged.filter(~F.col("_hold")).select(train.columns), tagged.filter(F.col("_hold")).select(train.columns)


def evaluate(train: DataFrame, run_date: dt.datetime, holdout_days: int = 7, interval: float = 0.95, min_points: int = MIN_POINTS) -> DataFrame:
    """Hold out each series' last ``holdout_days`` days, fit on the rest, score.

    One row per (region, metric) in the metrics table layout: MAE, RMSE, MAPE
    (in percent) and R2 over the held-out days, predicted for just those days. A
    series that is flat over them has no R2 (NULL), one that is 0 on a day no MAPE;
    series too short to fit are in ``skipped_series`` of ``fit_part``.
    """
    ensure_checkpoint_dir(train.sparkSession)
    train = train.checkpoint(eager=True)
    fit_part, hold = holdout(train, holdout_days)
    hold = hold.select("region", F.col("date").alias("ts"), F.col("avg_demand_mw").alias("actual"))
    model = fit_trend_weekday(usable_series(fit_part, min_points))
    pred = predict_at(model, hold.select("region", "ts"), interval).withColumnRenamed("series", "region")
    return metric_rows(pred.join(hold, ["region", "ts"], "inner"), run_date)


def metric_rows(scored: DataFrame, run_date: dt.datetime) -> DataFrame:
    """MAE, RMSE, MAPE and R2 per region of (region, actual, forecast), in the metrics table layout."""
    err = F.col("actual") - F.col("forecast")
    mean_actual = scored.groupBy("region").agg(F.avg("actual").alias("_mean"))
    s2 = scored.join(mean_actual, "region")
    stats = s2.groupBy("region").agg(
        F.avg(F.abs(err)).alias("MAE"),
        F.sqrt(F.avg(err * err)).alias("RMSE"),
        F.when(F.count_if(F.col("actual") == 0) == 0, F.avg(F.try_divide(F.abs(err), F.abs(F.col("actual")))) * 100.0).alias("MAPE"),
        (1.0 - F.try_divide(F.sum(err * err), F.sum((F.col("actual") - F.col("_mean")) * (F.col("actual") - F.col("_mean"))))).alias("R2"),
    )
    long = stats.select(
        "region",
        F.expr("stack(4, 'MAE', MAE, 'RMSE', RMSE, 'MAPE', MAPE, 'R2', R2) AS (metric_name, metric_value)"),
    )
    return long.select(
        model_version(run_date).alias("model_version"),
        ts_literal(run_date).alias("training_date"),
        "region",
        "metric_name",
        "metric_value",
        F.lit("holdout").alias("dataset_type"),
        ts_literal(run_date).alias("created_at"),
    )


def forecast_count_metrics(rows: DataFrame, run_date: dt.datetime) -> DataFrame:
    """Number of forecast rows per region as a metric row (FORECAST_PERIODS)."""
    return rows.groupBy("region").agg(F.count(F.lit(1)).cast("double").alias("metric_value")).select(
        model_version(run_date).alias("model_version"),
        ts_literal(run_date).alias("training_date"),
        "region",
        F.lit("FORECAST_PERIODS").alias("metric_name"),
        "metric_value",
        F.lit("forecast").alias("dataset_type"),
        ts_literal(run_date).alias("created_at"),
    )


def with_actuals(rows: DataFrame, daily: DataFrame) -> DataFrame:
    """Forecast rows with the day's actual mean, the error and whether it fell inside the interval."""
    actual = daily.select(F.col("respondent").alias("region"), F.col("period_day").alias("forecast_date"), F.col("avg_demand_mw").alias("actual"))
    j = rows.join(actual, ["region", "forecast_date"], "left")
    return j.select(
        *rows.columns,
        "actual",
        (F.col("actual") - F.col("forecast")).alias("prediction_error"),
        ((F.col("actual") >= F.col("lower_bound")) & (F.col("actual") <= F.col("upper_bound"))).alias("in_interval"),
    )


def history_with_forecast(daily: DataFrame, rows: DataFrame) -> DataFrame:
    """Actual daily means and forecasts as one series: region, date, value, bounds, kind."""
    past = daily.select(
        F.col("respondent").alias("region"), F.col("period_day").alias("date"), F.col("avg_demand_mw").alias("value"),
        F.lit(None).cast("double").alias("lower_bound"), F.lit(None).cast("double").alias("upper_bound"), F.lit("actual").alias("kind"),
    )
    ahead = rows.select(
        "region", F.col("forecast_date").alias("date"), F.col("forecast").alias("value"), "lower_bound", "upper_bound", F.lit("forecast").alias("kind"),
    )
    return past.unionByName(ahead)


def forecast_preview(rows: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` forecast rows by region and date (top-k)."""
    return rows.select("region", "forecast_date", "forecast", "lower_bound", "upper_bound").orderBy("region", "forecast_date").limit(n)
