"""Boosted-tree forecaster pooled over all series (MLlib), with feature importance.

Features per (series, day): the mean of the day before and of the same day a week
earlier (by date, not by row: a gap gives no lag), the weekday and the day number.
The trees are fitted by MLlib's distributed gradient boosting (Friedman 2001);
forecasts are made day by day, each day's forecast being the next day's lag. Their
intervals are checked, not assumed: the same way of forecasting is tried from earlier origins,
by a model that has not seen what follows them, and the errors found at each step give its width.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.time import day_of_week0, model_version, ts_literal
from ..session import ensure_checkpoint_dir
from .forecast import DAY_ORIGIN, MIN_POINTS, forecast_rows, usable_series, z_value
from .regression import origins

FEATURES = ("lag_1", "lag_7", "day_of_week", "day_number")


def _with_features(days: DataFrame) -> DataFrame:
    """(region, date, label) -> the same with the features; lags are those of the dates one and seven days before."""
    number = F.datediff(F.col("date").cast("date"), F.lit(DAY_ORIGIN.isoformat()).cast("date"))
    dated = days.withColumn("_n", number)
    by_day = Window.partitionBy("region").orderBy("_n")  # one row per day of a series
    return dated.select(
        "region",
        "date",
        "label",
        F.max("label").over(by_day.rangeBetween(-1, -1)).alias("lag_1"),
        F.max("label").over(by_day.rangeBetween(-7, -7)).alias("lag_7"),
        day_of_week0("date").cast("double").alias("day_of_week"),
        F.col("_n").cast("double").alias("day_number"),
    )


def gbt_features(train: DataFrame) -> DataFrame:
    """(region, date, label, lag_1, lag_7, day_of_week, day_number); days without a
    reading on both lag dates are left out (the first week, days after a gap)."""
    rows = _with_features(train.select("region", "date", F.col("avg_demand_mw").alias("label")))
    return rows.filter(F.col("lag_1").isNotNull() & F.col("lag_7").isNotNull())


@dataclass(frozen=True)
class GbtForecaster:
    model: PipelineModel
    features: tuple[str, ...] = FEATURES


def fit_gbt(train: DataFrame, max_iter: int = 20, max_depth: int = 4, seed: int = 42) -> GbtForecaster:
    """Fit one boosted-tree model on the lag/calendar features of all series."""
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    gbt = GBTRegressor(featuresCol="features", labelCol="label", maxIter=max_iter, maxDepth=max_depth, seed=seed)
    # The boosting loop passes over the feature rows once per tree; they are a
    # small (series x days) table, materialised once so the facts are scanned once.
    ensure_checkpoint_dir(train.sparkSession)
    rows = gbt_features(train).checkpoint(eager=True)
    model = Pipeline(stages=[assembler, gbt]).fit(rows)
    return GbtForecaster(model)


def gbt_fitted(forecaster: GbtForecaster, train: DataFrame) -> DataFrame:
    """One-day-ahead predictions on the training days: region, date, actual, prediction."""
    scored = forecaster.model.transform(gbt_features(train))
    return scored.select("region", "date", F.col("label").alias("actual"), "prediction")


def _path(forecaster: GbtForecaster, train: DataFrame, horizon: int, min_points: int) -> DataFrame:
    """(region, date, step, forecast): the ``horizon`` days after each usable series' last day.

    Each day is predicted from the days before it, forecasts included. A lag date
    without a reading takes the series' mean.
    """
    ensure_checkpoint_dir(train.sparkSession)
    known = usable_series(train, min_points).select("region", "date", F.col("avg_demand_mw").alias("label")).checkpoint(eager=True)
    facts = known.groupBy("region").agg(F.max("date").alias("last"), F.avg("label").alias("mean")).checkpoint(eager=True)
    for step in range(1, horizon + 1):
        day = facts.select("region", F.date_add(F.col("last").cast("date"), step).cast("timestamp_ntz").alias("date"), F.lit(None).cast("double").alias("label"))
        near = known.join(facts.select("region", "last"), "region").filter(F.col("date") >= F.date_add(F.col("last").cast("date"), step - 7).cast("timestamp_ntz"))
        rows = _with_features(near.select("region", "date", "label").unionByName(day)).filter(F.col("label").isNull()).join(facts.select("region", "mean"), "region")
        rows = rows.withColumn("lag_1", F.coalesce("lag_1", "mean")).withColumn("lag_7", F.coalesce("lag_7", "mean"))
        made = forecaster.model.transform(rows).select("region", "date", F.col("prediction").alias("label"))
        # One small table (series x days), stored so that each step reads the last one's forecasts.
        known = known.unionByName(made).checkpoint(eager=True)
    ahead = known.join(facts.select("region", "last"), "region").filter(F.col("date") > F.col("last"))
    return ahead.select("region", "date", F.datediff(F.col("date").cast("date"), F.col("last").cast("date")).alias("step"), F.col("label").alias("forecast"))


def _scales(train: DataFrame) -> DataFrame:
    """(region, scale): the deviation of a series' daily means; 1 for one that does not vary."""
    spread = F.stddev_samp("avg_demand_mw")
    return train.groupBy("region").agg(F.coalesce(F.when(spread > 0, spread), F.lit(1.0)).alias("scale"))


def gbt_backtest(train: DataFrame, horizon: int = 7, count: int = 3, every: int = 2, min_points: int = MIN_POINTS) -> DataFrame | None:
    """Forecasts from ``count`` origins against what came: region, origin, step, actual, forecast, scale.

    One model, fitted on the days up to each series' earliest origin, forecasts from all of
    them at once (a series and an origin make a series of their own). Origins with fewer than
    ``min_points`` days before them give no rows; None if no series has enough.
    """
    cuts = origins(train, count, every, horizon)
    first = cuts.groupBy("region").agg(F.min("origin").alias("origin"))
    early = usable_series(train.join(first, "region").filter(F.col("date") <= F.col("origin")).select(train.columns), min_points)
    ensure_checkpoint_dir(train.sparkSession)
    early = early.checkpoint(eager=True)
    if gbt_features(early).isEmpty():
        return None
    fold = F.concat_ws("\u0001", "region", F.date_format("origin", "yyyyMMdd"))
    folds = train.join(cuts, "region").filter(F.col("date") <= F.col("origin")).withColumn("fold", fold).checkpoint(eager=True)
    path = _path(fit_gbt(early), folds.select(F.col("fold").alias("region"), "date", "avg_demand_mw"), horizon, min_points).withColumnRenamed("region", "fold")
    named = path.join(folds.select("fold", "region", "origin").distinct(), "fold")
    actual = train.select("region", "date", F.col("avg_demand_mw").alias("actual"))
    scored = named.join(actual, ["region", "date"]).join(_scales(early), "region")
    return scored.select("region", "origin", "step", "actual", "forecast", "scale").checkpoint(eager=True)


def interval_widths(scored: DataFrame, interval: float = 0.95) -> DataFrame:
    """(step, width): the ``interval`` quantile of the errors at a step, in scales of their series, over all series."""
    error = F.abs(F.col("actual") - F.col("forecast")) / F.col("scale")
    return scored.groupBy("step").agg(F.percentile(error, interval).alias("width"))


def gbt_forecast(
    forecaster: GbtForecaster, train: DataFrame, run_date: dt.datetime, horizon: int = 7, interval: float = 0.95, min_points: int = MIN_POINTS,
    scored: DataFrame | None = None,
) -> DataFrame:
    """Forecast rows (as ``forecast_rows``) for the ``horizon`` days after each usable series' last day.

    The interval is as wide as the errors of ``gbt_backtest`` (or the given ``scored``) at the
    same step ask for. Where there was no day to try, it is normal with the deviation of the
    one-day-ahead residuals, growing with the root of the step.
    """
    path = _path(forecaster, train, horizon, min_points)
    fitted = gbt_fitted(forecaster, train)
    sigma = fitted.groupBy("region").agg(F.stddev_samp(F.col("actual") - F.col("prediction")).alias("sigma"))
    scored = gbt_backtest(train, horizon, min_points=min_points) if scored is None else scored
    steps = F.lit(z_value(interval)) * F.col("sigma") * F.sqrt("step")
    rows = path.join(sigma, "region", "left").join(_scales(train), "region")
    if scored is not None:
        rows = rows.join(F.broadcast(interval_widths(scored, interval)), "step", "left")  # a row per step
        half = F.coalesce(F.col("width") * F.col("scale"), steps)
    else:
        half = steps
    out = rows.select(
        F.col("region").alias("series"), F.col("date").alias("ts"), "forecast",
        (F.col("forecast") - half).alias("lower_bound"), (F.col("forecast") + half).alias("upper_bound"),
    )
    return forecast_rows(out, run_date)


def feature_importance(forecaster: GbtForecaster, run_date: dt.datetime) -> DataFrame:
    """model_version, feature_name, importance_score, rank (1 = most important), created_at.

    The importance vector has one entry per feature; it is the only thing built
    on the driver.
    """
    scores = forecaster.model.stages[-1].featureImportances.toArray().tolist()
    session = SparkSession.getActiveSession()
    df = session.createDataFrame(
        [(name, float(score)) for name, score in zip(forecaster.features, scores)], "feature_name string, importance_score double"
    )
    rank = F.row_number().over(Window.orderBy(F.desc("importance_score"), "feature_name"))
    return df.select(
        model_version(run_date).alias("model_version"),
        "feature_name",
        "importance_score",
        rank.alias("rank"),
        ts_literal(run_date).alias("created_at"),
    )
