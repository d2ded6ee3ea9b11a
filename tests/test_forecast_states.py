"""Mergeable regression state, forecasts from many origins, and checked intervals."""

import datetime as dt
import random

from pyspark.sql import functions as F

from wattage.operators import boosted, forecast, regression

RUN = dt.datetime(2024, 6, 1)


def _series(spark, days=80, regions=8, gaps=True, seed=1):
    rng = random.Random(seed)
    rows = []
    for r in range(regions):
        level, slope = rng.uniform(50, 5_000), rng.uniform(-2, 2)
        for d in range(days):
            day = dt.datetime(2024, 3, 1) + dt.timedelta(days=d)
            if gaps and r and rng.random() < 0.1:
                continue
            y = level + slope * d + 20 * (day.weekday() >= 5) + rng.gauss(0, 5)
            rows.append((day, float(y), f"r{r}"))
    rows += [(dt.datetime(2024, 5, 1), 3.0, "one day")]
    return spark.createDataFrame(rows, "date timestamp_ntz, avg_demand_mw double, region string")


def _near(a, b, tolerance=1e-6):
    return (a is None) == (b is None) and (a is None or abs(a - b) <= tolerance * max(1, abs(b)))


def test_merged_states_equal_the_fit_on_points(spark):
    train = _series(spark)
    model = forecast.fit_trend_weekday(forecast.usable_series(train))
    state = regression.day_state(train)
    thirds = [state.filter(F.dayofyear("date") % 3 == i) for i in range(3)]
    merged = [regression.merge_states(s, "region", "day_of_week") for s in thirds]
    lines, effects = regression.fit_states(merged[2].unionByName(merged[0]).unionByName(merged[1]), "region")
    got = {r.region: r for r in lines.collect()}
    for r in model.series.collect():
        mine = got[r.region]
        assert mine.n_points == r.n_points and all(_near(mine[c], r[c]) for c in ("slope", "intercept", "sigma"))
    effect = {(r.region, r.day_of_week): r.effect for r in effects.collect()}
    for r in model.weekday.collect():
        assert _near(effect[r.region, r.day_of_week], r.effect)
    assert got["one day"].slope is None and got["one day"].n_points == 1


def test_backtest_equals_a_fit_per_origin(spark):
    train = _series(spark, days=40, regions=3)
    got = {(r.region, r.origin, r.step): r for r in regression.backtest(train, count=3, every=4, horizon=5).collect()}
    cuts = [r for r in regression.origins(train, 3, 4, 5).collect() if r.region != "one day"]
    found = 0
    for region, origin in cuts:
        known = train.filter((F.col("region") == region) & (F.col("date") <= F.lit(origin)))
        days = train.filter((F.col("region") == region) & (F.col("date") > F.lit(origin)) & (F.col("date") <= F.lit(origin + dt.timedelta(days=5))))
        wanted = {r.ts: r.forecast for r in forecast.predict_at(forecast.fit_trend_weekday(known), days.select("region", F.col("date").alias("ts"))).collect()}
        for ts, value in wanted.items():
            assert _near(got[region, origin, (ts - origin).days].forecast, value)
            found += 1
    assert found == len(got) > 30


def test_train_from_daily_equals_training_from_the_fact(spark, sf_dir):
    from wattage.operators import calendar, dims, facts, marts, staging
    from wattage.sources import fixtures

    stg = staging.stg_hourly(fixtures.raw_readings(spark, sf_dir))
    dr = dims.dim_region(stg.filter("respondent <> 'error'"), RUN)  # a region that the dimension lacks drops out
    run = dt.datetime(2024, 1, 31)
    want = {(r.date, r.region): r.avg_demand_mw for r in forecast.train_daily(facts.fct_hourly_rows(stg, dr, calendar.dim_date(spark)), dr, run, 20).collect()}
    daily = marts.daily_from_hourly(staging.demand_by_region(stg))
    got = {(r.date, r.region): r.avg_demand_mw for r in regression.train_from_daily(daily, dr, run, 20).collect()}
    assert got.keys() == want.keys() and all(_near(got[k], want[k]) for k in want)


def test_boosted_intervals_cover_what_comes(spark):
    """Held-out weeks lie inside the 90 % interval about as often as it says; rows are horizon x usable series."""
    train = _series(spark, days=87, regions=12, gaps=False, seed=4).checkpoint()
    cut = dt.datetime(2024, 3, 1) + dt.timedelta(days=80)
    known = train.filter(F.col("date") < F.lit(cut))
    rows = boosted.gbt_forecast(boosted.fit_gbt(known), known, cut, 7, 0.9)
    scored = rows.join(train.select("region", F.col("date").alias("forecast_date"), F.col("avg_demand_mw").alias("actual")), ["region", "forecast_date"]).collect()
    assert rows.count() == len(scored) == 7 * 12
    inside = sum(r.lower_bound <= r.actual <= r.upper_bound for r in scored) / len(scored)
    assert 0.75 <= inside <= 1.0
    assert all(r.lower_bound <= r.forecast <= r.upper_bound for r in scored)


def test_boosted_backtest_of_short_series_is_none(spark):
    assert boosted.gbt_backtest(_series(spark, days=10, regions=2)) is None
