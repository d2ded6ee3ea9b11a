"""Properties of the custom operators on small literal frames and the fixture."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from wattage.functions.time import ts_literal
from wattage.operators import forecast, history, marts, staging, upsert
from wattage.operators.keys import dense_key, dense_key_counted
from wattage.schemas import RAW_KEY
from wattage.sources import fixtures, pages
from wattage.sources.tables import RAW_UPDATE_COLS

T0 = dt.datetime(2024, 1, 31)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dense_key_equals_global_row_number_with_hot_key_and_nulls(spark):
    # one "day" holds most rows; the order column has NULLs
    df = spark.range(5000).select(
        F.when(F.col("id") % 10 < 7, F.lit(1)).otherwise(F.col("id") % 13).alias("day"),
        F.when(F.col("id") % 97 == 0, F.lit(None)).otherwise(F.col("id") % 101).alias("b"),
        F.col("id"),
    )
    keyed, n = dense_key_counted(df, ["day", "b", "id"], name="k", partitions=16)
    assert n == 5000
    w = Window.orderBy(F.col("day").asc_nulls_first(), F.col("b").asc_nulls_first(), F.col("id").asc_nulls_first())
    ref = df.select(F.row_number().over(w).cast("long").alias("k"), "day", "b", "id")
    assert keyed.exceptAll(ref).count() == 0 and ref.exceptAll(keyed).count() == 0


def test_dense_key_is_dense(spark):
    keyed = dense_key(spark.range(777).withColumn("x", F.col("id") * 3 % 11), ["x", "id"], "k", partitions=7)
    ks = sorted(r[0] for r in keyed.select("k").collect())
    assert ks == list(range(1, 778))


def test_upsert_twice_equals_once(spark, sf_dir):
    target = fixtures.raw_readings(spark, sf_dir)
    batch = upsert.dedupe_batch(fixtures.upsert_batch_source(spark, sf_dir), RAW_KEY, ["loaded_at"]).drop("loaded_at")
    stamp = ts_literal(T0)
    kw = dict(on_match={"loaded_at": stamp}, on_insert={"loaded_at": stamp})
    once = upsert.upsert(target, batch, RAW_KEY, RAW_UPDATE_COLS, **kw)
    twice = upsert.upsert(once, batch, RAW_KEY, RAW_UPDATE_COLS, **kw)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    new_keys = batch.join(target, list(RAW_KEY), "left_anti").count()
    assert once.count() == target.count() + new_keys


def test_upsert_with_bucket_equals_plain(spark, sf_dir):
    target = fixtures.raw_readings(spark, sf_dir)
    batch = upsert.dedupe_batch(fixtures.upsert_batch_source(spark, sf_dir), RAW_KEY, ["loaded_at"]).drop("loaded_at")
    stamp = ts_literal(T0)
    kw = dict(on_match={"loaded_at": stamp}, on_insert={"loaded_at": stamp})
    plain = upsert.upsert(target, batch, RAW_KEY, RAW_UPDATE_COLS, **kw)
    bucketed = upsert.upsert(target, batch, RAW_KEY, RAW_UPDATE_COLS, bucket=F.to_date("period_date"), **kw)
    assert plain.exceptAll(bucketed).count() == 0 and bucketed.exceptAll(plain).count() == 0


def test_dedupe_batch_keeps_newest_then_all_columns(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0, 5), (1, "b", 2.0, 7), (1, "c", 3.0, 7), (2, "z", None, 1)],
        "k int, name string, v double, ts int",
    )
    out = _rows(upsert.dedupe_batch(df, ["k"], ["ts"]))
    assert out == [(1, "c", 3.0, 7), (2, "z", None, 1)]


def test_scd2_without_change_adds_nothing(spark, sf_dir):
    raw = fixtures.raw_readings(spark, sf_dir)
    t1, t2 = dt.datetime(2024, 1, 16), dt.datetime(2024, 1, 31)
    h1 = history.scd2(None, history.region_history_input(raw, t1), "respondent", as_of=t1)
    h2 = history.scd2(h1, history.region_history_input(raw, t2), "respondent", as_of=t2)
    assert h1.exceptAll(h2).count() == 0 and h2.exceptAll(h1).count() == 0


def test_scd2_check_all_changes_every_row(spark, sf_dir):
    raw = fixtures.raw_readings(spark, sf_dir)
    t1, t2 = dt.datetime(2024, 1, 16), dt.datetime(2024, 1, 31)
    h1 = history.scd2(None, history.region_history_input(raw, t1), "respondent", as_of=t1)
    h2 = history.scd2(h1, history.region_history_input(raw, t2), "respondent", check_cols="all", as_of=t2)
    n = h1.count()
    assert h2.count() == 2 * n
    assert h2.filter("is_current").count() == n


def test_scd2_states(spark):
    schema = "respondent string, respondent_name string, region_type string, created_at timestamp_ntz"
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    first = spark.createDataFrame([("A", "a", "R", t1), ("B", "b", "R", t1), ("C", "c", "R", t1)], schema)
    second = spark.createDataFrame([("A", "a", "R", t2), ("B", "b2", "R", t2), ("D", "d", "R", t2)], schema)
    h = history.scd2(history.scd2(None, first, "respondent", as_of=t1), second, "respondent", as_of=t2)
    got = {(r.respondent, r.respondent_name, r.is_current, r.valid_to) for r in h.collect()}
    assert got == {
        ("A", "a", True, None),
        ("B", "b", False, t2),
        ("B", "b2", True, None),
        ("C", "c", True, None),
        ("D", "d", True, None),
    }
    at = history.as_of_view(h, dt.datetime(2024, 1, 15))
    assert sorted(r.respondent_name for r in at.collect()) == ["a", "b", "c"]


def test_daily_totals_equal_hourly_totals(spark, sf_dir):
    stg = staging.stg_hourly(fixtures.raw_readings(spark, sf_dir))
    daily = marts.daily_demand(stg).agg(F.sum("total_demand_mwh"), F.sum("hourly_record_count")).first()
    hourly = staging.demand_by_region(stg).agg(F.sum("total_demand"), F.sum("record_count")).first()
    assert abs(daily[0] - hourly[0]) < 1e-6 and daily[1] == hourly[1]


def test_forecast_shape_and_interval(spark, sf_dir):
    from wattage.operators import calendar, dims, facts

    stg = staging.stg_hourly(fixtures.raw_readings(spark, sf_dir))
    dr = dims.dim_region(stg, T0)
    fct = facts.fct_hourly_rows(stg, dr, calendar.dim_date(spark))
    train = forecast.train_daily(fct, dr, T0, 90)
    usable = forecast.usable_series(train).select("region").distinct().count()
    fc = forecast.forecast_run(train, T0)
    assert fc.count() == 7 * usable
    assert fc.filter(~((F.col("lower_bound") <= F.col("forecast")) & (F.col("forecast") <= F.col("upper_bound")))).count() == 0
    assert fc.filter(F.col("forecast_date") <= ts_literal(dt.datetime(2024, 1, 30))).count() == 0


def test_short_series_are_skipped(spark):
    rows = [("long", dt.datetime(2024, 1, 1) + dt.timedelta(days=i), 10.0 + i) for i in range(20)]
    rows += [("short", dt.datetime(2024, 1, 1) + dt.timedelta(days=i), 5.0) for i in range(3)]
    train = spark.createDataFrame(rows, "region string, date timestamp_ntz, avg_demand_mw double")
    fc = forecast.forecast_run(train, T0)
    assert {r.region for r in fc.select("region").distinct().collect()} == {"long"}
    assert [r.region for r in forecast.skipped_series(train).collect()] == ["short"]
    # a straight line is forecast exactly, with a zero-width interval
    got = {r.forecast_date.day: r.forecast for r in fc.collect()}
    assert abs(got[21] - 30.0) < 1e-6


def test_newest_per_region_matches_window_under_skew(spark):
    # region "hot" holds most rows
    base = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("cold")).otherwise(F.lit("hot")).alias("respondent"),
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_interval(hours=(F.col("id") % 500).cast("int"))).alias("period_date"),
        (F.col("id") % 7).cast("string").alias("data_type"),
    ).dropDuplicates(["respondent", "period_date", "data_type"])
    got = pages.newest_per_region(base, n=321)
    w = Window.partitionBy("respondent").orderBy(F.col("period_date").desc(), F.col("data_type").desc())
    ref = base.withColumn("rn", F.row_number().over(w)).filter("rn <= 321").drop("rn")
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_dim_region_large_path_equals_small_path(spark, sf_dir, monkeypatch):
    from wattage.operators import dims

    stg = staging.stg_hourly(fixtures.raw_readings(spark, sf_dir))
    small = dims.dim_region(stg, T0)
    monkeypatch.setattr(dims, "small_side", lambda df, **_: df)  # too large to broadcast
    large = dims.dim_region(stg, T0)
    assert small.exceptAll(large).count() == 0 and large.exceptAll(small).count() == 0
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
