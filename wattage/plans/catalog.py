"""Named queries of the library over the driver's test tables.

Each entry takes (spark, sf_dir) and returns a lazy DataFrame. Doubles that
come out of sums and averages are rounded to 6 places here (summation order
differs between engines); the library functions return them unrounded. The
matching DuckDB text of every entry lives in ``oracle.py``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import day_start, ts_literal
from ..operators import boosted, calendar, diagnostics, dims, facts, forecast, history, marts, quality, regression, staging, upsert
from ..operators.keys import dense_key
from ..schemas import FORECAST_KEY, METRIC_KEY, RAW_KEY
from ..session import configure, scratch_path
from ..sources import fixtures, pages, tables
from ..sources.fixtures import AS_OF, RUN_DATE, SNAPSHOT_T1, SNAPSHOT_T2
from ..sources.tables import RAW_UPDATE_COLS
from ..streaming.ingest import ingest_stream
from . import jobs

# The fixture's National region (FIXTURES.md: `click` plays it).
FIXTURE_NATIONAL = "click"
SNAPSHOT_T3 = dt.datetime(2024, 2, 15)

Query = Callable[[SparkSession, str], DataFrame]


def _round(df: DataFrame, cols: list[str], places: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(c), places).alias(c) if c in cols else F.col(c) for c in df.columns])


def _stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return staging.stg_hourly(fixtures.raw_readings(spark, sf_dir))


def _dims(spark: SparkSession, sf_dir: str):
    stg = _stg(spark, sf_dir)
    dr = dims.dim_region(stg, AS_OF, national=FIXTURE_NATIONAL)
    dd = calendar.dim_date(spark)
    return stg, dr, dd


# -- staging ---------------------------------------------------------------

def q_stg_hourly(spark, sf_dir):
    return _stg(spark, sf_dir)


def q_demand_by_region(spark, sf_dir):
    df = staging.demand_by_region(_stg(spark, sf_dir))
    return _round(df, ["total_demand", "avg_demand", "max_demand", "min_demand"])


DAILY_DOUBLES = ["avg_demand_mw", "min_demand_mw", "max_demand_mw", "total_demand_mwh"]


def q_daily_demand(spark, sf_dir):
    return _round(marts.daily_demand(_stg(spark, sf_dir)), DAILY_DOUBLES)


def q_forecast_vs_actual(spark, sf_dir):
    return _round(marts.forecast_vs_actual(_stg(spark, sf_dir)), DAILY_DOUBLES)


def q_daily_demand_lineitem(spark, sf_dir):
    configure(spark)
    stg = staging.stg_hourly(fixtures.lineitem_readings(spark, sf_dir))
    # Prices have two decimals: summed as decimals the total is exact, and the mean its quotient.
    df = marts.daily_demand(stg.withColumn("demand_value", F.col("demand_value").cast("decimal(18,2)")))
    exact = df.select(*[F.col(c).cast("double").alias(c) if c in DAILY_DOUBLES else F.col(c) for c in df.columns])
    return exact.withColumn("avg_demand_mw", F.col("total_demand_mwh") / F.col("hourly_record_count"))


# -- calendar ----------------------------------------------------------------

def q_dim_date(spark, sf_dir):
    configure(spark)
    start, end = calendar.calendar_bounds(fixtures.raw_readings(spark, sf_dir), start=None, end=None)
    return calendar.dim_date(spark, start, end)


def q_dim_date_holidays(spark, sf_dir):
    """The calendar with the Sundays that have readings marked as holidays."""
    configure(spark)
    raw = fixtures.raw_readings(spark, sf_dir)
    start, end = calendar.calendar_bounds(raw, start=None, end=None)
    days = raw.filter(F.dayofweek("period_date") == 1).select(F.to_date("period_date").alias("date_value"))
    return calendar.dim_date(spark, start, end, holidays=days)


def q_calendar_head(spark, sf_dir):
    return calendar.calendar_head(q_dim_date(spark, sf_dir), 10)


# -- dimensions, keys, facts, summary ----------------------------------------

def q_dim_region(spark, sf_dir):
    _, dr, _ = _dims(spark, sf_dir)
    return dr


def q_region_list(spark, sf_dir):
    """The region dimension in key order (a small, ordered report)."""
    _, dr, _ = _dims(spark, sf_dir)
    return dr.select("region_key", "respondent", "respondent_name", "region_type").orderBy("region_key")


def q_dim_region_latest(spark, sf_dir):
    stg = _stg(spark, sf_dir)
    return dims.dim_region(stg, AS_OF, one_row_per_respondent=True, national=FIXTURE_NATIONAL)


def q_fct_hourly(spark, sf_dir):
    stg, dr, dd = _dims(spark, sf_dir)
    return facts.fct_hourly(stg, dr, dd)


def q_fct_hourly_lineitem(spark, sf_dir):
    """The hourly fact over readings that grow with the scale factor, with a calendar that follows them."""
    configure(spark)
    raw = fixtures.lineitem_readings(spark, sf_dir)
    stg = staging.stg_hourly(raw)
    dd = calendar.dim_date(spark, *calendar.calendar_bounds(raw, start=None, end=None))
    return facts.fct_hourly(stg, dims.dim_region(stg, AS_OF, national=FIXTURE_NATIONAL), dd)


def q_upsert_lineitem(spark, sf_dir):
    """A merge that grows with the scale factor: the last third of every month again, doubled, and one region ten years later."""
    configure(spark)
    target = fixtures.lineitem_readings(spark, sf_dir)
    again = target.filter(F.dayofmonth("period_date") > 20).withColumn("value", F.col("value") * 2)
    later = target.filter(F.col("respondent") == "NO").withColumn("period_date", F.col("period_date") + F.make_interval(days=F.lit(3650)))
    stamp = ts_literal(AS_OF)
    return upsert.upsert(
        target, again.unionByName(later).drop("loaded_at"), RAW_KEY, RAW_UPDATE_COLS,
        on_match={"loaded_at": stamp}, on_insert={"loaded_at": stamp}, bucket=day_start("period_date"),
    )


def q_fct_dense_key_orders(spark, sf_dir):
    configure(spark)
    orders = fixtures.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey", "o_totalprice")
    return dense_key(orders, ["o_orderdate", "o_orderkey"], name="order_seq")


def q_demand_summary(spark, sf_dir):
    stg, dr, dd = _dims(spark, sf_dir)
    fct = facts.fct_hourly_rows(stg, dr, dd)
    df = marts.demand_summary(fct, dr, dd, AS_OF)
    return _round(df, ["total_demand", "avg_demand", "max_demand", "min_demand", "demand_variance"])


# -- sources -----------------------------------------------------------------

ACCEPTED_REGIONS = ("click", "purchase", "signup", "view")


def q_only_regions(spark, sf_dir):
    configure(spark)
    return pages.only_regions(fixtures.raw_readings(spark, sf_dir), ACCEPTED_REGIONS)


def q_newest_per_region(spark, sf_dir):
    configure(spark)
    return pages.newest_per_region(fixtures.raw_readings(spark, sf_dir), n=100)


def q_normalise(spark, sf_dir):
    configure(spark)
    return pages.normalise(fixtures.service_readings(spark, sf_dir))


def q_rejects(spark, sf_dir):
    _, bad = pages.split_rejects(q_normalise(spark, sf_dir))
    return bad


def q_ingest_json(spark, sf_dir):
    """Readings landed as JSON pages, read back with the page schema, normalised."""
    configure(spark)
    path = scratch_path(spark, "pages")
    pages.write_pages(fixtures.service_readings(spark, sf_dir), path)
    return pages.normalise(pages.read_pages(spark, path))


def _land(spark, *landings):
    path = scratch_path(spark, "landing")
    for i, readings in enumerate(landings):
        pages.write_pages(readings, f"{path}/{i}")
    return path


def q_load_corrections(spark, sf_dir):
    """One load of three landings: of several readings of a key the last to land wins, also a lower or missing one."""
    configure(spark)
    warehouse = scratch_path(spark, "warehouse")
    landing = _land(spark, *fixtures.corrections(spark, sf_dir))
    jobs.hourly_load(spark, f"{landing}/*", warehouse, AS_OF, regions=ACCEPTED_REGIONS)
    jobs.hourly_load(spark, f"{landing}/0", warehouse, AS_OF, regions=ACCEPTED_REGIONS)  # the first again: undoes nothing
    return tables.scan_raw(spark, f"{warehouse}/raw_readings").drop(tables.PARTITION)


def q_load_rejects(spark, sf_dir):
    """Rejects that a load stores: bad periods, missing regions and types, malformed pages; counted by reason and region."""
    configure(spark)
    warehouse = scratch_path(spark, "warehouse")
    service = fixtures.service_readings(spark, sf_dir)
    n = F.conv(F.substring(F.md5(F.concat_ws("|", "period", "respondent", "type")), 1, 2), 16, 10).cast("int")
    region = F.when(n % 5 == 0, F.lit(None).cast("string")).when(n % 5 == 1, F.lit("")).otherwise(F.col("respondent"))
    landing = _land(spark, service.withColumn("respondent", region).withColumn("type", F.when(n % 7 == 0, F.lit("")).otherwise(F.col("type"))))
    cut = fixtures.table(spark, sf_dir, "nation").select(F.concat(F.lit('{"response": {"data": [{"respondent": "'), "n_name", F.lit('"')).alias("value"))
    cut.write.text(f"{landing}/cut")
    jobs.hourly_load(spark, f"{landing}/*", warehouse, AS_OF, regions=ACCEPTED_REGIONS)
    stored = spark.read.parquet(f"{warehouse}/rejects")
    return stored.groupBy("reason", "respondent").agg(F.count(F.lit(1)).alias("n_rows"))


def q_materialise(spark, sf_dir):
    """A mart rebuilt: first of half the days, then of all, by folder of the day; read back."""
    configure(spark)
    path = scratch_path(spark, "mart")
    daily = marts.daily_demand(_stg(spark, sf_dir)).withColumn("day", F.to_date("period_day"))
    tables.materialise(daily.filter(F.dayofmonth("day") > 10), path, "day")
    return _round(tables.materialise(daily.filter(F.dayofmonth("day") <= 20), path, "day").drop("day"), DAILY_DOUBLES)


def q_replace_table(spark, sf_dir):
    """A table replaced by rows made from itself."""
    configure(spark)
    path = scratch_path(spark, "table")
    first = tables.replace_table(fixtures.raw_readings(spark, sf_dir), path)
    changed = first.filter(F.col("respondent") != "error").withColumn("value", F.col("value") * 2)
    return tables.replace_table(changed, path)


def q_write_raw(spark, sf_dir):
    """Raw readings written by day partition and scanned back with the declared schema."""
    configure(spark)
    path = scratch_path(spark, "raw")
    tables.write_raw(fixtures.raw_readings(spark, sf_dir), path)
    return tables.scan_raw(spark, path).drop(tables.PARTITION)


def q_ingest_stream(spark, sf_dir):
    """Two landings of pages (readings before the first snapshot day; the others, and
    corrections of some of the first), each loaded by its own run of the incremental
    stream into one raw table; the second run sees only the new files (the stream's
    checkpoint remembers the first)."""
    configure(spark)
    landing, raw, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "raw"), scratch_path(spark, "stream-ckpt")
    readings = fixtures.raw_readings(spark, sf_dir)
    cut = F.col("period_date") < ts_literal(SNAPSHOT_T1)
    corrected = readings.filter(cut & (F.hour("period_date") % 4 == 1)).withColumn("value", F.col("value") - 1)
    pages.write_pages(fixtures.as_service(readings.filter(cut)), f"{landing}/a")
    ingest_stream(spark, f"{landing}/*", raw, ckpt, as_of=AS_OF)
    pages.write_pages(fixtures.as_service(readings.filter(~cut).unionByName(corrected)), f"{landing}/b")
    ingest_stream(spark, f"{landing}/*", raw, ckpt, as_of=AS_OF)
    return tables.scan_raw(spark, raw).drop(tables.PARTITION)


REGIONS = ("click", "purchase", "signup", "view", "error")


def _loaded_and_built(spark, sf_dir):
    """A warehouse with marts of the readings before the first snapshot day; and the later readings."""
    configure(spark)
    warehouse = scratch_path(spark, "warehouse")
    readings = fixtures.raw_readings(spark, sf_dir)
    cut = F.col("period_date") < ts_literal(SNAPSHOT_T1)
    landing = _land(spark, fixtures.as_service(readings.filter(cut)))
    jobs.hourly_load(spark, f"{landing}/*", warehouse, AS_OF, regions=REGIONS)
    jobs.build_marts(spark, warehouse, AS_OF, accepted=REGIONS, gate=False)
    return warehouse, readings, cut


def q_load_twice_refresh(spark, sf_dir):
    """Two loads of one stamp (odd and even days), then one refresh: the daily mart holds the days of both."""
    warehouse, readings, cut = _loaded_and_built(spark, sf_dir)
    odd = F.dayofmonth("period_date") % 2 == 1
    for part in (odd, ~odd):
        landing = _land(spark, fixtures.as_service(readings.filter(~cut & part)))
        jobs.hourly_load(spark, f"{landing}/*", warehouse, AS_OF, regions=REGIONS)
    jobs.refresh_marts(spark, warehouse, None, AS_OF, accepted=REGIONS, gate=False)
    return _round(jobs.read_mart(spark, warehouse, "fct_daily").drop(jobs.PART), DAILY_DOUBLES)


def q_stream_refresh(spark, sf_dir):
    """Later readings, and corrections of earlier ones, come by the stream; a refresh takes them into the daily mart."""
    warehouse, readings, cut = _loaded_and_built(spark, sf_dir)
    corrected = readings.filter(cut & (F.hour("period_date") % 4 == 1)).withColumn("value", F.col("value") - 1)
    landing = _land(spark, fixtures.as_service(readings.filter(~cut).unionByName(corrected)))
    ingest_stream(spark, f"{landing}/*", f"{warehouse}/raw_readings", scratch_path(spark, "stream-ckpt"), as_of=AS_OF)
    jobs.refresh_marts(spark, warehouse, None, AS_OF, accepted=REGIONS, gate=False)
    return _round(jobs.read_mart(spark, warehouse, "fct_daily").drop(jobs.PART), DAILY_DOUBLES)


def q_stored_fact(spark, sf_dir):
    """The stored fact with its dense keys after a refresh that its gate stopped and one that was let through;
    ``rows_while_stopped`` is what a reader found in between."""
    warehouse, readings, cut = _loaded_and_built(spark, sf_dir)
    landing = _land(spark, fixtures.as_service(readings.filter(~cut)))
    jobs.hourly_load(spark, f"{landing}/*", warehouse, AS_OF, regions=REGIONS)
    try:
        jobs.refresh_marts(spark, warehouse, None, AS_OF, accepted=("nowhere",))
    except AssertionError:
        pass
    found = jobs.read_fact(spark, warehouse).count()
    jobs.refresh_marts(spark, warehouse, None, AS_OF, accepted=REGIONS, gate=False)
    return jobs.read_fact(spark, warehouse).withColumn("rows_while_stopped", F.lit(found).cast("long"))


# -- upserts -----------------------------------------------------------------

def _batch(spark, sf_dir):
    src = fixtures.upsert_batch_source(spark, sf_dir)
    return upsert.dedupe_batch(src, RAW_KEY, ["loaded_at"])


def q_dedupe_batch(spark, sf_dir):
    configure(spark)
    return _batch(spark, sf_dir)


def q_upsert_readings(spark, sf_dir):
    configure(spark)
    target = fixtures.raw_readings(spark, sf_dir)
    batch = _batch(spark, sf_dir).drop("loaded_at")
    stamp = ts_literal(AS_OF)
    return upsert.upsert(
        target, batch, RAW_KEY, RAW_UPDATE_COLS,
        on_match={"loaded_at": stamp}, on_insert={"loaded_at": stamp}, bucket=day_start("period_date"),
    )


def seed_regions(spark: SparkSession) -> DataFrame:
    return jobs.seed_regions(spark, AS_OF)


def q_insert_absent_regions(spark, sf_dir):
    _, dr, _ = _dims(spark, sf_dir)
    return upsert.insert_absent(dr, seed_regions(spark), ["respondent"], key_col="region_key", insert_order=["seed_order"])


def q_insert_absent_dates(spark, sf_dir):
    stg = _stg(spark, sf_dir)
    dd = calendar.dim_date(spark)
    seen = stg.select(F.col("date_value").cast("date").alias("date_value")).distinct()
    target = dd.join(seen, "date_value", "left_semi")
    return upsert.insert_absent(target, dd, ["date_value"])


# -- type-2 history ----------------------------------------------------------

def q_region_history_input(spark, sf_dir):
    configure(spark)
    return history.region_history_input(fixtures.raw_readings(spark, sf_dir), AS_OF)


def q_region_history(spark, sf_dir):
    configure(spark)
    first, second = fixtures.region_snapshots(spark, sf_dir)
    h1 = history.scd2(None, history.region_history_input(first, SNAPSHOT_T1), "respondent", as_of=SNAPSHOT_T1)
    return history.scd2(h1, history.region_history_input(second, SNAPSHOT_T2), "respondent", as_of=SNAPSHOT_T2)


def q_region_history_rename(spark, sf_dir):
    """History over a rename while both names stay in the readings; a third, equal snapshot adds nothing."""
    configure(spark)
    raw = fixtures.renamed_readings(spark, sf_dir)
    h = history.scd2(None, history.region_history_input(raw.filter(F.col("period_date") < ts_literal(SNAPSHOT_T1)), SNAPSHOT_T1), "respondent", as_of=SNAPSHOT_T1)
    h = history.scd2(h, history.region_history_input(raw, SNAPSHOT_T2), "respondent", as_of=SNAPSHOT_T2)
    return history.scd2(h, history.region_history_input(raw, SNAPSHOT_T3), "respondent", as_of=SNAPSHOT_T3)


def q_history_as_of(spark, sf_dir):
    return history.as_of_view(q_region_history(spark, sf_dir), dt.datetime(2024, 1, 20))


# -- data quality --------------------------------------------------------------

def q_dq_not_null(spark, sf_dir):
    configure(spark)
    return quality.check_not_null(fixtures.raw_readings(spark, sf_dir), "value")


def q_dq_unique(spark, sf_dir):
    return quality.check_unique(q_region_history(spark, sf_dir), "respondent")


def q_dq_accepted(spark, sf_dir):
    return quality.check_accepted(_stg(spark, sf_dir), "respondent", ACCEPTED_REGIONS)


def q_dq_relationship(spark, sf_dir):
    stg, dr, dd = _dims(spark, sf_dir)
    fct = facts.fct_hourly_rows(stg, dr, dd).drop("data_type", "respondent")
    # Two regions are taken out of the dimension, so their facts are orphans.
    return quality.check_relationship(fct, "region_key", dr.filter(~F.col("respondent").isin("error", "view")), "region_key")


def q_dq_require_rows(spark, sf_dir):
    """Readings per region, behind the guard that fails on an empty input."""
    configure(spark)
    raw = quality.require_rows(fixtures.raw_readings(spark, sf_dir), "no readings")
    return diagnostics.key_counts(raw, "respondent", "n_rows")


def q_dq_keys(spark, sf_dir):
    configure(spark)
    return quality.check_unique(fixtures.upsert_batch_source(spark, sf_dir), *RAW_KEY)


def q_dq_counts(spark, sf_dir):
    _, dr, dd = _dims(spark, sf_dir)
    return quality.check_count(dd, 1461, "dim_date").unionByName(quality.check_count(dr, 4, "dim_region"))


def reference_checks(raw, stg, by_region, dr, fct) -> DataFrame:
    """The 17 column checks of the reference's model YAML, on our tables.

    Row-level checks of a table share one aggregate pass; unique and
    relationship checks need their own shuffle each.
    """
    C = quality.Check
    return quality.union_reports(
        # raw and staging checks share one scan of the raw rows
        quality.row_checks(
            raw,
            quality.RowChecks("raw_readings", ("period_date", "respondent", "value")),
            quality.RowChecks(
                "stg_hourly", ("period_date", "demand_value", "respondent"), {"respondent": ACCEPTED_REGIONS},
                where=staging.clean_reading(), columns=staging.STG_FROM_RAW,
            ),
        ),
        quality.column_checks(by_region, "stg_by_region", ["period_date", "respondent", "total_demand"]),
        quality.column_checks(dr, "dim_region", ["region_key", "respondent"]),
        quality.column_checks(fct, "fct_hourly", ["demand_value", "region_key"]),
        quality.quality_report(
            [
                C("unique", "dim_region", "region_key", quality.check_unique(dr, "region_key")),
                C("unique", "dim_region", "respondent", quality.check_unique(dr, "respondent")),
                C("relationships", "fct_hourly", "region_key", quality.check_relationship(fct, "region_key", dr, "region_key")),
            ]
        ),
    )


def q_dq_report(spark, sf_dir):
    configure(spark)
    raw = fixtures.raw_readings(spark, sf_dir)
    stg = staging.stg_hourly(raw)
    dr = dims.dim_region(stg, AS_OF, national=FIXTURE_NATIONAL)
    fct = facts.fct_hourly_rows(stg, dr, calendar.dim_date(spark))
    return reference_checks(raw, stg, staging.demand_by_region(stg), dr, fct)


# -- diagnostics -----------------------------------------------------------------

def _fct_rows(spark, sf_dir):
    stg, dr, dd = _dims(spark, sf_dir)
    return stg, dr, facts.fct_hourly_rows(stg, dr, dd)


def q_region_counts(spark, sf_dir):
    _, dr, fct = _fct_rows(spark, sf_dir)
    return diagnostics.region_counts(fct, dr)


def q_coverage_raw(spark, sf_dir):
    configure(spark)
    raw = fixtures.raw_readings(spark, sf_dir)
    return diagnostics.coverage(raw, "respondent", "period_date", "raw_count", "earliest_date", "latest_date")


def q_coverage_fact(spark, sf_dir):
    _, dr, fct = _fct_rows(spark, sf_dir)
    j = fct.select("region_key", "period_date").join(dr.select("region_key", "respondent"), "region_key")
    return diagnostics.coverage(j, "respondent", "period_date", "fact_count", "earliest_date", "latest_date")


def _train(spark, sf_dir, run=RUN_DATE):
    _, dr, fct = _fct_rows(spark, sf_dir)
    return forecast.train_daily(fct, dr, run, 90)


def q_coverage_train(spark, sf_dir):
    return diagnostics.coverage(_train(spark, sf_dir), "region", "date", "training_records", "earliest_date", "latest_date")


def _forecast(spark, sf_dir, run=RUN_DATE, interval=0.95):
    return forecast.forecast_run(_train(spark, sf_dir, run), run, 7, interval)


def q_coverage_forecast(spark, sf_dir):
    fc = _forecast(spark, sf_dir)
    return diagnostics.coverage(fc, "region", "forecast_date", "forecast_count", "first_forecast", "last_forecast")


def q_key_counts(spark, sf_dir):
    return diagnostics.key_counts(_stg(spark, sf_dir), "respondent", "staging_count")


def q_layer_counts(spark, sf_dir):
    configure(spark)
    raw = fixtures.raw_readings(spark, sf_dir)
    stg = staging.stg_hourly(raw)
    dr = dims.dim_region(stg, AS_OF, national=FIXTURE_NATIONAL)
    dd = calendar.dim_date(spark)
    fct = facts.fct_hourly_rows(stg, dr, dd)
    rows = forecast.forecast_run(forecast.train_daily(fct, dr, RUN_DATE, 90), RUN_DATE)
    return diagnostics.layer_counts(
        {"raw_readings": raw, "stg_hourly": stg, "dim_region": dr, "dim_date": dd, "fct_hourly": fct, "forecast_results": rows}
    )


def q_layer_dropoff(spark, sf_dir):
    configure(spark)
    raw = fixtures.raw_readings(spark, sf_dir)
    stg = staging.stg_hourly(raw)
    dr = dims.dim_region(stg, AS_OF, national=FIXTURE_NATIONAL)
    fct = facts.fct_hourly_rows(stg, dr, calendar.dim_date(spark))
    return diagnostics.layer_dropoff(raw, stg, fct, dr)


def q_trailing_days(spark, sf_dir):
    configure(spark)
    return forecast.trailing_days(fixtures.raw_readings(spark, sf_dir), "period_date", RUN_DATE, 14)


def q_loaded_on(spark, sf_dir):
    configure(spark)
    return diagnostics.loaded_on(fixtures.raw_readings(spark, sf_dir), dt.date(2024, 1, 15))


FORECAST_DOUBLES = ["forecast", "lower_bound", "upper_bound"]
RUNS = (dt.datetime(2024, 1, 17), dt.datetime(2024, 1, 24), RUN_DATE)


def _results(spark, sf_dir, runs=RUNS[1:], interval=0.95):
    out = None
    for run in runs:
        part = forecast.as_results(_forecast(spark, sf_dir, run, interval), AS_OF)
        out = part if out is None else out.unionByName(part)
    return out


def q_run_rows(spark, sf_dir):
    return _round(diagnostics.run_rows(_results(spark, sf_dir), RUN_DATE), FORECAST_DOUBLES)


# -- forecast ------------------------------------------------------------------

def q_train_daily(spark, sf_dir):
    return _round(_train(spark, sf_dir), ["avg_demand_mw"])


def q_usable_series(spark, sf_dir):
    return _round(forecast.usable_series(_train(spark, sf_dir)), ["avg_demand_mw"])


def q_forecast_fit(spark, sf_dir):
    model = forecast.fit_trend_weekday(forecast.usable_series(_train(spark, sf_dir)))
    return _round(model.series, ["slope", "intercept", "sigma"])


def q_forecast_weekday(spark, sf_dir):
    model = forecast.fit_trend_weekday(forecast.usable_series(_train(spark, sf_dir)))
    return _round(model.weekday, ["effect"])


def q_forecast_steps(spark, sf_dir):
    model = forecast.fit_trend_weekday(forecast.usable_series(_train(spark, sf_dir)))
    return _round(forecast.predict(model, 7, 0.95), FORECAST_DOUBLES)


def q_forecast_7d(spark, sf_dir):
    return _round(_forecast(spark, sf_dir), FORECAST_DOUBLES)


def q_forecast_metrics(spark, sf_dir):
    return _round(forecast.evaluate(_train(spark, sf_dir), RUN_DATE, 7), ["metric_value"])


def q_forecast_metrics_gaps(spark, sf_dir):
    """Metrics of awkward series: flat (no R2), short (no row), with a gap before the last day."""
    return _round(forecast.evaluate(fixtures.gappy(_train(spark, sf_dir)), RUN_DATE, 7), ["metric_value"])


def _daily_mart(spark, sf_dir):
    """The daily mart and the region dimension, without the hourly fact."""
    stg, dr, _ = _dims(spark, sf_dir)
    return marts.daily_from_hourly(staging.demand_by_region(stg)), dr


def q_forecast_fit_states(spark, sf_dir):
    """The model of ``forecast_fit`` from merged daily states: the window's two halves, added."""
    daily, dr = _daily_mart(spark, sf_dir)
    state = regression.day_state(regression.train_from_daily(daily, dr, RUN_DATE))
    early = F.col("date") < ts_literal(SNAPSHOT_T1)
    halves = [regression.merge_states(state.filter(part), "region", "day_of_week") for part in (early, ~early)]
    lines, _ = regression.fit_states(halves[0].unionByName(halves[1]), "region")
    return _round(lines.filter(F.col("n_points") >= forecast.MIN_POINTS), ["slope", "intercept", "sigma"])


def q_forecast_backtest(spark, sf_dir):
    """Errors by step of forecasts from two origins, five days apart."""
    train = regression.train_from_daily(*_daily_mart(spark, sf_dir), RUN_DATE)
    scored = regression.backtest(train, count=2, every=5, horizon=7)
    return _round(regression.errors_by_step(scored), ["mae", "rmse", "bias"])


def q_skipped_series(spark, sf_dir):
    return forecast.skipped_series(fixtures.gappy(_train(spark, sf_dir)))


def q_forecast_rows_quoted(spark, sf_dir):
    """Forecast rows of series whose names came in quotes: the quotes go."""
    train = _train(spark, sf_dir).withColumn("region", F.concat(F.lit('"'), "region", F.lit('"')))
    return _round(forecast.forecast_run(train, RUN_DATE), FORECAST_DOUBLES)


def q_forecast_count_metrics(spark, sf_dir):
    return forecast.forecast_count_metrics(_forecast(spark, sf_dir), RUN_DATE)


def q_forecast_with_actuals(spark, sf_dir):
    run = RUNS[1]
    rows = _forecast(spark, sf_dir, run)
    daily = marts.daily_demand(_stg(spark, sf_dir))
    return _round(forecast.with_actuals(rows, daily), [*FORECAST_DOUBLES, "actual", "prediction_error"])


def q_history_with_forecast(spark, sf_dir):
    daily = marts.daily_demand(_stg(spark, sf_dir))
    return _round(forecast.history_with_forecast(daily, _forecast(spark, sf_dir)), ["value", "lower_bound", "upper_bound"])


def q_forecast_preview(spark, sf_dir):
    return _round(forecast.forecast_preview(_forecast(spark, sf_dir), 10), FORECAST_DOUBLES)


def q_upsert_forecasts(spark, sf_dir):
    target = _results(spark, sf_dir, RUNS[1:])
    batch = _forecast(spark, sf_dir, RUNS[2], 0.8).unionByName(_forecast(spark, sf_dir, RUNS[0]))
    merged = upsert.upsert(target, batch, FORECAST_KEY, FORECAST_DOUBLES, on_insert={"loaded_at": ts_literal(AS_OF)})
    return _round(merged, FORECAST_DOUBLES)


def q_upsert_metrics(spark, sf_dir):
    target = forecast.forecast_count_metrics(_forecast(spark, sf_dir, RUNS[1]), RUNS[1]).unionByName(
        forecast.evaluate(_train(spark, sf_dir, RUNS[1]), RUNS[1])
    )
    batch = forecast.evaluate(_train(spark, sf_dir, RUNS[1]), RUNS[1], holdout_days=5).unionByName(
        forecast.forecast_count_metrics(_forecast(spark, sf_dir, RUNS[2]), RUNS[2])
    ).drop("created_at")
    merged = upsert.upsert(target, batch, METRIC_KEY, ["metric_value"], on_insert={"created_at": ts_literal(AS_OF)})
    return _round(merged, ["metric_value"])


def _gbt(spark, sf_dir):
    train = _train(spark, sf_dir)
    return boosted.fit_gbt(train), train


def q_gbt_features(spark, sf_dir):
    """Lag features by date; days after a gap have none."""
    return _round(boosted.gbt_features(fixtures.gappy(_train(spark, sf_dir))), ["label", "lag_1", "lag_7"])


def q_gbt_forecast(spark, sf_dir):
    """Seven days ahead by the pooled tree model (rows only)."""
    model, train = _gbt(spark, sf_dir)
    return boosted.gbt_forecast(model, train, RUN_DATE)


def q_fit_gbt(spark, sf_dir):
    """One-day-ahead fitted values of the pooled boosted-tree model (rows only)."""
    model, train = _gbt(spark, sf_dir)
    return boosted.gbt_fitted(model, train)


def q_feature_importance(spark, sf_dir):
    model, _ = _gbt(spark, sf_dir)
    return boosted.feature_importance(model, RUN_DATE)


QUERIES: dict[str, Query] = {
    "stg_hourly": q_stg_hourly,
    "demand_by_region": q_demand_by_region,
    "daily_demand": q_daily_demand,
    "forecast_vs_actual": q_forecast_vs_actual,
    "daily_demand_lineitem": q_daily_demand_lineitem,
    "dim_date": q_dim_date,
    "dim_date_holidays": q_dim_date_holidays,
    "calendar_head": q_calendar_head,
    "dim_region": q_dim_region,
    "dim_region_latest": q_dim_region_latest,
    "region_list": q_region_list,
    "fct_hourly": q_fct_hourly,
    "fct_hourly_lineitem": q_fct_hourly_lineitem,
    "upsert_lineitem": q_upsert_lineitem,
    "fct_dense_key_orders": q_fct_dense_key_orders,
    "demand_summary": q_demand_summary,
    "only_regions": q_only_regions,
    "newest_per_region": q_newest_per_region,
    "normalise": q_normalise,
    "ingest_json": q_ingest_json,
    "write_raw": q_write_raw,
    "ingest_stream": q_ingest_stream,
    "load_corrections": q_load_corrections,
    "load_twice_refresh": q_load_twice_refresh,
    "stream_refresh": q_stream_refresh,
    "stored_fact": q_stored_fact,
    "load_rejects": q_load_rejects,
    "materialise": q_materialise,
    "replace_table": q_replace_table,
    "rejects": q_rejects,
    "dedupe_batch": q_dedupe_batch,
    "upsert_readings": q_upsert_readings,
    "insert_absent_regions": q_insert_absent_regions,
    "insert_absent_dates": q_insert_absent_dates,
    "region_history_input": q_region_history_input,
    "region_history": q_region_history,
    "region_history_rename": q_region_history_rename,
    "history_as_of": q_history_as_of,
    "dq_not_null": q_dq_not_null,
    "dq_unique": q_dq_unique,
    "dq_accepted": q_dq_accepted,
    "dq_relationship": q_dq_relationship,
    "dq_require_rows": q_dq_require_rows,
    "dq_keys": q_dq_keys,
    "dq_counts": q_dq_counts,
    "dq_report": q_dq_report,
    "region_counts": q_region_counts,
    "coverage_raw": q_coverage_raw,
    "coverage_fact": q_coverage_fact,
    "coverage_train": q_coverage_train,
    "coverage_forecast": q_coverage_forecast,
    "key_counts": q_key_counts,
    "layer_counts": q_layer_counts,
    "layer_dropoff": q_layer_dropoff,
    "trailing_days": q_trailing_days,
    "loaded_on": q_loaded_on,
    "run_rows": q_run_rows,
    "train_daily": q_train_daily,
    "usable_series": q_usable_series,
    "forecast_fit": q_forecast_fit,
    "forecast_weekday": q_forecast_weekday,
    "forecast_steps": q_forecast_steps,
    "forecast_7d": q_forecast_7d,
    "forecast_metrics": q_forecast_metrics,
    "forecast_metrics_gaps": q_forecast_metrics_gaps,
    "skipped_series": q_skipped_series,
    "forecast_fit_states": q_forecast_fit_states,
    "forecast_backtest": q_forecast_backtest,
    "forecast_rows_quoted": q_forecast_rows_quoted,
    "forecast_count_metrics": q_forecast_count_metrics,
    "forecast_with_actuals": q_forecast_with_actuals,
    "history_with_forecast": q_history_with_forecast,
    "forecast_preview": q_forecast_preview,
    "upsert_forecasts": q_upsert_forecasts,
    "upsert_metrics": q_upsert_metrics,
    "fit_gbt": q_fit_gbt,
    "gbt_features": q_gbt_features,
    "gbt_forecast": q_gbt_forecast,
    "feature_importance": q_feature_importance,
}
