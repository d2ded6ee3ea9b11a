"""The three scheduled jobs as Spark jobs over stored tables.

Layout under one ``warehouse`` folder: ``raw_readings`` by day; ``marts`` in versions
(see ``sources.versions``): by day ``stg_by_region``, ``fct_hourly`` (by date_key) with
``fct_hours``, ``demand_summary`` with ``summary_hours``, ``fct_daily``, ``raw_region_days``,
undivided ``dim_region``, ``dim_date``, ``snap_region``, ``raw_days``; ``forecast_results``
(a folder per run), ``model_metrics``, ``skipped_series``, ``feature_importance``; ``rejects`` (a folder per
landing) and ``journal`` (days loaded but not yet in the marts, see ``sources.journal``).

A build or refresh writes a version of its own, checks it, and only then publishes it: all
marts change together, a failed gate or a stopped job leaves readers (``read_mart``,
``read_fact``, ``read_summary``) on the version before it.

Surrogate keys are positions in time order, so a late reading moves every later key.
The fact and the summary therefore store the position inside the hour, and the hours
tables the number of rows; ``read_fact`` and ``read_summary`` add the offset of the
hour. A refresh then writes the touched days only. Rows meet the hours of their own build
or the read stops: none is left out.

Each function is one job run; re-running it with the same inputs leaves the
tables as they were (upserts and rebuilds only). A job removes the checkpoints and
scratch folders it made.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import ts_literal
from ..operators import boosted, calendar, dims, facts, forecast, history, marts, quality, regression, staging
from ..operators.keys import group_offsets, number_in_group
from ..operators.sizing import small_side
from ..operators.upsert import dedupe_batch, insert_absent, upsert
from ..schemas import FORECAST_KEY, FORECAST_RESULTS, METRIC_KEY, MODEL_METRICS, RAW_KEY
from ..session import configure, job_scratch, path_exists
from ..sources import journal, pages, tables, versions
from ..sources.pages import REQUESTED_REGIONS

# Fixed value: the regions the staging check accepts.
ACCEPTED = ("US48", "CISO", "MISO", "PJM")

# The six seed regions of the one-time setup, in insert order.
SEED_REGIONS = (
    ("US48", "United States Lower 48", "National"),
    ("CISO", "California Independent System Operator", "Regional"),
    ("TEXA", "Electric Reliability Council of Texas", "Regional"),
    ("MISO", "Midcontinent Independent System Operator", "Regional"),
    ("NYISO", "New York Independent System Operator", "Regional"),
    ("PJM", "PJM Interconnection", "Regional"),
)


def _t(warehouse: str, name: str) -> str:
    return f"{warehouse.rstrip('/')}/{name}"


def seed_regions(spark: SparkSession, as_of: dt.datetime) -> DataFrame:
    """The seed regions as dimension rows (key left empty, ``seed_order`` = insert order)."""
    rows = [(i + 1, *r) for i, r in enumerate(SEED_REGIONS)]
    seed = spark.createDataFrame(rows, "seed_order int, respondent string, respondent_name string, region_type string")
    return seed.withColumn("created_at", ts_literal(as_of)).withColumn("region_key", F.lit(None).cast("long"))


PART = "part_day"  # partition column (date) of the marts stored by day


def _day(df: DataFrame, c: str = "period_date") -> DataFrame:
    return df.withColumn(PART, F.to_date(c))


def read_mart(spark: SparkSession, warehouse: str, name: str, **bounds) -> DataFrame:
    """A mart as the current version has it (``since``, ``until``: days to read)."""
    return versions.read_table(spark, warehouse, name, **bounds)


def initial_setup(spark: SparkSession, warehouse: str, as_of: dt.datetime) -> None:
    """One-time setup: seed regions and the calendar, each only where absent, so
    it can run again safely. A later ``build_marts`` rebuilds the region
    dimension from the data, as the reference's model build does."""
    configure(spark)
    with job_scratch(spark), versions.Build(spark, warehouse, as_of) as build:
        there = build.base.tables if build.base else {}
        if "dim_region" in there:
            dr = versions.read_table(spark, warehouse, "dim_region", build.base)
        else:
            dr = spark.createDataFrame([], "region_key bigint, respondent string, respondent_name string, region_type string, created_at timestamp_ntz")
        build.write(insert_absent(dr, seed_regions(spark, as_of), ["respondent"], key_col="region_key", insert_order=["seed_order"]), "dim_region")
        raw_path = _t(warehouse, "raw_readings")
        cal = calendar.dim_date(spark, *(calendar.calendar_bounds(tables.scan_raw(spark, raw_path)) if path_exists(spark, raw_path) else ()))
        dd = versions.read_table(spark, warehouse, "dim_date", build.base) if "dim_date" in there else cal.limit(0)
        build.write(insert_absent(dd, cal, ["date_value"]), "dim_date")
        build.publish([] if build.base else None)
    versions.clean_up(spark, warehouse)


def hourly_load(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    as_of: dt.datetime,
    regions: Sequence[str] = REQUESTED_REGIONS,
    newest: int | None = None,
    multi_line: bool = False,
    new_files_only: bool = False,
) -> dict:
    """Landed pages -> normalised -> malformed pages and unkeyable rows stored as rejects
    -> requested regions -> merged into ``raw_readings``, the reading that landed last
    winning. Fails on an empty batch.

    ``newest`` loads only that many readings per region (``newest_per_region``) and
    reports how many were left out; by default everything that landed is loaded.

    ``new_files_only`` leaves out files that such a load has taken in before and that have
    not changed since (path, time and size are kept in ``landed_files``): the landing folder
    may keep all it ever got. Without a new file such a load does nothing.
    """
    configure(spark)
    with job_scratch(spark):
        ledger, sources, fresh = _t(warehouse, "landed_files"), landing, None
        if new_files_only:
            fresh = tables.new_files(spark, landing, ledger).checkpoint(eager=True)
            # The names that a file source lists on the driver anyway.
            sources = sorted(r[0] for r in fresh.select("path").distinct().collect())
            if not sources:
                return {"rejected": 0, "left_out": 0, "loaded_today": 0, "first_day": None, "files": 0}
        # One run's landing, parsed once: rejects, guard, days and merge read this checkpoint.
        landed = pages.normalise(pages.read_pages(spark, sources, multi_line), landing=True).checkpoint(eager=True)
        good, bad = pages.split_rejects(landed)
        rejects = tables.write_rejects(bad, _t(warehouse, "rejects"), _landing_id(landed, as_of))
        batch, left_out = pages.only_regions(good, regions), 0
        if newest is not None:
            batch = dedupe_batch(batch, RAW_KEY, ("landed",)).checkpoint(eager=True)
            kept = pages.newest_per_region(batch, n=newest, tie=("data_type",)).checkpoint(eager=True)
            left_out = batch.count() - kept.count()
            batch = kept
        # At most as many as the calendar has days.
        days = sorted(r[0] for r in batch.select(F.to_date("period_date").alias(PART)).distinct().collect())
        quality.require_rows(batch, "no readings to load")
        first_day = days[0]
        # In the journal before the merge: a run that stops in between is caught up by the next refresh.
        entry = journal.open_entry(spark, warehouse, journal.new_id(as_of), days, as_of)
        raw = tables.upsert_raw(spark, _t(warehouse, "raw_readings"), batch, as_of)
        journal.close_entry(spark, warehouse, entry)
        if fresh is not None:  # after the merge: a load that stops before reads its files again
            tables.add_to_ledger(fresh, ledger)
        # Rows loaded today, counted over the days this run touched (folder pruning)
        # rather than over the whole history.
        touched = raw.filter(F.col(tables.PARTITION) >= F.lit(first_day))
        return {
            "rejected": rejects.count(), "left_out": left_out, "loaded_today": _loaded_on(touched, as_of.date()), "first_day": first_day,
            **({} if fresh is None else {"files": len(sources)}),
        }


def _landing_id(landed: DataFrame, as_of: dt.datetime) -> str:
    """Names the set of landed files (place and time): loading them again gives the same name, and
    no other load of the same stamp has it."""
    files = landed.select(F.xxhash64("landed._at", "landed._file").alias("h")).distinct()
    return f"{as_of.strftime('%Y%m%dT%H%M%S')}-{files.agg(F.coalesce(F.bit_xor('h'), F.lit(0))).first()[0] % (1 << 64):016x}"


def _loaded_on(raw: DataFrame, day: dt.date) -> int:
    return raw.filter(F.to_date("loaded_at") == F.lit(day.isoformat()).cast("date")).count()


def hourly_and_region_days(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``demand_by_region(stg_hourly(raw))`` and ``region_days(raw)`` from ONE pass.

    All raw rows are grouped by (hour, code, name); the staging aggregates are
    conditional on the staging filter, so groups with a clean reading give the
    hourly mart and all groups give the (day, code, name) table. The grouped
    table (hours x regions) is checkpointed once and both are read from it.
    """
    clean = staging.clean_reading()
    v = F.when(clean, F.col("value"))
    grouped = (
        raw.groupBy("period_date", "respondent", "respondent_name")
        .agg(
            F.sum(v).alias("total_demand"),
            F.avg(v).alias("avg_demand"),
            F.max(v).alias("max_demand"),
            F.min(v).alias("min_demand"),
            F.count_if(clean).alias("record_count"),
        )
        .checkpoint(eager=True)
    )
    by_region = grouped.filter(F.col("record_count") > 0)
    days = (
        grouped.filter(F.col("respondent").isNotNull())
        .groupBy(F.to_date("period_date").alias("period_day"), "respondent", "respondent_name")
        .agg((F.max("record_count") > 0).alias("clean"))
    )
    return by_region, days


def region_days(raw: DataFrame) -> DataFrame:
    """(day, code, name) of the raw readings, and whether a clean reading has it: a tiny
    table from which the region dimension and history are made without the readings."""
    return (
        raw.filter(F.col("respondent").isNotNull())
        .groupBy(F.to_date("period_date").alias("period_day"), "respondent", "respondent_name")
        .agg(F.max(staging.clean_reading()).alias("clean"))
    )


def _region_source(days: DataFrame) -> DataFrame:
    """The region dimension's input from ``region_days``: the latest day stands for the load time."""
    return days.filter("clean").select("respondent", "respondent_name", F.col("period_day").alias("loaded_at"))


def read_fact(spark: SparkSession, warehouse: str) -> DataFrame:
    """The stored hourly fact with ``demand_key`` (dense, in time order)."""
    return _keyed(spark, warehouse, "fct_hourly", "fct_hours", "demand_key").select("demand_key", *facts.FACT_COLUMNS)


def read_summary(spark: SparkSession, warehouse: str) -> DataFrame:
    """The stored demand summary with ``summary_key`` (dense, in time order)."""
    return _keyed(spark, warehouse, "demand_summary", "summary_hours", "summary_key").select("summary_key", *marts.SUMMARY_COLUMNS, "created_at")


def _keyed(spark: SparkSession, warehouse: str, name: str, hours_name: str, key: str) -> DataFrame:
    """Stored rows with their dense key; stops where rows and hours do not belong together.

    Both tables are read as one version has them and joined on the build as well. The hours must
    count as many rows as the version says are stored, and every row must find its hour.
    """
    version = versions.current(spark, warehouse)
    rows = versions.read_table(spark, warehouse, name, version, with_build=True)
    hours = versions.read_table(spark, warehouse, hours_name, version, with_build=True).drop(PART)
    offsets = small_side(group_offsets(hours, "period_date", (versions.BUILD, "n_rows")))
    counted, stored = offsets.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0], version.tables[name].rows
    if counted != stored:
        raise ValueError(f"{hours_name} counts {counted} rows, {name} holds {stored}")
    known = F.col("before").isNotNull() & (F.col("hour_seq") <= F.col("n_rows"))
    position = F.when(known, F.col("before") + F.col("hour_seq")).otherwise(F.raise_error(F.lit(f"a row of {name} has no hour")).cast("long"))
    return rows.join(offsets, [versions.BUILD, "period_date"], "left").withColumn(key, position)


def _hours(rows: DataFrame) -> DataFrame:
    return _day(rows.groupBy("period_date").agg(F.count(F.lit(1)).alias("n_rows")))


def _checks(raw, by_region, dr, fct, accepted: Sequence[str], changed: DataFrame | None = None) -> DataFrame:
    """The 17 column checks, the raw table's key, and (in a refresh) days ``changed`` outside the
    journal; one row per check, as a small frame of its own."""
    C = quality.Check
    report = quality.union_reports(
        quality.row_checks(  # raw and staging checks share one scan of the raw rows
            raw,
            quality.RowChecks("raw_readings", ("period_date", "respondent", "value")),
            quality.RowChecks(
                "stg_hourly", ("period_date", "demand_value", "respondent"), {"respondent": list(accepted)},
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
                C("unique", "raw_readings", ",".join(RAW_KEY), quality.check_unique(raw, *RAW_KEY)),
                *([] if changed is None else [C("journalled", "raw_readings", tables.PARTITION, changed)]),
            ]
        ),
    )
    return raw.sparkSession.createDataFrame(report.collect(), report.schema)  # one row per check


def build_marts(
    spark: SparkSession,
    warehouse: str,
    as_of: dt.datetime,
    one_row_per_respondent: bool = False,
    accepted: Sequence[str] = ACCEPTED,
    gate: bool = True,
) -> DataFrame:
    """Staging -> dimensions -> keyed fact -> marts, then the checks; the type-2
    snapshot runs only when every check passes. Returns the check report.

    A renamed region has two names in the readings. With ``one_row_per_respondent``
    the dimension takes the newest; without, it holds both, facts double as in the
    reference, and the gate's uniqueness check stops the build.
    """
    configure(spark)
    with job_scratch(spark), versions.Build(spark, warehouse, as_of) as build:
        entries = journal.pending(spark, warehouse)
        raw = tables.scan_raw(spark, _t(warehouse, "raw_readings")).drop(tables.PARTITION)
        stg = staging.stg_hourly(raw)
        # The hour x region aggregate and the (day, code, name) table come from one pass over
        # the readings; the daily mart and the region dimension come from these two.
        hourly, days_all = hourly_and_region_days(raw)
        by_region = build.write(_day(hourly), "stg_by_region", PART)
        days = build.write(_day(days_all, "period_day"), "raw_region_days", PART)
        dr = build.write(dims.dim_region(_region_source(days), as_of, one_row_per_respondent), "dim_region")
        dd = build.write(calendar.dim_date(spark, *calendar.calendar_bounds(days, "period_day")), "dim_date")
        fct = _write_slices(build, stg, by_region, dr, dd, as_of)
        build.write(tables.day_files(spark, _t(warehouse, "raw_readings")), "raw_days")
        report = _checks(raw, by_region, dr, fct, accepted)
        if gate:
            quality.assert_passes(report)
        _write_snapshot(build, days, as_of)
        _switch(build, None, entries)
        return report


def _write_slices(build: versions.Build, stg: DataFrame, by_region: DataFrame, dr: DataFrame, dd: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Fact, summary (each with its hours) and daily mart of the build's days; returns the stored fact rows."""
    seq = number_in_group(facts.fct_hourly_rows(stg, dr, dd), "period_date", list(facts.FACT_ORDER), "hour_seq")
    fct = build.write(seq.select("hour_seq", *facts.FACT_COLUMNS), "fct_hourly", "date_key", counted=True)
    build.write(_hours(fct), "fct_hours", PART)
    summary = build.write(_summary(fct, dr, dd, as_of), "demand_summary", PART, counted=True)
    build.write(_hours(summary.drop(PART)), "summary_hours", PART)
    build.write(_day(marts.daily_from_hourly(by_region.drop(PART)), "period_day"), "fct_daily", PART)
    return fct


def _switch(build: versions.Build, touched: Sequence[dt.date] | None, entries: Sequence[journal.Entry]) -> None:
    """Publish the build, then mark the loads it took in and remove what no reader needs."""
    taken = [e.name for e in entries if e.merged]
    build.publish(touched, taken)
    journal.consume(build.spark, build.warehouse, taken)
    versions.clean_up(build.spark, build.warehouse)


def _summary(fct: DataFrame, dr: DataFrame, dd: DataFrame, as_of: dt.datetime) -> DataFrame:
    rows = number_in_group(marts.demand_summary_rows(fct, dr, dd), "period_date", ["region"], "hour_seq")
    return _day(rows.select("hour_seq", *marts.SUMMARY_COLUMNS, ts_literal(as_of).alias("created_at")))


def _same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two small frames hold the same rows (one job)."""
    return a.exceptAll(b).unionByName(b.exceptAll(a)).isEmpty()


MARTS = ("stg_by_region", "fct_hourly", "fct_hours", "demand_summary", "summary_hours", "fct_daily", "raw_region_days")


def refresh_marts(
    spark: SparkSession,
    warehouse: str,
    since: dt.date | None,
    as_of: dt.datetime,
    accepted: Sequence[str] = ACCEPTED,
    gate: bool = True,
    one_row_per_respondent: bool = False,
) -> DataFrame:
    """``build_marts`` for the days that loads touched since the last refresh.

    The days are those in the journal of the loads and streams (a refresh that failed leaves
    their entries, so the next one catches up) and, if given, all raw days from ``since`` on. Only
    these days of the raw table and of every mart are read and written: rows keep
    their position inside the hour, and offsets come from the hours tables. The
    calendar grows where the days ask for it. A changed region dimension re-ranks
    every region key and falls back to ``build_marts`` with the same options. Checks
    run on the new slices and the small tables. Returns the check report.
    """
    configure(spark)
    options = {"one_row_per_respondent": one_row_per_respondent, "accepted": accepted, "gate": gate}
    base = versions.current(spark, warehouse)
    if base is None or not {*MARTS, "dim_region", "dim_date", "snap_region", "raw_days"} <= base.tables.keys():
        return build_marts(spark, warehouse, as_of, **options)
    with job_scratch(spark):
        entries = journal.pending(spark, warehouse)
        raw = tables.scan_raw(spark, _t(warehouse, "raw_readings"))
        touched = {d for e in entries for d in e.days}
        if since is not None:
            touched |= {r[0] for r in raw.filter(F.col(tables.PARTITION) >= F.lit(since)).select(tables.PARTITION).distinct().collect()}
        if not touched:
            empty = lambda name: versions.read_table(spark, warehouse, name, base).limit(0)
            dr = versions.read_table(spark, warehouse, "dim_region", base)
            report = _checks(raw.limit(0), empty("stg_by_region"), dr, empty("fct_hourly"), accepted)
            if gate:
                quality.assert_passes(report)
            return report
        with versions.Build(spark, warehouse, as_of) as build:
            report = _refresh_days(build, raw, sorted(touched), as_of, one_row_per_respondent, accepted, gate)
            if report is not None:
                _switch(build, sorted(touched), entries)
                return report
    return build_marts(spark, warehouse, as_of, **options)


def _refresh_days(build: versions.Build, raw, days: Sequence[dt.date], as_of, one_row_per_respondent, accepted, gate) -> DataFrame | None:
    """Write ``days`` of every mart and check them; the check report, or None if the region dimension changes."""
    spark, base = build.spark, build.base
    stored = lambda name: versions.read_table(spark, build.warehouse, name, base)
    between = F.col(tables.PARTITION).between(F.lit(days[0]), F.lit(days[-1]))
    touched = F.broadcast(spark.createDataFrame([(d,) for d in days], f"{PART} date"))  # at most the calendar's days
    raw_new = raw.filter(between).join(touched.withColumnRenamed(PART, tables.PARTITION), tables.PARTITION, "left_semi").drop(tables.PARTITION)
    hourly_new, days_new = hourly_and_region_days(raw_new)
    days_new = build.write(_day(days_new, "period_day"), "raw_region_days", PART)

    # The (day, code, name) table as it will be; equal (code, name) pairs mean equal keys.
    seen = stored("raw_region_days").join(touched, PART, "left_anti").unionByName(days_new)
    dr = stored("dim_region")
    pairs = dims.region_pairs(_region_source(seen), one_row_per_respondent)
    if not _same_rows(pairs.select("respondent", "respondent_name"), dr.select("respondent", "respondent_name")):
        return None
    dd = stored("dim_date")
    longer = calendar.extended(dd, *calendar.calendar_bounds(touched, PART, None, None))
    if longer is not None:
        dd = build.write(longer, "dim_date")
    by_new = build.write(_day(hourly_new), "stg_by_region", PART)
    fct_new = _write_slices(build, staging.stg_hourly(raw_new), by_new, dr, dd, as_of)
    # Duplicates and orphans are looked for in the touched days; the others are as the last version
    # found them if their files are (listed, not read).
    files = build.write(tables.day_files(spark, _t(build.warehouse, "raw_readings")), "raw_days")
    same = [F.col(c) for c in files.columns]
    changed = files.select(*same).exceptAll(stored("raw_days").select(*same)).unionByName(stored("raw_days").select(*same).exceptAll(files.select(*same)))
    changed = changed.select(F.col(tables.PARTITION).alias(PART)).distinct().join(touched, PART, "left_anti")
    report = _checks(raw_new, by_new, dr, fct_new, accepted, changed)
    if gate:
        quality.assert_passes(report)
    _write_snapshot(build, seen, as_of)
    return report


def _write_snapshot(build: versions.Build, raw: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Type-2 history of the regions seen in the raw table (``raw`` may be the raw
    readings or ``region_days`` of them: both give the newest name of each code)."""
    current = history.region_history_input(raw, as_of)
    known = build.base is not None and "snap_region" in build.base.tables
    previous = versions.read_table(build.spark, build.warehouse, "snap_region", build.base) if known else None
    return build.write(history.scd2(previous, current, "respondent", as_of=as_of), "snap_region")


def daily_forecast(
    spark: SparkSession,
    warehouse: str,
    run_date: dt.datetime,
    as_of: dt.datetime | None = None,
    days: int = 90,
    horizon: int = 7,
    interval: float = 0.95,
    boosted_trees: bool = False,
) -> DataFrame:
    """Train on the ``days`` before ``run_date``, forecast ``horizon`` days for every
    usable series, merge into ``forecast_results`` and the run's metrics into
    ``model_metrics``; series too short to fit go to ``skipped_series``. Earlier
    forecasts whose day has come get their ``actual``. With ``boosted_trees`` the
    pooled tree model forecasts instead and its feature importance is stored.
    Returns the run's forecast rows."""
    configure(spark)
    as_of = as_of or run_date
    stamp = ts_literal(as_of)
    with job_scratch(spark):
        daily = read_mart(spark, warehouse, "fct_daily", since=(run_date - dt.timedelta(days=days)).date(), until=run_date.date())
        dr = read_mart(spark, warehouse, "dim_region")
        train = regression.train_from_daily(daily, dr, run_date, days).checkpoint(eager=True)
        quality.require_rows(train, "training set is empty")
        if boosted_trees:
            model, scored = boosted.fit_gbt(train), boosted.gbt_backtest(train, horizon)
            rows = boosted.gbt_forecast(model, train, run_date, horizon, interval, scored=scored).checkpoint(eager=True)
            _merge(spark, warehouse, "feature_importance", boosted.feature_importance(model, run_date), ("model_version", "feature_name"))
        else:
            rows = forecast.forecast_run(train, run_date, horizon, interval).checkpoint(eager=True)
        quality.require_rows(rows, "no forecasts generated")
        skipped = forecast.skipped_series(train).select("region", "n_points", ts_literal(run_date).alias("generated_at"))
        _merge(spark, warehouse, "skipped_series", skipped, ("region", "generated_at"))

        results = _store_results(spark, warehouse, rows, train, run_date, days, stamp)

        met_path = _t(warehouse, "model_metrics")
        metrics = forecast.forecast_count_metrics(rows, run_date)
        if not boosted_trees:
            metrics = metrics.unionByName(forecast.evaluate(train, run_date))
        elif scored is not None:
            metrics = metrics.unionByName(forecast.metric_rows(scored, run_date))
        mtarget = spark.read.parquet(met_path) if tables.restore_table(spark, met_path) else spark.createDataFrame([], MODEL_METRICS)
        tables.stage_and_replace(upsert(mtarget, metrics.drop("created_at"), METRIC_KEY, ["metric_value"], on_insert={"created_at": stamp}), met_path)
        return results.filter(F.col("generated_at") == ts_literal(run_date)).select(rows.columns)


RUN = "run"
RESULTS_STORED = T.StructType([*FORECAST_RESULTS.fields, T.StructField(RUN, T.StringType())])


def read_results(spark: SparkSession, warehouse: str) -> DataFrame:
    """All stored forecasts, with the ``run`` that made them (its folder)."""
    return spark.read.schema(RESULTS_STORED).parquet(_t(warehouse, "forecast_results"))


def _store_results(spark: SparkSession, warehouse: str, rows: DataFrame, train: DataFrame, run_date: dt.datetime, days: int, stamp) -> DataFrame:
    """Merge a run's forecasts into its own folder, and fill ``actual`` where a day has come.

    Only that folder and those of runs with a day to fill are written. A day of the training
    window lies in a forecast made at most a window and a horizon before, so folders of older
    runs are not read.
    """
    path, name = _t(warehouse, "forecast_results"), lambda t: t.strftime("%Y%m%dT%H%M%S")
    horizon = rows.agg(F.max(F.datediff("forecast_date", F.lit(run_date).cast("date")))).first()[0]
    if path_exists(spark, path):
        known = read_results(spark, warehouse).filter(F.col(RUN).between(name(run_date - dt.timedelta(days=days + max(horizon, 0) + 1)), name(run_date)))
    else:
        known = spark.createDataFrame([], RESULTS_STORED)
    own = known.filter(F.col(RUN) == name(run_date)).drop(RUN)
    merged = upsert(own, rows, FORECAST_KEY, ["forecast", "lower_bound", "upper_bound"], on_insert={"loaded_at": stamp})
    merged = _fill_actual(merged, train).withColumn(RUN, F.lit(name(run_date)))
    earlier = known.filter(F.col(RUN) != name(run_date))
    filled = _fill_actual(earlier.drop(RUN), train).withColumn(RUN, F.date_format("generated_at", "yyyyMMdd'T'HHmmss"))
    # Runs with a day that has come since; at most one a day of the window, or as many as were made.
    due = filled.join(earlier.filter("actual IS NULL").select(RUN, "region", "forecast_date"), [RUN, "region", "forecast_date"], "left_semi")
    due = due.filter("actual IS NOT NULL").select(RUN).distinct().checkpoint(eager=True)
    out = merged.unionByName(filled.join(F.broadcast(due), RUN, "left_semi").select(merged.columns))
    touched = due.union(spark.createDataFrame([(name(run_date),)], f"{RUN} string")).distinct()
    tables.replace_days(out.select(RESULTS_STORED.names), path, touched, RUN)
    return read_results(spark, warehouse).filter(F.col(RUN) == name(run_date)).drop(RUN)


def _fill_actual(results: DataFrame, daily: DataFrame) -> DataFrame:
    """Results with ``actual`` set where the day's mean is known now."""
    known = daily.select(F.replace("region", F.lit('"'), F.lit("")).alias("region"), F.col("date").alias("forecast_date"), F.col("avg_demand_mw").alias("_now"))
    known = known.dropDuplicates(["region", "forecast_date"])
    return results.join(known, ["region", "forecast_date"], "left").withColumn("actual", F.coalesce("_now", "actual")).select(results.columns)


def _merge(spark: SparkSession, warehouse: str, name: str, rows: DataFrame, keys: Sequence[str]) -> None:
    """Upsert small rows into a small table, made on first use."""
    path = _t(warehouse, name)
    target = spark.read.parquet(path) if tables.restore_table(spark, path) else spark.createDataFrame([], rows.schema)
    tables.stage_and_replace(upsert(target, rows, keys, [c for c in rows.columns if c not in keys]), path)
