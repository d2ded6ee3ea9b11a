"""The three jobs end to end on landed pages built from the fixture."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from wattage.plans import jobs
from wattage.sources import fixtures, journal, pages, tables

AS_OF = dt.datetime(2024, 1, 31)
FIXTURE_REGIONS = ("click", "purchase", "signup", "view", "error")


def test_load_transform_forecast(spark, sf_dir, tmp_path):
    landing, wh = str(tmp_path / "landing"), str(tmp_path / "wh")
    pages.write_pages(fixtures.service_readings(spark, sf_dir), landing)
    first = jobs.hourly_load(spark, landing, wh, AS_OF, regions=FIXTURE_REGIONS)
    raw1 = sorted(tuple(r) for r in tables.scan_raw(spark, f"{wh}/raw_readings").collect())
    assert first["rejected"] > 0 and len(raw1) > 0
    jobs.hourly_load(spark, landing, wh, AS_OF, regions=FIXTURE_REGIONS)
    raw2 = sorted(tuple(r) for r in tables.scan_raw(spark, f"{wh}/raw_readings").collect())
    assert raw1 == raw2  # re-running the load changes nothing

    report = jobs.build_marts(spark, wh, AS_OF, accepted=FIXTURE_REGIONS, gate=False)
    failing = {(r.check, r.table_name, r.column_name) for r in report.filter("failures > 0").collect()}
    assert ("not_null", "raw_readings", "value") in failing  # planted NULL values
    fct = jobs.read_fact(spark, wh)
    keys = [r[0] for r in fct.orderBy("period_date", "demand_key").select("demand_key").collect()]
    assert keys == list(range(1, fct.count() + 1))
    snap = jobs.read_mart(spark, wh, "snap_region")
    assert snap.count() == 5 and snap.filter("is_current").count() == 5
    jobs.build_marts(spark, wh, AS_OF, accepted=FIXTURE_REGIONS, gate=False)
    assert jobs.read_mart(spark, wh, "snap_region").count() == 5  # no change, no new history rows

    rows = jobs.daily_forecast(spark, wh, AS_OF)
    n = rows.count()
    assert n > 0 and n % 7 == 0
    jobs.daily_forecast(spark, wh, AS_OF)
    res = spark.read.parquet(f"{wh}/forecast_results")
    assert res.count() == n  # idempotent merge on (region, date, generated_at)
    assert spark.read.parquet(f"{wh}/model_metrics").filter("metric_name = 'FORECAST_PERIODS'").count() == n // 7


def test_daily_from_hourly_equals_daily(spark, sf_dir):
    from wattage.operators import marts, staging

    stg = staging.stg_hourly(fixtures.raw_readings(spark, sf_dir))
    a = marts.daily_demand(stg)
    b = marts.daily_from_hourly(staging.demand_by_region(stg))
    keys = ["period_day", "respondent", "respondent_name"]
    j = a.alias("a").join(b.alias("b"), keys, "full_outer")
    cols = ["avg_demand_mw", "min_demand_mw", "max_demand_mw", "total_demand_mwh", "hourly_record_count"]
    bad = j.filter(" OR ".join(f"abs(a.{c} - b.{c}) > 1e-6 OR a.{c} IS NULL OR b.{c} IS NULL" for c in cols))
    assert a.count() == b.count() and bad.count() == 0


def _second_landing(spark, sf_dir, tmp_path):
    """Events again from 2024-01-20 on: half with doubled values (corrections of
    loaded hours), the rest moved a week later (new hours) or past the calendar's
    default end."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").filter(F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz"))
    moved = ev.select(
        "event_id",
        F.when(F.col("user_id") % 10 == 4, F.col("ts") + F.expr("INTERVAL 1500 DAYS"))  # past the calendar
        .when(F.col("user_id") % 2 == 0, F.col("ts") + F.expr("INTERVAL 7 DAYS"))
        .otherwise(F.col("ts"))
        .alias("ts"),
        "user_id", "event_type",
        F.when(F.col("user_id") % 2 == 1, F.col("value") * 2).otherwise(F.col("value")).alias("value"),
        "props",
    )
    src = tmp_path / "sf2"
    moved.write.parquet(str(src / "events.parquet"))
    landing = str(tmp_path / "landing2")
    pages.write_pages(fixtures.service_readings(spark, str(src)), landing)
    return landing


def _same(a, b):
    cols = sorted(a.columns)
    a, b = a.select(cols), b.select(cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _assert_same_warehouse(spark, inc, full):
    for name in ("stg_by_region", "dim_region", "dim_date", "fct_hours", "summary_hours", "fct_daily", "raw_region_days", "snap_region"):
        a, b = jobs.read_mart(spark, inc, name), jobs.read_mart(spark, full, name)
        if name == "dim_date":  # a calendar only grows
            a, b = a.filter("year < 2027"), b.filter("year < 2027")
        doubles = [c for c, t in a.dtypes if t == "double"]  # sums may differ in the last bits
        r = lambda df: df.select(*[F.round(c, 6).alias(c) if c in doubles else c for c in df.columns])  # noqa: E731, B023
        assert _same(r(a), r(b)), name
    assert _same(jobs.read_fact(spark, inc), jobs.read_fact(spark, full))
    r = lambda df: df.select(*[F.round(c, 5).alias(c) if t == "double" else c for c, t in df.dtypes])
    assert _same(r(jobs.read_summary(spark, inc)), r(jobs.read_summary(spark, full)))


def test_incremental_refresh_equals_full_build(spark, sf_dir, tmp_path, monkeypatch):
    landing = str(tmp_path / "landing")
    pages.write_pages(fixtures.service_readings(spark, sf_dir), landing)
    landing2 = _second_landing(spark, sf_dir, tmp_path)
    inc, full = str(tmp_path / "inc"), str(tmp_path / "full")
    for wh in (inc, full):
        jobs.hourly_load(spark, landing, wh, AS_OF, regions=FIXTURE_REGIONS)
        jobs.build_marts(spark, wh, AS_OF, accepted=FIXTURE_REGIONS, gate=False)
    t2 = dt.datetime(2024, 2, 1)
    out = jobs.hourly_load(spark, landing2, inc, t2, regions=FIXTURE_REGIONS)
    jobs.hourly_load(spark, landing2, full, t2, regions=FIXTURE_REGIONS)
    assert out["first_day"] == dt.date(2024, 1, 20)
    full_build = jobs.build_marts

    def no_fallback(*a, **k):
        raise AssertionError("refresh fell back to a full build")

    monkeypatch.setattr(jobs, "build_marts", no_fallback)
    # A refresh that fails half-way leaves its marks; the next one, without being told a day, catches up.
    daily = jobs.marts.daily_from_hourly
    monkeypatch.setattr(jobs.marts, "daily_from_hourly", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        jobs.refresh_marts(spark, inc, None, AS_OF, accepted=FIXTURE_REGIONS, gate=False)
    monkeypatch.setattr(jobs.marts, "daily_from_hourly", daily)
    jobs.refresh_marts(spark, inc, None, AS_OF, accepted=FIXTURE_REGIONS, gate=False)
    full_build(spark, full, AS_OF, accepted=FIXTURE_REGIONS, gate=False)
    assert jobs.read_mart(spark, inc, "fct_hourly").filter("date_key IS NULL").count() == 0
    assert jobs.read_mart(spark, inc, "fct_hourly").filter("date_key > 20270000").count() > 0  # past the default calendar
    assert journal.pending(spark, inc) == []
    _assert_same_warehouse(spark, inc, full)


def test_region_days_give_the_same_history_input(spark, sf_dir):
    from wattage.operators import history

    raw = fixtures.raw_readings(spark, sf_dir)
    a = history.region_history_input(raw, AS_OF)
    b = history.region_history_input(jobs.region_days(raw), AS_OF)
    assert _same(a, b)


def test_initial_setup_is_idempotent(spark, tmp_path):
    wh = str(tmp_path / "wh")
    for _ in range(2):
        jobs.initial_setup(spark, wh, AS_OF)
        dr = jobs.read_mart(spark, wh, "dim_region")
        assert dr.count() == 6 and jobs.read_mart(spark, wh, "dim_date").count() == 1461
    keys = {r.respondent: r.region_key for r in dr.collect()}
    assert keys == {"US48": 1, "CISO": 2, "TEXA": 3, "MISO": 4, "NYISO": 5, "PJM": 6}


def test_refresh_with_new_region_falls_back_to_full_build(spark, sf_dir, tmp_path):
    landing = str(tmp_path / "landing")
    pages.write_pages(fixtures.service_readings(spark, sf_dir), landing)
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").filter(F.col("ts") >= F.lit("2024-01-25").cast("timestamp_ntz"))
    renamed = ev.withColumn("event_type", F.when(F.col("event_type") == "click", F.lit("alpha")).otherwise(F.col("event_type")))
    src = tmp_path / "sf2"
    renamed.write.parquet(str(src / "events.parquet"))
    landing2 = str(tmp_path / "landing2")
    pages.write_pages(fixtures.service_readings(spark, str(src)), landing2)
    regions = (*FIXTURE_REGIONS, "alpha")
    inc, full = str(tmp_path / "inc"), str(tmp_path / "full")
    for wh in (inc, full):
        jobs.hourly_load(spark, landing, wh, AS_OF, regions=regions)
        jobs.build_marts(spark, wh, AS_OF, accepted=regions, gate=False)
    out = jobs.hourly_load(spark, landing2, inc, AS_OF, regions=regions)
    jobs.hourly_load(spark, landing2, full, AS_OF, regions=regions)
    jobs.refresh_marts(spark, inc, out["first_day"], AS_OF, accepted=regions, gate=False)
    jobs.build_marts(spark, full, AS_OF, accepted=regions, gate=False)
    assert jobs.read_mart(spark, inc, "dim_region").filter("respondent = 'alpha'").first().region_key == 1
    _assert_same_warehouse(spark, inc, full)


def test_command_line_runs_the_jobs(spark, sf_dir, tmp_path):
    from wattage.plans import run

    landing, wh = str(tmp_path / "landing"), str(tmp_path / "wh")
    pages.write_pages(fixtures.service_readings(spark, sf_dir), landing)
    regions = ",".join(FIXTURE_REGIONS)
    run.main(["setup", "--warehouse", wh, "--as-of", "2024-01-31"], spark)
    out = run.main(["load", "--warehouse", wh, "--landing", landing, "--as-of", "2024-01-31", "--regions", regions], spark)
    assert out["first_day"] == "2024-01-01"
    built = run.main(["build", "--warehouse", wh, "--as-of", "2024-01-31", "--accepted", regions, "--no-gate"], spark)
    assert "not_null:raw_readings.value" in built["failing_checks"]
    run.main(["refresh", "--warehouse", wh, "--since", "2024-01-28", "--as-of", "2024-01-31", "--accepted", regions, "--no-gate"], spark)
    fc = run.main(["forecast", "--warehouse", wh, "--run-date", "2024-01-31"], spark)
    assert fc["forecast_rows"] > 0 and fc["forecast_rows"] % 7 == 0


def test_one_pass_hourly_and_region_days(spark, sf_dir):
    from wattage.operators import staging

    raw = fixtures.raw_readings(spark, sf_dir)
    hourly, days = jobs.hourly_and_region_days(raw)
    want = staging.demand_by_region(staging.stg_hourly(raw))
    r = lambda df: df.select(
        "period_date", "respondent", "respondent_name", "record_count",
        *[F.round(c, 6).alias(c) for c in ("total_demand", "avg_demand", "max_demand", "min_demand")],
    )
    assert _same(r(hourly), r(want))
    assert _same(days, jobs.region_days(raw))


def _reading(period, value, region="PJM", name="Name", kind="D"):
    return {"period": period, "respondent": region, "respondent-name": name, "type": kind, "type-name": "Demand", "value": value}


def _land(folder, *rows):
    folder.mkdir(parents=True)
    (folder / "part.json").write_text("\n".join(r if isinstance(r, str) else json.dumps({"response": {"total": "1", "data": [r]}}) for r in rows) + "\n")


def test_rename_gives_one_open_row_per_code(spark, tmp_path):
    wh = str(tmp_path / "wh")
    _land(tmp_path / "l1", _reading("2024-01-05T01", "5", name="Old"), _reading("2024-01-05T01", "6", region="CISO"))
    _land(tmp_path / "l2", _reading("2024-01-06T01", "7", name="New"))
    options = {"accepted": ("PJM", "CISO"), "one_row_per_respondent": True}  # the gate stays on
    jobs.hourly_load(spark, str(tmp_path / "l1"), wh, AS_OF, regions=("PJM", "CISO"))
    jobs.build_marts(spark, wh, AS_OF, **options)
    jobs.hourly_load(spark, str(tmp_path / "l2"), wh, AS_OF, regions=("PJM", "CISO"))
    for day in range(1, 6):
        run = jobs.refresh_marts if day % 2 else lambda s, w, _, t, **k: jobs.build_marts(s, w, t, **k)
        run(spark, wh, None, dt.datetime(2024, 2, day), **options)
        snap = jobs.read_mart(spark, wh, "snap_region").collect()
        assert len(snap) == 3
        assert {r.respondent: r.respondent_name for r in snap if r.is_current} == {"PJM": "New", "CISO": "Name"}
        assert jobs.read_fact(spark, wh).count() == 3
    assert jobs.read_mart(spark, wh, "dim_region").count() == 2


def test_gate_names_every_failing_check(spark, tmp_path):
    wh = str(tmp_path / "wh")
    _land(tmp_path / "l", _reading("2024-01-05T01", "5", name="Old"), _reading("2024-01-05T02", "x", name="New"), _reading("2024-01-05T03", "5", name="New"))
    jobs.hourly_load(spark, str(tmp_path / "l"), wh, AS_OF, regions=("PJM",))
    with pytest.raises(AssertionError) as e:
        jobs.build_marts(spark, wh, AS_OF, accepted=("CISO",))
    for check in ("unique dim_region.respondent (1)", "not_null raw_readings.value (1)", "accepted_values stg_hourly.respondent (2)"):
        assert check in str(e.value)


def test_load_counts_and_stores_what_it_sets_aside(spark, tmp_path):
    wh = str(tmp_path / "wh")
    _land(
        tmp_path / "l", _reading("2024-01-05T01", "100"), _reading("2024-01-05T01", "90"), _reading("2024-01-05T02", "1", region=None),
        _reading("2024-01-05T02", "1", region=""), _reading("9999-01-05T02", "1"), _reading("2024-01-05T03", "1", region="TEXA"),
        '{"response": {"data": [{"period": "2024', '{"response": {"total": "0", "data": []}}', '{"other": 1}', _reading("2024-01-05T04", "3"),
    )
    out = jobs.hourly_load(spark, str(tmp_path / "l"), wh, AS_OF, regions=("PJM",))
    assert (out["rejected"], out["left_out"], out["loaded_today"]) == (5, 0, 2)
    raw = {r.period_date.hour: r.value for r in tables.scan_raw(spark, f"{wh}/raw_readings").collect()}
    assert raw == {1: 90.0, 4: 3.0}  # the later reading of a page, though it is lower
    jobs.hourly_load(spark, str(tmp_path / "l"), wh, AS_OF, regions=("PJM",))
    rejects = spark.read.parquet(f"{wh}/rejects")
    assert sorted(r.reason for r in rejects.collect()) == ["page", "page", "period", "respondent", "respondent"]
    assert any("2024" in (r.page or "") for r in rejects.collect())
    capped = jobs.hourly_load(spark, str(tmp_path / "l"), str(tmp_path / "w2"), AS_OF, regions=("PJM",), newest=1)
    assert capped["left_out"] == 1


def test_jobs_leave_no_scratch(spark, tmp_path):
    import os

    from wattage.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    files = lambda: {os.path.join(d, f) for d, _, fs in os.walk(base) for f in fs}
    before, wh = files(), str(tmp_path / "wh")
    _land(tmp_path / "l", *[_reading(f"2024-01-{d:02d}T01", str(50 + d)) for d in range(1, 31)])
    jobs.initial_setup(spark, wh, AS_OF)
    jobs.hourly_load(spark, str(tmp_path / "l"), wh, AS_OF, regions=("PJM",))
    jobs.build_marts(spark, wh, AS_OF, accepted=("PJM",))
    jobs.refresh_marts(spark, wh, dt.date(2024, 1, 28), AS_OF, accepted=("PJM",))
    assert jobs.daily_forecast(spark, wh, AS_OF).count() == 7
    with pytest.raises(ValueError):
        jobs.daily_forecast(spark, wh, dt.datetime(2030, 1, 1))
    assert files() == before
    assert not [n for n in os.listdir(wh) if "__" in n]


def test_forecast_job_survives_awkward_series(spark, tmp_path):
    wh = str(tmp_path / "wh")
    rows = [_reading(f"2024-01-{d:02d}T01", str(50 + d)) for d in range(1, 31)]
    rows += [_reading(f"2024-01-{d:02d}T01", "7", region="CISO") for d in range(1, 31)]  # flat
    rows += [_reading(f"2024-01-{d:02d}T01", "7", region="MISO") for d in range(25, 31)]  # short
    rows += [_reading(f"2024-01-{d:02d}T01", str(d), region="US48") for d in [*range(1, 21), 30]]  # a gap
    _land(tmp_path / "l", *rows)
    jobs.hourly_load(spark, str(tmp_path / "l"), wh, AS_OF)
    jobs.build_marts(spark, wh, AS_OF)
    assert jobs.daily_forecast(spark, wh, AS_OF).count() == 21
    metrics = {(r.region, r.metric_name): r.metric_value for r in spark.read.parquet(f"{wh}/model_metrics").collect()}
    assert metrics["CISO", "R2"] is None and metrics["CISO", "MAE"] is not None and metrics["US48", "MAE"] is not None
    assert [r.region for r in spark.read.parquet(f"{wh}/skipped_series").collect()] == ["MISO"]
    # the next day's run fills in what yesterday's forecast came to
    _land(tmp_path / "l2", _reading("2024-01-31T01", "81"))
    jobs.hourly_load(spark, str(tmp_path / "l2"), wh, AS_OF)
    jobs.refresh_marts(spark, wh, None, AS_OF)
    trees = jobs.daily_forecast(spark, wh, dt.datetime(2024, 2, 1), boosted_trees=True)
    assert trees.count() == 21 and trees.filter("lower_bound <= forecast AND forecast <= upper_bound").count() >= 14
    known = spark.read.parquet(f"{wh}/forecast_results").filter("actual IS NOT NULL").collect()
    assert [(r.region, r.actual) for r in known] == [("PJM", 81.0)]
    assert spark.read.parquet(f"{wh}/feature_importance").count() == 4


# --- versions and the journal

REGIONS = ("PJM", "CISO")


def _state(spark, wh):
    """What readers see of every mart, keys included."""
    names = (*jobs.MARTS, "dim_region", "dim_date", "snap_region")
    out = {n: sorted(map(str, jobs.read_mart(spark, wh, n).collect())) for n in names}
    out["keyed fact"] = sorted(map(str, jobs.read_fact(spark, wh).collect()))
    out["keyed summary"] = sorted(map(str, jobs.read_summary(spark, wh).collect()))
    return out


def _days(folder, *days, value="5", regions=REGIONS):
    _land(folder, *[_reading(f"2024-01-{d:02d}T{h:02d}", value, region=r) for d in days for h in (1, 2) for r in regions])
    return str(folder)


def _load(spark, folder, wh, as_of=AS_OF, **options):
    return jobs.hourly_load(spark, folder, wh, as_of, regions=REGIONS, **options)


def test_a_refresh_stopped_at_any_write_leaves_the_old_version(spark, tmp_path, monkeypatch):
    from wattage.sources import files, versions

    wh, full = str(tmp_path / "wh"), str(tmp_path / "full")
    options = {"accepted": REGIONS}
    _load(spark, _days(tmp_path / "a", 5, 6), wh)
    jobs.build_marts(spark, wh, AS_OF, **options)
    old = _state(spark, wh)
    _load(spark, _days(tmp_path / "b", 5, 9, value="7"), wh)
    write, publish, write_once = versions.Build.write, versions.Build.publish, files.write_once
    stops = 0

    class Stop(BaseException):  # as if the process ended: nothing is tidied up
        pass

    for at in range(20):
        calls = 0

        def stopping(self, *a, **k):
            nonlocal calls
            calls += 1
            out = write(self, *a, **k)
            if calls == at + 1:
                raise Stop
            return out

        monkeypatch.setattr(versions.Build, "__exit__", lambda *a: None)
        monkeypatch.setattr(versions.Build, "write", stopping)
        if at == 19:  # all was written, the pointer is torn
            monkeypatch.setattr(versions.Build, "write", write)
            monkeypatch.setattr(files, "write_once", lambda s, path, text: write_once(s, path, text[:40] if "/versions/" in path else text))
            monkeypatch.setattr(journal, "consume", lambda *a: (_ for _ in ()).throw(Stop()))
        try:
            jobs.refresh_marts(spark, wh, None, AS_OF, **options)
            break
        except Stop:
            stops += 1
            if at in (0, 3, 7, 19):
                assert _state(spark, wh) == old, at
            assert jobs.read_fact(spark, wh).count() == 8
    monkeypatch.undo()
    assert stops == 9  # seven divided tables, the list of raw days and the history
    jobs.refresh_marts(spark, wh, None, AS_OF, **options)
    for folder in ("a", "b"):
        _load(spark, str(tmp_path / folder), full)
    jobs.build_marts(spark, full, AS_OF, **options)
    new = _state(spark, wh)
    assert new == _state(spark, full) and new != old
    assert journal.pending(spark, wh) == []
    # Stopped builds leave nothing behind.
    builds = {n for t in files.names(spark, f"{wh}/marts") for n in files.names(spark, f"{wh}/marts/{t}")}
    assert len(builds) <= 3


def test_a_torn_pointer_is_no_version(spark, tmp_path):
    from wattage.sources import files, versions

    wh = str(tmp_path / "wh")
    _load(spark, _days(tmp_path / "a", 5), wh)
    jobs.build_marts(spark, wh, AS_OF, accepted=REGIONS)
    old = _state(spark, wh)
    files.write_once(spark, f"{wh}/versions/000000002.json", '{"number": 2, "tab')
    assert versions.current(spark, wh).number == 1 and _state(spark, wh) == old
    _load(spark, _days(tmp_path / "b", 6), wh)
    jobs.refresh_marts(spark, wh, None, AS_OF, accepted=REGIONS)
    assert versions.current(spark, wh).number == 3 and jobs.read_fact(spark, wh).count() == 8
    with pytest.raises(FileExistsError):
        files.write_once(spark, f"{wh}/versions/000000003.json", "{}")


def test_a_failed_gate_changes_no_mart(spark, tmp_path):
    wh = str(tmp_path / "wh")
    _load(spark, _days(tmp_path / "a", 5), wh)
    jobs.build_marts(spark, wh, AS_OF, accepted=REGIONS)
    old = _state(spark, wh)
    _load(spark, _days(tmp_path / "b", 6, value="x"), wh)
    for job in (lambda: jobs.refresh_marts(spark, wh, None, AS_OF, accepted=REGIONS), lambda: jobs.build_marts(spark, wh, AS_OF, accepted=REGIONS)):
        with pytest.raises(AssertionError):
            job()
        assert _state(spark, wh) == old
    assert [e.merged for e in journal.pending(spark, wh)] == [True]  # still to be taken in


def test_rows_without_their_hour_stop_the_reader(spark, tmp_path):
    from wattage.sources import versions

    wh = str(tmp_path / "wh")
    _load(spark, _days(tmp_path / "a", 5, 6), wh)
    jobs.build_marts(spark, wh, AS_OF, accepted=REGIONS)
    version = versions.current(spark, wh)
    hours = f"{wh}/marts/fct_hours/build={version.builds()[0]}"
    table = spark.read.parquet(hours).collect()
    schema = spark.read.parquet(hours).schema
    # An hour is lost; then its rows are counted elsewhere, so that the totals agree.
    spark.createDataFrame(table[1:], schema).write.mode("overwrite").partitionBy("part_day").parquet(hours)
    with pytest.raises(ValueError, match="fct_hours counts 6 rows, fct_hourly holds 8"):
        jobs.read_fact(spark, wh)
    moved = [r.asDict() for r in table[1:]]
    moved[0]["n_rows"] += table[0]["n_rows"]
    spark.createDataFrame(moved, schema).write.mode("overwrite").partitionBy("part_day").parquet(hours)
    with pytest.raises(Exception, match="a row of fct_hourly has no hour"):
        jobs.read_fact(spark, wh).collect()


def test_two_loads_of_one_stamp_and_a_stream_reach_the_marts(spark, tmp_path):
    from wattage.streaming.ingest import ingest_stream

    wh, full = str(tmp_path / "wh"), str(tmp_path / "full")
    _load(spark, _days(tmp_path / "l1", 1), wh)
    jobs.build_marts(spark, wh, AS_OF, accepted=REGIONS)
    bad = '{"response": {"data": [{"period": "2024'
    for name, day in (("l2", 5), ("l3", 9)):
        _days(tmp_path / name, day)
        (tmp_path / name / "bad.json").write_text(bad + name + "\n")
        _load(spark, str(tmp_path / name), wh, dt.datetime(2024, 2, 2))
    assert len({e.name for e in journal.pending(spark, wh)}) == 2
    assert spark.read.parquet(f"{wh}/rejects").count() == 2  # neither load's rejects are overwritten
    _days(tmp_path / "s" / "a", 12)
    stream = lambda: ingest_stream(spark, f"{tmp_path}/s/*", f"{wh}/raw_readings", str(tmp_path / "ck"), as_of=dt.datetime(2024, 2, 2))
    stream()
    assert [d.day for e in journal.pending(spark, wh) for d in e.days if e.name.startswith("stream-")] == [12]
    jobs.refresh_marts(spark, wh, None, AS_OF, accepted=REGIONS)
    assert journal.pending(spark, wh) == []
    # A replay of the micro-batch after it was taken in: its entry is open again.
    for part in ("commits", "offsets"):
        for f in (tmp_path / "ck" / part).iterdir():
            if part == "commits":
                f.unlink()
    stream()
    (entry,) = journal.pending(spark, wh)
    assert entry.merged and [d.day for d in entry.days] == [12]
    jobs.refresh_marts(spark, wh, None, AS_OF, accepted=REGIONS)
    for name in ("l1", "l2", "l3"):
        _load(spark, str(tmp_path / name), full, AS_OF if name == "l1" else dt.datetime(2024, 2, 2))
    ingest_stream(spark, f"{tmp_path}/s/*", f"{full}/raw_readings", str(tmp_path / "ck2"), as_of=dt.datetime(2024, 2, 2))
    jobs.build_marts(spark, full, AS_OF, accepted=REGIONS)
    assert _state(spark, wh) == _state(spark, full)


def test_an_unfinished_load_is_taken_in_but_not_consumed(spark, tmp_path, monkeypatch):
    """A refresh that runs while a load merges must not mark that load as done."""
    wh = str(tmp_path / "wh")
    _load(spark, _days(tmp_path / "a", 5), wh)
    jobs.build_marts(spark, wh, AS_OF, accepted=REGIONS)
    merge = tables.upsert_raw

    def refresh_first(*a, **k):
        jobs.refresh_marts(spark, wh, None, AS_OF, accepted=REGIONS)
        return merge(*a, **k)

    monkeypatch.setattr(tables, "upsert_raw", refresh_first)
    _load(spark, _days(tmp_path / "b", 6), wh)
    assert jobs.read_fact(spark, wh).count() == 4 and len(journal.pending(spark, wh)) == 1
    jobs.refresh_marts(spark, wh, None, AS_OF, accepted=REGIONS)
    assert jobs.read_fact(spark, wh).count() == 8 and journal.pending(spark, wh) == []


def test_only_new_or_changed_files_are_loaded(spark, tmp_path):
    import os

    wh, land = str(tmp_path / "wh"), tmp_path / "land"
    land.mkdir()
    page = lambda day, value: json.dumps({"response": {"total": "1", "data": [_reading(f"2024-01-{day:02d}T01", value)]}}) + "\n"
    for day in (5, 6):
        (land / f"d{day}.json").write_text(page(day, "1"))
    run = lambda: _load(spark, str(land), wh, new_files_only=True)
    assert run()["files"] == 2
    nothing = run()
    assert (nothing["files"], nothing["first_day"]) == (0, None)
    (land / "d7.json").write_text(page(7, "1"))
    (land / "d5.json").write_text(page(5, "22"))
    os.utime(land / "d5.json", (2e9, 2e9))
    out = run()
    assert out["files"] == 2 and out["first_day"] == dt.date(2024, 1, 5)
    assert {r.period_date.day: r.value for r in tables.scan_raw(spark, f"{wh}/raw_readings").collect()} == {5: 22.0, 6: 1.0, 7: 1.0}


def test_an_older_landing_undoes_no_correction(spark, tmp_path):
    import os

    wh = str(tmp_path / "wh")
    for name, value, at in (("old", "1", 1e9), ("new", "2", 1.1e9)):
        _land(tmp_path / name, _reading("2024-01-05T01", value), *([_reading("2024-01-05T02", "3")] if name == "old" else []))
        os.utime(tmp_path / name / "part.json", (at, at))
    values = lambda: {r.period_date.hour: r.value for r in tables.scan_raw(spark, f"{wh}/raw_readings").collect()}
    _load(spark, str(tmp_path / "new"), wh)
    _load(spark, str(tmp_path / "old"), wh)  # late, but landed before
    assert values() == {1: 2.0, 2: 3.0}
    for name in ("new", "old", "old"):
        _load(spark, str(tmp_path / name), wh)
        assert values() == {1: 2.0, 2: 3.0}


def test_duplicates_and_changes_outside_the_journal_stop_the_gate(spark, tmp_path):
    import shutil

    def twice(day):
        (part,) = (tmp_path / "wh" / "raw_readings" / f"period_day=2024-01-{day:02d}").glob("*.parquet")
        shutil.copy(part, part.with_name(f"copy-{part.name}"))

    wh = str(tmp_path / "wh")
    _load(spark, _days(tmp_path / "a", 5, 6), wh)
    jobs.build_marts(spark, wh, AS_OF, accepted=REGIONS)
    old = _state(spark, wh)
    _load(spark, _days(tmp_path / "b", 6), wh)
    twice(6)
    with pytest.raises(AssertionError, match=r"unique raw_readings.period_date,respondent,data_type \(4\)$"):
        jobs.refresh_marts(spark, wh, None, AS_OF, accepted=REGIONS)
    _load(spark, _days(tmp_path / "c", 6), wh)  # the merge of the day removes the copies
    twice(5)  # a day that no load names
    with pytest.raises(AssertionError, match=r"journalled raw_readings.period_day \(1\)"):
        jobs.refresh_marts(spark, wh, None, AS_OF, accepted=REGIONS)
    with pytest.raises(AssertionError, match=r"unique raw_readings"):
        jobs.build_marts(spark, wh, AS_OF, accepted=REGIONS)
    assert _state(spark, wh) == old


def test_a_day_keeps_few_files_over_many_loads(spark, tmp_path, monkeypatch):
    wh, folder = str(tmp_path / "wh"), tmp_path / "wh" / "raw_readings" / "period_day=2024-01-05"
    files = lambda: len(list(folder.glob("*.parquet")))
    for hour in range(24):
        _land(tmp_path / f"h{hour}", *[_reading(f"2024-01-05T{hour:02d}", "1", region=r) for r in REGIONS])
        if hour < 4 or hour > 20:
            _load(spark, str(tmp_path / f"h{hour}"), wh)
            assert files() == 1
    rows = sorted(map(str, tables.scan_raw(spark, f"{wh}/raw_readings").collect()))
    assert len(rows) == 14
    monkeypatch.setattr(tables, "DAY_FILE_BYTES", 2_000)  # the day's size asks for several
    _load(spark, str(tmp_path / "h5"), wh)
    assert 1 < files() <= 8
    assert len(tables.scan_raw(spark, f"{wh}/raw_readings").collect()) == 16


def test_a_forecast_run_writes_its_own_folder_and_those_with_a_day_to_fill(spark, tmp_path):
    wh = str(tmp_path / "wh")
    _land(tmp_path / "l", *[_reading(f"2024-01-{d:02d}T01", str(50 + d % 5)) for d in range(1, 31)])
    jobs.hourly_load(spark, str(tmp_path / "l"), wh, AS_OF, regions=("PJM",))
    jobs.build_marts(spark, wh, AS_OF, accepted=("PJM",))
    root = tmp_path / "wh" / "forecast_results"
    stamp = lambda: {p.parent.name: p.name for p in root.glob("run=*/*.parquet")}
    jobs.daily_forecast(spark, wh, AS_OF)
    first = stamp()
    jobs.daily_forecast(spark, wh, dt.datetime(2024, 2, 1))  # no new day has come
    second = stamp()
    assert set(second) == {"run=20240131T000000", "run=20240201T000000"} and second["run=20240131T000000"] == first["run=20240131T000000"]
    _land(tmp_path / "l2", _reading("2024-01-31T01", "70"))
    jobs.hourly_load(spark, str(tmp_path / "l2"), wh, AS_OF, regions=("PJM",))
    jobs.refresh_marts(spark, wh, None, AS_OF, accepted=("PJM",))
    jobs.daily_forecast(spark, wh, dt.datetime(2024, 2, 2))
    third = stamp()
    assert all(third[k] != second[k] for k in second)  # both had the 31st to fill
    jobs.daily_forecast(spark, wh, dt.datetime(2024, 2, 3))
    assert {k: v for k, v in stamp().items() if k in third} == third
    rows = jobs.read_results(spark, wh).collect()
    assert len(rows) == 28 and {(r.forecast_date.day, r.actual) for r in rows if r.actual is not None} == {(31, 70.0)}


def test_forecast_reads_no_hourly_fact(spark, tmp_path, monkeypatch):
    wh = str(tmp_path / "wh")
    _land(tmp_path / "l", *[_reading(f"2024-01-{d:02d}T01", str(50 + d % 5)) for d in range(1, 31)])
    jobs.hourly_load(spark, str(tmp_path / "l"), wh, AS_OF, regions=("PJM",))
    jobs.build_marts(spark, wh, AS_OF, accepted=("PJM",))
    read, seen = jobs.versions.read_table, []
    monkeypatch.setattr(jobs.versions, "read_table", lambda s, w, name, *a, **k: seen.append(name) or read(s, w, name, *a, **k))
    jobs.daily_forecast(spark, wh, AS_OF)
    assert seen == ["fct_daily", "dim_region"]
