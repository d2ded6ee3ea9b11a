"""Physical plan shape: what must (not) appear at scale."""

import datetime as dt

from wattage.operators import calendar, dims, facts, staging, upsert
from wattage.sources import fixtures

T0 = dt.datetime(2024, 1, 31)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _dims(spark, sf_dir):
    stg = staging.stg_hourly(fixtures.raw_readings(spark, sf_dir))
    return stg, dims.dim_region(stg, T0), calendar.dim_date(spark)


def test_dimensions_are_broadcast(spark, sf_dir):
    stg, dr, dd = _dims(spark, sf_dir)
    plan = _plan(facts.fct_hourly_rows(stg, dr, dd))
    assert plan.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in plan


def test_fact_key_has_no_single_task_window(spark, sf_dir):
    stg, dr, dd = _dims(spark, sf_dir)
    plan = _plan(facts.fct_hourly(stg, dr, dd))
    # rows are numbered inside their hour; the offsets (a row per hour) come stored and broadcast
    assert plan.count("Window") == 1 and "SinglePartition" not in plan
    assert "hashpartitioning(period_date" in plan


def test_staging_filter_reaches_the_scan(spark, tmp_path, sf_dir):
    path = str(tmp_path / "raw")
    fixtures.raw_readings(spark, sf_dir).write.parquet(path)
    raw = spark.read.parquet(path)
    plan = _plan(staging.stg_hourly(raw).select("period_date", "demand_value"))
    assert "GreaterThan(value,0.0)" in plan and "IsNotNull(value)" in plan
    read = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "respondent_name" not in read  # pruned


def test_insert_absent_is_anti_join(spark, sf_dir):
    from wattage.plans.catalog import seed_regions

    stg, dr, _ = _dims(spark, sf_dir)
    # without key numbering (which checkpoints the new rows) the anti join stays in this plan
    plan = _plan(upsert.insert_absent(dr, seed_regions(spark), ["respondent"]))
    assert "LeftAnti" in plan


def test_dedupe_combines_on_map_side(spark, sf_dir):
    from wattage.schemas import RAW_KEY

    batch = upsert.dedupe_batch(fixtures.upsert_batch_source(spark, sf_dir), RAW_KEY, ["loaded_at"])
    plan = _plan(batch)
    # partial aggregate before the exchange, final after it: a hot key ships one row per task
    assert plan.count("Aggregate") >= 2 and "Window" not in plan
