import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattage.operators import calendar, dims, facts, quality, staging


def test_checks_on_literals(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "z"), (None, "a")], "k int, v string")
    assert quality.check_not_null(df, "v").count() == 1
    assert [tuple(r) for r in quality.check_unique(df, "k").collect()] == [(1, 2)]
    assert quality.check_accepted(df, "v", ["a"]).count() == 1  # NULL passes, 'z' fails
    parent = spark.createDataFrame([(1,)], "k int")
    assert [r.k for r in quality.check_relationship(df, "k", parent, "k").collect()] == [2]  # NULL child ignored
    assert quality.check_count(df, 4).count() == 0 and quality.check_count(df, 3).count() == 1


def test_report_and_gate(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "k int, v string")
    rep = quality.union_reports(
        quality.column_checks(df, "t", ["k", "v"], {"v": ["b"]}),
        quality.quality_report([quality.Check("unique", "t", "k", quality.check_unique(df, "k"))]),
    )
    got = {(r.check, r.column_name): r.failures for r in rep.collect()}
    assert got == {("not_null", "k"): 0, ("not_null", "v"): 1, ("accepted_values", "v"): 0, ("unique", "k"): 0}
    with pytest.raises(AssertionError):
        quality.assert_passes(rep)


def test_calendar(spark):
    dd = calendar.dim_date(spark)
    assert dd.count() == 1461
    first = dd.orderBy("date_value").first()
    assert (first.date_key, first.day_name, first.day_of_week, first.is_weekend, first.month_name) == (20230101, "Sun", 0, True, "January")
    hol = spark.createDataFrame([(dt.date(2024, 12, 25),)], "date_value date")
    flagged = calendar.dim_date(spark, holidays=hol).filter("is_holiday")
    assert [r.date_key for r in flagged.collect()] == [20241225]


def test_reading_after_calendar_has_null_date_key(spark):
    raw = spark.createDataFrame(
        [(dt.datetime(2027, 1, 2, 3), "A", "a", "D", "d", 5.0, "MWh", dt.datetime(2027, 1, 2, 4)),
         (dt.datetime(2026, 12, 31, 3), "A", "a", "D", "d", 5.0, "MWh", dt.datetime(2027, 1, 2, 4))],
        "period_date timestamp_ntz, respondent string, respondent_name string, data_type string, data_type_name string, value double, value_units string, loaded_at timestamp_ntz",
    )
    stg = staging.stg_hourly(raw)
    fct = facts.fct_hourly(stg, dims.dim_region(stg, dt.datetime(2027, 1, 3)), calendar.dim_date(spark))
    keys = {r.period_date.year: r.date_key for r in fct.collect()}
    assert keys == {2027: None, 2026: 20261231}


def test_renamed_region_doubles_facts_unless_one_row(spark):
    raw = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 1), "A", "old", "D", "d", 5.0, "MWh", dt.datetime(2024, 1, 1)),
         (dt.datetime(2024, 1, 1, 2), "A", "new", "D", "d", 6.0, "MWh", dt.datetime(2024, 1, 2))],
        "period_date timestamp_ntz, respondent string, respondent_name string, data_type string, data_type_name string, value double, value_units string, loaded_at timestamp_ntz",
    )
    stg = staging.stg_hourly(raw)
    dd = calendar.dim_date(spark)
    as_ref = dims.dim_region(stg, dt.datetime(2024, 2, 1))
    assert quality.check_unique(as_ref, "respondent").count() == 1
    assert facts.fct_hourly(stg, as_ref, dd).count() == 4
    one = dims.dim_region(stg, dt.datetime(2024, 2, 1), one_row_per_respondent=True)
    assert [r.respondent_name for r in one.collect()] == ["new"]
    assert facts.fct_hourly(stg, one, dd).count() == 2


def test_row_checks_share_one_pass(spark):
    raw = spark.createDataFrame([(1.0, "a"), (None, "a"), (-2.0, None), (3.0, "z")], "value double, respondent string")
    rep = quality.row_checks(
        raw,
        quality.RowChecks("raw", ("value", "respondent")),
        quality.RowChecks("clean", ("demand_value", "respondent"), {"respondent": ["a"]},
                          where=F.col("value") > 0, columns={"demand_value": "value"}),
    )
    got = {(r.table_name, r.check, r.column_name): r.failures for r in rep.collect()}
    assert got == {
        ("raw", "not_null", "value"): 1, ("raw", "not_null", "respondent"): 1,
        ("clean", "not_null", "demand_value"): 0, ("clean", "not_null", "respondent"): 0,
        ("clean", "accepted_values", "respondent"): 1,
    }
    final = rep._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Scan") == 1
