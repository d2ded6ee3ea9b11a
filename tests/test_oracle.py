"""Every registered query against its DuckDB text on the smallest scale."""

import pytest

import __spark_entry__ as entry
from wattage.plans.catalog import QUERIES
from check_oracle import digest, duck, type_mismatches

NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_dir, con, name):
    sdf = entry.queries()[name](spark, sf_dir)
    rel = con.sql(entry.oracle_sql()[name])
    stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    assert type_mismatches(stypes, dict(zip(rel.columns, [str(t) for t in rel.types]))) == {}
    got, want = sdf.toPandas(), rel.df()
    assert sorted(got.columns) == sorted(want.columns)
    assert digest(got) == digest(want)


def test_every_query_has_oracle_or_is_rows_only():
    rows_only = set(QUERIES) - set(entry.oracle_sql())
    assert rows_only == {"fit_gbt", "gbt_forecast", "feature_importance"}


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "avg_demand_mw" in df.columns
