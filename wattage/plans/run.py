"""Command line for the scheduled jobs (for any scheduler).

    python -m wattage.plans.run setup   --warehouse W
    python -m wattage.plans.run load    --warehouse W --landing L [--as-of T] [--regions A,B] [--newest N] [--multi-line]
    python -m wattage.plans.run build   --warehouse W [--as-of T] [--accepted A,B] [--no-gate] [--one-row-per-respondent]
    python -m wattage.plans.run refresh --warehouse W [--since YYYY-MM-DD] [--as-of T] [--accepted A,B] [--no-gate] [--one-row-per-respondent]
    python -m wattage.plans.run forecast --warehouse W --run-date YYYY-MM-DD [--days 90] [--horizon 7] [--boosted-trees]

The session comes from the environment (``PYSPARK_SUBMIT_ARGS`` / Spark
settings; under spark-submit, submit a two-line launcher that calls
``wattage.plans.run.main()``); ``configure`` adds the library's SQL settings.
Prints one JSON line with what the job reports.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from ..functions.time import utc_now
from ..session import configure
from . import jobs


def _ts(text: str | None) -> dt.datetime:
    return dt.datetime.fromisoformat(text) if text else utc_now()


def _list(text: str | None, default):
    return tuple(x for x in text.split(",") if x) if text else default


def parse(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="wattage.plans.run")
    p.add_argument("job", choices=["setup", "load", "build", "refresh", "forecast"])
    p.add_argument("--warehouse", required=True)
    p.add_argument("--landing")
    p.add_argument("--as-of")
    p.add_argument("--since")
    p.add_argument("--run-date")
    p.add_argument("--regions")
    p.add_argument("--accepted")
    p.add_argument("--days", type=int, default=90)
    p.add_argument("--horizon", type=int, default=7)
    p.add_argument("--no-gate", action="store_true")
    p.add_argument("--one-row-per-respondent", action="store_true")
    p.add_argument("--newest", type=int, help="load only so many readings per region")
    p.add_argument("--multi-line", action="store_true", help="pages that span lines")
    p.add_argument("--new-files-only", action="store_true", help="leave out files loaded before")
    p.add_argument("--boosted-trees", action="store_true")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    a = parse(sys.argv[1:] if argv is None else argv)
    spark = configure(spark or SparkSession.builder.getOrCreate())
    as_of = _ts(a.as_of)
    accepted = _list(a.accepted, jobs.ACCEPTED)
    if a.job == "setup":
        jobs.initial_setup(spark, a.warehouse, as_of)
        out = {"job": "setup"}
    elif a.job == "load":
        if not a.landing:
            raise SystemExit("load needs --landing")
        res = jobs.hourly_load(spark, a.landing, a.warehouse, as_of, regions=_list(a.regions, jobs.REQUESTED_REGIONS), newest=a.newest, multi_line=a.multi_line, new_files_only=a.new_files_only)
        out = {"job": "load", **{k: str(v) for k, v in res.items()}}
    elif a.job in ("build", "refresh"):
        if a.job == "build":
            report = jobs.build_marts(spark, a.warehouse, as_of, a.one_row_per_respondent, accepted, not a.no_gate)
        else:
            since = dt.date.fromisoformat(a.since) if a.since else None
            report = jobs.refresh_marts(spark, a.warehouse, since, as_of, accepted, not a.no_gate, a.one_row_per_respondent)
        failing = {f"{r['check']}:{r['table_name']}.{r['column_name']}": r["failures"] for r in report.filter("failures > 0").collect()}
        out = {"job": a.job, "failing_checks": failing}
    else:
        if not a.run_date:
            raise SystemExit("forecast needs --run-date")
        run = _ts(a.run_date)
        rows = jobs.daily_forecast(spark, a.warehouse, run, as_of=_ts(a.as_of) if a.as_of else None, days=a.days, horizon=a.horizon, boosted_trees=a.boosted_trees)
        out = {"job": "forecast", "forecast_rows": rows.count()}
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
