"""Data-quality checks. Each check returns the violating rows; pass = no rows.

``quality_report`` turns a list of checks into one row per check with its
failure count; all counts come out of a single union job.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sizing import small_side


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def check_unique(df: DataFrame, *cols: str) -> DataFrame:
    """Key values that occur more than once (NULL keys are not compared)."""
    present = df
    for c in cols:
        present = present.filter(F.col(c).isNotNull())
    return present.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def check_accepted(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose value is outside ``values``; NULL passes (three-valued NOT IN)."""
    return df.filter(~F.col(col).isin(list(values)))


def check_relationship(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL ``col`` has no parent row (left anti join).

    The parent's distinct keys are counted and broadcast when small, so the
    child (a fact where one key may hold a third of the rows) is not shuffled.
    """
    keys = small_side(parent.select(F.col(parent_col).alias(col)).distinct())
    return child.filter(F.col(col).isNotNull()).join(keys, col, "left_anti")


def check_count(df: DataFrame, expected: int, name: str = "rows") -> DataFrame:
    """One row (actual, expected) when the row count differs from ``expected``."""
    actual = df.agg(F.count(F.lit(1)).alias("actual"))
    return actual.select(F.lit(name).alias("check_name"), "actual", F.lit(expected).cast("long").alias("expected")).filter(
        F.col("actual") != F.col("expected")
    )


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Fail fast when ``df`` is empty (reads at most one row)."""
    if df.isEmpty():
        raise ValueError(message)
    return df


@dataclass(frozen=True)
class Check:
    name: str
    table: str
    column: str
    failures: DataFrame


def quality_report(checks: Iterable[Check]) -> DataFrame:
    """check, table_name, column_name, failures (rows) for every check."""
    parts = [
        c.failures.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(c.name).alias("check"), F.lit(c.table).alias("table_name"), F.lit(c.column).alias("column_name"), "failures"
        )
        for c in checks
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@dataclass(frozen=True)
class RowChecks:
    """Row-level checks of one logical table read from a physical frame:
    ``where`` selects its rows, ``columns`` maps its column names to the
    frame's (e.g. a staging view over the raw table)."""

    table: str
    not_null: Sequence[str] = ()
    accepted: dict | None = None
    where: object = None
    columns: dict | None = None


def row_checks(df: DataFrame, *specs: RowChecks) -> DataFrame:
    """Report rows (check, table_name, column_name, failures) for all ``specs`` from
    ONE aggregate over ``df``: every not_null / accepted_values failure count is a
    conditional count, so several tables derived from one scan share the scan."""
    counts, labels = [], []
    for i, spec in enumerate(specs):
        where = spec.where if spec.where is not None else F.lit(True)
        col = lambda c: F.col((spec.columns or {}).get(c, c))
        for c in spec.not_null:
            counts.append(F.count_if(where & col(c).isNull()).alias(f"c{len(counts)}"))
            labels.append(("not_null", spec.table, c))
        for c, values in (spec.accepted or {}).items():
            counts.append(F.count_if(where & ~col(c).isin(list(values))).alias(f"c{len(counts)}"))
            labels.append(("accepted_values", spec.table, c))
    totals = df.agg(*counts)
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(k).alias("check"), F.lit(t).alias("table_name"), F.lit(c).alias("column_name"),
                    F.col(f"c{i}").cast("long").alias("failures"),
                )
                for i, (k, t, c) in enumerate(labels)
            ]
        )
    )
    return totals.select(rows.alias("r")).select("r.check", "r.table_name", "r.column_name", "r.failures")


def column_checks(
    df: DataFrame,
    table: str,
    not_null: Sequence[str] = (),
    accepted: dict[str, Sequence] | None = None,
) -> DataFrame:
    """Row-level checks of one table in a single pass (see ``row_checks``)."""
    return row_checks(df, RowChecks(table, tuple(not_null), accepted))


def union_reports(*reports: DataFrame) -> DataFrame:
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


def assert_passes(report: DataFrame) -> None:
    """Raise if any check of ``report`` has failures (the gate before history); the
    message lists every failing check (a report has one row per check)."""
    bad = report.filter(F.col("failures") > 0).orderBy("table_name", "column_name", "check").collect()
    if bad:
        listed = ", ".join(f"{r['check']} {r['table_name']}.{r['column_name']} ({r['failures']})" for r in bad)
        raise AssertionError(f"data-quality checks failed: {listed}")
