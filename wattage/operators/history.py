"""Type-2 history (slowly changing dimension) with the compare-columns strategy."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import ts_literal
from .dims import region_type

def region_history_input(raw: DataFrame, as_of: dt.datetime, label_from_code: bool = False) -> DataFrame:
    """Regions seen in the raw readings: code, newest name, type, stamp; one row per code.

    ``raw`` has ``period_date``, or ``period_day`` where it is a table of (day, code,
    name); the newest name is that of the latest day (then the largest name), so a
    rename arrives although the old name stays in the readings.

    The reference labels every region ``Regional`` here (unlike the dimension);
    ``label_from_code`` applies the dimension's National/Regional rule instead.
    """
    when = "period_day" if "period_day" in raw.columns else "period_date"
    newest = F.max(F.struct(F.to_date(when).alias("day"), "respondent_name")).alias("newest")
    pairs = raw.filter(F.col("respondent").isNotNull()).groupBy("respondent").agg(newest)
    pairs = pairs.select("respondent", F.col("newest.respondent_name").alias("respondent_name"))
    kind = region_type() if label_from_code else F.lit("Regional")
    return pairs.select("respondent", "respondent_name", kind.alias("region_type"), ts_literal(as_of).alias("created_at"))


def scd2(
    history: DataFrame | None,
    current: DataFrame,
    key: str | Sequence[str],
    check_cols: Sequence[str] | str | None = None,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """New type-2 history after comparing ``current`` with the open history rows.

    unchanged key -> open row kept; changed -> old row closed at ``as_of`` and a new
    row opened; new key -> opened; key missing from ``current`` -> stays open.
    ``check_cols`` defaults to every non-key column except ``created_at`` (a
    stamp differs on each run); ``"all"`` compares every non-key column, stamp
    included, which makes each run a change as in the reference. ``current`` must
    hold each key once: a key with two states at once has no history.
    """
    keys = [key] if isinstance(key, str) else list(key)
    repeated = current.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(5).collect()
    if repeated:
        raise ValueError(f"keys with several current rows, e.g. {[tuple(r)[:-1] for r in repeated]}")
    data_cols = [c for c in current.columns if c not in keys]
    if check_cols is None:
        check = [c for c in data_cols if c != "created_at"]
    elif check_cols == "all":
        check = data_cols
    else:
        check = list(check_cols)
    stamp = ts_literal(as_of)
    opened_now = current.select(*current.columns, stamp.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.lit(True).alias("is_current"))
    if history is None:
        return opened_now

    closed_before = history.filter(F.col("valid_to").isNotNull())
    open_rows = history.filter(F.col("valid_to").isNull())
    h = open_rows.select(*[F.col(c).alias(f"h__{c}") for c in open_rows.columns], F.lit(True).alias("_in_h"))
    s = current.select(*[F.col(c).alias(f"s__{c}") for c in current.columns], F.lit(True).alias("_in_s"))
    j = h.join(s, [F.col(f"h__{k}") == F.col(f"s__{k}") for k in keys], "full_outer")
    same = F.lit(True)
    for c in check:
        same = same & F.col(f"h__{c}").eqNullSafe(F.col(f"s__{c}"))
    both = F.col("_in_h").isNotNull() & F.col("_in_s").isNotNull()
    state = (
        F.when(F.col("_in_s").isNull(), F.lit("missing"))
        .when(F.col("_in_h").isNull(), F.lit("new"))
        .when(both & same, F.lit("same"))
        .otherwise(F.lit("changed"))
    )
    hist_cols = history.columns
    types = {f.name: f.dataType for f in history.schema.fields}

    def row(pick) -> F.Column:
        return F.struct(*[pick(c).cast(types[c]).alias(c) for c in hist_cols])

    kept = row(lambda c: F.col(f"h__{c}"))
    closed = row(lambda c: stamp if c == "valid_to" else F.lit(False) if c == "is_current" else F.col(f"h__{c}"))
    opened_cols = {"valid_from": stamp, "valid_to": F.lit(None), "is_current": F.lit(True)}
    opened = row(lambda c: opened_cols[c] if c in opened_cols else F.col(f"s__{c}"))
    # One pass over the join: a changed key yields its closed and its new row.
    out = j.select(
        F.explode(
            F.when(state.isin("same", "missing"), F.array(kept))
            .when(state == "changed", F.array(closed, opened))
            .otherwise(F.array(opened))
        ).alias("_r")
    ).select("_r.*")
    return closed_before.unionByName(out)


def as_of_view(history: DataFrame, ts: dt.datetime) -> DataFrame:
    """History rows valid at ``ts``: valid_from <= ts < valid_to (open rows: no end)."""
    t = ts_literal(ts)
    return history.filter((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t)))
