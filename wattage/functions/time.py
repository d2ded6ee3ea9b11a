"""Column expressions for hourly readings. All are built-in Spark functions, so
they stay inside whole-stage codegen; none of them needs a UDF."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_start(c: str | Column) -> Column:
    """Midnight of the reading's day, kept as ``timestamp_ntz``.

    ``date_trunc`` returns a zoned timestamp even for NTZ input; with the
    session zone at UTC the cast back is exact.
    """
    return F.date_trunc("DAY", _c(c)).cast("timestamp_ntz")


def hour_start(c: str | Column) -> Column:
    return F.date_trunc("HOUR", _c(c)).cast("timestamp_ntz")


def day_of_week0(c: str | Column) -> Column:
    """Day of week with Sunday = 0 ... Saturday = 6."""
    return (F.dayofweek(_c(c)) - 1).cast("int")


def date_key(c: str | Column) -> Column:
    """Calendar key ``yyyyMMdd`` as an int."""
    return F.date_format(_c(c), "yyyyMMdd").cast("int")


def parse_period(c: str | Column) -> Column:
    """Parse a service period (``2024-01-05T07`` or ``2024-01-05``) into ``timestamp_ntz``.

    An hourly period is rewritten ``date hh:00:00``; any other text is cast as it
    is; text that is no timestamp becomes NULL instead of failing the batch.
    """
    text = _c(c)
    hourly = F.regexp_replace(text, r"^(\d{4}-\d{2}-\d{2})T(\d{1,2})$", "$1 $2:00:00")
    return hourly.try_cast("timestamp_ntz")


def model_version(run: dt.datetime | dt.date) -> Column:
    """Version label of a model trained at ``run`` (``yyyyMMdd_HHmmss``)."""
    return F.date_format(ts_literal(run), "yyyyMMdd_HHmmss")


def ts_literal(value: dt.datetime | dt.date | str) -> Column:
    """A ``timestamp_ntz`` literal (never the wall clock: runs stay repeatable)."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    elif isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def utc_now() -> dt.datetime:
    """The present in UTC, the session's zone, without a zone."""
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)


def date_literal(value: dt.date | str) -> Column:
    if isinstance(value, dt.datetime):
        value = value.date()
    if isinstance(value, dt.date):
        value = value.isoformat()
    return F.lit(value).cast("date")
