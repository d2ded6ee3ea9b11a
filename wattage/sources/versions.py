"""Versions of the marts: a folder per build, and one pointer that says what is current.

Under ``<warehouse>/marts/<table>/build=<id>`` every build writes what it made: a full
build all rows, a refresh the rows of the days it touched. No file is ever replaced.
``<warehouse>/versions/<number>.json`` is the pointer of a version. It names, for every run
of days, the build that holds them, and for every undivided table its build. It is written
last, whole, in one rename; readers take the highest number they can parse and read only
what it names. So a build that stops at any point leaves readers on the version before it,
and all tables change together.

The pointer holds one entry for each run of days with one build: its size follows the
calendar, not the data. Builds that neither the current nor the previous version names
are removed after the switch; a reader that began on the previous version can finish.
One job writes at a time (as the scheduler runs them); a second that would publish the
same number stops instead.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import files

BUILD = "build"


@dataclass(frozen=True)
class Table:
    """Where a table's rows are: ``by`` is its day column (None: undivided, all in ``build``)."""

    schema: str
    by: str | None
    build: str | None
    rows: int | None = None  # counted where readers compare it


@dataclass(frozen=True)
class Version:
    number: int
    as_of: str
    days: tuple[tuple[str, str, str], ...]  # first day, last day, build; disjoint, ascending
    tables: dict[str, Table] = field(default_factory=dict)
    consumed: tuple[str, ...] = ()  # journal entries that this version took in

    def builds(self) -> list[str]:
        """Builds that hold live days."""
        return sorted({b for _, _, b in self.days})


def _pointers(warehouse: str) -> str:
    return f"{warehouse.rstrip('/')}/versions"


def table_root(warehouse: str, name: str) -> str:
    return f"{warehouse.rstrip('/')}/marts/{name}"


def _parse(text: str) -> Version | None:
    """A pointer's contents; None if it is torn."""
    try:
        raw = json.loads(text)
        tables = {n: Table(**t) for n, t in raw["tables"].items()}
        return Version(raw["number"], raw["as_of"], tuple(tuple(d) for d in raw["days"]), tables, tuple(raw["consumed"]))
    except (ValueError, KeyError, TypeError):
        return None


def numbers(spark: SparkSession, warehouse: str) -> list[int]:
    """Numbers of the pointers that exist, ascending."""
    names = files.names(spark, _pointers(warehouse))
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit())


def _read(spark: SparkSession, warehouse: str, number: int) -> Version | None:
    return _parse(files.read_text(spark, f"{_pointers(warehouse)}/{number:09d}.json"))


def current(spark: SparkSession, warehouse: str) -> Version | None:
    """The version readers use: the highest-numbered pointer that is whole."""
    for number in reversed(numbers(spark, warehouse)):
        version = _read(spark, warehouse, number)
        if version is not None:
            return version
    return None


def day_runs(owners: dict[dt.date, str]) -> tuple[tuple[str, str, str], ...]:
    """(first, last, build) for runs of consecutive days of one build."""
    runs: list[list] = []
    for day in sorted(owners):
        if runs and runs[-1][2] == owners[day] and runs[-1][1] + dt.timedelta(days=1) == day:
            runs[-1][1] = day
        else:
            runs.append([day, day, owners[day]])
    return tuple((a.isoformat(), b.isoformat(), c) for a, b, c in runs)


def owners(version: Version | None) -> dict[dt.date, str]:
    """The build of every live day."""
    out: dict[dt.date, str] = {}
    for first, last, build in version.days if version else ():
        day, end = dt.date.fromisoformat(first), dt.date.fromisoformat(last)
        while day <= end:
            out[day] = build
            day += dt.timedelta(days=1)
    return out


def _day_value(day: dt.date, kind: T.DataType):
    return int(day.strftime("%Y%m%d")) if isinstance(kind, T.IntegerType) else day


def read_table(
    spark: SparkSession, warehouse: str, name: str, version: Version | None = None,
    since: dt.date | None = None, until: dt.date | None = None, with_build: bool = False,
) -> DataFrame:
    """A mart as the given (by default the current) version has it.

    ``since`` and ``until`` (inclusive) leave out other days' folders. ``with_build``
    adds the build of each row.
    """
    version = version or current(spark, warehouse)
    if version is None or name not in version.tables:
        raise FileNotFoundError(f"no version of {name} under {warehouse}")
    table, root = version.tables[name], table_root(warehouse, name)
    schema = T.StructType.fromJson(json.loads(table.schema))
    if table.by is None:
        rows = spark.read.schema(schema).parquet(f"{root}/{BUILD}={table.build}")
        return rows.withColumn(BUILD, F.lit(table.build)) if with_build else rows
    live = {d: b for d, b in owners(version).items() if (since is None or d >= since) and (until is None or d <= until)}
    builds = sorted(set(live.values()))
    stored = T.StructType([*schema.fields, T.StructField(BUILD, T.StringType())])
    names = stored.names if with_build else schema.names
    if not builds:
        return spark.createDataFrame([], stored).select(*names)
    rows = spark.read.schema(stored).option("basePath", root).parquet(*[f"{root}/{BUILD}={b}" for b in builds])
    kind = schema[table.by].dataType
    if since is not None:
        rows = rows.filter(F.col(table.by) >= F.lit(_day_value(since, kind)))
    if until is not None:
        rows = rows.filter(F.col(table.by) <= F.lit(_day_value(until, kind)))
    if len(builds) > 1 or since is not None or until is not None:
        # A row per live day (a bound set by the calendar); a build's replaced days find no partner.
        pairs = spark.createDataFrame([(b, _day_value(d, kind)) for d, b in live.items()], T.StructType([stored[BUILD], T.StructField(table.by, kind)]))
        rows = rows.join(F.broadcast(pairs), [BUILD, table.by], "left_semi")
    return rows.select(*names)


class Build:
    """A version in the making: write its tables, then ``publish``. Until then no reader sees any of it.

    As a context it removes what it wrote if it ends with an error."""

    def __init__(self, spark: SparkSession, warehouse: str, as_of: dt.datetime) -> None:
        self.spark, self.warehouse, self.as_of = spark, warehouse, as_of
        self.base = current(spark, warehouse)
        taken = numbers(spark, warehouse)
        self.number = (taken[-1] if taken else 0) + 1
        self.id = f"{self.number:09d}-{uuid.uuid4().hex[:8]}"
        self.tables: dict[str, Table] = {}

    def __enter__(self) -> Build:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is not None and self.number not in numbers(self.spark, self.warehouse):
            for name in files.names(self.spark, f"{self.warehouse.rstrip('/')}/marts"):
                files.remove(self.spark, f"{table_root(self.warehouse, name)}/{BUILD}={self.id}")

    def write(self, df: DataFrame, name: str, by: str | None = None, counted: bool = False) -> DataFrame:
        """Store a table (or, divided by day, the days this build touches); returns the stored rows.

        The rows of a ``counted`` table are counted, from the footers of what was written."""
        path = f"{table_root(self.warehouse, name)}/{BUILD}={self.id}"
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(by) if by else writer).parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        self.tables[name] = Table(json.dumps(df.schema.jsonValue()), by, None if by else self.id, stored.count() if counted else None)
        return stored

    def publish(self, touched: Sequence[dt.date] | None, consumed: Sequence[str] = ()) -> Version:
        """Switch readers to this build.

        ``touched`` are the days this build holds, in place of the base version's; None says
        it holds all there are. Tables not written keep the base version's place.
        """
        if touched is None:
            live = {d: self.id for d in self._days()}
            tables = dict(self.tables)
        else:
            live = owners(self.base) | {d: self.id for d in touched}
            tables = dict(self.base.tables)
            for name, t in self.tables.items():
                rows, old = t.rows, tables.get(name)
                if t.by and rows is not None and old is not None:
                    rows += old.rows - self._rows_on(name, touched)
                tables[name] = Table(t.schema, t.by, t.build, rows)
        version = Version(self.number, self.as_of.isoformat(), day_runs(live), tables, tuple(consumed))
        body = {
            "number": version.number, "as_of": version.as_of, "days": version.days,
            "tables": {n: vars(t) for n, t in version.tables.items()}, "consumed": version.consumed,
        }
        files.write_once(self.spark, f"{_pointers(self.warehouse)}/{version.number:09d}.json", json.dumps(body))
        return version

    def _days(self) -> list[dt.date]:
        """All days for which this build wrote a folder."""
        out = set()
        for name, t in self.tables.items():
            if t.by:
                for folder in files.names(self.spark, f"{table_root(self.warehouse, name)}/{BUILD}={self.id}"):
                    if (day := _folder_day(folder)) is not None:
                        out.add(day)
        return sorted(out)

    def _rows_on(self, name: str, days: Sequence[dt.date]) -> int:
        """Rows of the base version on ``days``."""
        table = self.base.tables[name]
        kind = T.StructType.fromJson(json.loads(table.schema))[table.by].dataType
        wanted = self.spark.createDataFrame([(_day_value(d, kind),) for d in days], T.StructType([T.StructField(table.by, kind)]))
        stored = read_table(self.spark, self.warehouse, name, self.base, min(days), max(days))
        return stored.join(F.broadcast(wanted), table.by, "left_semi").count()


def _folder_day(folder: str) -> dt.date | None:
    """The day of a folder ``column=2024-01-31`` or ``column=20240131``."""
    value = folder.partition("=")[2].replace("-", "")
    return dt.datetime.strptime(value, "%Y%m%d").date() if len(value) == 8 and value.isdigit() else None


def clean_up(spark: SparkSession, warehouse: str) -> None:
    """Remove what neither the current nor the previous version names (also what stopped builds left)."""
    kept = [v for n in reversed(numbers(spark, warehouse)) if (v := _read(spark, warehouse, n)) is not None][:2]
    if not kept:
        return
    for number in numbers(spark, warehouse):
        if number < kept[-1].number:
            files.remove(spark, f"{_pointers(warehouse)}/{number:09d}.json")
    maps = [(v, owners(v)) for v in kept]
    for name in files.names(spark, f"{warehouse.rstrip('/')}/marts"):
        root = table_root(warehouse, name)
        for folder in files.names(spark, root):
            build = folder.partition("=")[2]
            if any(name in v.tables and v.tables[name].by is None and v.tables[name].build == build for v, _ in maps):
                continue
            days = {d for v, m in maps for d, b in m.items() if b == build and name in v.tables and v.tables[name].by}
            if not days:
                files.remove(spark, f"{root}/{folder}")
                continue
            for inner in files.names(spark, f"{root}/{folder}"):
                day = _folder_day(inner)
                if day is not None and day not in days:
                    files.remove(spark, f"{root}/{folder}/{inner}")
