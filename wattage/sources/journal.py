"""Journal of changed days: what loads and streams touched and the marts have not taken in.

An entry is one JSON file, ``<warehouse>/journal/<id>~<attempt>.json``, named by the load's
unique id: it holds the days and is written before the merge into the raw table. The mark
``<id>~<attempt>.merged`` beside it says that the merge is complete. A refresh works on the
days of all entries, but consumes (moves to ``journal/consumed``) only those that were
complete before it read the raw table, once its version is published. So a load that runs
while a refresh runs, or stops between its two marks, is taken in again by the next refresh;
nothing is lost by doing a day twice.

Ids are never shared by two loads: a batch load draws one, a stream's micro-batch has its
query's id and its batch number. A replayed micro-batch makes a new attempt, also when the
first was consumed, and takes the place of one that was not. A load touches at most as many
days as the calendar has.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import SparkSession

from . import files


class Entry(NamedTuple):
    name: str
    as_of: str
    days: tuple[dt.date, ...]
    merged: bool


def _folder(warehouse: str) -> str:
    return f"{warehouse.rstrip('/')}/journal"


def new_id(as_of: dt.datetime) -> str:
    """An id of a batch load; the stamp is for the eye only."""
    return f"load-{as_of.strftime('%Y%m%dT%H%M%S')}-{uuid.uuid4().hex}"


def open_entry(spark: SparkSession, warehouse: str, id: str, days: Iterable[dt.date], as_of: dt.datetime) -> str:
    """Record the days of a load that is about to merge; returns the entry's name."""
    folder, name = _folder(warehouse), f"{id}~{uuid.uuid4().hex[:12]}"
    body = {"as_of": as_of.isoformat(), "days": sorted(d.isoformat() for d in days)}
    files.write_once(spark, f"{folder}/{name}.json", json.dumps(body))
    for other in files.names(spark, folder):  # attempts that this one repeats
        if other.startswith(f"{id}~") and not other.startswith(name):
            files.remove(spark, f"{folder}/{other}")
    return name


def close_entry(spark: SparkSession, warehouse: str, name: str) -> None:
    """Record that the load's merge is complete."""
    files.write_once(spark, f"{_folder(warehouse)}/{name}.merged", "")


def pending(spark: SparkSession, warehouse: str) -> list[Entry]:
    """Entries that no version has taken in."""
    folder = _folder(warehouse)
    found = set(files.names(spark, folder))
    out = []
    for file in sorted(found):
        if file.endswith(".json"):
            name = file.removesuffix(".json")
            raw = json.loads(files.read_text(spark, f"{folder}/{file}"))
            out.append(Entry(name, raw["as_of"], tuple(map(dt.date.fromisoformat, raw["days"])), f"{name}.merged" in found))
    return out


def consume(spark: SparkSession, warehouse: str, names: Iterable[str]) -> None:
    """Mark entries as taken in; repeating it changes nothing."""
    folder = _folder(warehouse)
    for name in names:
        if not files.exists(spark, f"{folder}/{name}.json"):
            continue
        if not files.exists(spark, f"{folder}/consumed/{name}.json"):
            files.write_once(spark, f"{folder}/consumed/{name}.json", files.read_text(spark, f"{folder}/{name}.json"))
        files.remove(spark, f"{folder}/{name}.json")
        files.remove(spark, f"{folder}/{name}.merged")
