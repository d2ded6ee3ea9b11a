"""Pages, raw table writes, incremental stream, rejects."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from wattage.operators.quality import require_rows
from wattage.schemas import PAGE
from wattage.sources import pages, tables
from wattage.streaming.ingest import ingest_stream

T0 = dt.datetime(2024, 2, 1)


def _page(rows):
    return json.dumps({"response": {"total": str(len(rows)), "data": rows}})


def _reading(period, region="PJM", value="100.5", units="MWh", kind="D"):
    r = {"period": period, "respondent": region, "respondent-name": f"Name {region}", "type": kind,
         "type-name": "Demand", "value": value}
    if units is not None:
        r["value-units"] = units
    return r


def _write(path, *pages_):
    path.mkdir(parents=True, exist_ok=True)
    (path / "part.json").write_text("\n".join(pages_) + "\n")


def test_read_and_normalise_pages(spark, tmp_path):
    _write(tmp_path / "in", _page([_reading("2024-01-05T07"), _reading("2024-01-05", units=None),
                                   _reading("garbage", value="x"), _reading("2024-01-05T23", region="CISO")]))
    out = pages.normalise(pages.read_pages(spark, str(tmp_path / "in"))).collect()
    by = {(r.respondent, r.period_date): r for r in out}
    assert by[("PJM", dt.datetime(2024, 1, 5, 7))].value == 100.5
    assert by[("PJM", dt.datetime(2024, 1, 5, 0))].value_units == "MWh"
    assert by[("CISO", dt.datetime(2024, 1, 5, 23))].respondent_name == "Name CISO"
    bad = [r for r in out if r.period_date is None]
    assert len(bad) == 1 and bad[0].value is None


def test_rejects_keep_the_batch_going(spark, tmp_path):
    _write(tmp_path / "in", _page([_reading("2024-01-05T07"), _reading("nope"), _reading("2024-01-05T08", region="")]))
    good, bad = pages.split_rejects(pages.normalise(pages.read_pages(spark, str(tmp_path / "in"))))
    assert good.count() == 1
    assert sorted(r.reason for r in bad.collect()) == ["period", "respondent"]


def test_only_regions(spark, tmp_path):
    _write(tmp_path / "in", _page([_reading("2024-01-05T07", region=r) for r in ("PJM", "TEXA", "US48")]))
    df = pages.only_regions(pages.normalise(pages.read_pages(spark, str(tmp_path / "in"))))
    assert sorted(r.respondent for r in df.collect()) == ["PJM", "US48"]


def test_write_pages_bounds_page_size(spark, tmp_path):
    readings = spark.range(1234).select(
        F.lit("2024-01-05T07").alias("period"), (F.col("id") % 3).cast("string").alias("respondent"),
        F.lit("n").alias("respondent-name"), F.col("id").cast("string").alias("type"), F.lit("t").alias("type-name"),
        F.col("id").cast("string").alias("value"), F.lit("MWh").alias("value-units"),
    ).repartition(3)
    pages.write_pages(readings, str(tmp_path / "p"), page_size=100)
    raw = spark.read.schema(PAGE).json(str(tmp_path / "p"))
    sizes = [r[0] for r in raw.select(F.size("response.data")).collect()]
    assert max(sizes) <= 100 and sum(sizes) == 1234


def test_upsert_raw_twice_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "raw")
    schema = "period_date timestamp_ntz, respondent string, respondent_name string, data_type string, data_type_name string, value double, value_units string"
    first = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, h), "PJM", "P", "D", "Demand", float(h), "MWh") for h in range(24)], schema
    )
    tables.upsert_raw(spark, path, first, T0)
    assert tables.scan_raw(spark, path).count() == 24
    batch = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 5), "PJM", "P2", "D", "Demand", 99.0, "MWh"),
         (dt.datetime(2024, 1, 2, 0), "PJM", "P", "D", "Demand", 1.0, "MWh")], schema
    )
    t1 = dt.datetime(2024, 2, 2)
    tables.upsert_raw(spark, path, batch, t1)
    once = sorted(tuple(r) for r in tables.scan_raw(spark, path).collect())
    tables.upsert_raw(spark, path, batch, t1)
    twice = sorted(tuple(r) for r in tables.scan_raw(spark, path).collect())
    assert once == twice and len(once) == 25
    row = [r for r in once if r[0] == dt.datetime(2024, 1, 1, 5)][0]
    assert row[2] == "P2" and row[5] == 99.0 and row[7] == t1
    untouched = [r for r in once if r[0] == dt.datetime(2024, 1, 1, 6)][0]
    assert untouched[7] == T0


def test_one_stream_run_two_runs_and_the_batch_load_agree(spark, tmp_path):
    from wattage.plans import jobs

    first = [_page([_reading(f"2024-01-05T{h:02d}") for h in range(10)] + [_reading("bad")])]
    second = [_page([_reading(f"2024-01-05T{h:02d}", value=v) for h in range(5, 15) for v in ("200", "7")] + [_reading("2024-01-05T09", region="")]),
              '{"response": {"data": [{"period"', _page([_reading("2024-01-05T06", value="n/a")])]
    land = tmp_path / "land"
    raws, rejects = [], []
    _write(land / "a", *first)
    ingest_stream(spark, f"{land}/*", str(tmp_path / "raw2"), str(tmp_path / "ck2"), as_of=T0)
    _write(land / "b", *second)
    ingest_stream(spark, f"{land}/*", str(tmp_path / "raw2"), str(tmp_path / "ck2"), as_of=T0)
    ingest_stream(spark, f"{land}/*", str(tmp_path / "raw2"), str(tmp_path / "ck2"), as_of=T0)  # nothing new
    ingest_stream(spark, f"{land}/*", str(tmp_path / "raw1"), str(tmp_path / "ck1"), as_of=T0)
    jobs.hourly_load(spark, f"{land}/*", str(tmp_path / "wh"), T0, regions=("PJM",))
    for raw, bad in (("raw1", "raw1_rejects"), ("raw2", "raw2_rejects"), ("wh/raw_readings", "wh/rejects")):
        raws.append(sorted((r.period_date.hour, r.value) for r in tables.scan_raw(spark, str(tmp_path / raw)).collect()))
        rejects.append(sorted((r.reason, r.respondent or "", r.page or "") for r in spark.read.parquet(str(tmp_path / bad)).collect()))
    assert raws[0] == raws[1] == raws[2] and rejects[0] == rejects[1] == rejects[2]
    got = dict(raws[0])
    assert len(got) == 15 and got[3] == 100.5 and got[7] == 7.0 and got[14] == 7.0 and got[6] is None
    assert [r[0] for r in rejects[0]] == ["page", "period", "respondent"]
    # a replayed batch (a new checkpoint numbers it as before) adds no reject
    ingest_stream(spark, f"{land}/*", str(tmp_path / "raw1"), str(tmp_path / "ck3"), as_of=T0)
    assert spark.read.parquet(str(tmp_path / "raw1_rejects")).count() == 3


def test_pages_that_span_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "page.json").write_text(json.dumps(json.loads(_page([_reading("2024-01-05T07")])), indent=1))
    good, bad = pages.split_rejects(pages.normalise(pages.read_pages(spark, str(tmp_path / "in")), landing=True))
    assert good.count() == 0 and {r.reason for r in bad.collect()} == {"page"}  # told, not lost
    good, bad = pages.split_rejects(pages.normalise(pages.read_pages(spark, str(tmp_path / "in"), multi_line=True), landing=True))
    assert good.count() == 1 and bad.count() == 0


def test_a_failed_rename_keeps_the_old_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.materialise(spark.range(3), path)
    real = tables._fs

    class Refusing:
        def __init__(self, fs, allow):
            self.fs, self.allow = fs, allow

        def rename(self, a, b):
            self.allow -= 1
            return self.fs.rename(a, b) if self.allow >= 0 else False

        def __getattr__(self, name):
            return getattr(self.fs, name)

    for allow in (0, 1):
        def refusing(s, p, allow=allow):
            fs, q = real(s, p)
            return (Refusing(fs, allow) if p == path else fs), q

        monkeypatch.setattr(tables, "_fs", refusing)
        with pytest.raises(OSError):
            tables.stage_and_replace(spark.range(9), path)
        monkeypatch.setattr(tables, "_fs", real)
        assert tables.restore_table(spark, path) and spark.read.parquet(path).count() == 3
    import os

    assert os.listdir(tmp_path) == ["t"]


def test_require_rows(spark):
    with pytest.raises(ValueError):
        require_rows(spark.range(0), "empty")
    assert require_rows(spark.range(3), "x").count() == 3


def test_stage_and_replace_swaps_and_recovers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    t = spark.read.parquet(path)
    tables.stage_and_replace(t.union(spark.range(3, 5)), path)  # reads its own target
    assert spark.read.parquet(path).count() == 5
    # a run that stopped between the two renames: only the previous copy is left
    import os

    os.rename(path, path + "__previous")
    assert tables.restore_table(spark, path)
    assert spark.read.parquet(path).count() == 5
    leftovers = [p for p in os.listdir(tmp_path) if p != "t"]
    assert leftovers == []


def test_stream_writes_rejects(spark, tmp_path):
    land, raw, ck, rej = tmp_path / "land", str(tmp_path / "raw"), str(tmp_path / "ck"), str(tmp_path / "rej")
    _write(land / "a", _page([_reading("2024-01-05T01"), _reading("n/a"), _reading("2024-01-05T02", kind="")]))
    ingest_stream(spark, str(land) + "/*", raw, ck, as_of=T0, rejects_path=rej)
    assert tables.scan_raw(spark, raw).count() == 1
    assert sorted(r.reason for r in spark.read.parquet(rej).collect()) == ["data_type", "period"]


def test_full_rebuild_drops_stale_day_folders(spark, tmp_path):
    path = str(tmp_path / "fct")
    tables.materialise(spark.createDataFrame([(1, 20240101), (2, 20240102)], "v int, date_key int"), path, "date_key")
    out = tables.materialise(spark.createDataFrame([(3, 20240102)], "v int, date_key int"), path, "date_key")
    assert sorted(tuple(r) for r in out.collect()) == [(3, 20240102)]
