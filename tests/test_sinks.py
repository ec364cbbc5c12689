from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import ts
from spokeline import files as folders
from spokeline import schemas
from spokeline.operators import quality, staging
from spokeline.sinks import tables as sinks
from spokeline.sources import tables

WINDOW = (date(2024, 3, 1), date(2024, 4, 1))


def on(*days, ride="R"):
    return [
        {"ride_id": f"{ride}{d}", "started_at": ts(f"{d} 08:00:00"), "ended_at": ts(f"{d} 09:00:00")}
        for d in days
    ]


def stored(spark, path, table=schemas.RAW):
    return sorted(r.ride_id for r in tables.read(spark, path, table).collect())


def test_replacing_a_window_twice_changes_nothing(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    rows = raw(*on("2024-03-01", "2024-03-02", "2024-04-02"))
    for _ in range(2):
        assert sinks.replace_window(rows, path, schemas.RAW, WINDOW) == 2
        assert stored(spark, path) == ["R2024-03-01", "R2024-03-02"]


def test_a_day_that_became_empty_disappears_and_others_stay(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    sinks.replace(raw(*on("2024-02-29", "2024-03-01", "2024-03-02", "2024-04-01")), path, schemas.RAW)
    sinks.replace_window(raw(*on("2024-03-02", ride="N")), path, schemas.RAW, WINDOW)
    assert stored(spark, path) == ["N2024-03-02", "R2024-02-29", "R2024-04-01"]


def test_an_empty_window_is_refused(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    sinks.replace(raw(*on("2024-03-01")), path, schemas.RAW)
    for nothing in (raw(*on("2024-05-01")), raw({}).where("false")):
        with pytest.raises(sinks.EmptyWindowError):
            sinks.replace_window(nothing, path, schemas.RAW, WINDOW)
        assert stored(spark, path) == ["R2024-03-01"]
    assert sinks.replace_window(raw({}).where("false"), path, schemas.RAW, WINDOW, allow_empty=True) == 0
    assert sinks.stored_keys(spark, path, "started_date") == []


def test_replace_by_key_leaves_days_without_new_rows(spark, raw, tmp_path):
    path = str(tmp_path / "staging")
    clean = lambda rows: staging.clean(rows, date(2024, 4, 1), date(2024, 4, 1))
    sinks.replace_by_key(clean(raw(*on("2024-03-01", "2024-03-02"))), path, schemas.STAGING)
    sinks.replace_by_key(clean(raw(*on("2024-03-02", ride="N"))), path, schemas.STAGING)
    assert stored(spark, path, schemas.STAGING) == ["N2024-03-02", "R2024-03-01"]
    sinks.replace(clean(raw(*on("2024-03-02", ride="F"))), path, schemas.STAGING)
    assert stored(spark, path, schemas.STAGING) == ["F2024-03-02"]


def test_a_hot_day_is_written_by_several_tasks(spark, raw, tmp_path):
    """Most rows on one day: the rebalance splits it instead of giving it to one task."""
    path = str(tmp_path / "raw")
    many = spark.range(0, 400_000, 1, 8)
    one = raw(*on("2024-03-01"))
    hot = many.join(F.broadcast(one)).withColumn(
        "ride_id", F.sha2(F.col("id").cast("string"), 256)
    ).drop("id")
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "2m")
    try:
        sinks.replace(hot.unionByName(raw(*on("2024-03-02"))), path, schemas.RAW)
    finally:
        spark.conf.set(advisory, before)
    path = tables.current(spark, path)
    files = list(Path(path, "started_date=2024-03-01").glob("*.parquet"))
    assert len(files) > 3
    assert len(list(Path(path, "started_date=2024-03-02").glob("*.parquet"))) == 1
    assert tables.read(spark, path, schemas.RAW).count() == 400_001


def test_rows_are_sorted_inside_files(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    rows = [r | {"member_casual": w} for w in ("member", "casual", "member") for r in on("2024-03-01")]
    sinks.replace(raw(*rows), path, schemas.RAW)
    assert [r.member_casual for r in tables.read(spark, path, schemas.RAW).collect()] == [
        "casual", "member", "member",
    ]


def test_reports_are_read_in_order_or_empty_when_absent(spark, tmp_path):
    path = str(tmp_path / "weekly")
    assert tables.load_weekly(spark, path).collect() == []
    rows = [(d, "", "member", "classic_bike", 1, 1.0, 1.0, 1.0, 1, 1) for d in (3, 1, 2)]
    sinks.replace(spark.createDataFrame(rows, schemas.WEEKLY.struct), path, schemas.WEEKLY)
    report = tables.load_weekly(spark, path)
    assert [r.day_of_week for r in report.collect()] == [1, 2, 3]
    assert "unique_start_stations" not in report.columns


def test_a_month_without_rows_keeps_its_stored_days(spark, raw, tmp_path):
    path, window = str(tmp_path / "raw"), (date(2024, 2, 1), date(2024, 4, 1))
    sinks.replace_window(raw(*on("2024-02-10", "2024-03-01")), path, schemas.RAW, window)
    with pytest.raises(sinks.EmptyWindowError, match="2024-02"):
        sinks.replace_window(raw(*on("2024-03-05", ride="N")), path, schemas.RAW, window)
    assert {"R2024-02-10", "N2024-03-05"} <= set(stored(spark, path))
    sinks.replace_window(raw(*on("2024-03-05", ride="N")), path, schemas.RAW, window, allow_empty=True)
    assert stored(spark, path) == ["N2024-03-05"]


FAILS = "cast(raise_error('lost') as string)"


@pytest.mark.parametrize("write", ["replace", "replace_by_key", "replace_window"])
def test_a_failed_write_leaves_the_table(spark, raw, tmp_path, write):
    path = str(tmp_path / "raw")
    sinks.replace(raw(*on("2024-03-01", "2024-03-02")), path, schemas.RAW)
    bad = raw(*on("2024-03-02", ride="N")).withColumn("ride_id", F.expr(FAILS))
    more = (WINDOW,) if write == "replace_window" else ()
    with pytest.raises(Exception, match="lost"):
        getattr(sinks, write)(bad, path, schemas.RAW, *more)
    assert stored(spark, path) == ["R2024-03-01", "R2024-03-02"]


def test_a_failed_write_leaves_a_table_without_folders(spark, tmp_path):
    path = str(tmp_path / "weekly")
    rows = spark.createDataFrame([(1, "", "member", "classic_bike", 1, 1.0, 1.0, 1.0, 1, 1)], schemas.WEEKLY.struct)
    sinks.replace(rows, path, schemas.WEEKLY)
    with pytest.raises(Exception, match="lost"):
        sinks.replace(rows.withColumn("weekday_name", F.expr(FAILS)), path, schemas.WEEKLY)
    assert tables.read(spark, path, schemas.WEEKLY).count() == 1
    sinks.replace(rows.unionByName(rows), path, schemas.WEEKLY)
    assert tables.read(spark, path, schemas.WEEKLY).count() == 2
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["weekly"]


def test_replacing_by_nothing_empties_the_table(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    sinks.replace(raw(*on("2024-03-01")), path, schemas.RAW)
    sinks.replace(raw({}).where("false"), path, schemas.RAW)
    assert stored(spark, path) == []


def test_a_table_is_replaced_in_one_step(spark, raw, tmp_path, monkeypatch):
    """Until the switch the old rows are read, by then the new ones, and never none."""
    path = str(tmp_path / "raw")
    sinks.replace_window(raw(*on("2024-03-01")), path, schemas.RAW, WINDOW)  # not a version yet
    seen, switch = [], folders.put_text

    def watched(*args):
        seen.append(stored(spark, path))
        switch(*args)
        seen.append(stored(spark, path))

    monkeypatch.setattr(folders, "put_text", watched)
    sinks.replace(raw(*on("2024-03-02")), path, schemas.RAW)
    found_before = tables.read(spark, path, schemas.RAW)
    sinks.replace(raw(*on("2024-03-03")), path, schemas.RAW)
    assert seen == [["R2024-03-01"], ["R2024-03-02"], ["R2024-03-02"], ["R2024-03-03"]]
    # Who found the table before the switch reads on.
    assert [r.ride_id for r in found_before.collect()] == ["R2024-03-02"]
    sinks.replace_window(raw(*on("2024-03-04")), path, schemas.RAW, WINDOW)
    assert stored(spark, path) == ["R2024-03-04"]
    assert sinks.stored_keys(spark, path, "started_date") == ["2024-03-04"]
    # The version that counts, the one before, and the file that names it.
    assert len([n for n in folders.names(spark, path) if not n.startswith(".")]) == 3


def test_a_write_that_stops_before_the_switch_changes_nothing(spark, raw, tmp_path, monkeypatch):
    path = str(tmp_path / "raw")
    sinks.replace(raw(*on("2024-03-01")), path, schemas.RAW)

    def lost(*args):
        raise OSError("lost")

    with monkeypatch.context() as m, pytest.raises(OSError, match="lost"):
        m.setattr(folders, "put_text", lost)
        sinks.replace(raw(*on("2024-03-02")), path, schemas.RAW)
    assert stored(spark, path) == ["R2024-03-01"]
    sinks.replace(raw(*on("2024-03-02")), path, schemas.RAW)
    assert stored(spark, path) == ["R2024-03-02"]
    assert len([n for n in folders.names(spark, path) if n.startswith("_version-")]) == 2


@pytest.mark.parametrize("write", ["replace", "replace_window"])
def test_checks_are_counted_by_the_tasks_that_write(spark, raw, tmp_path, write):
    rows = raw(*[{"ride_id": None if i % 3 == 0 else f"R{i}"} | on("2024-03-01")[0] for i in range(30)])
    rows = rows.withColumn("ride_id", F.when(F.rand(3) < 0.5, F.col("ride_id")))
    path, cleaned = str(tmp_path / "staging"), staging.enrich(rows).select(*schemas.STAGING.names)
    checks = quality.Watch(schemas.STAGING)
    more = (WINDOW,) if write == "replace_window" else ()
    getattr(sinks, write)(cleaned, path, schemas.STAGING, *more, counts=checks.counts, seen=checks.seen)
    afterwards = quality.check(tables.read(spark, path, schemas.STAGING), schemas.STAGING)
    assert sorted(checks.report(spark).collect()) == sorted(afterwards.collect())
