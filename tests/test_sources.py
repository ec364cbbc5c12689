import re
import zipfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from spokeline import schemas
from spokeline.operators import drift, quality
from spokeline.plans import refresh
from spokeline.sources import trip_archive, trip_files

HEADER = ",".join(schemas.TRIPS.names)


def line(ride="R1", started="2024-01-05 08:00:00.123", name="A", lat="40.7"):
    return f"{ride},classic_bike,{started},2024-01-05 09:00:00,{name},1,B,2,{lat},-74.0,40.71,-74.01,member"


def text(*lines):
    return "\n".join((HEADER, *lines)) + "\n"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "202401-trips_1.csv").write_text(text(line("a"), line("b", "not a time")))
    (tmp_path / "sub" / "202401-trips_2.csv").write_text(text(line("c", name='"Say ""hi"", A"')))
    (tmp_path / "202402-trips.csv").write_text(text(line("d", name='""'), line("e", name="")))
    (tmp_path / "notes.txt").write_text("no trips")
    return tmp_path


def test_all_csv_files_are_one_scan(spark, folder):
    rows = {r.ride_id: r for r in trip_files.read_csv(spark, str(folder)).collect()}
    assert sorted(rows) == ["a", "b", "c", "d", "e"]
    assert rows["a"].started_at == datetime(2024, 1, 5, 8, 0, 0, 123000)
    assert rows["b"].started_at is None and rows["b"].ended_at is not None
    assert rows["c"].start_station_name == 'Say "hi", A'
    assert (rows["d"].start_station_name, rows["e"].start_station_name) == ("", None)
    assert (rows["c"].file_month, rows["d"].file_month) == ("202401", "202402")


def test_months_pick_files_and_must_all_be_there(spark, folder):
    picked = trip_files.read_csv(spark, str(folder), ["202402"])
    assert sorted(r.ride_id for r in picked.collect()) == ["d", "e"]
    with pytest.raises(FileNotFoundError, match="202403"):
        trip_files.read_csv(spark, str(folder), ["202402", "202403"])


def test_a_folder_without_csv_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        trip_files.read_csv(spark, str(tmp_path))


def test_a_bad_number_stops_the_load_unless_allowed(spark, tmp_path):
    (tmp_path / "202401.csv").write_text(text(line("a"), line("b", lat="north")))
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        trip_files.read_csv(spark, str(tmp_path)).collect()
    lax = trip_files.read_csv(spark, str(tmp_path), bad_rows="PERMISSIVE").collect()
    assert [r.start_lat for r in lax] == [40.7, None]


def test_line_breaks_in_quotes_need_multi_line(spark, tmp_path):
    (tmp_path / "202401.csv").write_text(text(line("a", name='"two\nlines"'), line("b")))
    rows = trip_files.read_csv(spark, str(tmp_path), multi_line=True).collect()
    assert [(r.ride_id, r.start_station_name) for r in rows] == [("a", "two\nlines"), ("b", "A")]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        trip_files.read_csv(spark, str(tmp_path)).collect()


@pytest.fixture
def archives(tmp_path):
    with zipfile.ZipFile(tmp_path / "202401-trips.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("202401_1.csv", text(line("a"), line("b", "not a time", name='"two\nlines"')))
        z.writestr("deep/202401_2.csv", text(line("c", name='""'), line("d", name="")))
        z.writestr("empty.csv", HEADER + "\n")
        for unsafe in ("../evil.csv", "/abs.csv", ".hidden.csv", "__MACOSX/._202401_1.csv", "x/../y.csv"):
            z.writestr(unsafe, text(line("evil")))
        z.writestr("readme.txt", "no trips")
    with zipfile.ZipFile(tmp_path / "202402-trips.zip", "w") as z:
        z.writestr("202402.csv", text(*[line(f"x{i}") for i in range(5000)]))
    return tmp_path


def test_archive_members_are_read_and_unsafe_ones_skipped(spark, archives):
    df = trip_files.read_archives(spark, str(archives), ["202401"])
    rows = {r.ride_id: r for r in df.collect()}
    assert sorted(rows) == ["a", "b", "c", "d"]
    assert rows["a"].started_at == datetime(2024, 1, 5, 8, 0, 0, 123000)
    assert rows["b"].started_at is None and rows["b"].start_station_name == "two\nlines"
    assert (rows["c"].start_station_name, rows["d"].start_station_name) == ("", None)
    assert {r.file_month for r in rows.values()} == {"202401"}


def test_each_member_is_a_task(spark, archives):
    df = trip_files.read_archives(spark, str(archives))
    assert df.rdd.getNumPartitions() == 4
    assert df.count() == 5004


def test_archives_of_a_missing_month(spark, archives):
    with pytest.raises(Exception, match="no archived CSV files"):
        trip_files.read_archives(spark, str(archives), ["202401", "202405"]).collect()


def test_a_bad_number_in_an_archive_stops_the_load(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "202401.zip", "w") as z:
        z.writestr("202401.csv", text(line("b", lat="north")))
    with pytest.raises(Exception, match="north"):
        trip_files.read_archives(spark, str(tmp_path)).collect()


@pytest.mark.parametrize(
    "name, safe",
    [("a.csv", True), ("a/b.csv", True), ("a/../b.csv", False), ("C:/a.csv", False),
     ("\\\\host\\a.csv", False), ("a.CSV.txt", False), ("a..csv", True)],
)
def test_member_names(name, safe):
    assert trip_archive.is_trip_member(name) == safe


def test_archives_and_csv_land_the_same_rows(spark, folder, archives, tmp_path):
    once = trip_files.read_csv(spark, str(folder), ["202401"])
    landing = str(tmp_path / "landing")
    refresh.land(once, landing)
    refresh.land(once, landing)  # the month is replaced, not doubled
    landed = trip_files.read_landed(spark, landing)
    assert sorted(r.ride_id for r in landed.collect()) == ["a", "b", "c"]
    assert landed.columns == schemas.TRIPS.names


def test_landed_files_are_picked_by_name(spark, trips, tmp_path):
    for name in ("202401-01-tripdata.parquet", "other.parquet"):
        trips({"ride_id": name}).coalesce(1).write.parquet(str(tmp_path / "out" / name))
    landed = trip_files.read_landed(spark, str(tmp_path / "out"))
    assert landed.count() == 2


def run_files(folder):
    days = {"202401": ("2024-01-31", "2024-02-01"), "202402": ("2024-02-02", "2024-01-30")}
    for month, starts in days.items():
        rows = [line(f"{month}{d}", f"{d} 00:30:00").replace("2024-01-05 09", "2024-02-09 09") for d in starts]
        (folder / f"{month}-trips.csv").write_text(text(*rows))


def test_refresh_from_files_to_reports(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    run_files(files)
    where = refresh.Tables(str(tmp_path / "warehouse"))
    run = (date(2024, 2, 15), date(2024, 3, 15))
    for _ in range(2):
        refresh.refresh(spark, where, *run, source=str(files))
        monthly = {r.metric_month: r.ride_count for r in where.read(spark, schemas.MONTHLY).collect()}
        # A trip belongs to the month it starts in, whichever file brought it.
        assert monthly == {date(2024, 1, 1): 2, date(2024, 2, 1): 2}
    assert where.read(spark, schemas.HOURLY).count() == 4
    months = {r.source_month for r in where.read(spark, schemas.RAW).collect()}
    assert months == {"202401", "202402"}


def test_refresh_from_archives(spark, archives, tmp_path):
    where = refresh.Tables(str(tmp_path / "warehouse"))
    run = (date(2024, 2, 15), date(2024, 3, 15))
    refresh.refresh(spark, where, *run, source=str(archives), archives=True)
    monthly = where.read(spark, schemas.MONTHLY).collect()
    # One of the trips has an unreadable start and is left out.
    assert [(r.metric_month, r.ride_count) for r in monthly] == [(date(2024, 1, 1), 5003)]


def test_staging_is_checked_while_it_is_written(spark, trips, tmp_path):
    where = refresh.Tables(str(tmp_path / "warehouse"))
    kinds = ("docked_bike", " ", "classic_bike")
    refresh.land(
        trips(*[{"rideable_type": k} for k in kinds]).withColumn("file_month", F.lit("202403")),
        where.landing,
    )
    run = (date(2024, 4, 1), date(2024, 4, 1))
    refresh.load_raw(spark, where, *run)
    while_writing = refresh.build_staging(spark, where, *run)
    afterwards = quality.check(where.read(spark, schemas.STAGING), schemas.STAGING)
    assert while_writing.exceptAll(afterwards).count() == 0
    assert while_writing.where("not passed").count() == 2


def test_full_refresh_keeps_only_its_window(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    run_files(files)
    where = refresh.Tables(str(tmp_path / "warehouse"))
    refresh.refresh(spark, where, date(2024, 2, 15), date(2024, 3, 15), source=str(files))
    refresh.refresh(spark, where, date(2024, 3, 15), date(2024, 3, 15), full_refresh=True)
    monthly = {r.metric_month: r.ride_count for r in where.read(spark, schemas.MONTHLY).collect()}
    assert monthly == {date(2024, 2, 1): 2}
    assert where.read(spark, schemas.RAW).count() == 4


def test_a_failed_check_stops_the_run_before_the_reports(spark, tmp_path):
    (tmp_path / "202401.csv").write_text(text(line("a").replace("classic_bike", "docked_bike")))
    where = refresh.Tables(str(tmp_path / "warehouse"))
    run = (date(2024, 2, 1), date(2024, 2, 1))
    with pytest.raises(quality.QualityError, match="rideable_type accepted_values: 1 rows"):
        refresh.refresh(spark, where, *run, source=str(tmp_path))
    assert not (tmp_path / "warehouse" / "report").exists()
    refresh.refresh(spark, where, *run, fail_on_check=False)
    assert where.read(spark, schemas.WEEKLY).count() == 1


def test_files_without_a_month_are_refused_unless_one_is_given(spark, tmp_path):
    (tmp_path / "trips-p.csv").write_text(text(line("p")))
    with zipfile.ZipFile(tmp_path / "trips-q.zip", "w") as z:
        z.writestr("q.csv", text(line("q")))
    for read in (trip_files.read_csv, trip_files.read_archives):
        with pytest.raises(Exception, match="no month in the names"):
            read(spark, str(tmp_path)).collect()
        assert [r.file_month for r in read(spark, str(tmp_path), file_month="202403").collect()] == ["202403"]


def test_rows_without_a_file_month_are_not_landed(spark, trips, tmp_path):
    landing = str(tmp_path / "landing")
    named = trips({}).withColumn("file_month", F.lit("202401"))
    refresh.land(named, landing)
    with pytest.raises(Exception, match="without a file month"):
        refresh.land(named.withColumn("file_month", F.lit(None).cast("string")), landing)
    assert trip_files.read_landed(spark, landing).count() == 1


def test_a_swapped_header_stops_the_load(spark, tmp_path):
    names = schemas.TRIPS.names
    swapped = [*names]
    i, j = names.index("start_station_name"), names.index("end_station_name")
    swapped[i], swapped[j] = names[j], names[i]
    body = text(line()).replace(HEADER, ",".join(swapped))
    (tmp_path / "202401-a.csv").write_text(body)
    with zipfile.ZipFile(tmp_path / "202401-a.zip", "w") as z:
        z.writestr("a.csv", body)
    for read in (trip_files.read_csv, trip_files.read_archives):
        with pytest.raises(Exception, match="(?i)header"):
            read(spark, str(tmp_path)).collect()


def test_bad_numbers_become_null_where_allowed(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "202401-a.zip", "w") as z:
        z.writestr("a.csv", text(line("a", lat="north"), line("b")))
    rows = trip_files.read_archives(spark, str(tmp_path), bad_rows="PERMISSIVE").collect()
    assert {r.ride_id: r.start_lat for r in rows} == {"a": None, "b": 40.7}


SPOILED = text(line("a"), line("b", lat="north"), line("c").rsplit(",", 1)[0], line("d") + ",more", line("e", lat=""))


@pytest.mark.parametrize("kind", ["csv", "zip"])
def test_records_that_cannot_be_read_are_kept_apart(spark, tmp_path, kind):
    if kind == "csv":
        (tmp_path / "202401-a.csv").write_text(SPOILED)
        read = trip_files.read_csv
    else:
        with zipfile.ZipFile(tmp_path / "202401-a.zip", "w") as z:
            z.writestr("a.csv", SPOILED)
        read = trip_files.read_archives
    rows = read(spark, str(tmp_path), bad_rows="PERMISSIVE")
    records = {r.corrupt_record for r in rows.collect()}
    assert records == {None, line("b", lat="north"), line("c").rsplit(",", 1)[0], line("d") + ",more"}
    landing = str(tmp_path / "landing")
    refresh.land(rows, landing)
    assert sorted(r.ride_id for r in trip_files.read_landed(spark, landing).collect()) == ["a", "e"]
    kept_apart = trip_files.read_quarantine(spark, landing, ["202401"])
    assert {r.corrupt_record for r in kept_apart.collect()} == records - {None}
    assert trip_files.read_quarantine(spark, landing, ["202402"]).count() == 0
    # Whole files land in place of spoiled ones, and leave nothing behind.
    refresh.land(rows.where("corrupt_record is null").drop("corrupt_record"), landing)
    assert trip_files.read_quarantine(spark, landing).count() == 0
    with pytest.raises(Exception, match="MALFORMED|north|Expected 13"):
        read(spark, str(tmp_path)).collect()


def test_landed_months_are_found_without_the_others(spark, tmp_path):
    for month, starts in {"202401": ("2024-01-31",), "202402": ("2024-02-02", "2024-01-30"), "202403": ("nope",)}.items():
        (tmp_path / f"{month}-t.csv").write_text(text(*[line(f"{month}-{d}", f"{d} 00:30:00") for d in starts]))
    landing = str(tmp_path / "landing")
    refresh.land(trip_files.read_csv(spark, str(tmp_path)), landing)
    january = trip_files.read_landed_months(spark, landing, ["202401", "202312"])
    # A late trip in a later file is found; files of other months are not even listed.
    assert sorted(r.ride_id for r in january.collect()) == ["202401-2024-01-31", "202402-2024-01-30"]
    assert all("/started_month=202401/" in f for f in january.inputFiles()) and len(january.inputFiles()) == 2
    assert trip_files.read_landed_months(spark, landing, ["202305"]).count() == 0
    assert trip_files.read_landed(spark, landing).count() == 4


def test_a_file_that_brings_other_months_leaves_none_behind(spark, trips, tmp_path):
    landing = str(tmp_path / "landing")
    for day, ride in (("2024-01-05", "a"), ("2024-02-05", "b")):
        start = datetime.fromisoformat(f"{day} 08:00:00")
        refresh.land(trips({"ride_id": ride, "started_at": start}).withColumn("file_month", F.lit("202401")), landing)
    assert [r.ride_id for r in trip_files.read_landed(spark, landing).collect()] == ["b"]


def test_schemas_of_files_that_drifted(spark, trips, tmp_path):
    ours = trips({})
    ours.write.parquet(str(tmp_path / "a"))
    ours.drop("ended_at").withColumn("start_lat", F.lit("x")).withColumn("more", F.lit(1)).write.parquet(str(tmp_path / "b"))
    found = drift.differences(drift.file_columns(spark, str(tmp_path)), schemas.TRIPS)
    assert {(r.column_name, r.declared, r.found) for r in found.collect() if "/b/" in r.file} == {
        ("ended_at", "timestamp_ntz", None), ("more", None, "int"), ("start_lat", "double", "string"),
    }
    assert found.where("file like '%/a/%'").count() == 0


@pytest.mark.parametrize(
    ("path", "uri"),
    [
        ("s3a://bucket/zip", "s3://bucket/zip"),
        ("s3://bucket/zip", "s3://bucket/zip"),
        ("hdfs://host/zip", "hdfs://host/zip"),
        ("file:/data/zip", "file:///data/zip"),
        ("file:///data/zip", "file:///data/zip"),
        ("/data/zip", "file:///data/zip"),
    ],
)
def test_archive_paths(path, uri):
    assert trip_archive.filesystem_uri(path) == uri


def test_other_archive_paths():
    assert trip_archive.filesystem_uri("zip").startswith("file:///")
    with pytest.raises(ValueError, match="ftp"):
        trip_archive.filesystem_uri("ftp://host/zip")


def test_columns_and_days_reach_the_archive_parser(spark, archives, tmp_path):
    with zipfile.ZipFile(tmp_path / "202403.zip", "w") as z:
        starts = [
            "2024-03-01", "2024-03-01 23:59:59.999", "2024-03-02 00:00:00", "2024-2-29 10:00:00",
            " 2024-03-01 10:00:00", "2024-03-01 lunch", "",
        ]
        z.writestr("202403.csv", text(*[line(f"m{i}", s, lat="0.5") for i, s in enumerate(starts)]))
    day = (date(2024, 3, 1), date(2024, 3, 2))
    df = trip_files.read_archives(spark, str(tmp_path), columns=["ride_id", "end_lat"], started=day)
    assert df.columns == ["ride_id", "end_lat", "file_month"]
    whole = trip_files.read_archives(spark, str(tmp_path))
    inside = whole.where("started_at >= date'2024-03-01' AND started_at < date'2024-03-02'")
    found = sorted(map(tuple, df.collect()))
    assert found == sorted(map(tuple, inside.select(*df.columns).collect()))
    assert [r[0] for r in found] == ["m0", "m1", "m4"]
    # A filter on the whole frame leaves it whole.
    assert whole.count() == 5011
    text_ = df._jdf.queryExecution().toString()
    assert re.search(r"trip_archive\[ride_id#\d+, started_at#\d+, end_lat#\d+, archive#\d+\]", text_)
    leap = trip_files.read_archives(spark, str(tmp_path), started=(date(2024, 2, 29), date(2024, 3, 1)))
    assert [r.ride_id for r in leap.collect()] == ["m3"]
    assert trip_files.read_archives(spark, str(tmp_path), columns=[]).count() == whole.count()
    with pytest.raises(ValueError, match="no columns"):
        trip_files.read_archives(spark, str(tmp_path), columns=["ride"])


def test_kept_records_need_all_fields(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "202401.zip", "w") as z:
        z.writestr("202401.csv", text(line("a"), line("b", lat="north"), "c,short"))
    read = trip_files.read_archives(spark, str(tmp_path), bad_rows="PERMISSIVE", columns=["ride_id"])
    rows = {r.ride_id: r.corrupt_record for r in read.collect()}
    assert rows == {"a": None, "b": line("b", lat="north"), None: "c,short"}
    # A bad number in a column that isn't read is not noticed.
    assert trip_files.read_archives(spark, str(tmp_path), columns=["end_lat"], bad_rows="PERMISSIVE").count() == 3
