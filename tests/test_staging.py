from datetime import date

import pytest

from conftest import ts
from spokeline import schemas
from spokeline.operators import quality, staging

START, END = date(2024, 4, 15), date(2024, 4, 15)  # the window is March 2024


def cleaned(raw, *changes):
    return staging.clean(raw(*changes), START, END)


def ids(df):
    return sorted(r.ride_id for r in df.collect())


def test_columns_and_types(raw):
    assert quality.schema_differences(cleaned(raw, {}), schemas.STAGING) == []
    assert cleaned(raw, {}).columns == schemas.STAGING.names


def test_placeholder_ids(raw):
    changes = [{"ride_id": i} for i in (None, "nan", "NaN", " nan", "R2")]
    assert ids(cleaned(raw, *changes)) == [" nan", "NaN", "R2"]


def test_zero_duration_has_no_speed(raw):
    row = cleaned(raw, {"ended_at": ts("2024-03-04 08:00:00")}).first()
    assert (row.ride_duration_minutes, row.avg_speed_kmh) == (0.0, None)


def test_end_before_start_or_missing(raw):
    assert ids(cleaned(raw, {"ended_at": None}, {"ended_at": ts("2024-03-04 07:59:59")})) == []


def test_duration_counts_whole_seconds(raw):
    row = cleaned(
        raw,
        {"started_at": ts("2024-03-04 00:00:00.9"), "ended_at": ts("2024-03-04 00:00:02.1")},
    ).first()
    assert row.ride_duration_minutes == pytest.approx(1 / 60)


def test_coordinate_bounds_are_inclusive(raw):
    kept = [{"ride_id": "a", "start_lat": 90.0}, {"ride_id": "b", "end_lng": -180.0}]
    dropped = [
        {"start_lat": 90.0001},
        {"end_lng": -180.0001},
        {"start_lng": None},
        {"end_lat": float("nan")},
    ]
    assert ids(cleaned(raw, *kept, *dropped)) == ["a", "b"]


def test_same_point(raw):
    row = cleaned(raw, {"end_lat": 40.7, "end_lng": -74.0}).first()
    assert (row.ride_distance_km, row.avg_speed_kmh) == (0.0, 0.0)


def test_texts_are_trimmed_and_ids_are_not(raw):
    row = cleaned(
        raw,
        {"start_station_name": "\tA ", "end_station_name": "  ", "start_station_id": " 1 "},
    ).first()
    assert (row.start_station_name, row.end_station_name, row.start_station_id) == ("A", None, " 1 ")


def test_window_edges(raw):
    last, stop = ts("2024-03-31 23:59:59.999999"), ts("2024-04-01 00:00:00")
    early = ts("2024-02-29 23:59:59.999999")
    late = ts("2024-04-02 00:00:00")
    rows = [
        {"ride_id": "in", "started_at": last, "ended_at": late},
        {"ride_id": "first", "started_at": ts("2024-03-01 00:00:00"), "ended_at": late},
        {"ride_id": "out", "started_at": stop, "ended_at": late},
        {"ride_id": "early", "started_at": early, "ended_at": late},
        {"ride_id": "none", "started_at": None},
    ]
    assert ids(cleaned(raw, *rows)) == ["first", "in"]


def test_landed_window_agrees_with_the_day_window(trips, raw):
    rows = [
        {"ride_id": str(i), "started_at": ts(t)}
        for i, t in enumerate(
            ["2024-02-29 23:59:59.999999", "2024-03-01 00:00:00", "2024-03-31 23:59:59.999999",
             "2024-04-01 00:00:00"]
        )
    ]
    landed = staging.landed_in_window(trips(*rows), START, END)
    by_day = staging.raw_in_window(raw(*rows), START, END)
    assert ids(landed) == ids(by_day) == ["1", "2"]


@pytest.mark.parametrize(
    "day, weekend, number", [("02", True, 7), ("03", True, 1), ("04", False, 2)]
)
def test_calendar_parts(raw, day, weekend, number):
    start, end = ts(f"2024-03-{day} 23:30:00"), ts("2024-03-09 00:00:00")
    row = cleaned(raw, {"started_at": start, "ended_at": end}).first()
    assert (row.is_weekend, row.day_of_week, row.started_hour) == (weekend, number, 23)
    assert (row.started_date, row.started_month) == (date(2024, 3, int(day)), date(2024, 3, 1))
    assert row.source_month == "202403"


def test_unknown_and_missing_bike_kinds_are_kept(raw):
    rows = cleaned(raw, {"ride_id": "a", "rideable_type": "docked_bike"}, {"ride_id": "b", "rideable_type": None})
    assert ids(rows) == ["a", "b"]
    failing = {
        (r.column_name, r.check_name): r.failing_rows
        for r in quality.check(rows, schemas.STAGING).collect()
    }
    assert failing["rideable_type", "accepted_values"] == 1
    assert failing["rideable_type", "not_null"] == 1


def test_duplicates_are_kept(raw):
    assert ids(cleaned(raw, {}, {})) == ["R1", "R1"]


def test_reasons_account_for_every_dropped_row(raw):
    rows = [
        {},
        {"ride_id": None},
        {"ride_id": "nan", "ended_at": None},
        {"ended_at": None},
        {"end_lat": None, "start_lat": 95.0},
        {"end_lat": 95.0},
        {"end_lng": float("nan")},
    ]
    counts = {r.reject_reason: r.rejected_rows for r in staging.rejected_by_reason(raw(*rows)).collect()}
    assert counts == {
        "placeholder_id": 2,
        "ends_before_start": 1,
        "missing_coordinates": 1,
        "coordinates_out_of_range": 2,
    }
    assert cleaned(raw, *rows).count() == len(rows) - sum(counts.values())


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_times_do_not_depend_on_the_session_zone(spark, raw, zone):
    """A trip across a clock change of the session's zone keeps its hour and duration."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = cleaned(
            raw,
            {"started_at": ts("2024-03-10 01:59:00"), "ended_at": ts("2024-03-10 03:01:00")},
            {"started_at": ts("2024-03-10 02:30:00"), "ended_at": ts("2024-03-10 03:30:00")},
        ).orderBy("started_at").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r.ride_duration_minutes for r in row] == [62.0, 60.0]
    assert [r.started_hour for r in row] == [1, 2]
    assert {r.started_date for r in row} == {date(2024, 3, 10)}
