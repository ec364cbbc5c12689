from datetime import date

import pytest

from conftest import ts
from spokeline import schemas
from spokeline.marts import common, hourly, monthly, stations, weekly, yoy
from spokeline.operators import rollups, staging


def monthly_rows(spark, *rows):
    """(month, rider, rides, minutes, km, speed)"""
    return spark.createDataFrame(
        [(m, who, "classic_bike", n, d, k, v, 1, 1) for m, who, n, d, k, v in rows],
        schemas.MONTHLY.struct,
    )


def hourly_rows(spark, *rows):
    """(day, hour, rider, rides, minutes, km, speed)"""
    return spark.createDataFrame(
        [(d, h, who, "classic_bike", False, n, 1, 1, m, k, v) for d, h, who, n, m, k, v in rows],
        schemas.HOURLY.struct,
    )


@pytest.fixture
def two_years(spark):
    return yoy.compared_months(
        monthly_rows(
            spark,
            (date(2024, 1, 1), "member", 100, 10.0, 2.0, 9.0),
            (date(2024, 1, 1), "casual", 50, 20.0, 4.0, None),
            (date(2024, 2, 1), "member", 150, 10.0, 2.0, 9.0),
            (date(2025, 1, 1), "member", 300, 12.0, 3.0, 9.0),
            (date(2025, 3, 1), "casual", 30, 12.0, 3.0, 9.0),
            (date(2026, 1, 1), "member", 999, 12.0, 3.0, 9.0),
        )
    )


def test_change_keeps_single_missing_months_unknown(two_years):
    rows = {r.month: r for r in yoy.change(two_years).collect()}
    assert (rows[1].rides_2024, rows[1].rides_2025, rows[1].yoy_pct) == (150, 300, 100.0)
    assert (rows[2].rides_2024, rows[2].rides_2025, rows[2].yoy_pct) == (150, None, None)
    assert (rows[3].rides_2024, rows[3].rides_2025, rows[3].yoy_pct) == (None, 30, None)
    assert [r.month_label for r in rows.values()] == ["Jan", "Feb", "Mar"]


def test_change_of_a_year_without_rows(spark):
    only_old = yoy.compared_months(monthly_rows(spark, (date(2024, 5, 1), "member", 7, 1.0, 1.0, 1.0)))
    row = yoy.change(only_old).first()
    assert (row.rides_2024, row.rides_2025, row.yoy_pct) == (7, 0, -100.0)
    only_new = yoy.compared_months(monthly_rows(spark, (date(2025, 5, 1), "member", 7, 1.0, 1.0, 1.0)))
    row = yoy.change(only_new).first()
    assert (row.rides_2024, row.rides_2025, row.yoy_pct) == (0, 7, None)


def test_peak_month_prefers_the_earlier_of_equals(two_years):
    rows = [(r.year, r.month, r.rides) for r in yoy.peak_month(two_years).collect()]
    assert rows == [(2024, 1, 150), (2025, 1, 300)]


def test_yearly_and_stats(two_years):
    rows = {r.year: r for r in yoy.yearly(two_years).collect()}
    assert (rows[2024].total_rides, rows[2024].months_covered) == (300, 2)
    assert rows[2024].avg_duration == pytest.approx((150 * 10 + 50 * 20 + 100 * 10) / 300)
    cards = {r.label: r for r in yoy.stats(two_years).collect()}
    assert cards["Total Rides"].change_text == "+10.0%"
    assert cards["Peak Month Rides"].value_2025 == 300
    assert cards["Avg Duration (min)"].text_2025 == "12.0"


def test_stats_of_a_missing_year(two_years):
    cards = {r.label: r for r in yoy.stats(two_years, "nobody").collect()}
    assert cards["Total Rides"].value_2024 == 0 and cards["Total Rides"].change_text == "N/A"
    assert yoy.subtitle(two_years, "nobody").first().subtitle == (
        "2024: 0 months of data  |  2025: 0 months of data"
    )


def test_other_years(spark):
    base = yoy.compared_months(
        monthly_rows(spark, (date(2026, 1, 1), "member", 5, 1.0, 1.0, 1.0)), (2025, 2026)
    )
    row = yoy.change(base, years=(2025, 2026)).first()
    assert (row.rides_2025, row.rides_2026) == (0, 5)


def test_speed_is_weighted_over_known_groups_only(spark):
    report = hourly_rows(
        spark,
        (date(2024, 1, 1), 8, "member", 10, 6.0, 1.0, 10.0),
        (date(2024, 1, 1), 9, "member", 30, 10.0, 2.0, None),
    )
    row = hourly.kpis(report).first()
    assert row.avg_speed_kmh == 10.0
    assert row.avg_duration_minutes == pytest.approx(9.0)
    assert (row.avg_daily_rides, row.daily_rides_text, row.duration_text) == (40.0, "40", "9.0 min")


def test_days_are_those_on_which_the_group_occurs(spark):
    report = hourly_rows(
        spark,
        (date(2024, 1, 1), 8, "member", 10, 6.0, 1.0, 10.0),
        (date(2024, 1, 9), 8, "member", 20, 6.0, 1.0, 10.0),
        (date(2024, 1, 1), 8, "casual", 4, 6.0, 1.0, 10.0),
    )
    rows = {r.member_casual: r for r in hourly.activity_by_member(report).collect()}
    assert (rows["member"].n_days, rows["member"].avg_rides) == (2, 15.0)
    assert (rows["casual"].n_days, rows["casual"].avg_rides) == (1, 4.0)
    assert weekly.weeks_covered(report).first().n_weeks == pytest.approx(9 / 7)


def test_empty_reports(spark):
    hour, month, week = (
        spark.createDataFrame([], t.struct) for t in (schemas.HOURLY, schemas.MONTHLY, schemas.WEEKLY)
    )
    assert hourly.date_range(hour).first().first_date is None
    assert list(hourly.kpis(hour).first()) == [None] * 8
    assert weekly.weeks_covered(hour).first().n_weeks == 1.0
    assert weekly.kpi(week, hour).first().avg_weekly_rides is None
    assert weekly.member_share(week, hour).collect() == []
    assert monthly.kpis(month).first().months_covered == 0
    assert monthly.date_range(hour, month).first().subtitle is None
    assert yoy.change(yoy.compared_months(month)).collect() == []
    assert [r.option for r in common.member_options(month).collect()] == ["All"]


def test_monthly_range_falls_back_to_months(spark):
    hour = spark.createDataFrame([], schemas.HOURLY.struct)
    month = monthly_rows(spark, (date(2024, 5, 1), "member", 7, 1.0, 1.0, 1.0))
    assert monthly.date_range(hour, month).first().first_date == date(2024, 5, 1)
    day = hourly_rows(spark, (date(2024, 4, 9), 8, "member", 10, 6.0, 1.0, 10.0))
    assert monthly.date_range(day, month).first().last_date == date(2024, 4, 9)


def test_shares_sum_to_one(spark):
    week = spark.createDataFrame(
        [(1, "Sunday", who, "classic_bike", n, 1.0, 1.0, 1.0, 1, 1) for who, n in (("member", 30), ("casual", 10))],
        schemas.WEEKLY.struct,
    )
    hour = hourly_rows(spark, (date(2024, 1, 1), 8, "member", 10, 6.0, 1.0, 10.0))
    rows = {r.member_casual: r for r in weekly.member_share(week, hour).collect()}
    assert (rows["member"].share, rows["casual"].share) == (0.75, 0.25)
    assert rows["member"].avg_rides == 30.0
    only = weekly.member_share(week, hour, "casual").collect()
    assert [(r.member_casual, r.share) for r in only] == [("casual", 1.0)]


@pytest.fixture
def station_trips(raw):
    rows = (
        [{"start_station_id": i, "start_station_name": n} for i, n in (("1", "X"), ("2", "X"), ("3", " "), (None, "Y"))]
        + [{"start_station_name": "Z", "started_at": ts("2024-04-04 08:00:00"), "ended_at": ts("2024-04-04 09:00:00")}] * 4
        + [{"start_station_name": "Z"}]
    )
    return staging.enrich(staging.standardize(raw(*rows)))


@pytest.mark.parametrize("rolled", [False, True])
def test_top_stations(station_trips, rolled):
    """Two ids with one name merge, a blank name is a group, a missing id is left out."""
    visits = (
        stations.rolled_visits_of(rollups.station_visits(station_trips), "start")
        if rolled
        else stations.visits_of(station_trips, "start")
    )
    top = [(r.station_name, r.avg_trips) for r in stations.top_by_month(visits).collect()]
    # Z has 4 and 1 trips in its two months: 2.5, rounded away from zero.
    assert top == [("Z", 3.0), ("X", 2.0), (None, 1.0)]
    years = [(r.station_name, r.trip_count) for r in stations.by_year(visits).collect()]
    assert years == [("Z", 5), ("X", 2), (None, 1)]


def test_station_tables(station_trips):
    visits = stations.visits_of(station_trips, "start")
    table = stations.numbered(stations.top_by_month(visits, 2)).collect()
    assert [(r.rank, r.station_name, r.avg_trips_text) for r in table] == [(1, "Z", "3.0"), (2, "X", "2.0")]
    best = stations.top_of_year(stations.trips_by_year(visits), 1).collect()
    assert [(r.year, r.rank, r.station_name, r.trips_text) for r in best] == [(2024, 1, "Z", "5")]


def test_side_is_checked(station_trips):
    with pytest.raises(ValueError):
        stations.visits_of(station_trips, "start_station_id; --")


def test_member_options_are_sorted_after_all(spark):
    report = monthly_rows(
        spark, *[(date(2024, 1, 1), who, 1, 1.0, 1.0, 1.0) for who in ("member", "casual", "member")]
    )
    assert [r.option for r in common.member_options(report).collect()] == ["All", "casual", "member"]
