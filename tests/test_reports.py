import pytest
from pyspark.sql import functions as F

from conftest import ts
from spokeline import schemas
from spokeline.operators import quality, reports, rollups, staging
from spokeline.verification import trips as source

SF = "/root/testdata/sf0.001"
TABLES = {t.name: t for t in (schemas.HOURLY, schemas.WEEKLY, schemas.MONTHLY)}


@pytest.fixture(scope="module")
def clean(spark):
    return source.clean(spark, SF).cache()


@pytest.mark.parametrize("table", TABLES.values(), ids=TABLES)
def test_report_agrees_with_plain_aggregation(clean, table):
    """The two-step report against Spark's own count(distinct), row by row."""
    ours = reports.from_trips(clean, table)
    assert quality.schema_differences(ours, table) == []
    keys = list(reports._keys(table))
    plain = (
        clean.withColumns(reports._keys(table))
        .groupBy(*keys)
        .agg(
            F.count("*").alias("n"),
            F.countDistinct("start_station_id").alias("s"),
            F.countDistinct("end_station_id").alias("e"),
            F.avg("ride_duration_minutes").alias("d"),
            F.avg("ride_distance_km").alias("k"),
            F.avg("avg_speed_kmh").alias("v"),
        )
    )
    key = lambda r: tuple(str(r[k]) for k in keys)
    expected = {key(r): r for r in plain.collect()}
    rows = ours.collect()
    assert len(rows) == len(expected)
    for r in rows:
        e = expected[key(r)]
        assert (r.ride_count, r.unique_start_stations, r.unique_end_stations) == (e.n, e.s, e.e)
        assert r.avg_ride_duration_minutes == pytest.approx(e.d)
        assert r.avg_ride_distance_km == pytest.approx(e.k)
        assert r.avg_speed_kmh == (None if e.v is None else pytest.approx(e.v))


@pytest.mark.parametrize("table", TABLES.values(), ids=TABLES)
def test_rollups_give_the_same_report(clean, table):
    places = lambda df: df.select(
        *[F.round(c, 9).alias(c) if c.startswith("avg_") else c for c in df.columns]
    )
    direct = places(reports.from_trips(clean, table))
    visits = rollups.hourly_visits if table is schemas.HOURLY else rollups.station_visits
    rolled = places(reports.from_rollups(rollups.usage_sums(clean), visits(clean), table))
    assert direct.exceptAll(rolled).count() == 0
    assert rolled.exceptAll(direct).count() == 0


def test_all_reports_count_every_trip(clean):
    total = clean.count()
    for table in TABLES.values():
        assert reports.from_trips(clean, table).agg(F.sum("ride_count")).first()[0] == total


def test_stations_never_outnumber_rides(clean):
    for table in TABLES.values():
        rows = reports.from_trips(clean, table)
        assert rows.where("unique_start_stations > ride_count or unique_end_stations > ride_count").count() == 0


def test_edge_groups(raw):
    """No known station, no moving trip, no bike kind."""
    rows = raw(
        {"rideable_type": " ", "start_station_id": None, "end_station_id": None,
         "ended_at": ts("2024-03-04 08:00:00")},
        {"rideable_type": None, "start_station_id": None, "end_station_id": "2",
         "ended_at": ts("2024-03-04 08:00:00")},
    )
    clean = staging.enrich(staging.standardize(rows))
    row = reports.monthly(clean).collect()
    assert len(row) == 1
    assert (row[0].rideable_type, row[0].ride_count, row[0].avg_speed_kmh) == (None, 2, None)
    assert (row[0].unique_start_stations, row[0].unique_end_stations) == (0, 1)


def test_stations_are_distinct_by_id_even_when_renamed(raw):
    rows = raw({"start_station_name": "A"}, {"start_station_name": "A (north)"}, {"start_station_id": "9"})
    clean = staging.enrich(staging.standardize(rows))
    direct = reports.monthly(clean).first()
    rolled = reports.from_rollups(
        rollups.usage_sums(clean), rollups.station_visits(clean), schemas.MONTHLY
    ).first()
    assert direct.unique_start_stations == rolled.unique_start_stations == 2


@pytest.mark.parametrize("table", TABLES.values(), ids=TABLES)
def test_empty_input(spark, table):
    empty = spark.createDataFrame([], schemas.STAGING.struct)
    assert reports.from_trips(empty, table).collect() == []


def test_42_checks_are_declared():
    declared = [c for t in schemas.CHECKED_TABLES for c in quality.checks(t)]
    assert len(declared) == 42
    assert sum(check == "accepted_values" for _, check in declared) == 2


def test_checks_find_the_blank_bike_kinds(clean):
    report = quality.check(clean, schemas.STAGING)
    failed = {(r.column_name, r.check_name) for r in report.where("not passed").collect()}
    assert failed == {("rideable_type", "not_null")}
    with pytest.raises(quality.QualityError, match="rideable_type not_null"):
        quality.require(report)


def test_checks_pass_on_empty_input(spark):
    empty = spark.createDataFrame([], schemas.STAGING.struct)
    quality.require(quality.check(empty, schemas.STAGING))
