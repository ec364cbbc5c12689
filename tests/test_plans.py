"""The plans Spark makes are the ones the operators are written for."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from spokeline import schemas
from spokeline.marts import stations
from spokeline.operators import reports, staging
from spokeline.plans import refresh
from spokeline.sinks import tables as sinks
from spokeline.sources import tables, trip_files
from spokeline.verification import registry
from spokeline.verification import trips as source

SF = "/root/testdata/sf0.001"
RUN = (date(2024, 4, 1), date(2024, 4, 1))


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stored")
    raw = source.raw(spark, SF).where("started_date < date'2024-04-10'")
    sinks.replace(raw, str(root / "raw"), schemas.RAW)
    raw.select(*schemas.TRIPS.names).write.parquet(str(root / "landing"))
    cleaned = staging.clean(raw, date(2024, 2, 1), date(2024, 5, 1))
    sinks.replace(cleaned, str(root / "staging"), schemas.STAGING)
    return root


def test_window_scan_reads_only_its_days(spark, stored):
    text = plan(staging.clean(tables.read(spark, str(stored / "raw"), schemas.RAW), *RUN))
    partition_filters = re.search(r"PartitionFilters: \[(.*)\]", text).group(1)
    assert "2024-03-01" in partition_filters and "2024-04-01" in partition_filters
    assert "Exchange" not in text


def test_filters_reach_the_parquet_scan(spark, stored):
    text = plan(staging.clean(tables.read(spark, str(stored / "raw"), schemas.RAW), *RUN))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    for part in ("Not(EqualTo(ride_id,nan))", "IsNotNull(start_lat)", "IsNotNull(end_lng)"):
        assert part in pushed


def test_landed_scan_skips_other_months(spark, stored):
    text = plan(staging.landed_in_window(trip_files.read_landed(spark, str(stored / "landing")), *RUN))
    assert "GreaterThanOrEqual(started_at,2024-03-01T00:00)" in text
    assert "LessThan(started_at,2024-04-01T00:00)" in text


def test_landed_months_are_folders_of_the_scan(spark, tmp_path):
    trips = source.trips(spark, SF).withColumn("file_month", F.date_format("started_at", "yyyyMM"))
    refresh.land(trips, str(tmp_path / "landing"))
    months = trip_files.read_landed_months(spark, str(tmp_path / "landing"), ["202403"])
    text = plan(staging.landed_in_window(months, *RUN))
    assert "GreaterThanOrEqual(started_at,2024-03-01T00:00)" in text
    assert re.search(r"Location: InMemoryFileIndex \[\S*/kind=trip/started_month=202403\]", text)


def test_one_pass_over_staging_makes_all_daily_tables(spark, stored, tmp_path, monkeypatch):
    """Staging is scanned by the trip rollup, once; what else a run writes daily comes from that."""
    where = refresh.Tables(str(tmp_path / "warehouse"))
    cleaned = tables.read(spark, str(stored / "staging"), schemas.STAGING)
    sinks.replace(cleaned, where.path(schemas.STAGING), schemas.STAGING)
    scans, write = {}, sinks.replace_window

    def watched(rows, path, table, *more, **named):
        scans[table.name] = len(re.findall(r"Location: \S+ \[\S*/trips_clean/", plan(rows)))
        return write(rows, path, table, *more, **named)

    monkeypatch.setattr(sinks, "replace_window", watched)
    refresh.build_daily(spark, where, *RUN)
    assert scans == {
        "trip_rollup": 1, "usage_sums": 0, "station_visits": 0, "station_sets": 0, "hourly_usage": 0,
    }
    usage, sets = (where.read(spark, t) for t in (schemas.USAGE_SUMS, schemas.STATION_SETS))
    text = plan(reports.from_sets(usage, sets, schemas.MONTHLY))
    # Bitmaps are merged in tasks before they are shuffled, and no station is.
    assert "bitmap_or_agg" in text and "station_id" not in text
    assert re.search(r"partial_bitmap_or_agg", text)


def test_sums_do_not_depend_on_order(spark, stored):
    clean = tables.read(spark, str(stored / "staging"), schemas.STAGING)
    exact = ("metric_month", "member_casual", "rideable_type", *registry.EXACT)
    found = [
        sorted(map(tuple, reports.monthly(clean.repartition(n, F.rand(n))).select(*exact).collect()), key=str)
        for n in (1, 3, 7)
    ]
    assert found[0] == found[1] == found[2]


def test_report_scans_only_its_columns(spark, stored):
    text = plan(reports.monthly(tables.read(spark, str(stored / "staging"), schemas.STAGING)))
    columns = set(re.findall(r"(\w+):", " ".join(re.findall(r"ReadSchema: struct<(.*)>", text))))
    assert columns == {
        "member_casual", "rideable_type", "start_station_id", "end_station_id",
        "ride_duration_minutes", "ride_distance_km", "avg_speed_kmh",
    }


def test_top_lists_are_cut_before_the_shuffle(spark, stored):
    clean = tables.read(spark, str(stored / "staging"), schemas.STAGING)
    visits = stations.visits_of(clean, "start")
    assert "TakeOrderedAndProject" in plan(stations.top_by_month(visits))
    assert "WindowGroupLimit" in plan(stations.top_of_year(stations.trips_by_year(visits)))


# The archive source is Python by design, and so are footers.
READ_BY_PYTHON = {"archive_scan", "archive_window", "schema_drift"}


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - READ_BY_PYTHON))
def test_no_python_and_no_pairing_in_the_plan(spark, name):
    """Queries that write tables are run up to there; the plan is that of what they read back."""
    text = plan(registry.queries()[name](spark, SF))
    for node in ("Python", "CartesianProduct", "NestedLoopJoin", "MapInPandas"):
        assert node not in text
