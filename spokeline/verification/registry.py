"""Every operator as a query over the driver's tables."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spokeline import schemas
from spokeline.functions import first_months, month_label, run_window
from spokeline.functions import months_in_window as months_of_run
from spokeline.marts import common, hourly, monthly, stations, weekly, yoy
from spokeline.operators import drift, quality, reports, rollups, staging
from spokeline.plans import refresh
from spokeline.session import scratch_root
from spokeline.sinks import tables as sinks
from spokeline.sources import tables, trip_files
from spokeline.verification import trips as source

Query = Callable[[SparkSession, str], DataFrame]

# Two scheduled monthly runs. Their windows share February, and the window of
# both together has trips on either side to leave out.
RUNS = ((date(2025, 2, 15), date(2025, 3, 15)), (date(2025, 3, 15), date(2025, 4, 15)))
NARROW = (RUNS[0][0], RUNS[1][1])
BACKFILL = (source.START, source.END)
# A pair of years of which the trips have the first one only.
ABSENT = (2026, 2027)


# What reports compute from whole seconds and millimetres: the same bits in any order of addition.
EXACT = ("avg_ride_duration_minutes", "avg_ride_distance_km")


def rounded(df: DataFrame, places: int = 6, exact: tuple[str, ...] = ()) -> DataFrame:
    """Computed doubles but the ``exact`` ones rounded, because engines add them in different orders.

    A mean of, say, 32 whole-second durations can lie exactly between two
    roundings, where the order of addition decides. The SQL and this function
    both add a billionth first, which settles such values one way.
    """
    return df.withColumns(
        {
            f.name: F.round(F.col(f.name) + 1e-9, places)
            for f in df.schema
            if f.dataType == T.DoubleType() and not f.name.endswith(("_lat", "_lng")) and f.name not in exact
        }
    )


def _on_trips(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(build(source.clean(spark, sf_dir)))


def _report(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(build(source.clean(spark, sf_dir)), exact=EXACT)


def _on_report(table: schemas.Table, build: Callable[[DataFrame], DataFrame]) -> Query:
    """A page's data set over the report columns the page loads."""
    return _on_trips(lambda trips: build(_page(trips, table)))


def _page(trips: DataFrame, table: schemas.Table) -> DataFrame:
    return reports.from_trips(trips, table, stations=False)


def _on_weekly(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return _on_trips(lambda t: build(_page(t, schemas.WEEKLY), _page(t, schemas.HOURLY)))


def _on_yoy(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_report(schemas.MONTHLY, lambda m: build(yoy.compared_months(m)))


def _small(query: Query) -> Query:
    """The tables here are small; their folders are many. Rebalanced writes go to tasks on all cores all the same."""
    sizes = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    }

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        before = {key: spark.conf.get(key, None) for key in sizes}
        for key, value in sizes.items():
            spark.conf.set(key, value)
        try:
            return query(spark, sf_dir)
        finally:
            for key, value in before.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)

    return run


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


# -- trips ---------------------------------------------------------------------


def staging_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(source.clean(spark, sf_dir).drop("loaded_at"))


def raw_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = source.trips(spark, sf_dir)
    return staging.landed_in_window(landed, *NARROW).drop("loaded_at")


def rejected_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.rejected_by_reason(source.raw(spark, sf_dir))


def months_in_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months a run over the span of the events would process."""
    span = spark.read.parquet(f"{sf_dir}/events.parquet").agg(
        F.to_date(F.min("ts")).alias("start"),
        F.add_months(F.to_date(F.max("ts")), source.MONTHS).alias("end"),
    )
    months = F.explode(first_months(F.col("start"), F.col("end"))).alias("first_day")
    return span.select(months).select(F.date_format("first_day", "yyyyMM").alias("month"))


def month_labels(trips: DataFrame) -> DataFrame:
    months = trips.select(F.month("started_month").cast("bigint").alias("month")).distinct()
    return months.withColumn("month_label", month_label(F.col("month")))


def quality_checks(trips: DataFrame) -> DataFrame:
    """The declared checks of all four tables."""
    result = quality.check(trips, schemas.STAGING)
    for table in (schemas.HOURLY, schemas.MONTHLY, schemas.WEEKLY):
        result = result.unionByName(quality.check(reports.from_trips(trips, table), table))
    return result


# -- files and tables ------------------------------------------------------------


def _landed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips written as CSV and read back as trip files."""
    folder = _scratch(spark, "csv")
    source.write_csv(source.trips(spark, sf_dir), folder)
    return trip_files.read_csv(spark, folder)


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed_csv(spark, sf_dir).select(*schemas.TRIPS.names)


def archive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips written as zip archives and read back by the archive source."""
    folder = _scratch(spark, "zip")
    source.write_archives(source.trips(spark, sf_dir), folder)
    return trip_files.read_archives(spark, folder).select(*schemas.TRIPS.names)


def archive_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of the narrow run window by bike kind, from all archives, reading two columns of its days only."""
    folder = _scratch(spark, "zip")
    source.write_archives(source.trips(spark, sf_dir), folder)
    rows = trip_files.read_archives(
        spark, folder, columns=["rideable_type", "started_at"], started=run_window(*NARROW)
    )
    return rows.groupBy("file_month", "rideable_type").agg(
        F.count(F.lit(1)).alias("trips"), F.min("started_at").alias("first_start"), F.max("started_at").alias("last_start")
    )


def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV to landed Parquet and back."""
    landing = _scratch(spark, "landing")
    refresh.land(_landed_csv(spark, sf_dir), landing)
    return trip_files.read_landed(spark, landing)


def _delivered(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """All trips as files, some with records that can't be read, some in a later month's file."""
    folder = _scratch(spark, kind)
    source.write_spoiled(source.trips(spark, sf_dir), folder, kind)
    return folder


def _quarantined(kind: str) -> Query:
    """Records that could not be read, after files were landed twice."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        read = trip_files.read_csv if kind == "csv" else trip_files.read_archives
        landing, folder = _scratch(spark, "landing"), _delivered(spark, sf_dir, kind)
        for _ in range(2):
            refresh.land(read(spark, folder, bad_rows="PERMISSIVE"), landing)
        fields = F.split("corrupt_record", ",")
        return trip_files.read_quarantine(spark, landing).select(
            "file_month",
            fields[0].alias("ride_id"),
            F.size(fields).alias("n_fields"),
            F.contains("corrupt_record", F.lit(",north,")).alias("in_words"),
        )

    return query


def landed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed trips of the narrow window's months, by start month and the file that brought them."""
    landing = _scratch(spark, "landing")
    refresh.land(trip_files.read_csv(spark, _delivered(spark, sf_dir, "csv"), bad_rows="PERMISSIVE"), landing)
    months = months_of_run(*NARROW)
    trips = trip_files.read_landed_months(spark, landing, months).select(F.col("_metadata.file_path").alias("file_path"))
    keys = [F.regexp_extract("file_path", rf"/{k}=(\d+)/", 1).alias(k) for k in ("started_month", "file_month")]
    return trips.groupBy(*keys).agg(F.count("*").alias("trips"))


def _refreshed_from_files(kind: str) -> Query:
    """A report of a run from files, every trip on its own day.

    The backfill from CSV loads all months, the two scheduled runs from archives those of their windows.
    """

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        where = refresh.Tables(_scratch(spark, "warehouse"))
        files = {"source": _delivered(spark, sf_dir, kind), "archives": kind == "zip", "bad_rows": "PERMISSIVE"}
        for run in (BACKFILL,) if kind == "csv" else RUNS:
            refresh.refresh(spark, where, *run, fail_on_check=False, **files)
        table = schemas.MONTHLY if kind == "csv" else schemas.HOURLY
        return rounded(where.read(spark, table), exact=EXACT)

    return query


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips landed by month, one month by a writer with other columns: how its files differ."""
    landing = _scratch(spark, "landing")
    trips = source.trips(spark, sf_dir)
    month = F.date_format("started_at", "yyyyMM")
    for ours, rows in ((True, trips.where(month != "202407")), (False, trips.where(month == "202407"))):
        if not ours:
            rows = rows.withColumn("start_lat", F.col("start_lat").cast("string")).withColumnRenamed("end_lng", "end_lon")
        rows.withColumn("file_month", month).write.mode("append").partitionBy("file_month").parquet(landing)
    found = drift.differences(drift.file_columns(spark, landing), schemas.TRIPS)
    file = F.regexp_extract("file", r"file_month=(\d+)", 1).alias("file_month")
    return found.select(file, "column_name", "declared", "found").distinct()


def stored_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging by day: rows, whether all are in their day's folder, and whether files are in order."""
    path = _scratch(spark, "staging")
    sinks.replace(source.clean(spark, sf_dir), path, schemas.STAGING)
    stored = tables.read(spark, path, schemas.STAGING).select(
        "started_date",
        *schemas.STAGING.cluster_by,
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("at"),
    )
    folder = F.regexp_extract("file", r"started_date=([0-9-]+)/", 1) == F.col("started_date").cast("string")
    keys = F.struct(*schemas.STAGING.cluster_by)
    before = F.lag(keys).over(Window.partitionBy("file").orderBy("at"))
    marked = stored.select("started_date", folder.alias("in_folder"), (before.isNull() | (before <= keys)).alias("next"))
    return marked.groupBy("started_date").agg(
        F.count("*").alias("trips"), F.every("in_folder").alias("in_folder"), F.every("next").alias("in_order")
    )


def window_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw table of all days in which one window is then loaded again."""
    path = _scratch(spark, "raw")
    landed = source.trips(spark, sf_dir)
    sinks.replace(staging.with_lineage(landed), path, schemas.RAW)
    window = run_window(*NARROW)
    again = staging.landed_in_window(landed, *NARROW)
    sinks.replace_window(again, path, schemas.RAW, window)
    return tables.read(spark, path, schemas.RAW).drop("loaded_at")


def delete_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging of a narrow window, then of all days, keyed on the day."""
    path = _scratch(spark, "staging")
    raw = source.raw(spark, sf_dir)
    for window in (NARROW, (source.START, source.END)):
        cleaned = staging.clean(raw, *window)
        sinks.replace_by_key(cleaned, path, schemas.STAGING)
    return rounded(tables.read(spark, path, schemas.STAGING).drop("loaded_at"))


def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging of all days, rebuilt from a narrow window alone."""
    path = _scratch(spark, "staging")
    raw = source.raw(spark, sf_dir)
    for window in ((source.START, source.END), NARROW):
        sinks.replace(staging.clean(raw, *window), path, schemas.STAGING)
    return rounded(tables.read(spark, path, schemas.STAGING).drop("loaded_at"))


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips, moved to days 1, 11, 21 and 31 of their months.

    Tables with a folder per day are slow to write on a local disk; fewer days
    make them usable here without leaving out a trip.
    """
    back = F.make_dt_interval(F.pmod(F.dayofmonth("started_at") - 1, F.lit(10)))
    moved = source.trips(spark, sf_dir).withColumns(
        {"started_at": F.col("started_at") - back, "ended_at": F.col("ended_at") - back}
    )
    return moved.withColumn("file_month", F.date_format("started_at", "yyyyMM"))


def _backfilled(spark: SparkSession, sf_dir: str) -> refresh.Tables:
    where = refresh.Tables(_scratch(spark, "warehouse"))
    refresh.land(_landed(spark, sf_dir), where.landing)
    # The derived trips hold blank bike kinds for the checks to find.
    refresh.refresh(spark, where, *BACKFILL, fail_on_check=False)
    return where


def refreshed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of a refresh, counted by the jobs that write."""
    where = refresh.Tables(_scratch(spark, "warehouse"))
    refresh.land(_landed(spark, sf_dir), where.landing)
    return refresh.refresh(spark, where, *BACKFILL, fail_on_check=False)


def refreshed_in_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging after a backfill and a full refresh of a narrow window."""
    where = _backfilled(spark, sf_dir)
    refresh.refresh(spark, where, *NARROW, full_refresh=True, fail_on_check=False)
    return rounded(where.read(spark, schemas.STAGING).drop("loaded_at"))


def missing_weekly_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly page when its report has never been written and the hourly one has."""
    paths = [_scratch(spark, t) for t in ("weekly", "hourly")]
    moved = staging.clean(staging.with_lineage(_landed(spark, sf_dir)), source.START, source.END)
    sinks.replace(reports.hourly(moved), paths[1], schemas.HOURLY)
    return rounded(weekly.kpi(tables.load_weekly(spark, paths[0]), tables.load_hourly(spark, paths[1])))


def no_trips_kpis(trips: DataFrame) -> DataFrame:
    """The hourly page over an hourly report of no valid trip."""
    return hourly.kpis(_page(trips.where(F.col("ride_distance_km") < 0), schemas.HOURLY))


def _refreshed(table: schemas.Table) -> Query:
    """A report table after the backfill of all months and two scheduled runs."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        where = _backfilled(spark, sf_dir)
        for run in RUNS:
            refresh.refresh(spark, where, *run, fail_on_check=False)
        return rounded(where.read(spark, table), exact=EXACT)

    return query


def rolled_yoy(side: str) -> Query:
    """Yearly station lists from visits stored by day."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = _scratch(spark, "visits")
        sinks.replace(rollups.station_visits(source.clean(spark, sf_dir)), path, schemas.STATION_VISITS)
        visits = tables.read(spark, path, schemas.STATION_VISITS)
        return stations.by_year(stations.rolled_visits_of(visits, side))

    return query


def refreshed_after_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly report when the trips of every eleventh of a month turn out to be invalid."""
    where = _backfilled(spark, sf_dir)
    eleventh = F.dayofmonth("started_at") == 11
    corrected = _landed(spark, sf_dir).withColumn("ride_id", F.when(eleventh, "nan").otherwise(F.col("ride_id")))
    refresh.land(corrected, where.landing)
    refresh.refresh(spark, where, *BACKFILL, fail_on_check=False)
    return rounded(where.read(spark, schemas.HOURLY), exact=EXACT)


def raw_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips by source month, and whether all were stamped not before the run began."""
    began = datetime.now(timezone.utc)
    raw = staging.with_lineage(source.trips(spark, sf_dir))
    stamped = F.col("loaded_at").isNotNull() & (F.col("loaded_at") >= F.lit(began))
    return raw.groupBy("source_month").agg(F.count(F.lit(1)).alias("trips"), F.every(stamped).alias("stamped"))


def _stored(*tables_: schemas.Table) -> Callable[[Callable[..., DataFrame]], Query]:
    """A page's data set over stored reports, which are written once and loaded as the pages do."""
    load = {
        schemas.HOURLY: tables.load_hourly,
        schemas.WEEKLY: tables.load_weekly,
        schemas.MONTHLY: tables.load_monthly,
    }

    def over(build: Callable[..., DataFrame]) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            trips, loaded = source.clean(spark, sf_dir), []
            for table in tables_:
                path = _scratch(spark, table.name)
                sinks.replace(reports.from_trips(trips, table), path, table)
                loaded.append(load[table](spark, path))
            return rounded(build(*loaded))

        return query

    return over


def _from_rollups(table: schemas.Table) -> Query:
    """A report from the trip rollup, which is one pass over the trips."""

    def build(trips: DataFrame) -> DataFrame:
        rollup = rollups.trip_rollup(trips)
        visits = rollups.hourly_visits_of if table is schemas.HOURLY else rollups.visits_of
        return reports.from_rollups(rollups.usage_of(rollup), visits(rollup), table)

    return _report(build)


def _from_sets(table: schemas.Table) -> Query:
    """A report from station bitmaps. Half of the stations have numbers before the others come."""

    def build(trips: DataFrame) -> DataFrame:
        visits = rollups.station_visits(trips)
        none = tables.empty(trips.sparkSession, schemas.STATIONS)
        early = rollups.new_stations(visits.where(F.col("started_date") < F.lit(NARROW[0])), none)
        numbers = early.unionByName(rollups.new_stations(visits, early))
        return reports.from_sets(rollups.usage_sums(trips), rollups.station_sets(visits, numbers), table)

    return _report(build)


def _top(side: str) -> Query:
    return _on_trips(lambda t: stations.top_by_month(stations.visits_of(t, side)))


def _years(side: str) -> Query:
    return _on_trips(lambda t: stations.by_year(stations.visits_of(t, side)))


def _rolled(side: str) -> Query:
    return _on_trips(
        lambda t: stations.top_by_month(stations.rolled_visits_of(rollups.station_visits(t), side))
    )


def _year_table(side: str) -> Query:
    return _on_trips(
        lambda t: stations.top_of_year(stations.trips_by_year(stations.visits_of(t, side)))
    )


# Queries that write tables with many folders.
WRITING = {
    "quarantined_csv", "quarantined_archives", "landed_months", "schema_drift", "stored_layout", "window_replace",
    "delete_insert", "full_refresh", "refreshed_from_csv", "refreshed_from_archives", "refreshed_checks",
    "refreshed_in_full", "refreshed_weekly_report", "refreshed_hourly_report", "refreshed_monthly_report",
    "refreshed_after_correction", "missing_weekly_kpi", "rolled_yoy_top_stations_start", "rolled_yoy_top_stations_end",
    "stored_hourly_kpis", "stored_weekly_kpi", "stored_monthly_kpis", "stored_yoy_change", "csv_scan", "archive_scan",
    "archive_window", "landing_roundtrip",
}


def queries() -> dict[str, Query]:
    hour, month = schemas.HOURLY, schemas.MONTHLY
    found = {
        # cleaning
        "staging_clean": staging_clean,
        "raw_window": raw_window,
        "rejected_by_reason": rejected_by_reason,
        "quality_checks": _on_trips(quality_checks),
        "months_in_window": months_in_window,
        "month_labels": _on_trips(month_labels),
        # files and tables
        "csv_scan": csv_scan,
        "archive_scan": archive_scan,
        "archive_window": archive_window,
        "landing_roundtrip": landing_roundtrip,
        "quarantined_csv": _quarantined("csv"),
        "quarantined_archives": _quarantined("zip"),
        "landed_months": landed_months,
        "schema_drift": schema_drift,
        "stored_layout": stored_layout,
        "window_replace": window_replace,
        "delete_insert": delete_insert,
        "full_refresh": full_refresh,
        "refreshed_weekly_report": _refreshed(schemas.WEEKLY),
        "refreshed_hourly_report": _refreshed(schemas.HOURLY),
        "refreshed_monthly_report": _refreshed(schemas.MONTHLY),
        "refreshed_after_correction": refreshed_after_correction,
        "refreshed_from_csv": _refreshed_from_files("csv"),
        "refreshed_from_archives": _refreshed_from_files("zip"),
        "refreshed_checks": refreshed_checks,
        "refreshed_in_full": refreshed_in_full,
        "raw_lineage": raw_lineage,
        "missing_weekly_kpi": missing_weekly_kpi,
        "no_trips_kpis": _on_trips(no_trips_kpis),
        "stored_hourly_kpis": _stored(hour)(hourly.kpis),
        "stored_weekly_kpi": _stored(schemas.WEEKLY, hour)(weekly.kpi),
        "stored_monthly_kpis": _stored(month)(monthly.kpis),
        "stored_yoy_change": _stored(month)(lambda m: yoy.change(yoy.compared_months(m))),
        # reports
        "hourly_report": _report(reports.hourly),
        "weekly_report": _report(reports.weekly),
        "monthly_report": _report(reports.monthly),
        "rolled_hourly_report": _from_rollups(hour),
        "rolled_weekly_report": _from_rollups(schemas.WEEKLY),
        "rolled_monthly_report": _from_rollups(month),
        "set_weekly_report": _from_sets(schemas.WEEKLY),
        "set_monthly_report": _from_sets(month),
        # stations
        "top_stations_start": _top("start"),
        "top_stations_end": _top("end"),
        "rolled_top_stations_start": _rolled("start"),
        "rolled_top_stations_end": _rolled("end"),
        "station_table": _on_trips(
            lambda t: stations.numbered(stations.top_by_month(stations.visits_of(t, "start")))
        ),
        "yoy_top_stations_start": _years("start"),
        "yoy_top_stations_end": _years("end"),
        "rolled_yoy_top_stations_start": rolled_yoy("start"),
        "rolled_yoy_top_stations_end": rolled_yoy("end"),
        "yoy_station_table": _year_table("start"),
        "yoy_station_table_end": _year_table("end"),
        # hourly page
        "hourly_date_range": _on_report(hour, hourly.date_range),
        "member_options": _on_report(hour, common.member_options),
        "hourly_kpis": _on_report(hour, hourly.kpis),
        "hourly_kpis_casual": _on_report(hour, lambda r: hourly.kpis(r, "casual")),
        "hourly_activity_by_member": _on_report(hour, hourly.activity_by_member),
        "hourly_duration_by_member": _on_report(hour, hourly.duration_by_member),
        "hourly_distance_by_member": _on_report(hour, hourly.distance_by_member),
        "hourly_activity_by_bike": _on_report(hour, hourly.activity_by_bike),
        "hourly_activity_by_bike_member": _on_report(
            hour, lambda r: hourly.activity_by_bike(r, "member")
        ),
        "weekday_weekend_duration": _on_report(hour, hourly.weekday_weekend_duration),
        # weekly page
        "weeks_covered": _on_report(hour, weekly.weeks_covered),
        "weekly_kpi": _on_weekly(weekly.kpi),
        "weekly_member_share": _on_weekly(weekly.member_share),
        "weekly_member_by_day": _on_weekly(weekly.member_by_day),
        "weekly_bike_share": _on_weekly(weekly.bike_share),
        "weekly_bike_share_casual": _on_weekly(lambda w, h: weekly.bike_share(w, h, "casual")),
        "weekly_bike_by_day": _on_weekly(weekly.bike_by_day),
        # monthly page
        "monthly_date_range": _on_trips(
            lambda t: monthly.date_range(_page(t, hour), _page(t, month))
        ),
        "monthly_kpis": _on_report(month, monthly.kpis),
        "monthly_rides_by_member": _on_report(month, monthly.rides_by_member),
        "monthly_rides_by_bike": _on_report(month, monthly.rides_by_bike),
        # year over year
        "yoy_monthly": _on_report(month, yoy.monthly),
        "yoy_yearly": _on_yoy(yoy.yearly),
        "yoy_peak_month": _on_yoy(yoy.peak_month),
        "yoy_stats": _on_yoy(yoy.stats),
        "yoy_stats_casual": _on_yoy(lambda y: yoy.stats(y, "casual")),
        "yoy_subtitle": _on_yoy(yoy.subtitle),
        "yoy_month_rides": _on_yoy(yoy.month_rides),
        "yoy_change": _on_yoy(yoy.change),
        "yoy_change_absent_year": _on_report(
            month, lambda m: yoy.change(yoy.compared_months(m, ABSENT), years=ABSENT)
        ),
        "yoy_stats_absent_year": _on_report(
            month, lambda m: yoy.stats(yoy.compared_months(m, ABSENT), years=ABSENT)
        ),
        "yoy_rides_by_member": _on_yoy(yoy.rides_by_member),
        "yoy_rides_by_bike": _on_yoy(yoy.rides_by_bike),
        "yoy_duration_by_month": _on_yoy(yoy.duration_by_month),
        "yoy_distance_by_month": _on_yoy(yoy.distance_by_month),
    }
    return {name: _small(query) if name in WRITING else query for name, query in found.items()}
