"""Bring all tables up to date for one run window."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokeline import schemas
from spokeline.functions import months_in_window, run_window
from spokeline.operators import quality, reports, rollups, staging
from spokeline.sinks import tables as sinks
from spokeline.sources import tables, trip_files


@dataclass(frozen=True)
class Tables:
    """Where each table of a warehouse folder lives."""

    root: str

    def __post_init__(self) -> None:
        object.__setattr__(self, "root", self.root.rstrip("/"))

    @property
    def landing(self) -> str:
        return f"{self.root}/landing/trips"

    def path(self, table: schemas.Table) -> str:
        layer = {
            schemas.RAW.name: "raw",
            schemas.STAGING.name: "staging",
            schemas.TRIP_ROLLUP.name: "staging",
            schemas.USAGE_SUMS.name: "staging",
            schemas.STATION_VISITS.name: "staging",
            schemas.STATIONS.name: "staging",
            schemas.STATION_SETS.name: "staging",
        }.get(table.name, "report")
        return f"{self.root}/{layer}/{table.name}"

    def read(self, spark: SparkSession, table: schemas.Table) -> DataFrame:
        return tables.read(spark, self.path(table), table)


def land(trips: DataFrame, landing: str) -> None:
    """Write trip files as Parquet by start month and file month; landing a file month again replaces it.

    Records that could not be read go to folders of their own by the same job, and no run
    reads them as trips (``trip_files.read_quarantine`` does). Rows stay in the tasks that read them:
    no shuffle, and files as large as the input splits.
    Rows without a file month stop the load before anything is replaced: all of
    them would share one folder, and the next such load would replace it.
    """
    unnamed = F.raise_error(F.lit("trips without a file month can't be landed"))
    corrupt = F.col(schemas.CORRUPT.name) if schemas.CORRUPT.name in trips.columns else F.lit(None).cast("string")
    named = trips.withColumns(
        {
            schemas.CORRUPT.name: corrupt,
            "kind": F.when(corrupt.isNull(), "trip").otherwise("corrupt"),
            "started_month": F.coalesce(F.date_format("started_at", "yyyyMM"), F.lit("unknown")),
            "file_month": F.coalesce(F.col("file_month"), unnamed.cast("string")),
        }
    )
    sinks.replace_sources(named, landing, schemas.LANDING)


def load_raw(
    spark: SparkSession, where: Tables, start: date, end: date, *, allow_empty: bool = False
) -> None:
    """Replace the run window of the raw table from all that has landed of its months."""
    landed = trip_files.read_landed_months(spark, where.landing, months_in_window(start, end))
    sinks.replace_window(
        staging.landed_in_window(landed, start, end),
        where.path(schemas.RAW),
        schemas.RAW,
        run_window(start, end),
        allow_empty=allow_empty,
    )


def build_staging(
    spark: SparkSession, where: Tables, start: date, end: date, *, full_refresh: bool = False
) -> DataFrame:
    """Clean the window's raw trips and return the report of the checks on them.

    Raw is stored by day already, so nothing is shuffled. Days of earlier runs
    were checked by those runs. Days of the window without a valid trip
    disappear, as raw, which was guarded when it was loaded, is what counts.
    """
    cleaned = staging.clean(where.read(spark, schemas.RAW), start, end)
    differences = quality.schema_differences(cleaned, schemas.STAGING)
    if differences:
        raise quality.QualityError("; ".join(differences))
    checks = quality.Watch(schemas.STAGING)
    noted = {"counts": checks.counts, "seen": checks.seen}
    path = where.path(schemas.STAGING)
    if full_refresh:
        sinks.replace(cleaned, path, schemas.STAGING, gather=False, **noted)
    else:
        window = run_window(start, end)
        sinks.replace_window(cleaned, path, schemas.STAGING, window, allow_empty=True, gather=False, **noted)
    return checks.report(spark)


def build_daily(
    spark: SparkSession, where: Tables, start: date, end: date, *, full_refresh: bool = False
) -> DataFrame:
    """Write what depends on one day's trips only, and return the report of the checks on the hourly report.

    One pass over the window's staging makes the trip rollup; the other rollups and the hourly
    report are made from that. The window's months are replaced as a whole, and rows of other days
    are those of a rebuild over all trips, because staging changes inside the window only.
    """

    def write(rows: DataFrame, table: schemas.Table, **noted) -> None:
        if full_refresh:
            sinks.replace(rows, where.path(table), table, **noted)
        else:
            window = run_window(start, end)
            sinks.replace_window(rows, where.path(table), table, window, allow_empty=True, **noted)

    def stored(table: schemas.Table) -> DataFrame:
        return staging.months_of_run(where.read(spark, table), start, end)

    window = staging.raw_in_window(where.read(spark, schemas.STAGING), start, end)
    write(rollups.trip_rollup(window), schemas.TRIP_ROLLUP)
    rollup = stored(schemas.TRIP_ROLLUP)
    write(rollups.usage_of(rollup), schemas.USAGE_SUMS)
    write(rollups.visits_of(rollup), schemas.STATION_VISITS)
    visits = stored(schemas.STATION_VISITS)
    write(rollups.station_sets(visits, numbered_stations(spark, where, visits)), schemas.STATION_SETS)
    checks = quality.Watch(schemas.HOURLY)
    hourly = reports.from_rollups(rollups.usage_of(rollup), rollups.hourly_visits_of(rollup), schemas.HOURLY)
    write(hourly, schemas.HOURLY, counts=checks.counts, seen=checks.seen)
    return checks.report(spark)


def numbered_stations(spark: SparkSession, where: Tables, visits: DataFrame) -> DataFrame:
    """The stations' numbers, with new ones for those that have none. Numbers once given stay as they are."""
    path = where.path(schemas.STATIONS)
    known = tables.read_or_empty(spark, path, schemas.STATIONS)
    sinks.replace(known.unionByName(rollups.new_stations(visits, known)), path, schemas.STATIONS)
    return where.read(spark, schemas.STATIONS)


def build_reports(spark: SparkSession, where: Tables) -> DataFrame:
    """Write the reports over all days anew, from the rollups alone, and return the report of their checks."""
    usage = where.read(spark, schemas.USAGE_SUMS)
    sets = where.read(spark, schemas.STATION_SETS)
    checked = []
    for table in (schemas.MONTHLY, schemas.WEEKLY):
        checks = quality.Watch(table)
        noted = {"counts": checks.counts, "seen": checks.seen}
        sinks.replace(reports.from_sets(usage, sets, table), where.path(table), table, **noted)
        checked.append(checks.report(spark))
    return checked[0].unionByName(checked[1])


def refresh(
    spark: SparkSession,
    where: Tables,
    start: date,
    end: date,
    *,
    source: str | None = None,
    archives: bool = False,
    bad_rows: str = "FAILFAST",
    multi_line: bool = False,
    full_refresh: bool = False,
    allow_empty: bool = False,
    fail_on_check: bool = True,
) -> DataFrame:
    """Files to reports for the months from the one before ``start`` up to ``end``'s.

    Returns the report of all checks, which were counted while the tables were written.

    ``source`` is a folder of trip CSVs, or of zip archives with ``archives``;
    without it the run starts from what has landed. ``bad_rows`` and ``multi_line``
    are those of ``read_csv``; with PERMISSIVE, records that cannot be read are kept apart.
    ``full_refresh`` rebuilds staging and what follows from this window alone. A failed check stops the run before the
    tables that depend on the checked one are written.
    """
    if source is not None:
        months = months_in_window(start, end)
        if archives:
            trips = trip_files.read_archives(spark, source, months, bad_rows=bad_rows)
        else:
            trips = trip_files.read_csv(spark, source, months, multi_line=multi_line, bad_rows=bad_rows)
        land(trips, where.landing)
    load_raw(spark, where, start, end, allow_empty=allow_empty)
    checked = [build_staging(spark, where, start, end, full_refresh=full_refresh)]
    if fail_on_check:
        quality.require(checked[0])
    checked.append(build_daily(spark, where, start, end, full_refresh=full_refresh))
    checked.append(build_reports(spark, where))
    if fail_on_check:
        quality.require(checked[1].unionByName(checked[2]))
    return reduce(DataFrame.unionByName, checked)
