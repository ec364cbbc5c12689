"""Report tables: trips by hour, weekday and month.

Each report joins two aggregates on its keys: the measure sums, which shrink
to a row per key inside every task, and the distinct stations. Distinct
counts are exact: pairs of key and station are made unique across tasks first
and counted per key afterwards, so no task ever holds one key's trips.

A report is built from clean trips or, cheaper, from the rollup tables. Reports over many days
merge the days' bitmaps of stations, which are counted without any pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spokeline import schemas
from spokeline.functions import weekday_name
from spokeline.operators import rollups

STATION_COUNTS = ("unique_start_stations", "unique_end_stations")


def _keys(table: schemas.Table) -> dict[str, Column]:
    day = F.col("started_date")
    time = {
        schemas.HOURLY.name: {"metric_date": day, "started_hour": F.col("started_hour")},
        schemas.WEEKLY.name: {"day_of_week": F.dayofweek(day).cast("bigint")},
        schemas.MONTHLY.name: {"metric_month": F.trunc(day, "MM")},
    }[table.name]
    return time | {c: F.col(c) for c in ("member_casual", "rideable_type")}


def _labels(table: schemas.Table) -> dict[str, Column]:
    return {
        schemas.HOURLY.name: {"is_weekend": F.dayofweek("metric_date").isin(1, 7)},
        schemas.WEEKLY.name: {"weekday_name": weekday_name(F.col("day_of_week"))},
        schemas.MONTHLY.name: {},
    }[table.name]


def from_trips(trips: DataFrame, table: schemas.Table, stations: bool = True) -> DataFrame:
    """A report straight from clean trips, with or without its station counts."""
    keys = _keys(table)
    keyed = trips.withColumns(keys)
    sums = rollups.sum_trips(keyed, list(keys))
    if not stations:
        return _measures(sums, table)
    return _merge(sums, rollups.count_visits(keyed, list(keys), named=False), table)


def from_rollups(usage: DataFrame, visits: DataFrame, table: schemas.Table) -> DataFrame:
    """The same report from usage sums and station visits (for the hourly report, by hour)."""
    keys = _keys(table)
    sums = _added(usage, table)
    pairs = visits.withColumns(keys).select(*keys, "side", "station_id").distinct()
    return _merge(sums, pairs, table)


def from_sets(usage: DataFrame, sets: DataFrame, table: schemas.Table) -> DataFrame:
    """The same report from usage sums and station sets. Tasks merge bitmaps before the shuffle."""
    keys = _keys(table)
    merged = (
        sets.withColumns(keys)
        .groupBy(*keys, "side", "bucket")
        .agg(F.bitmap_count(F.bitmap_or_agg("stations")).alias("stations"))
    )
    n = F.col("stations")
    counted = merged.groupBy(*keys).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("side") == side, n)), F.lit(0)).alias(name)
            for side, name in zip(("start", "end"), STATION_COUNTS)
        ]
    )
    return _measures(_with_counts(_added(usage, table), counted, table), table)


def _added(usage: DataFrame, table: schemas.Table) -> DataFrame:
    keys = _keys(table)
    return usage.withColumns(keys).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in rollups.SUMS])


def _merge(sums: DataFrame, pairs: DataFrame, table: schemas.Table) -> DataFrame:
    keys = list(_keys(table))
    counted = pairs.groupBy(*keys).agg(
        F.count_if(F.col("side") == "start").alias(STATION_COUNTS[0]),
        F.count_if(F.col("side") == "end").alias(STATION_COUNTS[1]),
    )
    return _measures(_with_counts(sums, counted, table), table)


def _with_counts(sums: DataFrame, counted: DataFrame, table: schemas.Table) -> DataFrame:
    keys = list(_keys(table))
    # A union instead of a join: NULL is a key like any other here.
    both = sums.unionByName(counted, allowMissingColumns=True)
    return both.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in rollups.SUMS],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in STATION_COUNTS],
    )


def _measures(sums: DataFrame, table: schemas.Table) -> DataFrame:
    rides = F.col("rides")
    columns = {
        "ride_count": rides,
        "avg_ride_duration_minutes": F.col("seconds") / 60.0 / rides,
        "avg_ride_distance_km": F.col("millimetres") / 1e6 / rides,
        "avg_speed_kmh": F.col("speed_sum") / F.nullif(F.col("speed_rides"), F.lit(0)),
    }
    full = sums.withColumns(columns | _labels(table))
    return full.select(*[c for c in table.names if c in full.columns])


def hourly(trips: DataFrame) -> DataFrame:
    """Usage per day, hour, rider and bike."""
    return from_trips(trips, schemas.HOURLY)


def weekly(trips: DataFrame) -> DataFrame:
    """Usage per weekday, rider and bike over all days."""
    return from_trips(trips, schemas.WEEKLY)


def monthly(trips: DataFrame) -> DataFrame:
    """Usage per month, rider and bike."""
    return from_trips(trips, schemas.MONTHLY)
