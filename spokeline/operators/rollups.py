"""Trips pre-aggregated by day, so that reports over all days need not read them again.

* trip rollup: counts and sums per hour, rider and bike, of all trips and per station, in one
  pass over the trips; the others are made from it;
* usage sums: counts and sums of the measures per hour, rider and bike;
* station visits: trips per day, rider, bike, side (start or end) and station;
* station sets: bitmaps of the stations visited per day, rider, bike and side.

Their size depends on days and stations, not on trips. All aggregate inside
each task before the shuffle, so an hour or a station that holds a third of
all trips arrives as a few partial rows. Durations and distances are summed in whole seconds
and millimetres, so that sums are the same in whatever order they are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spokeline import schemas

DAY = ["started_date", "member_casual", "rideable_type"]
HOUR = ["started_date", "started_hour", "member_casual", "rideable_type"]
SUMS = ["rides", "seconds", "millimetres", "speed_sum", "speed_rides"]
_START = ["start_station_id", "start_station_name"]
_END = ["end_station_id", "end_station_name"]


def _nearest(value: Column) -> Column:
    return F.floor(value + 0.5).cast("bigint")


def _sums() -> list[Column]:
    return [
        F.count("*").alias("rides"),
        F.sum(_nearest(F.col("ride_duration_minutes") * 60.0)).alias("seconds"),
        F.sum(_nearest(F.col("ride_distance_km") * 1e6)).alias("millimetres"),
        F.sum("avg_speed_kmh").alias("speed_sum"),
        F.count("avg_speed_kmh").alias("speed_rides"),
    ]


def _columns(rollup: DataFrame, table: schemas.Table) -> DataFrame:
    return rollup.withColumn("started_month", F.trunc("started_date", "MM")).select(*table.names)


def sum_trips(trips: DataFrame, keys: list[str]) -> DataFrame:
    """Counts and sums of the trip measures per key."""
    return trips.groupBy(*keys).agg(*_sums())


def count_visits(trips: DataFrame, keys: list[str], named: bool) -> DataFrame:
    """Trips per key, side and known station id, and name if asked, in one pass over the trips."""
    start, end = (_START, _END) if named else (_START[:1], _END[:1])
    visits = trips.groupingSets([keys + start, keys + end], *keys, *start, *end).agg(
        F.grouping("start_station_id").alias("_by_end"), F.count("*").alias("visits")
    )
    by_end = F.col("_by_end") == 1
    station = ["station_id", "station_name"][: len(start)]
    return visits.select(
        *keys,
        F.when(by_end, "end").otherwise("start").alias("side"),
        # The columns of the other side are NULL in each grouping set.
        *[F.coalesce(s, e).alias(name) for name, s, e in zip(station, start, end)],
        "visits",
    ).where(F.col("station_id").isNotNull())


def trip_rollup(trips: DataFrame) -> DataFrame:
    """Rows of the trip rollup table: one scan of the trips, grouped three ways."""
    sets = trips.groupingSets([HOUR, HOUR + _START, HOUR + _END], *HOUR, *_START, *_END).agg(
        F.grouping("start_station_id").alias("_not_start"), F.grouping("end_station_id").alias("_not_end"), *_sums()
    )
    side = F.when(F.col("_not_start") == 0, "start").when(F.col("_not_end") == 0, "end").otherwise("all")
    sided = sets.withColumns(
        {
            "side": side,
            "station_id": F.coalesce("start_station_id", "end_station_id"),
            "station_name": F.coalesce("start_station_name", "end_station_name"),
        }
    )
    known = (F.col("side") == "all") | F.col("station_id").isNotNull()
    return _columns(sided.where(known), schemas.TRIP_ROLLUP)


def usage_of(rollup: DataFrame) -> DataFrame:
    """Usage sums from the trip rollup: a filter."""
    return _columns(rollup.where(F.col("side") == "all"), schemas.USAGE_SUMS)


def hourly_visits_of(rollup: DataFrame) -> DataFrame:
    """Visits by hour and station from the trip rollup: a filter."""
    return rollup.where(F.col("side") != "all").withColumn("visits", F.col("rides"))


def visits_of(rollup: DataFrame) -> DataFrame:
    """Station visits from the trip rollup."""
    keys = [*DAY, "side", "station_id", "station_name"]
    visits = hourly_visits_of(rollup).groupBy(*keys).agg(F.sum("visits").alias("visits"))
    return _columns(visits, schemas.STATION_VISITS)


def usage_sums(trips: DataFrame) -> DataFrame:
    """Rows of the usage sums table, straight from trips."""
    return _columns(sum_trips(trips, HOUR), schemas.USAGE_SUMS)


def station_visits(trips: DataFrame) -> DataFrame:
    """Rows of the station visits table, straight from trips."""
    return _columns(count_visits(trips, DAY, named=True), schemas.STATION_VISITS)


def hourly_visits(trips: DataFrame) -> DataFrame:
    """Station visits by hour, straight from trips."""
    return count_visits(trips, HOUR, named=False)


def new_stations(visits: DataFrame, stations: DataFrame) -> DataFrame:
    """Stations without a number, with the numbers they get: those after the highest given, by id.

    The numbering passes through one task, which sees each new station once and no trips.
    """
    seen = visits.select("station_id").distinct().join(stations, "station_id", "left_anti")
    highest = stations.agg(F.max("station_no")).first()[0] or 0
    place = F.row_number().over(Window.orderBy("station_id"))
    return seen.select("station_id", (place + F.lit(highest)).cast("bigint").alias("station_no"))


def station_sets(visits: DataFrame, stations: DataFrame) -> DataFrame:
    """Rows of the station sets table. Every station visited must have a number."""
    number = F.coalesce("station_no", F.raise_error(F.lit("a station without a number")).cast("bigint"))
    numbered = visits.join(stations, "station_id", "left").withColumn("_no", number)
    sets = (
        numbered.withColumn("bucket", F.bitmap_bucket_number("_no"))
        .groupBy(*DAY, "side", "bucket")
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_no")).alias("stations"))
    )
    return _columns(sets, schemas.STATION_SETS)
