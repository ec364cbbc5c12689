"""Declared columns, checks and physical layout of every table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

STRING = T.StringType()
DOUBLE = T.DoubleType()
LONG = T.LongType()
DATE = T.DateType()
BOOLEAN = T.BooleanType()
# Source times carry no zone, so they stay without one from file to report.
NTZ = T.TimestampNTZType()
INSTANT = T.TimestampType()


@dataclass(frozen=True)
class Column:
    name: str
    dtype: T.DataType
    required: bool = False
    accepted: tuple[str, ...] = ()
    comment: str = ""


@dataclass(frozen=True)
class Table:
    """One table: columns in order, day or month folder, sort order inside files."""

    name: str
    columns: tuple[Column, ...]
    partition_by: str | None = None
    cluster_by: tuple[str, ...] = field(default=())
    # Keys of the folders inside those of ``partition_by``.
    then_by: tuple[str, ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def folder_keys(self) -> list[str]:
        return [self.partition_by, *self.then_by] if self.partition_by else []

    @property
    def struct(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(c.name, c.dtype, True, {"comment": c.comment} if c.comment else None)
                for c in self.columns
            ]
        )


# The bike and rider kinds that the checks accept.
BIKE_TYPES = ("classic_bike", "electric_bike")
RIDER_TYPES = ("member", "casual")

_TRIP_COLUMNS = (
    Column("ride_id", STRING, comment="trip identifier as delivered"),
    Column("rideable_type", STRING, comment="bike kind"),
    Column("started_at", NTZ, comment="trip start, local wall clock"),
    Column("ended_at", NTZ, comment="trip end, local wall clock"),
    Column("start_station_name", STRING),
    Column("start_station_id", STRING),
    Column("end_station_name", STRING),
    Column("end_station_id", STRING),
    Column("start_lat", DOUBLE, comment="degrees"),
    Column("start_lng", DOUBLE, comment="degrees"),
    Column("end_lat", DOUBLE, comment="degrees"),
    Column("end_lng", DOUBLE, comment="degrees"),
    Column("member_casual", STRING, comment="rider kind"),
)

TRIPS = Table("trips", _TRIP_COLUMNS)

# The text form of a trip file: times are parsed after the scan, because an
# unreadable time becomes NULL while an unreadable number stops the load.
CSV_FIELDS = T.StructType(
    [T.StructField(c.name, STRING if c.dtype == NTZ else c.dtype) for c in _TRIP_COLUMNS]
)

# The raw record of a line that doesn't fit the columns, NULL for all others.
CORRUPT = Column("corrupt_record", STRING, comment="record as delivered, if it could not be read")

# Months come before file months, so that a run lists the months it reads and no others.
LANDING = Table(
    "landing",
    _TRIP_COLUMNS
    + (
        CORRUPT,
        Column("kind", STRING, comment="trip, or corrupt for records that could not be read"),
        Column("started_month", STRING, comment="yyyyMM of the trip start, unknown without one"),
        Column("file_month", STRING, comment="yyyyMM in the source file name"),
    ),
    partition_by="kind",
    then_by=("started_month", "file_month"),
)

RAW = Table(
    "raw_trips",
    _TRIP_COLUMNS
    + (
        Column("source_month", STRING, comment="yyyyMM of the trip start"),
        Column("loaded_at", INSTANT, comment="time of the load"),
        Column("started_date", DATE, comment="day of the trip start; folder key"),
    ),
    partition_by="started_date",
    cluster_by=("member_casual", "rideable_type"),
)

STAGING = Table(
    "trips_clean",
    (
        Column("ride_id", STRING, True, comment="trip identifier, placeholders removed"),
        Column("rideable_type", STRING, True, BIKE_TYPES, "bike kind, trimmed"),
        Column("started_at", NTZ, True, comment="trip start"),
        Column("ended_at", NTZ, True, comment="trip end, never before the start"),
        Column("started_date", DATE, True, comment="day of the start"),
        Column("started_month", DATE, True, comment="first day of the start's month"),
        Column("started_hour", LONG, True, comment="hour of the start, 0 to 23"),
        Column("day_of_week", LONG, True, comment="1 is Sunday, 7 is Saturday"),
        Column("is_weekend", BOOLEAN, True, comment="Saturday or Sunday"),
        Column("start_station_name", STRING, comment="trimmed, blank is NULL"),
        Column("start_station_id", STRING),
        Column("end_station_name", STRING, comment="trimmed, blank is NULL"),
        Column("end_station_id", STRING),
        Column("start_lat", DOUBLE, True),
        Column("start_lng", DOUBLE, True),
        Column("end_lat", DOUBLE, True),
        Column("end_lng", DOUBLE, True),
        Column("member_casual", STRING, True, RIDER_TYPES, "rider kind, trimmed"),
        Column("ride_duration_minutes", DOUBLE, True, comment="whole seconds over 60"),
        Column("ride_distance_km", DOUBLE, True, comment="great circle, start to end"),
        Column("avg_speed_kmh", DOUBLE, comment="NULL when the trip took no time"),
        Column("source_month", STRING, True),
        Column("loaded_at", INSTANT, True),
    ),
    partition_by="started_date",
    cluster_by=("member_casual", "rideable_type", "start_station_id"),
)

_MEASURES = (
    Column("ride_count", LONG, True, comment="trips in the group"),
    Column("avg_ride_duration_minutes", DOUBLE, True),
    Column("avg_ride_distance_km", DOUBLE, True),
    Column("avg_speed_kmh", DOUBLE, comment="mean over trips that took time"),
    Column("unique_start_stations", LONG, True, comment="distinct known start station ids"),
    Column("unique_end_stations", LONG, True, comment="distinct known end station ids"),
)

HOURLY = Table(
    "hourly_usage",
    (
        Column("metric_date", DATE, True),
        Column("started_hour", LONG, True),
        Column("member_casual", STRING),
        Column("rideable_type", STRING),
        Column("is_weekend", BOOLEAN),
        Column("ride_count", LONG, True),
        Column("unique_start_stations", LONG, True),
        Column("unique_end_stations", LONG, True),
        Column("avg_ride_duration_minutes", DOUBLE),
        Column("avg_ride_distance_km", DOUBLE),
        Column("avg_speed_kmh", DOUBLE),
    ),
    partition_by="metric_date",
    cluster_by=("started_hour", "member_casual", "rideable_type"),
)

MONTHLY = Table(
    "monthly_metrics",
    (
        Column("metric_month", DATE, True),
        Column("member_casual", STRING, True),
        Column("rideable_type", STRING, True),
    )
    + _MEASURES,
    partition_by="metric_month",
    cluster_by=("member_casual", "rideable_type"),
)

WEEKLY = Table(
    "weekly_trend",
    (
        Column("day_of_week", LONG, True),
        Column("weekday_name", STRING, True),
        Column("member_casual", STRING, True),
        Column("rideable_type", STRING, True),
    )
    + _MEASURES,
    cluster_by=("day_of_week", "member_casual", "rideable_type"),
)

# Rollups are small, so a folder holds a month of them. Runs replace whole months.
_MONTH = Column("started_month", DATE, comment="first day of the month; folder key")

_SUMS = (
    Column("rides", LONG),
    # Whole units, so that no order of addition changes a sum.
    Column("seconds", LONG, comment="sum of durations"),
    Column("millimetres", LONG, comment="sum of distances, each to the nearest"),
    Column("speed_sum", DOUBLE, comment="km/h, trips that took time"),
    Column("speed_rides", LONG, comment="trips that took time"),
)

# What the daily tables are made from, in one pass over the trips.
TRIP_ROLLUP = Table(
    "trip_rollup",
    (
        _MONTH,
        Column("started_date", DATE),
        Column("started_hour", LONG),
        Column("member_casual", STRING),
        Column("rideable_type", STRING),
        Column("side", STRING, comment="all trips, or those of a start or end station"),
        Column("station_id", STRING),
        Column("station_name", STRING),
        *_SUMS,
    ),
    partition_by="started_month",
    cluster_by=("side", "started_date", "started_hour", "station_id"),
)

USAGE_SUMS = Table(
    "usage_sums",
    (
        _MONTH,
        Column("started_date", DATE),
        Column("started_hour", LONG),
        Column("member_casual", STRING),
        Column("rideable_type", STRING),
        *_SUMS,
    ),
    partition_by="started_month",
    cluster_by=("started_date", "started_hour", "member_casual", "rideable_type"),
)

STATION_VISITS = Table(
    "station_visits",
    (
        _MONTH,
        Column("started_date", DATE),
        Column("member_casual", STRING),
        Column("rideable_type", STRING),
        Column("side", STRING, comment="start or end of the trips counted"),
        Column("station_id", STRING),
        Column("station_name", STRING),
        Column("visits", LONG),
    ),
    partition_by="started_month",
    cluster_by=("side", "station_id"),
)

# Station ids and their places in bitmaps. Numbers are given once and stay.
STATIONS = Table(
    "stations",
    (Column("station_id", STRING), Column("station_no", LONG, comment="from 1, without gaps")),
    cluster_by=("station_no",),
)

STATION_SETS = Table(
    "station_sets",
    (
        _MONTH,
        Column("started_date", DATE),
        Column("member_casual", STRING),
        Column("rideable_type", STRING),
        Column("side", STRING),
        Column("bucket", LONG, comment="bitmap_bucket_number of the stations' numbers"),
        Column("stations", T.BinaryType(), comment="bitmap of the stations visited"),
    ),
    partition_by="started_month",
    cluster_by=("side", "bucket"),
)

CHECKED_TABLES = (STAGING, HOURLY, MONTHLY, WEEKLY)
