"""Hourly page: demand, duration and distance by hour of day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spokeline.functions import (
    fixed_decimals,
    range_text,
    thousands,
    weighted_avg,
    weighted_avg_known,
)
from spokeline.marts.common import ALL, for_member

_DAYS = "metric_date"


def date_range(hourly: DataFrame) -> DataFrame:
    """First and last day covered."""
    return hourly.agg(F.min(_DAYS).alias("first_date"), F.max(_DAYS).alias("last_date")).select(
        "*", range_text(F.col("first_date"), F.col("last_date")).alias("subtitle")
    )


def kpis(hourly: DataFrame, member: str = ALL) -> DataFrame:
    """Rides per day and the weighted means, as numbers and as shown; NULL without rows."""
    n = F.col("ride_count")
    days = F.nullif(F.countDistinct(_DAYS), F.lit(0))
    numbers = for_member(hourly, member).agg(
        (F.sum(n).cast("double") / days).alias("avg_daily_rides"),
        weighted_avg(F.col("avg_ride_duration_minutes"), n).alias("avg_duration_minutes"),
        weighted_avg(F.col("avg_ride_distance_km"), n).alias("avg_distance_km"),
        weighted_avg_known(F.col("avg_speed_kmh"), n).alias("avg_speed_kmh"),
    )
    return numbers.select(
        "*",
        thousands(F.col("avg_daily_rides")).alias("daily_rides_text"),
        fixed_decimals(F.col("avg_duration_minutes"), 1, "min").alias("duration_text"),
        fixed_decimals(F.col("avg_distance_km"), 2, "km").alias("distance_text"),
        fixed_decimals(F.col("avg_speed_kmh"), 1, "km/h").alias("speed_text"),
    )


def _activity(hourly: DataFrame, member: str, kind: str) -> DataFrame:
    """Mean rides per hour over the days on which the hour and kind occur."""
    return (
        for_member(hourly, member)
        .groupBy("started_hour", kind)
        .agg(
            F.sum("ride_count").alias("total_rides"),
            F.countDistinct(_DAYS).alias("n_days"),
        )
        .withColumn("avg_rides", F.col("total_rides").cast("double") / F.col("n_days"))
        .orderBy("started_hour", kind)
    )


def activity_by_member(hourly: DataFrame, member: str = ALL) -> DataFrame:
    return _activity(hourly, member, "member_casual")


def activity_by_bike(hourly: DataFrame, member: str = ALL) -> DataFrame:
    return _activity(hourly, member, "rideable_type")


def _weighted(measure: str) -> Column:
    return weighted_avg(F.col(measure), F.col("ride_count"))


def duration_by_member(hourly: DataFrame, member: str = ALL) -> DataFrame:
    return (
        for_member(hourly, member)
        .groupBy("started_hour", "member_casual")
        .agg(_weighted("avg_ride_duration_minutes").alias("avg_duration"))
        .orderBy("started_hour", "member_casual")
    )


def distance_by_member(hourly: DataFrame, member: str = ALL) -> DataFrame:
    return (
        for_member(hourly, member)
        .groupBy("started_hour", "member_casual")
        .agg(
            _weighted("avg_ride_distance_km").alias("avg_distance"),
            F.countDistinct(_DAYS).alias("n_days"),
        )
        .orderBy("started_hour", "member_casual")
    )


def weekday_weekend_duration(hourly: DataFrame, member: str = ALL) -> DataFrame:
    """Rides and mean duration on weekdays against weekends."""
    return (
        for_member(hourly, member)
        .groupBy("is_weekend")
        .agg(
            F.sum("ride_count").alias("rides"),
            _weighted("avg_ride_duration_minutes").alias("avg_duration"),
        )
        .orderBy("is_weekend")
    )
