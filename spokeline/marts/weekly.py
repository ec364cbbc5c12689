"""Weekly page: mean rides per week by weekday, rider and bike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spokeline.functions import thousands
from spokeline.marts.common import ALL, for_member


def weeks_covered(hourly: DataFrame) -> DataFrame:
    """Calendar weeks between the first and last day, at least one; no filter applies."""
    days = F.datediff(F.max("metric_date"), F.min("metric_date")) + 1
    return hourly.agg(F.greatest(days.cast("double") / 7.0, F.lit(1.0)).alias("n_weeks"))


def _per_week(hourly: DataFrame) -> Column:
    return F.sum("ride_count").cast("double") / weeks_covered(hourly).scalar()


def kpi(weekly: DataFrame, hourly: DataFrame, member: str = ALL) -> DataFrame:
    numbers = for_member(weekly, member).agg(_per_week(hourly).alias("avg_weekly_rides"))
    return numbers.select("*", thousands(F.col("avg_weekly_rides")).alias("weekly_rides_text"))


def _share(weekly: DataFrame, hourly: DataFrame, member: str, kind: str) -> DataFrame:
    rows = for_member(weekly, member)
    return (
        rows.groupBy(kind)
        .agg(F.sum("ride_count").alias("_rides"), _per_week(hourly).alias("avg_rides"))
        .withColumn("share", F.col("_rides") / rows.agg(F.sum("ride_count")).scalar())
        .select(kind, "avg_rides", "share")
        .orderBy(kind)
    )


def member_share(weekly: DataFrame, hourly: DataFrame, member: str = ALL) -> DataFrame:
    return _share(weekly, hourly, member, "member_casual")


def bike_share(weekly: DataFrame, hourly: DataFrame, member: str = ALL) -> DataFrame:
    return _share(weekly, hourly, member, "rideable_type")


def _by_day(weekly: DataFrame, hourly: DataFrame, member: str, kind: str) -> DataFrame:
    return (
        for_member(weekly, member)
        .groupBy("weekday_name", "day_of_week", kind)
        .agg(_per_week(hourly).alias("avg_rides"))
        .orderBy("day_of_week", kind)
    )


def member_by_day(weekly: DataFrame, hourly: DataFrame, member: str = ALL) -> DataFrame:
    return _by_day(weekly, hourly, member, "member_casual")


def bike_by_day(weekly: DataFrame, hourly: DataFrame, member: str = ALL) -> DataFrame:
    return _by_day(weekly, hourly, member, "rideable_type")
