"""Monthly page: rides per month and the busiest stations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokeline.functions import range_text, thousands
from spokeline.marts.common import ALL, for_member


def date_range(hourly: DataFrame, monthly: DataFrame) -> DataFrame:
    """Days covered by the hourly report or, when it is empty, months of the monthly one."""
    days = hourly.agg(F.min("metric_date").alias("first"), F.max("metric_date").alias("last"))
    months = monthly.agg(F.min("metric_month").alias("first"), F.max("metric_month").alias("last"))
    ranges = days.withColumn("_rank", F.lit(0)).unionByName(months.withColumn("_rank", F.lit(1)))
    rank = F.when(F.col("first").isNotNull(), F.col("_rank"))
    return ranges.agg(
        F.min_by("first", rank).alias("first_date"), F.min_by("last", rank).alias("last_date")
    ).select("*", range_text(F.col("first_date"), F.col("last_date")).alias("subtitle"))


def kpis(monthly: DataFrame, member: str = ALL) -> DataFrame:
    months = F.countDistinct("metric_month")
    return (
        for_member(monthly, member)
        .agg(months.alias("months_covered"), F.sum("ride_count").alias("_rides"))
        .select(
            "months_covered",
            (F.col("_rides").cast("double") / F.nullif(F.col("months_covered"), F.lit(0))).alias(
                "avg_monthly_rides"
            ),
        )
        .select("*", thousands(F.col("avg_monthly_rides")).alias("monthly_rides_text"))
    )


def _rides_by(monthly: DataFrame, member: str, kind: str) -> DataFrame:
    return (
        for_member(monthly, member)
        .groupBy("metric_month", kind)
        .agg(F.sum("ride_count").alias("total_rides"))
        .orderBy("metric_month", kind)
    )


def rides_by_member(monthly: DataFrame, member: str = ALL) -> DataFrame:
    return _rides_by(monthly, member, "member_casual")


def rides_by_bike(monthly: DataFrame, member: str = ALL) -> DataFrame:
    return _rides_by(monthly, member, "rideable_type")
