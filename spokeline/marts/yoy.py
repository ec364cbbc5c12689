"""Year-over-year page: two years compared month by month."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spokeline.functions import (
    fixed_decimals,
    month_label,
    pct_change,
    pct_text,
    thousands,
    weighted_avg,
    weighted_avg_known,
)
from spokeline.marts.common import ALL, for_member

YEARS = (2024, 2025)


def compared_months(report: DataFrame, years: tuple[int, int] = YEARS) -> DataFrame:
    """Monthly report of the compared years with year and month apart; base of this page.

    Left unordered, since the data sets below aggregate it again.
    """
    month, n = F.col("metric_month"), F.col("ride_count")
    first, stop = date(years[0], 1, 1), date(years[1] + 1, 1, 1)
    return (
        report.where((month >= F.lit(first)) & (month < F.lit(stop)))
        .groupBy(
            F.year(month).cast("bigint").alias("year"),
            F.month(month).cast("bigint").alias("month"),
            "member_casual",
            "rideable_type",
        )
        .agg(
            F.sum(n).alias("ride_count"),
            weighted_avg(F.col("avg_ride_duration_minutes"), n).alias("avg_ride_duration_minutes"),
            weighted_avg(F.col("avg_ride_distance_km"), n).alias("avg_ride_distance_km"),
            weighted_avg_known(F.col("avg_speed_kmh"), n).alias("avg_speed_kmh"),
        )
    )


def monthly(report: DataFrame, years: tuple[int, int] = YEARS) -> DataFrame:
    """The compared months in order."""
    return compared_months(report, years).orderBy(
        "year", "month", "member_casual", "rideable_type"
    )


def _weighted(measure: str) -> Column:
    return weighted_avg(F.col(measure), F.col("ride_count"))


def yearly(yoy: DataFrame, member: str = ALL) -> DataFrame:
    return (
        for_member(yoy, member)
        .groupBy("year")
        .agg(
            F.sum("ride_count").alias("total_rides"),
            _weighted("avg_ride_duration_minutes").alias("avg_duration"),
            _weighted("avg_ride_distance_km").alias("avg_distance"),
            F.countDistinct("month").alias("months_covered"),
        )
        .orderBy("year")
    )


def _month_totals(yoy: DataFrame, member: str) -> DataFrame:
    return (
        for_member(yoy, member).groupBy("year", "month").agg(F.sum("ride_count").alias("rides"))
    )


def peak_month(yoy: DataFrame, member: str = ALL) -> DataFrame:
    """Busiest month of each year; the earlier one of equals."""
    order = F.struct(F.col("rides"), -F.col("month"))
    return (
        _month_totals(yoy, member)
        .groupBy("year")
        .agg(F.max_by("month", order).alias("month"), F.max("rides").alias("rides"))
        .orderBy("year")
    )


def _of_year(year: int, measure: str) -> Column:
    """A year's value out of one row per year, 0 when the year has no rows."""
    return F.coalesce(F.max(F.when(F.col("year") == year, F.col(measure))), F.lit(0))


def stats(yoy: DataFrame, member: str = ALL, years: tuple[int, int] = YEARS) -> DataFrame:
    """The four headline figures of both years, as numbers and as shown."""
    old, new = years
    per_month = (
        for_member(yoy, member)
        .groupBy("year", "month")
        .agg(
            F.sum("ride_count").alias("rides"),
            F.sum(F.col("avg_ride_duration_minutes") * F.col("ride_count")).alias("minutes"),
            F.sum(F.col("avg_ride_distance_km") * F.col("ride_count")).alias("km"),
        )
    )
    per_year = per_month.groupBy("year").agg(
        F.sum("rides").alias("total"),
        F.max("rides").alias("peak"),
        (F.sum("minutes") / F.sum("rides")).alias("duration"),
        (F.sum("km") / F.sum("rides")).alias("distance"),
    )
    measures = {
        "total": ("Total Rides", lambda c: thousands(c)),
        "peak": ("Peak Month Rides", lambda c: thousands(c)),
        "duration": ("Avg Duration (min)", lambda c: fixed_decimals(c, 1)),
        "distance": ("Avg Distance (km)", lambda c: fixed_decimals(c, 2)),
    }
    one_row = per_year.agg(
        *[_of_year(y, m).cast("double").alias(f"{m}_{i}") for m in measures for i, y in enumerate(years)]
    )
    cards = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(label).alias("label"),
            F.col(f"{m}_0").alias(f"value_{old}"),
            F.col(f"{m}_1").alias(f"value_{new}"),
            shown(F.col(f"{m}_0")).alias(f"text_{old}"),
            shown(F.col(f"{m}_1")).alias(f"text_{new}"),
            pct_text(F.col(f"{m}_0"), F.col(f"{m}_1")).alias("change_text"),
        )
        for position, (m, (label, shown)) in enumerate(measures.items(), start=1)
    ]
    return one_row.select(F.inline(F.array(*cards))).orderBy("position")


def subtitle(yoy: DataFrame, member: str = ALL, years: tuple[int, int] = YEARS) -> DataFrame:
    """How many months of data each year has."""
    old, new = years
    covered = for_member(yoy, member).agg(
        *[
            F.countDistinct(F.when(F.col("year") == y, F.col("month"))).alias(f"months_{y}")
            for y in years
        ]
    )
    text = F.concat(
        F.lit(f"{old}: "), F.col(f"months_{old}"), F.lit(" months of data  |  "),
        F.lit(f"{new}: "), F.col(f"months_{new}"), F.lit(" months of data"),
    )
    return covered.select("*", text.alias("subtitle"))


def month_rides(yoy: DataFrame, member: str = ALL) -> DataFrame:
    return (
        _month_totals(yoy, member)
        .withColumn("month_label", month_label(F.col("month")))
        .orderBy("year", "month")
    )


def change(yoy: DataFrame, member: str = ALL, years: tuple[int, int] = YEARS) -> DataFrame:
    """Rides of both years side by side per month, and the change in percent.

    A year without any row counts 0 rides in every month; a month missing
    from a year that has others stays unknown.
    """
    rides = [f"rides_{y}" for y in years]
    table = (
        for_member(yoy, member)
        .groupBy("month")
        .pivot("year", list(years))
        .agg(F.sum("ride_count"))
        .withColumnsRenamed({str(y): r for y, r in zip(years, rides)})
    )
    # At most twelve rows, one per month, so one task may see them all.
    every_month = Window.partitionBy()
    seen = {r: F.count(r).over(every_month) > 0 for r in rides}
    return (
        table.withColumns(
            {r: F.when(seen[r], F.col(r)).otherwise(F.lit(0).cast("bigint")) for r in rides}
        )
        .withColumn("yoy_pct", pct_change(F.col(rides[0]), F.col(rides[1])))
        .withColumn("month_label", month_label(F.col("month")))
        .orderBy("month")
    )


def _rides_by(yoy: DataFrame, member: str, kind: str) -> DataFrame:
    return (
        for_member(yoy, member)
        .groupBy("year", kind)
        .agg(F.sum("ride_count").alias("rides"))
        .orderBy("year", kind)
    )


def rides_by_member(yoy: DataFrame, member: str = ALL) -> DataFrame:
    return _rides_by(yoy, member, "member_casual")


def rides_by_bike(yoy: DataFrame, member: str = ALL) -> DataFrame:
    return _rides_by(yoy, member, "rideable_type")


def _by_month(yoy: DataFrame, member: str, measure: str, name: str) -> DataFrame:
    return (
        for_member(yoy, member)
        .groupBy("year", "month")
        .agg(_weighted(measure).alias(name))
        .withColumn("month_label", month_label(F.col("month")))
        .orderBy("year", "month")
    )


def duration_by_month(yoy: DataFrame, member: str = ALL) -> DataFrame:
    return _by_month(yoy, member, "avg_ride_duration_minutes", "avg_duration")


def distance_by_month(yoy: DataFrame, member: str = ALL) -> DataFrame:
    return _by_month(yoy, member, "avg_ride_distance_km", "avg_distance")
