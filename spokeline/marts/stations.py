"""Busiest stations, from clean trips or from the station visits table.

Stations are selected by id and grouped by name: two ids that share a name
count as one, and a blank name forms a group of its own.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spokeline.functions import thousands

SIDES = ("start", "end")


def _check_side(side: str) -> None:
    if side not in SIDES:
        raise ValueError(f"side must be one of {SIDES}, not {side!r}")


def visits_of(trips: DataFrame, side: str) -> DataFrame:
    """Clean trips as visits of one side, one row per trip with a known station."""
    _check_side(side)
    return trips.where(F.col(f"{side}_station_id").isNotNull()).select(
        "started_date",
        F.col(f"{side}_station_name").alias("station_name"),
        F.lit(1).cast("bigint").alias("visits"),
    )


def rolled_visits_of(station_visits: DataFrame, side: str) -> DataFrame:
    """The same from the station visits table, already counted per day."""
    _check_side(side)
    return station_visits.where(F.col("side") == side).select(
        "started_date", "station_name", "visits"
    )


def _busiest_first(measure: str):
    return F.desc(measure), F.asc_nulls_last("station_name")


def top_by_month(visits: DataFrame, limit: int = 10) -> DataFrame:
    """Stations with the most trips per month, averaged over the months a station has trips in."""
    return (
        visits.groupBy("station_name", F.trunc("started_date", "MM").alias("month"))
        .agg(F.sum("visits").alias("monthly_trips"))
        .groupBy("station_name")
        .agg(F.round(F.avg("monthly_trips")).alias("avg_trips"))
        .orderBy(*_busiest_first("avg_trips"))
        .limit(int(limit))
    )


def numbered(top: DataFrame) -> DataFrame:
    """A top list with its rank and formatted trips. The list is short: its limit is the bound."""
    return top.select(
        F.row_number()
        .over(Window.orderBy(*_busiest_first("avg_trips")))
        .cast("bigint")
        .alias("rank"),
        "station_name",
        "avg_trips",
        thousands(F.col("avg_trips"), 1).alias("avg_trips_text"),
    )


def trips_by_year(visits: DataFrame, years: tuple[int, int] = (2024, 2025)) -> DataFrame:
    """Trips per year and station over whole years."""
    day = F.col("started_date")
    inside = (day >= F.lit(date(years[0], 1, 1))) & (day < F.lit(date(years[1] + 1, 1, 1)))
    return (
        visits.where(inside)
        .groupBy(F.year(day).cast("bigint").alias("year"), "station_name")
        .agg(F.sum("visits").alias("trip_count"))
    )


def by_year(visits: DataFrame, years: tuple[int, int] = (2024, 2025)) -> DataFrame:
    """The same, busiest first within a year."""
    return trips_by_year(visits, years).orderBy("year", *_busiest_first("trip_count"))


def top_of_year(stations: DataFrame, limit: int = 10) -> DataFrame:
    """The busiest stations of each year, ranked.

    Spark keeps the first rows of every year inside each task before it
    shuffles them, so a year's stations are never gathered in full.
    """
    order = Window.partitionBy("year").orderBy(*_busiest_first("trip_count"))
    return (
        stations.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= int(limit))
        .select(
            "year",
            F.col("rank").cast("bigint").alias("rank"),
            "station_name",
            "trip_count",
            thousands(F.col("trip_count")).alias("trips_text"),
        )
        .orderBy("year", "rank")
    )
