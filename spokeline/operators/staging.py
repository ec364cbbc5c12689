"""Raw trips to clean trips: normalise text, drop invalid rows, derive measures."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spokeline import schemas
from spokeline.functions import blank_to_null, haversine_km, run_window


def with_lineage(trips: DataFrame) -> DataFrame:
    """Raw table columns: the trip, its month, the load time and the day folder."""
    day = F.to_date("started_at")
    return trips.select(
        *[F.col(c.name).cast(c.dtype) for c in schemas.TRIPS.columns],
        F.date_format(day, "yyyyMM").alias("source_month"),
        F.current_timestamp().alias("loaded_at"),
        day.alias("started_date"),
    )


def landed_in_window(landing: DataFrame, start: date, end: date) -> DataFrame:
    """Landed trips that start inside the run window, whichever file brought them.

    The bounds are on the timestamp itself, so the Parquet scan skips row
    groups of other months by their statistics.
    """
    first, stop = run_window(start, end)
    inside = (F.col("started_at") >= _midnight(first)) & (F.col("started_at") < _midnight(stop))
    return with_lineage(landing.where(inside))


def raw_in_window(raw: DataFrame, start: date, end: date) -> DataFrame:
    """Raw trips of the run window; literal bounds on the folder column prune the scan."""
    first, stop = run_window(start, end)
    day = F.col("started_date")
    return raw.where((day >= F.lit(first)) & (day < F.lit(stop)))


def months_of_run(rollup: DataFrame, start: date, end: date) -> DataFrame:
    """Rows of the run window's months, of a table with a folder per month."""
    first, stop = run_window(start, end)
    month = F.col("started_month")
    return rollup.where((month >= F.lit(first)) & (month < F.lit(stop)))


def standardize(raw: DataFrame) -> DataFrame:
    """Trim names and kinds, blank to NULL. Ids stay as delivered."""
    texts = ("rideable_type", "start_station_name", "end_station_name", "member_casual")
    return raw.withColumns({c: blank_to_null(F.col(c)) for c in texts})


def validity_rules() -> dict[str, Column]:
    """What a trip must satisfy, by the reason given when it does not."""
    lats = [F.col("start_lat"), F.col("end_lat")]
    lngs = [F.col("start_lng"), F.col("end_lng")]
    present = [c.isNotNull() for c in lats + lngs]
    # NaN compares above every number, so it counts as out of range.
    inside = [F.abs(c) <= 90.0 for c in lats] + [F.abs(c) <= 180.0 for c in lngs]
    return {
        "placeholder_id": F.col("ride_id") != "nan",
        "ends_before_start": F.col("ended_at") >= F.col("started_at"),
        "missing_coordinates": _all(present),
        "coordinates_out_of_range": _all(inside),
    }


def valid(trips: DataFrame) -> DataFrame:
    return trips.where(_all(validity_rules().values()))


def reject_reason() -> Column:
    """First rule a trip breaks, NULL for a valid trip. A rule that is NULL counts as broken."""
    reasons = [
        F.when(~F.coalesce(rule, F.lit(False)), F.lit(reason))
        for reason, rule in validity_rules().items()
    ]
    return F.coalesce(*reasons)


def rejected_by_reason(raw: DataFrame) -> DataFrame:
    """Trips the cleaning drops, counted by reason."""
    return (
        raw.select(reject_reason().alias("reject_reason"))
        .where(F.col("reject_reason").isNotNull())
        .groupBy("reject_reason")
        .agg(F.count("*").alias("rejected_rows"))
        .orderBy("reject_reason")
    )


def enrich(trips: DataFrame) -> DataFrame:
    """Calendar parts, duration, distance and speed."""
    day = F.to_date("started_at")
    weekday = F.dayofweek(day)
    # Interval division counts whole seconds and ignores the session time zone.
    seconds = F.expr("(ended_at - started_at) div interval '1' second").cast("double")
    distance = haversine_km(
        F.col("start_lat"), F.col("start_lng"), F.col("end_lat"), F.col("end_lng")
    )
    return trips.withColumns({"_seconds": seconds, "ride_distance_km": distance}).withColumns(
        {
            "started_date": day,
            "started_month": F.trunc(day, "MM"),
            "started_hour": F.hour("started_at").cast("bigint"),
            "day_of_week": weekday.cast("bigint"),
            "is_weekend": weekday.isin(1, 7),
            "ride_duration_minutes": F.col("_seconds") / 60.0,
            "avg_speed_kmh": F.when(
                F.col("_seconds") > 0, F.col("ride_distance_km") / (F.col("_seconds") / 3600.0)
            ),
        }
    )


def clean(raw: DataFrame, start: date, end: date) -> DataFrame:
    """Staging rows of a run window."""
    return (
        raw.transform(raw_in_window, start, end)
        .transform(standardize)
        .transform(valid)
        .transform(enrich)
        .select(*schemas.STAGING.names)
    )


def _all(conditions) -> Column:
    conditions = list(conditions)
    result = conditions[0]
    for c in conditions[1:]:
        result = result & c
    return result


def _midnight(day: date) -> Column:
    return F.lit(day).cast("timestamp_ntz")
