"""DuckDB SQL for each query, written from the definitions and not from the Spark code.

Doubles are rounded the way ``registry.rounded`` explains; durations and distances of reports are
not rounded at all, as their sums are whole numbers.
"""

from __future__ import annotations

TRIPS = """
trips AS (
  SELECT
    CASE WHEN event_id % 97 = 0 THEN 'nan' ELSE 'R' || event_id END AS ride_id,
    CASE WHEN event_type IN ('click', 'purchase', 'view') THEN ' electric_bike '
         WHEN event_type = 'error' AND event_id % 50 = 0 THEN '  '
         ELSE 'classic_bike' END AS rideable_type,
    ts + to_months(CAST(event_id % 26 AS INTEGER)) AS started_at,
    ts + to_months(CAST(event_id % 26 AS INTEGER)) + to_seconds(
      CASE WHEN event_id % 89 = 0 THEN -60 WHEN event_id % 83 = 0 THEN 0
           ELSE CAST(floor(value * 12) AS BIGINT) END) AS ended_at,
    CASE WHEN user_id % 40 = 7 THEN '' ELSE ' Station ' || (user_id % 40) || ' ' END
      AS start_station_name,
    CASE WHEN user_id % 40 <> 9 THEN 'S' || (user_id % 40) END AS start_station_id,
    CASE WHEN event_id % 40 = 7 THEN '' ELSE ' Station ' || (event_id % 40) || ' ' END
      AS end_station_name,
    CASE WHEN event_id % 40 <> 9 THEN 'S' || (event_id % 40) END AS end_station_id,
    CASE WHEN event_id % 101 <> 0
         THEN 40.65::DOUBLE + 0.004::DOUBLE * (user_id % 40)::DOUBLE END AS start_lat,
    (-74.02)::DOUBLE + 0.003::DOUBLE * (user_id % 40)::DOUBLE AS start_lng,
    CASE WHEN event_id % 103 = 0 THEN 95.0::DOUBLE
         ELSE 40.65::DOUBLE + 0.004::DOUBLE * (event_id % 40)::DOUBLE END AS end_lat,
    (-74.02)::DOUBLE + 0.003::DOUBLE * (event_id % 40)::DOUBLE AS end_lng,
    CASE WHEN user_id % 5 = 0 THEN 'casual' ELSE ' member' END AS member_casual
  FROM events
),
raw AS (
  SELECT *, strftime(started_at, '%Y%m') AS source_month, CAST(started_at AS DATE) AS started_date
  FROM trips
)"""

_CLEAN = """
{name}_params AS (
  SELECT date_trunc('month', DATE '{start}' - INTERVAL 1 MONTH)::DATE AS first_day,
         date_trunc('month', DATE '{end}')::DATE AS stop_day
),
{name} AS (
  SELECT
    ride_id, rideable_type, started_at, ended_at,
    CAST(started_at AS DATE) AS started_date,
    date_trunc('month', started_at)::DATE AS started_month,
    hour(started_at)::BIGINT AS started_hour,
    (dayofweek(started_at) + 1)::BIGINT AS day_of_week,
    dayofweek(started_at) IN (0, 6) AS is_weekend,
    start_station_name, start_station_id, end_station_name, end_station_id,
    start_lat, start_lng, end_lat, end_lng, member_casual,
    seconds / 60.0::DOUBLE AS ride_duration_minutes,
    km AS ride_distance_km,
    CASE WHEN seconds > 0 THEN km / (seconds / 3600.0::DOUBLE) END AS avg_speed_kmh,
    source_month, seconds::BIGINT AS seconds, floor(km * 1e6::DOUBLE + 0.5::DOUBLE)::BIGINT AS millimetres
  FROM (
    SELECT * REPLACE (
        nullif(trim(rideable_type), '') AS rideable_type,
        nullif(trim(start_station_name), '') AS start_station_name,
        nullif(trim(end_station_name), '') AS end_station_name,
        nullif(trim(member_casual), '') AS member_casual),
      date_sub('second', started_at, ended_at)::DOUBLE AS seconds,
      2 * 6371.01::DOUBLE * asin(sqrt(least(1.0::DOUBLE,
        power(sin(radians(end_lat - start_lat) / 2), 2)
        + cos(radians(start_lat)) * cos(radians(end_lat))
          * power(sin(radians(end_lng - start_lng) / 2), 2)))) AS km
    FROM raw CROSS JOIN {name}_params
    WHERE started_date >= first_day AND started_date < stop_day
      AND ride_id <> 'nan' AND ended_at >= started_at
      AND start_lat IS NOT NULL AND start_lng IS NOT NULL
      AND end_lat IS NOT NULL AND end_lng IS NOT NULL
      AND abs(start_lat) <= 90 AND abs(end_lat) <= 90
      AND abs(start_lng) <= 180 AND abs(end_lng) <= 180
  )
)"""

STAGING = _CLEAN.format(name="staging", start="2024-02-15", end="2026-03-15")
NARROW = _CLEAN.format(name="narrow", start="2025-02-15", end="2025-04-15")

_MEASURES = """
    count(*) AS ride_count,
    count(DISTINCT start_station_id) AS unique_start_stations,
    count(DISTINCT end_station_id) AS unique_end_stations,
    sum(seconds)::BIGINT / 60.0::DOUBLE / count(*) AS avg_ride_duration_minutes,
    sum(millimetres)::BIGINT / 1e6::DOUBLE / count(*) AS avg_ride_distance_km,
    avg(avg_speed_kmh) AS avg_speed_kmh"""

_WEEKDAY = """CASE day_of_week WHEN 1 THEN 'Sunday' WHEN 2 THEN 'Monday' WHEN 3 THEN 'Tuesday'
      WHEN 4 THEN 'Wednesday' WHEN 5 THEN 'Thursday' WHEN 6 THEN 'Friday'
      WHEN 7 THEN 'Saturday' END"""

HOURLY = f"""
hourly AS (
  SELECT started_date AS metric_date, started_hour, member_casual, rideable_type, is_weekend,
{_MEASURES}
  FROM staging GROUP BY ALL
)"""

WEEKLY = f"""
weekly AS (
  SELECT day_of_week, {_WEEKDAY} AS weekday_name, member_casual, rideable_type,
{_MEASURES}
  FROM staging GROUP BY ALL
),
weeks AS (
  SELECT greatest((max(metric_date) - min(metric_date) + 1) / 7.0::DOUBLE, 1.0::DOUBLE) AS n_weeks
  FROM hourly
)"""

MONTHLY = f"""
monthly AS (
  SELECT started_month AS metric_month, member_casual, rideable_type,
{_MEASURES}
  FROM staging GROUP BY ALL
)"""

# A month's totals come back from its averages times its rides, as the page has nothing else.
YOY = """
months_of_pair AS (
  SELECT extract(year FROM metric_month)::BIGINT AS year, extract(month FROM metric_month)::BIGINT AS month,
    member_casual, rideable_type, ride_count::DOUBLE AS n,
    n * avg_ride_duration_minutes AS minutes, n * avg_ride_distance_km AS km,
    n * avg_speed_kmh AS speed, CASE WHEN avg_speed_kmh IS NULL THEN 0 ELSE n END AS n_speed
  FROM monthly WHERE year BETWEEN {old} AND {new}
),
yoy AS (
  SELECT year, month, member_casual, rideable_type, sum(n)::BIGINT AS ride_count,
    sum(minutes) / sum(n) AS avg_ride_duration_minutes, sum(km) / sum(n) AS avg_ride_distance_km,
    coalesce(sum(speed), 0) / nullif(sum(n_speed), 0) AS avg_speed_kmh
  FROM months_of_pair GROUP BY year, month, member_casual, rideable_type
)"""

_LABELS = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'][month]"

_STAGING_COLUMNS = """
  ride_id, rideable_type, started_at, ended_at, started_date, started_month, started_hour,
  day_of_week, is_weekend, start_station_name, start_station_id, end_station_name, end_station_id,
  start_lat, start_lng, end_lat, end_lng, member_casual,
  round(ride_duration_minutes + 1e-9, 6) AS ride_duration_minutes,
  round(ride_distance_km + 1e-9, 6) AS ride_distance_km,
  round(avg_speed_kmh + 1e-9, 6) AS avg_speed_kmh, source_month"""

_TRIP_COLUMNS = """
  ride_id, rideable_type, started_at, ended_at, {texts},
  start_lat, start_lng, end_lat, end_lng, member_casual"""
_STATIONS = "start_station_name, start_station_id, end_station_name, end_station_id"
_RAW_COLUMNS = _TRIP_COLUMNS.format(texts=_STATIONS) + ", source_month, started_date"

_REPORT_MEASURES = """ride_count, unique_start_stations, unique_end_stations,
  avg_ride_duration_minutes, avg_ride_distance_km,
  round(avg_speed_kmh + 1e-9, 6) AS avg_speed_kmh"""


# Trips moved to days 1, 11, 21 and 31, for the tables with a folder per day.
_BACK = "to_days(CAST((day(started_at) - 1) % 10 AS INTEGER))"
MOVED = TRIPS.replace(
    "FROM trips",
    f"FROM (SELECT * REPLACE (started_at - {_BACK} AS started_at, ended_at - {_BACK} AS ended_at) FROM trips)",
)


def _with(*tables: str, select: str, trips: str = TRIPS) -> str:
    return "WITH " + ",".join((trips, *tables)) + "\n" + select


def _hourly(select: str) -> str:
    return _with(STAGING, HOURLY, select=select)


def _weekly(select: str) -> str:
    return _with(STAGING, HOURLY, WEEKLY, select=select)


def _monthly(select: str) -> str:
    return _with(STAGING, HOURLY, MONTHLY, select=select)


def _yoy(select: str, old: int = 2024, new: int = 2025) -> str:
    return _with(STAGING, MONTHLY, YOY.format(old=old, new=new), select=select)


def _staging(select: str) -> str:
    return _with(STAGING, select=select)


_HOURLY_REPORT = f"""
SELECT metric_date, started_hour, member_casual, rideable_type, is_weekend, {_REPORT_MEASURES}
FROM hourly"""
_WEEKLY_REPORT = f"""
SELECT day_of_week, weekday_name, member_casual, rideable_type, {_REPORT_MEASURES} FROM weekly"""
_MONTHLY_REPORT = f"""
SELECT metric_month, member_casual, rideable_type, {_REPORT_MEASURES} FROM monthly"""


def _top(side: str) -> str:
    return f"""
SELECT station_name, round(trips / n_months::DOUBLE) AS avg_trips
FROM (
  SELECT {side}_station_name AS station_name, count(*) AS trips, count(DISTINCT started_month) AS n_months
  FROM staging WHERE {side}_station_id IS NOT NULL GROUP BY {side}_station_name
)
ORDER BY avg_trips DESC, station_name ASC NULLS LAST LIMIT 10"""


def _by_year(side: str) -> str:
    return f"""
SELECT year(started_at)::BIGINT AS year, {side}_station_name AS station_name,
  count(*) AS trip_count
FROM staging
WHERE {side}_station_id IS NOT NULL
  AND started_at >= TIMESTAMP '2024-01-01' AND started_at < TIMESTAMP '2026-01-01'
GROUP BY ALL"""


def _year_table(side: str) -> str:
    return f"""
SELECT year, rank, station_name, trip_count, format('{{:,}}', trip_count) AS trips_text
FROM (
  SELECT *, row_number() OVER (
    PARTITION BY year ORDER BY trip_count DESC, station_name ASC NULLS LAST)::BIGINT AS rank
  FROM ({_by_year(side)})
) WHERE rank <= 10"""


def _kpis(where: str = "") -> str:
    return f"""
SELECT *, format('{{:,}}', CAST(round_even(avg_daily_rides, 0) AS BIGINT)) AS daily_rides_text,
  printf('%.1f', avg_duration_minutes) || ' min' AS duration_text,
  printf('%.2f', avg_distance_km) || ' km' AS distance_text,
  printf('%.1f', avg_speed_kmh) || ' km/h' AS speed_text
FROM (
  SELECT
    round(sum(ride_count) / count(DISTINCT metric_date) + 1e-9, 6) AS avg_daily_rides,
    round(sum(avg_ride_duration_minutes * ride_count) / sum(ride_count) + 1e-9, 6)
      AS avg_duration_minutes,
    round(sum(avg_ride_distance_km * ride_count) / sum(ride_count) + 1e-9, 6) AS avg_distance_km,
    round(sum(avg_speed_kmh * ride_count)
      / sum(ride_count) FILTER (avg_speed_kmh IS NOT NULL) + 1e-9, 6) AS avg_speed_kmh
  FROM hourly {where}
)"""


def _activity(kind: str, where: str = "") -> str:
    return f"""
SELECT started_hour, {kind}, sum(ride_count)::BIGINT AS total_rides,
  count(DISTINCT metric_date) AS n_days,
  round(sum(ride_count) / count(DISTINCT metric_date) + 1e-9, 6) AS avg_rides
FROM hourly {where} GROUP BY ALL"""


def _share(kind: str, where: str = "") -> str:
    return f"""
SELECT {kind}, round(sum(ride_count) / any_value(n_weeks) + 1e-9, 6) AS avg_rides,
  round(sum(ride_count) / (SELECT sum(ride_count) FROM weekly {where}) + 1e-9, 6) AS share
FROM weekly CROSS JOIN weeks {where} GROUP BY {kind}"""


def _by_day(kind: str) -> str:
    return f"""
SELECT weekday_name, day_of_week, {kind},
  round(sum(ride_count) / any_value(n_weeks) + 1e-9, 6) AS avg_rides
FROM weekly CROSS JOIN weeks GROUP BY weekday_name, day_of_week, {kind}"""


def _stats(where: str = "", old: int = 2024, new: int = 2025) -> str:
    return f"""
, years AS (
  SELECT year, sum(ride_count)::DOUBLE AS total,
    sum(avg_ride_duration_minutes * ride_count) / sum(ride_count) AS duration,
    sum(avg_ride_distance_km * ride_count) / sum(ride_count) AS distance
  FROM yoy {where} GROUP BY year
),
peaks AS (
  SELECT year, max(rides)::DOUBLE AS peak
  FROM (SELECT year, month, sum(ride_count) AS rides FROM yoy {where} GROUP BY ALL)
  GROUP BY year
),
cards AS (
  SELECT 1 AS position, 'Total Rides' AS label, year, total AS v FROM years
  UNION ALL SELECT 2, 'Peak Month Rides', year, peak FROM peaks
  UNION ALL SELECT 3, 'Avg Duration (min)', year, duration FROM years
  UNION ALL SELECT 4, 'Avg Distance (km)', year, distance FROM years
),
pairs AS (
  SELECT position, label,
    coalesce(max(v) FILTER (year = {old}), 0) AS a, coalesce(max(v) FILTER (year = {new}), 0) AS b
  FROM cards GROUP BY position, label
)
SELECT position, label, round(a + 1e-9, 6) AS value_{old}, round(b + 1e-9, 6) AS value_{new},
  CASE WHEN position <= 2 THEN format('{{:,}}', a::BIGINT)
       WHEN position = 3 THEN printf('%.1f', a) ELSE printf('%.2f', a) END AS text_{old},
  CASE WHEN position <= 2 THEN format('{{:,}}', b::BIGINT)
       WHEN position = 3 THEN printf('%.1f', b) ELSE printf('%.2f', b) END AS text_{new},
  CASE WHEN a = 0 THEN 'N/A' ELSE
    CASE WHEN (b - a) / a * 100 >= 0 THEN '+' ELSE '' END || printf('%.1f', (b - a) / a * 100)
    || '%' END AS change_text
FROM pairs"""


def _change(old: int, new: int) -> str:
    return f"""
SELECT month, rides_{old}, rides_{new},
  round(CASE WHEN rides_{old} > 0 THEN (rides_{new} - rides_{old}) / rides_{old}::DOUBLE * 100 END + 1e-9, 6)
    AS yoy_pct, {_LABELS} AS month_label
FROM (
  SELECT month,
    CASE WHEN bool_or(coalesce(bool_or(year = {old}), false)) OVER () THEN sum(ride_count) FILTER (year = {old})
         ELSE 0 END::BIGINT AS rides_{old},
    CASE WHEN bool_or(coalesce(bool_or(year = {new}), false)) OVER () THEN sum(ride_count) FILTER (year = {new})
         ELSE 0 END::BIGINT AS rides_{new}
  FROM yoy GROUP BY month
)"""


# Trips as they are delivered in files: which records can't be read, and which file they come in.
_DELIVERED = """delivered AS (
  SELECT *, ride_id LIKE '%71' OR ride_id LIKE '%73' AS wordy, ride_id LIKE '%59' AS cut_short,
    strftime(CASE WHEN ride_id LIKE '%3' AND started_at < TIMESTAMP '2026-02-01' THEN started_at + INTERVAL 1 MONTH
                  ELSE started_at END, '%Y%m') AS file_month
  FROM raw)"""


def _checks() -> str:
    required = {
        "trips_clean": (
            "staging",
            "ride_id rideable_type started_at ended_at started_date started_month started_hour "
            "day_of_week is_weekend start_lat start_lng end_lat end_lng member_casual "
            "ride_duration_minutes ride_distance_km source_month",
        ),
        "hourly_usage": (
            "hourly",
            "metric_date started_hour ride_count unique_start_stations unique_end_stations",
        ),
        "monthly_metrics": (
            "monthly",
            "metric_month member_casual rideable_type ride_count avg_ride_duration_minutes "
            "avg_ride_distance_km unique_start_stations unique_end_stations",
        ),
        "weekly_trend": (
            "weekly",
            "day_of_week weekday_name member_casual rideable_type ride_count "
            "avg_ride_duration_minutes avg_ride_distance_km unique_start_stations "
            "unique_end_stations",
        ),
    }
    rows = [
        (name, table, column, "not_null", f"{column} IS NULL")
        for name, (table, columns) in required.items()
        for column in columns.split()
    ]
    # The load time is not part of these tables; it is never NULL.
    rows.append(("trips_clean", "staging", "loaded_at", "not_null", "false"))
    for column, values in (
        ("rideable_type", "'classic_bike', 'electric_bike'"),
        ("member_casual", "'member', 'casual'"),
    ):
        rows.append(("trips_clean", "staging", column, "accepted_values", f"{column} NOT IN ({values})"))
    selects = [
        f"SELECT '{name}' AS table_name, '{column}' AS column_name, '{check}' AS check_name, "
        f"count(*) FILTER ({bad}) AS failing_rows FROM {table}"
        for name, table, column, check, bad in rows
    ]
    return "SELECT *, failing_rows = 0 AS passed FROM (" + " UNION ALL ".join(selects) + ")"


def oracle_sql() -> dict[str, str]:
    sql = {
        "staging_clean": _staging(f"SELECT {_STAGING_COLUMNS} FROM staging"),
        "raw_window": _with(
            NARROW,
            select=f"SELECT {_RAW_COLUMNS} FROM raw CROSS JOIN narrow_params "
            "WHERE started_date >= first_day AND started_date < stop_day",
        ),
        "rejected_by_reason": _with(
            select="""
SELECT reject_reason, count(*) AS rejected_rows FROM (
  SELECT CASE WHEN ride_id IS NULL OR ride_id = 'nan' THEN 'placeholder_id'
    WHEN ended_at IS NULL OR ended_at < started_at THEN 'ends_before_start'
    WHEN start_lat IS NULL OR start_lng IS NULL OR end_lat IS NULL OR end_lng IS NULL
      THEN 'missing_coordinates'
    WHEN abs(start_lat) > 90 OR abs(end_lat) > 90 OR abs(start_lng) > 180 OR abs(end_lng) > 180
      THEN 'coordinates_out_of_range' END AS reject_reason
  FROM trips) WHERE reject_reason IS NOT NULL GROUP BY ALL"""
        ),
        "quality_checks": _with(STAGING, HOURLY, WEEKLY, MONTHLY, select=_checks()),
        "months_in_window": """
SELECT strftime(unnest(generate_series(
    date_trunc('month', min(ts)::DATE - INTERVAL 1 MONTH),
    date_trunc('month', max(ts)::DATE + INTERVAL 26 MONTH) - INTERVAL 1 MONTH,
    INTERVAL 1 MONTH)), '%Y%m') AS month
FROM events""",
        "month_labels": _staging(
            f"SELECT month, {_LABELS} AS month_label "
            "FROM (SELECT DISTINCT month(started_at)::BIGINT AS month FROM staging)"
        ),
        "csv_scan": _with(select=f"SELECT {_TRIP_COLUMNS.format(texts=_STATIONS)} FROM trips"),
        "window_replace": _with(select=f"SELECT {_RAW_COLUMNS} FROM raw"),
        "delete_insert": _staging(f"SELECT {_STAGING_COLUMNS} FROM staging"),
        "full_refresh": _with(NARROW, select=f"SELECT {_STAGING_COLUMNS} FROM narrow"),
        "refreshed_after_correction": _with(
            STAGING,
            "corrected AS (SELECT * FROM staging WHERE day(started_date) <> 11)",
            HOURLY.replace("FROM staging", "FROM corrected"),
            select=_HOURLY_REPORT,
            trips=MOVED,
        ),
        "refreshed_hourly_report": _with(STAGING, HOURLY, select=_HOURLY_REPORT, trips=MOVED),
        "refreshed_weekly_report": _with(
            STAGING, HOURLY, WEEKLY, select=_WEEKLY_REPORT, trips=MOVED
        ),
        "refreshed_monthly_report": _with(
            STAGING, HOURLY, MONTHLY, select=_MONTHLY_REPORT, trips=MOVED
        ),
        "raw_lineage": _with(
            select="SELECT source_month, count(*) AS trips, true AS stamped FROM raw GROUP BY source_month"
        ),
        "hourly_report": _hourly(_HOURLY_REPORT),
        "weekly_report": _weekly(_WEEKLY_REPORT),
        "monthly_report": _monthly(_MONTHLY_REPORT),
        "top_stations_start": _staging(_top("start")),
        "top_stations_end": _staging(_top("end")),
        "station_table": _staging(
            "SELECT row_number() OVER (ORDER BY avg_trips DESC, station_name ASC NULLS LAST)"
            "::BIGINT AS rank, station_name, avg_trips, "
            "format('{:,}', avg_trips::BIGINT) || '.0' AS avg_trips_text "
            f"FROM ({_top('start')})"
        ),
        "yoy_top_stations_start": _staging(_by_year("start")),
        "yoy_top_stations_end": _staging(_by_year("end")),
        "yoy_station_table": _staging(_year_table("start")),
        "yoy_station_table_end": _staging(_year_table("end")),
        "hourly_date_range": _hourly(
            "SELECT min(metric_date) AS first_date, max(metric_date) AS last_date, "
            "'Data range: ' || min(metric_date) || ' – ' || max(metric_date) AS subtitle "
            "FROM hourly"
        ),
        "member_options": _hourly(
            "SELECT 0::INTEGER AS position, 'All' AS option "
            "UNION SELECT 1, member_casual FROM hourly"
        ),
        "hourly_kpis": _hourly(_kpis()),
        "hourly_kpis_casual": _hourly(_kpis("WHERE member_casual = 'casual'")),
        "hourly_activity_by_member": _hourly(_activity("member_casual")),
        "hourly_activity_by_bike": _hourly(_activity("rideable_type")),
        "hourly_activity_by_bike_member": _hourly(
            _activity("rideable_type", "WHERE member_casual = 'member'")
        ),
        "hourly_duration_by_member": _hourly(
            "SELECT started_hour, member_casual, "
            "round(sum(avg_ride_duration_minutes * ride_count) / sum(ride_count) + 1e-9, 6) "
            "AS avg_duration FROM hourly GROUP BY ALL"
        ),
        "hourly_distance_by_member": _hourly(
            "SELECT started_hour, member_casual, "
            "round(sum(avg_ride_distance_km * ride_count) / sum(ride_count) + 1e-9, 6) AS avg_distance, "
            "count(DISTINCT metric_date) AS n_days FROM hourly GROUP BY ALL"
        ),
        "weekday_weekend_duration": _hourly(
            "SELECT is_weekend, sum(ride_count)::BIGINT AS rides, "
            "round(sum(avg_ride_duration_minutes * ride_count) / sum(ride_count) + 1e-9, 6) "
            "AS avg_duration FROM hourly GROUP BY ALL"
        ),
        "weeks_covered": _weekly("SELECT round(n_weeks + 1e-9, 6) AS n_weeks FROM weeks"),
        "weekly_kpi": _weekly(
            "SELECT avg_weekly_rides, format('{:,}', CAST(round_even(avg_weekly_rides, 0) AS "
            "BIGINT)) AS weekly_rides_text FROM (SELECT round(sum(ride_count) "
            "/ any_value(n_weeks) + 1e-9, 6) AS avg_weekly_rides FROM weekly CROSS JOIN weeks)"
        ),
        "weekly_member_share": _weekly(_share("member_casual")),
        "weekly_bike_share": _weekly(_share("rideable_type")),
        "weekly_bike_share_casual": _weekly(
            _share("rideable_type", "WHERE member_casual = 'casual'")
        ),
        "weekly_member_by_day": _weekly(_by_day("member_casual")),
        "weekly_bike_by_day": _weekly(_by_day("rideable_type")),
        "monthly_date_range": _monthly(
            "SELECT a AS first_date, b AS last_date, "
            "'Data range: ' || a || ' – ' || b AS subtitle FROM (SELECT "
            "coalesce((SELECT min(metric_date) FROM hourly), (SELECT min(metric_month) FROM "
            "monthly)) AS a, coalesce((SELECT max(metric_date) FROM hourly), "
            "(SELECT max(metric_month) FROM monthly)) AS b)"
        ),
        "monthly_kpis": _monthly(
            "SELECT months_covered, avg_monthly_rides, format('{:,}', CAST(round_even("
            "avg_monthly_rides, 0) AS BIGINT)) AS monthly_rides_text FROM (SELECT "
            "count(DISTINCT metric_month) AS months_covered, round(sum(ride_count) / "
            "count(DISTINCT metric_month) + 1e-9, 6) AS avg_monthly_rides FROM monthly)"
        ),
        "monthly_rides_by_member": _monthly(
            "SELECT metric_month, member_casual, sum(ride_count)::BIGINT AS total_rides "
            "FROM monthly GROUP BY ALL"
        ),
        "monthly_rides_by_bike": _monthly(
            "SELECT metric_month, rideable_type, sum(ride_count)::BIGINT AS total_rides "
            "FROM monthly GROUP BY ALL"
        ),
        "yoy_monthly": _yoy(
            "SELECT year, month, member_casual, rideable_type, ride_count, "
            "round(avg_ride_duration_minutes + 1e-9, 6) AS avg_ride_duration_minutes, "
            "round(avg_ride_distance_km + 1e-9, 6) AS avg_ride_distance_km, "
            "round(avg_speed_kmh + 1e-9, 6) AS avg_speed_kmh FROM yoy"
        ),
        "yoy_yearly": _yoy(
            "SELECT year, sum(ride_count)::BIGINT AS total_rides, "
            "round(sum(avg_ride_duration_minutes * ride_count) / sum(ride_count) + 1e-9, 6) "
            "AS avg_duration, "
            "round(sum(avg_ride_distance_km * ride_count) / sum(ride_count) + 1e-9, 6) AS avg_distance, "
            "count(DISTINCT month) AS months_covered FROM yoy GROUP BY year"
        ),
        "yoy_peak_month": _yoy("""
SELECT year, month, rides FROM (
  SELECT *, row_number() OVER (PARTITION BY year ORDER BY rides DESC, month) AS n
  FROM (SELECT year, month, sum(ride_count)::BIGINT AS rides FROM yoy GROUP BY ALL)
) WHERE n = 1"""),
        "yoy_stats": _yoy(_stats()),
        "yoy_stats_casual": _yoy(_stats("WHERE member_casual = 'casual'")),
        "yoy_subtitle": _yoy("""
SELECT *, '2024: ' || months_2024 || ' months of data  |  2025: ' || months_2025
  || ' months of data' AS subtitle
FROM (SELECT count(DISTINCT month) FILTER (year = 2024) AS months_2024,
        count(DISTINCT month) FILTER (year = 2025) AS months_2025 FROM yoy)"""),
        "yoy_month_rides": _yoy(
            f"SELECT year, month, rides, {_LABELS} AS month_label FROM (SELECT year, month, "
            "sum(ride_count)::BIGINT AS rides FROM yoy GROUP BY ALL)"
        ),
        "yoy_change": _yoy(_change(2024, 2025)),
        "yoy_change_absent_year": _yoy(_change(2026, 2027), 2026, 2027),
        "yoy_stats_absent_year": _yoy(_stats("", 2026, 2027), 2026, 2027),
        "yoy_rides_by_member": _yoy(
            "SELECT year, member_casual, sum(ride_count)::BIGINT AS rides FROM yoy GROUP BY ALL"
        ),
        "yoy_rides_by_bike": _yoy(
            "SELECT year, rideable_type, sum(ride_count)::BIGINT AS rides FROM yoy GROUP BY ALL"
        ),
        "yoy_duration_by_month": _yoy(
            f"SELECT year, month, avg_duration, {_LABELS} AS month_label FROM (SELECT year, month,"
            " round(sum(avg_ride_duration_minutes * ride_count) / sum(ride_count) + 1e-9, 6) "
            "AS avg_duration FROM yoy GROUP BY ALL)"
        ),
        "yoy_distance_by_month": _yoy(
            f"SELECT year, month, avg_distance, {_LABELS} AS month_label FROM (SELECT year, month,"
            " round(sum(avg_ride_distance_km * ride_count) / sum(ride_count) + 1e-9, 6) "
            "AS avg_distance FROM yoy GROUP BY ALL)"
        ),
    }
    sql["quarantined_csv"] = sql["quarantined_archives"] = _with(
        _DELIVERED,
        select="SELECT file_month, ride_id, CASE WHEN cut_short THEN 12 ELSE 13 END::INTEGER AS n_fields, "
        "wordy AS in_words FROM delivered WHERE wordy OR cut_short",
    )
    sql["landed_months"] = _with(
        _DELIVERED,
        select="SELECT source_month AS started_month, file_month, count(*) AS trips FROM delivered "
        "WHERE NOT (wordy OR cut_short) AND source_month IN ('202501', '202502', '202503') GROUP BY ALL",
    )
    readable = "readable AS (SELECT staging.* FROM staging WHERE NOT (ride_id LIKE '%71' OR ride_id LIKE '%73' OR ride_id LIKE '%59'))"
    sql["refreshed_from_csv"] = _with(
        STAGING, readable, MONTHLY.replace("FROM staging", "FROM readable"), select=_MONTHLY_REPORT
    )
    # What comes late with the file after the last one of the window is not there yet.
    in_time = readable.replace("FROM staging WHERE", """FROM staging WHERE source_month IN ('202501', '202502', '202503')
      AND NOT (ride_id LIKE '%3' AND source_month = '202503') AND""")
    sql["refreshed_from_archives"] = _with(
        STAGING, in_time, HOURLY.replace("FROM staging", "FROM readable"), select=_HOURLY_REPORT
    )
    sql["schema_drift"] = """
SELECT '202407' AS file_month, * FROM (VALUES
  ('start_lat', 'double', 'string'), ('end_lng', 'double', NULL), ('end_lon', NULL, 'double')
) AS v(column_name, declared, found)
WHERE EXISTS (SELECT 1 FROM events WHERE strftime(ts + to_months(CAST(event_id % 26 AS INTEGER)), '%Y%m') = '202407')"""
    sql["stored_layout"] = _staging(
        "SELECT started_date, count(*) AS trips, true AS in_folder, true AS in_order FROM staging GROUP BY started_date"
    )
    sql["refreshed_checks"] = _with(STAGING, HOURLY, WEEKLY, MONTHLY, select=_checks(), trips=MOVED)
    sql["refreshed_in_full"] = _with(NARROW, select=f"SELECT {_STAGING_COLUMNS} FROM narrow", trips=MOVED)
    sql["missing_weekly_kpi"] = _hourly(
        "SELECT NULL::DOUBLE AS avg_weekly_rides, NULL::VARCHAR AS weekly_rides_text FROM hourly LIMIT 1"
    )
    sql["no_trips_kpis"] = _with(
        STAGING, HOURLY.replace("FROM staging", "FROM staging WHERE ride_distance_km < 0"), select=_kpis()
    )
    sql["set_weekly_report"], sql["set_monthly_report"] = sql["weekly_report"], sql["monthly_report"]
    for side in ("start", "end"):
        sql[f"rolled_yoy_top_stations_{side}"] = sql[f"yoy_top_stations_{side}"]
    # Other ways to the same rows.
    sql["archive_window"] = _with(
        select="""SELECT source_month AS file_month, rideable_type, count(*) AS trips,
  min(started_at) AS first_start, max(started_at) AS last_start
FROM raw WHERE started_date >= DATE '2025-01-01' AND started_date < DATE '2025-04-01' GROUP BY ALL"""
    )
    sql["landing_roundtrip"] = sql["archive_scan"] = sql["csv_scan"]
    for report in ("hourly", "weekly", "monthly"):
        sql[f"rolled_{report}_report"] = sql[f"{report}_report"]
    # Other ways to the same rows: rollups and stored reports.
    for name, same in {
        "rolled_top_stations_start": "top_stations_start",
        "rolled_top_stations_end": "top_stations_end",
        "stored_hourly_kpis": "hourly_kpis",
        "stored_weekly_kpi": "weekly_kpi",
        "stored_monthly_kpis": "monthly_kpis",
        "stored_yoy_change": "yoy_change",
    }.items():
        sql[name] = sql[same]
    return sql
