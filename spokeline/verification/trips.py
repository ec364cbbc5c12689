"""Trip records derived from the ``events`` table.

Every event becomes one trip. Some values are spoiled on purpose (placeholder
ids, missing or impossible coordinates, ends before starts, padded and blank
texts), so that each cleaning rule has rows to work on; no event is left out.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spokeline import schemas
from spokeline.operators import staging
from spokeline.sources import trip_archive

# A backfill whose window, 2024-01 up to 2026-02, covers every derived trip.
START, END = date(2024, 2, 15), date(2026, 3, 15)
MONTHS = 26
STATIONS = 40


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def from_events(events: DataFrame) -> DataFrame:
    event, user = F.col("event_id"), F.col("user_id")
    start_no, end_no = F.col("_start_no"), F.col("_end_no")
    started = F.col("ts") + F.make_ym_interval(F.lit(0), F.lit(1)) * (event % MONTHS)
    seconds = (
        F.when(event % 89 == 0, -60)
        .when(event % 83 == 0, 0)
        .otherwise(F.floor(F.col("value") * 12.0))
    )
    ended = F.col("started_at") + seconds * F.lit(timedelta(seconds=1))
    columns = {
        "ride_id": F.when(event % 97 == 0, "nan").otherwise(_numbered("R", event)),
        "rideable_type": F.when(
            F.col("event_type").isin("click", "purchase", "view"), " electric_bike "
        )
        .when((F.col("event_type") == "error") & (event % 50 == 0), "  ")
        .otherwise("classic_bike"),
        "started_at": F.col("started_at"),
        "ended_at": ended,
        "start_station_name": _station_name(start_no),
        "start_station_id": _station_id(start_no),
        "end_station_name": _station_name(end_no),
        "end_station_id": _station_id(end_no),
        "start_lat": F.when(event % 101 != 0, _lat(start_no)),
        "start_lng": _lng(start_no),
        "end_lat": F.when(event % 103 == 0, 95.0).otherwise(_lat(end_no)),
        "end_lng": _lng(end_no),
        "member_casual": F.when(user % 5 == 0, "casual").otherwise(" member"),
    }
    # Values used several times get a column, so that Spark computes them once.
    once = {"started_at": started, "_start_no": user % STATIONS, "_end_no": event % STATIONS}
    return events.withColumns(once).select(
        *[columns[name].alias(name) for name in schemas.TRIPS.names]
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.with_lineage(trips(spark, sf_dir))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.clean(raw(spark, sf_dir), START, END)


# Quotes doubled, white space and microseconds kept.
_CSV = {
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


def write_csv(trips: DataFrame, folder: str) -> None:
    """Trips as CSV files with a header, named by the month their trips start in."""
    _write_files(_records(trips), trips.columns, folder, "csv")


def write_archives(trips: DataFrame, folder: str) -> None:
    """Trips as zip archives of one CSV member each, named as the files of ``write_csv``."""
    _write_files(_records(trips), trips.columns, folder, "zip")


def write_spoiled(trips: DataFrame, folder: str, kind: str) -> None:
    """As above, as ``csv`` or ``zip``, with what real files have:

    records that don't fit the columns, with a latitude in words or without the last field, and trips that
    come with the next month's file.
    """
    words = trips.withColumn("start_lat", F.when(wordy(), "north").otherwise(F.col("start_lat").cast("string")))
    short = F.to_csv(F.struct(*trips.columns[:-1]), _CSV)
    line = F.when(cut_short(), short).otherwise(F.to_csv(F.struct(*trips.columns), _CSV))
    month = F.when(late(), F.date_format(F.add_months("started_at", 1), "yyyyMM")).otherwise(_file_month())
    _write_files(words.select(month.alias("file_month"), line.alias("line")), trips.columns, folder, kind)


def late() -> Column:
    """Which trips come with the next month's file, as far as the backfill has one."""
    return F.col("ride_id").rlike("3$") & (F.col("started_at") < F.lit("2026-02-01").cast("timestamp_ntz"))


def wordy() -> Column:
    """Whose latitude ``write_spoiled`` writes in words."""
    return F.col("ride_id").rlike("7[13]$")


def cut_short() -> Column:
    """Whose last field ``write_spoiled`` leaves out."""
    return F.col("ride_id").rlike("59$")


def _file_month() -> Column:
    return F.date_format("started_at", "yyyyMM")


def _records(trips: DataFrame) -> DataFrame:
    return trips.select(_file_month().alias("file_month"), F.to_csv(F.struct(*trips.columns), _CSV).alias("line"))


def _write_files(records: DataFrame, columns: list[str], folder: str, kind: str) -> None:
    """A file per month and task, each written as a stream. Months too large for a task are split.

    A repeated task writes the same files again, under the same names.
    """
    header = ",".join(columns) + "\n"
    where = trip_archive.filesystem_uri(folder)

    def write(batches):
        from contextlib import ExitStack
        from zipfile import ZIP_DEFLATED, ZipFile

        from pyarrow import RecordBatch, fs
        from pyspark import TaskContext

        filesystem, root = fs.FileSystem.from_uri(where)
        filesystem.create_dir(root, recursive=True)
        task, month, out, opened = TaskContext.get().partitionId(), None, None, ExitStack()
        with opened:
            for batch in batches:
                for its_month, line in zip(*(c.to_pylist() for c in batch.columns)):
                    if its_month != month:
                        opened.close()
                        month, name = its_month, f"{its_month}-trips-{task:05d}"
                        out = opened.enter_context(filesystem.open_output_stream(f"{root}/{name}.{kind}"))
                        if kind == "zip":
                            archive = opened.enter_context(ZipFile(out, "w", ZIP_DEFLATED))
                            out = opened.enter_context(archive.open(f"{name}.csv", "w", force_zip64=True))
                        out.write(header.encode())
                    out.write(f"{line}\n".encode())
        yield RecordBatch.from_pydict({"month": [month]})

    sorted_ = records.hint("rebalance", "file_month").sortWithinPartitions("file_month")
    sorted_.mapInArrow(write, "month string").write.format("noop").mode("overwrite").save()


def _numbered(prefix: str, number: Column, suffix: str = "") -> Column:
    ending = [F.lit(suffix)] if suffix else []
    return F.concat(F.lit(prefix), number.cast("string"), *ending)


def _station_name(number: Column) -> Column:
    return F.when(number == 7, "").otherwise(_numbered(" Station ", number, " "))


def _station_id(number: Column) -> Column:
    return F.when(number != 9, _numbered("S", number))


def _lat(number: Column) -> Column:
    return F.lit(40.65) + F.lit(0.004) * number.cast("double")


def _lng(number: Column) -> Column:
    return F.lit(-74.02) + F.lit(0.003) * number.cast("double")
