"""Trip files: CSV, zipped CSV and landed Parquet, each as one scan over many files."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spokeline import files, schemas
from spokeline.sources import tables, trip_archive

# Fixed value: file names begin with the month they were published for.
FILE_MONTH_PATTERN = r"^(\d{6})"
_CORRUPT = T.StructField(schemas.CORRUPT.name, T.StringType())


def read_csv(
    spark: SparkSession,
    folder: str,
    months: Sequence[str] | None = None,
    *,
    multi_line: bool = False,
    bad_rows: str = "FAILFAST",
    file_month: str | None = None,
) -> DataFrame:
    """All trip CSVs below a folder, or those of the given months, each of which must be there.

    A number that cannot be read stops the load, as does a record with too many or too few
    fields; ``bad_rows="PERMISSIVE"`` makes what is missing NULL and adds a column
    ``corrupt_record`` with the record as delivered, NULL for all others. A time that cannot
    be read becomes NULL. Files are split
    between tasks, so a line break inside quotes needs ``multi_line=True``,
    which reads each file in one task. A header that differs from the declared
    columns stops the load.

    ``file_month`` is the month for files whose names begin with none; without it they
    are refused, because a month landed again replaces what has landed for it.
    """
    permissive = bad_rows.upper() == "PERMISSIVE"
    fields = [*schemas.CSV_FIELDS, _CORRUPT] if permissive else list(schemas.CSV_FIELDS)
    lines = (
        spark.read.schema(T.StructType(fields))
        .option("header", True)
        .option("columnNameOfCorruptRecord", schemas.CORRUPT.name)
        # A number is looked at even where its column is not asked for.
        .option("columnPruning", not permissive)
        .option("enforceSchema", False)
        .option("escape", '"')
        # No field holds this, so an empty field is NULL and a quoted empty one is "".
        .option("nullValue", "\u0000")
        .option("mode", bad_rows)
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", _month_glob(months, ".csv"))
        .csv(folder)
    )
    found = [posixpath.basename(f) for f in lines.inputFiles()]
    missing = [m for m in months or [""] if not any(f.startswith(m) for f in found)]
    if missing:
        raise FileNotFoundError(f"no CSV files in {folder} {' '.join(missing)}".rstrip())
    unnamed = [f for f in found if not re.match(FILE_MONTH_PATTERN, f)]
    if unnamed and file_month is None:
        raise ValueError(f"no month in the names of {unnamed[:5]}; give file_month")
    return _typed(lines, F.col("_metadata.file_name"), file_month)


def read_archives(
    spark: SparkSession,
    folder: str,
    months: Sequence[str] | None = None,
    *,
    bad_rows: str = "FAILFAST",
    file_month: str | None = None,
    columns: Sequence[str] | None = None,
    started: tuple[date, date] | None = None,
) -> DataFrame:
    """The CSV members of the zip archives below a folder, of all or of the given months.

    ``bad_rows`` and ``file_month`` are as for ``read_csv``. Line breaks inside quotes
    are read as they are: a member is one task anyway.

    ``columns`` names the trip columns to read, in any order; a bad number in another column
    is then not noticed, unless bad records are kept. ``started`` keeps the trips that start from the
    first day up to, not including, the second; trips without a start that can be read are left
    out, and so are records of which nothing could be read. Both reach the parser's tasks, so that
    other columns and days never leave them.
    """
    trip_archive.register(spark)
    chosen = [c for c in schemas.TRIPS.names if columns is None or c in columns]
    unknown = sorted(set(columns or ()) - set(chosen))
    if unknown:
        raise ValueError(f"trips have no columns {unknown}")
    texts = [f for f in schemas.CSV_FIELDS if f.name in chosen or (started and f.name == "started_at")]
    corrupt = [_CORRUPT] if bad_rows.upper() == "PERMISSIVE" else []
    reader = (
        spark.read.format(trip_archive.FORMAT)
        .schema(T.StructType([*texts, *corrupt, T.StructField("archive", T.StringType())]))
        .option("months", ",".join(months) if months is not None else "*")
        .option("bad_rows", bad_rows)
        .option("unnamed", "allowed" if file_month is not None else "refused")
    )
    if started is None:
        return _typed(reader.load(folder), F.col("archive"), file_month)
    first, stop = (day.isoformat() for day in started)
    trips = _typed(reader.option("started", f"{first},{stop}").load(folder), F.col("archive"), file_month)
    at = F.col("started_at")
    inside = trips.where((at >= F.lit(first).cast(schemas.NTZ)) & (at < F.lit(stop).cast(schemas.NTZ)))
    return inside if "started_at" in chosen else inside.drop("started_at")


def read_landed(spark: SparkSession, folder: str, name_glob: str = "*.parquet") -> DataFrame:
    """Trips of every landed Parquet file, whichever run landed it, and however it is laid out."""
    landed = (
        spark.read.schema(T.StructType([*schemas.TRIPS.struct, _CORRUPT]))
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", name_glob)
        .parquet(folder)
    )
    return landed.where(F.col(schemas.CORRUPT.name).isNull()).select(*schemas.TRIPS.names)


def read_landed_months(spark: SparkSession, folder: str, months: Sequence[str]) -> DataFrame:
    """Landed trips that start in the given months, whichever file brought them.

    Only those months' folders are listed, so a run over a few months takes no longer for
    the years that have landed before. Months without a folder have no rows.
    """
    return _landed(spark, folder, "trip", [f"started_month={m}" for m in months]).select(*schemas.TRIPS.names)


def read_quarantine(spark: SparkSession, folder: str, months: Sequence[str] | None = None) -> DataFrame:
    """Records that could not be read, with what could be read of them, of all or of the given file months."""
    rows = _landed(spark, folder, "corrupt", [""])
    return rows if months is None else rows.where(F.col("file_month").isin(*months))


def _landed(spark: SparkSession, folder: str, kind: str, below: list[str]) -> DataFrame:
    paths = [f"{folder}/kind={kind}/{b}".rstrip("/") for b in below]
    found = [p for p in paths if files.exists(spark, p)]
    if not found:
        return tables.empty(spark, schemas.LANDING)
    return spark.read.schema(schemas.LANDING.struct).option("basePath", folder).parquet(*found)


def _typed(lines: DataFrame, file_name: Column, file_month: str | None) -> DataFrame:
    """Text fields to trip columns, with the month of the file they came from."""
    named = F.nullif(F.regexp_extract(file_name, FILE_MONTH_PATTERN, 1), F.lit(""))
    return lines.select(
        *[
            F.col(c.name).try_cast(c.dtype).alias(c.name)
            if c.dtype == schemas.NTZ
            else F.col(c.name)
            for c in schemas.TRIPS.columns
            if c.name in lines.columns
        ],
        *[F.col(c) for c in (schemas.CORRUPT.name,) if c in lines.columns],
        F.coalesce(named, F.lit(file_month)).alias("file_month"),
    )


def _month_glob(months: Sequence[str] | None, suffix: str) -> str:
    if months is None:
        return f"*{suffix}"
    return "{" + ",".join(months) + "}*" + suffix
