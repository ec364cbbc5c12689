"""Tables written by this engine."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokeline import files, schemas

# The file that names the version of a table that counts, and how versions are named: out of sight of whoever lists the table.
CURRENT, VERSION = "_current", "_version-"


def current(spark: SparkSession, path: str) -> str:
    """The folder of a table's rows: the version that counts, or its own folder if there are no versions."""
    version = files.read_text(spark, f"{path}/{CURRENT}")
    return f"{path}/{version.strip()}" if version else path


def read(spark: SparkSession, path: str, table: schemas.Table) -> DataFrame:
    """A table by its declared columns; filters on its folder column prune the scan."""
    return spark.read.schema(table.struct).parquet(current(spark, path)).select(*table.names)


def read_or_empty(spark: SparkSession, path: str, table: schemas.Table) -> DataFrame:
    """As ``read``, with no rows where nothing was written yet. Other errors are raised."""
    try:
        return read(spark, path, table)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, table)


def empty(spark: SparkSession, table: schemas.Table) -> DataFrame:
    """A table without rows, which needs no scan and no Python."""
    return spark.range(0).select(*[F.lit(None).cast(c.dtype).alias(c.name) for c in table.columns])


def _page_columns(report: DataFrame) -> DataFrame:
    """Pages show no station counts, so the scan leaves them out."""
    return report.drop("unique_start_stations", "unique_end_stations")


def load_hourly(spark: SparkSession, path: str) -> DataFrame:
    report = _page_columns(read_or_empty(spark, path, schemas.HOURLY))
    return report.orderBy("metric_date", "started_hour")


def load_weekly(spark: SparkSession, path: str) -> DataFrame:
    return _page_columns(read_or_empty(spark, path, schemas.WEEKLY)).orderBy("day_of_week")


def load_monthly(spark: SparkSession, path: str) -> DataFrame:
    return _page_columns(read_or_empty(spark, path, schemas.MONTHLY)).orderBy("metric_month")
