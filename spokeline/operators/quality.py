"""Declared column checks, all checks of a table in one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spokeline import schemas


class QualityError(ValueError):
    """Rows were found that a declared check does not allow."""


def checks(table: schemas.Table) -> dict[tuple[str, str], Column]:
    """Failing-row condition by column and check. A NULL is left to not_null."""
    found = {}
    for c in table.columns:
        if c.required:
            found[c.name, "not_null"] = F.col(c.name).isNull()
        if c.accepted:
            found[c.name, "accepted_values"] = ~F.col(c.name).isin(*c.accepted)
    return found


def counts(table: schemas.Table) -> list[Column]:
    """Failing rows of each declared check, as aggregates."""
    return [F.count_if(bad).alias(f"check_{i}") for i, bad in enumerate(checks(table).values())]


def check(df: DataFrame, table: schemas.Table) -> DataFrame:
    """One row per declared check with its failing rows."""
    rows = [
        F.struct(
            F.lit(table.name).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(name).alias("check_name"),
            F.col(f"check_{i}").alias("failing_rows"),
            (F.col(f"check_{i}") == 0).alias("passed"),
        )
        for i, (column, name) in enumerate(checks(table))
    ]
    return df.agg(*counts(table)).select(F.inline(F.array(*rows)))


class Watch:
    """The checks of a table, counted by the job that writes it, which saves reading it again.

    ``counts`` and ``seen`` go to the sink, which notes them in the tasks that write.
    """

    def __init__(self, table: schemas.Table) -> None:
        self.table, self.counts, self.seen = table, counts(table), Observation(f"{table.name} checks")

    def report(self, spark: SparkSession) -> DataFrame:
        return watched(spark, self.seen, self.table)


def watched(spark: SparkSession, seen: Observation, table: schemas.Table) -> DataFrame:
    """The check report of a frame that was watched and has been written."""
    rows = [
        (table.name, column, name, failing, failing == 0)
        for (column, name), failing in zip(checks(table), seen.get.values())
    ]
    return spark.createDataFrame(
        rows,
        "table_name string, column_name string, check_name string, "
        "failing_rows bigint, passed boolean",
    )


def schema_differences(df: DataFrame, table: schemas.Table) -> list[str]:
    """Columns that are missing, unexpected or of another type than declared."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    declared = {c.name: c.dtype.simpleString() for c in table.columns}
    return [
        f"{name}: declared {declared.get(name)}, found {actual.get(name)}"
        for name in sorted(actual.keys() | declared.keys())
        if actual.get(name) != declared.get(name)
    ]


def require(report: DataFrame) -> None:
    """Raise if a check failed. The report has a row per declared check, so it is small."""
    failed = report.where(~F.col("passed")).collect()
    if failed:
        raise QualityError(
            "; ".join(
                f"{r.table_name}.{r.column_name} {r.check_name}: {r.failing_rows} rows"
                for r in failed
            )
        )
