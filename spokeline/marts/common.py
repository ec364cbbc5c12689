"""Pieces all pages share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALL = "All"


def for_member(report: DataFrame, member: str = ALL) -> DataFrame:
    """Rows of one rider kind, or every row for "All"."""
    return report if member == ALL else report.where(F.col("member_casual") == member)


def member_options(report: DataFrame) -> DataFrame:
    """Choices of the rider filter: "All" first, then the kinds in order."""
    kinds = report.select(F.lit(1).alias("position"), F.col("member_casual").alias("option"))
    everything = report.sparkSession.range(1).select(F.lit(0).alias("position"), F.lit(ALL).alias("option"))
    return (
        everything.unionByName(kinds.where(F.col("option").isNotNull()).distinct())
        .orderBy("position", "option")
    )
