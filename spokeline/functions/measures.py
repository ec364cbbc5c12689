"""Means weighted by a count, and change in percent."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def weighted_avg(measure: Column, count: Column) -> Column:
    """Mean of group means weighted by group size."""
    return F.sum(measure * count) / F.nullif(F.sum(count), F.lit(0))


def weighted_avg_known(measure: Column, count: Column) -> Column:
    """As ``weighted_avg``, but groups without a mean carry no weight."""
    known = F.sum(F.when(measure.isNotNull(), count))
    return F.sum(F.coalesce(measure, F.lit(0.0)) * count) / F.nullif(known, F.lit(0))


def pct_change(old: Column, new: Column) -> Column:
    """Change from old to new in percent; NULL unless old is positive."""
    return F.when(old > 0, (new - old) / old.cast("double") * 100.0)
