"""Run windows and calendar labels."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels shown for weekdays (1 = Sunday) and months.
WEEKDAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
MONTH_LABELS = (
    "Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec",
)


def run_window(start: date, end: date) -> tuple[date, date]:
    """Days a run replaces: from the month before ``start`` up to ``end``'s month, half open."""
    month_index = start.year * 12 + start.month - 2
    return date(month_index // 12, month_index % 12 + 1, 1), end.replace(day=1)


def months_in_window(start: date, end: date) -> list[str]:
    """The run window's months as yyyyMM."""
    first, stop = run_window(start, end)
    span = range(first.year * 12 + first.month - 1, stop.year * 12 + stop.month - 1)
    return [f"{i // 12}{i % 12 + 1:02d}" for i in span]


def first_months(start: Column, end: Column) -> Column:
    """The run window of two date columns as an array of first-of-month dates."""
    first = F.trunc(F.add_months(start, -1), "MM")
    last = F.add_months(F.trunc(end, "MM"), -1)
    months = F.sequence(first, last, F.make_ym_interval(F.lit(0), F.lit(1)))
    return F.when(first <= last, months).otherwise(F.array().cast("array<date>"))


def weekday_name(day_of_week: Column) -> Column:
    return _label(day_of_week, WEEKDAY_NAMES)


def month_label(month: Column) -> Column:
    return _label(month, MONTH_LABELS)


def _label(number: Column, labels: tuple[str, ...]) -> Column:
    """Label of a number counted from 1; NULL outside the list."""
    return F.try_element_at(
        F.array(*[F.lit(x) for x in labels]),
        F.when(number.between(1, len(labels)), number.cast("int")),
    )
