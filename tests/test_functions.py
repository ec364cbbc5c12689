import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from spokeline import functions as fn


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "text, expected",
    [(" a ", "a"), ("\t a b ", "a b"), ("　 x\u0085", "x"), (" \t ", ""), ("a", "a")],
)
def test_trim_strips_unicode_space(spark, text, expected):
    assert value(spark, fn.trim_ws(F.lit(text))) == expected


def test_trim_agrees_with_the_unicode_class(spark):
    """Every code point of the basic plane: stripped exactly when it is Unicode white space."""
    chars = spark.createDataFrame([(chr(i),) for i in range(1, 0xD800)], "c string")
    differ = chars.where(
        (fn.trim_ws(F.col("c")) == "") != F.col("c").rlike(r"(?U)^\s$")
    ).collect()
    assert differ == []


def test_blank_is_null(spark):
    assert value(spark, fn.blank_to_null(F.lit(" \t "))) is None
    assert value(spark, fn.blank_to_null(F.lit(" x "))) == "x"


def test_distance(spark):
    def km(*p):
        return value(spark, fn.haversine_km(*[F.lit(float(x)) for x in p]))

    assert km(40, -74, 40, -74) == 0.0
    assert km(0, 0, 0, 180) == pytest.approx(math.pi * 6371.01)
    assert km(90, 0, -90, 0) == pytest.approx(math.pi * 6371.01)
    assert not math.isnan(km(12.3456, 45.678, -12.3456, -134.322))
    assert km(0, 0, 0, 1) == pytest.approx(math.pi * 6371.01 / 180)


def test_run_window_wraps_the_year():
    assert fn.run_window(date(2024, 1, 15), date(2024, 3, 31)) == (date(2023, 12, 1), date(2024, 3, 1))
    assert fn.months_in_window(date(2024, 1, 15), date(2024, 3, 31)) == ["202312", "202401", "202402"]


def test_backfill_window_has_26_months():
    months = fn.months_in_window(date(2024, 2, 15), date(2026, 3, 15))
    assert (len(months), months[0], months[-1]) == (26, "202401", "202602")


def test_window_of_one_month_and_of_none(spark):
    assert fn.months_in_window(date(2024, 3, 1), date(2024, 3, 31)) == ["202402"]
    assert fn.months_in_window(date(2024, 6, 1), date(2024, 3, 1)) == []
    assert value(spark, fn.first_months(F.lit(date(2024, 6, 1)), F.lit(date(2024, 3, 1)))) == []
    assert value(spark, fn.first_months(F.lit(date(2024, 1, 15)), F.lit(date(2024, 3, 1)))) == [
        date(2023, 12, 1), date(2024, 1, 1), date(2024, 2, 1),
    ]


@pytest.mark.parametrize(
    "old, new, text",
    [(0, 5, "N/A"), (100, 100, "+0.0%"), (100, 103.25, "+3.2%"), (100, 50, "-50.0%"), (80, 0, "-100.0%")],
)
def test_percent_text_signs_zero_and_rounds_half_even(spark, old, new, text):
    assert value(spark, fn.pct_text(F.lit(float(old)), F.lit(float(new)))) == text


def test_number_texts(spark):
    assert value(spark, fn.thousands(F.lit(1234567))) == "1,234,567"
    assert value(spark, fn.thousands(F.lit(13200.0), 1)) == "13,200.0"
    assert value(spark, fn.fixed_decimals(F.lit(12.25), 1, "min")) == "12.2 min"
    assert value(spark, fn.fixed_decimals(F.lit(1.8), 2)) == "1.80"
    text = value(spark, fn.range_text(F.lit(date(2024, 1, 1)), F.lit(date(2024, 2, 1))))
    assert text == "Data range: 2024-01-01 – 2024-02-01"


def test_labels_are_null_outside_their_range(spark):
    assert [value(spark, fn.weekday_name(F.lit(d))) for d in (0, 1, 7, 8)] == [
        None, "Sunday", "Saturday", None,
    ]
    assert [value(spark, fn.month_label(F.lit(m))) for m in (1, 12, 13)] == ["Jan", "Dec", None]


def test_percent_change_needs_a_positive_base(spark):
    assert value(spark, fn.pct_change(F.lit(0), F.lit(5))) is None
    assert value(spark, fn.pct_change(F.lit(None).cast("bigint"), F.lit(5))) is None
    assert value(spark, fn.pct_change(F.lit(4), F.lit(0))) == -100.0
