"""Text cleaning and number formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Unicode counts as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trim_ws(c: Column) -> Column:
    """Strip all Unicode white space from both ends (plain trim strips spaces only)."""
    return F.trim(c, F.lit(WHITE_SPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(trim_ws(c), F.lit(""))


def _pattern(c: Column, pattern: str) -> Column:
    # Patterns round halves to even, as the reported texts do; format_string would not.
    return F.call_function("format_number", c, F.lit(pattern))


def thousands(c: Column, decimals: int = 0) -> Column:
    """1234567 as 1,234,567."""
    return _pattern(c, "#,##0" + ("." + "0" * decimals if decimals else ""))


def fixed_decimals(c: Column, decimals: int, unit: str = "") -> Column:
    """12.345 as 12.3 or, with a unit, as 12.3 min."""
    return F.concat(_pattern(c, "0." + "0" * decimals), F.lit(f" {unit}" if unit else ""))


def pct_text(old: Column, new: Column) -> Column:
    """Signed change such as +3.3%; zero is signed too, and N/A stands for no base."""
    pct = (new - old) / F.nullif(old.cast("double"), F.lit(0.0)) * 100.0
    sign = F.when(pct >= 0, "+").otherwise("")
    return F.when(old == 0, "N/A").otherwise(F.concat(sign, _pattern(pct, "0.0"), F.lit("%")))


def range_text(first: Column, last: Column) -> Column:
    """Date range as shown under a page title."""
    return F.concat(
        F.lit("Data range: "), first.cast("string"), F.lit(" \u2013 "), last.cast("string")
    )
