"""Date and time column functions (F1, F2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text layout of the incident date columns.
INCIDENT_DATETIME_PATTERN = "MM/dd/yyyy hh:mm:ss a"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_to_date(c, pattern: str = INCIDENT_DATETIME_PATTERN) -> Column:
    """Text → timestamp → date. Text that does not fit the pattern gives null
    (``try_to_timestamp``; a plain ``to_timestamp`` raises under ANSI mode)."""
    return F.try_to_timestamp(_col(c), F.lit(pattern)).cast("date")


def to_date_any(c, dtype: str, pattern: str = INCIDENT_DATETIME_PATTERN) -> Column:
    """Date column from text (parsed) or from a timestamp/date column (cast)."""
    if dtype == "string":
        return text_to_date(c, pattern)
    return _col(c).cast("date")


def in_year(c, year: int) -> Column:
    """``year(c) = year`` written as a half-open date range, which (unlike the
    function call) reaches the Parquet scan as a pushed filter and lets row
    groups be skipped by their min/max statistics."""
    col = _col(c)
    return (col >= F.make_date(F.lit(year), F.lit(1), F.lit(1))) & (
        col < F.make_date(F.lit(year + 1), F.lit(1), F.lit(1)))


def year_of(c) -> Column:
    return F.year(_col(c))


def month_of(c) -> Column:
    return F.month(_col(c))
