"""Month-year text dates (F1-F5). All native expressions, no UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import DAYS_PER_YEAR

MONTH_YEAR = "MMM-yyyy"      # e.g. Dec-2016
MONTH_SHORT_YEAR = "MMM-yy"  # e.g. Dec-16 (only when asked for)


def parse_month(c: Column | str, formats: tuple[str, ...] = (MONTH_YEAR,)) -> Column:
    """Text -> DATE (first of month); unparsable text -> NULL (F1).

    ``try_to_timestamp`` never raises under ANSI mode; formats are tried in order.
    A DATE already parsed passes through unchanged.
    """
    col = F.col(c) if isinstance(c, str) else c
    parsed = [F.try_to_timestamp(col.cast("string"), F.lit(fmt)).cast("date") for fmt in formats]
    return parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)


def month_start(c: Column | str) -> Column:
    """Month period as the first day of the month."""
    return F.trunc(F.col(c) if isinstance(c, str) else c, "MM")


def history_years(issue: Column, earliest: Column) -> Column:
    """Years between two dates: days / 365.25, negative -> 0, NULL -> 0."""
    years = F.datediff(issue, earliest).cast("double") / F.lit(DAYS_PER_YEAR)
    return F.greatest(F.coalesce(years, F.lit(0.0)), F.lit(0.0))
