"""Date rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_date(column: Column) -> Column:
    """``yyyy-MM-dd`` text to a date; NULL for another format or an impossible day.

    A cast also takes shorter forms and a time after the day, so the length, the two
    hyphens and the last digit are checked. A pattern or a date parser would cost
    several times as much per row, most of all on bad values.
    """
    shaped = (
        (F.octet_length(column) == 10)
        & (F.substring(column, 5, 1) == "-")
        & (F.substring(column, 8, 1) == "-")
        & F.substring(column, 10, 1).between("0", "9")
    )
    return F.when(shaped, column.try_cast("date"))


def year_disagrees(date: Column, year: Column) -> Column:
    """True unless both are NULL or the year is that of the date."""
    return ~F.year(date).eqNullSafe(year)
