"""Number rules: lenient casts, half-even rounding, shares, validity ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")

# Fixed value: what marks a number as a Java literal.
JAVA_LITERAL = r"(?<=[0-9.])[dDfF]$|[xX]"


def lenient_double(column: Column) -> Column:
    """Text to double; NULL when it is no number and for NaN. Infinity stays."""
    return F.nullif(parsed_double(column), F.lit(float("nan")))


def parsed_double(column: Column) -> Column:
    """Text to double, NULL when it is no number; NaN stays NaN.

    Spark also reads literals with a Java suffix or in hexadecimal (``1d``, ``0x1p3``).
    Those are no numbers in a catalog file and are spoiled before the cast.
    """
    text = column.cast("string")
    suspect = (
        F.right(text, F.lit(1)).isin("d", "D", "f", "F")
        | F.contains(text, F.lit("x"))
        | F.contains(text, F.lit("X"))
    )
    spoiled = F.regexp_replace(text, JAVA_LITERAL, "?")
    return F.when(suspect, spoiled.try_cast("double")).otherwise(text.try_cast("double"))


def lenient_long(column: Column) -> Column:
    """Text to a whole number by way of double, cutting the fraction; NULL when it fails."""
    return parsed_double(column).try_cast("bigint")


def half_even(column: Column, places: int = 4) -> Column:
    """Round to ``places`` digits, ties to the even neighbour."""
    return F.bround(column, places)


def exact_mean(value: Column, times: Column | None = None) -> Column:
    """Mean of a number in a group, each value counted ``times``, the same in any order of rows.

    Values are summed as decimals with twelve places. Where one has no such decimal (it is
    infinite, or has more than twelve digits before the point), the sum is one of doubles.
    """
    times = F.lit(1) if times is None else times
    exact = value.cast("double").try_cast("decimal(24,12)")
    count = F.sum(F.when(value.isNotNull(), times))
    total = F.sum(exact * times.cast("decimal(14,0)")).cast("double")
    plain = F.sum(value.cast("double") * times)
    return F.when(F.count(exact) == F.count(value), total).otherwise(plain) / F.nullif(count, F.lit(0))


def share_percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, 0 when there are no rows."""
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))


def is_infinite(column: Column) -> Column:
    """True for plus and minus infinity."""
    return F.abs(column) == F.lit(INFINITY)


def out_of_range(column: Column, low: float, high: float | None = None) -> Column:
    """True for values below ``low``, above ``high``, NaN or infinite; NULL for NULL."""
    value = column.cast("double")
    bad = F.isnan(value) | is_infinite(value) | (value < low)
    if high is not None:
        bad = bad | (value > high)
    return column.isNotNull() & bad
