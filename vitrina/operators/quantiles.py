"""Exact medians per group, from value histograms."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrina.functions.numbers import exact_mean
from vitrina.operators.compare import union_all
from vitrina.session import materialize

CUTS = 64
#: Different values around the middle of a group that one task ranks at most.
RANKED = 1 << 14


def grouped_summary(
    df: DataFrame, group: str, value: str, few_values: bool = True
) -> DataFrame:
    """``n``, ``mean``, ``median``, ``low`` and ``high`` of a number per group, NULLs left out.

    Rows are first counted per group and value, which combines before the shuffle and
    spreads a hot group over all tasks. ``few_values`` says that the number has few distinct
    values whatever the number of rows, as scores with a fixed range do; the counts of a
    group then meet in one task. Otherwise ``split_median`` searches for the middle. Both
    ways give the same result.
    """
    filled = df.filter(F.col(value).isNotNull()).select(
        F.col(group).alias("grp"), F.col(value).alias("val")
    )
    counts = filled.groupBy("grp", "val").agg(F.count(F.lit(1)).alias("freq"))
    totals = [
        F.sum("freq").alias("n"),
        exact_mean(F.col("val"), F.col("freq")).alias("mean"),
        F.min("val").alias("low"),
        F.max("val").alias("high"),
    ]
    if few_values:
        median = F.percentile(F.col("val").cast("double"), 0.5, F.col("freq"))
        summary = counts.groupBy("grp").agg(*totals, median.alias("median"))
    else:
        # Written once: the totals, and every round of the median, read the counts.
        counts = materialize(counts, "value-counts")
        summary = counts.groupBy("grp").agg(*totals).join(_split_median(counts), "grp")
    return summary.select(F.col("grp").alias(group), "n", "mean", "median", "low", "high")


def split_median(counts: DataFrame, cuts: int = CUTS, most: int = RANKED) -> DataFrame:
    """Median per ``grp`` of ``val`` occurring ``freq`` times, without gathering a group.

    ``median_ranges`` narrows each group down to at most ``most`` different values around its
    middle, and only those are ranked. The counts are written once, as every round reads them.
    """
    return _split_median(materialize(counts.select("grp", "val", "freq"), "value-counts"), cuts, most)


def _split_median(counts: DataFrame, cuts: int = CUTS, most: int = RANKED) -> DataFrame:
    """``split_median`` of counts that are written already."""
    middle = median_ranges(counts, cuts, most)
    up_to = Window.partitionBy("grp").orderBy("val").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        _inside(counts, middle)
        .withColumn("last_rank", F.col("below") + F.sum("freq").over(up_to))
        .withColumn("first_rank", F.col("last_rank") - F.col("freq") + 1)
    )

    def at_rank(rank: str) -> Column:
        holds = F.col(rank).between(F.col("first_rank"), F.col("last_rank"))
        return F.max(F.when(holds, F.col("val").cast("double")))

    return ranked.groupBy("grp").agg(
        ((at_rank("rank_a") + at_rank("rank_b")) / 2).alias("median")
    )


def median_ranges(counts: DataFrame, cuts: int = CUTS, most: int = RANKED) -> DataFrame:
    """Per ``grp`` a range ``from_val`` to ``to_val`` of at most ``most`` values with the middle.

    Also the ranks of the middle, ``rank_a`` and ``rank_b``, the number of rows ``below`` the
    range, and its number of ``values``. A round cuts the ranges that are still too wide into
    ``cuts`` parts and keeps the one or two that hold the middle, so rounds grow with the
    logarithm of the values of a group. A table of a row per group is all that a round writes.
    """
    whole = (
        counts.groupBy("grp")
        .agg(
            F.sum("freq").alias("n"),
            F.count(F.lit(1)).alias("values"),
            F.min("val").alias("from_val"),
            F.max("val").alias("to_val"),
        )
        .select(
            "grp",
            F.lit(0).cast("long").alias("below"),
            F.expr("(n + 1) div 2").alias("rank_a"),
            F.expr("(n + 2) div 2").alias("rank_b"),
            "from_val",
            "to_val",
            "values",
        )
    )
    found = []
    while True:
        ranges = materialize(whole, "median-ranges")
        found.append(ranges.filter(F.col("values") <= most))
        wide = ranges.filter(F.col("values") > most)
        if wide.isEmpty():
            return union_all(found)
        whole = _narrowed(counts, wide, cuts)


def _inside(counts: DataFrame, ranges: DataFrame) -> DataFrame:
    """The counts of the values in the range of their group."""
    return counts.join(ranges, "grp").filter("val BETWEEN from_val AND to_val")


def _narrowed(counts: DataFrame, ranges: DataFrame, cuts: int) -> DataFrame:
    """Ranges cut into parts of about equal numbers of values, and the parts with the middle.

    A sketch of bounded size proposes the cuts. They steer the work and not the result: the
    bounds of a part and the rows below it are counted.
    """
    fractions = [step / cuts for step in range(1, cuts)]
    stride = math.isqrt(cuts)
    coarse = F.transform(
        F.sequence(F.lit(stride), F.lit(cuts - 1), F.lit(stride)),
        lambda index: F.element_at("cuts", index),
    )
    inside = _inside(counts, ranges)
    sketches = (
        inside.groupBy("grp")
        .agg(F.percentile_approx("val", fractions, 8 * cuts).alias("cuts"))
        .withColumn("coarse", coarse)
    )

    def cuts_below(array: Column | str) -> Column:
        return F.size(F.filter(array, lambda cut: cut < F.col("val")))

    # The part of a value is the number of cuts below it: first every stride-th cut is
    # looked at, then those between two of them.
    fine = F.slice("cuts", F.col("skipped") + 1, F.lit(stride - 1))
    parts = (
        inside.join(sketches, "grp")
        .withColumn("skipped", cuts_below("coarse") * stride)
        .withColumn("part", F.col("skipped") + cuts_below(fine))
        .groupBy("grp", "part")
        .agg(
            *(F.first(name).alias(name) for name in ("below", "rank_a", "rank_b")),
            F.sum("freq").alias("rows"),
            F.count(F.lit(1)).alias("values"),
            F.min("val").alias("from_val"),
            F.max("val").alias("to_val"),
        )
    )
    before = (
        Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        parts.withColumn("below", F.col("below") + F.coalesce(F.sum("rows").over(before), F.lit(0)))
        .filter("below < rank_b AND below + rows >= rank_a")
        .groupBy("grp")
        .agg(
            *(F.min(name).alias(name) for name in ("below", "rank_a", "rank_b", "from_val")),
            F.max("to_val").alias("to_val"),
            F.sum("values").alias("values"),
        )
    )
