"""Positions of rows in a sorted table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrina.session import materialize

# Fixed value: bits that hold the row number inside a task in monotonically_increasing_id.
_ROW_BITS = 33


def small_ordinal(df: DataFrame, order: Sequence[Column], name: str = "posicion") -> DataFrame:
    """Positions from 0 in one task; for bounded results such as a top list only."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)) - 1)


def distributed_ordinal(
    df: DataFrame, order: Sequence[Column], name: str = "posicion"
) -> DataFrame:
    """Positions from 0 over a whole table, sorted by ranges.

    A random column breaks ties between equal rows, so that copies of one row do not
    have to share a task. The sorted rows are written once; the number of rows per
    task then gives each task the position of its first row.
    """
    ranged = df.withColumn("tie", F.rand(7))
    keys = [*order, F.col("tie")]
    numbered = (
        ranged.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("slot", F.monotonically_increasing_id())
        .drop("tie")
    )
    stored = materialize(numbered, "ordinal").withColumn(
        "task", F.shiftright("slot", _ROW_BITS)
    )
    sizes = stored.groupBy("task").agg(F.count(F.lit(1)).alias("rows"))
    # One row per task of the sort: bounded by the number of partitions.
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("task", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    local = F.col("slot") - F.shiftleft(F.col("task"), _ROW_BITS)
    return (
        stored.join(starts, "task")
        .withColumn(name, F.col("start") + local)
        .drop("task", "slot", "start")
    )
