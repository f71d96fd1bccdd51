"""One row per item and dimension value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.functions.dimensions import dimension_values, stored_values
from vitrina.spec import CatalogSpec


def explode_dimension(
    df: DataFrame,
    column: str,
    spec: CatalogSpec,
    extras: Sequence[str] = (),
    with_key: bool = True,
) -> DataFrame:
    """Distinct pairs of key and value of a pipe-delimited column, with further columns.

    Repeats inside a row are dropped inside its array, unless the dimensions are known to
    be normalised. If keys repeat over rows, pairs
    are made distinct by a grouping that combines before the shuffle, so a hot key
    sends one row per task and value; of several values of an extra column the largest
    is kept. ``with_key=False`` leaves the key out, and out of the scan, where it is
    unique.

    The not-NULL filter is written out because a split does not let Spark infer it; it
    reaches the Parquet scan.
    """
    filled = df.filter(F.col(column).isNotNull())
    elements = stored_values if spec.normalized else dimension_values
    # A column before it is exploded, as the text is split by compiled code then. For ``explode``
    # Spark adds a filter on the array, which would split the text once more.
    kept = [spec.key, *extras] if with_key or not spec.unique_key else [*extras]
    split = filled.select(*kept, elements(F.col(column)).alias(column))
    pairs = split.withColumn(column, F.explode_outer(column)).filter(F.col(column).isNotNull())
    if spec.unique_key:
        return pairs.select(*kept, column)
    if not extras:
        return pairs.distinct()
    return pairs.groupBy(spec.key, column).agg(*(F.max(name).alias(name) for name in extras))
