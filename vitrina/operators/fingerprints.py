"""Order-free fingerprints of tables, by bucket.

Rows fall into buckets by a hash of all their cells. A bucket's fingerprint is the number of
its rows and the sums of pieces of two 64-bit row hashes, so it depends on neither order nor
partitions, and copies count. Sums combine before the shuffle: what is shuffled is a row of
numbers per task and bucket, however wide the table is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1024
#: First bits of the pieces of a hash; a sum of 22-bit pieces holds for 2e12 rows.
PIECES = (0, 21, 42)
PIECE_MASK = (1 << 21) - 1


def row_hash(df: DataFrame, salt: int) -> Column:
    """64-bit hash of all cells of a row; it tells NULL from every value, at every place."""
    nested = (T.ArrayType, T.StructType, T.MapType, T.VariantType)
    cells, missing = [], []
    for index, field in enumerate(df.schema.fields):
        cell = F.col(f"`{field.name.replace('`', '``')}`")
        if isinstance(field.dataType, nested):
            # Hashes pass over NULL elements, JSON shows them.
            cell = F.to_json(F.struct(cell.alias(f"c{index}")), {"ignoreNullFields": "false"})
        else:
            missing.append(cell.isNull())
        cells.append(cell)
    return F.xxhash64(F.lit(salt), *missing, *cells)


def bucket_of(df: DataFrame) -> Column:
    return F.pmod(row_hash(df, 0), F.lit(BUCKETS)).cast("int")


def _signed(df: DataFrame, sign: int) -> DataFrame:
    hashed = df.select(
        bucket_of(df).alias("bucket"), row_hash(df, 0).alias("h0"), row_hash(df, 1).alias("h1")
    )
    pieces = []
    for name in ("h0", "h1"):
        for first in PIECES:
            piece = F.shiftrightunsigned(name, first)
            if first != PIECES[-1]:
                piece = piece.bitwiseAND(F.lit(PIECE_MASK).cast("long"))
            pieces.append((piece * sign).alias(f"{name}_{first}"))
    return hashed.select("bucket", F.lit(sign).cast("long").alias("n"), *pieces)


def differing_buckets(left: DataFrame, right: DataFrame) -> DataFrame:
    """``bucket`` numbers whose fingerprints differ between two tables with equal columns."""
    both = _signed(left, 1).unionByName(_signed(right, -1))
    names = both.columns[1:]
    sums = both.groupBy("bucket").agg(*(F.sum(name).alias(name) for name in names))
    differs = reduce(lambda a, b: a | b, (F.col(name) != 0 for name in names))
    return sums.filter(differs).select("bucket")


def only_differing(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """Both tables cut down to the buckets that differ, or None when none does.

    What reaches the driver is a list of at most ``BUCKETS`` numbers.
    """
    numbers = [row.bucket for row in differing_buckets(left, right).collect()]
    if not numbers:
        return None
    return (
        left.filter(bucket_of(left).isin(numbers)),
        right.filter(bucket_of(right).isin(numbers)),
    )
