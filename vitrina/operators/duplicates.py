"""Repeated keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEMBERS_PER_PART = 1000


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key (``cantidad``) for the keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cantidad")).filter("cantidad > 1")


def duplicate_summary(df: DataFrame, keys: Sequence[str], ignore_null: bool = False) -> DataFrame:
    """Number of repeated keys, of rows with such a key, and of rows beyond the first.

    NULL keys form a group of their own unless ``ignore_null`` is set.
    """
    source = df.dropna(how="any", subset=list(keys)) if ignore_null else df
    return key_counts(source, keys).agg(
        F.count(F.lit(1)).alias("duplicados"),
        F.coalesce(F.sum("cantidad"), F.lit(0)).alias("filas_en_grupos_duplicados"),
        F.coalesce(F.sum(F.col("cantidad") - 1), F.lit(0)).alias("filas_extra"),
    )


def _collisions(df: DataFrame, key: str, members: Sequence[str]) -> DataFrame:
    """Distinct members of repeated keys with the sizes of their group.

    Members are counted before they are joined to the sizes, so a hot key is split over
    its members, and the join can split it further.
    """
    counted = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key, *members)
        .agg(F.count(F.lit(1)).alias("veces"))
    )
    sizes = (
        counted.groupBy(key)
        .agg(F.sum("veces").alias("cantidad"), F.count(F.lit(1)).alias("distintos"))
        .filter("cantidad > 1")
    )
    return counted.join(sizes, key)


def collision_members(df: DataFrame, key: str, members: Sequence[str]) -> DataFrame:
    """One row per distinct member of every repeated non-NULL key.

    ``cantidad`` is the number of rows with the key, ``veces`` how often the member
    occurs among them. No group is gathered.
    """
    return _collisions(df, key, members).drop("distintos")


def collision_groups(
    df: DataFrame, key: str, member: str, label: str, per_part: int = MEMBERS_PER_PART
) -> DataFrame:
    """Repeated keys with the sorted lists of their members, largest groups first.

    A group of up to ``per_part`` members is one row. A larger one is split by hash
    into several rows (``parte``), which together hold every member, so that no list
    grows with the data.
    """
    parts = F.ceil(F.col("distintos") / per_part)
    return (
        _collisions(df, key, [member, label])
        .withColumn("parte", F.pmod(F.xxhash64(member, label), parts).cast("int"))
        .groupBy(key, "cantidad", "parte")
        .agg(F.sort_array(F.collect_list(F.struct(member, label, "veces"))).alias("miembros"))
        .select(
            key,
            "cantidad",
            "parte",
            F.col(f"miembros.{member}").alias("ids"),
            F.col(f"miembros.{label}").alias("nombres"),
            F.col("miembros.veces").alias("veces"),
        )
        # A sort samples its input, which would join and list all members once more.
        .repartition(key, "parte")
        .orderBy(F.desc("cantidad"), key, "parte")
    )
