"""Row-level changes on a keyed catalog, as new versioned snapshots.

Parquet has no update in place. A change is a plan over the previous snapshot, and a
snapshot is written to a path of its own; nothing that is being read is overwritten.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.operators.compare import same_rows

LARGEST_KEY = 2**63 - 1


def next_id(df: DataFrame, key: str = "id") -> DataFrame:
    """One row with the first free key: one above the largest, at least 1.

    Fails when the largest key is the largest whole number.
    """
    highest = F.greatest(F.coalesce(F.max(key), F.lit(0)), F.lit(0)).cast("bigint")
    full = F.raise_error(F.lit("no key is left above the largest one")).cast("bigint")
    free = F.when(highest < LARGEST_KEY, highest + 1).otherwise(full)
    return df.agg(free.alias("next_id"))


def create(df: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows; columns they lack are NULL, and the schema stays as it is."""
    known = set(rows.columns)
    unknown = known - set(df.columns)
    if unknown:
        raise ValueError(f"unknown columns: {sorted(unknown)}")
    shaped = rows.select(
        *(
            (F.col(name) if name in known else F.lit(None)).cast(dtype).alias(name)
            for name, dtype in df.dtypes
        )
    )
    return df.unionByName(shaped)


def read(df: DataFrame, value: Any, key: str = "id") -> DataFrame:
    """Rows with the key; the filter reaches the scan of the snapshot."""
    return df.filter(F.col(key) == value)


def _hit(key: str, value: Any) -> Column:
    return F.coalesce(F.col(key) == value, F.lit(False))


def update(df: DataFrame, value: Any, changes: Mapping[str, Any], key: str = "id") -> DataFrame:
    """Set columns of the rows with the key; all other rows, NULL keys too, stay the same."""
    types = dict(df.dtypes)
    return df.withColumns(
        {
            name: F.when(_hit(key, value), F.lit(new)).otherwise(F.col(name)).cast(types[name])
            for name, new in changes.items()
        }
    )


def update_many(df: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """Set the columns of ``changes`` on the rows with its keys, new NULLs included.

    Of several changes to one key the largest applies, so no row is multiplied. Spark
    chooses the join by the measured size of the changes.
    """
    types = dict(df.dtypes)
    names = [name for name in changes.columns if name != key]
    latest = (
        changes.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(F.struct(*names)).alias("change"))
    )
    value = {name: F.col(f"change.{name}").cast(types[name]) for name in names}
    hit = F.col("change").isNotNull()
    return df.join(latest, key, "left").select(
        *(
            F.when(hit, value[name]).otherwise(F.col(name)).alias(name) if name in value else name
            for name in df.columns
        )
    )


def delete(df: DataFrame, value: Any, key: str = "id") -> DataFrame:
    """Remove the rows with the key; rows without a key survive."""
    return df.filter(~_hit(key, value))


def delete_many(df: DataFrame, keys: DataFrame, key: str = "id") -> DataFrame:
    """Remove the rows whose key is listed; rows without a key survive."""
    return df.join(keys.select(key), key, "left_anti").select(*df.columns)


def snapshot(df: DataFrame, base: str, version: int, stage: str) -> DataFrame:
    """Write one version, read it back and check that nothing was lost.

    Fails if the version exists already. Returns the table as persisted.
    """
    path = f"{base}/v={version:05d}-{stage}"
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    stored = df.sparkSession.read.parquet(path)
    if not same_rows(df, stored):
        raise RuntimeError(f"snapshot {path} differs from what was written")
    return stored


def stage_summary(stored: DataFrame, stage: str, value: Any, key: str = "id") -> DataFrame:
    """Rows of a snapshot and how many have the key."""
    return stored.agg(
        F.count(F.lit(1)).alias("filas"),
        F.count_if(_hit(key, value)).alias("coincidencias"),
    ).select(
        F.lit(stage).alias("etapa"),
        "filas",
        F.lit(value).cast("bigint").alias("id_prueba"),
        "coincidencias",
    )


def lookup_expected(df: DataFrame, expected: DataFrame, key: str = "id") -> DataFrame:
    """Compare a short list of expected rows with the table; a missing row fails.

    The table is first reduced to the expected keys, which Spark broadcasts if they are as
    few as they should be.
    """
    names = [name for name in expected.columns if name != key]
    actual = df.join(expected.select(key), key, "left_semi").select(
        key, *(F.col(name).alias(f"actual_{name}") for name in names), F.lit(True).alias("found")
    )
    joined = expected.join(actual, key, "left")
    same = F.coalesce(F.col("found"), F.lit(False))
    for name in names:
        same = same & F.col(name).eqNullSafe(F.col(f"actual_{name}"))
    return joined.withColumn("ok", same).drop("found")
