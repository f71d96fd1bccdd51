"""Per-column counts: one pass over the table, one result row per column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.functions.numbers import share_percent


def columnwise(
    df: DataFrame,
    measures: Mapping[str, Mapping[str, Column]],
    label: str = "columna",
    totals: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Evaluate aggregates for many columns in one pass and list them as rows.

    ``measures`` maps a row label to its named aggregates; every row has the same names.
    ``totals`` are aggregates of the table repeated in each row.
    """
    aggregates = [
        aggregate.alias(f"{row}__{name}")
        for row, named in measures.items()
        for name, aggregate in named.items()
    ]
    shared = dict(totals or {})
    aggregates += [aggregate.alias(name) for name, aggregate in shared.items()]
    rows = [
        F.struct(
            F.lit(row).alias(label),
            *(F.col(f"{row}__{name}").alias(name) for name in named),
            *(F.col(name) for name in shared),
        )
        for row, named in measures.items()
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def count_share(df: DataFrame, conditions: Mapping[str, Column], name: str) -> DataFrame:
    """Rows that meet each condition, with their share, largest first."""
    counted = columnwise(
        df,
        {row: {name: F.count_if(condition)} for row, condition in conditions.items()},
        totals={"filas": F.count(F.lit(1))},
    )
    return counted.withColumn("porcentaje", share_percent(F.col(name), F.col("filas"))).orderBy(
        F.desc(name), "columna"
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column, with their share of the rows."""
    names = columns if columns is not None else df.columns
    return count_share(df, {name: F.col(name).isNull() for name in names}, "nulos")


def value_frequency(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return (
        df.groupBy(value.alias(name))
        .agg(F.count(F.lit(1)).alias("len"))
        .orderBy(F.desc("len"), name)
    )


def long_form(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """One row ``(columna, valor)`` per row and expression; all of one type."""
    pairs = [
        F.struct(F.lit(name).alias("columna"), value.alias("valor"))
        for name, value in columns.items()
    ]
    return df.select(F.inline(F.array(*pairs)))
