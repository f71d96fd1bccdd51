"""Writing catalogs and reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def write_catalog(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet with zstd, one file per task: nothing is gathered."""
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """One ordered CSV file with a header.

    For small reports only (a top list, one row per year): the single file is written
    by one task. Whole catalogs go through ``write_catalog``.
    """
    (
        df.coalesce(1)
        .write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def report_frame(spark: SparkSession, rows: Iterable[tuple], schema: str, order: str) -> DataFrame:
    """A few driver-side records (such as run times) as an ordered table."""
    return spark.createDataFrame(list(rows), schema).orderBy(order)
