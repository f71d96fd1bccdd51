"""What the operators share: reading tables and carrying whole rows along."""

from __future__ import annotations

import gc
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; Spark reads it, wherever it is stored."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_and_text(docs: DataFrame, text: str) -> DataFrame:
    """``row`` with all columns of a document and ``text``, NULL read as empty.

    Inside the struct no column of the caller can clash with one of an operator.
    """
    return docs.select(
        F.struct("*").alias("row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )


def id_and_text(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id`` and ``text`` of every document and nothing else, NULL text read as empty."""
    return docs.select(
        F.col(key).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )


@contextmanager
def with_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """The session with other settings, for as long as the block runs."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


#: Spark then deletes the shuffle files of a job as soon as the job has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder; the shuffle files of its job go with the job.

    What the driver held for its plan is let go too, as a job of many steps would keep all of it.
    """
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        return materialize(df, label)
    finally:
        spark.conf.set(CLEANUP, before)
        gc.collect()
        spark._jvm.System.gc()


def discard(df: DataFrame) -> None:
    """Deletes a table made by ``written`` that no later step reads."""
    files = df.inputFiles()
    if files:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
