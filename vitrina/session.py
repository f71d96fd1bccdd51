"""Session defaults and the shared folder used for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Plans are built from many small expressions; recording the call site of each is slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # A projection over many columns makes a generated method that the JVM leaves
    # uncompiled above this size; past it Spark generates smaller methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def keep_compilable(spark: SparkSession) -> None:
    """Set the limit on generated methods in a session that ``build_session`` did not make.

    It changes no result. A session that has a lower limit keeps it.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name, "65535")) > int(SESSION_DEFAULTS[name]):
        spark.conf.set(name, SESSION_DEFAULTS[name])


def build_session(app_name: str, **overrides: str) -> SparkSession:
    """A session with the defaults above.

    The number of shuffle partitions stays what the cluster sets: adaptive execution
    merges small ones, so it only has to be large enough for the data.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_DEFAULTS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one in the warehouse.

    Both are places that a cluster shares; no folder of a single machine is ever chosen here.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/vitrina-intermediate"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Have the file system drop ``path`` when the session's JVM ends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Used where two branches of a plan must see the same evaluation; the written table
    survives the loss of executors. It is deleted when the session ends.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    delete_at_end(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
