"""Run times of engines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the line of a run log that states the total seconds.
TOTAL_PATTERN = r"(?iU)Tiempo\s+total(?:\s+\w+)*\s*:\s*([0-9]+(?:[.,][0-9]+)?)"

# Names of the column with the seconds in a run-time report.
SECONDS_COLUMNS = ("tiempo_segundos", "duration_seconds", "seconds", "time_seconds")


def last_total(log: Column) -> Column:
    """The last total stated in a run log, in seconds; NULL when there is none."""
    found = F.regexp_extract_all(log, F.lit(TOTAL_PATTERN), 1)
    return F.replace(F.try_element_at(found, F.lit(-1)), F.lit(","), F.lit(".")).try_cast("double")


def report_seconds(report: DataFrame) -> DataFrame:
    """Seconds per row of a run-time report read as text; decimal commas are accepted.

    The first known column with the seconds is used.
    """
    known = [name for name in SECONDS_COLUMNS if name in report.columns]
    if not known:
        raise ValueError(f"no column with seconds among {report.columns}")
    text = F.replace(F.col(known[0]).cast("string"), F.lit(","), F.lit("."))
    return report.withColumn("tiempo_segundos", text.try_cast("double"))


def engine_times(engines: DataFrame, logs: DataFrame, timings: DataFrame) -> DataFrame:
    """Seconds per engine with their source: a run log where it states a total, else the report.

    ``engines`` has ``motor`` and ``entorno``, ``logs`` has ``motor`` and ``registro`` (one
    log per engine), ``timings`` has ``motor`` and ``tiempo_segundos``.
    """
    stated = logs.select("motor", last_total(F.col("registro")).alias("stated"))
    stated = stated.groupBy("motor").agg(F.max("stated").alias("stated"))
    summed = timings.groupBy("motor").agg(F.sum("tiempo_segundos").alias("summed"))
    source = F.when(F.col("stated").isNotNull(), "registro").when(
        F.col("summed").isNotNull(), "reporte"
    )
    return (
        engines.join(stated, "motor", "left")
        .join(summed, "motor", "left")
        .select(
            "motor",
            "entorno",
            F.coalesce("stated", "summed").alias("tiempo_segundos"),
            source.alias("fuente"),
        )
        .orderBy("motor")
    )


def timing_rollup(engines: DataFrame, timings: DataFrame) -> DataFrame:
    """Seconds per engine and their ratio to the fastest; NULL for an engine without times.

    ``engines`` has the column ``motor``, ``timings`` has ``motor`` and
    ``tiempo_segundos``. Times are summed before the join.
    """
    sums = timings.groupBy("motor").agg(F.sum("tiempo_segundos").alias("tiempo_segundos"))
    totals = engines.select("motor").distinct().join(sums, "motor", "left")
    fastest = sums.select(F.min("tiempo_segundos")).scalar()
    return totals.withColumn(
        "vs_mas_rapido", F.try_divide(F.col("tiempo_segundos"), fastest)
    ).orderBy("motor")
