"""Running the whole contract, and comparing written runs of it."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.operators.compare import close, suite_summary, union_all
from vitrina.plans.contract import CONTRACT, CONTRACT_ORDER
from vitrina.sources.readers import read_result
from vitrina.sources.writers import write_report
from vitrina.spec import TOLERANCE, CatalogSpec


def suite_results(clean: DataFrame, spec: CatalogSpec) -> DataFrame:
    """Number of result rows per query of the contract."""
    counts = [
        query(clean, spec)
        .agg(F.count(F.lit(1)).alias("filas_resultado"))
        .select(F.lit(name).alias("query_id"), "filas_resultado")
        for name, query in CONTRACT.items()
    ]
    return union_all(counts).orderBy("query_id")


def write_suite(clean: DataFrame, spec: CatalogSpec, path: str, parallel: int = 4) -> None:
    """Write every result of the contract as an ordered CSV report under its query id.

    A few queries are submitted at a time, so that the short last stages of one do not
    leave the executors idle.
    """

    def write(name: str) -> None:
        write_report(CONTRACT[name](clean, spec), f"{path}/{name}")

    with ThreadPoolExecutor(parallel) as pool:
        list(pool.map(write, CONTRACT))


def promised_order(name: str, spec: CatalogSpec | None = None) -> list[tuple[str, bool]]:
    """The order of a contract result by the names that ``spec`` gives the year and the key."""
    spec, roles = spec or CatalogSpec(), CatalogSpec()
    own = {roles.year_column: spec.year_column, roles.key: spec.key}
    return [(own.get(column, column), descending) for column, descending in CONTRACT_ORDER[name]]


def result_order(name: str, spec: CatalogSpec | None = None) -> list[Column]:
    """Sort columns of a contract result, NULLs last."""
    return [
        F.desc_nulls_last(column) if descending else F.asc_nulls_last(column)
        for column, descending in promised_order(name, spec)
    ]


def _written_rows(
    spark: SparkSession, path: str, engine: str, spec: CatalogSpec | None = None
) -> DataFrame:
    """The rows of a written suite with their position in the file.

    ``sin_orden`` tells that a column by which the rows should be in order is missing.

    Columns become cells, so that results of different shape share a table. The reader
    numbers the rows as it goes; a report is far below the size at which files are split.
    """
    rows = []
    for name in CONTRACT_ORDER:
        order = promised_order(name, spec)
        result = read_result(spark, f"{path}/{name}")
        missing = any(column not in result.columns for column, _ in order)
        cells = [
            F.struct(
                F.lit(place).alias("lugar"),
                F.lit(column).alias("columna"),
                F.col(f"`{column}`").cast("string").alias("texto"),
            )
            for place, column in enumerate(result.columns)
        ]

        def key(index: int) -> list[Column]:
            present = index < len(order) and order[index][0] in result.columns
            value = F.col(order[index][0]) if present else F.lit(None).cast("string")
            descending = index < len(order) and order[index][1]
            return [
                value.cast("string").alias(f"key_{index}"),
                F.lit(descending).alias(f"descending_{index}"),
            ]

        rows.append(
            result.select(
                F.lit(engine).alias("motor"),
                F.lit(name).alias("query_id"),
                F.monotonically_increasing_id().alias("posicion"),
                F.array(*cells).alias("celdas"),
                F.lit(missing).alias("sin_orden"),
                *key(0),
                *key(1),
            )
        )
    return union_all(rows)


def _before(index: int) -> Column:
    """Whether the next row's key belongs before this row's; numbers compare as numbers."""
    here, there = F.col(f"key_{index}"), F.col(f"next_{index}")
    a, b = there.try_cast("double"), here.try_cast("double")
    numeric = a.isNotNull() & b.isNotNull()
    less = F.when(numeric, a < b).otherwise(there < here)
    more = F.when(numeric, a > b).otherwise(there > here)
    strictly = F.when(F.col(f"descending_{index}"), more).otherwise(less)
    return F.coalesce(strictly, there.isNotNull() & here.isNull())


def _order_kept(rows: DataFrame) -> DataFrame:
    """Per engine and query, whether the rows follow the promised order."""
    keys = ["motor", "query_id"]
    following = rows.select(
        *keys,
        (F.col("posicion") - 1).alias("posicion"),
        F.col("key_0").alias("next_0"),
        F.col("key_1").alias("next_1"),
        F.lit(True).alias("followed"),
    )
    wrong = _before(0) | (F.col("key_0").eqNullSafe(F.col("next_0")) & _before(1))
    return (
        rows.join(following, [*keys, "posicion"], "left")
        .groupBy(*keys)
        .agg((~F.bool_or("sin_orden") & (F.count_if(F.col("followed") & wrong) == 0)).alias("en_orden"))
    )


def _paired_cells(everything: DataFrame, engines: Mapping[str, str], tolerance: float) -> DataFrame:
    """Every cell of the expected suite beside that of each engine, and what is wrong with it."""
    cells = everything.select("motor", "query_id", "posicion", F.inline("celdas"))
    engine_names = F.explode(F.array(*(F.lit(engine) for engine in engines)))
    keys = ["motor", "query_id", "posicion", "lugar", "columna"]
    wanted = cells.filter("motor = ''").select(
        engine_names.alias("motor"), *keys[1:], F.col("texto").alias("esperado"), F.lit(1).alias("a")
    )
    got = cells.filter("motor <> ''").select(
        *keys, F.col("texto").alias("actual"), F.lit(1).alias("b")
    )
    left, right = F.col("esperado"), F.col("actual")
    paired = wanted.join(got, keys, "full_outer")
    numeric = paired.groupBy("motor", "query_id", "columna").agg(
        (
            (F.count(left) + F.count(right) > 0)
            & (F.count(left) == F.count(left.try_cast("double")))
            & (F.count(right) == F.count(right.try_cast("double")))
        ).alias("numerica")
    )
    same = F.when(
        F.col("numerica"),
        close(left.try_cast("double"), right.try_cast("double"), tolerance),
    ).otherwise(left.eqNullSafe(right))
    wrong = F.when(F.col("b").isNull(), "falta").when(F.col("a").isNull(), "sobra").when(~same, "valor")
    return paired.join(numeric, ["motor", "query_id", "columna"]).withColumn("problema", wrong)


def _both_suites(spark, expected_path, engines, spec) -> DataFrame:
    expected = _written_rows(spark, expected_path, "", spec)
    return union_all(
        [expected, *(_written_rows(spark, path, engine, spec) for engine, path in engines.items())]
    )


def suite_issues(
    spark: SparkSession,
    expected_path: str,
    engines: Mapping[str, str],
    tolerance: float = TOLERANCE,
    spec: CatalogSpec | None = None,
) -> DataFrame:
    """Per engine, query and column that differ: how often, and the first bad row with both values.

    ``problema`` of that row is ``falta`` (the engine has no such cell), ``sobra`` (only the
    engine has it) or ``valor``. Columns count by name and place, as in ``compare_suites``.
    """
    cells = _paired_cells(_both_suites(spark, expected_path, engines, spec), engines, tolerance)
    first = F.min(F.struct("posicion", "problema", "esperado", "actual")).alias("first")
    return (
        cells.filter("problema IS NOT NULL")
        .groupBy("motor", "query_id", "columna")
        .agg(F.count(F.lit(1)).alias("diferencias"), first)
        .select("motor", "query_id", "columna", "diferencias", "first.*")
    )


def compare_suites(
    spark: SparkSession,
    expected_path: str,
    engines: Mapping[str, str],
    tolerance: float = TOLERANCE,
    spec: CatalogSpec | None = None,
) -> DataFrame:
    """Differing cells and kept order per engine and query, against the expected suite.

    A column is numeric for an engine if every filled cell of the expected suite and of that
    engine is a number; such cells may differ by the tolerance. Columns count by name and
    place. A missing row, or a column that is missing or elsewhere, shows as differing cells.
    Rows without the columns that order them are in no order; a result without rows is in order.
    """
    everything = _both_suites(spark, expected_path, engines, spec)
    differences = (
        _paired_cells(everything, engines, tolerance)
        .groupBy("motor", "query_id")
        .agg(F.count("problema").alias("diferencias"))
    )
    kept = _order_kept(everything)
    reference_kept = kept.filter("motor = ''").select(
        "query_id", F.col("en_orden").alias("referencia_en_orden")
    )
    pairs = spark.createDataFrame(
        [(engine, name) for engine in engines for name in CONTRACT_ORDER], "motor string, query_id string"
    )
    return (
        pairs.join(differences, ["motor", "query_id"], "left")
        .join(kept, ["motor", "query_id"], "left")
        .join(reference_kept, "query_id", "left")
        .select(
            "motor",
            "query_id",
            F.coalesce("diferencias", F.lit(0)).alias("diferencias"),
            (
                F.coalesce("en_orden", F.lit(True)) & F.coalesce("referencia_en_orden", F.lit(True))
            ).alias("en_orden"),
        )
    )


def summarize_suites(
    spark: SparkSession, expected_path: str, engines: Mapping[str, str]
) -> DataFrame:
    """Equal queries per engine."""
    return suite_summary(compare_suites(spark, expected_path, engines))
