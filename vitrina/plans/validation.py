"""Checks of a clean catalog, as tables of check, bad rows and verdict."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.functions.dates import year_disagrees
from vitrina.functions.dimensions import (
    dimension_size,
    dimension_text,
    dimension_values,
    has_empty_element,
    listed_values,
)
from vitrina.functions.numbers import out_of_range
from vitrina.operators.compare import union_all
from vitrina.operators.duplicates import duplicate_summary
from vitrina.operators.profile import columnwise
from vitrina.operators.rows import lookup_expected
from vitrina.sources.readers import columns_of_type
from vitrina.spec import (
    CLEAN_TYPES,
    EXPECTED_COLUMNS,
    EXPECTED_ROWS,
    EXPECTED_YEARS,
    LITERAL_ROWS,
    CatalogSpec,
)

RANGE_COLUMNS = ("rating", "metacritic", "playtime")


def row_checks(spec: CatalogSpec) -> dict[str, Column]:
    """Named conditions that mark a bad row of a clean catalog; NULL is not bad."""
    checks = {
        "id null": F.col(spec.key).isNull(),
        "name null": F.col("name").isNull(),
        "slug null": F.col("slug").isNull(),
        "released vs release_year": year_disagrees(
            F.col(spec.date_column), F.col(spec.year_column)
        ),
    }
    for name, counted in spec.dimensions.items():
        values = dimension_values(F.col(name))
        checks[f"{name} normalizado"] = ~F.col(name).eqNullSafe(dimension_text(values))
        checks[counted] = ~F.col(counted).eqNullSafe(dimension_size(values))
    checks["rating [0, 5]"] = out_of_range(F.col("rating"), 0, 5)
    checks["metacritic [0, 100]"] = out_of_range(F.col("metacritic"), 0, 100)
    checks["playtime >= 0"] = out_of_range(F.col("playtime"), 0)
    return checks


def validate_catalog(
    clean: DataFrame,
    spec: CatalogSpec,
    expected_rows: int = EXPECTED_ROWS,
    expected_columns: int = EXPECTED_COLUMNS,
    expected_types: Mapping[str, str] = CLEAN_TYPES,
    literal_rows: Sequence[tuple] = LITERAL_ROWS,
) -> DataFrame:
    """All checks of a clean catalog: ``verificacion``, ``incorrectos`` and ``ok``.

    Two checks of shape, five of the keys, one per literal row, one per typed column,
    one of the dates, two per dimension and three ranges. Conditions on rows are one
    pass; each repeated-key check is one grouping.
    """
    types = dict(clean.dtypes)
    conditions: dict[str, Column] = {
        "filas": F.abs(F.count(F.lit(1)) - F.lit(expected_rows)),
        "columnas": F.lit(abs(len(types) - expected_columns)).cast("bigint"),
    }
    conditions |= {name: F.count_if(bad) for name, bad in row_checks(spec).items()}
    conditions |= {
        f"tipo {name}": F.lit(int(types.get(name) != expected)).cast("bigint")
        for name, expected in expected_types.items()
    }
    one_pass = columnwise(
        clean,
        {name: {"incorrectos": F.coalesce(bad, F.lit(0))} for name, bad in conditions.items()},
        label="verificacion",
    )
    repeated = [
        duplicate_summary(clean, [key], ignore_null=ignore).select(
            F.lit(f"{key} duplicados").alias("verificacion"),
            F.col("duplicados").alias("incorrectos"),
        )
        for key, ignore in ((spec.key, False), ("slug", True))
    ]
    expected = clean.sparkSession.createDataFrame(
        list(literal_rows), f"{spec.key} bigint, name string, slug string"
    )
    literals = (
        lookup_expected(clean, expected, spec.key)
        .groupBy(spec.key)
        .agg(F.count_if(~F.col("ok")).alias("incorrectos"))
        .select(
            F.concat(F.lit("literal "), F.col(spec.key).cast("string")).alias("verificacion"),
            "incorrectos",
        )
    )
    return (
        union_all([one_pass, *repeated, literals])
        .withColumn("ok", F.col("incorrectos") == 0)
        .orderBy("verificacion")
    )


def value_ranges(clean: DataFrame, spec: CatalogSpec) -> DataFrame:
    """Lowest and highest value of the checked columns, as text, dates included."""
    names = [*RANGE_COLUMNS, spec.date_column]
    return columnwise(
        clean,
        {
            name: {
                "minimo": F.min(name).cast("string"),
                "maximo": F.max(name).cast("string"),
            }
            for name in names
        },
    ).orderBy("columna")


def audit_catalog(clean: DataFrame, spec: CatalogSpec) -> DataFrame:
    """Structural problems: ``auditoria`` and ``problemas``, with their total.

    Counts NaN per float column, ratings out of range, years that disagree, and per
    dimension blank elements, wrong counts and repeated pairs of key and value. The
    NaN counts are for information and not part of the total.
    """
    nan = {
        f"nan {name}": F.isnan(name) for name in columns_of_type(clean, "double", "float")
    }
    rating = F.col("rating").cast("double")
    problems = {
        "rating": F.col("rating").isNotNull() & ((rating < 0) | (rating > 5) | F.isnan(rating)),
        "release_year": year_disagrees(F.col(spec.date_column), F.col(spec.year_column)),
    }
    for name, counted in spec.dimensions.items():
        problems[f"vacios {name}"] = has_empty_element(F.col(name))
        problems[f"conteo {name}"] = ~F.coalesce(F.col(counted), F.lit(-1)).eqNullSafe(
            dimension_size(dimension_values(F.col(name)))
        )
    one_pass = columnwise(
        clean,
        {name: {"problemas": F.count_if(bad)} for name, bad in (nan | problems).items()},
        label="auditoria",
    )
    findings = one_pass.unionByName(repeated_pairs(clean, spec))
    # Every finding is a row of its own and a part of the total, so the table is read once for both.
    total = F.when(~F.col("auditoria").startswith("nan "), F.col("problemas"))
    shares = F.array(
        F.struct("auditoria", "problemas"),
        F.struct(F.lit("total").alias("auditoria"), total.alias("problemas")),
    )
    return (
        findings.select(F.inline(shares))
        .groupBy("auditoria")
        .agg(F.sum("problemas").alias("problemas"))
        .orderBy("auditoria")
    )


def repeated_pairs(clean: DataFrame, spec: CatalogSpec) -> DataFrame:
    """Pairs of key and dimension value that occur more than once, per dimension.

    All dimensions are exploded together and grouped once. A pair carries the number of its
    dimension, as a name in each would be a good part of what is shuffled.
    """
    texts = [
        F.struct(F.lit(number).cast("tinyint").alias("dimension"), F.col(name).alias("valores"))
        for number, name in enumerate(spec.dimensions)
    ]
    pairs = (
        clean.select(spec.key, F.inline(F.array(*texts)))
        .filter(F.col("valores").isNotNull())
        # A column before it is exploded, as the text is split by compiled code then.
        .select(spec.key, "dimension", listed_values(F.col("valores")).alias("valores"))
        .select(spec.key, "dimension", F.explode_outer("valores").alias("valor"))
        # For ``explode`` Spark adds a filter on the array, which would split every text twice.
        .filter(F.col("valor").isNotNull())
    )
    counts = pairs.groupBy(spec.key, "dimension", "valor").agg(F.count(F.lit(1)).alias("veces"))
    return counts.agg(
        *(
            F.count_if((F.col("dimension") == number) & (F.col("veces") > 1)).alias(name)
            for number, name in enumerate(spec.dimensions)
        )
    ).select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(f"pares {name}").alias("auditoria"),
                        F.col(name).alias("problemas"),
                    )
                    for name in spec.dimensions
                )
            )
        )
    )


def health_gate(
    clean: DataFrame,
    spec: CatalogSpec,
    expected_rows: int = EXPECTED_ROWS,
    expected_years: tuple[int, int] = EXPECTED_YEARS,
    expected_columns: int | None = None,
) -> DataFrame:
    """Whether rows, distinct keys and the first and last year are as expected.

    Keys are always counted, as the gate is there to find a promise that does not hold.
    """
    facts = {
        "filas": (F.count(F.lit(1)), expected_rows),
        "ids unicos": (F.count_distinct(spec.key), expected_rows),
        "anio minimo": (F.min(spec.year_column), expected_years[0]),
        "anio maximo": (F.max(spec.year_column), expected_years[1]),
    }
    if expected_columns is not None:
        facts["columnas"] = (F.lit(len(clean.columns)), expected_columns)
    return (
        columnwise(
            clean,
            {
                name: {"actual": actual.cast("bigint"), "esperado": F.lit(value).cast("bigint")}
                for name, (actual, value) in facts.items()
            },
            label="verificacion",
        )
        .withColumn("ok", F.col("actual").eqNullSafe(F.col("esperado")))
        .orderBy("verificacion")
    )


class CheckFailed(RuntimeError):
    """Some check of a catalog failed."""


def require(checks: DataFrame) -> None:
    """Fail with the names of the failed rows of a checks table."""
    failed = [row[0] for row in checks.filter(~F.col("ok")).select("verificacion").collect()]
    if failed:
        raise CheckFailed(", ".join(failed))
