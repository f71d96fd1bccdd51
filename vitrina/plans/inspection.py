"""First look at a table, its values and its key collisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrina.functions.dates import lenient_date
from vitrina.functions.numbers import half_even, parsed_double
from vitrina.functions.text import has_text, preview, stripped
from vitrina.operators.duplicates import collision_groups
from vitrina.operators.profile import count_share, long_form, null_profile, value_frequency
from vitrina.operators.quantiles import grouped_summary
from vitrina.sources.readers import present
from vitrina.spec import MINIMUM_ROWS, MULTI_VALUE_TEXT, CatalogSpec


def inspect_table(df: DataFrame, minimum_rows: int = MINIMUM_ROWS) -> DataFrame:
    """Per column: position, type, NULLs and their share, and whether the table is large enough."""
    fields = [
        F.struct(F.lit(index).alias("orden"), F.lit(dtype).alias("tipo"))
        for index, (_, dtype) in enumerate(df.dtypes, start=1)
    ]
    described = F.element_at(
        F.map_from_arrays(F.array(*(F.lit(name) for name in df.columns)), F.array(*fields)),
        F.col("columna"),
    )
    return (
        count_share(df, {name: F.col(name).isNull() for name in df.columns}, "nulos")
        .withColumn("campo", described)
        .select(
            F.col("campo.orden").alias("orden"),
            "columna",
            F.col("campo.tipo").alias("tipo"),
            "nulos",
            "porcentaje",
            "filas",
            (F.col("filas") >= minimum_rows).alias("suficientes"),
        )
        .orderBy("orden")
    )


def sample_values(
    raw: DataFrame, columns: Sequence[str] = MULTI_VALUE_TEXT, count: int = 5
) -> DataFrame:
    """The first distinct filled values of each column, shortened for display.

    All columns are read in one pass. Each task keeps its own first values before the
    shuffle by column, so no task receives all values of a column.
    """
    texts = long_form(
        raw,
        {
            name: F.when(has_text(F.col(name)), stripped(F.col(name)))
            for name in present(raw, columns)
        },
    )
    distinct = texts.filter("valor IS NOT NULL").distinct()
    first = Window.partitionBy("columna").orderBy("valor")
    return (
        distinct.withColumn("orden", F.row_number().over(first))
        .filter(F.col("orden") <= count)
        .select("columna", "orden", preview(F.col("valor")).alias("valor"))
        .orderBy("columna", "orden")
    )


def numeric_describe(raw: DataFrame, spec: CatalogSpec, few_values: bool = False) -> DataFrame:
    """Lowest, highest, mean and median number per numeric column of a raw table."""
    numbers = {
        name: F.nullif(parsed_double(stripped(F.col(name))), F.lit(float("nan")))
        for name in present(raw, spec.numeric_columns)
    }
    summary = grouped_summary(long_form(raw, numbers), "columna", "valor", few_values)
    return summary.select(
        "columna",
        F.col("low").alias("min"),
        F.col("high").alias("max"),
        half_even(F.col("mean"), 6).alias("mean"),
        half_even(F.col("median"), 6).alias("median"),
    ).orderBy("columna")


def date_range(raw: DataFrame, spec: CatalogSpec) -> DataFrame:
    """First and last valid date of a raw table."""
    date = lenient_date(stripped(F.col(spec.date_column)))
    return raw.agg(F.min(date).alias("fecha_minima"), F.max(date).alias("fecha_maxima"))


def flag_frequency(raw: DataFrame, column: str = "tba") -> DataFrame:
    """Rows per filled value of a column, without regard to case."""
    return value_frequency(
        raw.filter(has_text(F.col(column))), F.lower(stripped(F.col(column))), column
    )


def slug_collisions(clean: DataFrame, spec: CatalogSpec, slug: str = "slug") -> DataFrame:
    """Slugs shared by several rows, with their keys and names."""
    return collision_groups(clean, slug, spec.key, "name")


def rows_without_slug(
    clean: DataFrame, raw: DataFrame, spec: CatalogSpec, slug: str = "slug"
) -> DataFrame:
    """The raw rows of those items whose slug is NULL after cleaning."""
    missing = clean.filter(F.col(slug).isNull()).select(spec.key)
    return raw.select(spec.key, "name", slug).join(missing, spec.key, "left_semi")


__all__ = [
    "date_range",
    "flag_frequency",
    "inspect_table",
    "null_profile",
    "numeric_describe",
    "rows_without_slug",
    "sample_values",
    "slug_collisions",
]
