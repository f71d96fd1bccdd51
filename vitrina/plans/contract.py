"""The ten queries of the catalog contract.

Every result has a fixed column list and a total order. Result names are part of the
contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.functions.numbers import exact_mean, half_even
from vitrina.operators.explode import explode_dimension
from vitrina.operators.quantiles import grouped_summary
from vitrina.spec import CatalogSpec


def _items(spec: CatalogSpec) -> Column:
    """Distinct keys; a plain count where the key is unique, which needs no shuffle by key."""
    return F.count(F.lit(1)) if spec.unique_key else F.count_distinct(spec.key)


def q01_overview(clean: DataFrame, spec: CatalogSpec) -> DataFrame:
    """Rows, distinct keys, first and last year, and coverage of four columns.

    Distinct keys are counted even if they are promised to be unique: the count is a check.
    """
    return clean.agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.count_distinct(spec.key).alias("ids_unicos"),
        F.min(spec.year_column).alias("anio_minimo"),
        F.max(spec.year_column).alias("anio_maximo"),
        F.count("rating").alias("juegos_con_rating"),
        F.count("metacritic").alias("juegos_con_metacritic"),
        F.count("genres").alias("juegos_con_genero"),
        F.count("platforms").alias("juegos_con_plataforma"),
    )


def q02_items_per_year(clean: DataFrame, spec: CatalogSpec) -> DataFrame:
    """Items per release year."""
    year = spec.year_column
    return (
        clean.filter(F.col(year).isNotNull())
        .groupBy(year)
        .agg(_items(spec).alias("videojuegos"))
        .orderBy(year)
    )


def top_values(clean: DataFrame, dimension: str, spec: CatalogSpec) -> DataFrame:
    """The values of a dimension that most items have; ties in the order of the value."""
    pairs = explode_dimension(clean, dimension, spec, with_key=False)
    # Pairs are distinct by now, so rows count items; a NULL key is no item.
    items = F.count(F.lit(1)) if spec.unique_key else F.count(spec.key)
    return (
        pairs.groupBy(dimension)
        .agg(items.alias("videojuegos"))
        .orderBy(F.desc("videojuegos"), dimension)
        .limit(spec.top_k)
    )


def q03_top_genres(clean: DataFrame, spec: CatalogSpec) -> DataFrame:
    """Genres by number of items."""
    return top_values(clean, "genres", spec)


def q04_top_platforms(clean: DataFrame, spec: CatalogSpec) -> DataFrame:
    """Platforms by number of items."""
    return top_values(clean, "platforms", spec)


def q05_top_developers(clean: DataFrame, spec: CatalogSpec) -> DataFrame:
    """Developers by number of items."""
    return top_values(clean, "developers", spec)


def metric_by_dimension(
    clean: DataFrame,
    metric: str,
    support: int,
    spec: CatalogSpec,
    dimension: str = "genres",
    with_maximum: bool = False,
    few_values: bool | None = None,
) -> DataFrame:
    """Mean and median of a metric per dimension value with at least ``support`` items.

    Rows without the metric go first, so that a repeated key keeps a value if any of
    its rows has one. Whether the metric has few distinct values is up to the spec.
    """
    rated = clean.filter(F.col(metric).isNotNull())
    if not spec.unique_key:
        rated = rated.filter(F.col(spec.key).isNotNull())
    pairs = explode_dimension(rated, dimension, spec, extras=[metric], with_key=False)
    few = metric in spec.few_valued if few_values is None else few_values
    summary = grouped_summary(pairs, dimension, metric, few)
    columns = [
        F.col(dimension),
        F.col("n").alias(f"juegos_con_{metric}"),
        half_even(F.col("mean")).alias(f"{metric}_promedio"),
        half_even(F.col("median")).alias(f"{metric}_mediano"),
    ]
    if with_maximum:
        columns.append(F.col("high").alias(f"{metric}_maximo"))
    return (
        summary.filter(F.col("n") >= support)
        .select(*columns)
        .orderBy(F.desc(f"{metric}_promedio"), dimension)
        .limit(spec.top_k)
    )


def q06_rating_by_genre(clean: DataFrame, spec: CatalogSpec, **options) -> DataFrame:
    """Rating by genre."""
    return metric_by_dimension(clean, "rating", spec.rating_support, spec, **options)


def q07_metacritic_by_genre(clean: DataFrame, spec: CatalogSpec, **options) -> DataFrame:
    """Critics' score by genre."""
    return metric_by_dimension(clean, "metacritic", spec.metacritic_support, spec, **options)


def q08_top_items(clean: DataFrame, spec: CatalogSpec) -> DataFrame:
    """Items with most ratings; ties by key."""
    return (
        clean.filter(F.col("ratings_count").isNotNull())
        .select(
            spec.key,
            "name",
            spec.year_column,
            "rating",
            "ratings_count",
            "reviews_count",
            "genres",
        )
        .orderBy(F.desc("ratings_count"), spec.key)
        .limit(spec.top_k)
    )


def q09_playtime_by_genre(clean: DataFrame, spec: CatalogSpec, **options) -> DataFrame:
    """Playtime by genre, with the longest."""
    return metric_by_dimension(
        clean, "playtime", spec.playtime_support, spec, with_maximum=True, **options
    )


def q10_yearly_evolution(clean: DataFrame, spec: CatalogSpec) -> DataFrame:
    """Items, ratings and scores per release year; a year without ratings totals 0."""
    year = spec.year_column
    return (
        clean.filter(F.col(year).isNotNull())
        .groupBy(year)
        .agg(
            _items(spec).alias("videojuegos"),
            F.count("rating").alias("juegos_con_rating"),
            half_even(exact_mean(F.col("rating"))).alias("rating_promedio"),
            F.count("metacritic").alias("juegos_con_metacritic"),
            half_even(exact_mean(F.col("metacritic"))).alias("metacritic_promedio"),
            F.coalesce(F.sum("ratings_count"), F.lit(0)).alias("total_ratings"),
        )
        .orderBy(year)
    )


CONTRACT: dict[str, Callable[[DataFrame, CatalogSpec], DataFrame]] = {
    "q01": q01_overview,
    "q02": q02_items_per_year,
    "q03": q03_top_genres,
    "q04": q04_top_platforms,
    "q05": q05_top_developers,
    "q06": q06_rating_by_genre,
    "q07": q07_metacritic_by_genre,
    "q08": q08_top_items,
    "q09": q09_playtime_by_genre,
    "q10": q10_yearly_evolution,
}

# The order each result promises: column, True for descending.
CONTRACT_ORDER: dict[str, list[tuple[str, bool]]] = {
    "q01": [("total_registros", False)],
    "q02": [("release_year", False)],
    "q03": [("videojuegos", True), ("genres", False)],
    "q04": [("videojuegos", True), ("platforms", False)],
    "q05": [("videojuegos", True), ("developers", False)],
    "q06": [("rating_promedio", True), ("genres", False)],
    "q07": [("metacritic_promedio", True), ("genres", False)],
    "q08": [("ratings_count", True), ("id", False)],
    "q09": [("playtime_promedio", True), ("genres", False)],
    "q10": [("release_year", False)],
}
