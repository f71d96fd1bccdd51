"""Quality profile of a raw catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.functions.dates import lenient_date
from vitrina.functions.numbers import parsed_double
from vitrina.functions.text import is_missing, stripped
from vitrina.operators.duplicates import duplicate_summary
from vitrina.operators.profile import columnwise, count_share
from vitrina.sources.readers import present
from vitrina.spec import PROFILED_COLUMNS, CatalogSpec


def duplicate_profile(raw: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Repeated values of each key column; NULLs form one group."""
    summaries = [
        duplicate_summary(raw, [key]).select(F.lit(key).alias("clave"), "*") for key in keys
    ]
    result = summaries[0]
    for summary in summaries[1:]:
        result = result.unionByName(summary)
    return result


def missing_profile(raw: DataFrame, columns: Sequence[str] = PROFILED_COLUMNS) -> DataFrame:
    """Missing values per column: NULLs and missing tokens."""
    names = present(raw, columns)
    return count_share(raw, {name: is_missing(F.col(name)) for name in names}, "faltantes")


def numeric_validity(raw: DataFrame, spec: CatalogSpec) -> DataFrame:
    """Valid, missing and invalid cells per column that should hold numbers."""

    def counts(name: str) -> dict:
        missing = is_missing(F.col(name))
        number = parsed_double(stripped(F.col(name)))
        return {
            "validos": F.count_if(~missing & number.isNotNull()),
            "faltantes": F.count_if(missing),
            "invalidos": F.count_if(~missing & number.isNull()),
        }

    names = present(raw, spec.numeric_columns)
    return columnwise(raw, {name: counts(name) for name in names}).orderBy("columna")


def date_validity(raw: DataFrame, spec: CatalogSpec) -> DataFrame:
    """Missing, valid and invalid dates."""
    column = F.col(spec.date_column)
    missing, date = is_missing(column), lenient_date(stripped(column))
    return raw.agg(
        F.count_if(missing).alias("faltantes"),
        F.count_if(~missing & date.isNotNull()).alias("fechas_validas"),
        F.count_if(~missing & date.isNull()).alias("fechas_invalidas"),
    )
