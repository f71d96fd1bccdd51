"""Raw catalog to clean catalog: one projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.functions.dates import lenient_date
from vitrina.functions.dimensions import dimension_size, dimension_text, dimension_values
from vitrina.functions.numbers import lenient_double, lenient_long
from vitrina.functions.text import json_field, stripped, without_tokens
from vitrina.sources.readers import present
from vitrina.spec import CatalogSpec


def clean_catalog(raw: DataFrame, spec: CatalogSpec) -> DataFrame:
    """Normalise text, type the numbers and the date, and derive year, JSON field and counts.

    Works in this order: missing tokens become NULL; numbers and the date are read
    leniently; dimensions are stripped, freed of blanks and repeats, and counted. Names
    and slugs keep their text as it is. Columns that are absent are skipped, unknown
    ones pass through, and derived columns follow the raw ones.
    """
    types = dict(raw.dtypes)
    dimensions = present(raw, spec.dimensions)
    texts = [
        name
        for name in raw.columns
        if types[name] == "string" and name not in spec.literal_columns
    ]

    # Stripping is a step of its own: later expressions mention the text several times.
    trimmed = raw.withColumns({name: stripped(F.col(name)) for name in texts})

    def typed(name: str) -> Column:
        column, is_text = F.col(name), name in texts
        if name == spec.key:
            return column.try_cast("bigint") if is_text else column
        # Missing tokens are no numbers and no dates, so they give NULL there as well.
        if name in spec.integer_columns:
            return lenient_long(column)
        if name in spec.float_columns:
            return lenient_double(column)
        if name == spec.date_column:
            return lenient_date(column) if is_text else column.cast("date")
        if name in dimensions:
            return dimension_values(without_tokens(column))
        return without_tokens(column) if is_text else column

    lists = trimmed.select(*(typed(name).alias(name) for name in raw.columns))
    columns = [
        (dimension_text(F.col(name)) if name in dimensions else F.col(name)).alias(name)
        for name in raw.columns
    ]
    if spec.date_column in types:
        columns.append(F.year(spec.date_column).alias(spec.year_column))
    if spec.json_column in types:
        columns.append(json_field(F.col(spec.json_column), spec.json_path).alias(spec.json_field))
    columns += [
        dimension_size(F.col(name)).alias(spec.dimensions[name]) for name in dimensions
    ]
    return lists.select(*columns)
