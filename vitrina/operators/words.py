"""Word lengths of raw text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the characters that separate words.
SEPARATORS = r"[ \t\n\r\f]+"


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units, the length that word counts on the JVM report."""
    characters = F.length(text)
    units = (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")
    return F.when(F.octet_length(text) == characters, characters).otherwise(units)


def word_length_histogram(df: DataFrame, column: str) -> DataFrame:
    """Words per length. Counts combine before the shuffle; the result is small."""
    words = df.select(F.explode(F.split(F.col(column), SEPARATORS)).alias("word"))
    return (
        words.filter("word <> ''")
        .groupBy(utf16_length(F.col("word")).cast("bigint").alias("len"))
        .agg(F.count(F.lit(1)).alias("freq"))
    )


def histogram_stats(histogram: DataFrame) -> DataFrame:
    """Statistics of a length that occurs ``freq`` times.

    Count, sum, mean, exact median (mean of the two middle ranks), population standard
    deviation, and the sum of squares.
    """
    length, freq = F.col("len"), F.col("freq")
    squares = F.sum(length * length * freq)
    mean = F.sum(length * freq) / F.sum(freq)
    return histogram.agg(
        F.sum(freq).alias("total_tokens"),
        F.sum(length * freq).alias("suma_longitudes"),
        mean.alias("media"),
        F.percentile(length, 0.5, freq).alias("mediana"),
        # Rounding may leave a difference just below zero.
        F.sqrt(F.greatest(squares / F.sum(freq) - mean * mean, F.lit(0.0))).alias("desviacion_estandar"),
        squares.alias("suma_cuadrados"),
    )


def word_length_stats(df: DataFrame, column: str) -> DataFrame:
    """Word-length statistics of a text column."""
    return histogram_stats(word_length_histogram(df, column))
