"""Comparing result tables: by position, as multisets, sorted, and against an order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.functions.text import stripped
from vitrina.operators.fingerprints import only_differing
from vitrina.operators.ordinals import distributed_ordinal
from vitrina.session import materialize
from vitrina.spec import TOLERANCE

ISSUE_SCHEMA = (
    "problema string, columna string, posicion bigint, "
    "esperado string, actual string, filas bigint"
)

# How far a number may be from a whole one, and the places kept otherwise.
WHOLE_TOLERANCE = 1e-9
MULTISET_PLACES = 4


def is_numeric(dtype: T.DataType) -> bool:
    """Whether values of the type are compared as numbers."""
    return isinstance(dtype, T.NumericType)


def numeric_text_columns(df: DataFrame) -> list[str]:
    """Text columns whose filled cells are all numbers; a column without any is text."""
    texts = [field.name for field in df.schema if isinstance(field.dataType, T.StringType)]
    if not texts:
        return []
    number = {name: F.col(name).try_cast("double") for name in texts}
    checks = [
        ((F.count(name) > 0) & (F.count(name) == F.count(number[name]))).alias(name)
        for name in texts
    ]
    verdict = df.agg(*checks).first()
    return [name for name in texts if verdict[name]]


def typed_result(df: DataFrame) -> DataFrame:
    """A result read as text with its number columns turned into doubles."""
    return df.withColumns(
        {name: F.col(name).cast("double") for name in numeric_text_columns(df)}
    )


def close(left: Column, right: Column, tolerance: float = TOLERANCE) -> Column:
    """Numbers within an absolute tolerance; NULL and NaN equal themselves. Never NULL."""
    a, b = left.cast("double"), right.cast("double")
    return a.eqNullSafe(b) | F.coalesce(F.abs(a - b) <= tolerance, F.lit(False))


def cells_agree(
    left: Column, right: Column, numeric: bool, tolerance: float = TOLERANCE
) -> Column:
    """Cell equality: numbers with tolerance, text exactly, NULL equal to NULL."""
    if numeric:
        return close(left, right, tolerance)
    return left.cast("string").eqNullSafe(right.cast("string"))


def _shared_types(left: DataFrame, right: DataFrame, skip: Sequence[str]) -> dict[str, bool]:
    kinds = {field.name: is_numeric(field.dataType) for field in right.schema}
    return {
        field.name: is_numeric(field.dataType) and kinds[field.name]
        for field in left.schema
        if field.name not in skip
    }


def _side_by_side(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    def prefixed(df: DataFrame, side: str) -> DataFrame:
        names = [name for name in df.columns if name not in keys]
        return df.select(*keys, *(F.col(name).alias(f"{side}_{name}") for name in names)).withColumn(
            f"in_{side}", F.lit(True)
        )

    return prefixed(left, "a").join(prefixed(right, "b"), list(keys), "full_outer")


def compare_ordered(
    expected: DataFrame, actual: DataFrame, position: str, tolerance: float = TOLERANCE
) -> DataFrame:
    """Differences of two tables row by row along ``position``; empty when they agree.

    Different columns or a different number of rows is one issue. Otherwise each
    differing column is one issue with its first bad position and its bad rows.
    """
    spark = expected.sparkSession
    if expected.columns != actual.columns:
        row = ("columnas", None, None, ",".join(expected.columns), ",".join(actual.columns), None)
        return spark.createDataFrame([row], ISSUE_SCHEMA)
    numeric = _shared_types(expected, actual, [position])
    both = _side_by_side(expected, actual, [position])
    paired = F.col("in_a") & F.col("in_b")

    def differs(name: str) -> Column:
        return paired & ~cells_agree(
            F.col(f"a_{name}"), F.col(f"b_{name}"), numeric[name], tolerance
        )

    def cell(name: str) -> Column:
        return F.struct(
            F.col(position).cast("bigint").alias("posicion"),
            F.col(f"a_{name}").cast("string").alias("esperado"),
            F.col(f"b_{name}").cast("string").alias("actual"),
        )

    single = F.col("in_a").isNull() | F.col("in_b").isNull()
    aggregates = [
        F.count("in_a").alias("rows_a"),
        F.count("in_b").alias("rows_b"),
        F.count_if(single).alias("single"),
    ]
    for name in numeric:
        aggregates.append(F.count_if(differs(name)).alias(f"n_{name}"))
        aggregates.append(F.min(F.when(differs(name), cell(name))).alias(f"first_{name}"))
    no_text, no_number = F.lit(None).cast("string"), F.lit(None).cast("bigint")

    def issue(kind: str, column: Column, at: Column, want: Column, got: Column, rows: Column):
        return F.struct(
            F.lit(kind).alias("problema"),
            column.alias("columna"),
            at.alias("posicion"),
            want.alias("esperado"),
            got.alias("actual"),
            rows.alias("filas"),
        )

    issues = [
        issue(
            "filas",
            no_text,
            no_number,
            F.col("rows_a").cast("string"),
            F.col("rows_b").cast("string"),
            F.col("single"),
        )
    ]
    for name in numeric:
        first = F.col(f"first_{name}")
        issues.append(
            issue(
                "valores",
                F.lit(name),
                first["posicion"],
                first["esperado"],
                first["actual"],
                F.when(F.col("single") == 0, F.col(f"n_{name}")).otherwise(F.lit(0)),
            )
        )
    return both.agg(*aggregates).select(F.inline(F.array(*issues))).filter("filas > 0")


def normalized_cells(df: DataFrame) -> DataFrame:
    """Cells ready for a comparison without order.

    Numbers become doubles with four places (whole when nearly so), NaN becomes NULL,
    text is stripped.
    """

    def cell(field: T.StructField) -> Column:
        column = F.col(field.name)
        if not is_numeric(field.dataType):
            return stripped(column)
        number = column.cast("double")
        whole = F.rint(number)
        slack = WHOLE_TOLERANCE * F.greatest(F.abs(number), F.abs(whole), F.lit(1.0))
        tidy = F.when(F.abs(number - whole) <= slack, whole).otherwise(
            F.bround(number, MULTISET_PLACES)
        )
        return F.nullif(tidy, F.lit(float("nan")))

    return df.select(*(cell(field).alias(field.name) for field in df.schema))


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that occur more often on one side, with ``saldo`` = left minus right.

    One grouping replaces two EXCEPT ALL: it combines before the shuffle, so copies of
    a row are counted where they are read.
    """
    names = left.columns
    signed = left.withColumn("sign", F.lit(1)).unionByName(right.withColumn("sign", F.lit(-1)))
    return signed.groupBy(*names).agg(F.sum("sign").alias("saldo")).filter("saldo <> 0")


def compare_multiset(left: DataFrame, right: DataFrame) -> DataFrame:
    """``multiset_difference`` of the normalized cells of two tables with equal columns."""
    if left.columns != right.columns:
        raise ValueError(f"columns differ: {left.columns} and {right.columns}")
    return multiset_difference(normalized_cells(left), normalized_cells(right))


def difference_by_bucket(left: DataFrame, right: DataFrame) -> DataFrame:
    """``multiset_difference`` that shuffles rows only of buckets whose fingerprints differ.

    For tables that should be equal: with few differences nearly all rows are only hashed
    where they are read.
    """
    if left.columns != right.columns:
        raise ValueError(f"columns differ: {left.columns} and {right.columns}")
    return multiset_difference(*(only_differing(left, right) or (left.limit(0), right.limit(0))))


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Whether two tables have one schema and the same rows, by their fingerprints.

    Where fingerprints differ the rows themselves decide.
    """
    if left.dtypes != right.dtypes:
        return False
    parts = only_differing(left, right)
    return parts is None or multiset_difference(*parts).isEmpty()


def compare_sorted(
    reference: DataFrame,
    candidate: DataFrame,
    tolerance: float = TOLERANCE,
    examples: int = 10,
) -> DataFrame:
    """First differing cells after both tables are sorted by all their columns.

    Differences are reported by column, then by row, at most ``examples`` of them.
    """
    if reference.columns != candidate.columns:
        raise ValueError(f"columns differ: {reference.columns} and {candidate.columns}")
    names = reference.columns
    order = [F.col(name).asc_nulls_last() for name in names]
    both = _side_by_side(
        distributed_ordinal(reference, order, "fila"),
        distributed_ordinal(candidate, order, "fila"),
        ["fila"],
    )
    numeric = _shared_types(reference, candidate, [])

    def cell(index: int, name: str) -> Column:
        a, b = F.col(f"a_{name}"), F.col(f"b_{name}")
        same = (
            close(a, b, tolerance) if numeric[name] else stripped(a).eqNullSafe(stripped(b))
        )
        return F.struct(
            F.lit(index).alias("orden"),
            F.lit(name).alias("columna"),
            a.cast("string").alias("referencia"),
            b.cast("string").alias("candidato"),
            same.alias("igual"),
        )

    cells = F.array(*(cell(index, name) for index, name in enumerate(names)))
    return (
        both.select("fila", F.inline(cells))
        .filter("NOT igual")
        .orderBy("orden", "fila")
        .limit(examples)
        .select("fila", "columna", "referencia", "candidato")
    )


def compare_aligned(
    reference: DataFrame, candidate: DataFrame, tolerance: float = TOLERANCE
) -> DataFrame:
    """Rows and cells that differ, aligned inside equal texts; empty when both agree.

    Rows that both tables have cancel out first, counted with copies. What is left is numbered
    inside each combination of its text columns, in the order of its numbers, and rows of one
    number are compared. So a missing row is one issue and moves no other row. Issues are
    ``filas`` (the numbers of rows of both tables, if they differ), ``falta`` and ``sobra`` (a
    row without a partner, with its numbers) and ``valor`` (a cell beyond the tolerance).

    Texts are compared stripped, NULL equals NULL and NaN equals NaN. Cancelling combines before
    the shuffle, and the numbers come from a range sort of what is left, so no combination of
    texts is gathered in one task.
    """
    if reference.columns != candidate.columns:
        raise ValueError(f"columns differ: {reference.columns} and {candidate.columns}")
    numeric = _shared_types(reference, candidate, [])
    texts = [name for name in reference.columns if not numeric[name]]
    numbers = [name for name in reference.columns if numeric[name]]

    def cells(df: DataFrame) -> DataFrame:
        return df.select(
            *(stripped(F.col(name)).alias(name) for name in texts),
            *(F.col(name).cast("double").alias(name) for name in numbers),
        )

    left = materialize(multiset_difference(cells(reference), cells(candidate)), "unmatched")
    order = [F.col(name).asc_nulls_last() for name in (*texts, *numbers)]
    # Text columns in one value that can be a key whether or not they are NULL.
    key = F.array(*(F.coalesce(F.concat(F.lit("t"), F.col(name)), F.lit("")) for name in texts))

    def numbered(side: int) -> DataFrame:
        copies = F.expr(f"explode(sequence(1L, {side} * saldo))")
        rows = left.filter(F.col("saldo") * side > 0).select(*texts, *numbers, copies.alias("copia"))
        placed = distributed_ordinal(rows.drop("copia").withColumn("clave", key), order, "fila")
        firsts = placed.groupBy("clave").agg(F.min("fila").alias("primera"))
        values = F.struct(*(F.col(name) for name in numbers), F.lit(True).alias("hay"))
        return placed.join(firsts, "clave").select(
            "clave", (F.col("fila") - F.col("primera")).alias("fila"), values.alias("ab"[side < 0])
        )

    both = numbered(1).join(numbered(-1), ["clave", "fila"], "full_outer")

    def issue(kind: Column, name: str | None, a: Column, b: Column) -> Column:
        return F.struct(
            kind.alias("problema"),
            F.lit(name).cast("string").alias("columna"),
            a.cast("string").alias("referencia"),
            b.cast("string").alias("candidato"),
        )

    def row_text(side: str) -> Column:
        shown = (F.coalesce(F.col(f"{side}.{name}").cast("string"), F.lit("")) for name in numbers)
        return F.when(F.col(side).isNotNull(), F.concat_ws("|", *shown))

    single = F.when(F.col("b").isNull(), "falta").when(F.col("a").isNull(), "sobra")
    issues = [issue(single, None, row_text("a"), row_text("b"))]
    for name in numbers:
        a, b = F.col(f"a.{name}"), F.col(f"b.{name}")
        wrong = F.col("a.hay") & F.col("b.hay") & ~close(a, b, tolerance)
        issues.append(issue(F.when(wrong, F.lit("valor")), name, a, b))
    named = [
        F.when(F.col("clave")[at] != "", F.substr(F.col("clave")[at], F.lit(2))).alias(name)
        for at, name in enumerate(texts)
    ]
    found = both.select(*named, "fila", F.inline(F.array(*issues))).filter("problema IS NOT NULL")
    sizes = reference.agg(F.count(F.lit(1)).alias("n")).join(
        candidate.agg(F.count(F.lit(1)).alias("m")), F.col("n") != F.col("m")
    )
    verdict = sizes.select(
        *(F.lit(None).cast("string").alias(name) for name in texts),
        F.lit(None).cast("bigint").alias("fila"),
        F.inline(F.array(issue(F.lit("filas"), None, F.col("n"), F.col("m")))),
    )
    return found.unionByName(verdict)


def order_contract(
    df: DataFrame, position: str, order: Sequence[tuple[str, bool]]
) -> DataFrame:
    """Whether rows along ``position`` (0, 1, 2, ...) follow ``order``.

    ``order`` lists columns with True for descending; NULLs come last. A table equals
    its own stable sort exactly when no row belongs before its predecessor, so each
    row is joined to the next one; no task sees the whole table.
    """
    names = [name for name, _ in order]
    current = df.select(position, *names)
    following = df.select(
        (F.col(position) - 1).alias(position), *(F.col(name).alias(f"b_{name}") for name in names)
    )

    def before(name: str, descending: bool) -> Column:
        a, b = F.col(f"b_{name}"), F.col(name)
        strictly = (a > b) if descending else (a < b)
        return F.coalesce(strictly, a.isNotNull() & b.isNull())

    def inverted(rest: Sequence[tuple[str, bool]]) -> Column:
        name, descending = rest[0]
        here = before(name, descending)
        if len(rest) == 1:
            return here
        tied = F.col(name).eqNullSafe(F.col(f"b_{name}"))
        return here | (tied & inverted(rest[1:]))

    return current.join(following, position).agg(
        F.count(F.lit(1)).alias("pares"),
        F.count_if(inverted(order)).alias("violaciones"),
    ).withColumn("ok", F.col("violaciones") == 0)


def suite_summary(outcomes: DataFrame) -> DataFrame:
    """Equal queries per engine from rows ``(motor, query_id, diferencias, en_orden)``."""
    equal = (F.col("diferencias") == 0) & F.col("en_orden")
    return (
        outcomes.groupBy("motor")
        .agg(F.count_if(equal).alias("equivalentes"), F.count(F.lit(1)).alias("consultas"))
        .withColumn("ok", F.col("equivalentes") == F.col("consultas"))
        .orderBy("motor")
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of several tables with the same columns."""
    return reduce(DataFrame.unionByName, frames)
