import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitrina.operators import (
    compare, duplicates, fingerprints, ordinals, profile, quantiles, rows, timings, words,
)


def test_no_task_ranks_more_than_a_fixed_number_of_values(spark):
    values = spark.range(10_000_000).selectExpr("'hot' AS grp", "id * 7919 % 10000019 AS val", "1L AS freq")
    few = spark.range(10).selectExpr("'cold' AS grp", "id AS val", "id + 1 AS freq")
    counts = values.unionByName(few)
    ranges = {row.grp: row for row in quantiles.median_ranges(counts).collect()}
    assert ranges["cold"]["values"] == 10
    assert 0 < ranges["hot"]["values"] <= quantiles.RANKED
    got = {row.grp: row["median"] for row in quantiles.split_median(counts).collect()}
    kept = sorted(number * 7919 % 10000019 for number in range(10_000_000))
    assert got == {"hot": (kept[4_999_999] + kept[5_000_000]) / 2, "cold": 6.0}


@pytest.mark.parametrize("most", [1, 2, 5])
def test_median_after_many_rounds(spark, most):
    rows = [("a", float(i * i % 101), i % 3 + 1) for i in range(300)] + [("b", 1.0, 4), ("c", float("inf"), 1)]
    counts = spark.createDataFrame(rows, "grp string, val double, freq long").groupBy("grp", "val").agg(
        F.sum("freq").alias("freq")
    )
    want = {}
    for name in "abc":
        spread = sorted(value for grp, value, times in rows if grp == name for _ in range(times))
        want[name] = (spread[(len(spread) - 1) // 2] + spread[len(spread) // 2]) / 2
    # Two values may hold the middle, so fewer than two cannot be asked for.
    got = quantiles.split_median(counts, 4, max(2, most))
    assert {row.grp: row["median"] for row in got.collect()} == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from("abc"), st.integers(-6, 6) | st.floats(-1e6, 1e6)),
        min_size=1,
        max_size=60,
    )
)
def test_split_median_is_exact(spark, pairs):
    df = spark.createDataFrame([(g, float(v)) for g, v in pairs], "g string, v double")
    expected = {g: np.median([v for h, v in pairs if h == g]) for g, _ in pairs}
    counts = df.groupBy(F.col("g").alias("grp"), F.col("v").alias("val")).agg(
        F.count(F.lit(1)).alias("freq")
    )
    for cuts in (2, 16):
        got = {row.grp: row["median"] for row in quantiles.split_median(counts, cuts).collect()}
        assert got == pytest.approx(expected, abs=1e-9)


def test_grouped_summary_paths_agree(spark):
    # One group holds most rows, and one value a third of them.
    df = spark.range(30000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(-1).alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.sqrt("id")).alias("v"),
    )
    small = quantiles.grouped_summary(df, "g", "v", True).orderBy("g").collect()
    large = quantiles.grouped_summary(df, "g", "v", False).orderBy("g").collect()
    assert len(small) == len(large) == 8
    for a, b in zip(small, large):
        assert a.asDict() == pytest.approx(b.asDict(), rel=1e-12)


def test_distributed_ordinal_is_the_global_sort(spark):
    df = spark.range(20000).select(
        "id", F.when(F.col("id") % 3 > 0, F.lit(None)).otherwise(F.col("id") % 50).alias("k")
    )
    got = ordinals.distributed_ordinal(df, [F.asc_nulls_last("k"), F.desc("id")], "pos").collect()
    assert sorted(row.pos for row in got) == list(range(20000))
    wanted = sorted(got, key=lambda row: (row.k is None, row.k or 0, -row.id))
    assert [row.pos for row in wanted] == list(range(20000))


def test_compare_ordered(spark):
    left = spark.createDataFrame(
        [(0, "a", 1.0), (1, None, float("nan")), (2, "NULL", 3.0)], "p long, t string, n double"
    )
    right = spark.createDataFrame(
        [(0, "a", 1.00005), (1, None, float("nan")), (2, "NaN", 3.1)], "p long, t string, n double"
    )
    assert compare.compare_ordered(left, left, "p").isEmpty()
    issues = {row.columna: row for row in compare.compare_ordered(left, right, "p").collect()}
    assert set(issues) == {"t", "n"}
    assert (issues["t"].posicion, issues["t"].esperado, issues["t"].actual) == (2, "NULL", "NaN")
    assert issues["n"].filas == 1
    shorter = compare.compare_ordered(left, right.limit(2), "p").collect()
    assert [(row.problema, row.esperado, row.actual) for row in shorter] == [("filas", "3", "2")]
    renamed = compare.compare_ordered(left, right.withColumnRenamed("n", "m"), "p").collect()
    assert renamed[0].problema == "columnas"


def test_numeric_columns_of_text_results(spark):
    df = spark.createDataFrame(
        [("1", "NaN", None, "2.5"), ("2", "x", None, None)], "a string, b string, c string, d string"
    )
    assert compare.numeric_text_columns(df) == ["a", "d"]
    assert dict(compare.typed_result(df).dtypes)["d"] == "double"


def test_multiset_difference(spark):
    left = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", None)], "t string, n double")
    right = spark.createDataFrame([("a ", 1.00000000001), ("b", float("nan"))], "t string, n double")
    result = [tuple(row) for row in compare.compare_multiset(left, right).collect()]
    assert result == [("a", 1.0, 1)]
    assert compare.same_rows(left, left) and not compare.same_rows(left, right)


def test_fingerprints_tell_tables_apart(spark):
    schema = "a string, b string, n double, list array<int>"
    rows = [
        ("x", None, 1.0, [1, None]),
        ("x", None, 1.0, [1, None]),
        (None, "x", float("nan"), [None, 1]),
        ("", "x", 0.0, []),
        (None, None, None, None),
    ] + [(str(n), "y", float(n), [n]) for n in range(300)]
    left = spark.createDataFrame(rows, schema)

    def moved(at, row):
        return spark.createDataFrame(rows[:at] + [row] + rows[at + 1 :], schema)

    shuffled = spark.createDataFrame(rows[::-1], schema).repartition(7)
    assert fingerprints.only_differing(left, shuffled) is None and compare.same_rows(left, shuffled)
    assert compare.difference_by_bucket(left, shuffled).isEmpty()
    for at, row in (
        (0, (None, "x", 1.0, [1, None])),
        (0, ("x", None, 1.0, [None, 1])),
        (0, ("x", None, 1.0, [1])),
        (3, ("", "x", 0.0, None)),
        (4, ("", None, None, None)),
        (4, rows[0]),
        (304, ("299", "y", 299.5, [299])),
    ):
        other = moved(at, row)
        found = {(r.a, r.b, str(r.n), str(r.list), r.saldo) for r in compare.difference_by_bucket(left, other).collect()}
        plain = {(r.a, r.b, str(r.n), str(r.list), r.saldo) for r in compare.multiset_difference(left, other).collect()}
        assert found == plain and len(found) == 2
        assert not compare.same_rows(left, other)
    # Zeros of either sign are one value, whatever their hashes are.
    assert compare.same_rows(left, moved(3, ("", "x", -0.0, [])))
    assert not compare.same_rows(left, left.limit(0)) and compare.same_rows(left.limit(0), left.limit(0))


def test_equal_tables_shuffle_only_numbers(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(1000).select("id", F.repeat(F.col("id").cast("string"), 50).alias("long")).write.parquet(path)
    buckets = fingerprints.differing_buckets(spark.read.parquet(path), spark.read.parquet(path))
    plan = buckets._jdf.queryExecution().executedPlan().toString()
    below = [line for line in plan.splitlines() if "HashAggregate(" in line and "partial_sum" in line]
    assert "Exchange" in plan and below and all("long#" not in line for line in below)
    assert buckets.isEmpty()


def test_compare_sorted(spark):
    left = spark.createDataFrame([("b", 2.0), ("a", 1.0), (None, 3.0)], "t string, n double")
    right = spark.createDataFrame([("a", 1.00001), (None, 3.0), ("b", 2.5)], "t string, n double")
    assert compare.compare_sorted(left, left.orderBy("n")).isEmpty()
    rows_ = [tuple(row) for row in compare.compare_sorted(left, right).collect()]
    assert rows_ == [(1, "n", "2.0", "2.5")]


def test_order_contract(spark):
    df = spark.createDataFrame([(0, 5, "a"), (1, 5, "b"), (2, 3, "a"), (3, None, "a")], "p long, n int, t string")
    order = [("n", True), ("t", False)]
    assert compare.order_contract(df, "p", order).first().ok
    swapped = df.withColumn("p", F.when(F.col("p") < 2, 1 - F.col("p")).otherwise(F.col("p")))
    assert compare.order_contract(swapped, "p", order).first().violaciones == 1


def test_duplicates(spark):
    df = spark.createDataFrame(
        [(1, "s", "x"), (2, "s", "y"), (2, "s", "y"), (3, None, "z"), (4, None, "z"), (5, "t", "w")],
        "id long, slug string, name string",
    )
    assert tuple(duplicates.duplicate_summary(df, ["slug"]).first()) == (2, 5, 3)
    assert tuple(duplicates.duplicate_summary(df, ["slug"], ignore_null=True).first()) == (1, 3, 2)
    group = duplicates.collision_groups(df, "slug", "id", "name").collect()
    assert [tuple(row) for row in group] == [("s", 3, 0, [1, 2], ["x", "y"], [1, 2])]


def test_large_collisions_are_split_and_whole(spark):
    df = spark.range(5000).select("id", F.lit("s").alias("slug"), F.lit("n").alias("name"))
    parts = duplicates.collision_groups(df, "slug", "id", "name", per_part=500).collect()
    assert len(parts) == 10 and all(row.cantidad == 5000 for row in parts)
    assert sorted(i for row in parts for i in row.ids) == list(range(5000))


def test_profile_counts_columns_in_one_pass(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    result = [tuple(row) for row in profile.null_profile(df).collect()]
    assert result == [("b", 1, 2, 50.0), ("a", 0, 2, 0.0)]
    empty = profile.null_profile(df.limit(0)).collect()
    assert [row.porcentaje for row in empty] == [0.0, 0.0]


def test_row_changes(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0, None), (2, "b", None, "k"), (None, "c", 3.0, None)],
        "id long, name string, rating double, extra string",
    )
    assert rows.next_id(df).first().next_id == 3
    assert rows.next_id(df.filter("false")).first().next_id == 1
    assert rows.next_id(df.withColumn("id", -F.col("id"))).first().next_id == 1
    full = df.withColumn("id", F.lit(2**63 - 1))
    with pytest.raises(Exception, match="no key is left"):
        rows.next_id(full).collect()
    new = spark.createDataFrame([(3, "new", 3)], "id int, name string, rating int")
    created = rows.create(df, new)
    assert created.dtypes == df.dtypes and rows.read(created, 3).first().extra is None
    updated = rows.update(created, 3, {"rating": 4.5})
    assert rows.read(updated, 3).first().rating == 4.5
    assert compare.same_rows(updated.filter("id IS NULL OR id <> 3"), df)
    assert compare.same_rows(rows.delete(updated, 3), df)
    with pytest.raises(ValueError):
        rows.create(df, spark.createDataFrame([(1, 2)], "id int, other int"))


def test_bulk_changes(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id long, name string")
    changes = spark.createDataFrame(
        [(1, None), (2, "m"), (2, "z"), (9, "q"), (None, "w")], "id long, name string"
    )
    assert sorted(map(tuple, rows.update_many(df, changes).collect()), key=str) == [
        (1, None), (2, "z"), (None, "c"),
    ]
    kept = rows.delete_many(df, changes).collect()
    assert [tuple(row) for row in kept] == [(None, "c")]


def test_snapshots_are_versions(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "a")], "id long, name string")
    stored = rows.snapshot(df, str(tmp_path / "t"), 0, "antes")
    assert tuple(rows.stage_summary(stored, "antes", 1).first()) == ("antes", 2, 1, 2)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        rows.snapshot(df, str(tmp_path / "t"), 0, "antes")


def test_lookup_expected(spark):
    df = spark.createDataFrame([(1, "NULL"), (2, "x")], "id long, name string")
    expected = spark.createDataFrame([(1, "NULL"), (2, "y"), (3, "z")], "id long, name string")
    verdicts = {row.id: row.ok for row in rows.lookup_expected(df, expected).collect()}
    assert verdicts == {1: True, 2: False, 3: False}


def test_word_statistics(spark):
    df = spark.createDataFrame([("a bb\tccc\n", ), ("  dddd 😀", ), (None,)], "text string")
    histogram = {row.len: row.freq for row in words.word_length_histogram(df, "text").collect()}
    assert histogram == {1: 1, 2: 2, 3: 1, 4: 1}
    stats = words.word_length_stats(df, "text").first()
    lengths = [1, 2, 2, 3, 4]
    assert (stats.total_tokens, stats.suma_longitudes, stats.suma_cuadrados) == (5, 12, 34)
    assert stats.mediana == np.median(lengths) and stats.media == np.mean(lengths)
    assert stats.desviacion_estandar == pytest.approx(np.std(lengths))


def test_timings(spark):
    engines = spark.createDataFrame([("a",), ("b",), ("c",)], "motor string")
    times = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 5.0)], "motor string, tiempo_segundos double")
    result = [tuple(row) for row in timings.timing_rollup(engines, times).collect()]
    assert result == [("a", 2.0, 1.0), ("b", 5.0, 2.5), ("c", None, None)]
    logs = spark.createDataFrame(
        [("Tiempo total consultas: 1,5\nTiempo Total : 2.25 s",), ("nothing",)], "log string"
    )
    assert [row[0] for row in logs.select(timings.last_total(F.col("log"))).collect()] == [2.25, None]
