"""Suites that differ in one way each, promises that do not hold, and means on ties."""

import shutil

import pytest
from pyspark.sql import functions as F

from vitrina.operators import quantiles
from vitrina.operators.timings import last_total
from vitrina.plans.suite import summarize_suites, write_suite
from vitrina.plans.validation import health_gate
from vitrina.registry.catalogs import ORDER_SPEC, orders_clean
from vitrina.spec import CatalogSpec

SF = "/root/testdata/sf0.001"


def test_suites_differ_by_order_of_columns_and_numbers_of_one_engine(spark, tmp_path):
    names = ("expected", "reversed", "broken", "floats")
    paths = {name: f"{tmp_path}/{name}" for name in names}
    write_suite(orders_clean(spark, SF), ORDER_SPEC, paths["expected"])
    for name in names[1:]:
        shutil.copytree(paths["expected"], paths[name])

    def rewrite(engine, query, change):
        frame = spark.read.option("header", True).csv(f"{paths['expected']}/{query}")
        target = f"{paths[engine]}/{query}"
        change(frame).coalesce(1).write.mode("overwrite").option("header", True).csv(target)

    rewrite("reversed", "q02", lambda df: df.select(*df.columns[::-1]))
    rewrite("broken", "q02", lambda df: df.withColumn("videojuegos", F.lit("abc")))
    rewrite("floats", "q02", lambda df: df.withColumn("videojuegos", F.concat("videojuegos", F.lit(".0"))))
    engines = {name: paths[name] for name in names[1:]}
    rows = {row[0]: row for row in summarize_suites(spark, paths["expected"], engines).collect()}
    equal = {name: row.asDict() for name, row in rows.items()}
    assert not equal["reversed"]["ok"] and not equal["broken"]["ok"]
    assert equal["floats"]["ok"]


def test_gate_finds_a_broken_promise(spark):
    frame = spark.createDataFrame([(1, 2000), (1, 2001)], "id long, release_year int")
    rows = health_gate(frame, CatalogSpec(unique_key=True), 2, (2000, 2001)).collect()
    assert {row.verificacion: row.ok for row in rows} == {
        "filas": True, "ids unicos": False, "anio minimo": True, "anio maximo": True,
    }


def test_log_totals_with_accents(spark):
    frame = spark.createDataFrame([("Tiempo total ejecución: 3.5",), ("TIEMPO TOTAL: 2,5",)], "t string")
    assert [row[0] for row in frame.select(last_total(F.col("t"))).collect()] == [3.5, 2.5]


@pytest.mark.parametrize("parts", [1, 7])
def test_means_on_ties_do_not_depend_on_the_way(spark, parts):
    values = spark.range(32000).select(
        (F.col("id") % 2000).alias("g"),
        (F.pmod(F.xxhash64("id"), F.lit(500)) / 100).alias("v"),
    )
    values = values.repartition(parts)
    means = [
        {row.g: round(row.mean, 12) for row in quantiles.grouped_summary(values, "g", "v", few).collect()}
        for few in (True, False)
    ]
    total = F.sum(F.col("v").cast("decimal(20,2)")).cast("double")
    exact = values.groupBy("g").agg((total / F.count("v")).alias("m"))
    assert means[0] == means[1] == {row.g: round(row.m, 12) for row in exact.collect()}


CSV_FILES = {
    "stray": 'id,size,name\n1,a,x\n2,19" monitor,B\n3,"a ""b"", c",C\n4,5" by 7",D\n5,"two\nlines",E\n',
    "crlf": 'id,size,name\r\n1,"a\r\nb",x\r\n\r\n2,"",""\r\n3,"""q""",z\r\n',
    "ends": 'id,size,name\n1,"x\n\n,""y"",\n",a\n2,b"",c\n3,"p"q,r\n4,,"last"',
}


@pytest.mark.parametrize("split_bytes", ["7", "64", "1m"])
def test_csv_read_in_parallel_is_csv_read_whole(spark, tmp_path, split_bytes):
    from vitrina.sources.csv_records import read_csv_split
    from vitrina.sources.readers import read_csv

    for name, text in CSV_FILES.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(key) for key in keys]
    for key in keys:
        spark.conf.set(key, split_bytes)
    try:
        for path in [*(str(tmp_path / f"{name}.csv") for name in CSV_FILES), str(tmp_path)]:
            got = sorted(map(str, read_csv_split(spark, path).collect()))
            assert got == sorted(map(str, read_csv(spark, path).collect())), path
    finally:
        for key, value in zip(keys, old):
            spark.conf.set(key, value)


def test_csv_that_ends_inside_quotes_fails_and_is_named(spark, tmp_path):
    from vitrina.sources.csv_records import read_csv_split

    (tmp_path / "cut.csv").write_text('id,name\n1,a\n2,"b\n3,c\n')
    with pytest.raises(Exception, match="cut.csv"):
        read_csv_split(spark, str(tmp_path / "cut.csv")).collect()


def test_a_missing_row_is_one_issue_and_moves_no_other(spark):
    from vitrina.operators.compare import compare_aligned

    schema = "t string, u string, n double"
    rows = [("a", None, float(number)) for number in range(50)] + [(None, "x", float("nan"))] * 3
    left = spark.createDataFrame(rows, schema)
    assert compare_aligned(left, left.orderBy(F.desc("n"))).isEmpty()
    right = spark.createDataFrame([*rows[1:], ("b", "", 1.0)], schema)
    found = sorted(map(tuple, compare_aligned(left, right).collect()), key=str)
    assert found == [
        ("a", None, 0, "falta", None, "0.0", None), ("b", "", 0, "sobra", None, None, "1.0"),
    ]
    moved = left.withColumn("n", F.when(F.col("n") == 7, 7.5).otherwise(F.col("n") + 1e-9))
    found = [tuple(row) for row in compare_aligned(left, moved).collect()]
    assert found == [("a", None, 7, "valor", "n", "7.0", "7.5")]
    short = compare_aligned(left, left.limit(51)).filter("problema = 'filas'").first()
    assert (short.referencia, short.candidato) == ("53", "51")
    assert compare_aligned(left.limit(0), left.limit(0)).isEmpty()
