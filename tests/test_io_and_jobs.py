import pytest
from pyspark.sql import functions as F

from vitrina import session
from vitrina.operators.compare import same_rows
from vitrina.plans import suite, validation
from vitrina.plans.cleaning import clean_catalog
from vitrina.registry.catalogs import LINE_SPEC, ORDER_SPEC, orders_clean, orders_raw
from vitrina.sources import csv_records, readers, writers

SF = "/root/testdata/sf0.001"


def test_csv_keeps_quotes_newlines_and_literals(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        'id,name,description\n1,NULL,"two\nlines, and ""quotes"""\n2,None,\n3,NaN,"x|y"\n',
        encoding="utf-8",
    )
    df = readers.read_csv(spark, str(path))
    assert set(dict(df.dtypes).values()) == {"string"}
    rows = [tuple(row) for row in df.orderBy("id").collect()]
    assert rows == [
        ("1", "NULL", 'two\nlines, and "quotes"'), ("2", "None", None), ("3", "NaN", "x|y"),
    ]


def test_csv_and_parquet_round_trip_clean_alike(spark, tmp_path):
    raw = orders_raw(spark, SF).select(*(F.col(c).cast("string") for c in orders_raw(spark, SF).columns))
    raw.write.option("header", True).option("escape", '"').csv(str(tmp_path / "csv"))
    from_csv = clean_catalog(readers.read_csv(spark, str(tmp_path / "csv")), ORDER_SPEC)
    writers.write_catalog(orders_clean(spark, SF), str(tmp_path / "parquet"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    stored = readers.read_parquet(spark, str(tmp_path / "parquet"), split_bytes=1 << 20)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    small = readers.read_parquet(spark, str(tmp_path / "parquet"), split_bytes=1 << 12)
    assert small.rdd.getNumPartitions() > stored.rdd.getNumPartitions()
    assert same_rows(from_csv, stored)
    assert any("zstd" in path for path in stored.inputFiles())


def test_existing_catalog_is_not_overwritten(spark, tmp_path):
    df = spark.range(1)
    writers.write_catalog(df, str(tmp_path / "x"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.write_catalog(df, str(tmp_path / "x"))


def test_report_keeps_order_in_one_file(spark, tmp_path):
    path = tmp_path / "report"
    writers.write_report(spark.range(100).orderBy(F.desc("id")), str(path))
    files = list(path.glob("*.csv"))
    assert len(files) == 1
    assert files[0].read_text().split() == ["id", *map(str, range(99, -1, -1))]
    rows = writers.report_frame(spark, [("q02", 1.0), ("q01", 2.0)], "query_id string, s double", "query_id")
    assert [row.query_id for row in rows.collect()] == ["q01", "q02"]


def test_suite_comparison(spark, tmp_path):
    clean = orders_clean(spark, SF)
    suite.write_suite(clean, ORDER_SPEC, str(tmp_path / "a"))
    suite.write_suite(clean, LINE_SPEC, str(tmp_path / "b"))
    paths = {"same": str(tmp_path / "b")}
    (row,) = suite.summarize_suites(spark, str(tmp_path / "a"), paths).collect()
    assert tuple(row) == ("same", 10, 10, True)
    # The same rows in another order break the contract.
    reversed_ = readers.read_result(spark, str(tmp_path / "b" / "q02")).orderBy(F.desc("release_year"))
    broken = str(tmp_path / "c")
    for name in suite.CONTRACT:
        source = reversed_ if name == "q02" else readers.read_result(spark, str(tmp_path / "b" / name))
        writers.write_report(source, f"{broken}/{name}")
    outcome = {
        row.query_id: (row.diferencias, row.en_orden)
        for row in suite.compare_suites(spark, str(tmp_path / "a"), {"c": broken}).collect()
    }
    assert outcome.pop("q02")[1] is False
    assert set(outcome.values()) == {(0, True)}


def test_validation_has_35_checks_and_finds_breaks(spark):
    clean = orders_clean(spark, SF)
    options = dict(
        expected_rows=1500,
        expected_columns=22,
        literal_rows=((1, "NULL", "item-1"), (2, "None", "item-2"), (3, "NaN", "item-3")),
    )
    checks = validation.validate_catalog(clean, ORDER_SPEC, **options).collect()
    assert len(checks) == 35
    # The test catalog lacks one of the typed columns.
    assert [row.verificacion for row in checks if not row.ok] == ["tipo rating_top"]
    broken = clean.withColumns(
        {
            "rating": F.when(F.col("id") == 1, 9.0).otherwise(F.col("rating")),
            "genres": F.when(F.col("id") == 2, "A||A").otherwise(F.col("genres")),
            "slug": F.when(F.col("id") < 3, "item-1").otherwise(F.col("slug")),
            "release_year": F.when(F.col("id") == 1, 1900).otherwise(F.col("release_year")),
        }
    )
    bad = {
        row.verificacion: row.incorrectos
        for row in validation.validate_catalog(broken, ORDER_SPEC, **options).collect()
        if not row.ok
    }
    assert bad["rating [0, 5]"] == bad["genres normalizado"] == bad["genres_count"] == 1
    assert bad["slug duplicados"] == bad["released vs release_year"] == bad["literal 2"] == 1


def test_health_gate_and_require(spark):
    clean = orders_clean(spark, SF)
    good = validation.health_gate(clean, ORDER_SPEC, 1500, (1995, 2001), 22)
    validation.require(good)
    with pytest.raises(validation.CheckFailed, match="anio minimo"):
        validation.require(validation.health_gate(clean, ORDER_SPEC, 1500, (1996, 2001)))


def test_intermediate_tables_go_to_the_shared_folder(spark):
    stored = session.materialize(spark.range(3), "probe")
    assert stored.inputFiles()[0].removeprefix("file://").startswith(session.shared_folder(spark))
    assert stored.count() == 3


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_split_csv_equals_the_multiline_reader(spark, tmp_path, line_end):
    rows = ["id,name,description"]
    for i in range(400):
        long = line_end.join(f'part {k} of {i}, ""quoted""' for k in range(i % 7))
        rows.append(f'{i},"NULL","{long}"' if i % 3 else f"{i},plain {i},")
        if i % 50 == 0:
            rows.append("")
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_bytes(line_end.join(rows).encode())
    expected = readers.read_csv(spark, str(tmp_path))
    assert expected.count() == 800
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = csv_records.read_csv_split(spark, str(tmp_path))
        assert got.rdd.getNumPartitions() > 1
        got = session.materialize(got, "csv")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert same_rows(got, session.materialize(expected, "csv"))
