import datetime as dt

import pytest
from pyspark.sql import functions as F

from vitrina.functions import dates, dimensions, numbers, text


def one(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    rows = df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()
    return [row["y"] for row in rows]


def test_stripping_takes_all_whitespace(spark):
    values = ["\t a b \n", " x　", "\x0b\x0c", "", None, "plain", " é "]
    assert one(spark, values, text.stripped) == ["a b", "x", "", "", None, "plain", "é"]


def test_missing_tokens(spark):
    values = ["", " ", "NaN", "null ", "NONE", "n/a", "\tNA\n", None, "nana", "0", "none!"]
    missing = [True] * 8 + [False] * 3
    assert one(spark, values, text.is_missing) == missing
    assert one(spark, values, text.has_text) == [not m for m in missing]
    assert one(spark, values, text.normalized) == [None] * 8 + ["nana", "0", "none!"]


def test_preview_cuts_long_text(spark):
    values = ["a" * 500, "b" * 501, None]
    assert one(spark, values, text.preview) == ["a" * 500, "b" * 500 + "...", None]


def test_json_field(spark):
    values = ['{"id":4,"name":"Teen"}', '{"id":4}', "no json", None, '{"name":null}']
    result = one(spark, values, lambda c: text.json_field(c, "$.name"))
    assert result == ["Teen", None, None, None, None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_lenient_numbers(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        values = ["2.7", "-2.7", "1e3", "tbd", "NaN", "inf", "1d", "1.5F", "0x1p3", "", None, "9e99"]
        doubles = one(spark, values, numbers.lenient_double)
        assert doubles == [2.7, -2.7, 1000.0, None, None, float("inf"), None, None, None, None, None, 9e99]
        longs = one(spark, values, numbers.lenient_long)
        assert longs == [2, -2, 1000] + [None] * 9
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_half_even_and_share(spark):
    assert one(spark, [72.15625, 72.15635, None], numbers.half_even, "double") == [72.1562, 72.1564, None]
    assert one(spark, [0, 4], lambda c: numbers.share_percent(F.lit(1), c), "int") == [0.0, 25.0]


def test_out_of_range(spark):
    values = [0.0, 5.0, 5.1, -0.1, float("nan"), float("inf"), None]
    bad = one(spark, values, lambda c: numbers.out_of_range(c, 0, 5), "double")
    assert bad == [False, False, True, True, True, True, False]


def test_lenient_dates(spark):
    values = ["2020-02-29", "2019-02-29", "2020-2-3", "2020", "2020-12-1T", "20201201", "n/a", None]
    assert one(spark, values, dates.lenient_date) == [dt.date(2020, 2, 29)] + [None] * 7


def test_year_agreement(spark):
    df = spark.createDataFrame(
        [(dt.date(2020, 1, 1), 2020), (dt.date(2020, 1, 1), 2019), (None, None), (None, 2020)],
        "d date, y int",
    )
    rows = df.select(dates.year_disagrees(F.col("d"), F.col("y")).alias("bad")).collect()
    assert [row["bad"] for row in rows] == [False, True, False, True]


def test_dimensions(spark):
    values = ["Action||RPG|", "Action|Action", " RPG | Action\t|RPG", " | |", "", None, " A|　B "]
    lists = one(spark, values, dimensions.dimension_values)
    assert lists == [["Action", "RPG"], ["Action"], ["RPG", "Action"], [], [], None, ["A", "B"]]
    texts = one(spark, values, lambda c: dimensions.dimension_text(dimensions.dimension_values(c)))
    assert texts == ["Action|RPG", "Action", "RPG|Action", None, None, None, "A|B"]
    sizes = one(spark, values, lambda c: dimensions.dimension_size(dimensions.dimension_values(c)))
    assert sizes == [2, 1, 2, 0, 0, 0, 2]
    assert one(spark, values[:2], dimensions.pipe_count) == [3, 1]
    empties = one(spark, values, dimensions.has_empty_element)
    assert empties == [True, False, False, True, False, None, False]
