import datetime as dt

from pyspark.sql import functions as F

from vitrina.operators.explode import explode_dimension
from vitrina.plans import contract
from vitrina.plans.cleaning import clean_catalog
from vitrina.session import materialize
from vitrina.spec import CatalogSpec

GENERAL = CatalogSpec(rating_support=1, metacritic_support=1, playtime_support=1)
UNIQUE = CatalogSpec(
    unique_key=True, rating_support=1, metacritic_support=1, playtime_support=1
)

RAW_SCHEMA = (
    "id string, name string, slug string, released string, rating string, metacritic string, "
    "playtime string, ratings_count string, reviews_count string, genres string, "
    "platforms string, developers string, publishers string, esrb_rating string, extra string"
)
RAW = [
    ("1", "NULL", "null", "2020-01-05", "4.5", "90.0", "10", "7", "1", "Action||RPG|", "PC", "A|B", "P", '{"name":"Teen"}', " n/a "),
    ("2", "None", "none", "2020-02-30", "nan", "80", "", "9", None, "Action|Action", "PC| PS ", None, "", "nan", "kept "),
    (" 3 ", " NaN ", "nan", "1999-12-31", "3.5", "tbd", "30", "9", "2", " | |", "N/A", "A", "P|P", None, None),
    ("4", "x", "x", None, "2.5", None, None, None, "3", "RPG", None, "B", None, "{bad", None),
]


def clean(spark):
    return materialize(clean_catalog(spark.createDataFrame(RAW, RAW_SCHEMA), UNIQUE), "clean")


def test_cleaning(spark):
    df = clean(spark)
    types = dict(df.dtypes)
    assert types["id"] == types["metacritic"] == types["ratings_count"] == "bigint"
    assert types["released"] == "date" and types["release_year"] == "int"
    assert df.columns[15:] == [
        "release_year", "esrb_rating_name", "genres_count", "platforms_count",
        "developers_count_clean", "publishers_count",
    ]
    one, two, three, four = df.orderBy("id").collect()
    assert (one.name, two.name, three.name) == ("NULL", "None", " NaN ")
    assert one.genres == "Action|RPG" and one.genres_count == 2
    assert two.genres == "Action" and two.rating is None and two.playtime is None
    assert two.released is None and two.release_year is None
    assert three.genres is None and three.genres_count == 0 and three.metacritic is None
    assert three.released == dt.date(1999, 12, 31) and three.publishers == "P"
    assert one.esrb_rating_name == "Teen" and four.esrb_rating_name is None
    assert one.extra is None and two.extra == "kept"


def test_cleaning_is_idempotent(spark):
    df = clean(spark)
    again = clean_catalog(df.select(*df.columns[:15]), UNIQUE)
    assert again.exceptAll(df).isEmpty() and df.exceptAll(again).isEmpty()


def test_cleaning_is_one_stage(spark):
    plan = clean_catalog(spark.createDataFrame(RAW, RAW_SCHEMA), UNIQUE)._jdf.queryExecution()
    assert "Exchange" not in plan.executedPlan().toString()


def test_promises_do_not_change_results(spark):
    df = clean(spark)
    promised = CatalogSpec(
        unique_key=True, normalized=True, rating_support=1, metacritic_support=1, playtime_support=1
    )
    for query in contract.CONTRACT.values():
        expected = [tuple(row) for row in query(df, GENERAL).collect()]
        assert [tuple(row) for row in query(df, UNIQUE).collect()] == expected
        assert [tuple(row) for row in query(df, promised).collect()] == expected


def test_unsupported_groups_are_left_out(spark):
    rows = contract.q06_rating_by_genre(clean(spark), CatalogSpec(rating_support=2)).collect()
    assert [tuple(row) for row in rows] == [("RPG", 2, 3.5, 3.5)]


def test_year_without_ratings_totals_zero(spark):
    df = spark.createDataFrame(
        [(1, 2020, None, None, None)],
        "id long, release_year int, rating double, metacritic long, ratings_count long",
    )
    assert contract.q10_yearly_evolution(df, UNIQUE).first().total_ratings == 0


def test_repeated_keys_count_once_and_keep_a_value(spark):
    df = spark.createDataFrame(
        [(1, "A|B", None), (1, "A", 2.0), (1, "A", 4.0), (2, "A", 1.0), (None, "A", 5.0)],
        "id long, genres string, rating double",
    )
    top = contract.top_values(df, "genres", GENERAL).collect()
    assert [tuple(row) for row in top] == [("A", 2), ("B", 1)]
    rated = contract.q06_rating_by_genre(df, GENERAL).collect()
    assert [tuple(row) for row in rated] == [("A", 2, 2.5, 2.5)]


def test_ties_are_in_order_of_the_value(spark):
    df = spark.createDataFrame([(1, "b|a|C")], "id long, genres string")
    assert [row.genres for row in contract.top_values(df, "genres", UNIQUE).collect()] == ["C", "a", "b"]


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "clean")
    clean(spark).write.parquet(path)
    df = spark.read.parquet(path)
    plan = contract.q06_rating_by_genre(df, UNIQUE)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(rating), IsNotNull(genres)]" in plan
    assert "ReadSchema: struct<rating:double,genres:string>" in plan
    top = contract.q08_top_items(df, UNIQUE)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in top and "Exchange" not in top


def test_unique_keys_need_no_shuffle_of_pairs(spark):
    pairs = explode_dimension(clean(spark), "genres", UNIQUE, extras=["rating"])
    assert "Exchange" not in pairs._jdf.queryExecution().executedPlan().toString()
    assert pairs.filter(F.col("genres") == "Action").count() == 2
