"""Catalogs made from the shared tables, for Spark and as SQL text.

The shared tables are clean, so the catalogs spell their values the way raw catalog
files do: missing tokens, impossible dates, blank and repeated dimension elements.
Each list pairs a column with its expression; ``{S}`` stands for the text type and
``{D}`` for the double type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitrina.plans.cleaning import clean_catalog
from vitrina.session import keep_compilable, materialize
from vitrina.spec import CatalogSpec

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

# One row per order. The key is the primary key of the table.
ORDER_ITEMS = (
    ("id", "o_orderkey"),
    ("slug", "concat('item-', CAST(o_orderkey AS {S}))"),
    (
        "name",
        "CASE o_orderkey % 997 WHEN 1 THEN 'NULL' WHEN 2 THEN 'None' WHEN 3 THEN 'NaN' "
        "ELSE concat('Item ', CAST(o_orderkey AS {S})) END",
    ),
    (
        "released",
        "CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' WHEN o_orderkey % 13 = 0 THEN '1999-02-30' "
        "ELSE substr(CAST(o_orderdate AS {S}), 1, 10) END",
    ),
    (
        "rating",
        "CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN ' NaN ' "
        "WHEN o_orderkey % 19 = 0 THEN 'None' "
        "ELSE CAST(CAST(o_orderkey * 7919 % 501 AS {D}) / 100 AS {S}) END",
    ),
    (
        "metacritic",
        "CASE WHEN o_orderkey % 5 = 0 THEN concat(CAST(40 + o_orderkey % 61 AS {S}), '.0') "
        "WHEN o_orderkey % 29 = 0 THEN 'tbd' END",
    ),
    (
        "playtime",
        "CASE WHEN o_orderkey % 4 = 1 THEN CAST(o_orderkey * 31 % 300 AS {S}) "
        "WHEN o_orderkey % 31 = 0 THEN '' END",
    ),
    (
        "ratings_count",
        "CASE WHEN o_orderkey % 23 = 0 THEN 'null' "
        "ELSE CAST(o_orderkey * 104729 % 8000 AS {S}) END",
    ),
    (
        "reviews_count",
        "CASE WHEN o_orderkey % 37 = 0 THEN NULL "
        "ELSE CAST(o_orderkey * 1299709 % 9000 AS {S}) END",
    ),
    (
        "genres",
        "CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 41 = 0 THEN ' | |' "
        "ELSE concat('Genre', CAST(o_orderkey % 19 AS {S}), '||', ' Genre', "
        "CAST(o_orderkey * 7 % 19 AS {S}), ' |Genre', CAST(o_orderkey % 19 AS {S}), '|') END",
    ),
    (
        "platforms",
        "CASE WHEN o_orderkey % 43 = 0 THEN 'N/A' "
        "ELSE concat('Platform', CAST(o_orderkey % 23 AS {S}), '|Platform', "
        "CAST(o_orderkey % 27 AS {S})) END",
    ),
    (
        "developers",
        "CASE WHEN o_orderkey % 9 = 0 THEN NULL "
        "ELSE concat(' Dev', CAST(o_orderkey * 13 % 211 AS {S}), ' | Dev', "
        "CAST(o_orderkey % 50 AS {S})) END",
    ),
    (
        "publishers",
        "CASE WHEN o_orderkey % 8 = 0 THEN 'none' "
        "ELSE concat('Pub', CAST(o_orderkey % 31 AS {S})) END",
    ),
    (
        "esrb_rating",
        "CASE o_orderkey % 4 WHEN 0 THEN '{{\"id\":4,\"name\":\"Teen\"}}' "
        "WHEN 1 THEN '{{\"id\":2,\"name\":\"Everyone\"}}' WHEN 2 THEN 'nan' END",
    ),
    ("tags", "concat(' ', lower(o_orderpriority), ' | ', o_orderstatus, ' ')"),
    (
        "tba",
        "CASE o_orderstatus WHEN 'F' THEN 'False' WHEN 'O' THEN ' TRUE ' ELSE ' n/A' END",
    ),
)

# One row per order line: keys, slugs and pairs of key and genre repeat.
LINE_ITEMS = (
    ("id", "l_orderkey"),
    ("slug", "concat('part-', CAST(l_partkey AS {S}))"),
    ("name", "concat('Line ', CAST(l_linenumber AS {S}))"),
    ("released", "substr(CAST(l_shipdate AS {S}), 1, 10)"),
    (
        "rating",
        "CASE WHEN l_quantity > 45 THEN 'nan' "
        "ELSE CAST(CAST(l_quantity AS INT) / CAST(10 AS {D}) AS {S}) END",
    ),
    (
        "metacritic",
        "CASE WHEN l_linenumber > 5 THEN NULL ELSE CAST(CAST(l_quantity AS INT) * 2 AS {S}) END",
    ),
    ("playtime", "CAST(CAST(l_suppkey * 7 + l_linenumber AS {D}) / 4 AS {S})"),
    ("ratings_count", "CAST(l_partkey AS {S})"),
    ("reviews_count", "CAST(l_suppkey AS {S})"),
    (
        "genres",
        "concat('Return ', l_returnflag, ' | Status ', l_linestatus, '|| Return ', l_returnflag, "
        "'|Line ', CAST(l_linenumber AS {S}))",
    ),
    ("platforms", "concat('Supplier ', CAST(l_suppkey AS {S}))"),
    ("developers", "concat('Part ', CAST(l_partkey % 100 AS {S}), ' |')"),
    ("publishers", "CASE l_returnflag WHEN 'R' THEN 'NA' ELSE l_returnflag END"),
)

ORDER_SPEC = CatalogSpec(unique_key=True, normalized=True)
LINE_SPEC = CatalogSpec()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the shared tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _raw(df: DataFrame, columns) -> DataFrame:
    # Raw catalogs are there to be cleaned, which is a wide projection.
    keep_compilable(df.sparkSession)
    types = {"S": "STRING", "D": "DOUBLE"}
    return df.selectExpr(*(f"{text.format(**types)} AS {name}" for name, text in columns))


_stored: dict[tuple[str, str, str], DataFrame] = {}


def _once(spark: SparkSession, sf_dir: str, label: str, build) -> DataFrame:
    """Write a catalog in the shared folder the first time a session asks for it.

    Queries then read a table as they do in use: their filters and columns reach its scan.
    """
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _stored:
        _stored[key] = materialize(build(spark, sf_dir), label)
    return _stored[key]


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw catalog of orders."""
    return _once(
        spark, sf_dir, "orders-raw", lambda s, d: _raw(table(s, d, "orders"), ORDER_ITEMS)
    )


def orders_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean catalog of orders."""
    # From the projection, as a query of clean rows alone needs no written raw ones.
    return _once(
        spark,
        sf_dir,
        "orders-clean",
        lambda s, d: clean_catalog(_raw(table(s, d, "orders"), ORDER_ITEMS), ORDER_SPEC),
    )


def lines_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw catalog of order lines; a projection that reads only what a query asks for."""
    return _raw(table(spark, sf_dir, "lineitem"), LINE_ITEMS)


def lines_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean catalog of order lines, cleaned in the query for the columns that it reads."""
    return clean_catalog(lines_raw(spark, sf_dir), LINE_SPEC)


def lines_columns(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Some columns of the clean catalog of order lines, cleaned and written once.

    For queries that filter on a dimension: a filter on a column that is still to be cleaned would
    clean it again.
    """
    label = "-".join(("lines-clean", *names))
    return _once(spark, sf_dir, label, lambda s, d: lines_clean(s, d).select(*names))


def raw_sql(columns, source: str) -> str:
    """The raw catalog as SQL."""
    types = {"S": "VARCHAR", "D": "DOUBLE"}
    listed = ", ".join(f"{text.format(**types)} AS {name}" for name, text in columns)
    return f"SELECT {listed} FROM {source}"
