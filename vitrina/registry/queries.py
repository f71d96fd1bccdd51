"""Every operator as a query over the shared tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.functions.dates import lenient_date
from vitrina.functions.dimensions import (
    dimension_size,
    dimension_text,
    dimension_values,
    has_empty_element,
    listed_values,
    pipe_count,
)
from vitrina.functions.numbers import exact_mean, half_even, lenient_double, lenient_long
from vitrina.functions.text import has_text, is_missing, json_field, normalized, preview
from vitrina.operators.compare import (
    compare_aligned,
    compare_multiset,
    compare_ordered,
    compare_sorted,
    difference_by_bucket,
    multiset_difference,
    order_contract,
    typed_result,
    union_all,
)
from vitrina.operators.duplicates import collision_groups, collision_members, key_counts
from vitrina.operators.explode import explode_dimension
from vitrina.operators.ordinals import distributed_ordinal, small_ordinal
from vitrina.operators.profile import columnwise, long_form, null_profile
from vitrina.operators.quantiles import grouped_summary
from vitrina.operators.rows import (
    create,
    delete,
    delete_many,
    lookup_expected,
    next_id,
    read,
    snapshot,
    stage_summary,
    update,
    update_many,
)
from vitrina.operators.timings import engine_times, last_total, report_seconds, timing_rollup
from vitrina.operators.words import word_length_histogram, word_length_stats
from vitrina.plans import cleaning, contract, inspection, profiling, suite, validation
from vitrina.registry.catalogs import (
    LINE_SPEC,
    ORDER_SPEC,
    lines_clean,
    lines_columns,
    lines_raw,
    orders_clean,
    orders_raw,
    table,
)
from vitrina.session import delete_at_end, fresh_path
from vitrina.sources.csv_records import read_csv_split
from vitrina.sources.readers import first_rows, read_csv, read_parquet, read_result
from vitrina.sources.writers import report_frame, write_report

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

# The keys of the three items whose literal names must survive cleaning.
EXPECTED_LITERALS = ((1, "NULL", "item-1"), (2, "None", "item-2"), (3, "NaN", "item-3"))
VISIBLE = ("id", "name", "slug", "rating")
DEMO_NAME = "DEMO ITEM"


def query(function: Query) -> Query:
    """Register a query under the name of its function."""
    REGISTRY[function.__name__] = function
    return function


# Cleaning and column rules


@query
def clean_catalog(spark, sf_dir):
    return cleaning.clean_catalog(orders_raw(spark, sf_dir), ORDER_SPEC)


@query
def clean_line_catalog(spark, sf_dir):
    return cleaning.clean_catalog(lines_raw(spark, sf_dir), LINE_SPEC)


@query
def missing_tokens(spark, sf_dir):
    raw = orders_raw(spark, sf_dir)
    names = ("released", "rating", "genres", "platforms", "publishers", "esrb_rating", "tba")
    return raw.select(
        "id",
        *(is_missing(F.col(name)).alias(f"{name}_missing") for name in names),
        *(normalized(F.col(name)).alias(name) for name in names),
        has_text(F.col("developers")).alias("developers_valid"),
    )


@query
def lenient_casts(spark, sf_dir):
    raw = orders_raw(spark, sf_dir)
    return raw.select(
        "id",
        lenient_long(F.col("metacritic")).alias("metacritic"),
        lenient_long(F.col("ratings_count")).alias("ratings_count"),
        lenient_double(F.col("rating")).alias("rating"),
        lenient_double(F.col("playtime")).alias("playtime"),
        lenient_date(F.col("released")).alias("released"),
    )


@query
def json_field_catalog(spark, sf_dir):
    raw = orders_raw(spark, sf_dir)
    return raw.select("id", json_field(normalized(F.col("esrb_rating")), "$.name").alias("esrb_rating_name"))


@query
def json_field_events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", json_field(F.col("props"), "$.k").alias("k"))


@query
def dimension_normalise(spark, sf_dir):
    raw = orders_raw(spark, sf_dir)
    return raw.select(
        "id",
        *(
            dimension_text(dimension_values(normalized(F.col(name)))).alias(name)
            for name in ORDER_SPEC.dimensions
        ),
    )


@query
def dimension_counts(spark, sf_dir):
    raw = orders_raw(spark, sf_dir)
    columns = [F.col("id")]
    for name, counted in ORDER_SPEC.dimensions.items():
        text = normalized(F.col(name))
        columns += [
            dimension_size(dimension_values(text)).alias(counted),
            dimension_size(listed_values(text)).alias(f"{name}_listed"),
            pipe_count(text).alias(f"{name}_pipes"),
        ]
    return raw.select(*columns)


@query
def dimension_empty_tokens(spark, sf_dir):
    raw = orders_raw(spark, sf_dir)
    return columnwise(
        raw,
        {
            name: {"filas_con_vacios": F.count_if(has_empty_element(F.col(name)))}
            for name in ORDER_SPEC.dimensions
        },
    )


@query
def text_preview(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", preview(F.col("text")).alias("vista"))


@query
def explode_genres(spark, sf_dir):
    return explode_dimension(
        orders_clean(spark, sf_dir), "genres", ORDER_SPEC, extras=["rating", "metacritic"]
    )


@query
def explode_genres_repeated_ids(spark, sf_dir):
    return explode_dimension(
        lines_columns(spark, sf_dir, "id", "genres", "rating"), "genres", LINE_SPEC, extras=["rating"]
    )


# The contract

# What the queries that explode a dimension read of the catalog of order lines.
EXPLODED = {
    contract.q03_top_genres: ("id", "genres"),
    contract.q04_top_platforms: ("id", "platforms"),
    contract.q05_top_developers: ("id", "developers"),
    contract.q06_rating_by_genre: ("id", "genres", "rating"),
    contract.q07_metacritic_by_genre: ("id", "genres", "metacritic"),
    contract.q09_playtime_by_genre: ("id", "genres", "playtime"),
}


def _contract_query(name: str, function) -> None:
    def run(spark, sf_dir):
        return function(orders_clean(spark, sf_dir), ORDER_SPEC)

    def run_repeated(spark, sf_dir):
        names = EXPLODED.get(function)
        clean = lines_columns(spark, sf_dir, *names) if names else lines_clean(spark, sf_dir)
        return function(clean, LINE_SPEC)

    REGISTRY[name] = run
    # The top items of repeated keys have no total order.
    if function is not contract.q08_top_items:
        REGISTRY[f"{name}_repeated_ids"] = run_repeated


for _function in contract.CONTRACT.values():
    _contract_query(_function.__name__, _function)


@query
def q06_rating_by_genre_split(spark, sf_dir):
    return contract.q06_rating_by_genre(
        orders_clean(spark, sf_dir), ORDER_SPEC, few_values=False
    )


@query
def q09_playtime_by_genre_split(spark, sf_dir):
    lines = lines_columns(spark, sf_dir, *EXPLODED[contract.q09_playtime_by_genre])
    return contract.q09_playtime_by_genre(lines, LINE_SPEC, few_values=False)


@query
def price_median_by_flag_split(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    summary = grouped_summary(lines, "l_returnflag", "l_extendedprice", few_values=False)
    return summary.select(
        "l_returnflag",
        "n",
        half_even(F.col("mean"), 2).alias("mean"),
        half_even(F.col("median"), 6).alias("median"),
        "low",
        "high",
    )


@query
def aligned_aggregates(spark, sf_dir):
    pairs = explode_dimension(
        orders_clean(spark, sf_dir), "genres", ORDER_SPEC, extras=["rating", "metacritic"]
    )
    return pairs.groupBy("genres").agg(
        F.count("rating").alias("con_rating"),
        half_even(exact_mean(F.col("rating"))).alias("rating_promedio"),
        F.count("metacritic").alias("con_metacritic"),
        half_even(exact_mean(F.col("metacritic"))).alias("metacritic_promedio"),
    )


@query
def suite_results(spark, sf_dir):
    return suite.suite_results(orders_clean(spark, sf_dir), ORDER_SPEC)


@query
def suite_summary(spark, sf_dir):
    # Written results of three runs: the promise of unique keys is used, not used, and
    # used on a catalog whose ratings are one too high where they are low.
    clean = orders_clean(spark, sf_dir)
    shifted = clean.withColumn(
        "rating", F.when(F.col("rating") < 2, F.col("rating") + 1).otherwise(F.col("rating"))
    )
    path = fresh_path(spark, "suite")
    suite.write_suite(clean, ORDER_SPEC, f"{path}/expected")
    suite.write_suite(clean, LINE_SPEC, f"{path}/general")
    suite.write_suite(shifted, ORDER_SPEC, f"{path}/shifted")
    return suite.summarize_suites(
        spark,
        f"{path}/expected",
        {"general": f"{path}/general", "shifted": f"{path}/shifted"},
    )


@query
def suite_issues(spark, sf_dir):
    # As above; the first bad row of each column that differs, with both values.
    clean = orders_clean(spark, sf_dir)
    path = fresh_path(spark, "suite-issues")
    delete_at_end(spark, path)
    suite.write_suite(clean, ORDER_SPEC, f"{path}/expected")
    low = F.when(F.col("rating") < 2, F.col("rating") + 1).otherwise(F.col("rating"))
    suite.write_suite(clean.withColumn("rating", low), ORDER_SPEC, f"{path}/shifted")
    issues = suite.suite_issues(spark, f"{path}/expected", {"shifted": f"{path}/shifted"})
    # Where the order of rows changes, texts of later columns differ in any row; numbers show it.
    return issues.filter("query_id IN ('q01', 'q02', 'q10')").withColumns(
        {name: F.col(name).cast("double") for name in ("esperado", "actual")}
    )


# Inspection and profile


@query
def inspect_catalog(spark, sf_dir):
    return _rounded_share(inspection.inspect_table(orders_clean(spark, sf_dir), 1000))


@query
def inspect_lineitem(spark, sf_dir):
    return _rounded_share(inspection.inspect_table(table(spark, sf_dir, "lineitem")))


def _rounded_share(df: DataFrame) -> DataFrame:
    return df.withColumn("porcentaje", half_even(F.col("porcentaje"), 6))


@query
def null_profile_raw(spark, sf_dir):
    return _rounded_share(null_profile(orders_raw(spark, sf_dir)))


@query
def semantic_missing_profile(spark, sf_dir):
    return _rounded_share(profiling.missing_profile(orders_raw(spark, sf_dir)))


@query
def numeric_validity(spark, sf_dir):
    return profiling.numeric_validity(orders_raw(spark, sf_dir), ORDER_SPEC)


@query
def date_validity(spark, sf_dir):
    return profiling.date_validity(orders_raw(spark, sf_dir), ORDER_SPEC)


@query
def date_range(spark, sf_dir):
    return inspection.date_range(orders_raw(spark, sf_dir), ORDER_SPEC)


@query
def numeric_describe(spark, sf_dir):
    return inspection.numeric_describe(orders_raw(spark, sf_dir), ORDER_SPEC)


@query
def numeric_describe_split(spark, sf_dir):
    return inspection.numeric_describe(lines_raw(spark, sf_dir), LINE_SPEC, few_values=False)


@query
def sample_values(spark, sf_dir):
    return inspection.sample_values(orders_raw(spark, sf_dir))


@query
def value_frequency(spark, sf_dir):
    return inspection.flag_frequency(orders_raw(spark, sf_dir))


@query
def first_catalog_rows(spark, sf_dir):
    return first_rows(orders_clean(spark, sf_dir).select(*VISIBLE, "genres"), "id", 1000)


@query
def duplicate_key_summary(spark, sf_dir):
    return profiling.duplicate_profile(lines_raw(spark, sf_dir), ["id", "slug"])


@query
def duplicate_event_keys(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return key_counts(events, ["user_id", "event_type"])


@query
def slug_collision_members(spark, sf_dir):
    return collision_members(lines_clean(spark, sf_dir), "slug", ["id", "name"])


@query
def slug_collisions(spark, sf_dir):
    groups = inspection.slug_collisions(lines_clean(spark, sf_dir), LINE_SPEC)
    return _lists_as_text(groups, "slug")


@query
def text_collisions(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    groups = collision_groups(documents, "text", "doc_id", "source")
    return _lists_as_text(groups.withColumn("text", F.md5("text")), "text")


def _lists_as_text(groups: DataFrame, key: str) -> DataFrame:
    def joined(name: str):
        return F.array_join(F.col(name).cast("array<string>"), ",").alias(name)

    return groups.select(key, "cantidad", "parte", joined("ids"), joined("nombres"), joined("veces"))


@query
def rows_without_slug(spark, sf_dir):
    raw = orders_raw(spark, sf_dir)
    lost = orders_clean(spark, sf_dir).withColumn(
        "slug", F.when(F.col("genres").isNotNull(), F.col("slug"))
    )
    return inspection.rows_without_slug(lost, raw, ORDER_SPEC)


# Checks


@query
def validate_catalog(spark, sf_dir):
    return validation.validate_catalog(
        orders_clean(spark, sf_dir),
        ORDER_SPEC,
        expected_columns=22,
        literal_rows=EXPECTED_LITERALS,
    )


@query
def validate_line_catalog(spark, sf_dir):
    return validation.validate_catalog(lines_clean(spark, sf_dir), LINE_SPEC)


@query
def audit_catalog(spark, sf_dir):
    # The raw dimensions beside the clean counts: blanks and repeats are still in. Both sides are
    # whole catalogs, many times larger in memory than their compressed files, so none is broadcast.
    dirty = orders_clean(spark, sf_dir).drop(*ORDER_SPEC.dimensions)
    raw = orders_raw(spark, sf_dir).select("id", *ORDER_SPEC.dimensions)
    return validation.audit_catalog(dirty.join(raw.hint("merge"), "id"), ORDER_SPEC)


@query
def audit_line_catalog(spark, sf_dir):
    # Of the other columns an audit reads none.
    names = ("id", "released", "release_year", "rating", "playtime")
    lines = lines_columns(spark, sf_dir, *names, *LINE_SPEC.dimensions, *LINE_SPEC.dimensions.values())
    return validation.audit_catalog(lines, LINE_SPEC)


@query
def repeated_pairs(spark, sf_dir):
    return validation.repeated_pairs(
        lines_columns(spark, sf_dir, "id", *LINE_SPEC.dimensions), LINE_SPEC
    )


@query
def value_ranges(spark, sf_dir):
    return validation.value_ranges(lines_clean(spark, sf_dir), LINE_SPEC)


@query
def health_gate(spark, sf_dir):
    return validation.health_gate(lines_clean(spark, sf_dir), LINE_SPEC)


@query
def literal_lookup(spark, sf_dir):
    expected = spark.createDataFrame(
        [*EXPECTED_LITERALS, (-1, "absent", "absent")], "id bigint, name string, slug string"
    )
    return lookup_expected(orders_clean(spark, sf_dir), expected)


# Comparison


def _pair(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The catalog, and a copy with known differences inside and outside the tolerance."""
    columns = ["id", "name", "genres", "rating", "ratings_count"]
    left = orders_clean(spark, sf_dir).select(*columns)
    rating = F.col("rating")
    moved = (
        F.when(F.col("ratings_count") > 7900, rating + 0.5)
        .when(F.col("ratings_count") > 7000, rating + 0.00003)
        .otherwise(rating)
    )
    unplaced = F.concat("name", F.lit(" (sin genero)"))
    right = left.select(
        "id",
        F.when(F.col("genres").isNull(), unplaced).otherwise(F.col("name")).alias("name"),
        "genres",
        moved.alias("rating"),
        "ratings_count",
    )
    return left, right


@query
def compare_ordered_catalogs(spark, sf_dir):
    left, right = _pair(spark, sf_dir)
    return compare_ordered(left, right, "id")


@query
def compare_ordered_results(spark, sf_dir):
    clean = orders_clean(spark, sf_dir)
    shifted = clean.withColumn("rating", F.col("rating") * 1.01)

    def result(catalog):
        rows = contract.q06_rating_by_genre(catalog, ORDER_SPEC)
        return small_ordinal(rows, suite.result_order("q06"))

    return compare_ordered(result(clean), result(shifted), "posicion")


@query
def compare_multiset_catalogs(spark, sf_dir):
    left, right = _pair(spark, sf_dir)
    return compare_multiset(left, right)


@query
def multiset_difference_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    left = lines.select("l_returnflag", "l_linestatus", "l_linenumber")
    merged = F.when(F.col("l_returnflag") == "A", "R").otherwise(F.col("l_returnflag"))
    return multiset_difference(left, left.withColumn("l_returnflag", merged))


@query
def fingerprint_difference_lines(spark, sf_dir):
    # Whole lines: one order's discounts change, another order's lines are there twice.
    lines = table(spark, sf_dir, "lineitem")
    changed = F.when(F.col("l_orderkey") == 7, F.col("l_discount") + 1).otherwise(F.col("l_discount"))
    other = lines.withColumn("l_discount", changed).unionByName(lines.filter("l_orderkey = 32"))
    return difference_by_bucket(lines, other)


@query
def compare_sorted_catalogs(spark, sf_dir):
    left, right = _pair(spark, sf_dir)
    order = ["ratings_count", "rating", "name", "genres"]
    return compare_sorted(left.select(*order), right.select(*order))


@query
def compare_sorted_copies(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_tax")
    return compare_sorted(lines, lines.withColumn("l_tax", F.col("l_tax") + 0.01))


@query
def compare_aligned_lines(spark, sf_dir):
    # Some lines are missing from the copy and some taxes are higher.
    names = ["l_returnflag", "l_linestatus", "l_quantity", "l_tax"]
    lines = table(spark, sf_dir, "lineitem")
    higher = F.when(F.col("l_orderkey") % 89 == 0, F.col("l_tax") + 0.01).otherwise(F.col("l_tax"))
    copy = lines.filter(F.col("l_orderkey") % 97 != 0).withColumn("l_tax", higher)
    return compare_aligned(lines.select(*names), copy.select(*names))


@query
def sorted_positions(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return distributed_ordinal(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query
def order_contract_catalog(spark, sf_dir):
    ranked = distributed_ordinal(
        orders_clean(spark, sf_dir).select("id", "ratings_count"),
        [F.desc_nulls_last("ratings_count"), F.asc("id")],
    )
    checks = {
        "ratings_count desc, id": [("ratings_count", True), ("id", False)],
        "id": [("id", False)],
    }
    return union_all(
        [
            order_contract(ranked, "posicion", order).select(F.lit(name).alias("orden"), "*")
            for name, order in checks.items()
        ]
    )


# Row-level changes


def _demo_row(clean: DataFrame) -> DataFrame:
    return next_id(clean).select(
        F.col("next_id").alias("id"),
        F.lit(DEMO_NAME).alias("name"),
        F.concat(F.lit("demo-"), F.col("next_id").cast("string")).alias("slug"),
        F.lit(3.0).alias("rating"),
    )


@query
def crud_next_id(spark, sf_dir):
    return next_id(orders_clean(spark, sf_dir))


@query
def crud_create(spark, sf_dir):
    clean = orders_clean(spark, sf_dir)
    return create(clean, _demo_row(clean))


@query
def crud_read(spark, sf_dir):
    return read(lines_clean(spark, sf_dir), 7)


@query
def crud_update(spark, sf_dir):
    clean = orders_clean(spark, sf_dir)
    return update(clean, 7, {"rating": 4.5, "name": "renamed"})


@query
def crud_update_many(spark, sf_dir):
    changes = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_acctbal").alias("rating"),
        F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("name"),
    )
    return update_many(orders_clean(spark, sf_dir), changes)


@query
def crud_delete(spark, sf_dir):
    return delete(lines_clean(spark, sf_dir), 7)


@query
def crud_delete_many(spark, sf_dir):
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return delete_many(orders_clean(spark, sf_dir), keys)


@query
def crud_summary(spark, sf_dir):
    # Every stage starts from the persisted version before it.
    base = fresh_path(spark, "crud")
    before = snapshot(orders_clean(spark, sf_dir), base, 0, "antes")
    key = next_id(before).first()["next_id"]
    created = snapshot(create(before, _demo_row(before)), base, 1, "create")
    seen = snapshot(created, base, 2, "read")
    updated = snapshot(update(seen, key, {"rating": 4.5}), base, 3, "update")
    deleted = snapshot(delete(updated, key), base, 4, "delete")
    stages = {
        "00_antes": before,
        "01_create": created,
        "02_read": seen,
        "03_update": updated,
        "04_delete": deleted,
    }
    return union_all([stage_summary(df, name, key) for name, df in stages.items()]).orderBy("etapa")


# Sources and sinks


def _read_back(spark, df):
    """A table written as CSV and read by both readers of catalogs, in one column of texts."""
    path = fresh_path(spark, "csv-roundtrip")
    delete_at_end(spark, path)
    df.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return union_all(
        [
            reader(spark, path).withColumn("lector", F.lit(name))
            for name, reader in (("entero", read_csv), ("por_partes", read_csv_split))
        ]
    )


@query
def csv_roundtrip_documents(spark, sf_dir):
    # Texts hold line ends, quotes and commas.
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", "text")
    return _read_back(spark, documents).select(
        "lector",
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "lang",
        "source",
        F.col("n_chars").cast("bigint").alias("n_chars"),
        F.md5("text").alias("texto_md5"),
    )


@query
def csv_roundtrip_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return _read_back(spark, orders).select(
        "lector",
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        "o_orderstatus",
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        "o_orderpriority",
    )


@query
def lines_in_small_splits(spark, sf_dir):
    lines = read_parquet(spark, f"{sf_dir}/lineitem.parquet", split_bytes=1 << 18)
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lineas"), F.max("l_orderkey").alias("ultimo_pedido")
    )


@query
def typed_report(spark, sf_dir):
    # A result written as a report and read as text; its number columns are found by their cells.
    path = fresh_path(spark, "typed-report")
    delete_at_end(spark, path)
    write_report(contract.q08_top_items(orders_clean(spark, sf_dir), ORDER_SPEC), path)
    return typed_result(read_result(spark, path))


@query
def priority_report(spark, sf_dir):
    # A few rows of a report, as the driver has them after a run, become an ordered table.
    rows = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("pedidos"), F.max("o_totalprice").alias("mayor")
    )
    return report_frame(
        spark, map(tuple, rows.collect()), "prioridad string, pedidos bigint, mayor double", "prioridad"
    )


# Words and run times


@query
def document_word_lengths(spark, sf_dir):
    return word_length_histogram(table(spark, sf_dir, "documents"), "text")


@query
def document_word_stats(spark, sf_dir):
    stats = word_length_stats(table(spark, sf_dir, "documents"), "text")
    return stats.withColumns(
        {name: half_even(F.col(name), 6) for name in ("media", "desviacion_estandar")}
    )


@query
def conversation_word_stats(spark, sf_dir):
    stats = word_length_stats(table(spark, sf_dir, "conversations"), "text")
    return stats.withColumns(
        {name: half_even(F.col(name), 6) for name in ("media", "desviacion_estandar")}
    )


@query
def event_timing_rollup(spark, sf_dir):
    # Customers and users stand for engines and event values for seconds; a customer without
    # events has no time.
    events = table(spark, sf_dir, "events")
    timings = events.select(
        F.col("user_id").cast("string").alias("motor"), F.col("value").alias("tiempo_segundos")
    )
    customers = table(spark, sf_dir, "customer")
    engines = customers.select(F.col("c_custkey").cast("string").alias("motor")).unionByName(
        timings.select("motor")
    )
    rollup = timing_rollup(engines, timings)
    return rollup.withColumns(
        {name: half_even(F.col(name), 4) for name in ("tiempo_segundos", "vs_mas_rapido")}
    )


def _decimal_comma():
    return F.replace(F.col("value").cast("string"), F.lit("."), F.lit(","))


def _event_log():
    """A run log per event: two totals are stated and the last one counts; errors state none."""
    stated = F.concat(
        F.lit("Tiempo total consultas: 1.5 segundos\nTIEMPO  TOTAL : "),
        _decimal_comma(),
        F.lit(" segundos"),
    )
    failed = F.concat(F.lit("Tiempo: "), _decimal_comma())
    return F.when(F.col("event_type") == "error", failed).otherwise(stated)


@query
def event_log_totals(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", last_total(_event_log()).alias("tiempo_segundos"))


@query
def event_engine_times(spark, sf_dir):
    # Each event is an engine with a log and a report; customers are engines without either.
    events = table(spark, sf_dir, "events").withColumn("motor", F.col("event_id").cast("string"))
    customers = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), "c_custkey").alias("motor"), F.col("c_mktsegment").alias("entorno")
    )
    engines = events.select("motor", F.col("event_type").alias("entorno")).unionByName(customers)
    logs = events.select("motor", _event_log().alias("registro"))
    report = events.select("motor", _decimal_comma().alias("seconds"))
    return engine_times(engines, logs, report_seconds(report))


@query
def long_ratings(spark, sf_dir):
    clean = orders_clean(spark, sf_dir)
    numbers = {name: F.col(name).cast("double") for name in ("rating", "metacritic", "playtime")}
    return long_form(clean, numbers).groupBy("columna").agg(
        F.count("valor").alias("validos"), F.max("valor").alias("maximo")
    )
