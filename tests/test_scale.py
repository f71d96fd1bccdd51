"""Plans and inputs that must stay bounded as tables grow."""

import random

from pyspark.sql import functions as F

from vitrina.functions.dimensions import dimension_values, listed_values
from vitrina.functions.text import WHITESPACE, stripped
from vitrina.operators import quantiles
from vitrina.operators.duplicates import collision_groups
from vitrina.plans import validation
from vitrina.plans.contract import q06_rating_by_genre
from vitrina.registry import catalogs
from vitrina.registry.catalogs import LINE_SPEC, lines_clean, lines_columns
from vitrina.registry.queries import REGISTRY

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_audit_joins_whole_catalogs_without_a_broadcast(spark):
    audit = REGISTRY["audit_catalog"](spark, SF)
    assert "Join" in plan_of(audit) and "Broadcast" not in plan_of(audit)
    # Two catalogs, read for the conditions and for the pairs; the total reads nothing again.
    assert audit._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 4


def test_audit_total_is_the_sum_of_all_but_nan(spark):
    rows = [(1, " |a", 9.0), (1, "a|a", 1.0), (None, None, float("nan"))]
    clean = spark.createDataFrame(rows, "id long, genres string, rating double").withColumns(
        {name: F.lit("b") for name in ("platforms", "developers", "publishers")}
        | {name: F.lit(1) for name in LINE_SPEC.dimensions.values()}
        | {"released": F.lit("2000-01-01").cast("date"), "release_year": F.lit(2000)}
    )
    audit = validation.audit_catalog(clean, LINE_SPEC)
    found = {row.auditoria: row.problemas for row in audit.collect()}
    assert found["nan rating"] == 1 and found["rating"] == 2 and found["pares genres"] == 1
    assert found["total"] == sum(n for name, n in found.items() if name[:4] not in ("nan ", "tota"))


def columns_read(df):
    """The columns of every Parquet scan of a plan."""
    found = []
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    for at in range(leaves.size()):
        leaf = leaves.apply(at)
        if "parquet" in leaf.toString():
            found.append(sorted(name.split("#")[0] for name in leaf.output().mkString(",").split(",")))
    return found


def test_a_gate_cleans_only_what_it_reads(spark):
    assert columns_read(REGISTRY["health_gate"](spark, SF)) == [["l_orderkey", "l_shipdate"]]


def test_slug_collisions_read_no_dimension(spark):
    for names in columns_read(REGISTRY["slug_collisions"](spark, SF)):
        assert set(names) <= {"l_orderkey", "l_partkey", "l_linenumber"}


def test_written_columns_are_those_of_the_clean_catalog(spark):
    names = ("id", "genres", "rating")
    stored = lines_columns(spark, SF, *names)
    whole = lines_clean(spark, SF).select(*names)
    assert stored.schema == whole.schema and stored.columns == list(names)
    assert stored.exceptAll(whole).isEmpty() and whole.exceptAll(stored).isEmpty()
    assert stored.inputFiles() == lines_columns(spark, SF, *names).inputFiles()


def test_texts_are_split_once(spark):
    rows = [(1, " |a", 9.0), (1, "a|a", 1.0), (2, " | ", 2.0), (3, None, 1.0), (None, "b", 1.0)]
    clean = spark.createDataFrame(rows, "id long, genres string, rating double").withColumns(
        {name: F.col("genres") for name in ("platforms", "developers", "publishers")}
    )
    pairs = validation.repeated_pairs(clean, LINE_SPEC)
    assert {row.problemas for row in pairs.collect()} == {1}
    assert pairs._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    rated = q06_rating_by_genre(clean, LINE_SPEC)
    assert rated._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_counts_are_made_once_for_totals_and_medians(spark, monkeypatch):
    labels = []
    whole = quantiles.materialize
    monkeypatch.setattr(
        quantiles, "materialize", lambda df, label: labels.append(label) or whole(df, label)
    )
    frame = spark.createDataFrame([("g", float(n % 7)) for n in range(50)] + [(None, 1.0)], "g string, v double")
    summary = quantiles.grouped_summary(frame, "g", "v", few_values=False)
    assert labels.count("value-counts") == 1
    assert "LogicalRDD" not in summary._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(row) for row in summary.collect()] == [("g", 50, 2.94, 3.0, 0.0, 6.0)]


def test_values_are_those_stripped_one_by_one(spark):
    made = random.Random(5)
    parts = [*WHITESPACE, " ", "||", "|", "|", "a", "É", "\u200b", "\x1c", "b c", "日"]
    texts = ["".join(made.choices(parts, k=made.randint(0, 12))) for _ in range(3000)]
    texts += [None, "", "|", " a | b ", "a  |  b|a", "\u3000a\n|\u3000", " " * 50_000 + "x" + "\t" * 50_000 + "y"]
    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    one_by_one = F.array_remove(F.transform(F.split("text", r"\|"), stripped), "")
    wrong = ~listed_values(F.col("text")).eqNullSafe(one_by_one) | ~dimension_values(
        F.col("text")
    ).eqNullSafe(F.array_distinct(one_by_one))
    assert frame.filter(wrong).isEmpty()


def test_no_lambda_runs_per_element(spark):
    lines = lines_clean(spark, SF)
    for df in (
        lines,
        q06_rating_by_genre(lines, LINE_SPEC),
        validation.repeated_pairs(lines, LINE_SPEC),
        REGISTRY["audit_line_catalog"](spark, SF),
    ):
        assert "lambdafunction" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_raw_catalogs_are_cleaned_by_compiled_code(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    try:
        for given, wanted in (("65535", "8000"), ("4000", "4000")):
            spark.conf.set(name, given)
            lines_clean(spark, SF)
            assert spark.conf.get(name) == wanted
    finally:
        spark.conf.set(name, before)


def test_pairs_carry_no_name_of_their_dimension(spark):
    clean = spark.createDataFrame([(1, "a|b", "a"), (1, "a", "a")], "id long, genres string, platforms string")
    clean = clean.withColumns({name: F.lit(None).cast("string") for name in ("developers", "publishers")})
    pairs = validation.repeated_pairs(clean, LINE_SPEC)
    found = {row.auditoria: row.problemas for row in pairs.collect()}
    assert found == {"pares genres": 1, "pares platforms": 1, "pares developers": 0, "pares publishers": 0}
    # A number, so that a name is not shuffled with each pair.
    assert "cast(3 as tinyint)" in pairs._jdf.queryExecution().analyzed().toString()


def test_members_are_listed_once_for_a_sort(spark):
    rows = [(f"s{n % 7}", n % 50, "x") for n in range(400)] + [(None, 1, "y"), ("alone", 1, "z")]
    groups = collision_groups(spark.createDataFrame(rows, "slug string, id long, name string"), "slug", "id", "name")
    lines = plan_of(groups).splitlines()
    below = next(at for at, line in enumerate(lines) if "rangepartitioning" in line) + 1
    assert "Exchange" in lines[below]
    assert [(row.slug, row.cantidad) for row in groups.collect()] == sorted(
        ((f"s{n}", 58 if n == 0 else 57) for n in range(7)), key=lambda one: (-one[1], one[0])
    )


def test_clean_orders_need_no_written_raw_ones(spark, monkeypatch):
    labels = []
    whole = catalogs.materialize
    monkeypatch.setattr(catalogs, "_stored", {})
    monkeypatch.setattr(
        catalogs, "materialize", lambda df, label: labels.append(label) or whole(df, label)
    )
    clean = catalogs.orders_clean(spark, SF)
    assert labels == ["orders-clean"]
    again = catalogs.clean_catalog(catalogs.orders_raw(spark, SF), catalogs.ORDER_SPEC)
    assert clean.exceptAll(again).isEmpty() and again.exceptAll(clean).isEmpty()
