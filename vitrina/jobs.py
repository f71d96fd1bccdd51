"""Jobs for the command line: ``python -m vitrina.jobs JOB ...`` or ``spark-submit``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.operators.compare import suite_summary, typed_result, union_all
from vitrina.operators.profile import null_profile
from vitrina.operators.rows import create, delete, next_id, snapshot, stage_summary, update
from vitrina.operators.timings import engine_times, report_seconds, timing_rollup
from vitrina.operators.words import word_length_stats
from vitrina.plans import inspection, profiling, validation
from vitrina.plans.cleaning import clean_catalog
from vitrina.plans.suite import compare_suites, suite_issues, write_suite
from vitrina.session import build_session, materialize
from vitrina.sources.csv_records import read_csv_split
from vitrina.sources.readers import first_rows, read_csv, read_parquet, read_result
from vitrina.sources.writers import write_catalog, write_report
from vitrina.spec import LITERAL_COLUMNS, CatalogSpec


def load(spark: SparkSession, path: str, split: bool = False) -> DataFrame:
    """A raw CSV or a Parquet catalog, by the ending of its name."""
    if not path.endswith((".csv", ".csv.gz")):
        return read_parquet(spark, path)
    return read_csv_split(spark, path) if split else read_csv(spark, path)


def report(df: DataFrame, args: argparse.Namespace, name: str, rows: int = 100) -> None:
    """Prints the first rows and how many there are besides; with ``--output`` writes them all as Parquet."""
    df = materialize(df, f"report-{name}")
    df.show(rows, truncate=False)
    more = df.count() - rows
    if more > 0:
        print(f"{name}: {more} more rows are not shown, --output writes all")
    if args.output:
        write_catalog(df, f"{args.output}/{name}", "overwrite")


def run_clean(spark, args, spec):
    write_catalog(clean_catalog(load(spark, args.input, args.split_csv), spec), args.output)


def run_inspect(spark, args, spec):
    df = load(spark, args.input, args.split_csv)
    report(inspection.inspect_table(df), args, "columns")
    report(null_profile(df), args, "nulls")
    report(first_rows(df, spec.key, 5), args, "first")


def run_profile(spark, args, spec):
    raw = load(spark, args.input, args.split_csv)
    report(profiling.duplicate_profile(raw, [spec.key, "slug"]), args, "duplicates")
    report(profiling.missing_profile(raw), args, "missing")
    report(profiling.numeric_validity(raw, spec), args, "numbers")
    report(profiling.date_validity(raw, spec), args, "dates")


def run_values(spark, args, spec):
    raw = load(spark, args.input, args.split_csv)
    report(inspection.sample_values(raw), args, "samples")
    report(inspection.numeric_describe(raw, spec), args, "numbers")
    report(inspection.date_range(raw, spec), args, "dates")
    report(inspection.flag_frequency(raw), args, "flags")


def run_validate(spark, args, spec):
    clean = read_parquet(spark, args.input)
    checks = validation.validate_catalog(clean, spec)
    report(checks, args, "checks")
    report(validation.value_ranges(clean, spec), args, "ranges")
    report(null_profile(clean), args, "nulls")
    validation.require(checks)


def run_audit(spark, args, spec):
    report(validation.audit_catalog(read_parquet(spark, args.input), spec), args, "audit")


def run_gate(spark, args, spec):
    checks = validation.health_gate(read_parquet(spark, args.input), spec)
    report(checks, args, "checks")
    validation.require(checks)


def run_collisions(spark, args, spec):
    clean = read_parquet(spark, args.input)
    report(clean.filter(F.col("slug").isNull()).select(spec.key, *LITERAL_COLUMNS), args, "without_slug")
    report(inspection.slug_collisions(clean, spec), args, "collisions")
    if args.raw:
        raw = load(spark, args.raw, args.split_csv)
        report(inspection.rows_without_slug(clean, raw, spec), args, "raw_rows")


def run_queries(spark, args, spec):
    write_suite(read_parquet(spark, args.input), spec, args.output)


def run_compare(spark, args, spec):
    engines = dict(item.split("=", 1) for item in args.engines)
    outcomes = compare_suites(spark, args.input, engines, spec=spec)
    report(outcomes.orderBy("motor", "query_id"), args, "queries")
    issues = suite_issues(spark, args.input, engines, spec=spec)
    report(issues.orderBy("motor", "query_id", "columna"), args, "issues")
    report(suite_summary(outcomes), args, "summary")


def run_changes(spark, args, spec):
    full = read_parquet(spark, args.input)
    free = next_id(full, spec.key).first()["next_id"]
    demo = spark.createDataFrame(
        [(free, f"demo-{free}", "DEMO ITEM", 3.0)],
        f"{spec.key} bigint, slug string, name string, rating double",
    )
    before = snapshot(first_rows(full, spec.key, args.rows), args.output, 0, "antes")
    created = snapshot(create(before, demo), args.output, 1, "create")
    seen = snapshot(created, args.output, 2, "read")
    updated = snapshot(update(seen, free, {"rating": 4.5}, spec.key), args.output, 3, "update")
    deleted = snapshot(delete(updated, free, spec.key), args.output, 4, "delete")
    stages = {
        "00_antes": before,
        "01_create": created,
        "02_read": seen,
        "03_update": updated,
        "04_delete": deleted,
    }
    summary = [stage_summary(df, name, free, spec.key) for name, df in stages.items()]
    summary = union_all(summary).orderBy("etapa")
    write_report(summary, f"{args.output}/resumen")
    summary.show(truncate=False)


def run_words(spark, args, spec):
    report(word_length_stats(spark.read.text(args.input), "value"), args, "words")


def run_timings(spark, args, spec):
    reports = dict(item.split("=", 1) for item in args.engines)
    logs = dict(item.split("=", 1) for item in args.logs)
    names = spark.createDataFrame(
        [(name, None) for name in sorted({*reports, *logs})], "motor string, entorno string"
    )
    timed = [
        report_seconds(typed_result(read_result(spark, path))).select(
            F.lit(engine).alias("motor"), "tiempo_segundos"
        )
        for engine, path in reports.items()
    ]
    # A log is one text: its last total is the one that counts.
    told = [
        spark.read.text(path, wholetext=True).select(
            F.lit(engine).alias("motor"), F.col("value").alias("registro")
        )
        for engine, path in logs.items()
    ]
    nothing = spark.createDataFrame([], "motor string, tiempo_segundos double, registro string")
    times = engine_times(
        names,
        union_all([nothing.select("motor", "registro"), *told]),
        union_all([nothing.select("motor", "tiempo_segundos"), *timed]),
    )
    rollup = timing_rollup(names, times.filter("tiempo_segundos IS NOT NULL"))
    rollup = rollup.join(times.select("motor", "fuente"), "motor").orderBy("motor")
    rollup.show(truncate=False)
    if args.output:
        write_report(rollup, args.output)


JOBS = {
    "clean": run_clean,
    "inspect": run_inspect,
    "profile": run_profile,
    "values": run_values,
    "validate": run_validate,
    "audit": run_audit,
    "gate": run_gate,
    "collisions": run_collisions,
    "queries": run_queries,
    "compare": run_compare,
    "changes": run_changes,
    "words": run_words,
    "timings": run_timings,
}


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--input", help="catalog, text or expected suite to read")
    parser.add_argument("--output", help="where results, and whole reports, are written")
    parser.add_argument("--raw", help="raw catalog beside a clean one (collisions)")
    parser.add_argument(
        "--split-csv", action="store_true", help="read each CSV file in parallel"
    )
    parser.add_argument("--rows", type=int, default=1000, help="rows of the copy (changes)")
    parser.add_argument("--engines", nargs="*", default=[], metavar="NAME=PATH")
    parser.add_argument(
        "--logs", nargs="*", default=[], metavar="NAME=PATH", help="run logs (timings)"
    )
    parser.add_argument(
        "--unique-key", action="store_true", help="the key is known to be unique and filled"
    )
    parser.add_argument(
        "--normalized", action="store_true", help="the dimensions are known to be normalised"
    )
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spec = CatalogSpec(unique_key=args.unique_key, normalized=args.normalized)
    JOBS[args.job](build_session(f"vitrina-{args.job}"), args, spec)


if __name__ == "__main__":
    main()
