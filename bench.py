"""Time the contract over a clean catalog in Parquet; prints one JSON line.

Like the published runs, the queries read a catalog that was cleaned and written before;
cleaning is reported beside them and is not part of the total. Every query runs three
times and the median counts, so that one slow start does not decide.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from vitrina.operators.words import word_length_stats
from vitrina.plans.cleaning import clean_catalog
from vitrina.plans.contract import CONTRACT
from vitrina.plans.suite import suite_results
from vitrina.plans.validation import validate_catalog
from vitrina.registry.catalogs import ORDER_SPEC, orders_raw, table
from vitrina.session import build_session, fresh_path
from vitrina.sources.writers import write_catalog

RUNS = 3


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "vitrina-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    path = fresh_path(spark, "bench")
    raw = orders_raw(spark, sf_dir)
    extra = {
        "clean_catalog": seconds(lambda: write_catalog(clean_catalog(raw, ORDER_SPEC), path)),
    }
    # The test table is a single file; a catalog of that many rows per core is not.
    spread = fresh_path(spark, "bench")
    write_catalog(spark.read.parquet(path).repartition(int(cpus)), spread)
    clean = spark.read.parquet(spread)
    documents = table(spark, sf_dir, "documents")

    def timed(build) -> float:
        build().collect()
        return statistics.median(seconds(lambda: build().collect()) for _ in range(RUNS))

    queries = {
        name: timed(lambda query=query: query(clean, ORDER_SPEC))
        for name, query in CONTRACT.items()
    }
    extra["suite_results"] = timed(lambda: suite_results(clean, ORDER_SPEC))
    extra["validate_catalog"] = timed(lambda: validate_catalog(clean, ORDER_SPEC))
    extra["word_length_stats"] = timed(lambda: word_length_stats(documents, "text"))
    print(
        json.dumps(
            {
                "metric": "contract_q01_q10_total",
                "value": round(sum(queries.values()), 4),
                "unit": "sec",
                "queries": {name: round(value, 4) for name, value in queries.items()},
                "other": {name: round(value, 4) for name, value in extra.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
