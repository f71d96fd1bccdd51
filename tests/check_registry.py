"""Compare registered queries with their SQL: ``python tests/check_registry.py SF [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from vitrina.registry.catalogs import TABLES  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if value != value else format(value, ".9g")
    if hasattr(value, "as_tuple"):
        return format(float(value), ".9g")
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, name, build, sql, sf_dir) -> str | None:
    """What differs between a query and its SQL, None when they agree."""
    df = build(spark, sf_dir)
    start = time.time()
    ours = rows_of(df.columns, [tuple(row) for row in df.collect()])
    print(f"    collected after {time.time() - start:.2f}s", end=" ")
    cursor = con.execute(sql)
    columns = [item[0] for item in cursor.description]
    kinds = {item[0]: str(item[1]) for item in cursor.description}
    theirs = rows_of(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} and {sorted(columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows"
    for left, right in zip(ours, theirs):
        if left != right:
            return f"{left} and {right}"
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    odd = [
        f"{column} {dtype}/{kinds[column]}"
        for column, dtype in df.dtypes
        if names.get(dtype, kinds[column]) != kinds[column]
    ]
    return f"types {odd}" if odd else None


if __name__ == "__main__":
    import __spark_entry__ as driver
    from tests.conftest import local_session

    scale, *wanted = sys.argv[1:]
    sf_dir = f"/root/testdata/sf{scale}"
    spark, con = local_session(), connect(sf_dir)
    oracle = driver.oracle_sql()
    missing = set(driver.queries()) - set(oracle)
    extra = set(oracle) - set(driver.queries())
    print("without SQL:", sorted(missing), "without query:", sorted(extra))
    bad = 0
    for name, build in driver.queries().items():
        if (wanted and name not in wanted) or name not in oracle:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, build, oracle[name], sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        bad += problem is not None
        print(f"{'BAD' if problem else 'ok '} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print("differences:", bad)
