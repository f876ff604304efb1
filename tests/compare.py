"""Run queries beside their SQL and compare columns, types and values.

``python -m tests.compare [sf_dir] [name …]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from collections import Counter
from datetime import date, datetime
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# How the types of one side are named on the other.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            db.sql(f"create view {table} as from '{sf_dir}/{table}.parquet'")
    return db


def _plain(value: object) -> object:
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def _rows(names: list[str], rows: list) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What does not match, in words; empty when all does."""
    relation = db.sql(sql)
    expected_types = dict(zip(relation.columns, [str(t) for t in relation.types], strict=True))
    actual_types = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    found = []
    if actual_types != expected_types:
        found.append(
            f"schema: {sorted(set(actual_types.items()) ^ set(expected_types.items()))}"
        )
    actual = _rows(df.columns, df.collect())
    expected = _rows(relation.columns, relation.fetchall())
    if actual.total() != expected.total():
        found.append(f"rows: {actual.total()} instead of {expected.total()}")
    if actual != expected:
        extra, lacking = actual - expected, expected - actual
        found.append(
            f"values: {extra.total()} unexpected, e.g. {next(iter(extra), None)}; "
            f"{lacking.total()} lacking, e.g. {next(iter(lacking), None)}"
        )
    if not expected:
        found.append("the SQL gives no row")
    return found


def main() -> None:
    import __spark_entry__ as entry
    from trackside.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark: SparkSession = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8",
                                  "spark.driver.memory": "8g",
                                  "spark.checkpoint.dir": tempfile.mkdtemp(prefix="compare-")}
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, statements = connect(sf_dir), entry.oracle_sql()
    failed = 0
    for name, run in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            found = differences(run(spark, sf_dir), db, statements[name])
        except Exception as error:  # report and go on to the next query
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {time.time() - start:6.2f}s {name}", *found,
              sep="\n       " if found else " ", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
