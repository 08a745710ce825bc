"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

    python -m verification.compare [--sf DIR] [--explain] [query ...]
"""

from __future__ import annotations

import argparse
import math
import os
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

from growthmill.session import build_session
from verification.models_sql import GIVEN_TABLES
from verification.registry import QUERIES

SPARK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
    "BOOLEAN": "boolean",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in GIVEN_TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def spark_rows(df: DataFrame) -> tuple[dict[str, str], Counter]:
    names = sorted(df.columns)
    types = {name: kind.replace("timestamp_ntz", "timestamp") for name, kind in df.dtypes}
    rows = df.select(*[f"`{n}`" for n in names]).collect()
    return types, Counter(tuple(_cell(v) for v in row) for row in rows)


def duck_rows(connection, sql: str) -> tuple[dict[str, str], Counter]:
    relation = connection.sql(sql)
    names = relation.columns
    types = {n: SPARK_TYPES.get(str(t), str(t)) for n, t in zip(names, relation.types)}
    order = sorted(range(len(names)), key=lambda i: names[i])
    return types, Counter(tuple(_cell(row[i]) for i in order) for row in relation.fetchall())


def differences(spark: SparkSession, connection, name: str, sf_dir: str) -> tuple[int, list[str]]:
    """Row count of the Spark result and what differs from the expected one."""
    query = QUERIES[name]
    kinds, got = spark_rows(query(spark, sf_dir))
    problems = []
    unlisted = [c for c, k in kinds.items() if k == "double" and c not in query.digits]
    if unlisted:
        problems.append(f"double columns without rounding: {unlisted}")
    if query.oracle is None:
        return got.total(), problems
    expected_kinds, expected = duck_rows(connection, query.oracle)
    if kinds != expected_kinds:
        wrong = {c: (kinds.get(c), expected_kinds.get(c)) for c in {*kinds, *expected_kinds}}
        problems.append(f"types differ: { {c: p for c, p in wrong.items() if p[0] != p[1]} }")
    if got != expected:
        problems.append(f"rows differ: {got.total()} and {expected.total()}")
        problems += [f"  only in Spark: {row}" for row in list((got - expected))[:3]]
        problems += [f"  only expected: {row}" for row in list((expected - got))[:3]]
    return got.total(), problems


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    arguments = parser.parse_args()
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "compare", f"local[{cores}]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(arguments.sf)
    failed = 0
    for name in arguments.names or QUERIES:
        started = time.time()
        try:
            rows, problems = differences(spark, connection, name, arguments.sf)
        except Exception as error:
            rows, problems = -1, [str(error)[:1500]]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok':4} {name} rows={rows} {time.time() - started:.1f}s", flush=True)
        for problem in problems:
            print("    ", problem)
    print(f"{len(arguments.names or QUERIES)} queries, {failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
