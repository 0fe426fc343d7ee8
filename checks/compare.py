"""Run the registered queries next to their SQL and report differences.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
# Spark's type names and the DuckDB types they must meet.
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _sorted(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda row: [(v is not None, str(v)) for v in row])


def difference(
    spark: SparkSession, con, sf_dir: str, name: str, queries=QUERIES, oracles=ORACLES
) -> str | None:
    """What differs between a query and its SQL; None if nothing does."""
    frame = queries[name](spark, sf_dir)
    columns = sorted(frame.columns)
    mine = _sorted([tuple(row) for row in frame.select(*columns).collect()])
    relation = con.sql(oracles[name])
    if sorted(relation.columns) != columns:
        return f"columns {columns} against {sorted(relation.columns)}"
    theirs_types = dict(zip(relation.columns, map(str, relation.types)))
    for column, kind in frame.dtypes:
        if TYPES[kind] != theirs_types[column]:
            return f"type of {column}: {kind} against {theirs_types[column]}"
    theirs = _sorted(relation.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main(arguments: list[str]) -> int:
    from bench import local_session

    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    spark = local_session(8)
    con = connect(sf_dir)
    failures = 0
    for name in arguments[1:] or QUERIES:
        start = time.time()
        found = difference(spark, con, sf_dir, name)
        failures += found is not None
        print(f"{name:20} {time.time() - start:6.2f} s  {found or 'equal'}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
