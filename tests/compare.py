"""Run registered queries beside their SQL and compare rows, names and types.

``python tests/compare.py [folder] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
         "BOOLEAN": "boolean"}


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def _sortable(row):
    return tuple((v is None, str(type(v)) if v is None else "", repr(v)) for v in row)


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None where both sides agree, else what differs."""
    relation = connection.sql(sql)
    names = sorted(relation.columns)
    if sorted(result.columns) != names:
        return f"columns {sorted(result.columns)} vs {names}"
    theirs = {c: KINDS.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types)}
    ours = dict(result.dtypes)
    kinds = [f"{c}: {ours[c]} vs {theirs[c]}" for c in names if ours[c] != theirs[c]]
    if kinds:
        return "types " + "; ".join(kinds)
    left = sorted((tuple(r) for r in result.select(*names).collect()), key=_sortable)
    order = ", ".join(f'"{n}"' for n in names)
    right = sorted(connection.sql(f"SELECT {order} FROM ({sql})").fetchall(), key=_sortable)
    if len(left) != len(right):
        extra = set(left) ^ set(right)
        return f"rows {len(left)} vs {len(right)}; e.g. {list(extra)[:2]}"
    for a, b in zip(left, right):
        for x, y in zip(a, b):
            if x != y and not (isinstance(x, float) and isinstance(y, float)
                               and math.isnan(x) and math.isnan(y)):
                return f"row {a} vs {b}"
    return None


def local_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]").appName("kelvane-tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.streaming.metricsEnabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    import __spark_entry__ as contract
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark, connection = local_session(), database(folder)
    bad = 0
    for name, run in contract.queries().items():
        if chosen and name not in chosen:
            continue
        started = time.time()
        try:
            result = run(spark, folder)
            sql = contract.oracle_sql().get(name)
            problem = differences(result, connection, sql) if sql else None
            count = result.count()
        except Exception as error:  # report and go on
            problem, count = f"{type(error).__name__}: {str(error)[:700]}", -1
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:28s} {count:8d} "
              f"{time.time() - started:6.1f}s {problem or ''}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
