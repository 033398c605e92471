"""Run every query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, Decimal):
        return f"{value:f}"
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(row[i]) for i in order) for row in rows)


KINDS = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, sf_dir, query, sql):
    """Empty when equal, otherwise a description of the difference."""
    df = query(spark, sf_dir)
    mine = table(df.columns, [tuple(row) for row in df.collect()])
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    theirs = table(names, cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    for name, kind in df.dtypes:
        want = KINDS.get(kind, kind.upper())
        if want != kinds[name]:
            return f"type of {name}: {want} != {kinds[name]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} != {len(theirs[1])}"
    wrong = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(mine[1])} rows differ, first {wrong[0]}"
    return ""


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf_dir = sys.argv[1]
    only = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = contract.oracle_sql()
    for name, query in contract.queries().items():
        if only and name not in only:
            continue
        begin = time.time()
        try:
            if name in sql:
                result = compare(spark, con, sf_dir, query, sql[name]) or "ok"
            else:
                result = f"rows only: {query(spark, sf_dir).count()}"
        except Exception as error:
            result = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:34s} {time.time() - begin:6.2f}s  {result}", flush=True)
    missing = set(sql) - set(contract.queries())
    if missing:
        print("SQL without query:", missing)
