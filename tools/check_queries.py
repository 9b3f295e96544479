"""Run queries and their SQL side by side: ``python tools/check_queries.py SF_DIR [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def oracle_rows(sf_dir, sql):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = connection.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())


def compare(spark, sf_dir, function, sql):
    """``(row count, problem or None)`` of one query."""
    df = function(spark, sf_dir)
    columns, rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    total = sum(rows.values())
    if sql is None:
        return total, None
    expected_columns, expected = oracle_rows(sf_dir, sql)
    if columns != expected_columns:
        return total, f"columns {columns} != {expected_columns}"
    if rows != expected:
        ours, theirs = list((rows - expected).items())[:3], list((expected - rows).items())[:3]
        return total, f"{sum((rows - expected).values())} rows differ of {total}/{sum(expected.values())}: {ours} / {theirs}"
    return total, None


def main() -> int:
    from pyspark.sql import SparkSession

    from leadloom.driver import ORACLES, QUERIES

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        started = time.time()
        try:
            total, problem = compare(spark, sf_dir, QUERIES[name], ORACLES.get(name))
        except Exception as error:  # report and go on with the next query
            total, problem = 0, f"{type(error).__name__}: {str(error)[:700]}"
        mark = "ok" if problem is None and name in ORACLES else "rows" if problem is None else "BAD"
        bad += mark == "BAD"
        print(f"{mark:4} {name:28} {total:7} rows {time.time() - started:6.1f}s {problem or ''}"[:1500], flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
