"""Run registered queries next to their SQL on the same tables."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def canonical(value):
    if isinstance(value, float):
        return "null" if math.isnan(value) else f"{value:.7g}" if abs(value) < math.inf else str(value)
    return "null" if value is None else str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(row[i]) for i in order) for row in rows)


def difference(spark_df, connection, sql):
    """None when both results are equal, else a short description."""
    ours = spark_df.collect()
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    a, b = sorted_rows(spark_df.columns, ours), sorted_rows(names, theirs)
    different = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    return f"{len(different)} rows differ, first {different[0]}" if different else None


def main(folder, names):
    from pyspark.sql import SparkSession

    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    connection = duck(folder)
    oracles = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in oracles:
                outcome = difference(df, connection, oracles[name]) or "equal"
            else:
                outcome = f"rows {len(df.collect())}"
        except Exception as error:  # noqa: BLE001
            outcome = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        bad += outcome != "equal" and not outcome.startswith("rows ")
        print(f"{name:32s} {time.time() - start:7.2f}s {outcome}", flush=True)
    print("bad:", bad, "unknown oracles:", sorted(set(oracles) - set(entry.queries())))


if __name__ == "__main__":
    main(sys.argv[1], set(sys.argv[2:]))
