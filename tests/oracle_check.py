"""Run registered queries and their SQL counterparts and compare them row by row.

    python tests/oracle_check.py [sf] [query ...]
"""

from __future__ import annotations

import datetime
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, Decimal):
        return format(value, "f")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def oracle_connection(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def compare(spark, con, query, sql, sf_dir):
    """None if equal, else a short description of the difference."""
    df = query(spark, sf_dir)
    ours, columns = df.collect(), df.columns
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(columns) != sorted(names):
        return f"columns {sorted(set(columns) ^ set(names))}", len(ours)
    a, b = rows_of(columns, ours), rows_of(names, theirs)
    if a == b:
        return None, len(ours)
    return (
        f"{len(ours)} / {len(theirs)} rows; only ours {list((a - b).items())[:2]};"
        f" only oracle {list((b - a).items())[:2]}; {sorted(names)}", len(ours)
    )


def main():
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = oracle_connection(sf_dir)
    sqls, failed = entry.oracle_sql(), []
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        begin = time.time()
        try:
            problem, n = compare(spark, con, query, sqls[name], sf_dir)
        except Exception as e:  # report and go on with the next query
            problem, n = f"{type(e).__name__}: {str(e)[:700]}", 0
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {n} rows {time.time() - begin:.1f}s")
        if problem:
            failed.append(name)
            print("    ", problem[:1500])
    print("failed:", failed)
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
