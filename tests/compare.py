"""Run registered queries beside their SQL in DuckDB and compare all rows.

    python -m tests.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import time
from collections import Counter

import duckdb

from tidemark.catalog import QUERIES, SQL
from tidemark.session import session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def compare(spark, con, name, folder, sql=True):
    """(rows, seconds, problem or None); a query without SQL only has to give rows."""
    start = time.time()
    df = QUERIES[name](spark, folder)
    if not sql:
        df.write.format("noop").mode("overwrite").save()
        return 0, time.time() - start, None
    got = df.collect()
    spent = time.time() - start
    if name not in SQL:
        return len(got), spent, None if got else "no rows"
    result = con.execute(SQL[name])
    want_columns = [d[0] for d in result.description]
    want_types = {d[0]: str(d[1]) for d in result.description}
    want = result.fetchall()
    left, right = rows_of(df.columns, got), rows_of(want_columns, want)
    if left[0] != right[0]:
        return len(got), spent, f"columns {left[0]} != {right[0]}"
    types = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for column, kind in df.dtypes:
        if types.get(kind, kind) != want_types[column]:
            return len(got), spent, f"type of {column}: {kind} != {want_types[column]}"
    if left[1] != right[1]:
        extra, missing = left[1] - right[1], right[1] - left[1]
        return len(got), spent, (
            f"{len(got)} rows vs {len(want)}; only here {sum(extra.values())} {list(extra)[:3]}; "
            f"only there {sum(missing.values())} {list(missing)[:3]}"
        )
    return len(got), spent, None


def main():
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("--time-only", action="store_true", help="run without the SQL side")
    args.add_argument("names", nargs="*")
    args = args.parse_args()
    spark = session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(args.sf)
    bad = 0
    for name in args.names or QUERIES:
        try:
            n, spent, problem = compare(spark, con, name, args.sf, not args.time_only)
        except Exception as error:  # report and go on with the next query
            n, spent, problem = 0, 0.0, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {'sql ' if name in SQL else 'rows'} {n:8d} {spent:7.2f}s {problem or ''}", flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
