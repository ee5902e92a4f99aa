"""Run registered queries and their SQL counterparts side by side."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import time

import duckdb

from pyspark.sql import SparkSession


def sql_engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    engine = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        engine.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return engine


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (dt.datetime, dt.date, bool, int, str)) or value is None:
        return value
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark: SparkSession, sf_dir: str, build, sql: str) -> str:
    """Empty when both agree, otherwise what differs."""
    frame = build(spark, sf_dir)
    ours = rows_of(frame.columns, frame.collect())
    cursor = sql_engine(sf_dir).execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns differ: {sorted(set(frame.columns) ^ set(names))}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            pairs = [(n, x, y) for n, x, y in zip(sorted(names), a, b) if x != y or type(x) is not type(y)]
            return f"first difference: {pairs} in {a}"
    return ""


def main(sf_dir: str, only: list[str]) -> int:
    from checks.oracle import ORACLE
    from checks.registry import QUERIES
    from curbsight.session import local_session

    spark = local_session()
    bad = 0
    for name, build in QUERIES.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in ORACLE:
                verdict = compare(spark, sf_dir, build, ORACLE[name])
            else:
                verdict = f"no SQL, {build(spark, sf_dir).count()} rows"
        except Exception as error:  # noqa: BLE001 - the report names whatever went wrong
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(verdict)
        print(f"{'ok ' if not verdict else 'BAD'} {name:28s} {time.time() - start:6.2f}s {verdict}", flush=True)
    print(f"{bad} of {len(QUERIES)} differ")
    return bad


if __name__ == "__main__":
    import sys

    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
