"""Runs named queries on Spark and their SQL on DuckDB, and compares rows regardless of order."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
import sys
import time

import duckdb


def connect(folder: str):
    db = duckdb.connect()
    db.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def plain(value):
    if isinstance(value, decimal.Decimal):
        return f"{value:f}"
    if isinstance(value, float):
        return repr(round(value, 9) + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return "NULL" if value is None else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


# Names of the same type in the two engines.
SAME = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def compare(spark, db, run, sql: str, folder: str):
    """Differences as text; empty if there are none."""
    found = run(spark, folder)
    types = {f.name: f.dataType.simpleString() for f in found.schema}
    ours = rows_of(found.columns, found.collect())
    answer = db.execute(sql)
    names = [d[0] for d in answer.description]
    kinds = {d[0]: str(d[1]) for d in answer.description}
    theirs = rows_of(names, answer.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} against {theirs[0]}"
    odd = {n: (types[n], kinds[n]) for n in names if SAME.get(types[n], types[n].upper()) != kinds[n]}
    if odd:
        return f"types {odd}"
    if ours[1] != theirs[1]:
        a, b = set(ours[1]), set(theirs[1])
        return f"{len(ours[1])} against {len(theirs[1])} rows; only ours {sorted(a - b)[:3]}; only theirs {sorted(b - a)[:3]}"
    return ""


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config(
        "spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    db, sqls = connect(folder), entry.oracle_sql()
    for name, run in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in sqls:
                difference = compare(spark, db, run, sqls[name], folder)
                verdict = difference or "same"
            else:
                verdict = f"rows only: {run(spark, folder).count()}"
        except Exception as error:  # noqa: BLE001 - report and go on
            verdict = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:34s} {time.time() - start:6.2f}s  {verdict}", flush=True)
