"""Runs registered queries against their SQL twins: python tests/oraclecheck.py [sf] [name ...]"""

import datetime
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entrypoint  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6) + 0.0:.6f}"
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def compare(spark, con, name, sf_dir):
    """None when equal, otherwise what differs."""
    df = entrypoint.queries()[name](spark, sf_dir)
    got, got_columns = _rows(df.columns, [tuple(r) for r in df.collect()])
    sql = entrypoint.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    cur = con.execute(sql)
    want, want_columns = _rows([d[0] for d in cur.description], cur.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        extra = list(set(got) - set(want))[:2]
        missing = list(set(want) - set(got))[:2]
        return f"{len(got)} vs {len(want)} rows; extra {extra} missing {missing}"
    return None if got else "no rows"


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(entrypoint.queries())
    spark, con = session(), connect(f"/root/testdata/sf{sf}")
    bad = 0
    for name in names:
        start = time.time()
        try:
            diff = compare(spark, con, name, f"/root/testdata/sf{sf}")
        except Exception as exc:  # noqa: BLE001
            diff = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += diff is not None
        tag = "" if name in entrypoint.oracle_sql() else " (rows only)"
        print(f"{'ok ' if diff is None else 'BAD'} {name}{tag} {time.time() - start:.2f}s {diff or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    sys.exit(bool(bad))
