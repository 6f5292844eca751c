"""Compare registered queries with their SQL on DuckDB: ``python tests/compare.py [sf_dir] [name...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)
    if isinstance(v, bool):
        return float(v)
    if isinstance(v, int):
        return float(v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


def compare(spark, con, fn, sql, sf_dir) -> str:
    """Empty if both give the same rows, else what differs."""
    df = fn(spark, sf_dir)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    for a, b in zip(ours, theirs, strict=True):
        if a != b:
            return f"{str(a)[:300]} / {str(b)[:300]}"
    return ""


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries, oracles = entry.queries(), entry.oracle_sql()
    wanted = sys.argv[2:] or [n for n in queries if not n.startswith("op") and n != "pipeline"]
    spark, con, bad = session(), connect(folder), []
    for name in wanted:
        try:
            if name in oracles:
                said = compare(spark, con, queries[name], oracles[name], folder)
            else:
                said = "" if queries[name](spark, folder).count() >= 0 else "?"
        except Exception as e:  # noqa: BLE001
            said = f"{type(e).__name__}: {str(e)[:400]}"
        print("ok  " if not said else "FAIL", name, said, flush=True)
        bad += [name] if said else []
    print(len(wanted) - len(bad), "of", len(wanted))
    sys.exit(bool(bad))
