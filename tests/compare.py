"""Run a registered query and its SQL twin side by side and compare all rows."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool):
        return repr(value)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, con, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got_cols = df.columns
    got = _rows(got_cols, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want_cols = rel.columns
    want = _rows(want_cols, rel.fetchall())
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} != {sorted(want_cols)}"
    if got != want:
        return (
            f"{sum(got.values())} rows, expected {sum(want.values())}; "
            f"extra {list((got - want).items())[:2]}; missing {list((want - got).items())[:2]}"
        )
    return None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    names = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            if name in oracles:
                found = differences(spark, con, name, queries[name], oracles[name], sf_dir)
            else:
                df = queries[name](spark, sf_dir)
                found = None if len(df.collect()) else "no rows"
        except Exception as e:  # noqa: BLE001
            found = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += found is not None
        kind = "sql " if name in oracles else "rows"
        print(f"{'FAIL' if found else 'ok  '} {kind} {time.time() - start:6.2f}s {name} {found or ''}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
