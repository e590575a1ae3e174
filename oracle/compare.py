"""Strict comparison of every registered query with its DuckDB twin.

    python -m oracle.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def plain(value):
    """A value both engines can be compared on; nothing is rounded."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, Decimal)):
        return Decimal(value).normalize()
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def check(spark, con, sf_dir: str, name: str, entry) -> str:
    """'' when both sides agree, else a short description."""
    df = entry.run(spark, sf_dir)
    spark_columns = df.columns
    got = rows_of(spark_columns, df.collect())
    if entry.sql is None:
        return ""
    cursor = con.execute(entry.sql)
    duck_columns = [c[0] for c in cursor.description]
    want = rows_of(duck_columns, cursor.fetchall())
    if sorted(spark_columns) != sorted(duck_columns):
        return f"columns {sorted(set(spark_columns) ^ set(duck_columns))}"
    if got != want:
        extra, missing = list((got - want).elements()), list((want - got).elements())
        text = f"rows {sum(got.values())}/{sum(want.values())}, {len(extra)} differ"
        if extra and missing:
            names = sorted(spark_columns)
            best = min(missing, key=lambda m: sum(a != b for a, b in zip(extra[0], m)))
            diff = [(n, a, b) for n, a, b in zip(names, extra[0], best) if a != b]
            text += f": {diff[:4]}"
        return text
    if sum(want.values()) == 0:
        return "EMPTY on both sides"
    return ""


def main(sf_dir: str, names: list[str]) -> int:
    from oracle.registry import ENTRIES
    from tidemark.session import build_session

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in names or list(ENTRIES):
        begin = time.time()
        try:
            problem = check(spark, con, sf_dir, name, ENTRIES[name])
        except Exception as error:  # keep going: the list of failures is the result
            problem = "ERROR " + str(error)[:600]
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - begin:6.2f}s {name} {problem}", flush=True)
        bad += bool(problem)
    print(f"{bad} of {len(names or ENTRIES)} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
