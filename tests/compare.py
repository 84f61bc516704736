"""Run registered queries and their check SQL side by side.

    python -m tests.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import hashlib
import math
import sys
import time
import traceback

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute("SET max_temp_directory_size = '4GB'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v) -> str:
    if v is None:
        return "null"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, int) and not isinstance(v, bool):
        return f"{float(v):.9g}" if abs(v) < 2**53 else str(v)
    return str(v)


def fingerprint(columns: list[str], rows: list[tuple]) -> tuple[list[str], int, str, list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = sorted(tuple(_value(r[i]) for i in order) for r in rows)
    digest = hashlib.sha256(repr(plain).encode()).hexdigest()
    return [columns[i] for i in order], len(plain), digest, plain


def spark_side(df):
    return fingerprint(df.columns, [tuple(r) for r in df.collect()])


def sql_side(con, sql: str):
    found = con.execute(sql)
    return fingerprint([c[0] for c in found.description], found.fetchall())


def main() -> int:
    from pyspark.sql import SparkSession

    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        try:
            start = time.time()
            ours = spark_side(entry.queries()[name](spark, sf_dir))
            took = time.time() - start
            sql = entry.oracle_sql().get(name)
            if sql is None:
                print(f"rows  {name:28s} {ours[1]:8d} rows {took:6.2f}s", flush=True)
                continue
            theirs = sql_side(con, sql)
            same = ours[:3] == theirs[:3]
            print(f"{'ok   ' if same else 'DIFF '} {name:28s} {ours[1]:8d} rows {took:6.2f}s", flush=True)
            if not same:
                bad += 1
                print("   columns", ours[0], theirs[0], "rows", ours[1], theirs[1])
                a, b = set(ours[3]), set(theirs[3])
                print("   ours only ", sorted(a - b)[:3])
                print("   theirs only", sorted(b - a)[:3])
        except Exception as e:
            bad += 1
            print(f"FAIL  {name}: {str(e)[:1500]}", flush=True)
            if "-v" in sys.argv:
                traceback.print_exc()
    print(f"{bad} of {len(names)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
