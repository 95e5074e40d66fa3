"""Compare registered queries with their SQL: ``python -m tests.compare [sf_dir] [names...]``."""

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def database(sf_dir):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return db


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).decode()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(db, sql):
    found = db.execute(sql)
    return rows_of([d[0] for d in found.description], found.fetchall())


def difference(df, db, sql):
    """None when equal, else a short account of the first difference."""
    mine, theirs = spark_rows(df), duck_rows(db, sql)
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} against {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows against {len(theirs[1])}"
    for a, b in zip(mine[1], theirs[1]):
        if a != b:
            return f"{mine[0]}: {a} against {b}"
    return None


def main():
    from __spark_entry__ import oracle_sql, queries
    from fleetpulse.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(queries())
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8",
                                                "spark.ui.enabled": "false",
                                                "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    db, sql, failed = database(sf_dir), oracle_sql(), 0
    for name in wanted:
        started = time.time()
        try:
            result = difference(queries()[name](spark, sf_dir), db, sql[name]) if name in sql else "no sql"
        except Exception as problem:  # noqa: BLE001 - a report over all queries
            result = f"{type(problem).__name__}: {str(problem)[:600]}"
        failed += result is not None
        print(f"{name:32s} {time.time() - started:6.2f}s  {result or 'equal'}", flush=True)
    print("differing:", failed)


if __name__ == "__main__":
    main()
