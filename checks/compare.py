"""Run registered queries against DuckDB: ``python -m checks.compare [sf_dir] [name ...]``."""

import sys
import time

import duckdb

from checks.oracles import ORACLES
from checks.queries import QUERIES

ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in ALL_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    return sorted((tuple(r[i] for i in order) for r in rows), key=key)


def differences(spark, con, name, sf_dir):
    """None where both sides agree, else a short text."""
    return frame_differences(QUERIES[name](spark, sf_dir), con, name)


def frame_differences(df, con, name):
    got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    want = sorted_rows(columns, cur.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}" if bad else None


def main(args):
    from portledger.session import build_session

    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(sf_dir), 0
    for name in args[1:] or QUERIES:
        t = time.time()
        try:
            diff = differences(spark, con, name, sf_dir)
        except Exception as exc:
            diff = f"{type(exc).__name__}: {str(exc)[:600]}"
        failed += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} {time.time() - t:.2f}s {diff or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
