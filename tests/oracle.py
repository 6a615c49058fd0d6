"""Compare registered queries with their SQL on DuckDB: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    out = df[sorted(df.columns)].copy()
    for c in out.columns:
        out[c] = out[c].map(lambda v: "~" if v is None or v != v else (f"{float(v):.6f}" if isinstance(v, (int, float)) or hasattr(v, "dtype") else str(v)))
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def compare(spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> str | None:
    """None when equal, else what differs."""
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        return f"columns {list(spark_df.columns)} vs {list(sql_df.columns)}"
    if len(spark_df) != len(sql_df):
        return f"rows {len(spark_df)} vs {len(sql_df)}"
    a, b = canonical(spark_df), canonical(sql_df)
    if a.equals(b):
        return None
    bad = (a != b).any(axis=1)
    return f"{int(bad.sum())} of {len(a)} rows differ\n{a[bad].head(4)}\n{b[bad].head(4)}"


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    from wattframe.plans.registry import load_all
    from wattframe.session import build_session

    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name, q in load_all().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            got = q.run(spark, sf_dir).toPandas()
            seconds = time.time() - start
            if q.sql is None:
                print(f"ROWS {name} {len(got)} {seconds:.2f}s", flush=True)
                continue
            problem = compare(got, con.execute(q.oracle()).df())
        except Exception as e:  # report and go on to the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
            seconds = time.time() - start
        if problem:
            failed.append(name)
        print(f"{'FAIL' if problem else 'ok  '} {name} {seconds:.2f}s{' ' + problem if problem else f' {len(got)}'}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
