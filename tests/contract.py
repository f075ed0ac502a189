"""Compare registered queries with their SQL: ``python -m tests.contract SF_DIR [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

from __spark_entry__ import oracle_sql, queries
from telescale.operators.ordered import ROWS_KEY
from telescale.session import build_session


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def canonical(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return "null"
        if isinstance(v, bool):
            return str(v)
        return repr(float(v)) if isinstance(v, float) else str(v)

    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def differences(spark, con, name: str, sf_dir: str) -> str | None:
    """None when both engines give the same rows (and some), else what differs."""
    df = queries()[name](spark, sf_dir)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    want = canonical(columns, cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows / {len(want[1])}"
    if not got[1]:
        return "no rows"
    if got[1] != want[1]:
        pairs = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
        return f"{len(pairs)} rows differ, first {pairs[0]}"
    return None


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(queries())
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("ROWS_PER_BLOCK"):  # small values make every application a hot key
        spark.conf.set(ROWS_KEY, os.environ["ROWS_PER_BLOCK"])
    con = duck(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        if name not in oracle_sql():
            print(f"----  {name}: no SQL, {queries()[name](spark, sf_dir).count()} rows", flush=True)
            continue
        try:
            problem = differences(spark, con, name, sf_dir)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '}  {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names)} queries, {bad} wrong")


if __name__ == "__main__":
    main()
