"""Run registered queries beside their SQL in DuckDB and compare whole results.

    python tools/compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

import duckdb
import pandas as pd

from folioweave.plans.catalogue import ORACLES, QUERIES
from folioweave.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def tidy(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [tuple(None if v is None or v is pd.NA or (isinstance(v, float) and v != v) else
                  (v.isoformat() if isinstance(v, pd.Timestamp) else
                   v.item() if hasattr(v, "item") else v) for v in row)
            for row in frame.itertuples(index=False, name=None)]
    return sorted(rows, key=repr)


def duck(sf: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def compare(spark, connection, sf: str, name: str) -> tuple[bool, str]:
    began = time.time()
    frame = QUERIES[name](spark, sf)
    mine = frame.toPandas()
    spent = time.time() - began
    if name not in ORACLES:
        return True, f"rows only: {len(mine)} rows, {spent:.1f}s"
    began = time.time()
    table = connection.sql(ORACLES[name]).to_arrow_table()
    theirs = table.to_pandas()
    other = time.time() - began
    note = f"{len(mine)} rows, spark {spent:.1f}s, sql {other:.1f}s"
    if sorted(mine.columns) != sorted(theirs.columns):
        return False, f"columns {sorted(mine.columns)} / {sorted(theirs.columns)}"
    kinds = {f.name: f.dataType.simpleString() for f in frame.schema}
    sql_kinds = {f.name: str(f.type) for f in table.schema}
    same = {"bigint": "int64", "int": "int32", "string": "string", "double": "double",
            "boolean": "bool", "timestamp": "timestamp[us]"}
    odd = {n: (k, sql_kinds[n]) for n, k in kinds.items() if same.get(k) != sql_kinds[n]}
    a, b = tidy(mine), tidy(theirs)
    if a != b:
        lost = [r for r in b if r not in set(a)][:2] if len(b) < 5000 else []
        extra = [r for r in a if r not in set(b)][:2] if len(a) < 5000 else []
        return False, f"{note}; sql {len(b)} rows; extra {extra}; lost {lost}"
    return not odd, note + (f"; types differ {odd}" if odd else "")


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session("local[8]", extra={
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(args.sf)
    bad = 0
    for name in args.names or QUERIES:
        try:
            fine, note = compare(spark, connection, args.sf, name)
        except Exception as error:
            fine, note = False, f"{type(error).__name__}: {str(error)[:1200]}"
        bad += not fine
        print(f"{'ok  ' if fine else 'FAIL'} {name}: {note[:1500]}", flush=True)
    print(f"{bad} failing")
    return bool(bad)


if __name__ == "__main__":
    raise SystemExit(main())
