"""Compare registered queries with their DuckDB twins: python tests/check_oracles.py [sf] [name part ...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from clickloom.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text, rows sorted: what a value hash sees."""
    def cell(v):
        if v is None or v is pd.NA or v != v:
            return "NULL"
        if isinstance(v, float):
            return repr(round(v, 9))
        return str(v)

    df = df[sorted(df.columns)].astype(object)
    df = df.map(cell)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def spark_rows(df) -> pd.DataFrame:
    return pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns, dtype=object)


def duck_rows(con, sql: str) -> pd.DataFrame:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return pd.DataFrame(result.fetchall(), columns=names, dtype=object)


def differences(spark, con, name: str, sf_dir: str) -> str:
    """Empty if equal, else what differs."""
    mine = contract.queries()[name](spark, sf_dir)
    got = normal(spark_rows(mine))
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return "" if len(got) else "no rows"
    want = normal(duck_rows(con, sql))
    if list(got.columns) != list(want.columns):
        return f"columns {sorted(set(got.columns) ^ set(want.columns))}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [c for c in got.columns if not (got[c] == want[c]).all()]
    return f"values of {bad}: {got[bad].head(2).values.tolist()} != {want[bad].head(2).values.tolist()}" if bad else ""


if __name__ == "__main__":
    scale, *parts = sys.argv[1:] or ["0.01"]
    folder = f"/root/testdata/sf{scale}"
    session, connection = local_session(), duck(folder)
    failed = 0
    for query_name in contract.queries():
        if parts and not any(p in query_name for p in parts):
            continue
        started = time.time()
        try:
            problem = differences(session, connection, query_name, folder)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        kind = "sql" if query_name in contract.oracle_sql() else "rows"
        print(f"{query_name:40s} {time.time() - started:6.1f}s {kind:5s} {problem or 'ok'}", flush=True)
    print("failed:", failed)
