"""Compare registered queries with their SQL on the same Parquet files.

    python tests/oracle.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _normal(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    rows = []
    for row in df.itertuples(index=False):
        values = []
        for v in row:
            if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
                values.append(None)
            elif isinstance(v, pd.Timestamp):
                values.append(str(v))
            elif hasattr(v, "isoformat"):
                values.append(str(pd.Timestamp(v)))
            elif isinstance(v, bool) or type(v).__name__ == "bool_":
                values.append(bool(v))
            elif isinstance(v, (int, float)) or hasattr(v, "item"):
                values.append(repr(float(v)))
            else:
                values.append(str(v))
        rows.append(tuple(values))
    return sorted(rows, key=repr)


def differences(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(set(ours.columns) ^ set(theirs.columns))}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}"
    a, b = _normal(ours), _normal(theirs)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        names = sorted(ours.columns)
        x, y = bad[0]
        cells = [(n, p, q) for n, p, q in zip(names, x, y) if p != q]
        return f"{len(bad)} rows differ, first: {cells[:6]}"
    return None


def extra() -> dict[str, str]:
    """A folder for tables and checkpoints, if the caller names one."""
    folder = os.environ.get("CHECK_DIR")
    return {"spark.checkpoint.dir": folder} if folder else {}


def main(sf_dir: str, only: list[str]) -> int:
    from aerolith.session import build_session
    import __spark_entry__ as entry

    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", **extra()})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in only or queries:
        start = time.time()
        try:
            ours = queries[name](spark, sf_dir).toPandas()
            took = time.time() - start
            if name not in oracles:
                print(f"rows  {name:36s} {len(ours):8d} rows {took:6.2f}s", flush=True)
                continue
            problem = differences(ours, con.execute(oracles[name]).df())
        except Exception as e:  # report and go on with the next query
            problem, took, ours = f"{type(e).__name__}: {str(e)[:600]}", time.time() - start, []
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '}  {name:36s} {len(ours):8d} rows {took:6.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
