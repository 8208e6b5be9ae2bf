"""Run the named queries next to their SQL statements and report differences.

    python tests/check_queries.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as entry  # noqa: E402
from wattgrid.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if pd.api.types.is_datetime64_any_dtype(frame[c]):
            frame[c] = frame[c].astype("datetime64[us]")
        elif pd.api.types.is_numeric_dtype(frame[c]) and not pd.api.types.is_bool_dtype(frame[c]):
            frame[c] = frame[c].astype("float64")
        else:
            frame[c] = frame[c].astype("string")
    return frame.sort_values(list(frame.columns), na_position="last").reset_index(drop=True)


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """First difference as text; None when both frames are equal."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)} rows"
    a, b = canonical(ours), canonical(theirs)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        same = same.fillna(False)
        if not same.all():
            i = int((~same).to_numpy().argmax())
            return f"{c}: {int((~same).sum())} values differ, e.g. {a[c][i]!r} != {b[c][i]!r}"
    return None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        began = time.perf_counter()
        try:
            ours = run(spark, sf_dir).toPandas()
            seconds = time.perf_counter() - began
            problem = difference(ours, con.sql(oracle[name]).df()) if name in oracle else None
            kind = "rows-only" if name not in oracle else "ok"
            if name not in oracle and len(ours) == 0:
                problem = "no rows"
        except Exception as e:  # report and go on with the next query
            seconds, problem, kind = time.perf_counter() - began, str(e)[:700], "error"
            ours = pd.DataFrame()
        bad += problem is not None
        print(f"{name:32s} {seconds:6.1f}s {len(ours):8d}  {'DIFF ' + problem if problem else kind}", flush=True)
    print(f"{bad} problems")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
