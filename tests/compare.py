"""Compare every registered query with its SQL: `python -m tests.compare <folder> [name ...]`."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text where engines differ in type, rows sorted."""
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = df[c].astype("datetime64[us]")
        elif pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].astype(bool)
        elif pd.api.types.is_integer_dtype(df[c]) or pd.api.types.is_float_dtype(df[c]):
            df[c] = df[c].astype("float64")
        else:
            df[c] = df[c].map(lambda v: None if v is None or v is pd.NaT else str(v)[:10] if hasattr(v, "year") else str(v))
    return df.sort_values(list(df.columns), ignore_index=True)


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def mismatch(spark, folder: str, name: str, query, sql: str) -> str | None:
    got, want = canonical(query(spark, folder).toPandas()), canonical(duck(folder).sql(sql).df())
    if list(got.columns) != list(want.columns):
        return f"{name}: columns {list(got.columns)} != {list(want.columns)}"
    if len(got) != len(want):
        return f"{name}: {len(got)} rows != {len(want)}"
    try:
        pd.testing.assert_frame_equal(got, want, check_dtype=False)
    except AssertionError as e:
        return f"{name}: {e}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tallywake.session import local_session

    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    folder, names = sys.argv[1], sys.argv[2:] or list(entry.queries())
    for name in names:
        t = time.time()
        try:
            bad = mismatch(session, folder, name, entry.queries()[name], entry.oracle_sql()[name])
        except Exception as e:  # keep going: this is a report
            bad = f"{name}: {type(e).__name__} {str(e)[:1500]}"
        print(f"{'BAD ' + bad if bad else 'ok  ' + name}  {time.time() - t:.1f}s", flush=True)
