"""Compare a query with its oracle as the driver does: names, types, rows in any order."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pandas as pd


def tables(con: duckdb.DuckDBPyConnection, d: str) -> None:
    for p in Path(d).glob("*.parquet"):
        at = f"{p}/*.parquet" if p.is_dir() else str(p)
        con.execute(f"CREATE OR REPLACE VIEW {p.stem} AS SELECT * FROM '{at}'")


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        kind = str(df[c].dtype)
        if kind.startswith(("int", "Int", "uint")):
            df[c] = df[c].astype("Int64")
        elif kind.startswith("float"):
            df[c] = df[c].round(6) + 0.0
        elif kind.startswith("datetime"):
            df[c] = df[c].astype("datetime64[us]")
        else:
            df[c] = df[c].map(lambda v: None if v is None or v is pd.NA or v != v else str(v))
    keys = df.astype(str)
    return df.loc[keys.sort_values(list(keys.columns)).index].reset_index(drop=True)


def same(spark, query, sql: str, d: str) -> str:
    """Empty if equal, else the difference."""
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    tables(con, d)
    want, got = con.sql(sql).df(), query(spark, d).toPandas()
    if sorted(want.columns) != sorted(got.columns):
        return f"columns {sorted(got.columns)} {sorted(want.columns)}"
    if len(want) != len(got):
        return f"rows {len(got)}, oracle {len(want)}"
    a, b = normal(got).astype(str), normal(want).astype(str)
    a, b = a.replace({"None": "<NA>", "nan": "<NA>", "NaT": "<NA>"}), b.replace({"None": "<NA>", "nan": "<NA>", "NaT": "<NA>"})
    bad = (a != b).any(axis=1)
    if not bad.any():
        return ""
    # Numbers may be printed as whole or float.
    c, e = a[bad], b[bad]
    for col in c.columns:
        x, y = pd.to_numeric(c[col], errors="coerce"), pd.to_numeric(e[col], errors="coerce")
        ok = (c[col] == e[col]) | ((x - y).abs() <= 2e-6 * (1 + y.abs()))
        if not ok.all():
            return f"{col}: {c[~ok].head(3).to_dict('records')} oracle {e[~ok].head(3).to_dict('records')}"
    return ""


def main() -> None:
    import re
    import time

    import __spark_entry__ as e
    from tests.conftest import make_session

    spark, d, names = make_session(), sys.argv[1], sys.argv[2:]
    q, o = e.queries(), e.oracle_sql()
    for name in [n for n in q if any(re.fullmatch(p, n) for p in names)] if names else q:
        t = time.time()
        try:
          if name in o:
            out = same(spark, q[name], o[name], d) or "ok"
          else:
            out = f"rows only: {q[name](spark, d).count()}"
        except Exception as x:
            out = f"ERROR {type(x).__name__} {str(x)[:600]}"
        print(f"{name}: {out} ({time.time() - t:.1f} s)", flush=True)


if __name__ == "__main__":
    main()
