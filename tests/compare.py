"""Compare every query with its SQL on a generated data set."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    """Rows as comparable tuples, columns by name, rows sorted."""
    df = df[sorted(df.columns)]

    def cell(v):
        if v is None or (not isinstance(v, (str, bytes)) and pd.isna(v)):
            return ""
        if isinstance(v, (bool,)) or type(v).__name__ == "bool_":
            return str(bool(v))
        if isinstance(v, pd.Timestamp):
            return v.strftime("%Y-%m-%d %H:%M:%S.%f")
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, float):
            return repr(int(v)) if v == int(v) else f"{v:.4f}"
        return str(v)

    return sorted(tuple(cell(v) for v in row) for row in df.itertuples(index=False, name=None))


def difference(spark, con, sf_dir: str, name: str, queries, oracle) -> str | None:
    got = queries[name](spark, sf_dir).toPandas()
    want = con.execute(oracle[name]).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    if a == b:
        return None
    sa, sb = set(a), set(b)
    return f"rows {len(a)} / {len(b)}; only Spark {list(sa - sb)[:2]}; only SQL {list(sb - sa)[:2]}"


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    from __spark_entry__ import oracle_sql, queries
    from vitalgrid.session import local_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    spark, con, qs, sql = local_session(), connect(sf_dir), queries(), oracle_sql()
    bad = 0
    for q in sys.argv[2:] or qs:
        began = time.time()
        try:
            out = difference(spark, con, sf_dir, q, qs, sql)
        except Exception as e:  # report all queries, not only the first
            out = f"{type(e).__name__}: {str(e)[:600]}"
        bad += out is not None
        print(f"{q:22s} {time.time() - began:6.2f}s {'ok' if out is None else out}", flush=True)
    print("failures:", bad)
