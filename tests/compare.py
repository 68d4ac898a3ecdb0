"""Compare the named queries with their SQL counterparts: python tests/compare.py [folder] [names...]"""

from __future__ import annotations

import datetime as dt
import os
import sys
import time
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def tidy(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [tuple(plain(v) for v in row) for row in frame.itertuples(index=False, name=None)]
    return sorted(rows, key=repr)


def plain(v: object) -> object:
    if v is None or (not isinstance(v, (list, np.ndarray)) and pd.isna(v)):
        return None
    if isinstance(v, (dt.date, pd.Timestamp)):
        return pd.Timestamp(v).to_pydatetime()
    if isinstance(v, float) and v == 0:
        return 0.0
    return v


def kinds(frame: pd.DataFrame) -> dict[str, str]:
    names = {c: str(frame[c].dtype) for c in sorted(frame.columns)}
    return {c: "datetime" if n.startswith("datetime") else n for c, n in names.items()}


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str:
    """Empty if equal; otherwise what differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = tidy(got), tidy(want)
    if repr(a) == repr(b) or a == b:
        k, w = kinds(got), kinds(want)
        odd = {c: (k[c], w[c]) for c in k if k[c] != w[c] and {k[c], w[c]} != {"object", "datetime"}}
        return f"types {odd}" if odd else ""
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} rows differ, first: {bad[0] if bad else ''}"


def main() -> None:
    import __spark_entry__ as entry
    from tallycrest.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, shuffle_partitions=int(os.environ.get("PARTITIONS", "8")))
    con = database(folder)
    sql, bad = entry.oracle_sql(), 0
    names = sys.argv[2:] or list(entry.queries())
    for name in names:
        start = time.time()
        try:
            got = entry.queries()[name](spark, folder).toPandas()
            took = time.time() - start
            note = differences(got, con.execute(sql[name]).df()) if name in sql else "rows only"
        except Exception as error:  # report and go on
            got, took, note = [], time.time() - start, f"ERROR {type(error).__name__}: {str(error)[:600]}"
        bad += bool(note) and note != "rows only"
        print(f"{name:28s} {len(got):8d} rows {took:6.2f}s  {note or 'ok'}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
