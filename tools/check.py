"""Compare registered queries with their SQL in DuckDB: ``python tools/check.py [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]

    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "~"
        if hasattr(v, "item") and not isinstance(v, pd.Timestamp):
            v = v.item() if getattr(v, "ndim", 0) == 0 else v.tolist()
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)):
            return f"{float(v):.9g}"
        if isinstance(v, (list, tuple)):
            return str([cell(x) for x in v])
        if hasattr(v, "isoformat"):
            return pd.Timestamp(v).isoformat()
        return str(v)

    return sorted(tuple(cell(v) for v in row) for row in df.itertuples(index=False, name=None))


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} vs {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}"
    bad = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ; columns {sorted(got.columns)}; first\n   {bad[0][0]}\n   {bad[0][1]}"
    return ""


def main() -> int:
    from respira.catalog import load
    from respira.session import build_session

    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("sf") else "sf0.01"
    names = [a for a in args if not a.startswith("sf")]
    sf_dir = f"/root/testdata/{sf}"
    spark = build_session(
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(sf_dir), 0
    for name, (fn, sql) in load().items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        t0 = time.time()
        try:
            got = fn(spark, sf_dir).toPandas()
            dt = time.time() - t0
            if sql is None:
                print(f"rows  {name}: {len(got)} rows {dt:.2f}s", flush=True)
                continue
            msg = compare(got, con.execute(sql).df())
        except Exception as e:  # noqa: BLE001
            dt, msg = time.time() - t0, f"{type(e).__name__}: {str(e)[:1500]}"
        failed += bool(msg)
        print(f"{'FAIL ' if msg else 'ok   '} {name}: {len(got) if not msg else ''} rows {dt:.2f}s (sql {time.time()-t0-dt:.2f}s) {msg}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
