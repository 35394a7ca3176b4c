"""Run catalogue queries on Spark and their oracle SQL on DuckDB; compare
row counts, column names/types and an order-insensitive value hash."""

from __future__ import annotations

import hashlib
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from plait.plans import ORACLE, QUERIES  # noqa: E402
from plait.session import local_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def digest(rows):
    lines = sorted(json.dumps([norm(x) for x in r], default=str) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2].split(",") if len(sys.argv) > 2 else None
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    ok = 0
    for name, fn in QUERIES.items():
        if only and not any(name.startswith(o) for o in only):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            cols = df.columns
            rows = [tuple(r[c] for c in sorted(cols)) for r in df.collect()]
            types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        except Exception as exc:
            print(f"{name}: SPARK ERROR {type(exc).__name__}: {str(exc)[:400]}")
            continue
        ts = time.time() - t0
        sql = ORACLE.get(name)
        if sql is None:
            print(f"{name}: spark rows={len(rows)} (no oracle) {ts:.1f}s")
            continue
        try:
            rel = con.sql(sql)
            ocols = rel.columns
            otypes = dict(zip(ocols, [str(t) for t in rel.types]))
            orows = [tuple(r[ocols.index(c)] for c in sorted(ocols)) for r in rel.fetchall()]
        except Exception as exc:
            print(f"{name}: DUCKDB ERROR {exc}")
            continue
        same_cols = sorted(cols) == sorted(ocols)
        same = same_cols and len(rows) == len(orows) and digest(rows) == digest(orows)
        ok += same
        print(f"{name}: {'OK ' if same else 'MISMATCH'} rows={len(rows)}/{len(orows)} {ts:.1f}s"
              + ("" if same_cols else f" cols {sorted(cols)} vs {sorted(ocols)}")
              + ("" if same else f"\n   spark types {types}\n   duck types {otypes}"
                 f"\n   spark {sorted(rows, key=str)[:2]}\n   duck  {sorted(orows, key=str)[:2]}"))
    print(f"{ok} equal")


if __name__ == "__main__":
    main()
