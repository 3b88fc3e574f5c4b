"""Run every registered query and its SQL counterpart and compare the rows.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparktab.plans.oracles import ORACLES  # noqa: E402
from sparktab.plans.queries import QUERIES  # noqa: E402
from sparktab.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def key(v) -> tuple:
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, float(v))
    if isinstance(v, (int, float)) or hasattr(v, "as_tuple"):
        return (1, round(float(v), 4))
    return (2, str(v))


def close(a, b) -> bool:
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, str) or isinstance(b, str):
        return str(a) == str(b)
    if isinstance(a, (int, float)) and (isinstance(b, (int, float)) or hasattr(b, "as_tuple")):
        return math.isclose(float(a), float(b), rel_tol=1e-9, abs_tol=2e-6) or (math.isnan(float(a)) and math.isnan(float(b)))
    return a == b


def differences(name: str, spark, con, sf: str) -> tuple[int, str]:
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = [tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect()]
    if name not in ORACLES:
        return len(got), ""
    want = con.sql(ORACLES[name])
    if sorted(want.columns) != cols:
        return len(got), f"columns {cols} but SQL has {sorted(want.columns)}"
    spots = [want.columns.index(c) for c in cols]
    rows = [tuple(row[i] for i in spots) for row in want.fetchall()]
    if len(rows) != len(got):
        return len(got), f"{len(got)} rows but SQL has {len(rows)}"
    order = lambda row: tuple(key(v) for v in row)
    pairs = list(zip(sorted(got, key=order), sorted(rows, key=order)))
    bad = [(a, b) for a, b in pairs if not all(close(x, y) for x, y in zip(a, b))]
    if bad:
        return len(got), f"{len(bad)} rows differ, first {bad[0]} in {cols}"
    near = [(x, y) for a, b in pairs for x, y in zip(a, b) if isinstance(x, float) and y is not None and x != float(y)]
    return len(got), f"near: {len(near)} values differ in the last digit, first {near[0]}" if near else ""


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    names = list(ORACLES) if names == ["sql"] else names
    spark, con, failed = local_session(cores=8), connect(sf), 0
    for name in names:
        start = time.time()
        try:
            n, problem = differences(name, spark, con, sf)
        except Exception as e:  # noqa: BLE001
            n, problem = -1, f"{type(e).__name__}: {str(e)[:600]}"
        failed += bool(problem)
        mark = "FAIL" if problem else "ok" if name in ORACLES else "rows"
        print(f"{mark:5s}{name:30s}{n:8d} rows {time.time() - start:6.1f} s  {problem}", flush=True)
    print(f"{len(names)} queries, {failed} failed")


if __name__ == "__main__":
    main()
