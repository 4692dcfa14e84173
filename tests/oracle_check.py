"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usable from pytest (``compare_one``) and as a script::

    python tests/oracle_check.py [sf_dir] [name ...]

The comparison mirrors the driver's: column names sorted, row count, and an
order-insensitive comparison of the values (doubles rounded).
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.session import TABLES, table_path  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = table_path(sf_dir, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare_one(spark, con, name: str, fn, sql: str, sf_dir: str) -> tuple[bool, str]:
    sdf = fn(spark, sf_dir)
    left = sdf.toPandas()
    right = con.execute(sql).df()
    if sorted(left.columns) != sorted(right.columns):
        return False, f"columns differ: spark={sorted(left.columns)} sql={sorted(right.columns)}"
    if len(left) != len(right):
        return False, f"row count differs: spark={len(left)} sql={len(right)}"
    lt, rt = _rows(left), _rows(right)
    if lt != rt:
        bad = [(a, b) for a, b in zip(lt, rt) if a != b][:3]
        return False, f"values differ, e.g. {bad}"
    # type families
    sch = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    msgs = []
    for c in right.columns:
        st, dt = sch[c], str(right[c].dtype)
        fam_s = "f" if st in ("double", "float") else "i" if st in ("int", "bigint", "smallint", "tinyint") else "o"
        fam_d = "f" if dt.startswith("float") else "i" if dt.startswith(("int", "Int", "uint")) else "o"
        if fam_s != fam_d and not (fam_s == "i" and fam_d == "f" and right[c].isna().any()):
            msgs.append(f"{c}: spark {st} vs sql {dt}")
    return True, ("types: " + "; ".join(msgs)) if msgs else "ok"


def main(argv: list[str]) -> int:
    from tessera.plans import catalog
    from tessera.session import build_session

    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = catalog.queries(), catalog.oracle_sql()
    failed = 0
    for name in names or sorted(qs):
        t0 = time.time()
        if name not in sqls:
            n = qs[name](spark, sf_dir).count()
            print(f"{name:28s} rows-only  rows={n}  {time.time() - t0:.1f}s", flush=True)
            continue
        try:
            ok, msg = compare_one(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:300]}"
        failed += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} {msg}  {time.time() - t0:.1f}s", flush=True)
    print(f"failed={failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
