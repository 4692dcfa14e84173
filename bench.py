"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
``{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``

Every query is executed in full with the ``noop`` sink (all rows produced,
nothing collected to the driver).  Each query runs once to warm up the JVM
and then ``BENCH_REPEATS`` times; the best time is reported.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans import catalog  # noqa: E402
from tessera.session import build_session  # noqa: E402

HEADLINE = [
    "saturation",
    "report_saturated",
    "stateful_hist",
    "stop_when_exhausted",
    "hist2d_signed",
    "reconcile_parent_child",
    "diff_paths",
    "expand_children",
    "classify_by_curve",
    "sample_cells",
    "weighted_sample_2d",
    "clamped_running_sum",
    "mlp_score",
    "scan_struct_records",
    "scan_part_csv",
    "long_to_matrix",
]


def run_query(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def transfer_split(spark, sf_dir: str) -> dict:
    """The reference benchmark's columns: total / transfer / analysis per method.

    Timestep and Atom rows (from orders/lineitem) are prepared once; then per
    method the tables are written in that transport's format (transfer) and
    the consistency check ``Count`` runs on what Spark reads back (analysis).
    """
    from tessera.operators import records as R
    from tessera.plans.records import atom_view, timestep_view
    from tessera.session import scratch_path
    from tessera.sources import files as FS
    from tessera.sources import struct_records as SR

    base = scratch_path(spark, "bench_transfer")
    timestep_view(spark, sf_dir).write.parquet(base + "/ts")
    atom_view(spark, sf_dir).write.parquet(base + "/atom")
    ts, at = spark.read.parquet(base + "/ts"), spark.read.parquet(base + "/atom")
    nsteps, natoms = ts.count(), at.count()
    out = {}
    for method in ("binary", "csv"):
        path = scratch_path(spark, f"bench_{method}")
        t0 = time.perf_counter()
        if method == "binary":
            SR.write_struct(ts, path + "/ts", SR.TIMESTEP)
            SR.write_struct(at, path + "/atom", SR.ATOM)
        else:
            FS.write_part_csv(ts, path + "/ts")
            FS.write_part_csv(at, path + "/atom")
        t1 = time.perf_counter()
        if method == "binary":
            rts, rat = SR.scan_struct(spark, path + "/ts", SR.TIMESTEP), SR.scan_struct(spark, path + "/atom", SR.ATOM)
        else:
            rts = FS.read_part_csv(spark, path + "/ts", SR.spark_schema(SR.TIMESTEP))
            rat = FS.read_part_csv(spark, path + "/atom", SR.spark_schema(SR.ATOM))
        res = R.reconcile_parent_child(rts, rat, ["id", "rank"], ["timestep", "rank"]).first()
        t2 = time.perf_counter()
        assert res.n_mismatch == 0, res
        out[method] = {"nrows": nsteps, "natoms": natoms,
                       "bytes": nsteps * R.TIMESTEP_BYTES + natoms * R.ATOM_BYTES,
                       "total": round(t2 - t0, 3), "transfer": round(t1 - t0, 3),
                       "analysis": round(t2 - t1, 3)}
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = build_session(app_name="tessera-bench")
    qs = catalog.queries()
    names = [n for n in HEADLINE if n in qs]
    times: dict[str, float] = {}
    for name in names:
        run_query(spark, qs[name], sf_dir)  # warm-up
        times[name] = round(min(run_query(spark, qs[name], sf_dir) for _ in range(repeats)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    rows_in = {"saturation": events, "stateful_hist": events, "sample_cells": events,
               "scan_struct_records": orders}
    out = {
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "rows_per_sec": {k: round(n / times[k]) for k, n in rows_in.items()
                         if times.get(k, 0) > 0},
        "transfer_split": transfer_split(spark, sf_dir),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
