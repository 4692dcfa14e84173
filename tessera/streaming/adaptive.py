"""The adaptive histogram loop (T7): sample by weight, label, report, re-weight, stop.

One round:

1. CDF over the current cell weights (W3);
2. draw this round's points by weight (X2) -- one point per input row of the
   round, uniforms hashed from (seed, row key), so a retry draws the same;
3. label each point against the curve (J2);
4. write the round's Point table, replacing the last one (K1);
5. report the saturated cells against the carried state (T5) and write the
   new state;
6. reported cells get weight 1 (J6); stop when the weight total <= n*n (T6).

State and weights (one n*n cell table) are written to the shared scratch folder every round, so
each round's plan starts from files (no growing lineage) and a lost executor
only costs the current round.  Called again with the same ``workdir`` (after a
driver restart) the loop resumes after the last finished round.  Only the
weight total reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import Grid
from ..functions.scalar import label_sign
from ..operators import curve as C
from ..operators import histogram as H
from ..operators import sampling as SP
from ..operators import state as S


def _done(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def adaptive_hist(spark: SparkSession, rounds: DataFrame, segments: DataFrame, grid: Grid,
                  workdir: str, round_values: Sequence, key: str = "seq", round_col: str = "batch",
                  seed: int = 0, max_rounds: int | None = None,
                  keep_points: bool = True) -> DataFrame:
    """Run the loop over the given rounds; returns the final cells with their weights.

    With ``keep_points`` each round's labelled points are written as the
    ``Point`` table (replacing the previous round's, K1) and the analysis
    reads that table; without it the analysis reads the points straight from
    the draw (cheap to recompute: a hash and two broadcast joins).

    ``rounds`` holds one row per point to draw, keyed by ``key`` and grouped
    by ``round_col``; ``round_values`` is the ordered list of rounds (one
    entry per round, small).  Result: ``(xmin, xmax, ymin, ymax, weight,
    rounds_run, exhausted, n_drawn, n_outside, n_beside)`` for all n*n cells:
    the points of all rounds, those outside the grid, and those beside the
    curve (no label, so they add nothing to a cell).
    """
    # the curve is fixed for the whole run: materialise it once (one row per knot)
    if not _done(spark, f"{workdir}/segments"):
        segments.write.mode("overwrite").parquet(f"{workdir}/segments")
    seg = spark.read.parquet(f"{workdir}/segments")
    # broadcast the segment table only after checking its size
    seg_small = seg.count() <= C.MAX_BROADCAST_INTERVALS
    cells_path = f"{workdir}/cells"
    if not _done(spark, f"{cells_path}/r=0"):
        H.zero_grid(spark, grid).select(
            "idx", "h", F.lit(S.INITIAL_WEIGHT).cast("int").alias("weight")).write.mode(
            "overwrite").parquet(f"{cells_path}/r=0")
    total_limit = grid.cells
    run, exhausted = 0, False
    for r, rv in enumerate(round_values):
        if max_rounds is not None and r >= max_rounds:
            break
        if _done(spark, f"{cells_path}/r={r + 1}"):
            # finished before a restart: every round is a pure function of the
            # previous cell table and (seed, round, key), so it is not redone
            run = r + 1
            total = spark.read.parquet(f"{cells_path}/r={r + 1}").agg(F.sum("weight")).first()[0]
            if total <= total_limit:
                exhausted = True
                break
            continue
        cells = spark.read.parquet(f"{cells_path}/r={r}")
        cdf = SP.weight_cdf(cells.select("idx", "weight"))
        draws = SP.hash_uniforms(rounds.where(F.col(round_col) == rv).select(key), key, seed=seed + r)
        pts = SP.weighted_sample_2d(draws, cdf, grid).select(key, "x", "y")
        lab = C.bucketed_range_join(pts, "x", seg, "x_lo", "x_hi", grid.dmin, grid.dmax,
                                    closed_last="last", broadcast=seg_small)
        points = lab.select(key, "x", "y", label_sign(C.segment_value("x"), F.col("y"))
                            .alias("category"))
        if keep_points:
            points.write.mode("overwrite").parquet(f"{workdir}/Point")  # the round's table (K1)
            points = spark.read.parquet(f"{workdir}/Point")
        cells_of = H.assign_cells(points, grid).withColumn("beside", F.col("category").isNull())
        pt, seen = H.inside_counted(cells_of, grid, f"round{r + 1}", extra={"beside": F.col("beside")})
        # one pass: saturation and histogram of the round against the carried state (T5, A1),
        # then the weight overlay (J6) -- state and weights are written together
        sat = H.saturation(pt, grid, state=cells.select("idx", "h"), order=(key,))
        told = H.counted(seen, "beside")
        spark.createDataFrame([(told["points"], told["outside"] + told["null_bins"], told["beside"])],
                              "drawn long, outside long, beside long").coalesce(1).write.mode("overwrite").parquet(
            f"{workdir}/counts/r={r + 1}")
        hit = (F.abs(F.col("sat")) > S.SATURATION_THRESHOLD)
        new_cells = cells.join(F.broadcast(sat.select("idx", "dh", "sat")) if grid.cells <= H.MAX_BROADCAST_CELLS
                               else sat.select("idx", "dh", "sat"), "idx", "left").select(
            "idx", (F.col("h") + F.coalesce(F.col("dh"), F.lit(0))).cast("bigint").alias("h"),
            F.when(hit, F.lit(S.SATURATED_WEIGHT)).otherwise(F.col("weight")).cast("int").alias("weight"))
        # the weight total is observed while the table is written (no extra job)
        obs = Observation(f"weights_r{r + 1}")
        new_cells.observe(obs, F.sum("weight").alias("total")).write.mode("overwrite").parquet(
            f"{cells_path}/r={r + 1}")
        run = r + 1
        total = obs.get["total"]
        if total <= total_limit:  # T6
            exhausted = True
            break
    final = spark.read.parquet(f"{cells_path}/r={run}").select("idx", "weight")
    out = H.cell_to_edges(final, grid)
    drawn = outside = beside = 0
    if run:
        # counts are written before the round's cells, so every finished round has them
        drawn, outside, beside = spark.read.parquet(f"{workdir}/counts").where(F.col("r") <= run).agg(
            F.sum("drawn"), F.sum("outside"), F.sum("beside")).first()
    return out.select(F.col("xlo").alias("xmin"), F.col("xhi").alias("xmax"),
                      F.col("ylo").alias("ymin"), F.col("yhi").alias("ymax"),
                      F.col("weight").cast("double").alias("weight"),
                      F.lit(run).alias("rounds_run"), F.lit(exhausted).alias("exhausted"),
                      F.lit(drawn).alias("n_drawn"), F.lit(outside).alias("n_outside"), F.lit(beside).alias("n_beside"))
