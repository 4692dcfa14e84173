"""State carried over batches, in batch form (one query over the whole history).

When the points do not depend on the weights, the per-batch loop of the
reference (read state -> histogram + saturation -> write state) is one
relational query: the running state is a window over (batch, seq) per cell and
the per-batch numbers are a ``groupBy(batch, idx)``.  The streaming form in
:mod:`tessera.streaming.state` must give the same numbers batch by batch.

Weights (sampler side): every cell starts at ``initial``; a cell drops to
``saturated_weight`` from the first batch in which ``|sat| > threshold``; the
run stops at the first batch where the weight total is ``<= n*n``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.grid import Grid
from .histogram import DEFAULT_BLOCK_ROWS, saturation, zero_grid

# Fixed values from the reference sampler.
INITIAL_WEIGHT = 100
SATURATED_WEIGHT = 1
SATURATION_THRESHOLD = 3  # same as histogram.REPORT_THRESHOLD


def batch_history(points: DataFrame, grid: Grid, state: DataFrame | None = None,
                  block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Per (batch, idx) with points: ``n_points, dh, sat, h_after``.

    ``points`` needs ``batch, seq, idx, category``.  ``h_after`` is the cell
    state after the batch (initial state + all points up to that batch).
    """
    # h_after comes out of the same aggregation (state before the batch's last
    # point in the cell plus that point), so no second shuffle is needed
    return saturation(points, grid, state=state, order=("batch", "seq"), by=("batch",),
                      block_rows=block_rows)


def state_at_batch_start(points: DataFrame) -> DataFrame:
    """(batch, idx, h_start): state of each cell a batch's points read."""
    per = points.groupBy("batch", "idx").agg(F.sum("category").alias("dh"))
    w = Window.partitionBy("idx").orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)
    return per.select("batch", "idx",
                      F.coalesce(F.sum("dh").over(w), F.lit(0)).cast("bigint").alias("h_start"))


#: Copies of the state rows that points of one hot (batch, cell) are spread over.
STATE_SALTS = 16


def read_cell_state(points: DataFrame, state: DataFrame, salts: int = STATE_SALTS) -> DataFrame:
    """``points`` with ``h``: their cell's state at the start of their batch, 0 for a cell without one.

    ``state`` is (batch, idx, h_start).  One pair may hold a third of all
    points, so each state row is copied ``salts`` times and a point meets one
    of the copies, picked by its hash.  A null batch is a batch like any other.
    """
    copies = state.select(F.col("batch").alias("_b"), F.col("idx").alias("_i"), "h_start",
                          F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_s"))
    salted = points.withColumn("_salt", F.pmod(F.xxhash64(*points.columns), F.lit(salts)).cast("int"))
    same = F.col("batch").eqNullSafe(F.col("_b")) & (F.col("idx") == F.col("_i")) & (F.col("_salt") == F.col("_s"))
    return salted.join(copies, same, "left").select(
        *points.columns, F.coalesce("h_start", F.lit(0)).cast("bigint").alias("h"))


def reports(history: DataFrame, threshold: float = SATURATION_THRESHOLD) -> DataFrame:
    """Per batch, the reported cells ``(batch, idx, sat = |sat|)``, |sat| > threshold."""
    return (history.select("batch", "idx", F.abs("sat").alias("sat"))
            .where(F.col("sat") > threshold))


def overlay_weights(weights: DataFrame, reported: DataFrame,
                    saturated_weight: float = SATURATED_WEIGHT) -> DataFrame:
    """Upsert: reported cells get ``saturated_weight``, all others keep theirs."""
    rep = reported.select("idx").distinct().withColumn("_hit", F.lit(True))
    return weights.join(rep, "idx", "left").select(
        "idx", F.when(F.col("_hit"), F.lit(saturated_weight)).otherwise(F.col("weight"))
        .cast(weights.schema["weight"].dataType).alias("weight"))


def initial_weights(spark, grid: Grid, initial: int = INITIAL_WEIGHT) -> DataFrame:
    return zero_grid(spark, grid).select("idx", F.lit(initial).cast("int").alias("weight"))


def weight_totals(history: DataFrame, grid: Grid, initial: int = INITIAL_WEIGHT,
                  saturated_weight: int = SATURATED_WEIGHT,
                  threshold: float = SATURATION_THRESHOLD) -> DataFrame:
    """(batch, weight_total, exhausted) per batch, up to the stopping batch.

    ``weight_total`` is the sum of all n*n weights after the batch's report
    has been applied; ``exhausted`` = total <= n*n.  Rows after the first
    exhausted batch are not produced (the loop stops there).
    """
    # one pass over the history: a cell's rows are one per batch, and the row of its first report counts it
    first = F.min(F.when(F.abs("sat") > threshold, F.col("batch"))).over(Window.partitionBy("idx"))
    newly = (history.select("batch", first.alias("_first")).groupBy("batch")
             .agg(F.count(F.when(F.col("batch") == F.col("_first"), 1)).alias("_new")))
    # one row per batch: a global window over the (small) batch list
    w = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    tot = newly.select(
        "batch",
        (F.lit(initial * grid.cells) - F.lit(initial - saturated_weight)
         * F.sum("_new").over(w)
         ).cast("bigint").alias("weight_total"))
    tot = tot.withColumn("exhausted", (F.col("weight_total") <= grid.cells).cast("int"))
    w2 = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)
    return (tot.withColumn("_before", F.coalesce(F.max("exhausted").over(w2), F.lit(0)))
            .where(F.col("_before") == 0).drop("_before"))
