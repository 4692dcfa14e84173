"""Weighted 2-D sampling over the cell grid (inverse-CDF lookup as a range join).

The reference builds a cumulative distribution over the cell weights, draws
uniforms ``(u, v)`` and maps ``u`` to a cell by binary search; ``x`` is placed
inside the cell from the rest of ``u`` and ``y`` from ``v``.  Here:

* :func:`weight_cdf` -- a window over the (n*n-row) weight table;
* :func:`sample_cells` -- a bucketed equi-join of draws to CDF intervals,
  CDF broadcast (it has exactly n*n rows);
* :func:`weighted_sample_2d` -- the placement as column arithmetic;
* :func:`hash_uniforms` -- draws from a hash of (seed, keys): the same rows
  get the same draws whatever the partitioning or retries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.grid import Grid
from ..functions.scalar import unit_from_hash
from .curve import bucketed_range_join
from .histogram import MAX_BROADCAST_CELLS, cell_to_edges


def weight_cdf(weights: DataFrame, idx: str = "idx", w: str = "weight") -> DataFrame:
    """``(idx, weight, cdf_lo, cdf_hi)``: normalised cumulative weights in idx order.

    The last upper bound is forced to exactly 1.0.
    """
    run = Window.orderBy(idx).rowsBetween(Window.unboundedPreceding, 0)
    tot = Window.partitionBy()
    c = weights.select(idx, w, F.sum(w).over(run).alias("_cum"), F.sum(w).over(tot).alias("_tot"),
                       F.max(idx).over(tot).alias("_last"))
    hi = F.when(F.col(idx) == F.col("_last"), F.lit(1.0)).otherwise(
        F.col("_cum").cast("double") / F.col("_tot").cast("double"))
    c = c.withColumn("cdf_hi", hi)
    return c.select(idx, w, F.coalesce(F.lag("cdf_hi").over(Window.orderBy(idx)), F.lit(0.0))
                    .alias("cdf_lo"), "cdf_hi")


def sample_cells(draws: DataFrame, cdf: DataFrame, grid: Grid, u: str = "u",
                 buckets: int = 4096) -> DataFrame:
    """Each draw gets the cell k with ``cdf_lo[k] <= u < cdf_hi[k]``."""
    return bucketed_range_join(draws, u, cdf, "cdf_lo", "cdf_hi", 0.0, 1.0, buckets=buckets,
                               broadcast=grid.cells <= MAX_BROADCAST_CELLS)


def weighted_sample_2d(draws: DataFrame, cdf: DataFrame, grid: Grid, u: str = "u",
                       v: str = "v") -> DataFrame:
    """Place each draw inside its cell: x from the rest of u, y from v."""
    s = cell_to_edges(sample_cells(draws, cdf, grid, u), grid)
    frac = (F.col(u) - F.col("cdf_lo")) / (F.col("cdf_hi") - F.col("cdf_lo"))
    return s.withColumns({
        "x": F.col("xlo") + frac * (F.col("xhi") - F.col("xlo")),
        "y": F.col("ylo") + F.col(v) * (F.col("yhi") - F.col("ylo")),
    })


def hash_uniforms(df: DataFrame, *keys: str, seed: int = 0) -> DataFrame:
    """Add repeatable uniforms ``u``, ``v`` in [0, 1) from (seed, keys)."""
    return df.withColumns({"u": unit_from_hash(*keys, seed=2 * seed),
                           "v": unit_from_hash(*keys, seed=2 * seed + 1)})
