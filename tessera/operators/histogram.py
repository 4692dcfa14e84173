"""Signed 2-D histogram with order-dependent saturation.

The reference walks the points of a batch one by one::

    sat[cell] += b + |h[cell]|     # h before this point
    h[cell]   += b

``h`` carries over between batches, ``sat`` restarts at 0 every batch.  Here
the walk becomes relational:

* ``h`` before a point is the cell's initial state plus a running sum of
  ``b`` over the cell's earlier points (a window);
* the saturation is a plain ``groupBy`` sum of ``b + |prev|``.

The running sum of each point (:func:`state_before_row`) is computed skew-safe
in two levels so that a hot cell (one cell may hold a third of all points)
never lands in a single task:

1. ``sum(b)`` per (cell, block), where a block is a range of the order key
   that holds about ``block_rows`` rows -- partial aggregation, no hot group;
2. running total of the block sums per cell, over the small block table;
3. running sum inside each (cell, block) -- about ``block_rows`` rows per
   window partition at most -- plus the block offset from step 2.

The saturation does not need each point's state, only ``sum |h0 + p|`` over the
points of a (cell, block) for the state ``h0`` that comes into the block, where
``p`` is the running sum inside it.  So a (cell, block) is summarised by how
often each ``p`` occurs (:func:`block_summaries`): one pass over the points, no
join back to them, and summaries of a cell are put together in block order
whatever ``h0`` turns out to be.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.grid import Grid, bin_assign, cell_index, in_domain, lower_edge, upper_edge, cell_row, cell_col
from ..session import scratch_path
from .reshape import row_blocks

DEFAULT_BLOCK_ROWS = 1 << 20
# Cell tables have exactly n*n rows; below this many cells we broadcast them.
MAX_BROADCAST_CELLS = 1 << 20


def _maybe_broadcast(df: DataFrame, grid: Grid) -> DataFrame:
    """Broadcast a per-cell table only when its size (n*n rows) is small."""
    return F.broadcast(df) if grid.cells <= MAX_BROADCAST_CELLS else df


# --------------------------------------------------------------------------
# Generators
# --------------------------------------------------------------------------

def zero_grid(spark: SparkSession, grid: Grid) -> DataFrame:
    """The n x n zero state as a long cell table ``(idx, i, j, h)``."""
    n = grid.n
    return spark.range(grid.cells).select(
        (F.col("id") + 1).cast("int").alias("idx"),
        (F.floor(F.col("id") / n) + 1).cast("int").alias("i"),
        (F.pmod(F.col("id"), F.lit(n)) + 1).cast("int").alias("j"),
        F.lit(0).cast("bigint").alias("h"),
    )


def zeros_like(cells: DataFrame, grid: Grid, i: str = "i", j: str = "j") -> DataFrame:
    """The zero state over the cells of an existing (i, j) table: ``(idx, i, j, h = 0)``."""
    return cells.select(cell_index(F.col(i), F.col(j), grid).alias("idx"),
                        F.col(i).cast("int").alias("i"), F.col(j).cast("int").alias("j"),
                        F.lit(0).cast("bigint").alias("h"))


def cell_edges(spark: SparkSession, grid: Grid) -> DataFrame:
    """Every cell with its edges ``(idx, i, j, xlo, xhi, ylo, yhi)``."""
    z = zero_grid(spark, grid)
    return z.select(
        "idx", "i", "j",
        lower_edge("i", grid).alias("xlo"), upper_edge("i", grid).alias("xhi"),
        lower_edge("j", grid).alias("ylo"), upper_edge("j", grid).alias("yhi"),
    )


def cell_to_edges(df: DataFrame, grid: Grid, idx: str = "idx") -> DataFrame:
    """Add the cell's row/column and edges to rows carrying a cell number."""
    i, j = cell_row(idx, grid), cell_col(idx, grid)
    return df.withColumns({
        "i": i, "j": j,
        "xlo": lower_edge(i, grid), "xhi": upper_edge(i, grid),
        "ylo": lower_edge(j, grid), "yhi": upper_edge(j, grid),
    })


# --------------------------------------------------------------------------
# Binning (P4 - P6)
# --------------------------------------------------------------------------

def assign_cells(points: DataFrame, grid: Grid, x: str = "x", y: str = "y") -> DataFrame:
    """Add 1-based bins ``gx, gy`` and the cell number ``idx``."""
    return points.withColumns({"gx": bin_assign(x, grid), "gy": bin_assign(y, grid)}).withColumn(
        "idx", cell_index("gx", "gy", grid))


def _inside(grid: Grid) -> Column:
    return F.coalesce(in_domain("gx", "gy", grid), F.lit(False))


def split_domain(cells: DataFrame, grid: Grid) -> tuple[DataFrame, DataFrame]:
    """(points inside the grid, rejected points: those outside and those with a null bin)."""
    return cells.where(_inside(grid)), cells.where(~_inside(grid))


def inside_counted(cells: DataFrame, grid: Grid, name: str = "rejects",
                   extra: dict[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """(points inside the grid, what was left out), counted in the same pass.

    The observation holds ``points``, ``outside`` (both bins known, one not in
    1..n) and ``null_bins`` once an action has run over the points; before
    that, reading it waits.  ``extra`` conditions are counted over all points,
    too.  :func:`no_rejects` turns rejects into an error.
    """
    seen = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    null = F.col("gx").isNull() | F.col("gy").isNull()
    told = cells.observe(seen, F.count(F.lit(1)).alias("points"),
                         F.count(F.when(~_inside(grid) & ~null, 1)).alias("outside"),
                         F.count(F.when(null, 1)).alias("null_bins"),
                         *[F.count(F.when(c, 1)).alias(n) for n, c in (extra or {}).items()])
    return told.where(_inside(grid)), seen


def counted(seen: Observation, *extra: str) -> dict[str, int]:
    """The observed counts; zeros where the optimizer saw that there are no points and observed nothing."""
    try:
        told = seen.get
    except Py4JJavaError:  # Spark hands back a row without columns then, which Python cannot read
        told = {}
    return {k: 0 for k in ("points", "outside", "null_bins", *extra)} | told


class PointsOutside(ValueError):
    """Points fell outside the grid, which the reference's analysis does not allow."""


def no_rejects(seen: Observation) -> None:
    """Raise if the observed pass left out a point."""
    told = counted(seen)
    if told["outside"] or told["null_bins"]:
        raise PointsOutside(f"{told['outside']} points outside the grid and {told['null_bins']} without a bin, "
                            f"of {told['points']}")


# --------------------------------------------------------------------------
# A1: signed histogram on top of an old state
# --------------------------------------------------------------------------

def hist2d_signed(points: DataFrame, grid: Grid, state: DataFrame | None = None,
                  b: str = "category") -> DataFrame:
    """Dense state after adding ``b`` per cell: ``(idx, h)`` for all n*n cells.

    ``points`` must carry ``idx`` (see :func:`assign_cells`).  The per-cell
    sum is a partial + final aggregation; the result is joined to the (n*n)
    state table.
    """
    spark = points.sparkSession
    base = (state if state is not None else zero_grid(spark, grid)).select("idx", "h")
    dh = points.groupBy("idx").agg(F.sum(b).alias("dh"))
    return base.join(_maybe_broadcast(dh, grid), "idx", "left").select(
        "idx", (F.col("h") + F.coalesce(F.col("dh"), F.lit(0))).alias("h"))


# --------------------------------------------------------------------------
# State before each point (two-level running sum)
# --------------------------------------------------------------------------

def state_before_row(points: DataFrame, grid: Grid, state: DataFrame | None = None,
                     order: Sequence[str] = ("seq",), b: str = "category",
                     block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Add ``prev``: the cell state just before each point.

    ``order`` is a list of columns whose combination is unique and gives the
    processing order (nulls first); the last one must be numeric.  Blocks are
    ranges of it that hold about ``block_rows`` rows each, however its values
    are spread.
    """
    order = list(order)
    blk_cols = order[:-1] + ["_blk"]
    pts = row_blocks(points, order[-1], block_rows, "_blk")

    # level 1: one row per (cell, block)
    blocks = pts.groupBy("idx", *blk_cols).agg(F.sum(b).alias("_bs"))
    # level 2: exclusive running total of block sums per cell, plus the initial state
    w_blk = Window.partitionBy("idx").orderBy(*blk_cols).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("_off", F.coalesce(F.sum("_bs").over(w_blk), F.lit(0)))
    if state is not None:
        st = _maybe_broadcast(state.select("idx", F.col("h").alias("_h0")), grid)
        offsets = offsets.join(st, "idx", "left").withColumn(
            "_off", F.col("_off") + F.coalesce(F.col("_h0"), F.lit(0)))
    keys = ["idx", *blk_cols]
    offsets = offsets.select(*[F.col(c).alias(f"_o_{c}") for c in keys], "_off")

    # level 3: running sum inside (cell, block) -- bounded window partitions
    w_in = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    same = F.lit(True)
    for c in keys:  # a null order column is an order value like any other
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    out = pts.join(offsets, same, "inner").withColumn(
        "prev", F.col("_off") + F.coalesce(F.sum(b).over(w_in), F.lit(0)))
    return out.drop("_blk", "_off", *[f"_o_{c}" for c in keys])


# --------------------------------------------------------------------------
# A2: saturation
# --------------------------------------------------------------------------

def block_summaries(points: DataFrame, order: Sequence[str] = ("seq",), by: Sequence[str] = (), b: str = "category",
                    block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """How often each inner running sum occurs: ``(idx, *blk, *by, p, n, n_b, sb, last)``.

    ``p`` is the sum of ``b`` over the cell's earlier points of the same
    block, ``n`` the points that see it (``n_b`` of them with a ``b``), ``sb``
    their sum of ``b``; ``last`` is the group's last ``(order, p + b)``.  With
    b = 1 or -1 there are few distinct ``p`` in a block next to its points.
    One shuffle of the points by (cell, block); the grouping needs none.
    """
    order, by = list(order), list(by)
    blk_cols = order[:-1] + ["_blk"]
    pts = row_blocks(points, order[-1], block_rows, "_blk").select(
        "idx", *dict.fromkeys([*blk_cols, *order, *by]), F.col(b).alias("_b"))
    w_in = Window.partitionBy("idx", *blk_cols).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    pts = pts.withColumn("p", F.coalesce(F.sum("_b").over(w_in), F.lit(0)))
    rest = [c for c in order if c not in by] or order
    after = (F.col("p") + F.coalesce(F.col("_b"), F.lit(0))).alias("after")
    return pts.groupBy("idx", *dict.fromkeys([*blk_cols, *by]), "p").agg(
        F.count(F.lit(1)).alias("n"), F.count("_b").alias("n_b"), F.coalesce(F.sum("_b"), F.lit(0)).alias("sb"),
        F.max(F.struct(*rest, after)).alias("last"))


def saturation(points: DataFrame, grid: Grid, state: DataFrame | None = None,
               order: Sequence[str] = ("seq",), by: Sequence[str] = (),
               b: str = "category", block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``(*by, idx, n_points, dh, sat, h_after)`` for every cell that has points.

    ``sat = sum(b + |prev|)`` over the cell's points in ``order``, where
    ``prev`` is the cell's state before the point; ``h_after`` is the state
    after the cell's last point of the group.  With ``by=("batch",)`` and
    ``order=("batch", "seq")`` the state carries over between batches while the
    saturation restarts per batch.  A null ``b`` counts as a point and adds
    nothing.

    The summaries are written once: the offsets and the totals both read
    them, so the points are read once after their blocks are cut.
    """
    spark = points.sparkSession
    by = list(by)
    blk_cols = list(order[:-1]) + ["_blk"]
    keys = ["idx", *blk_cols]
    made = block_summaries(points, order, by, b, block_rows)
    path = scratch_path(spark, "block-summaries")
    made.write.parquet(path)
    parts = spark.read.schema(made.schema).parquet(path)
    # one row per (cell, block): the state that comes in
    w_blk = Window.partitionBy("idx").orderBy(*blk_cols).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy(*keys).agg(F.sum("sb").alias("_bs")).withColumn(
        "_off", F.coalesce(F.sum("_bs").over(w_blk), F.lit(0)))
    if state is not None:
        st = _maybe_broadcast(state.select("idx", F.col("h").alias("_h0")), grid)
        offsets = offsets.join(st, "idx", "left").withColumn(
            "_off", F.col("_off") + F.coalesce(F.col("_h0"), F.lit(0)))
    offsets = offsets.select(*[F.col(c).alias(f"_o_{c}") for c in keys], "_off")
    same = F.lit(True)
    for c in keys:  # a null order column is an order value like any other
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    placed = parts.join(offsets, same)
    rest = [c for c in order if c not in by] or list(order)
    last = F.struct(*[F.col(f"last.{c}") for c in rest],
                    (F.col("_off") + F.col("last.after")).alias("after"))
    return placed.groupBy(*by, "idx").agg(
        F.sum("n").cast("bigint").alias("n_points"),
        F.sum("sb").cast("bigint").alias("dh"),
        F.sum(F.col("sb") + F.col("n_b") * F.abs(F.col("_off") + F.col("p"))).alias("sat"),
        F.max(last)["after"].cast("bigint").alias("h_after"),
    )


def hist_table(sat: DataFrame, grid: Grid) -> DataFrame:
    """The dense analysis matrix ``Hist``: ``(idx, c1, c2, c3)``.

    ``c1``/``c2`` are the lower x/y edges, ``c3`` the saturation (0 for
    cells without points).
    """
    edges = cell_edges(sat.sparkSession, grid).select("idx", F.col("xlo").alias("c1"),
                                                       F.col("ylo").alias("c2"))
    s = _maybe_broadcast(sat.select("idx", "sat"), grid)
    return edges.join(s, "idx", "left").select(
        "idx", "c1", "c2", F.coalesce(F.col("sat"), F.lit(0)).cast("bigint").alias("c3"))


# Fixed value: cells are reported when |saturation| is strictly above this.
REPORT_THRESHOLD = 3


def report_saturated(hist: DataFrame, threshold: float = REPORT_THRESHOLD,
                     sat_col: str = "c3") -> DataFrame:
    """``(idx, sat)`` of the cells whose absolute saturation is above the threshold, the largest first, ties by cell."""
    return (hist.select("idx", F.abs(F.col(sat_col)).alias("sat"))
            .where(F.col("sat") > threshold)
            .orderBy(F.desc("sat"), "idx"))
