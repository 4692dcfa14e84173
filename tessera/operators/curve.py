"""Piecewise curves, range joins on segments, and the clamped running sum.

* :func:`segments` -- consecutive knots -> linear segments (``lead`` window on
  the small knot table).
* :func:`bucketed_range_join` -- each row finds the interval ``[lo, hi)``
  containing its value.  A plain range predicate plans as a nested-loop join;
  here every interval is exploded into the fixed-width buckets it covers and
  the join is an equi-join on the bucket with a residual range check.
* :func:`clamped_running_sum` -- ``v_i = clamp(v_{i-1} + d_i)`` per key,
  computed in three levels so no key's series has to sit in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.scalar import CLAMP_HI, CLAMP_LO
from ..session import scratch_path
from .reshape import DEFAULT_BLOCK_ROWS, row_blocks, row_index

DEFAULT_BUCKETS = 1024
MAX_BROADCAST_INTERVALS = 1 << 20


# ---------------------------------------------------------------- segments

def segments(knots: DataFrame, x: str = "kx", y: str = "ky", by: Sequence[str] = ()) -> DataFrame:
    """``(seg, x_lo, x_hi, y_lo, y_hi, slope, last)`` from knots ordered by x.

    ``last`` marks the final segment, whose upper end is closed.
    """
    w = Window.partitionBy(*by).orderBy(x) if by else Window.orderBy(x)
    s = knots.select(*by, F.col(x).alias("x_lo"), F.col(y).alias("y_lo"),
                     F.lead(x).over(w).alias("x_hi"), F.lead(y).over(w).alias("y_hi"),
                     (F.row_number().over(w) - 1).cast("int").alias("seg"))
    s = s.where(F.col("x_hi").isNotNull())
    w2 = Window.partitionBy(*by) if by else Window.partitionBy()
    return s.select(*by, "seg", "x_lo", "x_hi", "y_lo", "y_hi",
                    F.when(F.col("x_hi") > F.col("x_lo"),
                           (F.col("y_hi") - F.col("y_lo")) / (F.col("x_hi") - F.col("x_lo")))
                    .otherwise(0.0).alias("slope"),  # knots that share an x leave no width
                    (F.col("seg") == F.max("seg").over(w2)).alias("last"))


def segment_value(x="x") -> F.Column:
    """Linear interpolation on the joined segment."""
    xc = F.col(x) if isinstance(x, str) else x
    return F.col("y_lo") + F.col("slope") * (xc - F.col("x_lo"))


def cubic_segments(knots: DataFrame, x: str = "kx", y: str = "ky", by: Sequence[str] = ()) -> DataFrame:
    """Cubic Hermite segments through the knots: ``(seg, x_lo, x_hi, c0, c1, c2, c3, last)``.

    A smooth (C1) stand-in for the reference's order-4 B-spline, built only
    with window functions: the tangent at a knot is the slope between its two
    neighbours (one-sided at the ends), and on ``[x_lo, x_hi]`` with
    ``t = x - x_lo`` the curve is ``c0 + c1 t + c2 t^2 + c3 t^3``.  Evaluate
    with :func:`poly_value`.
    """
    w = Window.partitionBy(*by).orderBy(x) if by else Window.orderBy(x)
    k = knots.select(*by, F.col(x).alias("_x"), F.col(y).alias("_y"),
                     F.lag(x).over(w).alias("_xp"), F.lag(y).over(w).alias("_yp"),
                     F.lead(x).over(w).alias("_xn"), F.lead(y).over(w).alias("_yn"))
    tangent = (F.coalesce(F.col("_yn"), F.col("_y")) - F.coalesce(F.col("_yp"), F.col("_y"))) / (
        F.coalesce(F.col("_xn"), F.col("_x")) - F.coalesce(F.col("_xp"), F.col("_x")))
    k = k.withColumn("_m", tangent)
    wk = Window.partitionBy(*by).orderBy("_x") if by else Window.orderBy("_x")
    s = k.select(*by, F.col("_x").alias("x_lo"), F.col("_y").alias("y_lo"), F.col("_m").alias("m_lo"),
                 F.lead("_x").over(wk).alias("x_hi"), F.lead("_y").over(wk).alias("y_hi"),
                 F.lead("_m").over(wk).alias("m_hi"),
                 (F.row_number().over(wk) - 1).cast("int").alias("seg"))
    s = s.where(F.col("x_hi").isNotNull())
    h = F.col("x_hi") - F.col("x_lo")
    d = (F.col("y_hi") - F.col("y_lo")) / h
    w2 = Window.partitionBy(*by) if by else Window.partitionBy()
    return s.select(*by, "seg", "x_lo", "x_hi", F.col("y_lo").alias("c0"), F.col("m_lo").alias("c1"),
                    ((F.lit(3.0) * d - F.lit(2.0) * F.col("m_lo") - F.col("m_hi")) / h).alias("c2"),
                    ((F.col("m_lo") + F.col("m_hi") - F.lit(2.0) * d) / (h * h)).alias("c3"),
                    (F.col("seg") == F.max("seg").over(w2)).alias("last"))


def poly_value(x="x") -> F.Column:
    """Evaluate the joined cubic segment at x (Horner form)."""
    xc = F.col(x) if isinstance(x, str) else x
    t = xc - F.col("x_lo")
    return F.col("c0") + t * (F.col("c1") + t * (F.col("c2") + t * F.col("c3")))


# ---------------------------------------------------------------- smooth curve (J2): interpolating cubic spline
#
# The order-4 spline through all knots whose third derivative does not jump at
# the second and the last but one knot.  Its slopes m solve a tridiagonal
# system  a_i m_{i-1} + b_i m_i + c_i m_{i+1} = d_i.  Elimination writes
# m_i = D_i - G_i m_{i+1}, where the step from (G, D) of row i-1 to row i is
#   G_i = c_i / (b_i - a_i G),  D_i = (d_i - a_i D) / (b_i - a_i G):
# a projective map.  Such maps compose, so elimination is a prefix composition,
# and so is the substitution back, m_i = D_i - G_i m_{i+1}, from the last knot.

_PROJECTIVE = ("_p", "_q", "_r", "_m", "_t", "_u", "_w")
_AFFINE = ("_al", "_be")


def _compose_projective(p1, q1, r1, m1, t1, u1, w1, p2, q2, r2, m2, t2, u2, w2):
    """(G, D) -> ((p G + q), (r G + m D + t)) / (u G + w), first 1, then 2; scaled so that numbers stay near 1."""
    new = (p2 * p1 + q2 * u1, p2 * q1 + q2 * w1, r2 * p1 + m2 * r1 + t2 * u1, m2 * m1, r2 * q1 + m2 * t1 + t2 * w1,
           u2 * p1 + w2 * u1, u2 * q1 + w2 * w1)
    scale = np.maximum(np.abs(new[5]), np.abs(new[6]))
    return tuple(v / scale for v in new)


def _compose_affine(a1, b1, a2, b2):
    """v -> a + b v, first 1, then 2."""
    return a2 + b2 * a1, b2 * b1


def _two_level(df: DataFrame, order, block: str, block_order, cols: Sequence[str], compose, value) -> DataFrame:
    """Prefix maps inside blocks, then the value that comes into each block: ``df`` with prefix ``cols`` and ``_in``.

    ``value(incoming)`` applies a block's composed map to a struct or number
    column; before the first block ``_in`` is null.
    """
    rows = _prefix_maps(df, [block], order, cols, compose)
    whole = rows.groupBy(block).agg(F.max(F.struct("_rn", *cols)).alias("t")).select(block, *[f"t.{c}" for c in cols])
    # one row per block
    upto = _prefix_maps(whole.withColumn("_one", F.lit(0)), ["_one"], block_order, cols, compose)
    before = upto.select(F.col(block).alias("_ob"), F.lag(value(None)).over(
        Window.partitionBy("_one").orderBy(block_order)).alias("_in"))
    return rows.drop("_rn").join(before, F.col(block) == F.col("_ob")).drop("_ob")


def spline_segments(knots: DataFrame, x: str = "kx", y: str = "ky", block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Segments ``(seg, x_lo, x_hi, c0, c1, c2, c3, last)`` of the cubic spline through the knots.

    Two knots give a line, three a parabola, one or none no segment.  Knots
    that share an x count as one at their mean y; knots with a null are left
    out.  Knots are numbered in blocks, meet their neighbours by number, and
    the system is solved in blocks, so no task holds all knots.
    """
    k = (knots.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(x).cast("double").alias("_x"))
         .agg(F.avg(y).alias("_y")))
    path = scratch_path(knots.sparkSession, "knots")
    row_index(k, key="_x", name="_i", start=0, block_rows=block_rows).write.parquet(path)
    k = knots.sparkSession.read.parquet(path)
    n = k.count()
    # every knot goes to the rows it has a part in: two before and two after
    near = k.select(F.explode(F.array(*(F.col("_i") + d for d in (-2, -1, 0, 1, 2)))).alias("_row"),
                    "_i", "_x", "_y").where((F.col("_row") >= 0) & (F.col("_row") < n))
    at = lambda d, c: F.max(F.when(F.col("_i") == F.col("_row") + d, F.col(c)))
    row = near.groupBy("_row").agg(*[at(d, c).alias(f"{c}{d + 2}") for d in (-2, -1, 0, 1, 2) for c in ("_x", "_y")])
    h = {d: F.col(f"_x{d + 3}") - F.col(f"_x{d + 2}") for d in (-2, -1, 0, 1)}  # h[d]: from knot d to knot d + 1
    g = {d: (F.col(f"_y{d + 3}") - F.col(f"_y{d + 2}")) / h[d] for d in h}
    i, first, last = F.col("_row"), F.col("_row") == 0, F.col("_row") == n - 1
    if n >= 4:
        a = F.when(first, 0.0).when(last, h[-2] + h[-1]).otherwise(h[0])
        b = F.when(first, h[1]).when(last, h[-2]).otherwise(2 * (h[-1] + h[0]))
        c = F.when(first, h[0] + h[1]).when(last, 0.0).otherwise(h[-1])
        d = (F.when(first, ((h[0] + 2 * (h[0] + h[1])) * h[1] * g[0] + h[0] * h[0] * g[1]) / (h[0] + h[1]))
             .when(last, (h[-1] * h[-1] * g[-2] + (2 * (h[-2] + h[-1]) + h[-1]) * h[-2] * g[-1]) / (h[-2] + h[-1]))
             .otherwise(3 * (h[0] * g[-1] + h[-1] * g[0])))
    elif n == 3:  # both end rows say the same there: a parabola, whose slope in the middle is known
        middle = (h[0] * g[-1] + h[-1] * g[0]) / (h[-1] + h[0])
        a = F.when(last, 1.0).otherwise(0.0)
        b, c = F.lit(1.0), F.when(first, 1.0).otherwise(0.0)
        d = F.when(first, 2 * g[0]).when(last, 2 * g[-1]).otherwise(middle)
    else:
        a, b, c = F.lit(0.0), F.lit(1.0), F.lit(0.0)
        d = F.when(first, g[0]).otherwise(g[-1])
    zero = F.lit(0.0)
    system = row.withColumn("_blk", F.floor(i / block_rows)).withColumns({"_ca": a, "_cb": b, "_cc": c, "_cd": d}).select(
        "_row", "_blk", F.col("_x2").alias("_x"), F.col("_y2").alias("_y"),
        zero.alias("_p"), F.col("_cc").cast("double").alias("_q"), zero.alias("_r"),
        (-F.col("_ca")).cast("double").alias("_m"), F.col("_cd").cast("double").alias("_t"),
        (-F.col("_ca")).cast("double").alias("_u"), F.col("_cb").cast("double").alias("_w"))

    def eliminated(incoming):
        G, D = (zero, zero) if incoming is None else (F.coalesce(incoming["G"], zero), F.coalesce(incoming["D"], zero))
        under = F.col("_u") * G + F.col("_w")
        return F.struct(((F.col("_p") * G + F.col("_q")) / under).alias("G"),
                        ((F.col("_r") * G + F.col("_m") * D + F.col("_t")) / under).alias("D"))

    down = _two_level(system, "_row", "_blk", "_blk", _PROJECTIVE, _compose_projective, eliminated)
    back = down.withColumn("_gd", eliminated(F.col("_in"))).select(
        "_row", "_blk", "_x", "_y", F.col("_gd.D").alias("_al"), (-F.col("_gd.G")).alias("_be"))

    def substituted(incoming):
        return F.col("_al") + F.col("_be") * (zero if incoming is None else F.coalesce(incoming, zero))

    up = _two_level(back, F.desc("_row"), "_blk", F.desc("_blk"), _AFFINE, _compose_affine, substituted)
    slopes = up.select("_row", "_x", "_y", substituted(F.col("_in")).alias("_s"))
    nxt = slopes.select((F.col("_row") - 1).alias("_row"), F.col("_x").alias("x_hi"), F.col("_y").alias("_y1"),
                        F.col("_s").alias("_s1"))
    width = F.col("x_hi") - F.col("_x")
    rise = (F.col("_y1") - F.col("_y")) / width
    return slopes.join(nxt, "_row").select(
        F.col("_row").cast("int").alias("seg"), F.col("_x").alias("x_lo"), "x_hi", F.col("_y").alias("c0"),
        F.col("_s").alias("c1"), ((3 * rise - 2 * F.col("_s") - F.col("_s1")) / width).alias("c2"),
        ((F.col("_s") + F.col("_s1") - 2 * rise) / (width * width)).alias("c3"), (F.col("_row") == n - 2).alias("last"))


# ---------------------------------------------------------------- range join

def bucketed_range_join(rows: DataFrame, value: str, intervals: DataFrame, lo: str, hi: str,
                        dmin: float, dmax: float, buckets: int = DEFAULT_BUCKETS,
                        closed_last: str | None = None, broadcast: bool | None = None,
                        how: str = "left") -> DataFrame:
    """Join each row to the interval with ``lo <= value < hi``.

    A row outside all intervals stays, with nulls for the interval's columns
    (``how="inner"`` leaves it out).

    ``closed_last`` names a boolean column of ``intervals`` marking intervals
    whose upper end is closed (``value <= hi``).  Intervals are exploded into
    the buckets of width ``(dmax - dmin) / buckets`` they overlap, so a row
    meets only the few intervals of its own bucket.  With ``broadcast=None``
    the exploded intervals are written to the scratch folder first: they are
    computed once, and the planner broadcasts them if their real size is below
    the session's threshold and shuffles both sides on the bucket otherwise.
    ``broadcast=True`` is for a table whose size the caller has checked.
    """
    width = (dmax - dmin) / buckets

    def bucket_of(c):
        return F.least(F.greatest(F.floor((c - F.lit(dmin)) / F.lit(width)), F.lit(0)),
                       F.lit(buckets - 1)).cast("int")

    iv = intervals.withColumn("_ib", F.explode(F.sequence(bucket_of(F.col(lo)), bucket_of(F.col(hi)))))
    if broadcast is None:
        path = scratch_path(iv.sparkSession, "intervals")
        iv.write.parquet(path)
        iv = iv.sparkSession.read.schema(iv.schema).parquet(path)
    if broadcast:
        iv = F.broadcast(iv)
    r = rows.withColumn("_b", bucket_of(F.col(value)))
    upper = F.col(value) < F.col(hi)
    if closed_last:
        upper = upper | (F.col(closed_last) & (F.col(value) == F.col(hi)))
    within = (F.col("_b") == F.col("_ib")) & (F.col(value) >= F.col(lo)) & upper
    return r.join(iv, within, how).drop("_b", "_ib")


# ---------------------------------------------------------------- clamped running sum
#
# A step  v -> clamp(v + a, lo, hi)  is stored as (a, lo, hi).  Steps compose
# inside the same family:  g(f(v)) = clamp(v + a_f + a_g, L, H)  with
#   L = min(h_g, max(l_g, l_f + a_g)),  H = max(l_g, min(h_g, h_f + a_g)).
# So the steps up to a row of a block are one triple, a block's last triple
# stands for the block, blocks compose the same way, and a row's value is its
# triple applied to the value before its block.

_TRIPLE = ("_a", "_l", "_h")


def _compose(a1, l1, h1, a2, l2, h2):
    """Apply (a1, l1, h1) first, then (a2, l2, h2); numpy-vectorised."""
    return a1 + a2, np.minimum(h2, np.maximum(l2, l1 + a2)), np.maximum(l2, np.minimum(h2, h1 + a2))


def _segmented_scan(seg, a, lo, hi):
    """Prefix compositions of clamped steps within each run of equal ``seg``."""
    return _scan(seg, (a, lo, hi), _compose)


def _scan(seg, maps, compose):
    """Prefix compositions within each run of equal ``seg`` (rows sorted by segment, order).

    Hillis-Steele doubling: O(n log n) vectorised numpy steps, no Python loop
    over rows; an element only composes with earlier elements of its own segment.
    """
    maps = [c.copy() for c in maps]
    n = len(seg)
    k = 1
    while k < n:
        same = seg[k:] == seg[:-k]
        if not same.any():
            break  # no run is longer than k
        new = compose(*(c[:-k] for c in maps), *(c[k:] for c in maps))
        for c, v in zip(maps, new):
            c[k:] = np.where(same, v, c[k:])
        k <<= 1
    return maps


def _prefix_maps(df: DataFrame, runs: Sequence[str], order, cols: Sequence[str], compose) -> DataFrame:
    """``df`` with the maps in ``cols`` replaced by the composition of its run's maps up to the row.

    ``compose(*first, *second)`` gives the numbers of "first, then second" and
    works on numpy arrays; it must be associative.

    The window deals and sorts the rows (null keys are a run like any other)
    and numbers them, so a run starts at number 1; the tasks stream Arrow
    batches and carry one map from batch to batch, whatever a run's length.
    """
    schema = StructType([*df.schema.fields, StructField("_rn", IntegerType(), False)])
    at = [df.columns.index(c) for c in cols]

    def scan(batches):
        carry = None
        for b in batches:
            if b.num_rows == 0:
                continue
            first = b.column(b.num_columns - 1).to_numpy() == 1
            t = [b.column(k).to_numpy(zero_copy_only=False).copy() for k in at]
            if not first[0] and carry is not None:
                for k, v in enumerate(compose(*carry, *(c[0] for c in t))):
                    t[k][0] = v
            t = _scan(np.cumsum(first), t, compose)
            carry = tuple(c[-1] for c in t)
            cols = list(b.columns)
            for k, c in zip(at, t):
                cols[k] = pa.array(c)
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    number = F.row_number().over(Window.partitionBy(*runs).orderBy(order))
    return df.withColumn("_rn", number).mapInArrow(scan, schema)


def clamped_running_sum(df: DataFrame, key: Sequence[str], order: str, step: str,
                        lo: float = CLAMP_LO, hi: float = CLAMP_HI, v0: float = 0.0,
                        name: str = "v", block_rows: int = 1 << 20) -> DataFrame:
    """``v_i = max(lo, min(hi, v_{i-1} + d_i))`` per key in ``order`` (``v_0 = v0``).

    A key's series is cut into blocks of about ``block_rows`` rows, however
    the values of ``order`` are spread, so a hot key is walked by many tasks.
    Level 1: the triple of every row inside its (key, block).  Level 2: per
    key, the blocks' last triples are composed in order (one row per block).
    Level 3: a row's triple is applied to the value before its block.

    ``order`` must be numeric and unique per key.  A null key is a key, a null
    order value comes first, a null step leaves the value as it is.
    """
    from ..session import ship_package
    ship_package(df.sparkSession)
    key = list(key)
    d = row_blocks(df, order, block_rows, "_blk").withColumns({
        "_a": F.coalesce(F.col(step).cast("double"), F.lit(0.0)), "_l": F.lit(float(lo)), "_h": F.lit(float(hi))})
    rows = _prefix_maps(d, [*key, "_blk"], order, _TRIPLE, _compose)
    whole = F.max(F.struct("_rn", "_a", "_l", "_h"))
    blocks = rows.groupBy(*key, "_blk").agg(whole.alias("t")).select(*key, "_blk", "t._a", "t._l", "t._h")
    upto = _prefix_maps(blocks, key, "_blk", _TRIPLE, _compose)
    before = Window.partitionBy(*key).orderBy("_blk")
    offs = upto.select(*[F.col(k).alias(f"_k{n}") for n, k in enumerate(key)], F.col("_blk").alias("_kb"), F.coalesce(
        F.lag(_apply(F.lit(float(v0)), "_a", "_l", "_h")).over(before), F.lit(float(v0))).alias("_v"))
    same = F.col("_blk") == F.col("_kb")
    for n, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{n}"))
    return rows.join(offs, same).select(*df.columns, _apply(F.col("_v"), "_a", "_l", "_h").alias(name))


def _apply(v, a, lo, hi):
    """``clamp(v + a, lo, hi)``: of columns if ``a`` is the name of one, else of numbers or numpy arrays."""
    if isinstance(a, str):
        return F.least(F.col(hi), F.greatest(F.col(lo), v + F.col(a)))
    return np.minimum(hi, np.maximum(lo, v + a))
