"""Parent/child operators, range joins, the clamped walk, sampling."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions.grid import Grid
from tessera.operators import curve as C
from tessera.operators import records as R
from tessera.operators import sampling as SP


def test_rank_within_hot_group_matches_window(spark):
    rows = [(0 if k % 3 else k % 50, k, k % 11) for k in range(6000)]  # group 0 holds 2/3
    df = spark.createDataFrame(rows, "g long, o long, v long")
    got = R.rank_within(df, ["g"], ["o"], name="r", partitions=16)
    want = df.withColumn("r", (F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1).cast("int"))
    assert got.select("g", "o", "r").exceptAll(want.select("g", "o", "r")).count() == 0


def test_reconcile_and_expand(spark):
    parents = spark.createDataFrame([(1, 0, 2), (2, 0, 0), (3, 1, 3)], "id long, rank int, natoms int")
    kids = R.expand_children(parents)
    assert kids.count() == 5
    assert sorted(r.num for r in kids.where("timestep = 3").collect()) == [0, 1, 2]
    assert [r.symbol for r in kids.where("timestep = 3").orderBy("num").collect()] == [67, 79, 79]
    ok = R.reconcile_parent_child(parents, kids, ["id", "rank"], ["timestep", "rank"]).first()
    assert (ok.n_parents, ok.n_children, ok.n_mismatch, ok.n_orphans) == (3, 5, 0, 0)
    bad = kids.unionByName(kids.where("timestep = 1"))
    r = R.reconcile_parent_child(parents, bad, ["id", "rank"], ["timestep", "rank"]).first()
    assert r.n_mismatch == 1


def test_diff_paths_counts_multiset_difference(spark):
    a = spark.createDataFrame([(1, 0.1234564), (1, 0.1234564), (2, 2.0)], "k long, v double")
    b = spark.createDataFrame([(1, 0.1234561), (3, 3.0)], "k long, v double")
    r = R.diff_paths(a, b).first()
    assert (r.rows_a, r.rows_b, r.only_a, r.only_b) == (3, 2, 2, 1)


def test_keyed_draw_range_and_stability(spark):
    df = spark.range(5000).select(F.lit(3).alias("rank"), F.lit(5000).alias("n"), "id")
    d1 = df.select("id", R.keyed_draw("rank", "n", "id").alias("d"))
    d2 = df.repartition(7).select("id", R.keyed_draw("rank", "n", "id").alias("d"))
    assert d1.agg(F.min("d"), F.max("d")).first() == (4, 7)
    assert d1.exceptAll(d2).count() == 0


def _walk(steps, lo=25.0, hi=75.0):
    v, out = 0.0, []
    for d in steps:
        v = max(lo, min(hi, v + d))
        out.append(v)
    return out


def test_clamped_running_sum_blocks(spark):
    rnd = random.Random(3)
    rows = [(k % 3, k, rnd.uniform(-30, 30)) for k in range(4000)]
    df = spark.createDataFrame(rows, "key long, seq long, d double")
    got = C.clamped_running_sum(df, ["key"], "seq", "d", block_rows=64).collect()
    got = {(r.key, r.seq): r.v for r in got}
    for key in range(3):
        steps = [(s, d) for k, s, d in rows if k == key]
        for (s, _), v in zip(steps, _walk([d for _, d in steps])):
            assert abs(got[(key, s)] - v) < 1e-9


def test_bucketed_range_join_equals_brute_force(spark):
    rnd = random.Random(5)
    cuts = sorted({0.0, 100.0, *[round(rnd.uniform(0, 100), 3) for _ in range(40)]})
    iv = spark.createDataFrame([(k, cuts[k], cuts[k + 1], k == len(cuts) - 2) for k in range(len(cuts) - 1)],
                               "seg int, lo double, hi double, last boolean")
    xs = [rnd.uniform(0, 100) for _ in range(3000)] + [0.0, 100.0] + cuts
    pts = spark.createDataFrame([(k, x) for k, x in enumerate(xs)], "id long, x double")
    got = {r.id: r.seg for r in C.bucketed_range_join(pts, "x", iv, "lo", "hi", 0.0, 100.0, buckets=16,
                                                       closed_last="last").collect()}
    for k, x in enumerate(xs):
        want = int(np.searchsorted(cuts, x, side="right") - 1)
        want = min(want, len(cuts) - 2)
        assert got[k] == want


def test_sample_cells_equals_searchsorted(spark):
    g = Grid(8)
    rnd = random.Random(11)
    w = spark.createDataFrame([(k + 1, rnd.choice([1, 100])) for k in range(64)], "idx int, weight int")
    cdf = SP.weight_cdf(w)
    rows = cdf.orderBy("idx").collect()
    assert rows[-1].cdf_hi == 1.0 and rows[0].cdf_lo == 0.0
    draws = SP.hash_uniforms(spark.range(20000).withColumnRenamed("id", "seq"), "seq", seed=4)
    got = SP.sample_cells(draws, cdf, g).select("seq", "u", "idx").collect()
    his = np.array([r.cdf_hi for r in rows])
    for r in got:
        assert r.idx == int(np.searchsorted(his, r.u, side="right")) + 1
    pts = SP.weighted_sample_2d(draws, cdf, g)
    bad = pts.where((F.col("x") < F.col("xlo")) | (F.col("x") > F.col("xhi"))
                    | (F.col("y") < F.col("ylo")) | (F.col("y") > F.col("yhi"))).count()
    assert bad == 0 and pts.count() == 20000


def test_cubic_segments_interpolate_and_are_smooth(spark):
    xs = [0.0, 2.0, 3.0, 7.0, 10.0]
    ys = [0.0, 30.0, 45.0, 25.0, 60.0]
    knots = spark.createDataFrame(list(zip(xs, ys)), "kx double, ky double")
    seg = C.cubic_segments(knots)
    probe = spark.createDataFrame([(k, x) for k, x in enumerate(xs + [1.0, 2.5, 5.0, 9.0])], "id long, x double")
    got = {r.id: r.v for r in C.bucketed_range_join(probe, "x", seg, "x_lo", "x_hi", 0.0, 10.0, buckets=8,
                                                     closed_last="last").select("id", C.poly_value("x").alias("v")).collect()}
    for k, y in enumerate(ys):  # passes through every knot
        assert abs(got[k] - y) < 1e-9
    # Left and right derivative agree at an interior knot
    rows = {r.seg: r for r in seg.collect()}
    left, right = rows[1], rows[2]
    h = left.x_hi - left.x_lo
    d_left = left.c1 + 2 * left.c2 * h + 3 * left.c3 * h * h
    assert abs(d_left - right.c1) < 1e-9


def dense_spline(x, y):
    """Slopes of the spline through the knots without a jump of the third derivative at the second and last but one."""
    n = len(x)
    h, g = np.diff(x), np.diff(y) / np.diff(x)
    a, d = np.zeros((n, n)), np.zeros(n)
    for i in range(1, n - 1):  # equal second derivatives on both sides
        a[i, i - 1:i + 2] = h[i], 2 * (h[i - 1] + h[i]), h[i - 1]
        d[i] = 3 * (h[i] * g[i - 1] + h[i - 1] * g[i])
    for row, (p, q) in ((0, (0, 1)), (n - 1, (n - 3, n - 2))):  # equal third derivatives of two segments
        a[row, p] += 1 / h[p] ** 2
        a[row, p + 1] += 1 / h[p] ** 2 - 1 / h[q] ** 2
        a[row, q + 1] -= 1 / h[q] ** 2
        d[row] = 2 * (g[p] / h[p] ** 2 - g[q] / h[q] ** 2)
    return np.linalg.solve(a, d)


@pytest.mark.parametrize("n, block_rows", [(4, 1 << 20), (5, 2), (60, 7), (60, 1 << 20), (400, 50)])
def test_spline_equals_a_dense_solve(spark, n, block_rows):
    rng = np.random.default_rng(n)
    x = np.cumsum(rng.uniform(0.05, 3.0, n))
    y = rng.normal(size=n) * 10
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "kx double, ky double").repartition(4)
    got = C.spline_segments(df, block_rows=block_rows).orderBy("seg").collect()
    m = dense_spline(x, y)
    assert len(got) == n - 1 and [r.last for r in got] == [False] * (n - 2) + [True]
    assert np.allclose([r.c1 for r in got], m[:-1], rtol=1e-9, atol=1e-9)
    for r, k in zip(got, range(n - 1)):
        t = x[k + 1] - x[k]
        assert abs(r.c0 + t * (r.c1 + t * (r.c2 + t * r.c3)) - y[k + 1]) < 1e-9 * max(1, abs(y).max())
        assert abs(r.c1 + t * (2 * r.c2 + 3 * t * r.c3) - m[k + 1]) < 1e-8 * max(1, abs(m).max())


def test_spline_of_few_odd_and_repeated_knots(spark):
    def made(rows):
        df = spark.createDataFrame(rows, "kx double, ky double")
        return [(r.x_lo, r.x_hi, r.c0, r.c1, r.c2, r.c3) for r in C.spline_segments(df).orderBy("seg").collect()]
    assert made([]) == [] and made([(1.0, 2.0)]) == []
    assert made([(0.0, 1.0), (2.0, 5.0)]) == [(0.0, 2.0, 1.0, 2.0, 0.0, 0.0)]
    parabola = made([(0.0, 0.0), (1.0, 1.0), (3.0, 9.0)])
    assert np.allclose(parabola, [(0, 1, 0, 0, 1, 0), (1, 3, 1, 2, 1, 0)], atol=1e-12)
    cubic = [(float(k), float(k ** 3)) for k in range(8)]
    again = made(cubic + [(3.0, 26.0), (3.0, 28.0), (None, 1.0), (9.0, None)])
    assert np.allclose(again, [(k, k + 1, k ** 3, 3 * k * k, 3 * k, 1) for k in range(7)], atol=1e-9)
