"""Curve and sampling queries.

Knots come from the data: one knot per day of ``events``, ``kx`` = day
scaled to 0..100, ``ky`` = the day's mean value (rounded to 6 decimals).
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalar import clamp, label_sign, replace_small
from ..operators import curve as C
from ..operators import sampling as SP
from ..operators import state as S
from ..session import read_table
from .catalog import query
from .points import load_points, point_sql
from .q_hist import G, _S, _grid_sql, _history_sql, history

KNOT_BUCKETS = 1024


def knots(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("ts", "value")
    per_day = ev.groupBy(F.unix_date(F.to_date("ts")).alias("day")).agg(
        F.round(F.avg("value"), 6).alias("ky"))
    w = Window.partitionBy()
    first, last = F.min("day").over(w), F.max("day").over(w)
    return per_day.select(
        "day", F.when(last > first, (F.col("day") - first).cast("double")
                      / F.nullif((last - first).cast("double"), F.lit(0.0)) * F.lit(100.0))
        .otherwise(0.0).alias("kx"), "ky")  # data of one day: one knot at 0


def curve_segments(spark, sf_dir):
    return C.segments(knots(spark, sf_dir))


def _knots_sql() -> str:
    return """
    SELECT day, CAST(day - min(day) OVER () AS DOUBLE)
                / CAST(max(day) OVER () - min(day) OVER () AS DOUBLE) * 100.0 AS kx, ky
    FROM (SELECT CAST(CAST(ts AS DATE) - DATE '1970-01-01' AS INTEGER) AS day,
                 round(avg(value), 6) AS ky FROM events GROUP BY 1) d"""


def _segments_sql() -> str:
    return f"""
    SELECT seg, x_lo, x_hi, y_lo, y_hi, (y_hi - y_lo) / (x_hi - x_lo) AS slope,
           seg = max(seg) OVER () AS last
    FROM (SELECT CAST(row_number() OVER (ORDER BY kx) - 1 AS INTEGER) AS seg, kx AS x_lo, ky AS y_lo,
                 lead(kx) OVER (ORDER BY kx) AS x_hi, lead(ky) OVER (ORDER BY kx) AS y_hi
          FROM ({_knots_sql()}) k) s WHERE x_hi IS NOT NULL"""


def _classified_sql() -> str:
    return f"""
    SELECT p.seq, s.seg, s.y_lo + s.slope * (p.x - s.x_lo) AS curve, p.y
    FROM ({point_sql()}) p LEFT JOIN ({_segments_sql()}) s
      ON p.x >= s.x_lo AND (p.x < s.x_hi OR (s.last AND p.x = s.x_hi))"""


def classified(spark, sf_dir):
    pts = load_points(spark, sf_dir).select("seq", "x", "y")
    j = C.bucketed_range_join(pts, "x", curve_segments(spark, sf_dir), "x_lo", "x_hi", 0.0, 100.0,
                              buckets=KNOT_BUCKETS, closed_last="last")
    return j.select("seq", "seg", C.segment_value("x").alias("curve"), "y")


@query("segments", sql=_segments_sql)
def q_segments(spark, sf_dir):
    """Consecutive knots -> linear segments (lo, hi, value, slope)."""
    return curve_segments(spark, sf_dir)


@query("classify_by_curve", sql=lambda: f"""
    SELECT seq, seg, curve, CASE WHEN curve > y THEN 1 WHEN curve <= y THEN -1 END AS category
    FROM ({_classified_sql()}) c""")
def q_classify_by_curve(spark, sf_dir):
    """Each point finds its curve segment (bucketed range join) and is labelled; null beside the curve."""
    c = classified(spark, sf_dir)
    return c.select("seq", "seg", "curve", label_sign("curve", "y").alias("category"))


@query("label_sign", sql=lambda: f"""
    SELECT seq, CASE WHEN curve > y THEN 1 WHEN curve <= y THEN -1 END AS label FROM ({_classified_sql()}) c""")
def q_label_sign(spark, sf_dir):
    """+1 if the curve is above the point, else -1 (ties -1); null where the curve has no value."""
    return classified(spark, sf_dir).select("seq", label_sign("curve", "y").alias("label"))


def _spline_sql() -> str:
    """The spline's slopes by elimination knot after knot and substitution back, as recursive queries."""
    return f"""
    WITH RECURSIVE k AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY kx) - 1 AS i, count(*) OVER () AS n, kx AS x, ky AS y,
             lead(kx) OVER (ORDER BY kx) - kx AS h, (lead(ky) OVER (ORDER BY kx) - ky) / (lead(kx) OVER (ORDER BY kx) - kx) AS g
      FROM ({_knots_sql()}) k0),
    w AS MATERIALIZED (SELECT *, lag(h) OVER (ORDER BY i) AS h1, lag(g) OVER (ORDER BY i) AS g1, lag(h, 2) OVER (ORDER BY i) AS h2,
             lag(g, 2) OVER (ORDER BY i) AS g2, lead(h) OVER (ORDER BY i) AS hn, lead(g) OVER (ORDER BY i) AS gn FROM k),
    s AS MATERIALIZED (SELECT i, n,
        CASE WHEN i = 0 THEN 0.0::DOUBLE WHEN i = n - 1 THEN h2 + h1 ELSE h END AS a,
        CASE WHEN i = 0 THEN hn WHEN i = n - 1 THEN h2 ELSE 2 * (h1 + h) END AS b,
        CASE WHEN i = 0 THEN h + hn WHEN i = n - 1 THEN 0.0::DOUBLE ELSE h1 END AS c,
        CASE WHEN i = 0 THEN ((h + 2 * (h + hn)) * hn * g + h * h * gn) / (h + hn)
             WHEN i = n - 1 THEN (h1 * h1 * g2 + (2 * (h2 + h1) + h1) * h2 * g1) / (h2 + h1)
             ELSE 3 * (h * g1 + h1 * g) END AS d FROM w),
    down(i, gg, dd) AS (
      SELECT i, c / b, d / b FROM s WHERE i = 0
      UNION ALL SELECT s.i, s.c / (s.b - s.a * down.gg), (s.d - s.a * down.dd) / (s.b - s.a * down.gg)
      FROM down JOIN s ON s.i = down.i + 1),
    up(i, m) AS (
      SELECT down.i, dd FROM down, (SELECT max(n) AS n FROM s) z WHERE down.i = n - 1
      UNION ALL SELECT down.i, down.dd - down.gg * up.m FROM up JOIN down ON down.i = up.i - 1),
    seg AS (SELECT CAST(k.i AS INTEGER) AS seg, k.x AS x_lo, k.x + k.h AS x_end, k2.x AS x_hi, k.y AS c0, u.m AS c1,
        (3 * k.g - 2 * u.m - u2.m) / k.h AS c2, (u.m + u2.m - 2 * k.g) / (k.h * k.h) AS c3, k.i = k.n - 2 AS last
      FROM k JOIN up u ON u.i = k.i JOIN k k2 ON k2.i = k.i + 1 JOIN up u2 ON u2.i = k.i + 1)"""


@query("spline_segments", sql=lambda: f"""{_spline_sql()}
    SELECT seg, round(x_lo, 6) AS x_lo, round(x_hi, 6) AS x_hi, round(c0, 6) AS c0, round(c1, 6) AS c1,
           round(c2, 6) AS c2, round(c3, 6) AS c3, last FROM seg""")
def q_spline_segments(spark, sf_dir):
    """W6, smooth: the cubic spline through the knots as segments with four coefficients."""
    s = C.spline_segments(knots(spark, sf_dir))
    return s.select("seg", *[F.round(c, 6).alias(c) for c in ("x_lo", "x_hi", "c0", "c1", "c2", "c3")], "last")


@query("classify_by_spline", sql=lambda: f"""{_spline_sql()},
    v AS (SELECT p.seq, p.y, seg.seg, c0 + (p.x - x_lo) * (c1 + (p.x - x_lo) * (c2 + (p.x - x_lo) * c3)) AS curve
          FROM ({point_sql()}) p LEFT JOIN seg ON p.x >= x_lo AND (p.x < x_hi OR (last AND p.x = x_hi)))
    SELECT seq, seg, round(curve, 6) AS curve, CASE WHEN curve > y THEN 1 WHEN curve <= y THEN -1 END AS category FROM v""")
def q_classify_by_spline(spark, sf_dir):
    """J2 on the smooth curve: each point finds its spline segment and is labelled; null beside the curve."""
    pts = load_points(spark, sf_dir).select("seq", "x", "y")
    j = C.bucketed_range_join(pts, "x", C.spline_segments(knots(spark, sf_dir)), "x_lo", "x_hi", 0.0, 100.0,
                              buckets=KNOT_BUCKETS, closed_last="last")
    curve = C.poly_value("x")
    return j.select("seq", "seg", F.round(curve, 6).alias("curve"), label_sign(curve, "y").alias("category"))


@query("linspace", sql=lambda: f"""
    WITH g AS (SELECT COUNT(*) * 100 AS n FROM ({_knots_sql()}) k),
         t AS (SELECT CAST(r.range AS BIGINT) AS k,
                      0.0::DOUBLE + (100.0::DOUBLE - 0.0::DOUBLE) / CAST(g.n - 1 AS DOUBLE) * CAST(r.range AS DOUBLE) AS x
               FROM g, range((SELECT n FROM g)) r)
    SELECT t.k, t.x, s.y_lo + s.slope * (t.x - s.x_lo) AS curve
    FROM t JOIN ({_segments_sql()}) s
      ON t.x >= s.x_lo AND (t.x < s.x_hi OR (s.last AND t.x = s.x_hi))""")
def q_linspace(spark, sf_dir):
    """``n = 100 * knots`` evenly spaced points on [0, 100] with the curve value there."""
    from ..functions.scalar import linspace_points
    n_row = knots(spark, sf_dir).agg((F.count(F.lit(1)) * 100).alias("n"))
    t = linspace_points(n_row, "n", 0.0, 100.0)
    j = C.bucketed_range_join(t, "x", curve_segments(spark, sf_dir), "x_lo", "x_hi", 0.0, 100.0,
                              buckets=KNOT_BUCKETS, closed_last="last")
    return j.select("k", "x", C.segment_value("x").alias("curve"))


def _steps(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return ev.select("user_id", F.col("event_id").alias("seq"),
                     (F.col("value") - F.lit(50.0)).alias("h"))


@query("clamp", sql="""
    SELECT event_id AS seq, greatest(25.0::DOUBLE, least(75.0::DOUBLE, value - 50.0::DOUBLE)) AS clamped
    FROM events""")
def q_clamp(spark, sf_dir):
    """``fmax(25, fmin(75, v))`` on each step."""
    return _steps(spark, sf_dir).select("seq", clamp("h").alias("clamped"))


@query("replace_small", sql="""
    SELECT event_id AS seq, CASE WHEN value - 50.0::DOUBLE < 1 AND value - 50.0::DOUBLE > -1
                                 THEN -5.0::DOUBLE ELSE value - 50.0::DOUBLE END AS h
    FROM events""")
def q_replace_small(spark, sf_dir):
    """Steps inside (-1, 1) become -5."""
    return _steps(spark, sf_dir).select("seq", replace_small("h").alias("h"))


@query("clamped_running_sum", sql="""
    WITH RECURSIVE s AS (
      SELECT user_id, event_id,
             row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn,
             CASE WHEN value - 50.0::DOUBLE < 1 AND value - 50.0::DOUBLE > -1
                  THEN -5.0::DOUBLE ELSE value - 50.0::DOUBLE END AS h
      FROM events),
    w(user_id, rn, seq, v) AS (
      SELECT user_id, rn, event_id, greatest(25.0::DOUBLE, least(75.0::DOUBLE, 0.0::DOUBLE + h))
      FROM s WHERE rn = 1
      UNION ALL
      SELECT s.user_id, s.rn, s.event_id, greatest(25.0::DOUBLE, least(75.0::DOUBLE, w.v + s.h))
      FROM w JOIN s ON s.user_id = w.user_id AND s.rn = w.rn + 1)
    SELECT user_id, seq, round(v, 6) AS v FROM w""")
def q_clamped_running_sum(spark, sf_dir):
    """Per user, ``v_i = clamp(v_{i-1} + replace_small(value - 50))`` in event order."""
    st = _steps(spark, sf_dir).select("user_id", "seq", replace_small("h").alias("d"))
    out = C.clamped_running_sum(st, ["user_id"], "seq", "d")
    return out.select("user_id", "seq", F.round("v", 6).alias("v"))


# ---------------------------------------------------------------- sampling

def final_weights(spark, sf_dir):
    return S.overlay_weights(S.initial_weights(spark, G), S.reports(history(spark, sf_dir)))


def _weights_sql() -> str:
    return f"""
    SELECT g.idx, CAST(CASE WHEN r.idx IS NOT NULL THEN 1 ELSE 100 END AS INTEGER) AS weight
    FROM ({_grid_sql()}) g LEFT JOIN
         (SELECT DISTINCT idx FROM ({_history_sql()}) h WHERE abs(sat) > 3) r ON g.idx = r.idx"""


def _cdf_sql() -> str:
    return f"""
    SELECT idx, weight, COALESCE(lag(cdf_hi) OVER (ORDER BY idx), 0.0::DOUBLE) AS cdf_lo, cdf_hi FROM (
      SELECT idx, weight,
             CASE WHEN idx = max(idx) OVER () THEN 1.0::DOUBLE
                  ELSE CAST(SUM(weight) OVER (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
                       / CAST(SUM(weight) OVER () AS DOUBLE) END AS cdf_hi
      FROM ({_weights_sql()}) w) c"""


def _draws(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "value")
    max_id = ev.agg(F.max("event_id")).first()[0]  # one scalar, folded in as a literal
    max_id = float(max_id) if max_id is not None else 0.0
    return ev.select(F.col("event_id").alias("seq"),
                     ((F.col("event_id").cast("double") + F.lit(0.5))
                      / (F.lit(max_id) + F.lit(1.0))).alias("u"),
                     (F.col("value") - F.floor("value")).alias("v"))


def _draws_sql() -> str:
    return """
    SELECT event_id AS seq,
           (CAST(event_id AS DOUBLE) + 0.5) / (CAST((SELECT max(event_id) FROM events) AS DOUBLE) + 1.0) AS u,
           value - floor(value) AS v
    FROM events"""


@query("weight_cdf", sql=_cdf_sql)
def q_weight_cdf(spark, sf_dir):
    """Normalised cumulative weights over the cells (after all batches' reports)."""
    return SP.weight_cdf(final_weights(spark, sf_dir))


@query("sample_cells", sql=lambda: f"""
    SELECT d.seq, c.idx FROM ({_draws_sql()}) d JOIN ({_cdf_sql()}) c
    ON d.u >= c.cdf_lo AND d.u < c.cdf_hi""")
def q_sample_cells(spark, sf_dir):
    """Inverse-CDF lookup of each event's uniform u (fraction of its id)."""
    cdf = SP.weight_cdf(final_weights(spark, sf_dir))
    return SP.sample_cells(_draws(spark, sf_dir), cdf, G).select("seq", "idx")


@query("weighted_sample_2d", sql=lambda: f"""
    SELECT seq, idx,
           (i - 1) * {_S} + (u - cdf_lo) / (cdf_hi - cdf_lo) * (i * {_S} - (i - 1) * {_S}) AS x,
           (j - 1) * {_S} + v * (j * {_S} - (j - 1) * {_S}) AS y
    FROM (SELECT d.seq, d.u, d.v, c.idx, c.cdf_lo, c.cdf_hi,
                 CAST((c.idx - 1) // {G.n} + 1 AS INTEGER) AS i, CAST((c.idx - 1) % {G.n} + 1 AS INTEGER) AS j
          FROM ({_draws_sql()}) d JOIN ({_cdf_sql()}) c ON d.u >= c.cdf_lo AND d.u < c.cdf_hi) s""")
def q_weighted_sample_2d(spark, sf_dir):
    """One point per event placed by weight: cell from u, x inside the cell from u, y from v."""
    cdf = SP.weight_cdf(final_weights(spark, sf_dir))
    return SP.weighted_sample_2d(_draws(spark, sf_dir), cdf, G).select("seq", "idx", "x", "y")
