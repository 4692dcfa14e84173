"""Histogram queries over the Point view (core, histogram, state over batches)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import Grid, cell_col, cell_row, in_domain, signed_abs
from ..operators import histogram as H
from ..operators import state as S
from ..session import read_table
from .catalog import query
from .points import DEFAULT_GRID, load_point_cells, load_points, point_cells_sql, point_sql

G = DEFAULT_GRID
N = G.n
CELLS = G.cells
_S = f"CAST({G.stride!r} AS DOUBLE)"


#: What the last query over the Point table left out, once it has run (see :func:`histogram.inside_counted`).
LAST_REJECTS: list = [None]


def inside(cells: DataFrame, grid: Grid = G) -> DataFrame:
    """Points inside the grid; those left out are counted in the same pass, into ``LAST_REJECTS``."""
    kept, LAST_REJECTS[0] = H.inside_counted(cells, grid, "Point")
    return kept


# ---------------------------------------------------------------- SQL pieces

def _cells_sql() -> str:
    return f"SELECT * FROM ({point_cells_sql(G)}) pc WHERE gx BETWEEN 1 AND {N} AND gy BETWEEN 1 AND {N}"


def _grid_sql() -> str:
    return (f"SELECT CAST(range + 1 AS INTEGER) AS idx, CAST(range // {N} + 1 AS INTEGER) AS i, "
            f"CAST(range % {N} + 1 AS INTEGER) AS j FROM range({CELLS})")


def _prev_sql(order: str = "seq") -> str:
    return f"""SELECT *, CAST(COALESCE(SUM(category) OVER (PARTITION BY idx ORDER BY {order}
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS prev
               FROM ({_cells_sql()}) c"""


def _sat_sql() -> str:
    return f"""SELECT idx, COUNT(*) AS n_points, CAST(SUM(category) AS BIGINT) AS dh,
               CAST(SUM(category + abs(prev)) AS BIGINT) AS sat
               FROM ({_prev_sql()}) w GROUP BY idx"""


def _hist_sql() -> str:
    s = G.stride
    return f"""SELECT g.idx, (g.i - 1) * {_S} AS c1, (g.j - 1) * {_S} AS c2,
               CAST(COALESCE(s.sat, 0) AS BIGINT) AS c3
               FROM ({_grid_sql()}) g LEFT JOIN ({_sat_sql()}) s ON g.idx = s.idx"""


def _history_sql() -> str:
    return f"""SELECT *, CAST(SUM(dh) OVER (PARTITION BY idx ORDER BY batch
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS h_after FROM (
               SELECT batch, idx, COUNT(*) AS n_points, CAST(SUM(category) AS BIGINT) AS dh,
                      CAST(SUM(category + abs(prev)) AS BIGINT) AS sat
               FROM ({_prev_sql('batch, seq')}) w GROUP BY batch, idx) g"""


def _dense_state_sql() -> str:
    return f"""SELECT g.idx, g.i, g.j, CAST(COALESCE(d.dh, 0) AS BIGINT) AS h
               FROM ({_grid_sql()}) g LEFT JOIN
               (SELECT idx, SUM(category) AS dh FROM ({_cells_sql()}) c GROUP BY idx) d
               ON g.idx = d.idx"""


# ---------------------------------------------------------------- Spark pieces

def points_in_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inside(load_point_cells(spark, sf_dir, G))


def single_batch_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analysis matrix for all points as one batch on a zero state."""
    sat = H.saturation(points_in_grid(spark, sf_dir), G)
    return H.hist_table(sat, G)


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.batch_history(points_in_grid(spark, sf_dir), G)


# ---------------------------------------------------------------- step 1: core

@query("scan_table", sql=lambda: point_sql())
def q_scan_table(spark, sf_dir):
    """``SELECT * FROM Point``."""
    return load_points(spark, sf_dir)


@query("project_positional", sql=lambda: f"SELECT x, y FROM ({point_sql()}) p")
def q_project_positional(spark, sf_dir):
    """``df[, 1:2]`` -- the first two columns by position."""
    df = load_points(spark, sf_dir)
    return df.select(*df.columns[0:2])


@query("bin_assign", sql=lambda: f"SELECT seq, gx, gy FROM ({point_cells_sql(G)}) p")
def q_bin_assign(spark, sf_dir):
    """1-based bins ``ceil(v / stride)``."""
    return load_point_cells(spark, sf_dir, G).select("seq", "gx", "gy")


@query("out_of_domain", sql=lambda: f"""
    SELECT seq, gx, gy FROM ({point_cells_sql(G, clamp_y=False)}) p
    WHERE (gx BETWEEN 1 AND {N} AND gy BETWEEN 1 AND {N}) IS NOT TRUE""")
def q_out_of_domain(spark, sf_dir):
    """P5: points whose bins fall outside 1..n or are null (raw, unclamped y = value)."""
    cells = H.assign_cells(load_points(spark, sf_dir, clamp_y=False), G)
    return H.split_domain(cells, G)[1].select("seq", "gx", "gy")


@query("cell_index", sql=lambda: f"""
    SELECT seq, idx, CAST((idx - 1) // {N} + 1 AS INTEGER) AS i,
           CAST((idx - 1) % {N} + 1 AS INTEGER) AS j, idx - 1 AS idx0
    FROM ({_cells_sql()}) c""")
def q_cell_index(spark, sf_dir):
    """(i, j) -> idx and back; 0-based form for the sampler."""
    c = points_in_grid(spark, sf_dir)
    return c.select("seq", "idx", cell_row("idx", G).alias("i"), cell_col("idx", G).alias("j"),
                    (F.col("idx") - 1).alias("idx0"))


@query("cell_to_edges", sql=lambda: f"""
    SELECT seq, idx, (gx - 1) * {_S} AS xlo, gx * {_S} AS xhi,
           (gy - 1) * {_S} AS ylo, gy * {_S} AS yhi
    FROM ({_cells_sql()}) c""")
def q_cell_to_edges(spark, sf_dir):
    """Cell number -> lower/upper x and y edge."""
    c = H.cell_to_edges(points_in_grid(spark, sf_dir), G)
    return c.select("seq", "idx", "xlo", "xhi", "ylo", "yhi")


@query("cell_edges", sql=lambda: f"""
    SELECT g.idx, g.i, g.j, (g.i - 1) * {_S} AS xlo, (g.j - 1) * {_S} AS ylo,
           COALESCE(p.n_points, 0) AS n_points
    FROM ({_grid_sql()}) g LEFT JOIN
         (SELECT idx, COUNT(*) AS n_points FROM ({_cells_sql()}) c GROUP BY idx) p
    ON g.idx = p.idx""")
def q_cell_edges(spark, sf_dir):
    """Dense cell index with lower edges (and the points that fall in each cell)."""
    edges = H.cell_edges(spark, G)
    cnt = points_in_grid(spark, sf_dir).groupBy("idx").agg(F.count(F.lit(1)).alias("n_points"))
    return edges.join(H._maybe_broadcast(cnt, G), "idx", "left").select(
        "idx", "i", "j", "xlo", "ylo", F.coalesce("n_points", F.lit(0)).alias("n_points"))


@query("signed_abs", sql=lambda: f"""
    SELECT idx, h, abs(h) AS abs_h FROM ({_dense_state_sql()}) d""")
def q_signed_abs(spark, sf_dir):
    """P10: the absolute value of the state after all points."""
    st = H.hist2d_signed(points_in_grid(spark, sf_dir), G)
    return st.select("idx", "h", signed_abs("h").cast("bigint").alias("abs_h"))


@query("project_alias", sql=lambda: f"SELECT idx, abs(c3) AS sat FROM ({_hist_sql()}) h")
def q_project_alias(spark, sf_dir):
    """The cell number and the absolute saturation, under new names."""
    return single_batch_hist(spark, sf_dir).select("idx", F.abs("c3").alias("sat"))


@query("filter_saturated", sql=lambda: f"""
    SELECT * FROM (SELECT idx, abs(c3) AS sat FROM ({_hist_sql()}) h) s WHERE sat > 3""")
def q_filter_saturated(spark, sf_dir):
    """The cells whose saturation is strictly above the threshold."""
    return (single_batch_hist(spark, sf_dir).select("idx", F.abs("c3").alias("sat"))
            .where(F.col("sat") > 3))


@query("order_saturated", sql=lambda: f"""
    SELECT * FROM (SELECT idx, abs(c3) AS sat FROM ({_hist_sql()}) h) s WHERE sat > 3
    ORDER BY sat DESC, idx""")
def q_order_saturated(spark, sf_dir):
    """O1: the full report of one batch: ``ORDER BY Sat DESC`` (ties by idx)."""
    return H.report_saturated(single_batch_hist(spark, sf_dir))


# ---------------------------------------------------------------- step 2: histogram

@query("hist2d_signed", sql=lambda: f"SELECT idx, h FROM ({_dense_state_sql()}) d")
def q_hist2d_signed(spark, sf_dir):
    """A1: dense state after ``h[j,k] += b`` over all points (zero initial state)."""
    return H.hist2d_signed(points_in_grid(spark, sf_dir), G)


@query("state_before_row", sql=lambda: f"SELECT seq, idx, prev FROM ({_prev_sql()}) w")
def q_state_before_row(spark, sf_dir):
    """The cell state just before each point."""
    return H.state_before_row(points_in_grid(spark, sf_dir), G).select("seq", "idx", "prev")


@query("saturation", sql=_sat_sql)
def q_saturation(spark, sf_dir):
    """A2: ``sum(b + |h before the point|)`` per cell, points in seq order."""
    return H.saturation(points_in_grid(spark, sf_dir), G).select("idx", "n_points", "dh", "sat")


@query("join_cell_state", sql=lambda: f"""
    SELECT c.seq, c.batch, c.idx, CAST(COALESCE(s.h_start, 0) AS BIGINT) AS h
    FROM ({_cells_sql()}) c LEFT JOIN (
      SELECT batch, idx, SUM(dh) OVER (PARTITION BY idx ORDER BY batch
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS h_start
      FROM (SELECT batch, idx, SUM(category) AS dh FROM ({_cells_sql()}) c2 GROUP BY batch, idx) a
    ) s ON c.batch IS NOT DISTINCT FROM s.batch AND c.idx = s.idx""")
def q_join_cell_state(spark, sf_dir):
    """Each point reads its cell's state at the start of its batch (missing -> 0)."""
    pts = points_in_grid(spark, sf_dir)
    return S.read_cell_state(pts.select("seq", "batch", "idx"), S.state_at_batch_start(pts))


@query("sum_all", sql=lambda: f"""
    SELECT CAST(SUM(CASE WHEN ok THEN category END) AS BIGINT) AS total, COUNT(*) FILTER (ok) AS n_points,
           COUNT(*) FILTER (ok AND category = 1) AS n_hits, COUNT(*) FILTER (NOT ok) AS n_outside
    FROM (SELECT category, coalesce(gx BETWEEN 1 AND {N} AND gy BETWEEN 1 AND {N}, false) AS ok
          FROM ({point_cells_sql(G)}) pc) c""")
def q_sum_all(spark, sf_dir):
    """A3: global sum (histogram total), and how many points lie outside the grid."""
    ok = F.coalesce(in_domain("gx", "gy", G), F.lit(False))
    return load_point_cells(spark, sf_dir, G).agg(
        F.sum(F.when(ok, F.col("category"))).cast("bigint").alias("total"),
        F.count(F.when(ok, 1)).alias("n_points"),
        F.count(F.when(ok & (F.col("category") == 1), 1)).alias("n_hits"),
        F.count(F.when(~ok, 1)).alias("n_outside"))


@query("group_sum_sorted", sql=lambda: f"""
    SELECT y, CAST(SUM(CASE WHEN category = 1 THEN 1 ELSE 0 END) AS BIGINT) AS sum_hit
    FROM ({point_sql()}) p GROUP BY y ORDER BY y DESC""")
def q_group_sum_sorted(spark, sf_dir):
    """A4: hits per distinct y, largest y first."""
    p = load_points(spark, sf_dir)
    return (p.groupBy("y").agg(F.sum(F.when(F.col("category") == 1, 1).otherwise(0))
                               .cast("bigint").alias("sum_hit"))
            .orderBy(F.desc("y")))


@query("row_count", sql="""
    SELECT 'Timestep' AS table_name, COUNT(*) AS n_rows FROM orders
    UNION ALL SELECT 'Atom', COUNT(*) FROM lineitem
    UNION ALL SELECT 'Point', COUNT(*) FROM events""")
def q_row_count(spark, sf_dir):
    """A5: row count per table (Timestep = orders, Atom = lineitem, Point = events)."""
    parts = [read_table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(name).alias("table_name"), "n_rows")
             for name, t in (("Timestep", "orders"), ("Atom", "lineitem"), ("Point", "events"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- step 3: state over batches

@query("stateful_hist", sql=_history_sql)
def q_stateful_hist(spark, sf_dir):
    """T2 in batch form: per (batch, idx) the histogram, saturation and state after."""
    return history(spark, sf_dir).select("batch", "idx", "n_points", "dh", "sat", "h_after")


@query("report_saturated", sql=lambda: f"""
    SELECT batch, idx, abs(sat) AS sat FROM ({_history_sql()}) h WHERE abs(sat) > 3
    ORDER BY batch, sat DESC, idx""")
def q_report_saturated(spark, sf_dir):
    """T5: per batch, the reported cells (state carried over between batches)."""
    return S.reports(history(spark, sf_dir)).orderBy("batch", F.desc("sat"), "idx")


@query("overlay_weights", sql=lambda: f"""
    SELECT g.idx, CASE WHEN r.idx IS NOT NULL THEN 1 ELSE 100 END AS weight
    FROM ({_grid_sql()}) g LEFT JOIN
         (SELECT DISTINCT idx FROM ({_history_sql()}) h WHERE abs(sat) > 3) r ON g.idx = r.idx""")
def q_overlay_weights(spark, sf_dir):
    """Weights after all batches; reported cells 1, others keep 100."""
    w = S.initial_weights(spark, G)
    return S.overlay_weights(w, S.reports(history(spark, sf_dir)))


@query("stop_when_exhausted", sql=lambda: f"""
    WITH f AS (SELECT idx, MIN(batch) AS first_batch FROM ({_history_sql()}) h
               WHERE abs(sat) > 3 GROUP BY idx),
         b AS (SELECT DISTINCT batch FROM ({_cells_sql()}) c),
         t AS (SELECT b.batch, CAST({100 * CELLS} - 99 * SUM(COALESCE(n.cnt, 0))
                      OVER (ORDER BY b.batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                      AS BIGINT) AS weight_total
               FROM b LEFT JOIN (SELECT first_batch, COUNT(*) AS cnt FROM f GROUP BY first_batch) n
               ON b.batch = n.first_batch),
         e AS (SELECT batch, weight_total,
                      CAST(CASE WHEN weight_total <= {CELLS} THEN 1 ELSE 0 END AS INTEGER) AS exhausted
               FROM t)
    SELECT * FROM e WHERE batch <= COALESCE((SELECT MIN(batch) FROM e WHERE exhausted = 1),
                                            (SELECT MAX(batch) FROM e))""")
def q_stop_when_exhausted(spark, sf_dir):
    """Weight total per batch and the stop flag; rows end at the stopping batch."""
    return S.weight_totals(history(spark, sf_dir), G)
