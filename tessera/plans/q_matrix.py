"""Reshape and matrix-file queries over the dense state of the Point histogram."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.grid import axis_scale, cell_col, cell_row, column_ordinal
from ..operators import histogram as H
from ..operators import reshape as RS
from ..session import read_table, scratch_path
from ..sources import files as FS
from .catalog import query
from .points import load_points, point_sql
from .q_hist import G, N, _dense_state_sql, points_in_grid


def dense_state(spark, sf_dir):
    st = H.hist2d_signed(points_in_grid(spark, sf_dir), G)
    return st.select(cell_row("idx", G).alias("i"), cell_col("idx", G).alias("j"),
                     F.col("h").alias("value"))


def wide_state(spark, sf_dir):
    return RS.long_to_matrix(dense_state(spark, sf_dir), N)


def _wide_sql() -> str:
    cols = ", ".join(f"MAX(CASE WHEN j = {k} THEN h END) AS C{k}" for k in range(1, N + 1))
    return f"SELECT i, {cols} FROM ({_dense_state_sql()}) d GROUP BY i"


@query("long_to_matrix", sql=_wide_sql)
def q_long_to_matrix(spark, sf_dir):
    """R2: cells -> wide matrix rows (i, C1..Cn)."""
    return wide_state(spark, sf_dir)


@query("matrix_to_long", sql=lambda: f"SELECT i AS x, 'C' || CAST(j AS VARCHAR) AS y, h AS value FROM ({_dense_state_sql()}) d")
def q_matrix_to_long(spark, sf_dir):
    """One row per cell of the wide matrix: x, the column's name as y, the value."""
    wide = wide_state(spark, sf_dir).withColumnRenamed("i", "x")
    return RS.matrix_to_long(wide, "x")


@query("column_ordinal", sql=lambda: f"SELECT i AS x, 'C' || CAST(j AS VARCHAR) AS y, CAST(j - 1 AS INTEGER) AS y_ord, h AS value FROM ({_dense_state_sql()}) d")
def q_column_ordinal(spark, sf_dir):
    """The 0-based ordinal of the gathered column names, beside the value."""
    wide = wide_state(spark, sf_dir).withColumnRenamed("i", "x")
    lng = RS.matrix_to_long(wide, "x")
    return lng.select("x", "y", column_ordinal("y").alias("y_ord"), "value")


@query("axis_scale", sql=lambda: f"""
    SELECT CAST(i - 1 AS DOUBLE) * (100.0 / {N}.0) AS x, CAST(j - 1 AS DOUBLE) * (100.0 / {N}.0) AS y,
           h AS value FROM ({_dense_state_sql()}) d""".replace("100.0 / ", "CAST(100 AS DOUBLE) / ").replace(f"{N}.0)", f"CAST({N} AS DOUBLE))"))
def q_axis_scale(spark, sf_dir):
    """The plotting frame: ``x = seq(0, nrow - 1) * (100 / nrow)``, ``y = ordinal * (100 / nrow)``."""
    wide = wide_state(spark, sf_dir)
    lng = RS.matrix_to_long(wide.withColumn("x", F.col("i") - 1).drop("i"), "x")
    return lng.select(axis_scale("x", N).alias("x"), axis_scale(column_ordinal("y"), N).alias("y"),
                      "value")


@query("bind_columns", sql=lambda: f"SELECT CAST(i - 1 AS BIGINT) AS x, * EXCLUDE (i) FROM ({_wide_sql()}) w")
def q_bind_columns(spark, sf_dir):
    """``cbind(x = seq(0, nrow - 1), df)`` on the matrix read back from its CSV."""
    path = scratch_path(spark, "hist_csv")
    FS.write_matrix_csv(wide_state(spark, sf_dir), path)
    m = FS.read_matrix_csv(spark, path, N, value_type="long").drop("i")
    return RS.bind_columns(m, name="x", key=None)


@query("row_index", sql=lambda: f"SELECT seq, row_number() OVER (ORDER BY seq) AS row FROM ({point_sql()}) p")
def q_row_index(spark, sf_dir):
    """1-based row number in seq order (two-level, no single-task window)."""
    return RS.row_index(load_points(spark, sf_dir).select("seq"), key="seq", name="row")


@query("matrix_profile", sql=lambda: f"""
    SELECT COUNT(DISTINCT i) AS rows, COUNT(DISTINCT j) AS cols,
           CAST(SUM(CASE WHEN h <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS nnz
    FROM ({_dense_state_sql()}) d""")
def q_matrix_profile(spark, sf_dir):
    """Rows, cols and nnz of the state matrix."""
    return RS.matrix_profile(dense_state(spark, sf_dir), "i", "j", "value")


@query("write_matrix_csv", sql=_wide_sql)
def q_write_matrix_csv(spark, sf_dir):
    """K4: the state as a wide CSV with header (one file), read back in file order."""
    path = scratch_path(spark, "hist_csv")
    FS.write_matrix_csv(wide_state(spark, sf_dir), path)
    return FS.read_matrix_csv(spark, path, N, value_type="long")


@query("scan_matrix_csv", sql=_wide_sql)
def q_scan_matrix_csv(spark, sf_dir):
    """S3: read a wide matrix CSV (header C1..Cn, names found in it); row number from the file order."""
    path = scratch_path(spark, "hist_csv")
    FS.write_matrix_csv(wide_state(spark, sf_dir), path)
    return FS.read_matrix_csv(spark, path, None, value_type="long")


@query("scan_matrix_meta", sql=lambda: f"""
    SELECT 'matrix' AS data_type, 'long' AS value_type, COUNT(DISTINCT i) AS rows,
           CAST({N} AS BIGINT) AS cols, CAST(SUM(CASE WHEN h <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS nnz,
           'csv' AS format, true AS header, ',' AS sep, 'tessera' AS author,
           (SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') || ' UTC' FROM events) AS created
    FROM ({_dense_state_sql()}) d""")
def q_scan_matrix_meta(spark, sf_dir):
    """All ten keys of the JSON sidecar; the state is as of the newest event."""
    path = scratch_path(spark, "hist_csv")
    newest = read_table(spark, sf_dir, "events").agg(
        F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("t")).first()["t"]
    FS.write_matrix_csv(wide_state(spark, sf_dir), path, created=f"{newest} UTC")
    return FS.read_matrix_meta(spark, path + ".mtd").select(*FS.MATRIX_META_KEYS)
