"""Table I/O queries: every format is written from the given tables into the
shared scratch folder (below ``spark.checkpoint.dir``) and read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..operators import state as S
from ..operators.histogram import cell_to_edges
from ..operators.timing import timed, timing_rows
from ..session import scratch_path
from ..sources import files as FS
from ..sources import struct_records as SR
from ..sources import tables as T
from . import registry as REG
from .catalog import query
from .points import load_points, point_sql
from .q_hist import G, _grid_sql, _history_sql, _S, history
from .records import atom_sql, atom_view, timestep_sql, timestep_view


@query("scan_struct_records", sql=timestep_sql)
def q_scan_struct_records(spark, sf_dir):
    """Timestep rows written as packed 24-byte structs, read back by byte ranges."""
    path = scratch_path(spark, "timestep_bin")
    SR.write_struct(timestep_view(spark, sf_dir), path, SR.TIMESTEP)
    return SR.scan_struct(spark, path, SR.TIMESTEP)


@query("append_struct_records", sql=lambda: f"SELECT * FROM ({timestep_sql()}) a UNION ALL SELECT * FROM ({timestep_sql()}) b")
def q_append_struct_records(spark, sf_dir):
    """K1/K2 for packed structs: an overwrite leaves one copy, an append after it two."""
    path = scratch_path(spark, "timestep_bin")
    rows = timestep_view(spark, sf_dir)
    SR.write_struct(rows, path, SR.TIMESTEP)
    SR.write_struct(rows, path, SR.TIMESTEP)
    SR.write_struct(rows, path, SR.TIMESTEP, append=True)
    return SR.scan_struct(spark, path, SR.TIMESTEP)


@query("scan_part_csv", sql=atom_sql)
def q_scan_part_csv(spark, sf_dir):
    """Atom rows written as header-less CSV parts per rank, read back with a schema."""
    path = scratch_path(spark, "atom_csv")
    FS.write_part_csv(atom_view(spark, sf_dir), path)
    return FS.read_part_csv(spark, path, SR.spark_schema(SR.ATOM))


@query("write_part_csv", sql=timestep_sql)
def q_write_part_csv(spark, sf_dir):
    """K3: Timestep as CSV parts (``%ld,%d,%d,%f``), read back."""
    path = scratch_path(spark, "timestep_csv")
    FS.write_part_csv(timestep_view(spark, sf_dir), path)
    return FS.read_part_csv(spark, path, SR.spark_schema(SR.TIMESTEP))


def _cells_sql() -> str:
    return f"""
    SELECT (g.i - 1) * {_S} AS xmin, g.i * {_S} AS xmax, (g.j - 1) * {_S} AS ymin,
           g.j * {_S} AS ymax,
           CAST(CASE WHEN r.idx IS NOT NULL THEN 1 ELSE 100 END AS DOUBLE) AS count
    FROM ({_grid_sql()}) g LEFT JOIN
         (SELECT DISTINCT idx FROM ({_history_sql()}) h WHERE abs(sat) > 3) r ON g.idx = r.idx"""


def _weight_cells(spark, sf_dir):
    w = S.overlay_weights(S.initial_weights(spark, G), S.reports(history(spark, sf_dir)))
    c = cell_to_edges(w, G)
    return c.select(F.col("xlo").alias("xmin"), F.col("xhi").alias("xmax"),
                    F.col("ylo").alias("ymin"), F.col("yhi").alias("ymax"),
                    F.col("weight").cast("double").alias("count"))


@query("write_cell_text", sql=_cells_sql)
def q_write_cell_text(spark, sf_dir):
    """K5: final cell weights as ``xmin xmax ymin ymax weight`` text (read back)."""
    path = scratch_path(spark, "hist_tab")
    FS.write_cell_text(_weight_cells(spark, sf_dir), path)
    return FS.read_cell_text(spark, path)


@query("scan_cell_text", sql=_cells_sql)
def q_scan_cell_text(spark, sf_dir):
    """Read the space-delimited cell file as columns."""
    path = scratch_path(spark, "hist_tab")
    FS.write_cell_text(_weight_cells(spark, sf_dir), path)
    return FS.read_cell_text(spark, path)


def _accounting_sql() -> str:
    from .catalog import oracle_sql
    return oracle_sql()["bytes_accounting"]


TIMING_SCHEMA = StructType([StructField(c, StringType() if c == "Method" else DoubleType() if c in (
    "Total", "Transfer", "Analysis") else LongType()) for c in FS.TIMING_COLUMNS])


@query("scan_tsv_header", sql=lambda: f"""
    SELECT m.method AS Method, a.nsteps AS Nrows, a.natoms AS Natoms, a.bytes AS Bytes, true AS times_add_up
    FROM (VALUES ('ring'), ('fs')) AS m(method), ({_accounting_sql()}) a""")
def q_scan_tsv_header(spark, sf_dir):
    """The timing table (seven columns, measured) of both transports, per rank, as TSV with header, read back.

    Times differ from run to run, so they are checked here: all positive, and
    the whole is the sum of transfer and analysis.
    """
    tbl = timing_table(spark, sf_dir)
    path = scratch_path(spark, "timing_tsv")
    FS.write_tsv_header(tbl, path)
    back = FS.read_tsv_header(spark, path, TIMING_SCHEMA)
    adds = (F.col("Transfer") > 0) & (F.col("Analysis") > 0) & (
        F.abs(F.col("Total") - F.col("Transfer") - F.col("Analysis")) < 1e-9 * F.col("Total"))
    return back.select("Method", "Nrows", "Natoms", "Bytes", adds.alias("times_add_up"))


def timing_table(spark, sf_dir):
    """Both transports (packed records, CSV parts) of Timestep and Atom, timed: write, then the parent/child check."""
    steps, atoms = timestep_view(spark, sf_dir), atom_view(spark, sf_dir)
    out = None
    for method in ("ring", "fs"):
        base = scratch_path(spark, f"timing-{method}")

        def transfer():
            for name, df, fields in (("step", steps, SR.TIMESTEP), ("atom", atoms, SR.ATOM)):
                if method == "ring":
                    SR.write_struct(df, f"{base}/{name}", fields)
                else:
                    FS.write_part_csv(df, f"{base}/{name}")

        def table(name, fields):
            if method == "ring":
                return SR.scan_struct(spark, f"{base}/{name}", fields)
            return FS.read_part_csv(spark, f"{base}/{name}", SR.spark_schema(fields))

        def analysis():
            REG.run_analysis(spark, "Count", {"Timestep": table("step", SR.TIMESTEP),
                                              "Atom": table("atom", SR.ATOM)}).collect()

        seconds = timed(transfer, analysis)
        rows = timing_rows(method, table("step", SR.TIMESTEP), table("atom", SR.ATOM), seconds)
        out = rows if out is None else out.unionByName(rows)
    return out.select(*FS.TIMING_COLUMNS)


@query("scan_column_dump", sql=lambda: f"""
    SELECT x, y, CAST(CASE WHEN category = 1 THEN 1 ELSE 0 END AS INTEGER) AS hit
    FROM ({point_sql()}) p""")
def q_scan_column_dump(spark, sf_dir):
    """Points as binary column dumps (int32 n, x[n], y[n], hit[n]), read back."""
    pts = load_points(spark, sf_dir).select(
        "x", "y", F.when(F.col("category") == 1, 1).otherwise(0).cast("int").alias("hit"))
    path = scratch_path(spark, "darts")
    FS.write_column_dump(pts, path)
    return FS.read_column_dump(spark, path).select("x", "y", "hit")


# ------------------------------------------------------------------ tables

def _point_table(spark, sf_dir):
    return load_points(spark, sf_dir)


@query("write_table_overwrite", sql=lambda: point_sql())
def q_write_table_overwrite(spark, sf_dir):
    """K1: writing the Point table twice with append = 0 leaves one copy."""
    path = scratch_path(spark, "point_tbl")
    pts = _point_table(spark, sf_dir)
    T.write_table(pts, path, append=False)
    T.write_table(pts, path, append=False)
    return T.read_table_at(spark, path)


@query("write_table_append", sql=lambda: f"SELECT * FROM ({point_sql()}) a UNION ALL SELECT * FROM ({point_sql()}) b")
def q_write_table_append(spark, sf_dir):
    """K2: writing the Point table, then appending it again, keeps both copies."""
    path = scratch_path(spark, "point_tbl")
    pts = _point_table(spark, sf_dir)
    T.write_table(pts, path, append=False)
    T.write_table(pts, path, append=True)
    return T.read_table_at(spark, path)


@query("clear_table", sql=lambda: f"SELECT * FROM ({point_sql()}) p WHERE 1 = 0")
def q_clear_table(spark, sf_dir):
    """K9: drop all rows of a table; the schema stays."""
    path = scratch_path(spark, "point_tbl")
    T.write_table(_point_table(spark, sf_dir), path, append=False)
    T.clear_table(spark, path)
    return T.read_table_at(spark, path)


@query("register_view", sql=lambda: point_sql())
def q_register_view(spark, sf_dir):
    """K8: a lazy named view over the stored table (``SELECT * FROM Point``)."""
    path = scratch_path(spark, "point_tbl")
    T.write_table(_point_table(spark, sf_dir), path, append=False)
    T.register_view(spark, "Point", path)
    return spark.sql("SELECT * FROM Point")


@query("union_chunks", sql=timestep_sql)
def q_union_chunks(spark, sf_dir):
    """A table is the union of all producers' chunks (one chunk per rank), duplicates kept."""
    path = scratch_path(spark, "timestep_chunks")
    T.write_chunks(timestep_view(spark, sf_dir), path, "rank")
    return T.read_chunks(spark, path, "rank").select("id", "rank", "natoms", "energy")


# ------------------------------------------------------------------ reply text

def _reply_sql() -> str:
    return f"""
    SELECT batch, string_agg(CAST(idx AS VARCHAR) || ' ' || CAST(sat AS VARCHAR), ' '
                             ORDER BY sat DESC, idx) AS reply
    FROM (SELECT batch, idx, abs(sat) AS sat FROM ({_history_sql()}) h WHERE abs(sat) > 3) r
    GROUP BY batch"""


@query("encode_result", sql=_reply_sql)
def q_encode_result(spark, sf_dir):
    """K6: per batch, the reply text ``"idx sat idx sat ..."`` (sat descending)."""
    from ..operators.reply import encode_reply
    return encode_reply(S.reports(history(spark, sf_dir)), by=["batch"])


@query("decode_result", sql=lambda: f"""
    SELECT batch, idx, CAST(sat AS DOUBLE) AS weight
    FROM (SELECT batch, idx, abs(sat) AS sat FROM ({_history_sql()}) h WHERE abs(sat) > 3) r""")
def q_decode_result(spark, sf_dir):
    """K7: the reply text parsed back to (idx, weight) pairs."""
    from ..operators.reply import decode_reply, encode_reply
    txt = encode_reply(S.reports(history(spark, sf_dir)), by=["batch"])
    return decode_reply(txt, by=["batch"]).select("batch", F.col("idx").cast("int").alias("idx"),
                                                  "weight")
