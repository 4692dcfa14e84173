"""Streaming, loop and analysis-registry queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.grid import cell_col, cell_index, cell_row
from ..operators import histogram as H
from ..operators import records as R
from ..operators.reshape import long_to_matrix, matrix_to_long
from ..session import scratch_path
from ..sources import files as FS
from ..sources import struct_records as SR
from ..streaming import adaptive as AD
from ..streaming import state as ST
from ..streaming.store import StateStore
from . import registry as REG
from .catalog import query
from .points import load_points, point_sql
from .q_curve import curve_segments
from .q_hist import G, _dense_state_sql, _hist_sql, _history_sql
from .records import timestep_sql, timestep_view


# files taken per micro-batch (a bound on in-flight data, like the reference's 4 blocks)
FILES_PER_TRIGGER = 4
# rounds that the checked summary of the adaptive loop runs
SUMMARY_ROUNDS = 4


def _staged_points(spark, sf_dir):
    """The Point table as a record table with one file per day or stretch of it (the producer side)."""
    pts = load_points(spark, sf_dir)
    src = scratch_path(spark, "point_stream")
    ST.stage_batches(pts, src, "batch", order="seq")
    return src, pts.schema


@query("ingest_micro_batches", sql=lambda: point_sql())
def q_ingest_micro_batches(spark, sf_dir):
    """Files arrive one per day; a streaming query appends each micro-batch to a table."""
    src, schema = _staged_points(spark, sf_dir)
    base = scratch_path(spark, "ingest")
    t = ST.ingest_micro_batches(spark, src, base + "/table", base + "/ckpt", schema,
                                files_per_trigger=FILES_PER_TRIGGER)
    return t.select("x", "y", "category", "seq", "batch")


@query("stateful_hist_stream", sql=_history_sql)
def q_stateful_hist_stream(spark, sf_dir):
    """T2 streamed: state carried across micro-batches (one per day) via versioned files."""
    src, schema = _staged_points(spark, sf_dir)
    base = scratch_path(spark, "stateful")

    def cells(batch):
        return H.assign_cells(batch, G)

    return ST.stateful_hist_stream(spark, src, base + "/out", base + "/ckpt", schema, G, cells,
                                   files_per_trigger=FILES_PER_TRIGGER)


@query("adaptive_hist")
def q_adaptive_hist(spark, sf_dir):
    """The adaptive loop; one round per day, as many draws as the day has events."""
    src, schema = _staged_points(spark, sf_dir)
    rounds = SR.scan_struct(spark, src, SR.fields_of(schema), columns=["seq", "batch"])
    days = [r[0] for r in rounds.select("batch").distinct().orderBy("batch").collect()]
    work = scratch_path(spark, "adaptive")
    return AD.adaptive_hist(spark, rounds, curve_segments(spark, sf_dir), G, work, days)


@query("adaptive_hist_summary", sql=lambda: f"""
    WITH days AS (SELECT batch, COUNT(*) AS n FROM ({point_sql()}) p GROUP BY batch ORDER BY batch LIMIT {SUMMARY_ROUNDS})
    SELECT CAST({G.cells} AS BIGINT) AS n_cells, COUNT(*) AS rounds_run, CAST(SUM(n) AS BIGINT) AS n_drawn,
           CAST({G.cells} AS BIGINT) AS n_weights_1_or_100, CAST(0 AS BIGINT) AS n_outside, true AS cells_tile_the_grid
    FROM days""")
def q_adaptive_hist_summary(spark, sf_dir):
    """What must hold after the loop's first rounds, whatever was drawn (a grid is not exhausted that early)."""
    src, schema = _staged_points(spark, sf_dir)
    rounds = SR.scan_struct(spark, src, SR.fields_of(schema), columns=["seq", "batch"])
    days = [r[0] for r in rounds.select("batch").distinct().orderBy("batch").collect()]
    out = AD.adaptive_hist(spark, rounds, curve_segments(spark, sf_dir), G, scratch_path(spark, "adaptive"), days,
                           max_rounds=SUMMARY_ROUNDS)
    area = F.sum((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")))
    return out.agg(
        F.count(F.lit(1)).alias("n_cells"), F.max("rounds_run").cast("long").alias("rounds_run"),
        F.max("n_drawn").cast("long").alias("n_drawn"),
        F.count(F.when(F.col("weight").isin(1.0, 100.0), 1)).alias("n_weights_1_or_100"),
        F.max("n_outside").cast("long").alias("n_outside"),
        (F.abs(area - (G.dmax - G.dmin) ** 2) < 1e-6).alias("cells_tile_the_grid"))


# ---------------------------------------------------------------- analyses

def _init(spark, inputs, state):
    return {"h": H.zero_grid(spark, G).select("idx", "h")}


def _update(spark, inputs, state):
    """Report and new state from one pass; points outside the grid are counted while the pass is written."""
    pts, seen = H.inside_counted(H.assign_cells(inputs["Point"], G), G, "Update")
    old = state.get("h")
    sat = H.saturation(pts, G, state=old)
    base = old if old is not None else H.zero_grid(spark, G)
    h = base.select("idx", "h").join(H._maybe_broadcast(sat.select("idx", "dh"), G), "idx", "left").select(
        "idx", (F.col("h") + F.coalesce("dh", F.lit(0))).alias("h"))
    told = H.counted(seen)
    rejects = spark.createDataFrame([(told["points"], told["outside"], told["null_bins"])],
                                    "points long, outside long, null_bins long")
    return {"report": H.report_saturated(H.hist_table(sat, G)), "h": h, "rejects": rejects}


def _printer(spark, inputs, state):
    """The stored state as it is: no points are read."""
    return state["h"].select("idx", cell_row("idx", G).alias("i"), cell_col("idx", G).alias("j"), "h")


def _count(spark, inputs, state):
    return R.reconcile_parent_child(inputs["Timestep"], inputs["Atom"], ["id", "rank"],
                                    ["timestep", "rank"]).select("n_mismatch")


def _analysis_script(spark, inputs, state):
    """Script with inputs df (points) and state h; outputs analysis, h and rejects (points that were left out)."""
    cells = H.assign_cells(inputs["df"], G)
    pts, rejects = H.split_domain(cells, G)
    sat = H.saturation(pts, G, state=state.get("h"))
    return {"analysis": H.hist_table(sat, G), "h": H.hist2d_signed(pts, G, state=state.get("h")), "rejects": rejects}


REG.register_analysis("Init", _init, outputs=["h"], keeps=["h"])
REG.register_analysis("Update", _update, deps=["Point"], outputs=["report", "h", "rejects"], keeps=["h", "rejects"],
                      returns="report")
REG.register_analysis("Printer", _printer)
REG.register_analysis("Count", _count, deps=["Timestep", "Atom"])


@query("run_analysis", sql=lambda: f"""
    SELECT * FROM (SELECT idx, abs(c3) AS sat FROM ({_hist_sql()}) h) s WHERE sat > 3""")
def q_run_analysis(spark, sf_dir):
    """``Init`` then ``Update`` by name, with the Point table as dependency."""
    st = REG.run_analysis(spark, "Init")
    return REG.run_analysis(spark, "Update", {"Point": load_points(spark, sf_dir)}, state=st)


@query("register_analysis", sql=lambda: f"""
    SELECT CAST(SUM(CASE WHEN COALESCE(p.natoms, 0) <> COALESCE(c.n, 0) THEN 1 ELSE 0 END) AS BIGINT)
             AS n_mismatch
    FROM ({timestep_sql()}) p FULL OUTER JOIN
         (SELECT l_orderkey AS timestep, CAST(l_orderkey % 7 AS INTEGER) AS rank, COUNT(*) AS n
          FROM lineitem GROUP BY 1, 2) c
    ON p.id = c.timestep AND p.rank = c.rank""")
def q_register_analysis(spark, sf_dir):
    """a user analysis registered under a name (``Count``) and run on two tables."""
    from .q_parent import atom_base
    return REG.run_analysis(spark, "Count", {"Timestep": timestep_view(spark, sf_dir),
                                             "Atom": atom_base(spark, sf_dir)})


@query("script_with_named_io", sql=lambda: f"""
    SELECT idx, h, c1, c2, c3 FROM ({_dense_state_sql()}) d JOIN ({_hist_sql()}) a USING (idx)""")
def q_script_with_named_io(spark, sf_dir):
    """script with named inputs (df, state) and declared outputs; returns both, side by side."""
    st = REG.run_analysis(spark, "Init")
    res = (REG.Script(_analysis_script).input("df", load_points(spark, sf_dir))
           .with_state(st).as_val("analysis").as_val("h").execute(spark))
    return res["h"].join(res["analysis"], "idx").select("idx", "h", "c1", "c2", "c3")


# ---------------------------------------------------------------- state set-up

@query("zero_grid", sql=lambda: f"""
    SELECT g.idx, g.i, g.j, CAST(0 AS BIGINT) AS h, g.h AS replaced FROM ({_dense_state_sql()}) g""")
def q_zero_grid(spark, sf_dir):
    """The zero state, shaped like the current one, beside the value it replaces in every cell."""
    from .q_matrix import dense_state
    st = dense_state(spark, sf_dir)  # the state computed from the points, long form (i, j, value)
    zeros = H.zeros_like(st, G)
    return zeros.join(st, ["i", "j"]).select("idx", "i", "j", "h", F.col("value").alias("replaced"))


@query("state_init", sql=lambda: f"SELECT idx, CAST(0 AS BIGINT) AS h, d.h AS replaced FROM ({_dense_state_sql()}) d")
def q_state_init(spark, sf_dir):
    """``Init`` puts a zero state over the one an ``Update`` over all points stored; both versions side by side."""
    store = StateStore(spark, scratch_path(spark, "state"))
    REG.run_analysis(spark, "Update", {"Point": load_points(spark, sf_dir)}, state=store)
    updated = store.latest("h")
    REG.run_analysis(spark, "Init", state=store)
    return store["h"].join(store.get("h", version=updated).withColumnRenamed("h", "replaced"), "idx").select(
        "idx", "h", "replaced")


@query("state_dump", sql=lambda: f"SELECT idx, i, j, h FROM ({_dense_state_sql()}) d")
def q_state_dump(spark, sf_dir):
    """T4: ``Init``, ``Update`` over all points, then ``Printer``: the stored version as matrix CSV and sidecar, read back."""
    store = StateStore(spark, scratch_path(spark, "state"))
    REG.run_analysis(spark, "Init", state=store)
    REG.run_analysis(spark, "Update", {"Point": load_points(spark, sf_dir)}, state=store)
    path = scratch_path(spark, "state_csv")
    dumped = REG.run_analysis(spark, "Printer", state=store)
    FS.write_matrix_csv(long_to_matrix(dumped, G.n, value="h"), path)
    cells = matrix_to_long(FS.read_matrix_csv(spark, path, G.n, value_type="long"), "i", "c", "h")
    return cells.select("i", F.substring("c", 2, 9).cast("int").alias("j"), "h").select(
        cell_index("i", "j", G).alias("idx"), "i", "j", "h")
