"""Row blocks, saturation summaries, ranks, the clamped walk, rejects, stored state: hot, null and odd inputs."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions.grid import Grid
from tessera.functions.scalar import clamp, label_sign, linspace_points
from tessera.operators import curve as C
from tessera.operators import histogram as H
from tessera.operators import records as R
from tessera.operators import reshape as RS
from tessera.plans import q_io, registry as REG
from tessera.plans.points import load_points
from tessera.session import scratch_path
from tessera.sources import files as FS
from tessera.streaming.store import NoState, StateStore
from tests.conftest import SF_SMALL

G = Grid(8)


# ------------------------------------------------------------------ blocks

def test_two_levels_of_blocks(spark):
    """10 rows a block need more ranges than the first level has."""
    df = spark.range(30_000).select((F.col("id") * F.col("id")).alias("k"))
    per = RS.row_blocks(df, "k", 10, "b").groupBy("b").agg(
        F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("b").collect()
    assert len(per) > RS.FIRST_RANGES and max(r.n for r in per) <= 20
    assert all(a.hi < b.lo for a, b in zip(per, per[1:]))


def test_cut_points_do_not_grow_with_the_rows(spark):
    few, many = (RS.row_blocks(spark.range(n).toDF("k"), "k", 10, "b") for n in (20_000, 200_000))
    sizes = [len(d._jdf.queryExecution().optimizedPlan().toString()) for d in (few, many)]
    assert sizes[1] < 1.2 * sizes[0]


def test_blocks_of_nulls_and_nan(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), *((float(k),) for k in range(50))], "k double")
    got = {str(r.k): r.b for r in RS.row_blocks(df, "k", 10, "b").collect()}
    assert got["None"] == 0 and got["nan"] == max(got.values()) > 1
    empty = RS.row_blocks(df.limit(0), "k", 10, "b")
    assert empty.count() == 0 and "b" in empty.columns


# ------------------------------------------------------------------ saturation

def walk(rows, state):
    """The reference's loop: (batch, idx) -> n, dh, sat, h_after."""
    h, out = dict(state), {}
    for batch, _, idx, b in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        n, dh, sat, _ = out.get((batch, idx), (0, 0, 0, 0))
        prev = h.get(idx, 0)
        step = b or 0
        h[idx] = prev + step
        out[batch, idx] = (n + 1, dh + step, sat + (0 if b is None else b + abs(prev)), h[idx])
    return out


@pytest.mark.parametrize("block_rows", [7, 1 << 20])
def test_saturation_equals_the_walk(spark, block_rows):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 2, 3]), k, 5 if rng.random() < 0.6 else rng.randint(1, 64),
             rng.choice([1, -1, 1, None]) if k % 50 == 0 else rng.choice([1, -1, -1])) for k in range(900)]
    rows += [(9, 900 + k, 7, 1) for k in range(300)]  # a straight run in one cell
    state = [(k, (k % 5) - 2) for k in range(1, 65)]
    pts = spark.createDataFrame(rows, "batch int, seq long, idx int, category int").repartition(5)
    st = spark.createDataFrame(state, "idx int, h long")
    got = H.saturation(pts, G, state=st, order=("batch", "seq"), by=("batch",), block_rows=block_rows)
    assert {(r.batch, r.idx): (r.n_points, r.dh, r.sat, r.h_after) for r in got.collect()} == walk(rows, state)
    whole = H.saturation(pts, G, state=st, order=("batch", "seq"), block_rows=block_rows).collect()
    assert sum(r.n_points for r in whole) == len(rows)


def test_a_block_is_summarised_not_listed(spark):
    pts = spark.range(20_000).select(F.lit(3).alias("idx"), F.col("id").alias("seq"),
                                     F.when(F.xxhash64("id") % 2 == 0, 1).otherwise(-1).alias("category"))
    assert H.block_summaries(pts).count() < 2000  # the values that a walk of 20,000 steps visits


def test_the_points_are_read_once_after_the_cuts(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(2000).select(F.lit(3).alias("idx"), F.col("id").alias("seq"), F.lit(1).alias("category")).write.parquet(path)
    made = H.block_summaries(spark.read.parquet(path), block_rows=100)
    plan = made._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("Scan parquet") == 1 and plan.count("Exchange") <= 2  # explain lists the initial plan only


# ------------------------------------------------------------------ rejects

def test_points_with_a_null_bin_are_rejects(spark):
    pts = spark.createDataFrame([(1, 5.0, 5.0), (2, None, 5.0), (3, 500.0, 5.0)], "seq long, x double, y double")
    inside, out = H.split_domain(H.assign_cells(pts, G), G)
    assert [r.seq for r in inside.collect()] == [1] and sorted(r.seq for r in out.collect()) == [2, 3]
    kept, seen = H.inside_counted(H.assign_cells(pts, G), G)
    assert kept.count() == 1
    assert H.counted(seen) == {"points": 3, "outside": 1, "null_bins": 1}
    with pytest.raises(H.PointsOutside, match="1 points outside the grid and 1 without a bin, of 3"):
        H.no_rejects(seen)


# ------------------------------------------------------------------ stored state

def test_analyses_keep_versions_of_the_state(spark):
    store = StateStore(spark, scratch_path(spark, "store"))
    with pytest.raises(NoState):
        store["h"]
    pts = spark.createDataFrame([(5.0, 5.0, 1, 1, 1), (5.0, 5.0, 1, 2, 1), (500.0, 5.0, 1, 3, 1), (None, 5.0, 1, 4, 1)],
                                "x double, y double, category int, seq long, batch int")
    REG.run_analysis(spark, "Init", state=store)
    for _ in range(3):
        report = REG.run_analysis(spark, "Update", {"Point": pts}, state=store)
    # |sat|: 1+0 + 1+1 on zero; 1+2 + 1+3 on two; 1+4 + 1+5 on four
    assert [r.sat for r in report.collect()] == [11]
    assert store.latest("h") == 4 and store.note("h") == {"analysis": "Update"}
    assert [store.get("h", version=v).agg(F.sum("h")).first()[0] for v in (1, 2, 3, 4)] == [0, 2, 4, 6]
    assert tuple(store["rejects"].first()) == (4, 1, 1)
    dumped = REG.run_analysis(spark, "Printer", state=StateStore(spark, store.root))  # as another session would
    assert dumped.agg(F.sum("h")).first()[0] == 6
    assert "events" not in dumped._jdf.queryExecution().toString()
    with pytest.raises(NoState):
        store.get("h", version=9)


def test_update_of_no_points(spark):
    store = StateStore(spark, scratch_path(spark, "store"))
    none = load_points(spark, SF_SMALL).limit(0)
    assert REG.run_analysis(spark, "Update", {"Point": none}, state=store).count() == 0
    assert store["h"].agg(F.sum("h")).first()[0] == 0


def test_a_failing_update_keeps_the_old_state(spark):
    store = StateStore(spark, scratch_path(spark, "store"))
    REG.run_analysis(spark, "Init", state=store)
    bad = load_points(spark, SF_SMALL).withColumn("category", F.raise_error(F.lit("cut off")).cast("int"))
    with pytest.raises(Exception, match="cut off"):
        REG.run_analysis(spark, "Update", {"Point": bad}, state=store)
    assert store.latest("h") == 1


# ------------------------------------------------------------------ ranks

def test_ranks_of_null_groups_and_of_hot_groups(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, "a", "a", "a", "b"]), rng.choice([None, 1, 2, 3, 4]), rng.randint(0, 400)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, o1 int, o2 int").repartition(6)
    want = df.withColumn("n", (F.row_number().over(Window.partitionBy("g").orderBy("o1", "o2")) - 1).cast("int"))
    for group_rows in (1 << 20, 40):
        got = R.rank_within(df, ["g"], ["o1", "o2"], name="n", group_rows=group_rows)
        assert got.exceptAll(want).count() == 0 and got.count() == want.count()
        assert got.dtypes == want.dtypes
    nulls = spark.createDataFrame([(None, k) for k in (3, 1, 2)], "g string, o int")
    assert sorted(r.n for r in R.rank_within(nulls, ["g"], ["o"], name="n").collect()) == [0, 1, 2]
    nan = spark.createDataFrame([(float("nan"), k) for k in (3, 1, 2)], "g double, o int")
    assert sorted(r.n for r in R.rank_within(nan, ["g"], ["o"], name="n", start=1, group_rows=1).collect()) == [1, 2, 3]


def test_a_hot_group_is_ranked_in_many_windows(spark):
    df = spark.range(5000).select(F.lit(1).alias("g"), F.xxhash64("id").alias("o"))
    got = R.rank_within(df, ["g"], ["o"], name="n", group_rows=100)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.split("\n") if "row_number()" in x and "Window" in x]
    assert windows and all("_rng" in x for x in windows)
    assert sorted(r.n for r in got.collect()) == list(range(5000))


# ------------------------------------------------------------------ clamped walk

@pytest.mark.parametrize("block_rows", [16, 1 << 20])
def test_clamped_walk_keeps_null_keys_and_orders(spark, block_rows):
    rng = random.Random(8)
    rows = [(k, o * o * 1000, rng.choice([None, *range(-30, 31)])) for k in (None, 1, 2) for o in range(70)]
    rows += [(2, None, 9), (None, None, -9)]
    df = spark.createDataFrame(rows, "k int, o long, d int").repartition(5)
    got = {(r.k, r.o): r.v for r in C.clamped_running_sum(df, ["k"], "o", "d", block_rows=block_rows).collect()}
    want = {}
    for key in (None, 1, 2):
        v = 0.0
        for _, o, d in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0)):
            v = max(25.0, min(75.0, v + (d or 0)))
            want[key, o] = v
    assert got == want


# ------------------------------------------------------------------ labels, accounting, sequences, tables

def test_unknown_curve_has_no_label(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0), (None, 2.0), (1.0, None)], "c double, y double")
    assert [r[0] for r in df.select(label_sign("c", "y")).collect()] == [-1, -1, 1, None, None]
    assert [r[0] for r in df.select(clamp("c", 1.5, 2.5)).collect()] == [1.5, 2.0, 2.5, None, 1.5]


def test_points_of_a_curve_without_segments(spark):
    one = C.segments(spark.createDataFrame([(0.0, 1.0)], "kx double, ky double"))
    pts = spark.createDataFrame([(1, 5.0, 5.0)], "seq long, x double, y double")
    got = C.bucketed_range_join(pts, "x", one, "x_lo", "x_hi", 0.0, 100.0, closed_last="last")
    assert [r[0] for r in got.select(label_sign(C.segment_value("x"), "y")).collect()] == [None]


def test_ranks_without_steps_or_atoms_are_accounted(spark):
    steps = spark.createDataFrame([(0,), (0,), (1,), (None,)], "rank int")
    atoms = spark.createDataFrame([(1,), (2,), (None,)], "rank int")
    got = sorted(map(tuple, R.account_bytes(steps, atoms).collect()), key=str)
    assert got == sorted([(0, 2, 0, 48), (1, 1, 1, 96), (2, 0, 1, 72), (None, 1, 1, 96)], key=str)


def test_linspace_in_chunks(spark):
    def values(n):
        row = spark.createDataFrame([(n,)], "n long")
        return [(r.k, r.x) for r in linspace_points(row, "n", 1.0, 2.0, chunk=10).orderBy("k").collect()]
    assert [k for k, _ in values(101)] == list(range(101)) and math.isclose(values(101)[-1][1], 2.0)
    assert values(1) == [(0, 1.0)] and values(0) == []


def test_timing_table_has_seven_columns(spark):
    rows = q_io.timing_table(spark, SF_SMALL).collect()
    assert rows[0].__fields__ == list(FS.TIMING_COLUMNS) and {r.Method for r in rows} == {"ring", "fs"}
    assert all(r.Transfer > 0 and r.Analysis > 0 and math.isclose(r.Total, r.Transfer + r.Analysis) for r in rows)


def test_matrix_sidecar_counts_what_was_written(spark, tmp_path):
    wide = spark.createDataFrame([(k, k % 2, 0.5) for k in range(40)], "i int, C1 int, C2 double").repartition(8)
    path = str(tmp_path / "m")
    FS.write_matrix_csv(wide, path, created="2020-01-01 00:00:00 UTC")
    meta = FS.read_matrix_meta(spark, path + ".mtd").first()
    assert (meta.rows, meta.cols, meta.nnz, meta.value_type) == (40, 2, 60, "double")
    assert meta.created == "2020-01-01 00:00:00 UTC" and set(meta.__fields__) == set(FS.MATRIX_META_KEYS)
