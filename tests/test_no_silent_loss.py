"""Inputs that once lost rows or changed the answer without a word."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera import session
from tessera.functions.grid import Grid, bin_assign, signed_abs
from tessera.operators import curve as C
from tessera.operators import histogram as H
from tessera.operators import mlp as NN
from tessera.operators import reshape as RS
from tessera.session import scratch_path
from tessera.sources import files as FS
from tessera.sources import struct_records as SR
from tessera.streaming import state as ST

G = Grid(8)


def test_struct_file_with_a_cut_row_raises(spark, tmp_path):
    arr = np.zeros(10, dtype=SR.record_dtype(SR.POINT))
    (tmp_path / "p.bin").write_bytes(arr.tobytes()[:-5])
    with pytest.raises(Exception, match="no whole number of rows"):
        SR.scan_struct(spark, str(tmp_path / "p.bin"), SR.POINT).count()


def test_struct_rewrite_leaves_no_old_rows_and_append_keeps_them(spark):
    df = spark.range(10).select("id", F.lit(0).alias("rank"), F.lit(1).alias("natoms"), F.lit(0.5).alias("energy"))
    path = scratch_path(spark, "rewrite")
    SR.write_struct(df.repartition(4), path, SR.TIMESTEP)
    SR.write_struct(df.coalesce(1), path, SR.TIMESTEP)
    assert SR.scan_struct(spark, path, SR.TIMESTEP).count() == 10
    SR.write_struct(df, path, SR.TIMESTEP, append=True)
    assert SR.scan_struct(spark, path, SR.TIMESTEP).count() == 20


def test_column_dump_rewrite_any_name_and_cut_file(spark, tmp_path):
    df = spark.range(10).select((F.col("id") * 0.5).alias("x"), (F.col("id") * 0.25).alias("y"),
                                F.lit(1).alias("hit"))
    path = str(tmp_path / "dump")
    FS.write_column_dump(df.repartition(4), path)
    FS.write_column_dump(df.coalesce(1), path)
    assert FS.read_column_dump(spark, path).count() == 10
    one = next((tmp_path / "dump").glob("*.dat"))
    (tmp_path / "dump" / "other.bin").write_bytes(one.read_bytes())
    assert FS.read_column_dump(spark, path).count() == 20
    assert FS.read_column_dump(spark, path, pattern="*.dat").count() == 10
    (tmp_path / "dump" / "cut.bin").write_bytes(one.read_bytes()[:-4])
    with pytest.raises(Exception, match="do not hold"):
        FS.read_column_dump(spark, path).count()


def test_null_order_keys_stay(spark):
    pts = spark.createDataFrame([(1, None, 1, 1), (1, 1, 2, -1), (1, None, 3, 1)],
                                "idx int, batch int, seq long, category int")
    got = {r.seq: r.prev for r in H.state_before_row(pts, G, order=("batch", "seq")).collect()}
    assert got == {1: 0, 3: 1, 2: 2}


@pytest.mark.parametrize("key", [
    "id * 2000000",                                          # sparse
    "id / 1000.0",                                           # fractional
    "if(id < 3900, id / 1000000.0, cast(id AS double))",     # clustered
])
def test_blocks_hold_a_bounded_number_of_rows(spark, key):
    df = spark.range(4000).select(F.expr(key).alias("k"), F.lit(1).alias("category"), F.lit(1).alias("idx"))
    sizes = [r["count"] for r in RS.row_blocks(df, "k", 500, "b").groupBy("b").count().collect()]
    assert len(sizes) >= 7 and max(sizes) <= 1000
    got = RS.row_index(df, key="k", name="row", block_rows=500)
    want = df.withColumn("row", F.row_number().over(Window.orderBy("k")).cast("long"))
    assert got.select("k", "row").exceptAll(want.select("k", "row")).count() == 0
    prev = H.state_before_row(df, G, order=("k",), block_rows=500)  # all in one hot cell
    assert prev.select("k", "prev").exceptAll(want.select("k", (F.col("row") - 1).alias("prev"))).count() == 0


def test_scoring_null_and_ragged_vectors(spark):
    d = spark.range(1).select(F.lit(2).alias("D"))
    params = NN.mlp_init(d)
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [3.0, 4.0]), (4, [1.0, None])],
                               "vec_id long, embedding array<double>").coalesce(1)
    got = {r.vec_id: r.probs for r in NN.score_batches(df, "embedding", params, ["vec_id"], ["probs"]).collect()}
    alone = NN.score_batches(df.where("vec_id = 3"), "embedding", params, ["vec_id"], ["probs"]).first().probs
    assert got[2] is None and got[4] is None and got[3] == alone and len(got[1]) == 2
    bad = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0, 4.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="network takes 2"):
        NN.score_batches(bad, "embedding", params, ["vec_id"], ["probs"]).collect()


def test_bins_of_a_grid_that_does_not_start_at_zero(spark):
    g = Grid(10, 100.0, 200.0)
    got = spark.createDataFrame([(105.0,), (110.0,), (200.0,), (100.0,)], "v double").select(
        bin_assign("v", g).alias("b")).collect()
    assert [r.b for r in got] == [1, 1, 10, 0]


def test_absolute_value_of_large_integers(spark):
    n = (1 << 60) + 1
    assert spark.range(1).select(signed_abs(F.lit(-n)).alias("a")).first().a == n


def test_matrix_rows_over_several_files(spark, tmp_path):
    (tmp_path / "part-00000.csv").write_text("C1,C2\n1,2\n")
    (tmp_path / "part-00001.csv").write_text("C1,C2\n" + "".join(f"{k},{k}\n" for k in range(10, 200)))
    rows = FS.read_matrix_csv(spark, str(tmp_path), 2, value_type="long").collect()
    assert [(r.i, r.C1) for r in sorted(rows)][:3] == [(1, 1), (2, 10), (3, 11)]


def test_rows_outside_all_intervals_and_knots_without_width(spark):
    iv = spark.createDataFrame([(0, 0.0, 5.0)], "seg int, lo double, hi double")
    pts = spark.createDataFrame([(1, 2.0), (2, 9.0)], "id long, x double")
    got = {r.id: r.seg for r in C.bucketed_range_join(pts, "x", iv, "lo", "hi", 0.0, 10.0, buckets=4).collect()}
    assert got == {1: 0, 2: None}
    knots = spark.createDataFrame([(0.0, 1.0), (0.0, 2.0), (1.0, 3.0)], "kx double, ky double")
    assert sorted(r.slope for r in C.segments(knots).collect())[0] == 0.0


def test_stream_refuses_points_out_of_order_and_keeps_rejects(spark):
    schema = "x double, y double, category int, seq long, batch int"
    src, base = scratch_path(spark, "src"), scratch_path(spark, "st")

    def run():
        return ST.stateful_hist_stream(spark, src, base + "/out", base + "/c",
                                       spark.createDataFrame([], schema).schema, G, lambda b: H.assign_cells(b, G))

    spark.createDataFrame([(5.0, 5.0, 1, 10, 2), (500.0, 5.0, 1, 11, 2)], schema).coalesce(1).write.parquet(src)
    assert run().count() == 1
    assert spark.read.parquet(base + "/out/rejects").count() == 1
    spark.createDataFrame([(5.0, 5.0, 1, 1, 1)], schema).coalesce(1).write.mode("append").parquet(src)
    with pytest.raises(Exception, match="out of order"):
        run()


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_matrix_rows_are_numbered_on_many_tasks(spark, tmp_path):
    for k in range(4):
        lines = [f"{k * 50 + r},{r}" for r in range(50)]
        (tmp_path / f"part-{k}.csv").write_text("\n".join(["C1,C2", *lines]) + "\n")
    read = FS.read_matrix_csv(spark, str(tmp_path), 2, value_type="long")
    assert sorted((r.i, r.C1) for r in read.collect()) == [(n + 1, n) for n in range(200)]
    assert dict(read.dtypes)["i"] == "int"
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.split("\n") if "row_number()" in x and "Window" in x]
    # a window's partition keys are listed before its order
    assert windows and all("_file" in (keys := x.split("], [")[1]) and "ASC" not in keys for x in windows), plan
