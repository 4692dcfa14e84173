"""Record tables change in one step; dumps are read by ranges; the record stream keeps its own offsets."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.session import scratch_path
from tessera.sources import commit as CM
from tessera.sources import files as FS
from tessera.sources import struct_records as SR

STEP = "id", "rank", "natoms", "energy"


def steps(spark, n, at=0):
    return spark.range(at, at + n).select("id", F.lit(0).alias("rank"), F.lit(1).alias("natoms"),
                                          (F.col("id") * 0.5).alias("energy"))


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def data_files(path):
    return sorted(f for f in os.listdir(path.replace("file:", "")) if not f.startswith(("_", ".")))


@pytest.mark.parametrize("append", [False, True])
def test_failing_write_leaves_the_old_table(spark, append):
    path = scratch_path(spark, "crash")
    SR.write_struct(steps(spark, 10).repartition(4), path, SR.TIMESTEP)
    before = data_files(path)
    bad = steps(spark, 40, 100).repartition(4).withColumn(
        "energy", F.when(F.col("id") == 117, F.raise_error(F.lit("cut off")).cast("double")).otherwise(F.col("energy")))
    with pytest.raises(Exception, match="cut off"):
        SR.write_struct(bad, path, SR.TIMESTEP, append=append)
    assert ids(SR.scan_struct(spark, path, SR.TIMESTEP)) == list(range(10))
    assert set(before) <= set(data_files(path))
    rows = SR.write_struct(steps(spark, 3, 50), path, SR.TIMESTEP, append=True)
    # tasks that were still running when the write was given up may leave files; the next commit takes them away
    assert len(data_files(path)) == len(before) + rows.count()
    assert ids(SR.scan_struct(spark, path, SR.TIMESTEP)) == [*range(10), 50, 51, 52]


def test_table_rewritten_from_itself(spark):
    path = scratch_path(spark, "self")
    SR.write_struct(steps(spark, 20).repartition(3), path, SR.TIMESTEP)
    for n in (1, 2, 3):
        SR.write_struct(SR.scan_struct(spark, path, SR.TIMESTEP).withColumn("id", F.col("id") + 1), path, SR.TIMESTEP)
        assert ids(SR.scan_struct(spark, path, SR.TIMESTEP)) == list(range(n, 20 + n))
    fs, root = CM.fs_and_path(path)
    assert len(CM.current(CM.log_versions(fs, root))) == 1


def test_nulls_and_values_too_large_stop_the_write(spark):
    path = scratch_path(spark, "nulls")
    df = spark.createDataFrame([(1, 1, None, 0.5)], "id long, rank int, natoms int, energy double")
    with pytest.raises(Exception, match="'natoms', row 0 .* null"):
        SR.write_struct(df, path, SR.TIMESTEP)
    big = spark.createDataFrame([(1, 1 << 40, 1, 0.5)], "id long, rank long, natoms int, energy double")
    with pytest.raises(Exception, match="'rank'"):
        SR.write_struct(big, path, SR.TIMESTEP)
    dots = spark.createDataFrame([(1.0, None, 1)], "x double, y double, hit int")
    with pytest.raises(Exception, match="'y', row 0 .* null"):
        FS.write_column_dump(dots, path)


def test_foreign_files_are_kept_and_taken_in(spark, tmp_path):
    arr = np.zeros(3, dtype=SR.record_dtype(SR.TIMESTEP))
    arr["id"] = [7, 8, 9]
    (tmp_path / "sim.bin").write_bytes(arr.tobytes())
    SR.write_struct(steps(spark, 2), str(tmp_path), SR.TIMESTEP, append=True)
    assert ids(SR.scan_struct(spark, str(tmp_path), SR.TIMESTEP)) == [0, 1, 7, 8, 9]
    (tmp_path / "note.txt").write_text("not of the table")
    for _ in range(3):
        SR.write_struct(steps(spark, 2), str(tmp_path), SR.TIMESTEP)
    assert ids(SR.scan_struct(spark, str(tmp_path), SR.TIMESTEP)) == [0, 1]
    assert (tmp_path / "note.txt").exists()


def test_empty_writes(spark):
    path = scratch_path(spark, "none")
    assert SR.write_struct(steps(spark, 0), path, SR.TIMESTEP).count() == 0
    assert SR.scan_struct(spark, path, SR.TIMESTEP).count() == 0
    FS.write_column_dump(spark.createDataFrame([], "x double, y double, hit int"), path + "-dump")
    assert FS.read_column_dump(spark, path + "-dump").count() == 0


def test_a_dump_is_read_by_row_ranges(spark):
    path = scratch_path(spark, "dump")
    df = spark.range(4000).select((F.col("id") * 0.5).alias("x"), (F.col("id") * -0.25).alias("y"),
                                  (F.col("id") % 2).cast("int").alias("hit"))
    FS.write_column_dump(df.coalesce(1), path)
    got = FS.read_column_dump(spark, path, rows_per_partition=1000)
    per = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert per == [1000] * 4
    assert got.select("x", "y", "hit").exceptAll(df).count() == 0
    assert [r.pos for r in got.orderBy("pos").collect()] == list(range(4000))
    no_hit = scratch_path(spark, "dump")
    FS.write_column_dump(df.coalesce(1), no_hit, hit=None, max_rows_per_file=1500)
    back = FS.read_column_dump(spark, no_hit, with_hit=False, rows_per_partition=999)
    assert back.columns == ["file", "pos", "x", "y"] and back.select("x", "y").exceptAll(df.select("x", "y")).count() == 0


def drained(spark, path, out, ckpt, limit, consumer="c"):
    sizes = []

    def take(batch, epoch):
        sizes.append(batch.count())
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    q = (SR.stream_struct(spark, path, SR.TIMESTEP, consumer, limit).writeStream.foreachBatch(take)
         .option("checkpointLocation", ckpt).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return sizes


def test_record_stream_bounds_batches_and_resumes(spark):
    path, base = scratch_path(spark, "feed"), scratch_path(spark, "drain")
    SR.write_struct(steps(spark, 25).coalesce(1), path, SR.TIMESTEP)
    SR.write_struct(steps(spark, 10, 25).coalesce(1), path, SR.TIMESTEP, append=True)
    assert drained(spark, path, base + "/o", base + "/c", 10) == [10, 10, 10, 5]
    first = spark.read.parquet(base + "/o/epoch=0")
    assert ids(first) == list(range(10))
    SR.write_struct(steps(spark, 12, 35).coalesce(1), path, SR.TIMESTEP, append=True)
    assert drained(spark, path, base + "/o", base + "/c", 10) == [10, 2]  # a new query on the same checkpoint
    assert ids(spark.read.parquet(base + "/o")) == list(range(47))
    assert SR.acknowledged(path)["c"] <= (4, 0) and SR.acknowledged(path)["c"] >= (3, 10)
    assert drained(spark, path, base + "/o2", base + "/c2", 1000, "other") == [47]


def test_record_stream_serves_versions_in_order(spark):
    path, base = scratch_path(spark, "feed"), scratch_path(spark, "drain")
    for version in (3, 2):  # a later producer is done first
        SR.write_struct(steps(spark, 5, 10 * version), path, SR.TIMESTEP, append=True, version=version)
    SR.write_struct(steps(spark, 5, 10), path, SR.TIMESTEP, append=True, version=1)
    drained(spark, path, base + "/o", base + "/c", 5)
    per = [ids(spark.read.parquet(f"{base}/o/epoch={k}")) for k in range(3)]
    assert per == [list(range(10 * v, 10 * v + 5)) for v in (1, 2, 3)]
    with pytest.raises(Exception, match="committed already"):
        SR.write_struct(steps(spark, 1), path, SR.TIMESTEP, append=True, version=2)


def test_record_stream_stops_when_the_table_is_replaced(spark):
    path, base = scratch_path(spark, "feed"), scratch_path(spark, "drain")
    SR.write_struct(steps(spark, 5), path, SR.TIMESTEP)
    drained(spark, path, base + "/o", base + "/c", 100)
    SR.write_struct(steps(spark, 5, 100), path, SR.TIMESTEP)
    with pytest.raises(Exception, match="under a running stream"):
        drained(spark, path, base + "/o", base + "/c", 100)


def test_append_query_has_no_task_with_all_rows(spark, tmp_path, monkeypatch):
    """the overwrite in between went through one task."""
    from tessera.plans import q_io
    spark.range(2000).select(F.col("id").alias("o_orderkey"), F.lit(1.5).alias("o_totalprice")).repartition(4).write.parquet(
        f"{tmp_path}/orders.parquet")
    spark.range(3000).select((F.col("id") % 1500).alias("l_orderkey")).repartition(4).write.parquet(
        f"{tmp_path}/lineitem.parquet")
    table = f"file://{tmp_path}/table"
    monkeypatch.setattr(q_io, "scratch_path", lambda spark, name: table)
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled",
                                           "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = q_io.q_append_struct_records(spark, str(tmp_path))
        assert got.groupBy("id").count().filter("count = 2").count() == 2000
        assert got.groupBy().sum("natoms").first()[0] == 6000
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    rows = [f.rows for f in CM.table_files(table)]
    assert sum(rows) == 4000 and max(rows) < 1000
