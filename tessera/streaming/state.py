"""Micro-batch ingestion and the stateful histogram with Structured Streaming.

* :func:`stage_batches` -- the producer side: rows go to a record table in
  processing order, one file per batch value (or per stretch of it); the
  table's commit log is the order in which a stream serves them, on any
  storage and whatever the files' times.
* :func:`ingest_micro_batches` (T1) -- a bounded stream over the table,
  appended to another by ``foreachBatch`` (each epoch writes its own
  sub-directory, so a replayed epoch overwrites itself: exactly-once); the
  producer can ask how far the consumer is.
* :func:`stateful_hist_stream` (T2) -- per micro-batch: read the state version
  of the previous epoch, compute histogram + saturation, write the history
  rows and the new state version.  State lives in files keyed by epoch, not
  in the driver; versions already written are skipped on replay.

A plain Parquet folder can be streamed, too; its files come in the order of
their modification times, and points out of order stop the histogram.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import Grid
from ..operators import histogram as H
from ..operators import state as S
from ..sources import commit as CM
from ..sources import struct_records as SR


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def stage_batches(df: DataFrame, path: str, batch_col: str = "batch",
                  order: str | None = None, append: bool = False) -> list:
    """Write ``df`` as a record table in batch order; returns the sorted batch values (a short list).

    Rows are range-partitioned and sorted on the batch and, if given,
    ``order``, so files follow each other in that order and each holds rows of
    one batch; a large batch is written by many tasks if ``order`` is given.
    The table changes in one commit.
    """
    by = [batch_col] + ([order] if order else [])
    SR.write_struct(df.repartitionByRange(*by).sortWithinPartitions(*by), path, SR.fields_of(df.schema), append=append,
                    split_by=batch_col)
    return sorted(r[0] for r in df.select(batch_col).distinct().collect())


def _run_stream(spark: SparkSession, source: str, schema, checkpoint: str,
                fn: Callable[[DataFrame, int], None], files_per_trigger: int = 1) -> None:
    """Run ``fn`` over all micro-batches that are there now."""
    if _exists(spark, f"{source}/{CM.LOG}"):
        rows = SR.stream_struct(spark, source, SR.fields_of(schema), max_files=files_per_trigger)
        q = rows.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        return
    q = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
         .parquet(source).writeStream.foreachBatch(fn)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def ingest_micro_batches(spark: SparkSession, source: str, table: str, checkpoint: str,
                         schema, files_per_trigger: int = 1) -> DataFrame:
    """Stream the files of ``source`` into the table at ``table``; returns the table."""

    def append(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/epoch={epoch}")

    _run_stream(spark, source, schema, checkpoint, append, files_per_trigger)
    return spark.read.parquet(table)


def stateful_hist_stream(spark: SparkSession, source: str, out: str, checkpoint: str,
                         schema, grid: Grid, cells: Callable[[DataFrame], DataFrame],
                         files_per_trigger: int = 1) -> DataFrame:
    """Carry the cell state from micro-batch to micro-batch; returns the history table.

    ``cells`` turns a raw micro-batch into points with ``gx, gy, idx, seq,
    batch, category``.  History rows: ``(batch, idx, n_points, dh, sat,
    h_after)``; points outside the grid go to ``<out>/rejects``.  The answer
    depends on the order of the points, so a micro-batch that starts at or
    before the last (batch, seq) of an earlier one raises; it is not put in
    the state.
    """
    state_root, hist_root = f"{out}/state", f"{out}/history"

    def update(batch: DataFrame, epoch: int) -> None:
        done = f"{state_root}/epoch={epoch}/_SUCCESS"
        if _exists(spark, done):  # replay of a finished epoch: nothing to do
            return
        prev = (spark.read.parquet(f"{state_root}/epoch={epoch - 1}") if epoch > 0
                else H.zero_grid(spark, grid).select("idx", "h"))
        assigned = cells(batch)
        pts, rejects = H.split_domain(assigned, grid)
        # points outside the grid are kept apart, not lost
        rejects.write.mode("overwrite").parquet(f"{out}/rejects/epoch={epoch}")
        span = assigned.agg(F.min(F.struct("batch", "seq")).alias("first"),
                            F.max(F.struct("batch", "seq")).alias("last"))
        span.write.mode("overwrite").parquet(f"{out}/span/epoch={epoch}")
        first = spark.read.parquet(f"{out}/span/epoch={epoch}").first()["first"]
        if epoch > 0 and first is not None:
            seen = (spark.read.parquet(f"{out}/span").where(F.col("epoch") < epoch)
                    .agg(F.max("last").alias("last")).first()["last"])
            if seen is not None and tuple(first) <= tuple(seen):
                raise ValueError(f"points arrived out of order: {tuple(first)} after {tuple(seen)}")
        # one micro-batch may hold several batches: history per (batch, idx) in (batch, seq) order
        hist = S.batch_history(pts, grid, state=prev).select(
            "batch", "idx", "n_points", "dh", "sat", "h_after")
        hist.write.mode("overwrite").parquet(f"{hist_root}/epoch={epoch}")
        # the new state follows from the (small) history just written: the last
        # h_after of each touched cell, the old state elsewhere -- no second pass
        # over the points
        last = (spark.read.parquet(f"{hist_root}/epoch={epoch}").groupBy("idx")
                .agg(F.max_by("h_after", "batch").alias("_h")))
        new_state = prev.join(F.broadcast(last) if grid.cells <= H.MAX_BROADCAST_CELLS else last,
                              "idx", "left").select(
            "idx", F.coalesce(F.col("_h"), F.col("h")).cast("bigint").alias("h"))
        new_state.write.mode("overwrite").parquet(f"{state_root}/epoch={epoch}")

    _run_stream(spark, source, schema, checkpoint, update, files_per_trigger)
    # A batch may span several micro-batches: saturation and counts add up,
    # the state after the batch is the one of its last micro-batch.
    h = spark.read.parquet(hist_root)
    return h.groupBy("batch", "idx").agg(
        F.sum("n_points").alias("n_points"), F.sum("dh").cast("bigint").alias("dh"),
        F.sum("sat").cast("bigint").alias("sat"),
        F.max_by("h_after", "epoch").cast("bigint").alias("h_after"))
