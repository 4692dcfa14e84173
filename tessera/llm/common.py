"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tessera.session import scratch_path, ship_package

#: Input rows handed to one Python call at a time; bounds what a task holds of very long texts.
ROWS_PER_STEP = 256


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder, read back.

    Cuts the lineage with files every executor can read, and lets the planner
    see the real size of the table (so a broadcast is chosen only below the
    session's threshold).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``ROWS_PER_STEP``."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_PER_STEP):
            yield batch.slice(at, ROWS_PER_STEP)


def grouped(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """(key, columns) of each run of rows that agree in their first ``n`` columns.

    For rows dealt and sorted by those columns; a group is held at a time.
    """
    rows = (r for b in steps(batches) for r in zip(*(c.to_pylist() for c in b.columns)))
    for key, found in groupby(rows, key=lambda r: r[:n]):
        yield key, list(zip(*found))


#: What this worker keeps for later tasks, of one stage at a time.
_KEPT: dict[Hashable, object] = {}


def kept(key: Hashable, build: Callable[[], object]) -> object:
    """``build()``, kept by this worker for later tasks that ask for ``key``; what was kept under another goes."""
    if key not in _KEPT:
        forget()
        _KEPT[key] = build()
    return _KEPT[key]


def forget() -> None:
    if _KEPT:
        _KEPT.clear()
        give_back()


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int]:
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda pad: 0)  # glibc only


def give_back() -> None:
    """Return this worker's free memory to the system, where other workers and stages need it."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def tidy(run: Callable[[Iterator], Iterator], keep: bool = False) -> Callable[[Iterator], Iterator]:
    """``run`` for ``mapInArrow`` in workers that serve stage after stage, so that their memory doesn't add up.

    What other stages kept goes before it (not with ``keep``), and free memory after it.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keep:
            forget()
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def python_ready(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers."""
    ship_package(spark)


def file_bytes(path: str) -> bytes:
    """A vocabulary file (a few MB, a fixed size) read on the driver to be broadcast."""
    with open(path, "rb") as f:
        return f.read()
