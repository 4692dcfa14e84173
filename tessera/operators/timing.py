"""The reference's timing table (S5): one row per method and producer, times measured."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .records import account_bytes


def timed(transfer: Callable[[], object], analysis: Callable[[], object]) -> dict[str, float]:
    """Seconds of both steps and of the whole, measured around them."""
    t0 = time.perf_counter()
    transfer()
    t1 = time.perf_counter()
    analysis()
    t2 = time.perf_counter()
    return {"Total": t2 - t0, "Transfer": t1 - t0, "Analysis": t2 - t1}


def timing_rows(method: str, steps: DataFrame, atoms: DataFrame, seconds: dict[str, float]) -> DataFrame:
    """``Method Nrows Natoms Bytes Total Transfer Analysis``, a row per producer rank.

    The ranks of a method run together, so each row has the method's times.
    """
    told = account_bytes(steps, atoms)
    return told.select(F.lit(method).alias("Method"), F.col("nsteps").alias("Nrows"), F.col("natoms").alias("Natoms"),
                       F.col("bytes").alias("Bytes"), *[F.lit(seconds[c]).alias(c) for c in ("Total", "Transfer", "Analysis")])
