"""The reply text of the analysis: ``"idx sat idx sat ..."`` and back.

Encoding aggregates the (small) reported list per group -- at most n*n cells
-- into one string, sorted by saturation descending (ties by idx).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def encode_reply(reports: DataFrame, by: Sequence[str] = (), idx: str = "idx",
                 sat: str = "sat") -> DataFrame:
    pairs = F.array_sort(F.collect_list(F.struct((-F.col(sat)).alias("k"), F.col(idx).alias("i"),
                                                 F.col(sat).alias("s"))))
    text = F.array_join(F.transform(pairs, lambda p: F.concat_ws(" ", p["i"].cast("string"),
                                                                  p["s"].cast("string"))), " ")
    g = reports.groupBy(*by) if by else reports.groupBy()
    return g.agg(text.alias("reply"))


def decode_reply(replies: DataFrame, by: Sequence[str] = (), col: str = "reply") -> DataFrame:
    """Pairs of tokens -> rows ``(*by, idx, weight)``; the sampler uses ``idx - 1``."""
    toks = F.split(F.trim(F.col(col)), " +")
    n = F.size(toks)
    starts = F.when(n >= 2, F.sequence(F.lit(0), n - 2, F.lit(2))).otherwise(
        F.array().cast("array<int>"))
    e = replies.select(*by, toks.alias("_t"), F.explode(starts).alias("_k"))
    return e.select(*by, F.get("_t", F.col("_k")).cast("bigint").alias("idx"),
                    F.get("_t", F.col("_k") + 1).cast("double").alias("weight"))
