"""Operator 3: mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its target share of the output's code
points over its own number of them.  Each document draws its count by
inverting the Poisson distribution of that rate at a uniform number hashed
from the seed and its id, so the draw does not depend on partitioning and
comes out the same when a task runs again.  Documents are exploded by their
counts and dealt over the cluster by a hash of seed, id and copy, and sorted
by it in each partition: a global shuffle.

A third of all rows may have one source: sizes are partial aggregates, rates
(one row per source) join by a broadcast only below the session's threshold,
and copies are dealt by copy, not by source.

Defined results: null text counts as empty; a null source is a source of its
own; a null id draws by its text; sources without any text or weight have rate
0 and give no rows; repeated rows draw the same count, each for itself.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.common import text_or_empty, written

SEED = "mix-1"
#: Without given weights a source's target share goes with its size to this power.
TEMPER = 0.5


def _uniform(*parts: Column) -> Column:
    """In (0, 1): the first 52 bits of the MD5 of the parts, joined by colons."""
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 52)


def poisson_cdf(rate: Column) -> Column:
    """array of P(X <= k) for k = 0, 1, ... up to where the rest is below rounding."""
    most = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    log_p = lambda s, k: s["log_p"] + F.log(rate / k)
    return F.aggregate(
        F.sequence(F.lit(1), most),
        F.struct((-rate).alias("log_p"), F.array(F.exp(-rate)).alias("cdf")),
        lambda s, k: F.struct(log_p(s, k).alias("log_p"), F.concat(
            s["cdf"], F.array(F.element_at(s["cdf"], -1) + F.exp(log_p(s, k)))).alias("cdf")))["cdf"]


def rates(docs: DataFrame, weights: Mapping[str, float] | None = None, budget: float | None = None,
          source_col: str = "source", text_col: str = "text") -> DataFrame:
    """key, rate, cdf of every source; ``budget``: code points wanted (default: as many as there are)."""
    sizes = docs.groupBy(_key(source_col).alias("key")).agg(
        F.sum(F.length(text_or_empty(text_col))).cast("double").alias("size"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow("size", F.lit(TEMPER)))
    else:
        given = F.create_map(*(F.lit(x) for k, w in weights.items() for x in (f"s{k}", float(w)))) \
            if weights else F.create_map().cast("map<string,double>")
        sizes = sizes.withColumn("weight", F.coalesce(F.try_element_at(given, F.col("key")), F.lit(0.0)))
    sizes = written(sizes, "source-sizes")
    total = sizes.filter("size > 0").agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"))
    wanted = F.lit(float(budget)) if budget is not None else F.col("all_size")
    # one row with the totals beside each source
    rate = F.col("weight") / F.col("all_weight") * wanted / F.col("size")
    return written(sizes.filter("size > 0 AND weight > 0").join(F.broadcast(total))
                   .select("key", rate.alias("rate")).withColumn("cdf", poisson_cdf(F.col("rate"))), "source-rates")


def _key(source_col: str) -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("n"))


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, budget: float | None = None, seed: str = SEED,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """row (all columns of ``docs`` in a struct), copies, copy (from 1), mix_key: replicated and shuffled."""
    by_source = rates(docs, weights, budget, source_col, text_col)
    own = F.coalesce(F.col(id_col).cast("string"), F.md5(text_or_empty(text_col)))
    rows = docs.select(F.struct("*").alias("row"), _key(source_col).alias("key"), own.alias("own"))
    drawn = (rows.join(by_source, "key")
             .withColumn("u", _uniform(F.lit(seed), F.col("own")))
             .withColumn("copies", F.size(F.filter("cdf", lambda c: c < F.col("u")))).filter("copies > 0"))
    copies = (drawn.select("row", "own", "copies", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
              .withColumn("mix_key", F.md5(F.concat_ws(":", F.lit(seed), F.lit("deal"), "own", F.col("copy").cast("string")))))
    return (copies.select("row", "copies", "copy", "mix_key")
            .repartition("mix_key").sortWithinPartitions("mix_key"))
