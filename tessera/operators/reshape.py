"""Matrix reshaping, row numbering and column binding.

The reference keeps dense matrices; here a matrix is a **long cell table**
``(i, j, value)`` and the wide form (one row per i, columns ``C1..Cn``) is
only produced at the CSV edge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

DEFAULT_BLOCK_ROWS = 1 << 20
#: Ranges that a level of :func:`row_blocks` cuts: the first level's ends are literals of the plan,
#: the ends of each later level are a table with one row per range of the level before.
FIRST_RANGES, NEXT_RANGES = 1024, 64
#: Size of a quantile sketch (KLL): a few kilobytes for ranks to about 0.1 %, whatever the number of rows.
SKETCH_K = 2048
#: Parts in which sketches are merged before they meet in one task.
SKETCH_PARTS = 256


def _ends(sketch: str, ranges: int) -> Column:
    """The ``ranges - 1`` inner quantiles of a sketch column."""
    return F.kll_sketch_get_quantile_double(F.col(sketch), F.array(*(F.lit(k / ranges) for k in range(1, ranges))))


def _place(ends: Column, value: Column, most: int) -> Column:
    """How many of the sorted ``ends`` are at most ``value``: a binary search, the steps folded over a literal list."""
    steps = F.array(*(F.lit(1 << k) for k in range(most.bit_length() - 1, -1, -1)))
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(
        F.get(ends, at + s - 1) <= value, at + s).otherwise(at))


def row_blocks(df: DataFrame, key: str, block_rows: int, name: str) -> DataFrame:
    """Add ``name``: a block number, increasing with ``key``, of about ``block_rows`` rows each.

    One job counts the rows and sketches the key's quantiles (mergeable KLL
    sketches, merged in ``SKETCH_PARTS`` parts); its up to ``FIRST_RANGES``
    ranges are all that reaches the driver and the plan.  As long as a range
    holds more than a block, each range is sketched again and cut by its own
    ends, which are a table in the scratch folder, joined by range number.

    Sparse, fractional and clustered keys all give even blocks.  A null key is
    in the first block, NaN in the last.  Keys are compared as doubles: those
    that are one double share a block.
    """
    spark = df.sparkSession
    value = F.col(key).cast("double")
    usable = F.when(~F.isnan(value), value)
    told = (df.groupBy((F.spark_partition_id() % SKETCH_PARTS).alias("part"))
            .agg(F.count("*").alias("n"), F.kll_sketch_agg_double(usable, F.lit(SKETCH_K)).alias("s"))
            .agg(F.sum("n").alias("n"), F.kll_merge_agg_double("s", F.lit(SKETCH_K)).alias("s")))
    row = told.select("n", F.when(F.kll_sketch_get_n_double("s") > 0, _ends("s", FIRST_RANGES)).alias("q")).first()
    ranges = min(FIRST_RANGES, -(-(row["n"] or 0) // block_rows))
    if ranges <= 1 or row["q"] is None:
        return df.withColumn(name, F.lit(0).cast("long"))
    chosen = sorted({row["q"][round(k * FIRST_RANGES / ranges) - 1] for k in range(1, ranges)})
    tmp = f"{name}_key"
    keyed = df.withColumn(tmp, F.coalesce(value, F.lit(float("-inf"))))
    cut = Bucketizer(splits=[float("-inf"), *chosen, float("inf")], inputCol=tmp, outputCol=name,
                     handleInvalid="keep")
    out = cut.transform(keyed).withColumn(name, F.col(name).cast("long"))
    held = row["n"] / ranges
    while held > block_rows:
        held /= NEXT_RANGES
        sketched = (out.filter(~F.isnan(tmp)).groupBy(name, (F.spark_partition_id() % SKETCH_PARTS).alias("part"))
                    .agg(F.kll_sketch_agg_double(tmp, F.lit(SKETCH_K)).alias("s"))
                    .groupBy(name).agg(F.kll_merge_agg_double("s", F.lit(SKETCH_K)).alias("s"))
                    .select(F.col(name).alias(f"{name}_of"), _ends("s", NEXT_RANGES).alias(f"{name}_ends")))
        path = scratch_path(spark, "block-ends")
        sketched.write.parquet(path)
        table = spark.read.schema(sketched.schema).parquet(path)
        inner = F.coalesce(_place(F.col(f"{name}_ends"), F.col(tmp), NEXT_RANGES - 1), F.lit(0))
        out = (out.join(table, F.col(name) == F.col(f"{name}_of"), "left")
               .withColumn(name, F.col(name) * NEXT_RANGES + inner).drop(f"{name}_of", f"{name}_ends"))
    return out.drop(tmp)


def row_index(df: DataFrame, key: str | None = None, name: str = "row", start: int = 1,
              block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Dense row number in ``key`` order (``start``-based), computed in two levels.

    Without ``key`` the partition order is used (``monotonically_increasing_id``).
    A global ``row_number()`` would pull every row into one task; instead
    rows are grouped into blocks of about ``block_rows`` rows, the block
    counts are prefix-summed over the (small) block table and each row's
    number is its rank inside its block plus the block offset.  ``key`` must
    be numeric and unique; a null key comes first.
    """
    k = key or "_mono"
    d = df if key else df.withColumn("_mono", F.monotonically_increasing_id())
    d = row_blocks(d, k, block_rows, "_blk")
    counts = d.groupBy("_blk").agg(F.count(F.lit(1)).alias("_cnt"))
    w_blk = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_blk", F.coalesce(F.sum("_cnt").over(w_blk), F.lit(0)).alias("_off"))
    w_in = Window.partitionBy("_blk").orderBy(k)
    out = d.join(offs, "_blk").withColumn(
        name, (F.col("_off") + F.row_number().over(w_in) - 1 + F.lit(start)).cast("bigint"))
    drop = ["_blk", "_off"] + ([] if key else ["_mono"])
    return out.drop(*drop)


def bind_columns(df: DataFrame, name: str = "x", key: str | None = None,
                 block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``cbind(x = seq(0, nrow - 1), df)``: a 0-based row number as first column."""
    out = row_index(df, key=key, name=name, start=0, block_rows=block_rows)
    return out.select(name, *[c for c in df.columns])


def matrix_to_long(wide: DataFrame, id_col: str = "x", var: str = "y",
                   value: str = "value", cols: Sequence[str] | None = None) -> DataFrame:
    """``gather(y, value, -x)``: wide -> (x, y, value)."""
    cols = list(cols) if cols is not None else [c for c in wide.columns if c != id_col]
    return wide.unpivot([id_col], cols, var, value)


def long_to_matrix(long: DataFrame, n: int, i: str = "i", j: str = "j", value: str = "value",
                   fill=0, prefix: str = "C") -> DataFrame:
    """Cells -> wide matrix rows ``(i, C1..Cn)``; missing cells are ``fill``.

    The column list is given (``1..n``) so Spark does not run a distinct job
    to discover it; one row per ``i`` comes out of a single aggregation.
    """
    wide = long.groupBy(i).pivot(j, list(range(1, n + 1))).agg(F.first(value))
    cols = [F.coalesce(F.col(str(k)), F.lit(fill)).cast(long.schema[value].dataType)
            .alias(f"{prefix}{k}") for k in range(1, n + 1)]
    return wide.select(i, *cols)


def matrix_profile(long: DataFrame, i: str = "i", j: str = "j", value: str = "value") -> DataFrame:
    """rows, cols, nnz of a matrix in long form."""
    return long.agg(
        F.count_distinct(i).alias("rows"),
        F.count_distinct(j).alias("cols"),
        F.sum(F.when(F.col(value) != 0, 1).otherwise(0)).cast("bigint").alias("nnz"),
    )
