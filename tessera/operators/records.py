"""Parent/child record tables: ordinals, expansion, reconciliation, differential check.

``Timestep`` rows are parents carrying a child count (``natoms``); ``Atom``
rows are their children.  All operators are joins/aggregations/explodes; no
per-row Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import ATOM_SYMBOLS, char_code, value_lookup_in_array
from ..session import scratch_path
from .reshape import _place

# C struct sizes of the reference records (bytes per row).
TIMESTEP_BYTES = 24
ATOM_BYTES = 72


#: Rows of a group that one window may hold; larger groups are cut into ranges of their order.
GROUP_ROWS = 1 << 20
#: Sampled rows per range of a large group, and the most ranges one group is cut into.
SAMPLED_PER_RANGE, MOST_RANGES = 16, 4096


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "ordinal",
                start: int = 0, partitions: int | None = None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Ordinal of each row inside its group, in ``order`` (nulls first); skew-safe, in JVM windows.

    Groups of up to ``group_rows`` rows are ranked by a plain window.  A larger
    group would put that many rows into one task, so its order is cut into
    ranges: cut points come from a hash sample of its rows (a sorted array per
    large group, at most ``MOST_RANGES`` long), each row finds its range by
    binary search, the counts per (group, range) are summed up before it, and
    the window runs inside a range.  The ranges only deal the rows, so the
    sample has no part in the result.  Rows that agree in all of ``order`` are
    in one range.

    Whether there is a large group is asked first, by a count of the group
    columns alone; usually there is none, and the rows are shuffled once (into
    ``partitions`` if given).  Nulls (and NaN) are values of a group like any other.
    """
    group, order = list(group), list(order)
    large = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > group_rows)
    own = Window.partitionBy(*group).orderBy(*order)
    if large.isEmpty():
        df = df.repartition(partitions, *group) if partitions else df
        return df.withColumn(name, (F.row_number().over(own) - 1 + F.lit(start)).cast("int"))

    spark = df.sparkSession
    keys = [f"_g{k}" for k in range(len(group))]
    place = F.struct(*[F.col(c) for c in order])

    def same(table: DataFrame, *more: Column) -> Column:
        cond = F.lit(True)
        for c, k in zip(group, keys):
            cond = cond & F.col(c).eqNullSafe(F.col(k))
        for m in more:
            cond = cond & m
        return cond

    large = large.select(*[F.col(c).alias(k) for c, k in zip(group, keys)], "_n")
    every = F.greatest(F.lit(group_rows / SAMPLED_PER_RANGE), F.col("_n") / (MOST_RANGES * SAMPLED_PER_RANGE))
    sample = (df.join(large, same(large)).filter(F.pmod(F.xxhash64(*[F.col(c) for c in order]),
                                                        F.greatest(F.lit(1), F.floor(every)).cast("long")) == 0)
              .groupBy(*keys).agg(F.sort_array(F.collect_set(place)).alias("_s")))
    picked = F.filter("_s", lambda _, k: k % SAMPLED_PER_RANGE == SAMPLED_PER_RANGE - 1)
    cuts = sample.select(*keys, picked.alias("_cuts"))
    path = scratch_path(spark, "rank-cuts")
    cuts.write.parquet(path)
    cuts = spark.read.schema(cuts.schema).parquet(path)
    ranged = df.join(cuts, same(cuts), "left").withColumn(
        "_rng", F.coalesce(_place(F.col("_cuts"), place, 2 * MOST_RANGES - 1), F.lit(0))).drop(*keys, "_cuts")
    upto = Window.partitionBy(*keys).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    before = (ranged.groupBy(*group, "_rng").agg(F.count(F.lit(1)).alias("_c"))
              .select(*[F.col(c).alias(k) for c, k in zip(group, keys)], F.col("_rng").alias("_r"), "_c")
              .select(*keys, "_r", F.sum("_c").over(upto).alias("_off")).filter(F.col("_off") > 0))
    inside = Window.partitionBy(*group, "_rng").orderBy(*order)
    ranged = ranged.repartition(partitions, *group, "_rng") if partitions else ranged
    out = ranged.withColumn("_rn", F.row_number().over(inside)).join(
        before, same(before, F.col("_rng") == F.col("_r")), "left")
    return out.select(*df.columns, (F.col("_rn") - 1 + F.coalesce(F.col("_off"), F.lit(0)) + F.lit(start))
                      .cast("int").alias(name))


def child_counts(children: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Children per parent key (partial + final aggregation: hot keys are cheap)."""
    return children.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def reconcile_parent_child(parents: DataFrame, children: DataFrame,
                           parent_keys: Sequence[str], child_keys: Sequence[str],
                           count_col: str = "natoms") -> DataFrame:
    """Summary of the parent/child consistency check (0 mismatches = consistent).

    Children are counted per key, full-outer-joined to the parents; a
    mismatch is a key whose declared count differs from the real one (a
    missing side counts as 0).  Orphans are children without a parent.
    """
    cc = child_counts(children, child_keys, "_n")
    ren = {c: p for c, p in zip(child_keys, parent_keys)}
    cc = cc.select(*[F.col(c).alias(ren[c]) for c in child_keys], "_n", F.lit(True).alias("_has_c"))
    p = parents.select(*parent_keys, F.col(count_col).alias("_decl"), F.lit(True).alias("_has_p"))
    j = p.join(cc, list(parent_keys), "full_outer")
    mismatch = F.coalesce("_decl", F.lit(0)) != F.coalesce("_n", F.lit(0))
    return j.agg(
        F.sum(F.when(F.col("_has_p"), 1).otherwise(0)).cast("bigint").alias("n_parents"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_children"),
        F.sum(F.when(mismatch, 1).otherwise(0)).cast("bigint").alias("n_mismatch"),
        F.sum(F.when(F.col("_has_p").isNull(), F.col("_n")).otherwise(0)).cast("bigint")
        .alias("n_orphans"),
    )


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double/float column (``%f`` text keeps 6 decimals)."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if f.dataType.simpleString() in ("double", "float") else F.col(f.name)
                       for f in df.schema.fields])


def diff_paths(a: DataFrame, b: DataFrame, digits: int = 6) -> DataFrame:
    """Differential check of one table read two ways (multiset difference, like ``exceptAll``).

    Both sides are tagged, unioned and grouped by the whole row (one shuffle,
    partial aggregation first, so many copies of one row stay cheap); a row
    that appears k times in a and m times in b contributes ``max(k - m, 0)``
    to ``only_a``.  Doubles are compared at ``digits`` decimals.
    """
    cols = list(a.columns)
    ra = round_doubles(a, digits).withColumn("_in_a", F.lit(1)).withColumn("_in_b", F.lit(0))
    rb = round_doubles(b.select(*cols), digits).withColumn("_in_a", F.lit(0)).withColumn("_in_b", F.lit(1))
    g = ra.unionByName(rb).groupBy(*cols).agg(F.sum("_in_a").alias("_k"), F.sum("_in_b").alias("_m"))
    return g.agg(
        F.coalesce(F.sum("_k"), F.lit(0)).cast("bigint").alias("rows_a"),
        F.coalesce(F.sum("_m"), F.lit(0)).cast("bigint").alias("rows_b"),
        F.coalesce(F.sum(F.greatest(F.col("_k") - F.col("_m"), F.lit(0))), F.lit(0)).cast("bigint").alias("only_a"),
        F.coalesce(F.sum(F.greatest(F.col("_m") - F.col("_k"), F.lit(0))), F.lit(0)).cast("bigint").alias("only_b"))


# The synthetic atom generator's factors for step i and atom j,
# x, y, z = i * (0.01, 0.02, 0.03) + j * 0.01 and forces = i * (0.01, 0.02, 0.03).
ATOM_STEP_FACTORS = (0.01, 0.02, 0.03)
ATOM_NUM_FACTOR = 0.01


def atom_coordinates(i: Column, j: Column) -> dict[str, Column]:
    """Synthetic atom values from step i and atom j (factors above)."""
    fi, fj = i.cast("double"), j.cast("double")
    fx, fy, fz = (F.lit(f) for f in ATOM_STEP_FACTORS)
    fn = F.lit(ATOM_NUM_FACTOR)
    return {
        "x": fi * fx + fj * fn,
        "y": fi * fy + fj * fn,
        "z": fi * fz + fj * fn,
        "force_x": fi * fx,
        "force_y": fi * fy,
        "force_z": fi * fz,
    }


EXPAND_CHUNK = 1 << 16


def expand_children(parents: DataFrame, count_col: str = "natoms", id_col: str = "id",
                    rank_col: str = "rank", chunk: int = EXPAND_CHUNK) -> DataFrame:
    """Parent with a count -> that many Atom rows (R3), ``num`` = 0-based ordinal.

    A parent may declare a huge count, so the expansion is done in two steps:
    the count is cut into chunks of at most ``chunk`` children, the chunk rows
    are spread round-robin over the cluster, and each chunk is exploded where
    it lands -- no task ever builds or emits one parent's whole child list.
    ``n = 0`` gives no rows.  ``symbol`` is the code of ``C, O, O`` at ``num``
    (null past the list, where the reference reads out of bounds).
    """
    n = F.col(count_col)
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(chunk))).otherwise(
        F.array().cast("array<int>"))
    chunks = parents.select(id_col, rank_col, count_col, F.explode(starts).alias("_s"))
    chunks = chunks.repartition(chunks.sparkSession.sparkContext.defaultParallelism)
    seq = F.sequence(F.col("_s"), F.least(F.col("_s") + F.lit(chunk), n) - 1)
    e = chunks.select(id_col, rank_col, F.explode(seq).alias("num"))
    coords = atom_coordinates(F.col(id_col), F.col("num"))
    return e.select(
        F.col(id_col).alias("timestep"), F.col(rank_col).alias("rank"),
        char_code(value_lookup_in_array(F.col("num"), ATOM_SYMBOLS)).cast("tinyint").alias("symbol"),
        F.col("num").cast("int").alias("num"),
        *[v.alias(k) for k, v in coords.items()])


def keyed_draw(rank, nsteps, i, modulus: int = 4, offset: int = 4, seed: int = 0) -> Column:
    """Repeatable draw from a key: the MD5 of ``seed:rank:nsteps:i``, its first 32 bits mod m, plus offset.

    Independent of partitioning, and the same in any engine (the reference
    uses Philox with key = rank, counter = (nsteps, i); values are not
    bit-equal to it).
    """
    cols = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in (rank, nsteps, i)]
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *cols)), 1, 8), 16, 10).cast("long")
    return (bits % modulus + F.lit(offset)).cast("int")


def bytes_accounting(nsteps, natoms) -> Column:
    """``nsteps * 24 + natoms * 72``."""
    c = [F.col(x) if isinstance(x, str) else x for x in (nsteps, natoms)]
    return (c[0].cast("bigint") * F.lit(TIMESTEP_BYTES) + c[1].cast("bigint") * F.lit(ATOM_BYTES))


def account_bytes(steps: DataFrame, atoms: DataFrame, rank: str = "rank") -> DataFrame:
    """``(rank, nsteps, natoms, bytes)`` of every rank that has steps, atoms or both (a null rank is one)."""
    s = steps.groupBy(F.col(rank).alias("_s")).agg(F.count(F.lit(1)).alias("nsteps"), F.lit(True).alias("_has"))
    a = atoms.groupBy(F.col(rank).alias("_a")).agg(F.count(F.lit(1)).alias("natoms"))
    both = s.join(a, F.col("_s").eqNullSafe(F.col("_a")), "full_outer")
    told = both.select(F.when(F.col("_has"), F.col("_s")).otherwise(F.col("_a")).alias(rank),
                       F.coalesce("nsteps", F.lit(0)).alias("nsteps"), F.coalesce("natoms", F.lit(0)).alias("natoms"))
    return told.withColumn("bytes", bytes_accounting("nsteps", "natoms"))
