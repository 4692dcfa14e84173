"""Small scalar column expressions used by the simulation side of the reference.

All are built-in Spark expressions (JVM-side, codegen friendly).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference: the clamp range of the curve
# random walk, the replacement for small steps, and the atom symbols.
CLAMP_LO = 25.0
CLAMP_HI = 75.0
SMALL_STEP_REPLACEMENT = -5.0
ATOM_SYMBOLS = ("C", "O", "O")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clamp(v, lo: float = CLAMP_LO, hi: float = CLAMP_HI) -> Column:
    """``max(lo, min(hi, v))``; null stays null."""
    return F.when(_c(v).isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), _c(v))))


def replace_small(h, value: float = SMALL_STEP_REPLACEMENT) -> Column:
    """Steps strictly inside (-1, 1) are replaced by ``value``."""
    h = _c(h)
    return F.when((h < 1) & (h > -1), F.lit(value)).otherwise(h)


def label_sign(curve, y) -> Column:
    """+1 if the curve is strictly above the point, else -1 (ties give -1); null where either is unknown."""
    return F.when(_c(curve) > _c(y), F.lit(1)).when(_c(curve) <= _c(y), F.lit(-1))


def char_code(ch) -> Column:
    """Character -> numeric code (first character)."""
    return F.ascii(_c(ch))


def code_char(code) -> Column:
    """Numeric code -> one-character string."""
    return F.char(_c(code).cast("bigint"))


def cast_text_number(text, to: str = "double") -> Column:
    """Text -> number; malformed text gives null instead of an error."""
    return F.trim(_c(text)).try_cast(to)


def value_lookup_in_array(pos, values: Sequence, wrap: bool = False) -> Column:
    """Value at 0-based ``pos`` of a short literal list.

    Out-of-range positions give null (``wrap=False``) or wrap around
    (``wrap=True``).  The reference reads past the end of its list.
    """
    arr = F.array(*[F.lit(v) for v in values])
    p = _c(pos)
    if wrap:
        p = F.pmod(p, F.lit(len(values)))
    # ``get`` is 0-based and returns null when out of bounds.
    return F.get(arr, p.cast("int"))


def one_hot_binary(b) -> tuple[Column, Column]:
    """``cbind(1 - b, b)`` for a 0/1 label."""
    b = _c(b)
    return (F.lit(1) - b), b


def unit_from_hash(*cols, seed: int = 0) -> Column:
    """A repeatable uniform draw in [0, 1) from a hash of the given columns.

    Independent of partitioning and task retries (unlike ``rand()``): the
    value depends only on the key columns and the seed.
    """
    h = F.xxhash64(F.lit(seed), *[_c(c) for c in cols])
    # 53 random bits -> double in [0, 1)
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def linspace_points(count_row, n_col: str, a: float, b: float, chunk: int = 1 << 16):
    """``n`` evenly spaced values on [a, b], both ends included: ``a + (b - a) / (n - 1) * k``.

    ``count_row`` is a one-row DataFrame holding ``n`` (computed by Spark from
    the data).  The row is cut into chunks of at most ``chunk`` values, the
    chunks are dealt over the cluster, and each is exploded where it lands.
    ``n = 1`` gives ``a`` alone, less gives nothing.
    """
    n = F.col(n_col).cast("bigint")
    starts = F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n - 1, F.lit(chunk).cast("bigint"))).otherwise(
        F.array().cast("array<bigint>"))
    chunks = count_row.select(n.alias("_n"), F.explode(starts).alias("_s"))
    chunks = chunks.repartition(max(1, chunks.sparkSession.sparkContext.defaultParallelism))
    e = chunks.select("_n", F.explode(F.sequence(F.col("_s"), F.least(F.col("_s") + chunk, F.col("_n")) - 1)).alias("k"))
    stride = F.when(F.col("_n") > 1, (F.lit(float(b)) - F.lit(float(a))) / F.nullif(
        (F.col("_n") - 1).cast("double"), F.lit(0.0))).otherwise(F.lit(0.0))
    return e.select("k", (F.lit(float(a)) + stride * F.col("k").cast("double")).alias("x"))
