"""Operator 13: embedding whitening by shifted CholeskyQR.

Vectors are put on an integer grid, x = floor(scale * c) + offset, so counts,
sums and the centred values n * x - S are exact; a row is centred as
(n * x - S) / n, which keeps the full precision of a double although x itself
is large.  Each pass over the fit list (every distinct vector once) multiplies
the centred rows by the inverses of the triangular factors found so far, by
triangular solves in the tasks, and adds up the Gram matrix of the result.
The first factor is the Cholesky factor of the Gram matrix plus a small shift,
which exists however ill-conditioned the rows are; the next ones bring the
columns to orthonormality.  R, the product of the factors, has the singular
values and right singular vectors of the centred rows: e = s^2 / n, and the
right vectors are the components.

A direction without variance (a constant or dependent dimension) never becomes
a column of length one: its columns stay at zero and the shift is used again.
Components whose standard deviation is below ``RANK_CUT`` of the largest are
rounding noise and are left out.

Only D x D Gram matrices (D is the width of a vector) and the sums go through
the driver.  Gram entries are added per task, then per entry, by Spark.

Defined results: rows whose vector is null, empty, holds null or non-finite
entries, or whose grid values pass 62 bits take no part; vectors of several
lengths: the most common length takes part (ties: the longest), since a
covariance needs one width; repeated rows and ids each get their rows, repeated vectors
count once in the fit; rows with a null id take part; no vector, or none that differs
from the others: no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.common import python_ready, written

#: Standard deviations below this share of the largest are rounding noise.
RANK_CUT = 1e-11
#: Passes of CholeskyQR after which the factors are taken as they are; three do for all but the worst conditions.
MOST_PASSES = 8


def grid_vector(col: str, scale: float, offset: int) -> Column:
    """The integer vector of a column of float or double arrays; null where it cannot take part."""
    def fits(c: Column) -> Column:
        x = c.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < 2.0 ** 62)

    usable = F.col(col).isNotNull() & (F.size(col) > 0) & F.forall(F.col(col), fits)
    return F.when(usable, F.transform(F.col(col), lambda c: (
        F.floor(F.lit(float(scale)) * c.cast("double")) + F.lit(offset)).cast("long")))


def _matrix(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (n * x - sums) / n


def _gram(fit: DataFrame, n: int, sums: np.ndarray, factors: list[np.ndarray], right: np.ndarray | None = None
          ) -> np.ndarray:
    """Gram matrix of the centred rows after the triangular solves and, if given, times ``right``."""
    width = len(sums)
    k = width if right is None else right.shape[1]

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for b in batches:
            if b.num_rows:
                q = _centred(_matrix(b, "x", width), n, sums)
                for r in factors:
                    q = _solved(q, r)
                if right is not None:
                    q = q @ right
                total += q.T @ q
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k * k, dtype=np.int32)), pa.array(total.ravel())], names=["at", "value"])

    added = fit.select("x").mapInArrow(per_task, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    out = np.zeros(k * k)
    for row in added.collect():  # k * k numbers, whatever the number of rows
        out[row.at] = row.value
    return out.reshape(k, k)


def _solved(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """rows @ inv(r) for an upper triangular r, one column after the other."""
    q = np.empty_like(rows)
    for j in range(r.shape[0]):
        q[:, j] = (rows[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def _factor(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper triangular R with R'R = gram, plus the shift that makes the factorisation exist."""
    width = len(gram)
    shift = 11 * (width * n + width * (width + 1)) * np.finfo(float).eps / 2 * np.linalg.norm(gram, 2)
    if not shifted:
        try:
            return np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:
            pass
    # far beyond a million rows the textbook shift would pass the matrix itself: a Gram entry's rounding does not
    shift = min(shift, 1e-6 * np.linalg.norm(gram, 2))
    return np.linalg.cholesky(gram + shift * np.eye(width)).T


def triangular_factor(fit: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """R of the centred fit list: shifted CholeskyQR, repeated until the columns that vary are orthonormal."""
    width = len(sums)
    factors: list[np.ndarray] = []
    for turn in range(MOST_PASSES):
        gram = _gram(fit, n, sums, factors)
        if not gram.any():
            return np.zeros((width, width))
        if turn:
            alive = np.diag(gram) > 0.5
            off = gram[np.ix_(alive, alive)] - np.eye(int(alive.sum()))
            rest = np.delete(np.delete(gram, alive, 0), alive, 1)
            if np.abs(off).max(initial=0) < 1e-13 * width and np.abs(rest).max(initial=0) < 0.5 and turn > 1:
                break
        factors.append(_factor(gram, n, shifted=turn == 0))
    r = np.eye(width)
    for f in factors:
        r = f @ r
    return r


def _exact_squares(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """sum((n * x - S)^2) per row as decimal(38, 0); Python integers where 64 bits may not hold it."""
    d = n * x - sums
    if np.square(d.astype(np.float64)).sum(axis=1).max(initial=0) < 2.0 ** 62:
        return pa.array(np.square(d).sum(axis=1)).cast(pa.decimal128(38, 0))
    big = d.astype(object)
    return pa.array([Decimal(int(v)) for v in (big * big).sum(axis=1)], pa.decimal128(38, 0))


def whiten(rows: DataFrame, vec: str = "embedding", ident: str = "vec_id", components: int = 16,
           scale: float = 64.0, offset: int = 1_000_000) -> DataFrame:
    """ident, component (from 1), n, deviation (decimal), whitened, explained, identity_error.

    One row per row of ``rows`` that takes part and component up to
    ``components`` (fewer where the vectors vary in fewer directions).
    """
    spark = rows.sparkSession
    python_ready(spark)
    schema = "ident {}, component int, n long, deviation decimal(38,0), whitened double, explained double, " \
             "identity_error double".format(rows.schema[ident].dataType.simpleString())
    names = [ident, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    grid = rows.select(F.col(ident).alias("ident"), grid_vector(vec, scale, offset).alias("x")).filter("x is not null")
    lengths = grid.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if lengths is None:
        return spark.createDataFrame([], schema).toDF(*names)
    width = lengths.width
    grid = grid.filter(F.size("x") == width)
    fit = written(grid.select("x").distinct(), "whitening-fit")
    per_dim = fit.select(F.posexplode("x").alias("dim", "v")).groupBy("dim").agg(
        F.count("*").alias("n"), F.sum("v").alias("s")).collect()  # one row per dimension
    n, sums = per_dim[0].n, np.zeros(width, dtype=np.int64)
    for r in per_dim:
        sums[r.dim] = r.s
    _, s, vt = np.linalg.svd(triangular_factor(fit, n, sums))
    e = s * s / n
    trace = float(e.sum())
    rank = int((s > RANK_CUT * s[0]).sum()) if s[0] > 0 else 0
    k = min(components, rank)
    if k == 0:
        return spark.createDataFrame([], schema).toDF(*names)
    basis = vt[:k]
    basis = basis * np.sign(basis[np.arange(k), np.abs(basis).argmax(axis=1)])[:, None]
    right = (basis / np.sqrt(e[:k])[:, None]).T
    error = float(np.abs(_gram(fit, n, sums, [], right) / n - np.eye(k)).max())
    share = e[:k] / trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b, "x", width)
            m = len(x)
            w = _centred(x, n, sums) @ right
            again = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                b.column("ident").take(again), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n, dtype=np.int64)), _exact_squares(x, n, sums).take(again),
                pa.array(w.ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))],
                names=["ident", *names[1:]])

    return grid.mapInArrow(project, schema).toDF(*names)
