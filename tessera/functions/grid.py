"""Column expressions for the square histogram grid (bins, cell numbers, edges).

Every function returns a ``Column`` so it stays inside whole-stage codegen;
nothing here runs Python per row.

Conventions (fixed by the reference analysis):

* the domain is ``[dmin, dmax]`` on both axes, ``stride = (dmax - dmin) / n``;
* a bin number is ``ceil((v - dmin) / stride)``, 1-based, bins are ``(lo, hi]`` --
  ``v == dmin`` gives bin 0, which is *outside* the grid;
* the cell number is ``(i - 1) * n + j`` (1-based, row-major in x);
* lower cell edges are ``dmin + (i - 1) * stride``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    """A square n x n grid over ``[dmin, dmax]^2``."""

    n: int = 64
    dmin: float = 0.0
    dmax: float = 100.0

    @property
    def stride(self) -> float:
        return (self.dmax - self.dmin) / self.n

    @property
    def cells(self) -> int:
        return self.n * self.n


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bin_assign(v, grid: Grid) -> Column:
    """1-based bin ``ceil((v - dmin) / stride)``; bins are ``(lo, hi]``."""
    return F.ceil((_c(v) - F.lit(grid.dmin)) / F.lit(grid.stride)).cast("int")


def in_domain(gx, gy, grid: Grid) -> Column:
    """True when both bins are inside ``1..n``."""
    return _c(gx).between(1, grid.n) & _c(gy).between(1, grid.n)


def cell_index(i, j, grid: Grid) -> Column:
    """(i, j) -> 1-based cell number ``(i - 1) * n + j``."""
    return ((_c(i) - 1) * F.lit(grid.n) + _c(j)).cast("int")


def cell_row(idx, grid: Grid) -> Column:
    """1-based cell number -> 1-based row (x bin)."""
    return (F.floor((_c(idx) - 1) / F.lit(grid.n)) + 1).cast("int")


def cell_col(idx, grid: Grid) -> Column:
    """1-based cell number -> 1-based column (y bin)."""
    return (F.pmod(_c(idx) - 1, F.lit(grid.n)) + 1).cast("int")


def lower_edge(b, grid: Grid) -> Column:
    """Lower edge of 1-based bin b."""
    return F.lit(grid.dmin) + (_c(b) - 1).cast("double") * F.lit(grid.stride)


def upper_edge(b, grid: Grid) -> Column:
    """Upper edge of 1-based bin b."""
    return F.lit(grid.dmin) + _c(b).cast("double") * F.lit(grid.stride)


def axis_scale(v, n) -> Column:
    """Ordinal -> axis coordinate ``v * (100 / n)``; n may be a column."""
    n_col = _c(n) if not isinstance(n, (int, float)) else F.lit(float(n))
    return _c(v).cast("double") * (F.lit(100.0) / n_col.cast("double"))


def column_ordinal(name) -> Column:
    """Wide-matrix column name to 0-based ordinal: ``"C7" -> 6``."""
    return (F.substring(_c(name), 2, 1 << 20).cast("int") - 1)


def signed_abs(h) -> Column:
    """``abs(h)``, exact for integers of any size."""
    return F.abs(_c(h))
