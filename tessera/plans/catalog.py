"""Registry of named queries and their DuckDB oracle SQL.

Each query is ``f(spark, sf_dir) -> DataFrame`` over the given tables; the
oracle is the same result written as SQL over the same tables (views named
after the parquet files).  Queries without an SQL form are registered with
``sql=None`` and checked against a brute-force fixture in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def query(name: str, sql: str | Callable[[], str] | None = None):
    """Decorator: register ``fn`` under ``name`` with an optional oracle SQL."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql() if callable(sql) else sql
        return fn

    return deco


def _load_all() -> None:
    # importing the modules registers their queries
    from . import q_hist, q_matrix, q_io, q_parent, q_curve, q_model, q_stream  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLE)
