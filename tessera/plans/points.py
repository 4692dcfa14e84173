"""The ``Point`` table (x, y, category) as a view over the ``events`` table.

Mapping (fixed for the whole repository):

* ``seq      = event_id``  (unique, gives the processing order)
* ``x        = (user_id + 0.5) / (max(user_id) + 1) * 100``  (strictly inside (0, 100))
* ``y        = least(value, 100)``  (value > 0, so y in (0, 100])
* ``category = +1 for purchase/click, else -1``
* ``batch    = day number of ts`` (days since 1970-01-01, UTC)

``max(user_id)`` is one scalar aggregate (a single tiny job); its value is
folded into the projection as a literal, so the plans below carry no subquery
that every stage would evaluate again, and no join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import Grid
from ..operators.histogram import assign_cells
from ..session import read_table

# The event types that count as a positive label, and the
# reference grid (64 x 64 cells over [0, 100] on both axes).
POSITIVE_EVENT_TYPES = ("purchase", "click")
DEFAULT_GRID = Grid(64, 0.0, 100.0)


def point_view(events: DataFrame, clamp_y: bool = True) -> DataFrame:
    """``(x, y, category, seq, batch)`` over the events table (reference column order first)."""
    max_user = events.agg(F.max("user_id")).first()[0]
    max_user = float(max_user) if max_user is not None else 0.0
    y = F.least(F.col("value"), F.lit(100.0)) if clamp_y else F.col("value")
    return events.select(
        ((F.col("user_id").cast("double") + F.lit(0.5))
         / (F.lit(max_user) + F.lit(1.0)) * F.lit(100.0)).alias("x"),
        y.alias("y"),
        F.when(F.col("event_type").isin(*POSITIVE_EVENT_TYPES), F.lit(1))
        .otherwise(F.lit(-1)).alias("category"),
        F.col("event_id").alias("seq"),
        F.unix_date(F.to_date("ts")).alias("batch"),
    )


def load_points(spark: SparkSession, sf_dir: str, clamp_y: bool = True) -> DataFrame:
    events = read_table(spark, sf_dir, "events").select(
        "event_id", "user_id", "value", "event_type", "ts")
    return point_view(events, clamp_y=clamp_y)


def load_point_cells(spark: SparkSession, sf_dir: str, grid: Grid = DEFAULT_GRID) -> DataFrame:
    return assign_cells(load_points(spark, sf_dir), grid)


def point_sql(clamp_y: bool = True) -> str:
    """The same view in DuckDB SQL (oracle side)."""
    y = "least(value, CAST(100 AS DOUBLE))" if clamp_y else "value"
    return f"""
    SELECT (CAST(user_id AS DOUBLE) + 0.5)
             / (CAST((SELECT max(user_id) FROM events) AS DOUBLE) + 1.0) * 100.0 AS x,
           {y} AS y,
           CASE WHEN event_type IN ('purchase', 'click') THEN 1 ELSE -1 END AS category,
           event_id AS seq,
           CAST(CAST(ts AS DATE) - DATE '1970-01-01' AS INTEGER) AS batch
    FROM events"""


def point_cells_sql(grid: Grid = DEFAULT_GRID, clamp_y: bool = True) -> str:
    s = grid.stride
    n = grid.n
    return f"""
    SELECT *, CAST((gx - 1) * {n} + gy AS INTEGER) AS idx FROM (
      SELECT *, CAST(ceil(x / CAST({s!r} AS DOUBLE)) AS INTEGER) AS gx, CAST(ceil(y / CAST({s!r} AS DOUBLE)) AS INTEGER) AS gy
      FROM ({point_sql(clamp_y)}) p0) p1"""
