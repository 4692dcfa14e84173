"""``Timestep`` / ``Atom`` record tables as views over ``orders`` / ``lineitem``.

* Timestep: ``id = o_orderkey``, ``rank = o_orderkey mod 7`` (producer number),
  ``natoms`` = number of the order's lineitems (0 for orders without any),
  ``energy = o_totalprice``.
* Atom: one row per lineitem; ``timestep = l_orderkey``, same ``rank``,
  ``num`` = 0-based ordinal inside the order (a deterministic total order
  over all lineitem columns -- ``(l_orderkey, l_linenumber)`` is not unique),
  ``symbol`` = code of ``C, O, O`` at ``num mod 3``, doubles from the
  lineitem's numeric columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import ATOM_SYMBOLS, char_code, value_lookup_in_array
from ..operators.records import child_counts, rank_within
from ..session import read_table

# Number of producer ranks in the reference cluster set-up.
N_RANKS = 7
LINEITEM_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def timestep_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey")
    cnt = child_counts(li, ["l_orderkey"], "_n")
    return o.join(cnt, o.o_orderkey == cnt.l_orderkey, "left").select(
        F.col("o_orderkey").alias("id"),
        F.pmod(F.col("o_orderkey"), F.lit(N_RANKS)).cast("int").alias("rank"),
        F.coalesce(F.col("_n"), F.lit(0)).cast("int").alias("natoms"),
        F.col("o_totalprice").alias("energy"))


def atom_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    ranked = rank_within(li, ["l_orderkey"], list(LINEITEM_ORDER), name="num")
    return ranked.select(
        F.col("l_orderkey").alias("timestep"),
        F.pmod(F.col("l_orderkey"), F.lit(N_RANKS)).cast("int").alias("rank"),
        char_code(value_lookup_in_array(F.col("num"), ATOM_SYMBOLS, wrap=True))
        .cast("tinyint").alias("symbol"),
        F.col("num").cast("int").alias("num"),
        F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"),
        F.col("l_discount").alias("z"), F.col("l_tax").alias("force_x"),
        F.col("l_partkey").cast("double").alias("force_y"),
        F.col("l_suppkey").cast("double").alias("force_z"))


def timestep_sql() -> str:
    return f"""
    SELECT o_orderkey AS id, CAST(o_orderkey % {N_RANKS} AS INTEGER) AS rank,
           CAST(COALESCE(c.n, 0) AS INTEGER) AS natoms, o_totalprice AS energy
    FROM orders LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey) c
    ON o_orderkey = c.l_orderkey"""


def atom_sql() -> str:
    order = ", ".join(LINEITEM_ORDER)
    return f"""
    SELECT timestep, rank, CAST(CASE num % 3 WHEN 0 THEN 67 ELSE 79 END AS TINYINT) AS symbol,
           num, x, y, z, force_x, force_y, force_z FROM (
      SELECT l_orderkey AS timestep, CAST(l_orderkey % {N_RANKS} AS INTEGER) AS rank,
             CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {order}) - 1 AS INTEGER) AS num,
             l_quantity AS x, l_extendedprice AS y, l_discount AS z, l_tax AS force_x,
             CAST(l_partkey AS DOUBLE) AS force_y, CAST(l_suppkey AS DOUBLE) AS force_z
      FROM lineitem) a"""
