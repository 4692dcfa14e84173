"""Named tables stored as Parquet: overwrite/append, clear, lazy views, chunked writes.

The reference keeps rows in executor memory; here a table is a Parquet
directory in shared storage (it survives executor loss) and a view is a lazy
``spark.read`` -- nothing is read until a query runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, append: bool = False) -> None:
    """``append = 0`` replaces the table, ``append = 1`` adds the rows."""
    df.write.mode("append" if append else "overwrite").parquet(path)


def read_table_at(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def clear_table(spark: SparkSession, path: str) -> None:
    """Drop all rows; keep the schema (an empty overwrite)."""
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def register_view(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Make the stored table queryable by name (lazy)."""
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df


class UnknownTable(KeyError):
    pass


def table(spark: SparkSession, name: str) -> DataFrame:
    """Look up a registered table; an unknown name is an error."""
    if not spark.catalog.tableExists(name):
        raise UnknownTable(name)
    return spark.table(name)


def write_chunks(df: DataFrame, path: str, by: str) -> None:
    """One chunk (sub-directory) per producer, e.g. per rank."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def read_chunks(spark: SparkSession, path: str, by: str, by_type: str = "int") -> DataFrame:
    """The table = union of all chunks (duplicates kept)."""
    df = spark.read.parquet(path)
    return df.withColumn(by, F.col(by).cast(by_type))
