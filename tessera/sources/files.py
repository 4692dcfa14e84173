"""Text and small binary file formats of the reference, read and written by Spark.

* part CSV (S2/K3): header-less, fixed column order, doubles printed as ``%f``;
* wide matrix CSV + JSON sidecar (S3/S7/K4);
* cell text (S4/K5): ``xmin xmax ymin ymax weight``, space separated;
* TSV with header (S5);
* binary column dumps (S6): ``int32 n, double x[n], double y[n][, int32 hit[n]]``.

Everything goes through the DataFrame reader/writer; the column dumps are a
Python data source that reads a file by row ranges and commits what it writes
in one step.
"""

from __future__ import annotations

import os
from fnmatch import fnmatch

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from . import commit as CM
from .commit import DataFile
from .struct_records import CommittedWriter, WrittenFiles, committed_files, packed

# The reference's file layouts.
MATRIX_META_KEYS = ("data_type", "value_type", "rows", "cols", "nnz", "format", "header", "sep",
                    "author", "created")
CELL_TEXT_COLUMNS = ("xmin", "xmax", "ymin", "ymax", "count")
TIMING_COLUMNS = ("Method", "Nrows", "Natoms", "Bytes", "Total", "Transfer", "Analysis")


# ------------------------------------------------------------------ part CSV

def write_part_csv(df: DataFrame, path: str, rank: str = "rank",
                   max_records_per_file: int = 1 << 22) -> None:
    """Header-less CSV parts, one directory per ``rank``; doubles as ``%f`` (6 decimals).

    No shuffle: every task writes its rows into the directory of their rank
    (``rank=<r>/part-*.csv``), so a rank holding most of the rows is still
    written by all tasks in parallel.  ``rank`` also stays inside the rows,
    in its column position, as in the reference format.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DoubleType) or f.dataType.simpleString() == "float":
            cols.append(F.format_string("%f", F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name).cast("string").alias(f.name))
    (df.select(*cols, F.col(rank).alias("_part_rank")).write.mode("overwrite")
     .partitionBy("_part_rank").option("maxRecordsPerFile", max_records_per_file)
     .csv(path, header=False))


def read_part_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A directory tree of header-less CSV parts with a given column order."""
    return (spark.read.schema(schema).option("recursiveFileLookup", "true")
            .csv(path, header=False, mode="FAILFAST"))


# ------------------------------------------------------------------ matrix CSV

def write_matrix_csv(wide: DataFrame, path: str, row_key: str = "i",
                     author: str = "tessera", created: str | None = None) -> None:
    """Wide matrix (one row per ``row_key``, columns C1..Cn) as one CSV with header, and its JSON sidecar.

    The matrix has n rows (bounded by the grid), so one output file is fine.
    Rows and non-zeros are counted while the CSV is written; the sidecar
    ``<path>.mtd`` follows from them, so the matrix is computed once.
    ``created`` is a text; by default the time of the write.
    """
    spark = wide.sparkSession
    value_cols = [c for c in wide.columns if c != row_key]
    nnz = sum(F.when(F.col(c) != 0, 1).otherwise(0) for c in value_cols)
    seen = Observation()
    # observed after the sort: what feeds a sort runs twice, once for the range bounds
    (wide.orderBy(row_key).select(*value_cols).coalesce(1)
     .observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(nnz).cast("bigint").alias("nnz"))
     .write.mode("overwrite").csv(path, header=True))
    vtype = "double" if any(isinstance(wide.schema[c].dataType, DoubleType)
                            for c in value_cols) else "long"
    told = (seen.get["rows"], seen.get["nnz"] or 0)
    made = spark.createDataFrame([("matrix", vtype, told[0], len(value_cols), told[1], "csv", True, ",", author)],
                                 "data_type string, value_type string, rows long, cols long, nnz long, format string, "
                                 "header boolean, sep string, author string")
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss z")
    meta = made.withColumn("created", F.lit(created) if created is not None else now).select(*MATRIX_META_KEYS)
    meta.coalesce(1).write.mode("overwrite").json(path + ".mtd")


def read_matrix_csv(spark: SparkSession, path: str, n_cols: int | None = None,
                    value_type: str = "double", row_name: str = "i") -> DataFrame:
    """Wide matrix CSV with header ``C1..Cn`` -> ``(i, C1..Cn)``, i 1-based in file order.

    Over several files rows go by file name, then by place in the file (Spark
    itself takes larger files first): a row's number is its rank in its own block
    of a file and the rows of the blocks before, so no task numbers all rows.
    """
    if n_cols is None:
        df = spark.read.csv(path, header=True, inferSchema=False)
        schema = StructType([StructField(c, DoubleType() if value_type == "double" else LongType())
                             for c in df.columns])
    else:
        schema = StructType([StructField(f"C{k}", DoubleType() if value_type == "double"
                                         else LongType()) for k in range(1, n_cols + 1)])
    df = spark.read.schema(schema).csv(path, header=True, mode="FAILFAST")
    placed = df.select("*", F.col("_metadata.file_path").alias("_file"),
                       F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_mono"))
    # one row per block of a file
    upto = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    before = (placed.groupBy("_file", "_block").agg(F.count("*").alias("_n"))
              .select("_file", "_block", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before")))
    own = F.row_number().over(Window.partitionBy("_file", "_block").orderBy("_mono"))
    return (placed.withColumn("_own", own).join(before, ["_file", "_block"])
            .select((F.col("_before") + F.col("_own")).cast("int").alias(row_name), *schema.fieldNames()))


def read_matrix_meta(spark: SparkSession, path: str) -> DataFrame:
    """The JSON sidecar as one row (multi-line JSON accepted)."""
    return spark.read.json(path, multiLine=True)


# ------------------------------------------------------------------ cell text

CELL_TEXT_SCHEMA = StructType([StructField(c, DoubleType()) for c in CELL_TEXT_COLUMNS])


def write_cell_text(cells: DataFrame, path: str) -> None:
    """``xmin xmax ymin ymax count``, space separated, no header (plain doubles)."""
    cells.select(*[F.col(c).cast("double") for c in cells.columns[:5]]).write.mode(
        "overwrite").csv(path, sep=" ", header=False)


def read_cell_text(spark: SparkSession, path: str) -> DataFrame:
    """Blank separator lines are skipped by the CSV reader."""
    return spark.read.schema(CELL_TEXT_SCHEMA).csv(path, sep=" ", header=False, mode="FAILFAST")


# ------------------------------------------------------------------ TSV with header

def write_tsv_header(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, sep="\t", header=True)


def read_tsv_header(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    r = spark.read.option("sep", "\t").option("header", True)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    return r.csv(path)


# ------------------------------------------------------------------ binary column dumps

DEFAULT_DUMP_ROWS = 1 << 20


class _Strides(InputPartition):
    """Rows ``first .. first + count`` of a dump file of ``n`` rows: one stretch of each of its columns."""

    def __init__(self, root: str, fs_path: str, n: int, first: int, count: int):
        super().__init__((fs_path, first, count))
        self.root, self.fs_path, self.n, self.first, self.count = root, fs_path, n, first, count


class ColumnDumpReader(DataSourceReader):
    """Cuts each file into row ranges; a task reads its stretch of every column, so no task holds a file."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.with_hit = options.get("hit", "true").lower() == "true"
        self.pattern = options.get("pattern")
        self.rows_per_partition = int(options.get("rowsPerPartition", DEFAULT_DUMP_ROWS))

    def partitions(self):
        _, root = CM.fs_and_path(self.path)
        width = 20 if self.with_hit else 16
        parts = []
        for f in CM.table_files(self.path):
            if self.pattern and not fnmatch(os.path.basename(f.name), self.pattern):
                continue
            n, rest = divmod(f.size - 4, width)
            if rest or n < 0:
                raise ValueError(f"{self.path}/{f.name}: {f.size} bytes do not hold whole rows of {width} bytes")
            for first in range(0, n, self.rows_per_partition) if n else [0]:
                parts.append(_Strides(self.path, f"{root}/{f.name}" if f.name else root, n, first,
                                      min(self.rows_per_partition, n - first)))
        return parts or [_Strides(self.path, "", 0, 0, 0)]

    def read(self, partition: _Strides):
        p = partition
        if not p.fs_path:
            return
        fs, _ = CM.fs_and_path(p.root)
        with fs.open_input_file(p.fs_path) as fh:
            told = int(np.frombuffer(fh.read(4), dtype="<i4")[0])
            if told != p.n:
                raise ValueError(f"{p.fs_path}: {4 + p.n * (20 if self.with_hit else 16)} bytes do not hold {told} rows")

            def stretch(start: int, dtype: str, first: int, count: int) -> np.ndarray:
                size = np.dtype(dtype).itemsize
                fh.seek(start + size * first)
                return np.frombuffer(fh.read(size * count), dtype=dtype, count=count)

            for at in range(p.first, p.first + p.count, 1 << 16):
                m = min(1 << 16, p.first + p.count - at)
                arrays = [pa.array([p.fs_path] * m, pa.string()), pa.array(np.arange(at, at + m, dtype="int32")),
                          pa.array(stretch(4, "<f8", at, m)), pa.array(stretch(4 + 8 * p.n, "<f8", at, m))]
                if self.with_hit:
                    arrays.append(pa.array(stretch(4 + 16 * p.n, "<i4", at, m)))
                yield pa.RecordBatch.from_arrays(arrays, names=["file", "pos", "x", "y", "hit"][:len(arrays)])


class ColumnDumpWriter(CommittedWriter):
    """Files of at most ``rowsPerFile`` rows (their number precedes the columns, so a file's rows are held first)."""

    def __init__(self, options: dict, overwrite: bool):
        super().__init__(options, overwrite)
        self.most = int(options.get("rowsPerFile", DEFAULT_DUMP_ROWS))

    def write(self, iterator):
        from pyspark import TaskContext
        context = TaskContext.get()
        fs, root = CM.fs_and_path(self.path)
        fs.create_dir(root, recursive=True)
        files, held, n, before = [], [], 0, 0

        def flush() -> None:
            t = pa.Table.from_batches(held)
            name = f"dump-{self.mark}-{context.partitionId():06d}-{context.taskAttemptId()}-{len(files):05d}.dat"
            size = 4
            with fs.open_output_stream(f"{root}/{name}") as out:
                out.write(np.array([t.num_rows], dtype="<i4").tobytes())
                for c, kind in zip(t.column_names, ("double", "double", "int")):
                    raw = packed(t.column(c).combine_chunks(), c, kind, before).tobytes()
                    out.write(raw)
                    size += len(raw)
            files.append(DataFile(name, size, t.num_rows))

        for b in iterator:
            while b.num_rows:
                part = b.slice(0, self.most - n)
                held.append(part)
                n += part.num_rows
                b = b.slice(part.num_rows)
                if n == self.most:
                    flush()
                    held, n, before = [], 0, before + n
        if n:
            flush()
        return WrittenFiles(context.partitionId(), files)


class ColumnDumpDataSource(DataSource):
    """``spark.read.format("column_dump").load(path)``: (file, pos, x, y[, hit])."""

    @classmethod
    def name(cls) -> str:
        return "column_dump"

    def schema(self):
        fields = "file string, pos int, x double, y double"
        return fields + (", hit int" if self.options.get("hit", "true").lower() == "true" else "")

    def reader(self, schema) -> DataSourceReader:
        return ColumnDumpReader(self.options)

    def writer(self, schema, overwrite: bool):
        return ColumnDumpWriter(self.options, overwrite)


def _register_dumps(spark: SparkSession) -> None:
    from ..session import ship_package
    ship_package(spark)
    spark.dataSource.register(ColumnDumpDataSource)


def write_column_dump(df: DataFrame, path: str, x: str = "x", y: str = "y",
                      hit: str | None = "hit", max_rows_per_file: int = DEFAULT_DUMP_ROWS,
                      append: bool = False) -> DataFrame:
    """Each task writes its rows as dump files ``int32 n, x[n], y[n][, hit[n]]``.

    Files hold at most ``max_rows_per_file`` rows.  Without ``append`` the rows
    replace those that were there; the table changes in one step, or not at
    all if the write fails.  A null raises.  Returns per file (part, rows, bytes).
    """
    from ..session import qualified
    spark = df.sparkSession
    _register_dumps(spark)
    target = qualified(spark, path.rstrip("/"))
    cols = [F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")]
    if hit:
        cols.append(F.col(hit).cast("int").alias("hit"))
    (df.select(*cols).write.format("column_dump").option("rowsPerFile", str(max_rows_per_file))
     .mode("append" if append else "overwrite").save(target))
    return committed_files(spark, target)


def read_column_dump(spark: SparkSession, path: str, with_hit: bool = True, pattern: str | None = None,
                     rows_per_partition: int = DEFAULT_DUMP_ROWS) -> DataFrame:
    """Dump files -> ``(file, pos, x, y[, hit])``, a row range of a file per task.

    The table's files are read (a folder without a commit log: all files below
    it, whatever their names) unless ``pattern`` (a glob on file names) chooses
    some.  A file whose length does not fit its count raises.
    """
    from ..session import qualified
    _register_dumps(spark)
    r = (spark.read.format("column_dump").option("hit", str(with_hit).lower())
         .option("rowsPerPartition", str(rows_per_partition)))
    if pattern is not None:
        r = r.option("pattern", pattern)
    return r.load(qualified(spark, path))
