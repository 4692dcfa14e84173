"""Packed fixed-width C-struct rows as a Spark data source: batch, streaming and sink.

A layout is a list of ``(name, type)`` with the five C field types
``char int long float double``; offsets, padding and row size follow the C
compiler's natural alignment (numpy ``align=True`` computes the same).

Reading: the driver takes the table's files from its commit log (see
:mod:`.commit`; a folder without one: all its files) and cuts each one into
byte ranges of whole rows (one ``InputPartition`` per range); each task reads
its range with one ``seek`` + ``read`` and turns it into an Arrow batch with
numpy -- no per-row Python.  Column pruning is by the ``columns`` option (a
Python source cannot see Spark's pruned schema).

Writing: every task writes its file (or files, see ``splitBy``) under names of
its own and tells the driver their sizes; the driver commits them all in one step or, if a task fails
for good, removes them, so the table is the old or the new one and nothing in
between.  A null or a value that does not fit its C type stops the write.

Streaming: the log is the order.  An offset is (version, rows taken from it);
a micro-batch takes at most ``maxRowsPerTrigger`` rows, cut anywhere inside a
file (and, if set, at most ``maxFilesPerTrigger`` whole files), and versions are served without gaps, so producers that name their
version (``version`` option) may commit in any order.  What a consumer has
planned and finished is kept beside the log, where the producer can read it
(:func:`acknowledged`).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader,
                                    InputPartition, WriterCommitMessage)
from pyspark.sql.types import (ByteType, DoubleType, FloatType, IntegerType, LongType,
                               StructField, StructType)

from . import commit as CM
from .commit import DataFile, fs_and_path

# The C field types the reference accepts and their Spark types.
C_TYPES = {
    "char": ("i1", ByteType()),
    "int": ("i4", IntegerType()),
    "long": ("i8", LongType()),
    "float": ("f4", FloatType()),
    "double": ("f8", DoubleType()),
}

# Fixed record layouts of the reference (field order = C declaration order).
TIMESTEP = (("id", "long"), ("rank", "int"), ("natoms", "int"), ("energy", "double"))
ATOM = (("timestep", "long"), ("rank", "int"), ("symbol", "char"), ("num", "int"),
        ("x", "double"), ("y", "double"), ("z", "double"),
        ("force_x", "double"), ("force_y", "double"), ("force_z", "double"))
POINT = (("x", "double"), ("y", "double"), ("category", "int"))

DEFAULT_ROWS_PER_PARTITION = 1 << 20
# Fixed value: the reference keeps at most 4 blocks of 262,144 rows in flight.
ROWS_IN_FLIGHT = 4 * 262_144


def parse_fields(spec: str | Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """``"id:long,rank:int"`` or a list of pairs -> list of pairs (validated)."""
    if isinstance(spec, str):
        pairs = [tuple(p.strip().split(":")) for p in spec.split(",") if p.strip()]
    else:
        pairs = [tuple(p) for p in spec]
    for name, t in pairs:
        if t not in C_TYPES:
            raise ValueError(f"field {name!r}: unsupported C type {t!r}")
    return [(str(n), str(t)) for n, t in pairs]


def fields_spec(fields: Sequence[tuple[str, str]]) -> str:
    return ",".join(f"{n}:{t}" for n, t in fields)


def record_dtype(fields: Sequence[tuple[str, str]], align: bool = True,
                 byteorder: str = "=") -> np.dtype:
    """numpy dtype with the C layout (offsets, padding, size)."""
    return np.dtype([(n, byteorder + C_TYPES[t][0]) for n, t in fields], align=align)


def layout(fields: Sequence[tuple[str, str]], align: bool = True) -> dict:
    """Offsets and row size, e.g. Atom -> size 72, symbol at 12, num at 16."""
    dt = record_dtype(fields, align)
    return {"size": dt.itemsize, "offsets": {n: dt.fields[n][1] for n, _ in fields}}


def fields_of(schema: StructType) -> list[tuple[str, str]]:
    """The record layout that holds rows of a Spark schema; a type without a C counterpart raises."""
    known = {spark_type: name for name, (_, spark_type) in C_TYPES.items()}
    for f in schema.fields:
        if f.dataType not in known:
            raise ValueError(f"field {f.name!r}: {f.dataType.simpleString()} has no place in a packed struct")
    return [(f.name, known[f.dataType]) for f in schema.fields]


def spark_schema(fields: Sequence[tuple[str, str]], columns: Sequence[str] | None = None) -> StructType:
    keep = set(columns) if columns else None
    return StructType([StructField(n, C_TYPES[t][1], nullable=False)
                       for n, t in fields if keep is None or n in keep])


class _Range(InputPartition):
    """Rows ``first_row .. first_row + nrows`` of one file (``fs_path`` inside ``root``'s FS)."""

    def __init__(self, root: str, fs_path: str, first_row: int, nrows: int):
        super().__init__((fs_path, first_row, nrows))
        self.root, self.fs_path, self.first_row, self.nrows = root, fs_path, first_row, nrows


class _Layout:
    """What the batch and the streaming reader share: options, row ranges, decoding."""

    def __init__(self, options: dict, schema: StructType):
        self.path = options["path"]
        self.fields = parse_fields(options["fields"])
        self.align = options.get("align", "true").lower() == "true"
        self.byteorder = options.get("byteorder", "=")
        self.rows_per_partition = int(options.get("rowsPerPartition", DEFAULT_ROWS_PER_PARTITION))
        self.columns = [f.name for f in schema.fields]

    def rows_of(self, file: DataFile) -> int:
        size = record_dtype(self.fields, self.align).itemsize
        nrows, rest = divmod(file.size, size)
        if rest:
            raise ValueError(f"{self.path}/{file.name}: {file.size} bytes are no whole number of rows of {size} bytes")
        return nrows

    def ranges(self, file: DataFile, first: int, stop: int) -> list[_Range]:
        _, root = fs_and_path(self.path)
        path = f"{root}/{file.name}" if file.name else root
        return [_Range(self.path, path, at, min(self.rows_per_partition, stop - at))
                for at in range(first, stop, self.rows_per_partition)]

    def decoded(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        if partition.nrows == 0:
            return
        dt = record_dtype(self.fields, self.align, self.byteorder)
        fs, _ = fs_and_path(partition.root)
        chunk = 1 << 16
        with fs.open_input_file(partition.fs_path) as fh:
            for off in range(0, partition.nrows, chunk):
                n = min(chunk, partition.nrows - off)
                fh.seek((partition.first_row + off) * dt.itemsize)
                buf = fh.read(n * dt.itemsize)
                arr = np.frombuffer(buf, dtype=dt, count=n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(arr[c]).astype(dt[c].newbyteorder("="),
                                                                  copy=False))
                     for c in self.columns], names=self.columns)


class StructRecordsReader(_Layout, DataSourceReader):
    def partitions(self):
        parts = [r for f in CM.table_files(self.path) for r in self.ranges(f, 0, self.rows_of(f))]
        return parts or [_Range(self.path, "", 0, 0)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        return self.decoded(partition)


class StructRecordsStreamReader(_Layout, DataSourceStreamReader):
    """Micro-batches of bounded size in log order; see the module's text."""

    def __init__(self, options: dict, schema: StructType):
        super().__init__(options, schema)
        self.limit = int(options.get("maxRowsPerTrigger", ROWS_IN_FLIGHT))
        self.most_files = int(options.get("maxFilesPerTrigger", 0))
        self.consumer = options.get("consumer", "default")
        self.planned: tuple[int, int] | None = None

    def _versions(self) -> list[CM.Version]:
        fs, root = fs_and_path(self.path)
        return CM.log_versions(fs, root)

    def _note(self, **what) -> None:
        fs, root = fs_and_path(self.path)
        path = f"{root}/{CM.LOG}/consumers/{self.consumer}.json"
        CM.put_json(fs, path, (CM.get_json(fs, path) or {}) | what)

    def _kept(self) -> dict:
        fs, root = fs_and_path(self.path)
        return CM.get_json(fs, f"{root}/{CM.LOG}/consumers/{self.consumer}.json") or {}

    def initialOffset(self) -> dict:
        """Only asked by a query that starts anew: the table's first version, or the one that replaced it."""
        versions = self._versions()
        first = current_first(versions)
        self.planned = (first, 0)
        self._note(first=first, planned=[first, 0])
        return {"version": first, "row": 0}

    def latestOffset(self) -> dict:
        """What follows the rows planned last, up to the bounds of a micro-batch or the first missing version."""
        versions = {v.number: v for v in self._versions()}
        number, row = self.planned or self._kept().get("planned") or (current_first(list(versions.values())), 0)
        left, files = self.limit, self.most_files or -1
        while number in versions and left > 0 and files != 0:
            at = 0
            for f in versions[number].files:
                rows = self.rows_of(f)
                if row < at + rows and left > 0 and files != 0:
                    take = min(left, at + rows - row)
                    row, left, files = row + take, left - take, files - 1
                at += rows
            if row < at:
                break
            number, row = number + 1, 0
        return {"version": number, "row": row}

    def partitions(self, start: dict, end: dict) -> list[_Range]:
        a, b = (start["version"], start["row"]), (end["version"], end["row"])
        versions = {v.number: v for v in self._versions()}
        out, first_of_all = [], self._kept().get("first", a[0])
        for number in range(a[0], b[0] + 1):
            first = a[1] if number == a[0] else 0
            stop = b[1] if number == b[0] else None
            if stop == 0:
                continue
            if number not in versions or (versions[number].overwrite and number != first_of_all):
                raise ValueError(f"{self.path}: version {number} was {'replaced' if number in versions else 'removed'} "
                                 "under a running stream")
            at = 0
            for f in versions[number].files:
                rows = self.rows_of(f)
                out += self.ranges(f, max(first - at, 0), rows if stop is None else min(max(stop - at, 0), rows))
                at += rows
        self.planned = b
        self._note(planned=list(b))
        return out

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        return self.decoded(partition)

    def commit(self, end: dict) -> None:
        self._note(finished=[end["version"], end["row"]])


def current_first(versions: list[CM.Version]) -> int:
    """Number of the version that a new stream starts with (1 before any is there)."""
    return CM.current(versions)[0].number if versions else 1


def acknowledged(path: str) -> dict[str, tuple[int, int]]:
    """Per consumer the (version, rows of it) up to which its stream has finished: what a producer may let go."""
    from pyarrow import fs as pafs
    fs, root = fs_and_path(path)
    folder = f"{root}/{CM.LOG}/consumers"
    if fs.get_file_info(folder).type != pafs.FileType.Directory:
        return {}
    told = {f.base_name[:-5]: CM.get_json(fs, f.path) for f in fs.get_file_info(pafs.FileSelector(folder))
            if f.extension == "json"}
    return {name: tuple(t["finished"]) for name, t in told.items() if "finished" in t}


@dataclass
class WrittenFiles(WriterCommitMessage):
    """What one task wrote."""

    part: int
    files: list[DataFile]


class CommittedWriter(DataSourceArrowWriter):
    """The driver's half of a write, shared by the file formats: commit all tasks' files, or take them away."""

    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.overwrite = overwrite
        self.number = int(options["version"]) if "version" in options else None
        self.mark = uuid.uuid4().hex[:12]

    def commit(self, messages: list[WrittenFiles | None]) -> None:
        told = sorted((m for m in messages if m is not None), key=lambda m: m.part)
        CM.publish(self.path, [f for m in told for f in m.files], self.overwrite, self.number)

    def abort(self, messages: list[WrittenFiles | None]) -> None:
        """Also the files of tasks that never reported: all that carry this write's mark."""
        fs, root = fs_and_path(self.path)
        try:
            found = CM.visible_files(fs, root)
        except FileNotFoundError:
            return
        CM.remove_files(self.path, [f.name for f in found if f"-{self.mark}-" in f.name])


class StructRecordsWriter(CommittedWriter):
    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        super().__init__(options, overwrite)
        self.fields = parse_fields(options["fields"])
        self.align = options.get("align", "true").lower() == "true"
        self.split_by = options.get("splitBy")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFiles:
        from pyspark import TaskContext
        dt = record_dtype(self.fields, self.align)
        fs, root = fs_and_path(self.path)
        fs.create_dir(root, recursive=True)
        context = TaskContext.get()
        files: list[DataFile] = []
        out, held, value, rows = None, 0, None, 0
        try:
            for b in iterator:
                arr = np.zeros(b.num_rows, dtype=dt)
                for n, t in self.fields:
                    arr[n] = packed(b.column(b.schema.get_field_index(n)), n, t, rows)
                rows += b.num_rows
                for run in self.runs(arr):
                    own = run[0][self.split_by] if self.split_by else None
                    if out is None or own != value:
                        if out is not None:
                            out.close()
                            files.append(DataFile(name, held * dt.itemsize, held))
                        # the attempt is in the name: two attempts of a task never write to one file
                        name = (f"part-{self.mark}-{context.partitionId():06d}-{context.taskAttemptId()}"
                                f"-{len(files):05d}.bin")
                        out, held, value = fs.open_output_stream(f"{root}/{name}"), 0, own
                    out.write(run.tobytes())
                    held += len(run)
        finally:
            if out is not None:
                out.close()
        if held:
            files.append(DataFile(name, held * dt.itemsize, held))
        return WrittenFiles(context.partitionId(), files)

    def runs(self, arr: np.ndarray) -> Iterator[np.ndarray]:
        """The rows cut where the ``splitBy`` column changes; whole without one."""
        if not len(arr):
            return
        cuts = np.flatnonzero(arr[self.split_by][1:] != arr[self.split_by][:-1]) + 1 if self.split_by else []
        yield from np.split(arr, cuts)


def packed(values: pa.Array, name: str, c_type: str, before: int) -> np.ndarray:
    """A column as C values; a null or a value that the type cannot hold raises with its column and row."""
    if values.null_count:
        row = before + values.is_null().to_pylist().index(True)
        raise ValueError(f"column {name!r}, row {row} of its task: null, which a packed struct cannot hold")
    try:
        return values.cast(pa.from_numpy_dtype(np.dtype(C_TYPES[c_type][0]))).to_numpy(zero_copy_only=False)
    except pa.ArrowInvalid as e:
        raise ValueError(f"column {name!r}, from row {before} of its task on: {e}") from e


class StructRecordsDataSource(DataSource):
    """``spark.read.format("struct_records").option("fields", ...).load(path)``."""

    @classmethod
    def name(cls) -> str:
        return "struct_records"

    def schema(self):
        fields = parse_fields(self.options["fields"])
        cols = self.options.get("columns")
        return spark_schema(fields, cols.split(",") if cols else None)

    def reader(self, schema: StructType) -> DataSourceReader:
        return StructRecordsReader(self.options, schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return StructRecordsStreamReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return StructRecordsWriter(self.options, schema, overwrite)


def register(spark: SparkSession) -> None:
    from ..session import ship_package
    ship_package(spark)
    spark.dataSource.register(StructRecordsDataSource)


def scan_struct(spark: SparkSession, path: str, fields, columns: Sequence[str] | None = None,
                align: bool = True, rows_per_partition: int = DEFAULT_ROWS_PER_PARTITION) -> DataFrame:
    """Read packed struct rows as a typed DataFrame (non-null columns)."""
    register(spark)
    r = (spark.read.format("struct_records").option("fields", fields_spec(parse_fields(fields)))
         .option("align", str(align).lower()).option("rowsPerPartition", str(rows_per_partition)))
    if columns:
        r = r.option("columns", ",".join(columns))
    from ..session import qualified
    return r.load(qualified(spark, path))


def stream_struct(spark: SparkSession, path: str, fields, consumer: str = "default",
                  max_rows: int = ROWS_IN_FLIGHT, max_files: int = 0, align: bool = True) -> DataFrame:
    """The table's rows as a stream, in log order, at most ``max_rows`` (and, if not 0, ``max_files``) a micro-batch."""
    from ..session import qualified
    register(spark)
    return (spark.readStream.format("struct_records").option("fields", fields_spec(parse_fields(fields)))
            .option("align", str(align).lower()).option("consumer", consumer)
            .option("maxRowsPerTrigger", str(max_rows)).option("maxFilesPerTrigger", str(max_files))
            .load(qualified(spark, path)))


def write_struct(df: DataFrame, path: str, fields, align: bool = True, append: bool = False,
                 version: int | None = None, split_by: str | None = None) -> DataFrame:
    """Write each partition as one file of packed rows; returns per file (part, rows, bytes).

    Without ``append`` the rows replace those that were there; either way the
    table changes in one step at the end, or not at all if the write fails.
    ``version`` names the commit (see the streaming order); by default the
    next one is taken.  With ``split_by`` a new file starts where the value of
    that field changes.
    """
    from ..session import qualified
    spark = df.sparkSession
    register(spark)
    fields = parse_fields(fields)
    target = qualified(spark, path.rstrip("/"))
    writer = (df.select(*[n for n, _ in fields]).write.format("struct_records")
              .option("fields", fields_spec(fields)).option("align", str(align).lower()))
    if version is not None:
        writer = writer.option("version", str(version))
    if split_by is not None:
        writer = writer.option("splitBy", split_by)
    writer.mode("append" if append else "overwrite").save(target)
    return committed_files(spark, target, version)


def committed_files(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """(part, rows, bytes) of the files of a version, the last one by default; one row per file."""
    fs, root = fs_and_path(target)
    versions = {v.number: v for v in CM.log_versions(fs, root)}
    files = versions[version if version is not None else max(versions)].files
    return spark.createDataFrame([(k, f.rows, f.size) for k, f in enumerate(files)], "part int, rows long, bytes long")
