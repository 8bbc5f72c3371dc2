"""Data sources for SQLite tables, .npy arrays and Arrow IPC files: each splits into ranges that executors read for themselves.

Files must lie in a folder that all executors see. `register(spark)` makes them known as formats "sqlite", "npy" and "arrow_ipc".
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructField, StructType

PAGE = 1_000_000
# The columns of node and edge files.
NODES = pa.schema([("id", pa.uint32()), ("incoming_degree", pa.uint32()), ("outgoing_degree", pa.uint32())])
EDGES = pa.schema([("weight", pa.float32()), ("source", pa.int32()), ("target", pa.int32())])


class Range(InputPartition):
    def __init__(self, start: int, stop: int) -> None:
        self.start, self.stop = start, stop


def ranges(low: int, high: int, page: int) -> list[Range]:
    return [Range(a, min(a + page, high)) for a in range(low, high, page)] or [Range(low, low)]


def _option(options: dict, name: str, default: str | None = None) -> str:
    found = options.get(name, default)
    if found is None:
        raise ValueError(f"option {name} is needed")
    return found


# ---- SQLite


_SQL_TYPES = {"INT": LongType(), "CHAR": StringType(), "TEXT": StringType(), "CLOB": StringType(), "REAL": DoubleType(), "FLOA": DoubleType(), "DOUB": DoubleType(), "BLOB": BinaryType()}


class SqliteSource(DataSource):
    """A table by ranges of rowid; only the columns of the requested schema are read. Options: path, table, page."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> StructType:
        table = _option(self.options, "table")
        with sqlite3.connect(f"file:{_option(self.options, 'path')}?mode=ro", uri=True) as db:
            columns = db.execute(f'PRAGMA table_info("{table}")').fetchall()
        if not columns:
            raise ValueError(f"no table {table}")
        return StructType([StructField(name, next((t for k, t in _SQL_TYPES.items() if k in (kind or "").upper()), StringType())) for _, name, kind, *_ in columns])

    def reader(self, schema: StructType) -> DataSourceReader:
        return SqliteReader(self.options, schema)


class SqliteReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType) -> None:
        self.path, self.table, self.schema = _option(options, "path"), _option(options, "table"), schema
        self.page = int(_option(options, "page", str(PAGE)))

    def _open(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def partitions(self) -> list[InputPartition]:
        with self._open() as db:
            low, high = db.execute(f'SELECT min(rowid), max(rowid) FROM "{self.table}"').fetchone()
        return [Range(0, 0)] if low is None else ranges(low, high + 1, self.page)

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        names, arrow = ", ".join(f'"{f.name}"' for f in self.schema), to_arrow_schema(self.schema)
        with self._open() as db:
            rows = db.execute(f'SELECT {names} FROM "{self.table}" WHERE rowid >= ? AND rowid < ?', (part.start, part.stop))
            while batch := rows.fetchmany(50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*batch, strict=True), arrow.types, strict=True)], schema=arrow)


# ---- NumPy


_NP_TYPES = {"i1": ByteType(), "i2": ShortType(), "i4": IntegerType(), "i8": LongType(), "u1": ShortType(), "u2": IntegerType(), "u4": LongType(), "u8": LongType(), "f2": FloatType(), "f4": FloatType(), "f8": DoubleType()}


class NpySource(DataSource):
    """(idx, value) of a 1-D array, (idx, value: array) of a 2-D one; rows are ranges of a memory map. Options: path, page."""

    @classmethod
    def name(cls) -> str:
        return "npy"

    def schema(self) -> StructType:
        a = np.load(_option(self.options, "path"), mmap_mode="r")
        kind = _NP_TYPES[a.dtype.str[1:]]
        if a.ndim not in (1, 2):
            raise ValueError("arrays of one or two dimensions only")
        return StructType([StructField("idx", LongType(), False), StructField("value", kind if a.ndim == 1 else ArrayType(kind, False), False)])

    def reader(self, schema: StructType) -> DataSourceReader:
        return NpyReader(self.options, schema)


class NpyReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType) -> None:
        self.path, self.page, self.schema = _option(options, "path"), int(_option(options, "page", str(PAGE))), schema

    def partitions(self) -> list[InputPartition]:
        return ranges(0, len(np.load(self.path, mmap_mode="r")), self.page)

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(self.schema)
        a = np.load(self.path, mmap_mode="r")
        for at in range(part.start, part.stop, 50_000):
            x = np.array(a[at : min(at + 50_000, part.stop)])
            kind = arrow.field("value").type
            if x.ndim == 2:
                flat = pa.array(x.ravel()).cast(kind.value_type)
                value = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), flat).cast(kind)
            else:
                value = pa.array(x).cast(kind)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + len(x))), value], schema=arrow)


# ---- Arrow IPC


class ArrowIpcSource(DataSource):
    """An Arrow IPC file by record batches. Options: path; kind (nodes, edges or knn): the file's schema, names, order and types, must equal that kind's, or reading fails."""

    @classmethod
    def name(cls) -> str:
        return "arrow_ipc"

    def schema(self) -> StructType:
        with pa.memory_map(_option(self.options, "path")) as f:
            found = pa.ipc.open_file(f).schema
        check_kind(found, self.options.get("kind"))
        return from_arrow_schema(_signed(found))

    def reader(self, schema: StructType) -> DataSourceReader:
        return ArrowIpcReader(self.options, schema)


def check_kind(found: pa.Schema, kind: str | None) -> None:
    """Raise unless a file's schema equals that of its stated kind; the length of the lists of neighbours is free."""
    if kind is None:
        return
    if kind == "knn":
        lists = [t for t in found.types if pa.types.is_fixed_size_list(t)]
        k = lists[0].list_size if lists else 0
        want = pa.schema([("index", pa.list_(pa.int32(), k)), ("dist", pa.list_(pa.float32(), k))])
    else:
        want = {"nodes": NODES, "edges": EDGES}[kind]
    if not found.equals(want):
        raise ValueError(f"the file's schema is {found}, wanted is {want}")


def _signed(schema: pa.Schema) -> pa.Schema:
    """Spark has no unsigned numbers: the next wider signed ones."""
    wider = {pa.uint8(): pa.int16(), pa.uint16(): pa.int32(), pa.uint32(): pa.int64(), pa.uint64(): pa.int64()}

    def kind(t: pa.DataType) -> pa.DataType:
        return pa.list_(kind(t.value_type)) if pa.types.is_fixed_size_list(t) or pa.types.is_list(t) else wider.get(t, t)

    return pa.schema([pa.field(f.name, kind(f.type), f.nullable) for f in schema])


class ArrowIpcReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType) -> None:
        self.path, self.schema, self.kind = _option(options, "path"), schema, options.get("kind")

    def partitions(self) -> list[InputPartition]:
        with pa.memory_map(self.path) as f:
            check_kind(pa.ipc.open_file(f).schema, self.kind)
            return ranges(0, pa.ipc.open_file(f).num_record_batches, 1)

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        want = to_arrow_schema(self.schema)
        with pa.memory_map(self.path) as f:
            reader = pa.ipc.open_file(f)
            if [x.name for x in want if x.name not in reader.schema.names]:
                raise ValueError(f"the file has {reader.schema.names}, wanted are {want.names}")
            for i in range(part.start, part.stop):
                batch = reader.get_batch(i)
                yield pa.RecordBatch.from_arrays([batch.column(x.name).cast(x.type) for x in want], schema=want)


def register(spark: SparkSession) -> None:
    for source in (SqliteSource, NpySource, ArrowIpcSource):
        spark.dataSource.register(source)
