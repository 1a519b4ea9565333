"""Shared plumbing of the training-data operators: storage every node sees, and size-checked joins."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from ..session import filesystem, ship, work_path
from ..session import written as materialize

__all__ = ["BROADCAST_BYTES", "BROADCAST_ROWS", "Output", "RangeReader", "discard", "filesystem", "let", "map_arrow", "materialize", "parts_for", "small_side", "table", "work_path"]

#: A side is broadcast only if it has been found to have at most this many rows and bytes of values.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 32 << 20
#: Files and bodies that one task reads back.
READ_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def discard(*frames: DataFrame) -> None:
    """Deletes written tables that no later plan reads."""
    for df in frames:
        spark, path = df.sparkSession, df.written_at
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def let(value: Column, body) -> Column:
    """``body`` of the value, which is written and evaluated once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def map_arrow(df: DataFrame, function, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with this package sent to the workers first."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def _bytes_of(column: Column, kind) -> Column:
    """Bytes of a value, 8 for one of a fixed size."""
    if isinstance(kind, StringType | BinaryType):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 8
    if isinstance(kind, ArrayType) and not isinstance(kind.elementType, ArrayType | MapType | StructType | StringType | BinaryType):
        return F.greatest(F.size(column), F.lit(0)) * 8 + 16
    if isinstance(kind, ArrayType | MapType | StructType):
        return F.length(F.to_json(F.struct(column.alias("x"))))
    return F.lit(8)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Marks a materialized frame for broadcast if its rows and its values' bytes are within the limits; else a shuffle join remains."""
    each = sum((_bytes_of(F.col(f"`{f.name}`"), f.dataType) for f in df.schema), F.lit(0)).cast("long")
    n, total = df.agg(F.count("*"), F.coalesce(F.sum(each), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and total <= size else df


def parts_for(spark: SparkSession, size: int) -> int:
    """Tasks to read ``size`` bytes of files back: by bytes, and enough to occupy the cores where files are small."""
    return max(-(-size // READ_BYTES), min(spark.sparkContext.defaultParallelism, -(-size // (READ_BYTES >> 5)), 256), 1)


class Output:
    """A file of a task attempt. Its name is unique to the attempt; only committed manifest rows refer to it."""

    def __init__(self, folder: str, stem: str, suffix: str):
        self.name = f"{stem}-{uuid.uuid4().hex[:12]}{suffix}"
        store, path = filesystem(folder)
        store.create_dir(path, recursive=True)
        self._out = store.open_output_stream(f"{path}/{self.name}", compression=None)
        self.size = 0

    def write(self, data: bytes) -> int:
        """Appends and returns the offset at which the data starts."""
        at = self.size
        self._out.write(data)
        self.size += len(data)
        return at

    def close(self) -> None:
        self._out.close()


class RangeReader:
    """Range reads with one open file at a time (requests come sorted by file)."""

    def __init__(self, folder: str):
        self._store, self._path = filesystem(folder)
        self._name, self._file = None, None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self._name:
            self.close()
            self._file, self._name = self._store.open_input_file(f"{self._path}/{name}"), name
        data = self._file.read_at(length, offset)
        if len(data) != length:
            raise OSError(f"{name}: {length} bytes at {offset} wanted, {len(data)} there")
        return data

    def close(self) -> None:
        if self._file is not None:
            self._file.close()
            self._file, self._name = None, None
