"""Rows that stay where they are read, and tables that come to them."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import RDD
from pyspark.serializers import PairDeserializer
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .kernels import slices

#: Bytes of text in one piece of a block, one row at least.
SLICE = 1 << 18
Batches = Iterator[pa.RecordBatch]


def trim() -> None:
    """Gives freed memory back, as a worker waits for its next task with all that it has grown to."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def _trimmed(made: Iterable) -> Iterator:
    yield from made
    trim()


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _batches(parts: Iterable[bytes]) -> Batches:
    for part in parts:
        yield from pa.ipc.open_stream(bytes(part))


class Blocks:
    """The partitions of a DataFrame as numbered blocks.

    A block's rows never move: tables keyed by ``block`` are dealt by that
    number, and partition i of them is zipped with block i.  What a block asks
    of a table is aggregated in the block first, so the shuffle carries what is
    distinct in a block and not what stands in its rows.

    Both uses read the partitions of one plan, so their numbers agree, also
    when a lost executor has them computed again, as long as the plan gives the
    same rows in the same partition each time; tables in files do.  Callers let
    a block's part of a table say what it was made of and compare, so that a
    plan that does not keep to this fails.  A block is as large as a partition
    of the scan (``spark.sql.files.maxPartitionBytes``) and is in memory once
    while it is met.
    """

    def __init__(self, df: DataFrame, text: str):
        at = df.columns.index(text)

        def pack(batches: Batches) -> Batches:
            parts = [_ipc(batch.slice(lo, hi - lo)) for batch in batches for lo, hi in slices(batch.column(at), SLICE)]
            yield pa.RecordBatch.from_arrays([pa.array([parts], pa.list_(pa.binary()))], ["parts"])
            del parts
            trim()

        self.df, self.spark = df, df.sparkSession
        #: One row a block, with all its pieces; a task runs few Python workers at a time, as each has its memory.
        self.rdd = df.mapInArrow(pack, "parts array<binary>").rdd
        self.n = self.rdd.getNumPartitions()

    def ask(self, f: Callable[[int, Batches], Batches], schema: T.StructType | str) -> DataFrame:
        """What ``f`` makes of each block's number and rows."""

        def run(batches: Batches) -> Batches:
            from pyspark import TaskContext

            return _trimmed(f(TaskContext.get().partitionId(), batches))

        return self.df.mapInArrow(run, schema)

    def meet(self, table: DataFrame, f: Callable[[Batches, Batches], Batches], schema: T.StructType | str) -> DataFrame:
        """What ``f`` makes of each block's part of ``table`` (column ``block``) and the block's rows; as few rows as documents."""

        def pack(batches: Batches) -> Batches:
            yield pa.RecordBatch.from_arrays([pa.array([[_ipc(b) for b in batches]], pa.list_(pa.binary()))], ["parts"])

        if not self.n:
            return self.spark.createDataFrame([], schema)
        mine = table.repartitionById(self.n, table["block"]).drop("block").mapInArrow(pack, "parts array<binary>").rdd
        if not mine.getNumPartitions():  # a table known to be empty has no partitions
            mine = self.spark.sparkContext.parallelize([([],)] * self.n, self.n)
        # either side has one row a partition, so their batches agree; RDD.zip would put two more workers between to batch them anew
        both = RDD(self.rdd._jrdd.zip(mine._jrdd), self.spark.sparkContext, PairDeserializer(self.rdd._jrdd_deserializer, mine._jrdd_deserializer))
        met = both.flatMap(lambda z: _trimmed(row for b in f(_batches(z[1][0]), _batches(z[0][0])) for row in zip(*(c.to_pylist() for c in b.columns), strict=True)))
        return self.spark.createDataFrame(met, schema)
