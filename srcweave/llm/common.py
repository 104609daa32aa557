"""Helpers the operators of this package share: staged tables, Arrow columns, partition counts."""

from __future__ import annotations

import sys
import types
import uuid
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from srcweave.session import scratch_dir


class Scratch:
    """Parquet tables of one operator call, in the folder `spark.checkpoint.dir` names.

    A staged table cuts lineage: executors lost later cost nothing that was
    written.  `drop` removes a table as soon as the next one replaces it; what
    a returned DataFrame still reads has to stay.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{scratch_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stage(self, df: DataFrame, name: str, **options) -> DataFrame:
        # what was shuffled for a table is of no use once it is written, and may be larger than the input
        setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, "true")
        try:
            df.write.options(**options).parquet(self.path(name))
        finally:
            self.spark.conf.set(setting, before)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def small_batches(spark: SparkSession, rows: int):
    """Hand Python at most `rows` rows at a time, for rows of many kilobytes; holds for what is run inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def lower_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand Python at most `rows` rows at a time from now on, for frames of whole documents that are run later.

    A batch is held by the JVM, outside its heap and in buffers that double, and by the worker, given and returned.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = int(spark.conf.get(name))
    spark.conf.set(name, min(rows, before) if before > 0 else rows)


_KEPT = "__given_"


def without(df: DataFrame, *names: str) -> DataFrame:
    """`df` with its columns of these names, if any, put aside under another; `restored` brings them back."""
    for column in df.columns:
        if column.lower() in names:
            df = df.withColumnRenamed(column, _KEPT + column)
    return df


def restored(df: DataFrame) -> DataFrame:
    for column in df.columns:
        if column.startswith(_KEPT):
            df = df.withColumnRenamed(column, column.removeprefix(_KEPT))
    return df


def worker_memory(owner: str) -> dict:
    """What an operator keeps in a Python worker from task to task, until another operator needs the room.

    Functions of this package are shipped by value and have globals of their
    own in each task, so these don't last.
    """
    place = sys.modules.setdefault("_srcweave_worker", types.ModuleType("_srcweave_worker"))
    if getattr(place, "owner", None) != owner:
        place.owner, place.held = owner, {}
    return place.held


def raw_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; a null counts as empty text."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def slices(texts: list[bytes], limit: int = 1 << 20):
    """(first, last) index ranges of consecutive texts, about `limit` bytes each, one text at least."""
    yield from sized_slices(map(len, texts), limit)


def sized_slices(sizes, limit: int = 1 << 20):
    """The same from the sizes of the texts."""
    first, held, i = 0, 0, -1
    for i, size in enumerate(sizes):
        if i > first and held + size > limit:
            yield first, i
            first, held = i, 0
        held += size
    if i >= first:
        yield first, i + 1


def text_slices(column: pa.Array, limit: int = 1 << 20):
    """(first, piece of the column) with about `limit` bytes in each piece."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for first, last in sized_slices(sizes, limit):
        yield first, column.slice(first, last - first)
