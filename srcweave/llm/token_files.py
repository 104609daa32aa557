"""Token-id output: Parquet files of token lists, made for selective reads.

A file holds documents in key order: key, token count, place in the file, and
the ids as a list column.  Ids are dictionary-encoded (16 bits or fewer each
for usual vocabularies); the ascending columns are delta-encoded.  Row groups
and pages are kept small, and the writer adds page indexes, so a reader takes
the metadata columns without touching ids, or the ids of a key range without
reading other pages.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from srcweave.llm.common import text_slices
from srcweave.llm.wordcache import encode, pieces

LAYOUT = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
    "parquet.enable.dictionary#key": "false",
    "parquet.enable.dictionary#local_start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text"
) -> None:
    """Encode every whole text, append `end_id`, and write the ids in ascending key order.

    Columns: part (number of the file's task, ascending with the keys),
    local_start (ids before the row in its part), key, n_tokens, ids.  A null
    text is an empty one: only the end id.  Null keys come first; repeated keys
    stay next to each other, in the order of the input.  An empty table gives
    files without rows.  Other columns are not written.
    """
    ranged = (
        docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("seen"))
        .repartitionByRange("key", "seen")
        .sortWithinPartitions("key", "seen")
    )
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("local_start", T.LongType()),
            T.StructField("key", docs.schema[key].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        table = pieces(tokenizer)
        for batch in batches:
            for first, texts in text_slices(batch.column("text")):
                ids, sizes = encode(texts, table)
                ends = np.cumsum(sizes)
                ids = np.insert(ids, ends, end_id).view(np.int32)
                sizes, ends = sizes + 1, ends + np.arange(1, len(texts) + 1)
                columns = [
                    pa.array(np.full(len(texts), part), pa.int32()),
                    pa.array(start + ends - sizes),
                    batch.column("key").slice(first, len(texts)),
                    pa.array(sizes),
                    pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(ids)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                start += int(ends[-1])

    ranged.mapInArrow(run, schema).write.options(**LAYOUT).parquet(path)


def _shifts(files: DataFrame) -> DataFrame:
    """(part, ids in the parts before it); a row per file."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))


def token_index(spark: SparkSession, path: str, key: str = "key") -> DataFrame:
    """(key, part, start, n_tokens) from the metadata columns alone; start counts over all files."""
    files = spark.read.parquet(path)
    return files.join(_shifts(files), "part").select(
        F.col("key").alias(key), "part", (F.col("shift") + F.col("local_start")).alias("start"), "n_tokens"
    )


def token_checksums(spark: SparkSession, path: str, key: str = "key") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document, read back from the files.

    ids_crc32 is the unsigned CRC-32 of the ids as little-endian unsigned
    32-bit integers.
    """
    files = spark.read.parquet(path)
    schema = T.StructType(
        [f for f in files.schema.fields if f.name != "ids"] + [T.StructField("ids_crc32", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4", copy=False).tobytes()
            ends = np.cumsum(np.diff(lists.offsets.to_numpy())) * 4
            sums, at = [], 0
            for end in ends.tolist():
                sums.append(zlib.crc32(flat[at:end]))
                at = end
            columns = [batch.column(n) for n in schema.names[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sums, pa.int64())], names=schema.names)

    return files.mapInArrow(run, schema).join(_shifts(files), "part").select(
        F.col("key").alias(key), (F.col("shift") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_tokens(spark: SparkSession, path: str, first, last) -> DataFrame:
    """(key, ids) of a key range; row groups and pages outside it are skipped by their statistics."""
    return spark.read.parquet(path).where(F.col("key").between(first, last)).select("key", "ids")
