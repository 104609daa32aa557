"""Token counts of documents in flat token files without an index.

A flat file is a run of token ids of 2 or 4 little-endian bytes; an
end-of-document id closes each document.  Files are cut into blocks of bounded
size.  A task searches its block for the end id as one vector comparison; a
prefix scan over the blocks of a file then carries the last end before each
block and the number of documents before it, which stitches documents that
cross block boundaries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from srcweave.llm.common import Scratch, text_slices
from srcweave.llm.wordcache import encode, pieces

# Ids of a block.
BLOCK_TOKENS = 4 << 20


def write_flat_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, text: str = "text", width: int = 2
) -> None:
    """Encode every whole text and write flat token files: ids of `width` bytes, each text closed by `end_id`.

    Texts keep the order of the rows in each partition of `docs`; a null text
    is an empty one.  Strings of special tokens in a text are ordinary text, so
    the end id never occurs inside a document.  Written by Spark's text writer,
    whose line separator is the end id, hence committed once per task and on
    any file system Spark knows.
    """
    kind = {2: "<u2", 4: "<u4"}[width]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(tokenizer, ordinary=True)
        for batch in batches:
            for _, texts in text_slices(batch.column(0)):
                ids, sizes = encode(texts, table)
                if len(ids) and int(ids.max()) >> (8 * width):
                    raise ValueError(f"a token id needs more than {width} bytes")
                flat = ids.astype(kind).tobytes()
                ends = (np.cumsum(sizes) * width).tolist()
                rows = [flat[s:e] for s, e in zip([0, *ends], ends, strict=False)]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["ids"])

    separator = np.array([end_id], kind).tobytes().decode("latin-1")
    flat = docs.select(text).mapInArrow(run, "ids binary")
    flat.select(F.col("ids").cast("string")).write.option("lineSep", separator).option("encoding", "ISO-8859-1").text(path)


def count_tokens(
    spark: SparkSession, path: str, end_id: int, width: int = 2, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """(file, doc_no, start, n_tokens, closed) of every document in the flat files of a folder.

    start and n_tokens count ids, without the end id.  Two end ids in a row are
    a document of no tokens.  Ids behind the last end id are a document that
    isn't closed.  A file without ids has no documents; a file whose length is
    no multiple of `width` is an error.
    """
    scratch = Scratch(spark, "separators")
    kind = {2: "<u2", 4: "<u4"}[width]
    step = block_tokens * width
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    blocks = (
        files.where("length > 0")
        .select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(step))).alias("offset"))
        .repartition("path", "offset")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for place, length, offset in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if length % width:
                    raise ValueError(f"{place}: {length} bytes are no whole ids")
                system, inner = fs.FileSystem.from_uri(place)
                with system.open_input_file(inner) as source:
                    ids = np.frombuffer(source.read_at(min(step, length - offset), offset), kind)
                first = offset // width
                ends = np.flatnonzero(ids == end_id).astype(np.int64) + first
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([place]),
                        pa.array([first], pa.int64()),
                        pa.array([first + len(ids)], pa.int64()),
                        pa.array([length // width], pa.int64()),
                        pa.array([ends.tolist()], pa.list_(pa.int64())),
                    ],
                    names=["file", "first", "next", "total", "ends"],
                )

    found = scratch.stage(
        blocks.mapInArrow(run, "file string, first long, next long, total long, ends array<long>"), "blocks"
    )
    before = Window.partitionBy("file").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    carried = found.select(
        "file",
        "first",
        F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).alias("docs"),
        (F.coalesce(F.max(F.try_element_at("ends", F.lit(-1))).over(before), F.lit(-1)) + 1).alias("open"),
    )
    stitched = found.join(carried, ["file", "first"])
    tail = F.when((F.col("next") == F.col("total")), F.col("total"))
    after = F.when(F.size("ends") > 0, F.try_element_at("ends", F.lit(-1)) + 1).otherwise(F.col("open"))
    ends = F.when(tail > after, F.concat("ends", F.array(tail))).otherwise(F.col("ends"))
    starts = F.concat(F.array("open"), F.transform("ends", lambda e: e + 1))
    each = stitched.select("file", "docs", "total", "ends", F.posexplode(F.arrays_zip(ends.alias("e"), starts.alias("s"))))
    rows = each.where(F.col("col.e").isNotNull())
    return rows.select(
        "file",
        (F.col("docs") + F.col("pos")).alias("doc_no"),
        F.col("col.s").alias("start"),
        (F.col("col.e") - F.col("col.s")).alias("n_tokens"),
        (F.col("pos") < F.size("ends")).alias("closed"),
    )
