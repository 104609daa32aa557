"""Exact duplicates, found by a Bloom filter in two passes.

Pass one marks the filter's slots that two rows or more fall into; a row of a
repeated text has all its slots marked.  Pass two asks for every row: the few
that may be repeated are shuffled and grouped, the rest pass straight through.
Text is read once, for its hash, and never moves.

The filter has two slots a row out of 8 to 16 for each function and row (one
row in a hundred is shuffled for nothing), up to MOST_SLOTS; so what is
broadcast is bounded by two bitmaps of MOST_SLOTS / 8 bytes.  Beyond some 2^26
rows more and more rows are shuffled, at last all, as (id, hash) without text;
the result is the same.

Edge cases.  A null text counts as empty.  A null id is smaller than all
others.  Of rows that repeat the largest id of a text, one is kept; every row
of the table has its row in the result.  Columns named like the new ones are
replaced by them.  No rows give none.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from srcweave.llm.common import Scratch

# Slots of one function of the filter, at most: 64 MB of bits.
MOST_SLOTS = 1 << 29
# Bits of one bitmap of bitmap_construct_agg.
_BITMAP = 1 << 15
# A text of more than one row in HOT is grouped apart; there are fewer than HOT such texts.
HOT = 1000


def folded(text: Column) -> Column:
    """The text with A-Z lowered, all else as it is; null as empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def slots_for(rows: int) -> int:
    """Slots of each function of the filter for a table of so many rows, a power of two."""
    return max(_BITMAP, min(MOST_SLOTS, 1 << max(0, 8 * rows - 1).bit_length()))


def _slots(slots: int) -> list[Column]:
    """The two slots of a hash, numbered apart from each other."""
    return [F.pmod(F.xxhash64("hash", F.lit(i)), F.lit(slots)) + i * slots for i in range(2)]


def repeated_slots(rows: DataFrame, slots: int) -> DataFrame:
    """filter(bucket, bits): slots that two rows or more fall into, as bitmaps of 4 KB.

    A task's slots go as pre-aggregated counts; that is less than its bitmap as
    long as a task fills under a hundredth of the slots.
    """
    slot = F.col("slot")
    return (
        rows.select(F.explode(F.array(*_slots(slots))).alias("slot"))
        .groupBy("slot")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .groupBy(F.shiftright(slot, 15).alias("bucket"))
        .agg(F.bitmap_construct_agg(slot % _BITMAP).alias("bits"))
    )


def _marked(bits: Column, slot: Column) -> Column:
    place = (slot % _BITMAP).cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, place % 8) == 1, F.lit(False))


def maybe_repeated(rows: DataFrame, marked: DataFrame, slots: int) -> DataFrame:
    """`rows` with `maybe`: whether all its slots are marked."""
    maybe = F.lit(True)
    for i, slot in enumerate(_slots(slots)):
        one = marked.select(F.col("bucket").alias(f"bucket{i}"), F.col("bits").alias(f"bits{i}"))
        rows = rows.withColumn(f"slot{i}", slot).withColumn(f"bucket{i}", F.shiftright(f"slot{i}", 15))
        # bounded: two bitmaps of MOST_SLOTS bits in all
        rows = rows.join(F.broadcast(one), f"bucket{i}", "left")
        maybe = maybe & _marked(F.col(f"bits{i}"), F.col(f"slot{i}"))
    return rows.select("id", "tag", "hash", maybe.alias("maybe"))


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, keep_id, group_size, kept, text_sha256) for every row: which row of its equal texts stays, that of the largest id."""
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    hashed = docs.select(
        F.col(key).alias("id"),
        F.monotonically_increasing_id().alias("tag"),
        F.unhex(F.sha2(folded(F.col(text)), 256)).alias("hash"),
    )
    hashed = scratch.stage(hashed, "hashes")
    n = hashed.count()
    slots = slots_for(n)
    marked = scratch.stage(repeated_slots(hashed, slots), "filter")
    asked = scratch.stage(maybe_repeated(hashed, marked, slots), "asked")
    scratch.drop("hashes", "filter")

    maybe = asked.where("maybe").select("id", "tag", "hash")
    groups = maybe.groupBy("hash").agg(
        F.max(F.struct("id", "tag")).alias("last"), F.count(F.lit(1)).alias("group_size")
    )
    groups = scratch.stage(groups.where("group_size > 1"), "groups")
    # fewer than HOT texts can have more than one row in HOT, so these may be broadcast
    hot = F.broadcast(groups.where(F.col("group_size") * HOT > n))
    met = maybe.join(hot, "hash", "left")
    rare = met.where("group_size is null").select("id", "tag", "hash").join(
        groups.where(F.col("group_size") * HOT <= n), "hash", "left"
    )

    def shaped(rows: DataFrame) -> DataFrame:
        alone = F.col("group_size").isNull()
        return rows.select(
            F.col("id").alias(key),
            F.when(alone, F.col("id")).otherwise(F.col("last.id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            (alone | (F.col("tag") == F.col("last.tag"))).alias("kept"),
            F.lower(F.hex("hash")).alias("text_sha256"),
        )

    nothing = F.lit(None).cast(groups.schema["last"].dataType).alias("last"), F.lit(None).cast("long").alias("group_size")
    alone = asked.where(~F.col("maybe")).select("id", "tag", "hash", *nothing)
    parts = [shaped(p) for p in (alone, met.where("group_size is not null"), rare)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
