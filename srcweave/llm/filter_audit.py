"""What a chain of document filters removes, under every order of the filters.

A document is reduced to a mask: one bit per filter it fails.  Documents are
counted per part and mask, so at most 2^filters cells a part are left, however
many documents there are.  Each cell then folds across the array of all filter
orders (a literal, so it travels with the plan) and gives one weighted struct
per order and step; the structs of a part's cells are added element by element.

Edge cases.  A null text counts as empty, a null part as ''.  A document with a
null id is not identical to a smaller one and has no labels.  Rows that repeat
an id are counted each; rows repeating the smallest id of a text are not copies
of each other.  A document is good (toxic) if any label row of its id says so.
Only the columns named are read, whatever others there are.  No rows give none.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
_STEP = "struct<kept:bigint,removed:bigint,redundant:bigint,unique_fails:bigint,good_lost:bigint,toxic_lost:bigint>"
_COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def text_failures(text: Column) -> dict[str, Column]:
    """Conditions on one text: A few words, B repetitive, C many capitals, D symbols."""
    body = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(body, F.lit(WORD), F.lit(0))
    return {
        "A": F.size(words) < 100,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
        "C": F.regexp_count(body, F.lit("[A-Z]")) * 100 > F.char_length(body) * 10,
        "D": body.rlike("[#$%&*|]"),
    }


def mask_of(fails: Sequence[Column]) -> Column:
    """One number with bit i set where condition i holds; a condition that is null does not hold."""
    bits = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(fails)]
    total = bits[0]
    for bit in bits[1:]:
        total = total + bit
    return total


def masks(
    docs: DataFrame, labels: DataFrame, fails: Sequence[Column], *, key: str, text: str, part: str
) -> DataFrame:
    """cells(part, mask, n, good, toxic): documents by what they fail.

    The conditions `fails` look at the text alone; one bit more says that a
    smaller id has the same text.  Text is read once and does not move: what is
    shuffled is one narrow row a document, and copies of a text are added up
    before they meet.
    """
    copy_bit = 1 << len(fails)
    body = F.coalesce(F.col(text), F.lit(""))
    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("is_good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("is_toxic"),
    )
    rows = docs.select(
        F.col(key).alias("id"),
        F.coalesce(F.col(part), F.lit("")).alias("part"),
        F.unhex(F.sha2(body, 256)).alias("hash"),
        mask_of(fails).alias("mask"),
    )
    found = rows.groupBy("id", "part", "hash").agg(F.max("mask").alias("mask"), F.count(F.lit(1)).alias("n"))
    flag = lambda name: F.coalesce(F.col(name), F.lit(0)) * F.col("n")
    weighed = found.join(known, "id", "left").select(
        "id", "part", "hash", "mask", "n", flag("is_good").alias("good"), flag("is_toxic").alias("toxic")
    )
    has_id = F.col("id").isNotNull()
    texts = weighed.groupBy("hash", "part").agg(
        F.max("mask").alias("mask"),
        F.sum(F.when(has_id, 0).otherwise(F.col("n"))).alias("n_null"),
        F.sum(F.when(has_id, F.col("n")).otherwise(0)).alias("n"),
        F.sum("good").alias("good"),
        F.sum("toxic").alias("toxic"),
        F.min(F.when(has_id, F.struct("id", "n", "good", "toxic"))).alias("first"),
    )
    smallest = F.min("first.id").over(Window.partitionBy("hash"))
    holds = F.col("first.id") == F.col("smallest")

    def original(name):
        return F.when(holds, F.col(f"first.{name}")).otherwise(0)

    def cell(mask, n, good, toxic):
        return F.struct(mask.alias("mask"), n.alias("n"), good.alias("good"), toxic.alias("toxic"))

    split = F.array(
        cell(F.col("mask"), F.col("n_null") + original("n"), original("good"), original("toxic")),
        cell(
            F.col("mask") + copy_bit,
            *[F.col(name) - original(name) for name in ("n", "good", "toxic")],
        ),
    )
    cells = texts.withColumn("smallest", smallest).select("part", F.inline(split)).where("n > 0")
    return cells.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def order_array(filters: Sequence[str]) -> Column:
    """All orders of the filters as one literal: an array of arrays of mask bits."""
    bit = {name: 1 << i for i, name in enumerate(filters)}
    return F.array(*[F.array(*[F.lit(bit[name]) for name in order]) for order in permutations(filters)])


def fold_cell(orders: Column) -> Column:
    """The steps of all orders for one cell, as an array of structs weighted by the cell's counts."""
    mask, n = F.col("mask"), F.col("n")
    none = F.lit(0).cast("long")

    def step(state, bit):
        fails = mask.bitwiseAND(bit) != 0
        removed = fails & ~state["gone"]
        counts = {
            "kept": F.when(state["gone"] | fails, none).otherwise(n),
            "removed": F.when(removed, n).otherwise(none),
            "redundant": F.when(fails & state["gone"], n).otherwise(none),
            "unique_fails": F.when(mask == bit, n).otherwise(none),
            "good_lost": F.when(removed, F.col("good")).otherwise(none),
            "toxic_lost": F.when(removed, F.col("toxic")).otherwise(none),
        }
        row = F.struct(*[c.alias(name) for name, c in counts.items()])
        return F.struct((state["gone"] | fails).alias("gone"), F.concat(state["steps"], F.array(row)).alias("steps"))

    start = F.struct(F.lit(False).alias("gone"), F.array().cast(f"array<{_STEP}>").alias("steps"))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(order, start, step, lambda s: s["steps"])))


def audit(cells: DataFrame, filters: Sequence[str]) -> DataFrame:
    """(part, filter_order, step, filter, counts …, shapley) for every part, order of the filters and step.

    `cells` are as `masks` gives them.  A part holds at most 2^filters cells,
    each of them filters! times filters structs, so a part's merge is bounded.
    """
    names = ["".join(order) for order in permutations(filters)]
    k = len(filters)
    zeros = F.array_repeat(F.struct(*[F.lit(0).cast("long").alias(c) for c in _COUNTS]), math.factorial(k) * k)

    def add(a, b):
        return F.struct(*[(a[c] + b[c]).alias(c) for c in _COUNTS])

    merged = (
        cells.select("part", fold_cell(order_array(filters)).alias("steps"))
        .groupBy("part")
        .agg(F.collect_list("steps").alias("all"))
        .select("part", F.aggregate("all", zeros, lambda total, one: F.zip_with(total, one, add)).alias("steps"))
    )
    rows = merged.select("part", F.posexplode("steps").alias("at", "c")).select(
        "part",
        F.element_at(F.array(*[F.lit(n) for n in names]), F.floor(F.col("at") / k).cast("int") + 1).alias("filter_order"),
        (F.col("at") % k + 1).cast("int").alias("step"),
        *[F.col(f"c.{c}").alias(c) for c in _COUNTS],
    )
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    return rows.withColumn("filter", letter).withColumn(
        "shapley", F.sum("removed").over(Window.partitionBy("part", "filter"))
    )
