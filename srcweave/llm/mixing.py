"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens to the power `alpha`, normalised:
1 keeps the shares, 0 makes all sources equal.  The exponent is bisected until
the weights reach a target entropy, or until no source is repeated more often
than a limit.  The weights become token budgets, realised as passes over each
source: whole passes, then blocks of documents in the order of a pseudo-random
permutation, drawn anew for each pass, until the budget is spent.

A source of n documents has about sqrt(n) blocks of sqrt(n) documents, so both
levels of the running totals stay small, however large a source is.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Sources whose totals are gathered on the driver.
MOST_SOURCES = 1_000_000


@dataclass
class Mixture:
    alpha: float
    budget: float  # tokens
    rows: list[tuple]  # (source, documents, tokens, weight, whole passes, tokens of the last pass, blocks)


def weights(tokens: list[int], alpha: float) -> list[float]:
    """Normalised shares to the power alpha; a source without tokens gets none."""
    top = max(tokens, default=0)
    raw = [math.exp(alpha * math.log(n / top)) if n else 0.0 for n in tokens]
    total = sum(raw)
    return [x / total if total else 0.0 for x in raw]


def entropy(shares: list[float]) -> float:
    return -sum(p * math.log2(p) for p in shares if p)


def repeats(tokens: list[int], shares: list[float], budget: float | None) -> tuple[float, float]:
    """(budget, most passes over a source); without a budget, the least that passes over every source once."""
    each = [(n, p) for n, p in zip(tokens, shares, strict=True) if n]
    if budget is None:
        budget = max((n / p for n, p in each), default=0.0)
    return budget, max((budget * p / n for n, p in each), default=0.0)


def bisect_alpha(
    tokens: list[int], target_entropy: float | None = None, max_repeats: float | None = None, budget: float | None = None
) -> float:
    """Smallest exponent from 0 to 8 with at most the target entropy, or that repeats no source beyond the limit."""

    def fits(alpha: float) -> bool:
        shares = weights(tokens, alpha)
        if target_entropy is not None:
            return entropy(shares) <= target_entropy
        return repeats(tokens, shares, budget)[1] <= max_repeats

    low, high = 0.0, 8.0 if target_entropy is not None else 1.0
    if fits(low) or not fits(high):
        return low if fits(low) else high
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (low, middle) if fits(middle) else (middle, high)
    return high


def plan(
    totals: DataFrame,
    source: str,
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget: float | None = None,
) -> Mixture:
    """Weights and passes from (source, n_docs, n_tokens) totals, a row per source."""
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give target_entropy or max_repeats")
    found = totals.limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    found.sort(key=lambda r: (r[source] is not None, r[source]))
    tokens = [int(r["n_tokens"]) for r in found]
    alpha = bisect_alpha(tokens, target_entropy, max_repeats, budget)
    shares = weights(tokens, alpha)
    spent, _ = repeats(tokens, shares, budget)
    rows = []
    for r, n, p in zip(found, tokens, shares, strict=True):
        passes, rest = divmod(round(spent * p), n) if n else (1, 0)
        blocks = math.isqrt(max(r["n_docs"] - 1, 0)) + 1
        rows.append((r[source], r["n_docs"], n, p, passes, rest, blocks))
    return Mixture(alpha, spent, rows)


def count_words(text: Column) -> Column:
    """Words between ASCII white space; none in a null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def _draw(*parts: Column) -> Column:
    """32 pseudo-random bits of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 8), 16, 10).cast("long")


def mix(
    docs: DataFrame,
    tokens: Column,
    source: str = "source",
    key: str = "doc_id",
    *,
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget: float | None = None,
) -> DataFrame:
    """Every row of `docs` once for each pass that takes it, with a struct column `mix`.

    mix.epoch counts the passes over the source from 0, mix.place is the place
    of the row's block in that pass, mix.block its number, mix.n_tokens what
    the row costs.  `tokens` is a column of token counts.  In the last block of
    a last pass documents are taken in hashed order while they fit the budget.
    Texts are never shuffled: only totals per source and block, and the keys
    of the blocks a budget ends in, about sqrt(n) each.

    A null source is a source of its own; one without tokens is passed over
    once.  Rows with the same key are taken or left together.  An empty table
    gives no rows.  An input column `mix` is replaced.
    """
    spark = docs.sparkSession
    flat = docs.drop("mix").select("*", tokens.alias("__n"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("__key"))
    totals = flat.groupBy(source).agg(F.count(F.lit(1)).alias("n_docs"), F.sum("__n").alias("n_tokens"))
    mixture = plan(totals, source, target_entropy, max_repeats, budget)
    kind = docs.schema[source].dataType.simpleString()
    schema = f"__source {kind}, __docs long, __total long, __weight double, __passes long, __rest long, __blocks long"
    per_source = F.broadcast(spark.createDataFrame(mixture.rows, schema).drop("__docs", "__total", "__weight"))
    known = flat.join(per_source, F.col(source).eqNullSafe(F.col("__source"))).select(
        "*", F.pmod(_draw(F.col("__key")), F.col("__blocks")).alias("__block")
    )
    # Where each last pass ends: running totals over blocks, then over the documents of one block.
    own = Window.partitionBy("__source").orderBy("__place", "__block")
    sums = known.groupBy("__source", "__block", "__passes", "__rest").agg(F.sum("__n").alias("cost"))
    placed = sums.select("*", _draw(F.col("__block").cast("string"), F.col("__passes").cast("string")).alias("__place"))
    ends = placed.select(
        F.col("__source").alias("s"),
        F.col("__block").alias("b"),
        F.sum("cost").over(own).alias("upto"),
        (F.col("__rest") - F.sum("cost").over(own) + F.col("cost")).alias("left"),
        F.col("__rest").alias("rest"),
    ).select("s", "b", ((F.col("upto") <= F.col("rest")) & (F.col("rest") > 0)).alias("whole"), "left")
    status = F.broadcast(ends.where("whole or left > 0"))  # about sqrt(n) rows per source
    same_block = F.col("__source").eqNullSafe(F.col("s")) & (F.col("__block") == F.col("b"))
    last = F.broadcast(ends.where("not whole and left > 0"))  # a row per source
    order = Window.partitionBy("__source").orderBy("__order", "__key")
    partial = (
        known.select("__source", "__block", "__key", "__n", "__passes")
        .join(last, same_block)
        .groupBy("__source", "__key", "__passes", "left")
        .agg(F.sum("__n").alias("cost"))
        .select("*", _draw(F.col("__key"), F.col("__passes").cast("string"), F.lit("d")).alias("__order"))
        .select("__source", "__key", (F.sum("cost").over(order) <= F.col("left")).alias("fits"))
        .where("fits")
        .select(F.col("__source").alias("ps"), F.col("__key").alias("pk"), "fits")
    )
    chosen = known.join(status, same_block, "left").join(
        F.broadcast(partial), F.col("__source").eqNullSafe(F.col("ps")) & (F.col("__key") == F.col("pk")), "left"
    )
    extra = F.when(F.col("whole") | F.coalesce("fits", F.lit(False)), 1).otherwise(0)
    epochs = F.col("__passes") + F.coalesce(extra, F.lit(0))
    passes = F.when(epochs > 0, F.sequence(F.lit(0).cast("long"), epochs - 1)).otherwise(F.array().cast("array<long>"))
    place = _draw(F.col("__block").cast("string"), F.col("__epoch").cast("string"))
    return chosen.select("*", F.explode(passes).alias("__epoch")).select(
        *docs.drop("mix").columns,
        F.struct(
            F.col("__epoch").alias("epoch"), place.alias("place"), F.col("__block").alias("block"), F.col("__n").alias("n_tokens")
        ).alias("mix"),
    )
