"""How far the sources of a language differ in their terms.

Every source gives each term kept in its language the share
p = 1 + floor(10^9 (count + 1) / (N + V)); one share p differs from another q by
floor((p - q)^2 / q).  Terms are counted in tasks (`term_counts`), added up by
(language, source, term) and kept if enough documents of the language hold them.

Pairs of sources are compared in blocks of terms and sources: a block lays out
the shares of its terms densely and gives partial sums for its pairs; terms
that neither source of a block has enter by arithmetic, so the work follows the
counts there are and not terms times sources.

All numbers are exact: shares are computed as decimals, differences fit in 64
bits.  Edge cases: null text, language or source counts as ''; a language
without kept terms gives pairs of value 0; a lone source has no pairs; rows that
repeat an id are documents of their own; other columns are not read; no rows
give none.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from srcweave.llm.common import Scratch, small_batches
from srcweave.llm.term_counts import count_batches

SCALE = 10**9
# Sources in a block of pairs, counts in a block of terms, terms compared at once.
BLOCK_SOURCES = 64
BLOCK_COUNTS = 20_000
_CHUNK = 1 << 13


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (total + terms)); null where there are no terms."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    below = F.nullif(total + terms, F.lit(0)).cast("decimal(20,0)")
    return F.call_function("div", above, below) + 1


def difference(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q), a bigint."""
    return F.call_function("div", (p - q) * (p - q), q)


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """counts(lang, source, term, n, lang_n, first): terms in `min_docs` documents of their language or more."""
    partial = docs.mapInArrow(count_batches, "lang string, source string, term string, n long, docs long")
    counts = partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    same = Window.partitionBy("lang", "term")
    return (
        counts.withColumn("lang_docs", F.sum("docs").over(same))
        .withColumn("lang_n", F.sum("n").over(same))
        .withColumn("first", F.min("source").over(same) == F.col("source"))
        .where(F.col("lang_docs") >= min_docs)
        .select("lang", "source", "term", "n", "lang_n", "first")
    )


def sources(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """groups(lang, source, total, lang_total, terms, at, blocks): every source of each language."""
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if("first").alias("firsts"))
    lang = Window.partitionBy("lang")
    none = F.lit(0).cast("long")
    return (
        docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
        .withColumn("total", F.coalesce("total", none))
        .withColumn("lang_total", F.sum("total").over(lang))
        .withColumn("terms", F.coalesce(F.sum("firsts").over(lang), none))
        .withColumn("at", F.row_number().over(lang.orderBy("source")) - 1)
        .withColumn("blocks", F.ceil(F.count(F.lit(1)).over(lang) / BLOCK_SOURCES).cast("int"))
        .drop("firsts")
    )


def _compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Partial sums of one block: (lang, a, b, value, terms) for every ordered pair of its two source blocks."""
    lang, _, left, right = (k.as_py() for k in key)
    at, p = table["at"].to_numpy(), table["p"].to_numpy()
    codes = table["term"].combine_chunks().dictionary_encode()
    unknown = np.asarray(codes.indices.is_null())
    base_at, base = at[unknown], p[unknown]
    seated = np.argsort(base_at)
    base_at, base = base_at[seated], base[seated]
    term, seat, p = codes.indices.drop_null().to_numpy(), np.searchsorted(base_at, at[~unknown]), p[~unknown]
    order = np.argsort(term, kind="stable")
    term, seat, p = term[order], seat[order], p[order]
    n_terms, sides = len(codes.dictionary), base_at // BLOCK_SOURCES
    values = np.zeros((len(base), len(base)), np.int64)
    for low in range(0, n_terms, _CHUNK):
        high = min(low + _CHUNK, n_terms)
        inside = slice(*np.searchsorted(term, [low, high]))
        shares = np.repeat(base[:, None], high - low, axis=1)
        shares[seat[inside], term[inside] - low] = p[inside]
        for b in range(len(base)):
            facing = slice(None) if left == right else np.flatnonzero(sides != sides[b])
            away = shares[facing] - shares[b]
            values[facing, b] += (away * away // shares[b]).sum(axis=1)
    a, b = np.nonzero(~np.eye(len(base), dtype=bool) if left == right else sides[:, None] != sides[None, :])
    return pa.table(
        {
            "lang": pa.array([lang] * len(a), pa.string()),
            "a": pa.array(base_at[a], pa.int32()),
            "b": pa.array(base_at[b], pa.int32()),
            "value": pa.array(values[a, b], pa.int64()),
            "seen": pa.array(np.full(len(a), n_terms), pa.int64()),
        }
    )


def pair_values(known: DataFrame, groups: DataFrame, counts: int) -> DataFrame:
    """pairs(lang, source, item, value): every source against each other source of its language.

    `known` are the counts with their shares (lang, term, at, blocks, p).
    """
    buckets = max(1, math.ceil(counts / BLOCK_COUNTS))
    block, other = F.floor(F.col("at") / BLOCK_SOURCES).cast("int"), F.col("other")
    base = share(F.lit(0), F.col("total"), F.col("terms"))
    # a row without a term gives a block the share of terms its source does not have
    rest = groups.where("terms > 0").select(
        "lang", F.lit(None).cast("string").alias("term"), "at", "blocks", base.alias("p"),
        F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"),
    )
    placed = known.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")).unionByName(rest)
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "lang", "bucket", F.least(block, other).alias("left"), F.greatest(block, other).alias("right"), "term", "at", "p"
    )
    partial = dealt.groupBy("lang", "bucket", "left", "right").applyInArrow(
        _compare, "lang string, a int, b int, value long, seen long"
    )
    sums = partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    mine = groups.select("lang", "source", F.col("at").alias("a"), base.alias("p"), "terms")
    theirs = groups.select("lang", F.col("source").alias("item"), F.col("at").alias("b"), base.alias("q"))
    pairs = mine.join(theirs, "lang").where("a <> b").join(sums, ["lang", "a", "b"], "left")
    none = F.lit(0).cast("long")
    unseen = (F.col("terms") - F.coalesce("seen", none)) * difference(F.col("p"), F.col("q"))
    return pairs.select("lang", "source", "item", (F.coalesce("value", none) + F.coalesce(unseen, none)).alias("value"))


def term_values(known: DataFrame) -> DataFrame:
    """terms(lang, source, item, value): terms more common in a source than in its language."""
    p, q = F.col("p"), share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    return known.withColumn("q", q).where(p > F.col("q")).select(
        "lang", "source", F.col("term").alias("item"), difference(p, F.col("q")).alias("value")
    )


def source_divergence(
    docs: DataFrame, min_docs: int = 3, top: int = 200, *, text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """(lang, source, part, item, value, rank): `pair` rows for all other sources, `term` rows up to rank `top`."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "divergence")
    given = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    with small_batches(spark, 2000):
        kept = scratch.stage(kept_terms(given, min_docs), "counts")
    groups = scratch.stage(sources(given, kept), "sources")
    counts = kept.count()
    known = kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    shares = known.select("lang", "term", "at", "blocks", "p")
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")

    def ranked(df: DataFrame, part: str) -> DataFrame:
        rows = df.withColumn("rank", F.row_number().over(best))
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")

    terms = ranked(term_values(known), "term").where(F.col("rank") <= top)
    return ranked(pair_values(shares, groups, counts), "pair").unionByName(terms)
