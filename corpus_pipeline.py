"""A training-data pipeline over `documents`, in stages of the numbered operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from srcweave.llm import decontaminate, jaccard, langid, mixing, token_files
from srcweave.llm.common import Scratch, lower_batches, restored, without
from srcweave.llm.queries import held_out, tokenizer_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a letter and one learnt language likelier than all others together.

    Only learnt languages are compared, so a longer text passes in any language.
    """
    lower_batches(spark)
    model = langid.train(docs.where(~held_out()))
    found = langid.predict(without(docs, "lang_pred", "score"), model)
    return restored(found.where("lang_pred <> 'und' and score > 0.5").drop("lang_pred", "score"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that of the smallest id, of each group linked by 80 % of their five-word shingles.

    A row is known by its id and text: rows that repeat an id with other texts
    are judged each by its own text, and of rows that repeat both one stays.
    Rows without an id all stay.
    """
    found = jaccard.similar_documents(docs, width=5, num=4, den=5, digests=True)
    rows = Scratch(spark, "classes").stage(found, "rows").where("doc_id is not null")
    texts = rows.groupBy("doc_id", "text_sha256", "component_id", "group_id").agg(F.max("n_shingles").alias("n"), F.count(F.lit(1)).alias("rows"))
    # of several texts of the smallest id in one group, that of the smallest digest stays
    first = texts.where("n > 0 and doc_id = component_id").groupBy("group_id").agg(F.min("text_sha256").alias("first"))
    judged = texts.join(first, "group_id", "left").withColumn(
        "stays", (F.col("n") == 0) | ((F.col("doc_id") == F.col("component_id")) & (F.col("text_sha256") == F.col("first")))
    )
    key = ["doc_id", "__digest"]
    odd = judged.where("not stays or rows > 1").select("doc_id", F.col("text_sha256").alias("__digest"), "stays")
    marked = docs.withColumn("__digest", F.sha2(F.coalesce("text", F.lit("")), 256))
    single = marked.join(jaccard.few(odd.select(*key)), key, "left_anti")
    repeated = marked.join(jaccard.few(odd.where("stays").select(*key)), key, "left_semi")
    return single.unionByName(repeated.dropDuplicates(key)).select(docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that hold no ten consecutive words of a benchmark item."""
    lower_batches(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_benchmark(without(docs, "found"), items, width=10)
    return restored(found.where("found.n_hit = 0").drop("found"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents so that sources come nearer to each other: all at least once, none more than twice."""
    given = without(docs, "mix")
    return restored(mixing.mix(given, mixing.count_words(F.col("text")), max_repeats=2.0).drop("mix"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token files of the mixture and give each document's place, count and checksum in them."""
    lower_batches(spark)
    path = Scratch(spark, "token-files").path("documents")
    token_files.write_token_files(docs, path, tokenizer_path(), end_id=2)
    return token_files.token_checksums(spark, path, key="doc_id")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("mixture", mixture),
    ("tokens", tokens),
]
# Language models and tokenizers can't be expressed in SQL; tests/llm/test_pipeline.py has a brute-force twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to `documents`; each one's rows are written and read again by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.stage(stage(spark, docs, sf_dir), f"{i}-{name}")
        if i:
            scratch.drop(f"{i - 1}-{STAGES[i - 1][0]}")
    return docs
