import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

pipeline = pytest.importorskip("corpus_pipeline")

from srcweave.llm import mixing  # noqa: E402
from srcweave.llm.common import Scratch  # noqa: E402
from srcweave.llm.queries import tokenizer_path  # noqa: E402
from tests.llm.test_decontaminate import brute as hits  # noqa: E402
from tests.llm.test_jaccard import brute as classes  # noqa: E402
from tests.llm.test_token_files import brute as files  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = "doc_id long, text string, lang string, source string, n_chars long"
    docs = docs.unionByName(spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "12 !", "en", "s", 4)], extra))
    docs = docs.withColumn("found", F.lit(1)).withColumn("score", F.lit("s")).withColumn("mix", F.lit(2))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = docs
    for i, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, before, SF).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        given, kept = before.collect(), after.collect()
        texts = {r.doc_id: r.text for r in given}
        if i < 4:
            assert sorted(after.columns) == sorted(docs.columns)
            assert {tuple(r[c] for c in docs.columns) for r in kept} <= {tuple(r[c] for c in docs.columns) for r in given}
        ids = Counter(r.doc_id for r in kept)
        if name == "language":
            assert set(texts) - set(ids) <= {9001, 9002} | {k for k, t in texts.items() if len(t or "") < 40}
            assert not {9001, 9002} & set(ids)
        elif name == "near_duplicates":
            assert sorted(ids) == sorted({c for _, _, c in classes(list(texts.items()), 5, 4, 5)}) and max(ids.values()) == 1
        elif name == "benchmark":
            assert set(ids) == {k for k, t in texts.items() if not hits(t, items, 10)[1]}
        elif name == "mixture":
            counted = before.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum(mixing.count_words(F.col("text"))).alias("n_tokens"))
            passes = {r[0]: r[4] for r in mixing.plan(counted, "source", max_repeats=2.0).rows}
            sources = {r.doc_id: r.source for r in given}
            assert set(ids) == set(texts)
            assert all(n - passes[sources[k]] in (0, 1) for k, n in ids.items())
        else:
            rows = [(r.doc_id, r.text) for r in given]
            assert sorted(tuple(r) for r in kept) == sorted(files(rows, tokenizer_path(), 2))
        before = after


def test_empty_and_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "a plain text of some words", "en", None, 1)] * 2 + [(None, "no id but text here", None, "x", 1), (2, "", "en", "x", 0)]
    docs = spark.createDataFrame(rows, schema)
    for frame, expected in ((docs, 2), (docs.limit(0), 0)):
        for name, stage in pipeline.STAGES[:3]:
            frame = spark.createDataFrame(stage(spark, frame, SF).collect(), schema)
        assert frame.count() == expected


def test_rows_that_repeat_an_id_are_judged_by_their_texts(spark):
    copy, alone, other = ("one text of eight words that is copied", "a text of its own with nothing shared", "and one more of seven other words")
    rows = [(3, copy), (5, copy), (5, alone), (8, other), (8, "quite another text under the same id"), (8, other), (9, ""), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = pipeline.near_duplicates(spark, docs, SF).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.doc_id != 9) == sorted({(3, copy), (5, alone), *rows[3:5]})
    assert len([r for r in kept if r.doc_id == 9]) == 1  # both without a word: one document twice


def test_a_staged_table_leaves_no_shuffle_files(spark):
    def held():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in files.split("\n") if f.rsplit("/")[-1].startswith("shuffle_") and f.endswith(".data")}

    before, scratch = held(), Scratch(spark, "test")
    rows = scratch.stage(spark.range(1000).repartition(3, "id").groupBy("id").count(), "rows")
    until = time.time() + 10  # they are removed beside what runs next
    while held() - before and time.time() < until:
        time.sleep(0.1)
    assert not held() - before
    assert rows.count() == 1000
    scratch.drop("rows")


@pytest.mark.parametrize("stage", ["language", "benchmark"])
def test_python_gets_few_documents_at_a_time(spark, stage):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, 10_000)
    try:
        docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
        dict(pipeline.STAGES)[stage](spark, docs, "/root/testdata/sf0.001")
        assert int(spark.conf.get(name)) <= 1000
    finally:
        spark.conf.set(name, before)
