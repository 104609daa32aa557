import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from srcweave.llm import exact_dedup

SCHEMA = "doc_id long, text string, hash string, id int, tag string"


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def check(docs, rows):
    groups = defaultdict(list)
    for i, text, *_ in docs:
        groups[fold(text)].append(i)
    largest = {t: max(ids, key=lambda i: (i is not None, i or 0)) for t, ids in groups.items()}
    wanted = Counter(
        (i, largest[fold(t)], len(groups[fold(t)]), hashlib.sha256(fold(t).encode()).hexdigest()) for i, t, *_ in docs
    )
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == wanted
    kept = Counter((r.doc_id, r.text_sha256) for r in rows if r.kept)
    assert kept == Counter((i, hashlib.sha256(t.encode()).hexdigest()) for t, i in largest.items())


def odd_documents():
    rnd = random.Random(5)
    pool = [None, "", " ", "a", "A", "É", "é", "x" * 300_000, *(f"Text {i}" for i in range(300)), *(f"tEXT {i}" for i in range(40))]
    docs = [(rnd.choice([None, *range(400)]), rnd.choice(pool), "h", 1, "t") for _ in range(700)]
    return docs + [(900, "Again", "h", 1, "t")] * 4 + [(i, "HOT", "h", 1, "t") for i in range(1000, 1500)]


def test_against_brute_force(spark):
    docs = odd_documents()
    df = spark.createDataFrame(docs, SCHEMA).repartition(7)
    found = exact_dedup.exact_duplicates(df)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    check(docs, found.collect())
    assert exact_dedup.exact_duplicates(df.limit(0)).count() == 0


def test_a_filter_too_small_only_costs_work(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "slots_for", lambda rows: 8)
    docs = odd_documents()
    check(docs, exact_dedup.exact_duplicates(spark.createDataFrame(docs, SCHEMA)).collect())


def test_slots_are_bounded():
    assert exact_dedup.slots_for(0) == exact_dedup.slots_for(10) == 1 << 15
    assert 8 * 10**6 <= exact_dedup.slots_for(10**6) <= 16 * 10**6
    assert exact_dedup.slots_for(10**12) == exact_dedup.MOST_SLOTS


@pytest.mark.parametrize("slots", [1 << 15, 1 << 18])
def test_no_repeated_row_passes_and_few_others_are_stopped(spark, slots):
    rows = spark.range(6000).select("id", F.col("id").alias("tag"), F.sha2((F.col("id") % 5000).cast("string"), 256).alias("hash"))
    asked = exact_dedup.maybe_repeated(rows, exact_dedup.repeated_slots(rows, slots), slots)
    found = asked.groupBy((F.col("id") % 5000 < 1000).alias("twice"), "maybe").count().collect()
    counts = {(r.twice, r.maybe): r["count"] for r in found}
    assert counts[True, True] == 2000 and (True, False) not in counts
    assert counts.get((False, True), 0) < 400


def test_plan_is_native_and_moves_no_text(spark):
    df = spark.createDataFrame(odd_documents(), SCHEMA)
    plan = exact_dedup.exact_duplicates(df)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "Python" not in plan and "InArrow" not in plan and "text#" not in plan
