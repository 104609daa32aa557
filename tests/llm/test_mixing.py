from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from srcweave.llm import mixing

SF = "/root/testdata/sf0.01/documents.parquet"


def test_bisection():
    tokens = [1000, 100, 10, 0]
    alpha = mixing.bisect_alpha(tokens, max_repeats=4.0)
    shares = mixing.weights(tokens, alpha)
    assert abs(sum(shares) - 1) < 1e-12 and shares[3] == 0
    budget, most = mixing.repeats(tokens, shares, None)
    assert abs(most - 4.0) < 1e-9 and budget >= 1110 - 1e-6
    alpha = mixing.bisect_alpha(tokens, target_entropy=1.2)
    assert abs(mixing.entropy(mixing.weights(tokens, alpha)) - 1.2) < 1e-9
    assert mixing.bisect_alpha(tokens, target_entropy=9.0) == 0.0
    assert mixing.bisect_alpha(tokens, max_repeats=200.0) == 0.0
    assert mixing.bisect_alpha([], max_repeats=2.0) == 0.0
    with pytest.raises(ValueError):
        mixing.plan(None, "source")


@pytest.mark.parametrize("options", [{"max_repeats": 2.0}, {"target_entropy": 3.9, "budget": 200_000.0}])
def test_budgets_are_met_and_no_document_is_left_behind(spark, options):
    docs = spark.read.parquet(SF)
    tokens = mixing.count_words(F.col("text"))
    totals = docs.select("source", tokens.alias("n")).groupBy("source").agg(
        F.count("*").alias("n_docs"), F.sum("n").alias("n_tokens")
    )
    plan = mixing.plan(totals, "source", **options)
    rows = mixing.mix(docs, tokens, **options).select("doc_id", "source", "mix.*").collect()
    spent, passes, longest = Counter(), defaultdict(Counter), Counter()
    for r in rows:
        spent[r.source] += r.n_tokens
        passes[r.source][r.doc_id] += 1
        longest[r.source] = max(longest[r.source], r.n_tokens)
    sizes = {r.doc_id: r.n for r in docs.select("doc_id", tokens.alias("n")).collect()}
    for source, _, total, weight, whole, rest, _ in plan.rows:
        goal = round(plan.budget * weight)
        assert goal == whole * total + rest
        room = goal - spent[source]
        assert 0 <= room
        missing = [d for d, n in passes[source].items() if n == whole]
        if rest and missing:  # only the next document of the permutation may not have fitted
            assert room < max(sizes.values())
        assert set(passes[source].values()) <= {whole, whole + 1}
    if "max_repeats" in options:
        assert {r.doc_id for r in rows} == set(sizes)


def test_odd_rows(spark):
    schema = "doc_id long, text string, source string, mix string"
    rows = [(i, "a b c", "big", "x") for i in range(40)] + [(50, None, "none", "x"), (51, "", None, "x"), (52, "one two", None, "x")]
    rows += [(60, "same row", "twice", "x")] * 2 + [(None, "no key", "twice", "x")]
    docs = spark.createDataFrame(rows, schema)
    found = mixing.mix(docs, mixing.count_words(F.col("text")), max_repeats=3.0)
    assert found.columns == ["doc_id", "text", "source", "mix"]
    counted = Counter((r.doc_id, r.source) for r in found.collect())
    assert all(counted[i, "big"] == 1 for i in range(40))
    assert counted[50, "none"] == 1 and counted[52, None] == 3 and counted[60, "twice"] in (2, 4, 6)
    assert mixing.mix(docs.limit(0), mixing.count_words(F.col("text")), max_repeats=3.0).count() == 0
