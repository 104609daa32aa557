import math
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from srcweave.llm import topk


def brute(rows, k):
    usable = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = set()
    for q, a in usable:
        if q % 5:
            continue
        scores = [(-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in usable if i != q and len(a) == len(b)]
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])}
    return out


def found(df, k=3):
    vectors = df.select("vec_id", topk.quantised("embedding").alias("v"))
    rows = topk.top_products(vectors, F.col("vec_id") % 5 == 0, k, "vec_id", "v").collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


@pytest.mark.parametrize("shape", ["random", "skewed", "ties", "huge"])
def test_against_brute_force(spark, monkeypatch, shape):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    monkeypatch.setattr(topk, "GROUP_BLOCKS", 2)
    rng = np.random.default_rng(1)
    v = rng.normal(size=(200, 20))
    if shape == "skewed":
        v *= np.exp(rng.normal(size=(200, 1)))
        v[:, 5:] *= 0.05
    if shape == "ties":
        v = np.round(v[:40].repeat(5, 0))
        v[60:130] = v[60]
    if shape == "huge":
        v *= 1e6
    rows = [(i, x) for i, x in enumerate(v.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(df) == brute(rows, 3)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, []), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
        (10, [0.5, 0.5]), (None, [9.0, 9.0]), (15, [1.0, 2.0, 3.0]), (16, [-1.0, -1.0]), (20, [0.0, 0.0]),
    ]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, id int, v int")
    assert found(df) == brute(rows, 3)
    assert found(df.limit(0)) == set()


@pytest.mark.parametrize("block", [4, 16, 2048])
def test_repeated_rows_count_each(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    rng = np.random.default_rng(2)
    few = np.round(rng.normal(size=(4, 6)) * 2)
    rows = [(i, few[0].tolist()) for i in (50, 51, 52) for _ in range(3)]
    rows += [(int(i), few[j].tolist()) for i, j in zip(rng.integers(0, 40, 150), rng.integers(0, 4, 150), strict=True)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = df.select("vec_id", topk.quantised("embedding").alias("v"))
    got = topk.top_products(vectors, F.col("vec_id") % 5 == 0, 5, "vec_id", "v").collect()
    wanted = Counter()
    for q, v in rows:
        if q % 5 == 0:
            others = [r for r in rows if r[0] != q]
            wanted.update(brute_row(q, v, others, 5))
    assert Counter(map(tuple, got)) == wanted


def brute_row(q, v, others, k):
    """What one query row finds; repeated rows are told apart."""
    scores = sorted((-sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(v, w, strict=True)), i) for i, w in others)
    return [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]


def test_memory_of_many_queries():
    rng = np.random.default_rng(3)
    queries = rng.integers(-300, 300, (16 * 512, 64)).astype(np.int16)
    block = rng.integers(-300, 300, (topk.BLOCK, 64)).astype(np.int16)
    longest = float(np.sqrt((block.astype(float) ** 2).sum(1)).max())
    blocks = [(longest, np.arange(topk.BLOCK) + 10_000, block)] * 2
    tracemalloc.start()
    try:
        at, score, _ = topk.search_lane(blocks, np.arange(len(queries)), queries, np.eye(64), 5)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 250 << 20
    every = queries[:50].astype(np.int64) @ block.astype(np.int64).T
    for q in range(50):
        assert score[at == q].tolist() == np.sort(np.concatenate([every[q], every[q]]))[::-1][:5].tolist()
