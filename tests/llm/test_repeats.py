import hashlib
import random

import numpy as np
import pytest

from srcweave.llm import repeats, suffixes
from srcweave.llm.suffixes import suffix_ranks

LENGTH = repeats.LENGTH


def test_suffix_ranks_against_sorting():
    rng = np.random.default_rng(0)
    for trial in range(120):
        s = rng.integers(1, int(rng.integers(2, 5)), int(rng.integers(1, 60)))
        s = np.concatenate((s, s[: len(s) // 2], s)) if trial % 3 == 0 else s
        depth = int(rng.integers(1, 30))
        prefixes = [tuple(s[i : i + depth].tolist()) for i in range(len(s))]
        names = {p: i for i, p in enumerate(sorted(set(prefixes)))}
        assert suffix_ranks(s, depth).tolist() == [names[p] for p in prefixes]


def test_suffix_ranks_take_three_sorts(monkeypatch):
    sorted_, before = [], suffixes._ranked

    def counted(keys):
        sorted_.append(len(keys))
        return before(keys)

    monkeypatch.setattr(suffixes, "_ranked", counted)
    s = np.random.default_rng(3).integers(1, 257, 400)
    s = np.concatenate((s, s[20:90], [2**18], s))  # symbols of 19 bits as well
    for text, sorts in ((s[:400], 3), (s, 4)):
        prefixes = [tuple(text[i : i + LENGTH].tolist()) for i in range(len(text))]
        names = {p: i for i, p in enumerate(sorted(set(prefixes)))}
        sorted_.clear()
        assert suffix_ranks(text, LENGTH).tolist() == [names[p] for p in prefixes]
        assert len(sorted_) == sorts


def brute(rows):
    first: dict[bytes, int] = {}
    for key, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - LENGTH + 1 if key is not None else 0):
            w = raw[i : i + LENGTH]
            first[w] = min(first.get(w, key), key)
    out = []
    for key, text in rows:
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - LENGTH + 1 if key is not None else 0):
            if first[raw[i : i + LENGTH]] < key:
                gone[i : i + LENGTH] = [True] * LENGTH
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not h for g, h in zip(gone, [False, *gone], strict=False))
        out.append((key, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, c string, state int")
    return sorted((tuple(r) for r in repeats.digests(repeats.remove_repeats(docs)).collect()), key=str)


def corpus(seed, n=250):
    rng = random.Random(seed)
    words = ["der", "thé", "ing", "of", "a", "quantity", "b", "éé"]
    passages = [" ".join(rng.choices(words, k=rng.choice([8, 14, 30, 60]))) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(6)):
            parts.append(rng.choice(passages)[rng.choice([0, 0, 3]) :] if rng.random() < 0.5 else "".join(rng.choices("abcdefgh ", k=rng.randrange(90))))
        rows.append((rng.randrange(-50, 5000), " ".join(parts)))
    return rows


@pytest.mark.parametrize("seed, hot", [(1, 2000), (2, 2000), (3, 2)])
def test_against_brute_force(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "GROUP", 12 if seed == 2 else 10_000)
    monkeypatch.setattr(repeats, "FLUSH", 500)
    monkeypatch.setattr(repeats, "SORTED_BYTES", 3000)
    rows = corpus(seed)
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    long = "one long line " * 20
    rows = [(1, None), (2, ""), (3, "short"), (4, long), (4, long), (4, "other " + long), (5, long), (None, long), (6, "a" * 120_000)]
    rows += [(7, "a" * 60), (8, "é" * 49 + "x"), (9, "yé" + "é" * 49), (10, "x" * 50), (11, "x" * 49)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
