import random
import re
import tracemalloc

import numpy as np
import pytest

from srcweave.llm import jaccard
from srcweave.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width, num, den):
    sets = [(k, shingles(t, width)) for k, t in rows]
    parent = list(range(len(sets)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (k, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if k is not None and sets[j][0] is not None and a and b and den * len(a & b) >= num * len(a | b):
                parent[top(i)] = top(j)
    least = {}
    for i, (k, _) in enumerate(sets):
        if k is not None:
            least[top(i)] = min(k, least.get(top(i), k))
    return sorted(((k, len(s), least[top(i)] if k is not None else None) for i, (k, s) in enumerate(sets)), key=str)


def found(spark, rows, *args):
    docs = spark.createDataFrame([(*r, 0, "n") for r in rows], "doc_id long, text string, node int, rep string")
    return sorted((tuple(r) for r in jaccard.similar_documents(docs, *args).collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["The", "of", "É"] * 40
    rows, base = [], [rng.choices(vocabulary, k=rng.choice([1, 2, 4, 30, 60, 90])) for _ in range(40)]
    for i in range(260):
        words = list(rng.choice(base[:12] if i % 2 else base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if i % 9 == 0:
            words += base[0][:20]
        rows.append((rng.randrange(10_000), rng.choice([" ", "\n", "\t "]).join(words)))
    return list({k: t for k, t in rows}.items())


@pytest.mark.parametrize("args", [(3, 90, 100), (5, 4, 5), (1, 1, 2)])
def test_against_brute_force(spark, monkeypatch, args):
    monkeypatch.setattr(jaccard, "SHORT", 4)  # so that lists are settled by centres
    rows = corpus(args[0])
    assert found(spark, rows, *args) == brute(rows, *args)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A b"), (6, "a b c d e f"), (6, "a b c d e f"), (None, "a b")]
    rows += [(7, "x y z " * 30_000), (8, "x y z " * 30_000), (9, "a")]
    assert found(spark, rows, 3, 90, 100) == brute(rows, 3, 90, 100)
    assert found(spark, [], 3, 90, 100) == []


def test_long_lists_are_split_by_a_second_order(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "ROUNDS", 0)
    monkeypatch.setattr(jaccard, "SHORT", 3)
    rnd = random.Random(11)
    base = [f"w{i}" for i in range(60)]
    docs = []
    for i in range(70):
        words = list(base)
        for _ in range(rnd.choice([0, 1, 2, 12])):
            words[rnd.randrange(60)] = f"x{rnd.randrange(40)}"
        docs.append((i, " ".join(words)))
    assert found(spark, docs, 3, 90, 100) == brute(docs, 3, 90, 100)


def alike(n, changed):
    """Documents that share most of their words with one text, and no two of which are linked at 90 %."""
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(100)]
    docs = []
    for i in range(n):
        words = list(base)
        for at in rnd.sample(range(100), changed):
            words[at] = f"x{i}-{at}"
        docs.append((i, " ".join(words)))
    return docs


def test_documents_alike_but_not_linked_are_not_expanded_into_pairs(spark, monkeypatch):
    rows, before = [], jaccard._Join.verified

    def counted(self, pairs, *args):
        out = before(self, pairs, *args)
        rows.append(out.count())
        return out

    monkeypatch.setattr(jaccard._Join, "verified", counted)
    docs = alike(200, 3) + [(1000 + i, t) for i, t in alike(200, 1)]
    assert found(spark, docs, 3, 90, 100) == brute(docs, 3, 90, 100)
    assert sum(rows) < 20 * len(docs)  # all pairs: 79,800


def test_very_long_lists_are_split_and_compared_in_blocks(spark, monkeypatch):
    for name, value in (("ROUNDS", 0), ("SHORT", 3), ("BLOCK", 8), ("SPLIT", 20)):
        monkeypatch.setattr(jaccard, name, value)
    docs = alike(60, 2) + [(1000 + i, t) for i, t in alike(30, 1)]
    assert found(spark, docs, 3, 90, 100) == brute(docs, 3, 90, 100)


def test_hashing_many_texts_takes_memory_for_a_slice_only():
    texts, tally = [b"some words of one text " * 1000] * 400, np.zeros(1 << 20, np.int64)
    shingle_sets(texts[:20], 3, tally=tally)
    tracemalloc.start()
    shingle_sets(texts, 3, tally=tally)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 18 << 20


def test_cells_of_the_same_members_are_sent_once(spark):
    cells = {(7, 0, 0, 0): (1, 2, 3), (8, 0, 0, 1): (3, 2, 1), (9, -1, 0, 0): (1, 2), (9, -2, 0, 0): (1, 2, 4)}
    sent = spark.createDataFrame([(*c, n) for c, nodes in cells.items() for n in nodes], "token long, part long, low int, high int, node long")
    found = [tuple(r) for r in jaccard._distinct_cells(sent).collect()]
    assert sorted(found) == sorted((*c, n) for c, nodes in cells.items() if c[0] != 8 for n in nodes)


def test_sets_are_sent_in_waves_of_bounded_bytes(spark, monkeypatch):
    for name, value in (("ROUNDS", 1), ("SHORT", 3), ("BLOCK", 8), ("ROOM", 1)):
        monkeypatch.setattr(jaccard, name, value)
    given, waves = [], []

    def counted(self, sent, *args, before=jaccard._Join.waves):
        given.append((sent.count(), before(self, sent, *args)))
        return given[-1][1]

    def noted(wave, n, *by, before=jaccard._in_wave):
        waves.append((wave, n))
        return before(wave, n, *by)

    monkeypatch.setattr(jaccard._Join, "waves", counted)
    monkeypatch.setattr(jaccard, "_in_wave", noted)
    docs = alike(60, 2) + [(1000 + i, t) for i, t in alike(30, 1)]
    assert found(spark, docs, 3, 90, 100) == brute(docs, 3, 90, 100)
    # texts are about equally long, so as many rows as documents fill a wave
    assert max(n for _, n in given) > 3 and all(n >= rows / len(docs) * 0.7 for rows, n in given)
    assert {w for w, n in waves if n == max(n for _, n in given)} == set(range(max(n for _, n in given)))
