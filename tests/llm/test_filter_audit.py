import random
import re
from collections import defaultdict
from itertools import permutations

from pyspark.sql import functions as F

from srcweave.llm import filter_audit

DOCS = "doc_id long, text string, lang string, part string, mask int"
LABELS = "doc_id long, quality int, toxic int"


def run(docs, labels):
    fails = filter_audit.text_failures(F.col("text"))
    cells = filter_audit.masks(docs, labels, list(fails.values()), key="doc_id", text="text", part="lang")
    return filter_audit.audit(cells, [*fails, "E"])


def brute(docs, labels):
    """Every document sent through every order, one by one."""
    smallest = {}
    for i, text, *_ in docs:
        if i is not None:
            smallest[text or ""] = min(i, smallest.get(text or "", i))
    rows = []
    for i, text, lang, *_ in docs:
        body = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", body)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in body) > 10 * len(body),
            "D": any(c in "#$%&*|" for c in body),
            "E": i is not None and smallest[body] < i,
        }
        mine = [x for x in labels if i is not None and x[0] == i]
        rows.append((lang or "", fails, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out, shapley = {}, defaultdict(int)
    for part in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, letter in enumerate(order, 1):
                removed = [r for r in left if r[1][letter]]
                left = [r for r in left if not r[1][letter]]
                redundant = sum(r[1][letter] for r in gone)
                gone += removed
                unique = sum(r[0] == part and r[1][letter] and sum(r[1].values()) == 1 for r in rows)
                shapley[part, letter] += len(removed)
                out[part, "".join(order), step] = (
                    len(left), len(removed), redundant, unique, sum(r[2] for r in removed), sum(r[3] for r in removed)
                )
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def got(rows):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in rows}


def texts(seed):
    rnd = random.Random(seed)
    pool = [None, "", "a|b", "ÀÉ é", "\x1c\x85x", "x" * 200_000, "W " * 120_000]
    for _ in range(40):
        words = [rnd.choice(["an", "Of", "the", "IT", "w%d" % rnd.randrange(300), "é"]) for _ in range(rnd.choice([1, 60, 150, 300]))]
        pool.append(rnd.choice([" ", "\n", "\t\x0b"]).join(words) + rnd.choice(["", "", " #", "A" * 400]))
    return pool


def test_against_brute_force_with_odd_rows(spark):
    rnd = random.Random(3)
    pool = texts(1)
    docs = [(rnd.choice([None, *range(60)]), rnd.choice(pool), rnd.choice([None, "", "en", "de"]), "p", 7) for _ in range(150)]
    docs += [(5, "same", "en", "p", 1)] * 3 + [(4, "same", "de", "p", 1), (9, "same", "en", "p", 1), (None, "same", "en", "p", 1)]
    labels = [(rnd.choice([None, *range(60)]), rnd.choice([None, 0, 1]), rnd.choice([None, 0, 1])) for _ in range(80)]
    rows = run(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert got(rows) == brute(docs, labels)
    assert len(rows) == 3 * 600
    assert all(r["filter"] == r.filter_order[r.step - 1] for r in rows)


def test_no_rows_and_fewer_filters(spark):
    labels = spark.createDataFrame([], LABELS)
    assert run(spark.createDataFrame([], DOCS), labels).count() == 0
    cells = spark.createDataFrame([("x", 3, 5, 1, 0), ("x", 0, 2, 2, 1)], "part string, mask int, n long, good long, toxic long")
    rows = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.shapley) for r in filter_audit.audit(cells, "AB").collect()}
    assert rows == {("AB", 1): (2, 5, 0, 5), ("AB", 2): (2, 0, 5, 5), ("BA", 1): (2, 5, 0, 5), ("BA", 2): (2, 0, 5, 5)}


def test_copies_are_added_up_before_they_meet(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("copy").alias("text"), F.lit("en").alias("lang"))
    rows = got(run(docs, spark.createDataFrame([], LABELS)).collect())
    assert rows["en", "EABCD", 1][:2] == (1, 4999)
    assert rows["en", "AEBCD", 2][:3] == (0, 0, 4999)
