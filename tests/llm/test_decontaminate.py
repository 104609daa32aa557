import re

from srcweave.llm.decontaminate import find_benchmark

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, width):
    words = fold(text)
    hit, ids = set(), set()
    for key, item in items:
        own = fold(item)
        if key is None or not own:
            continue
        n = min(width, len(own))
        for i in range(len(own) - n + 1):
            for j in range(len(words) - n + 1):
                if words[j : j + n] == own[i : i + n]:
                    hit |= set(range(j, j + n))
                    ids.add(str(key))
    return len(words), len(hit), sorted(ids)


ITEMS = [(1, "a b c d e"), (2, "Short Item"), (2, "Short Item"), (10, "é1 b! c"), (None, "x y z w"), (5, None), (6, "..."), (7, "c d e f g")]
DOCS = [
    (1, "zz A, b c-d e f g zz"),
    (2, None),
    (3, ""),
    (4, "short item short itemx xshort item"),
    (5, "É1 b c é1 b c"),
    (5, "É1 b c é1 b c"),
    (None, "x y z w a b c d"),
    (6, "q r " * 40_000 + "SHORT item"),
]


def test_against_brute_force(spark):
    docs = spark.createDataFrame([(*r, "x", 1) for r in DOCS], "doc_id long, text string, found string, item_id int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for width in (3, 10):
        rows = find_benchmark(docs, items, width).collect()
        assert len(rows) == len(DOCS)
        texts = {(r.doc_id, r.text): r for r in rows}
        for key, text in DOCS:
            f = texts[key, text].found
            if text and len(text) > 1000:
                assert f.n_words == 80_002 and f.n_hit == 2 and f.item_ids == ["2"]
                continue
            assert (f.n_words, f.n_hit, f.item_ids) == brute(text, ITEMS, width)
            raw = (text or "").encode()
            assert sum(len(fold(raw[s.start : s.end].decode())) for s in f.spans) == f.n_hit


def test_many_automata_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    one = sorted(map(str, find_benchmark(docs, items, 3).collect()))
    monkeypatch.setattr("srcweave.llm.decontaminate.PATTERN_BYTES", 5)
    assert sorted(map(str, find_benchmark(docs, items, 3).collect())) == one


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert find_benchmark(docs.limit(0), items).count() == 0
    assert {r.found.n_hit for r in find_benchmark(docs, items.limit(0)).collect()} == {0}
