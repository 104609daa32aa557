import random
import re
from collections import Counter, defaultdict

import numpy as np

from srcweave.llm import divergence, term_counts

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long"


def terms_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(docs, min_docs=3, top=200):
    held, counts, sources = defaultdict(set), Counter(), defaultdict(set)
    for d, (_, text, lang, source, *_) in enumerate(docs):
        lang, source = lang or "", source or ""
        sources[lang].add(source)
        for t in terms_of(text):
            held[lang, t].add(d)
            counts[lang, source, t] += 1
    rows = set()
    for lang, names in sources.items():
        kept = [t for (where, t), ids in held.items() if where == lang and len(ids) >= min_docs]

        def shares(some, lang=lang, kept=kept):
            n = {t: sum(counts[lang, s, t] for s in some) for t in kept}
            below = sum(n.values()) + len(kept)
            return {t: 1 + 10**9 * (n[t] + 1) // below for t in kept}

        p, q = {s: shares([s]) for s in names}, shares(names)
        for s in names:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode(), o) for o in names if o != s]
            own = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if counts[lang, s, t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", sorted(own)[:top])):
                rows |= {(lang, s, part, item, -value, i) for i, (value, _, item) in enumerate(sorted(found), 1)}
    return rows


def got(df):
    rows = df.collect()
    found = {(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in rows}
    assert len(found) == len(rows)
    return found


def odd_documents(n_sources=6, n=260):
    rnd = random.Random(n_sources)
    words = ["a", "An", "the", "ÉTÉ", "été", "don't", "x1y", "ß", "日本", "naïve-Bayes", "w" * 40, "ab" * 9, "abcdefgh", "abcdefghijklmnop"]
    words += ["".join(rnd.choice("abcdé") for _ in range(rnd.randrange(1, 20))) for _ in range(60)]
    docs = []
    for i in range(n):
        text = rnd.choice([" ", "\n", "_", "0"]).join(rnd.choice(words[: rnd.choice([4, 20, 80])]) for _ in range(rnd.randrange(30)))
        docs.append((i % 50, text, rnd.choice([None, "", "en", "en", "en"]), f"s{rnd.randrange(n_sources)}", "t", 1))
    docs += [(1, None, "de", None, "t", 1), (None, "", "de", "q", "t", 1), (2, "only once", "fr", "q", "t", 1)]
    docs += [(3, "Hot word " * 5, "en", "s0", "t", 1)] * 100
    return docs


def test_against_brute_force_with_odd_rows(spark):
    docs = odd_documents()
    df = spark.createDataFrame(docs, SCHEMA).repartition(5)
    assert got(divergence.source_divergence(df)) == brute(docs)
    assert got(divergence.source_divergence(df, min_docs=1, top=2)) == brute(docs, 1, 2)
    assert divergence.source_divergence(df.limit(0)).count() == 0


def test_many_sources_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_COUNTS", 50)
    wide = [(i, f"w{'ab'[i % 2]} w{'abcdefg'[i % 7]} common", "en", f"s{i % 150:03}", "t", 1) for i in range(600)]
    assert got(divergence.source_divergence(spark.createDataFrame(wide, SCHEMA))) == brute(wide)


def test_slices_and_long_texts_count_alike():
    rnd = random.Random(9)
    texts = [" ".join(rnd.choice(["Ab", "é" * rnd.randrange(1, 30), "word%s" % ("x" * rnd.randrange(20))]) for _ in range(400)).encode() for _ in range(30)]
    groups = np.sort(np.array([rnd.randrange(3) for _ in texts]))
    n, docs = Counter(), Counter()
    for term, group, many, in_docs in term_counts.count_slice(texts, groups):
        for t, g, a, b in zip(term.to_pylist(), group.tolist(), many.tolist(), in_docs.tolist(), strict=True):
            n[g, t] += a
            docs[g, t] += b
    wanted, held = Counter(), Counter()
    for g, text in zip(groups.tolist(), texts, strict=True):
        found = terms_of(text.decode())
        wanted.update((g, t) for t in found)
        held.update((g, t) for t in set(found))
    assert n == wanted and docs == held
    whole = b" ".join(texts)
    pieces = {t: (a, b) for c in term_counts.count_long(whole, 0, 1000) for t, a, b in zip(c[0].to_pylist(), c[2].tolist(), c[3].tolist(), strict=True)}
    assert pieces == {t: (a, 1) for t, a in Counter(terms_of(whole.decode())).items()}
    assert list(term_counts.count_slice([b"", b" 1 "], np.array([0, 0]))) == []


def test_radix_order_is_stable():
    rnd = np.random.default_rng(4)
    words = [rnd.integers(0, 1 << 62, 5000, dtype=np.uint64) >> np.uint64(40) << np.uint64(40) for _ in range(2)]
    assert term_counts.radix_order(words, 8).tolist() == np.lexsort((words[1], words[0])).tolist()
    assert term_counts.radix_order(words[:1], 4).tolist() == np.argsort(words[0], kind="stable").tolist()
