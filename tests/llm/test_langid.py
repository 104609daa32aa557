import math

import numpy as np
from pyspark.sql import functions as F

from srcweave.llm import langid
from srcweave.llm.queries import held_out

SF = "/root/testdata/sf0.01/documents.parquet"


def brute_bits(training: dict[str, list[bytes]], text: bytes) -> dict[str, float]:
    """PPM method C with exclusion, straight from the definition."""
    out = {}
    for lang, texts in training.items():
        counts: dict[bytes, dict[int, int]] = {}
        for t in texts:
            padded = bytes(langid.ORDER) + t
            for i in range(langid.ORDER, len(padded)):
                for j in range(langid.ORDER + 1):
                    seen = counts.setdefault(padded[i - j : i], {})
                    seen[padded[i]] = seen.get(padded[i], 0) + 1
        total, padded = 0.0, bytes(langid.ORDER) + text
        for i in range(langid.ORDER, len(padded)):
            excluded: set[int] = set()
            for j in range(langid.ORDER, -1, -1):
                own = {b: n for b, n in counts.get(padded[i - j : i], {}).items() if b not in excluded}
                n, kinds = sum(own.values()), len(own)
                if padded[i] in own:
                    total -= math.log2(own[padded[i]] / (n + kinds))
                    break
                if kinds:
                    total -= math.log2(kinds / (n + kinds))
                excluded |= own.keys()
            else:
                total += math.log2(256 - len(excluded))
        out[lang] = total
    return out


def test_code_lengths_against_the_definition(spark):
    training = {"aa": [b"abracadabra", "été à la mer".encode(), b"ab"], "bb": [b"the cat sat on the mat", b"abc"]}
    rows = [(i, t.decode(), lang) for i, (lang, t) in enumerate((la, t) for la, ts in training.items() for t in ts)]
    rows += [(90, None, "aa"), (91, "no language", None), (92, "", "bb"), (93, "abc", "bb")]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["aa", "bb"]
    texts = [b"abra", b"", "thé mat".encode(), b"zq\xf4\x8f\xbf\xbf!", b"cat abracadab"]
    bits = langid.code_lengths(model, texts)
    for text, found in zip(texts, bits, strict=True):
        expected = brute_bits(training, text)
        assert np.allclose(found, [expected["aa"], expected["bb"]], atol=1e-3)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(SF)
    found = langid.predict(docs, langid.train(docs.where(~held_out())))
    right = found.where(held_out()).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.98


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, score string, lang_pred int"
    rows = [(1, None, "en", "x", 1), (2, "", "en", "x", 1), (3, "123 !?", "fr", "x", 1), (4, "the cat", "en", "x", 1)]
    rows += [(7, "½ ² Ⅷ _", "en", "x", 1), (8, "½ e", "en", "x", 1)]  # number signs aren't letters
    rows += [(4, "the cat", "en", "x", 1), (5, "le chat été", "fr", None, None), (6, "the " * 50_000, None, "", 0)]
    docs = spark.createDataFrame(rows, schema)
    found = {(r.doc_id, r.lang_pred, r.score > 0) for r in langid.predict(docs, langid.train(docs)).collect()}
    assert {(1, "und", False), (2, "und", False), (3, "und", False), (7, "und", False), (4, "en", True), (6, "en", True)} <= found
    assert all(lang != "und" for i, lang, _ in found if i == 8)
    other_ids = docs.withColumn("doc_id", F.col("doc_id") * 1000)  # ids have no part in what is learnt
    a, b = (langid.train(d, sample=1) for d in (docs, other_ids))
    assert a.symbols == b.symbols and (a.bits == b.bits).all()
    nothing = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}
    assert langid.predict(docs.limit(0), nothing).count() == 0
