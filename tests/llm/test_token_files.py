import sys
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from srcweave.llm import token_files, wordcache
from srcweave.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001/documents.parquet"


def brute(rows, path, end_id):
    tokenizer = Tokenizer.from_file(path)
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


ODD = [
    (5, "The cat, the CAT. don't stop... ÉÉ, é é İ ΑΣ, x y"),
    (3, None),
    (4, ""),
    (9, "word " * 30_000 + "ünïcödé, 123,456. a1, ..."),
    (None, "no key"),
    (12, "tab\tnew\nline\r\n\x0b\x0c end wide ̈mark ,. ,, a,, ß. ﬁ,"),
    (-1, "\x1c\x1d odd \x85 controls"),
]


@pytest.mark.parametrize("which", ["odd", "table", "empty"])
def test_round_trip_against_the_library(spark, tmp_path, which):
    path = tokenizer_path()
    schema = "doc_id long, text string, key string, part int"
    if which == "table":
        docs = spark.read.parquet(SF).select("doc_id", "text", F.lit("k").alias("key"), F.lit(7).alias("part"))
    else:
        docs = spark.createDataFrame([(*r, "k", 1) for r in ODD if which == "odd"], schema)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = str(tmp_path / "tokens")
    token_files.write_token_files(docs, out, path, 2)
    found = [tuple(r) for r in token_files.token_checksums(spark, out, "doc_id").collect()]
    assert sorted(found, key=str) == sorted(brute(rows, path, 2), key=str)
    index = {(r.doc_id, r.start, r.n_tokens) for r in token_files.token_index(spark, out, "doc_id").collect()}
    assert index == {f[:3] for f in found}


def test_repeated_rows_keep_a_place_each(spark, tmp_path):
    docs = spark.createDataFrame([(1, "same text")] * 50 + [(2, "other")], "doc_id long, text string")
    out = str(tmp_path / "tokens")
    token_files.write_token_files(docs, out, tokenizer_path(), 2)
    starts = sorted((r.start, r.n_tokens) for r in token_files.token_checksums(spark, out, "doc_id").collect())
    assert len(starts) == 51
    assert all(a[0] + a[1] == b[0] for a, b in zip(starts, starts[1:], strict=False))


def test_key_range_and_metadata_reads_are_selective(spark, tmp_path):
    docs = spark.read.parquet(SF)
    out = str(tmp_path / "tokens")
    token_files.write_token_files(docs, out, tokenizer_path(), 2)
    some = token_files.read_tokens(spark, out, 10, 12)
    assert sorted(r.key for r in some.collect()) == [10, 11, 12]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(key,10)" in plan
    assert "ids" not in token_files.token_index(spark, out)._jdf.queryExecution().executedPlan().toString()


# The tokenizer matches added tokens on the text as given, composes, and lowers last.
LOWERED_LAST = [
    "J\u030can H\u0331amza T\u0308 W\u030a Y\u030a j\u030can",
    "plain WORDS and Cafe\u0301, E\u0301TE\u0301. J\u0323\u030c J\u0591\u030c J\u0344",
    "<|ENDOFTEXT|> <|endoftext|> a<|EndOfText|>B, <|STARTOFTEXT|>. <|OTHER|>",
    "\u0372 Z\u0327. ÜBER Straße K\u212a",
]


@pytest.mark.parametrize("ordinary", [False, True])
def test_letters_are_not_lowered_before_they_are_composed(ordinary):
    library = Tokenizer.from_file(tokenizer_path())
    library.encode_special_tokens = ordinary
    table = wordcache._Pieces(library)
    for texts in ([t] for t in LOWERED_LAST), ([w] for t in LOWERED_LAST for w in t.split()), (LOWERED_LAST,):
        for some in texts:
            ids, sizes = wordcache.encode(pa.array(some), table)
            given = [library.encode(t, add_special_tokens=False).ids for t in some]
            assert ids.tolist() == sum(given, [])
            assert sizes.tolist() == [len(g) for g in given]


def test_marks_that_compose_with_ascii_letters_have_two_first_bytes():
    for c in map(chr, range(128, sys.maxunicode + 1)):
        if unicodedata.combining(c) or unicodedata.decomposition(c):
            for letter in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" if not "\ud800" <= c <= "\udfff" else "":
                if not unicodedata.normalize("NFC", letter + c).startswith(letter):
                    assert c.encode()[0] in (0xCC, 0xCD)


# Where marks meet letters, digits, combining marks, contractions and added tokens.
PARTED = [
    "don't x''s I'll!! a'S 1's rock'n'roll, 'tis. we're... o'ver'vers",
    "a≮b ≠ c≯ a`̀ x.́y z,̧, 12,3.4%5 a_b_c e-mail@host.tld/x?y=1&z=[2]",
    "end,", "", ",begin", "café, café!! é…. x…, a€$, ١, 中, á! É, \x1fa,\x7f.b",
    "see<|endoftext|>, a<|startoftext|>.b <|endoftext|", "<|EndOfText|>, x,<|x|>,",
]


@pytest.mark.parametrize("ordinary", [False, True])
def test_words_parted_from_marks_have_the_ids_of_the_whole_text(ordinary):
    library = Tokenizer.from_file(tokenizer_path())
    library.encode_special_tokens = ordinary
    marks = [chr(b) for b in range(33, 127) if not chr(b).isalnum()]
    every = [" ".join(f"a{m}{n}B 1{m}s {m}{n}t x{m}{n}" for m in marks for n in marks)]
    for texts in PARTED, every, [p.upper() for p in PARTED]:
        ids, sizes = wordcache.encode(pa.array(texts), wordcache._Pieces(library))
        given = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == sum(given, [])
        assert sizes.tolist() == [len(g) for g in given]


def test_a_word_is_encoded_once_whatever_marks_follow():
    library = Tokenizer.from_file(tokenizer_path())
    table = wordcache._Pieces(library)
    ends = ["", ",", ".", "!!", ";", ":", ")", '"', "***", "..."]
    words = [a + b for a in ("gan", "tel", "mor", "sip", "ruk") for b in ("ban", "del", "for", "tip", "luk")]
    wordcache.encode(pa.array([" ".join(w + e for w in words for e in ends)]), table)
    assert len(table) <= len(words) + len(ends)
