"""Token relation: types, positions, losslessness."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from srcweave.operators import tokens

CASES = {
    "spaces": ("  x\t= 1 ", [("IDENTIFIER", "x", 1, 3), ("ASSIGN", "=", 1, 5), ("NUMBER", "1", 1, 7), ("EOF", "", 1, 9)]),
    "empty": ("", [("EOF", "", 1, 1)]),
    "only_blanks": (" \t", [("EOF", "", 1, 3)]),
    "leading_zero": ("007", [("NUMBER", "0", 1, 1), ("NUMBER", "0", 1, 2), ("NUMBER", "7", 1, 3), ("EOF", "", 1, 4)]),
    "number_then_word": ("1else", [("NUMBER", "1e", 1, 1), ("IDENTIFIER", "lse", 1, 3), ("EOF", "", 1, 6)]),
    "numbers": (
        "0x1F 0b01 0o7 1_0.5e-3j 0.5",
        [("NUMBER", "0x1F", 1, 1), ("NUMBER", "0b01", 1, 6), ("NUMBER", "0o7", 1, 11), ("NUMBER", "1_0.5e-3j", 1, 15),
         ("NUMBER", "0.5", 1, 25), ("EOF", "", 1, 28)],
    ),
    "fstring": ('f"a{b}"', [("IDENTIFIER", "f", 1, 1), ("STRING", '"a{b}"', 1, 2), ("EOF", "", 1, 8)]),
    "escapes": (r"'a\'b' x", [("STRING", r"'a\'b'", 1, 1), ("IDENTIFIER", "x", 1, 8), ("EOF", "", 1, 9)]),
    "unterminated": ("'ab\ncd", [("STRING", "'ab\ncd", 1, 1), ("EOF", "", 2, 3)]),
    "triple": (
        '"""a\n"b""" x',
        [("STRING", '"""a\n"b"""', 1, 1), ("IDENTIFIER", "x", 2, 7), ("EOF", "", 2, 8)],
    ),
    "comment": ("# hi \nif", [("COMMENT", "# hi ", 1, 1), ("NEWLINE", "\n", 1, 6), ("KEYWORD", "if", 2, 1), ("EOF", "", 2, 3)]),
    "operators": (
        "**= //= ... -> := != << ~ ! $",
        [("DOUBLE_STAR_ASSIGN", "**=", 1, 1), ("DOUBLE_SLASH_ASSIGN", "//=", 1, 5), ("ELLIPSIS", "...", 1, 9),
         ("ARROW", "->", 1, 13), ("WALRUS", ":=", 1, 16), ("NE", "!=", 1, 19), ("LSHIFT", "<<", 1, 22),
         ("TILDE", "~", 1, 25), ("ERROR", "!", 1, 27), ("ERROR", "$", 1, 29), ("EOF", "", 1, 30)],
    ),
    "unicode": ("é٣ ²x", [("IDENTIFIER", "é٣", 1, 1), ("NUMBER", "²", 1, 4), ("IDENTIFIER", "x", 1, 5), ("EOF", "", 1, 6)]),
    "carriage_return": ("a\r\nb", [("IDENTIFIER", "a", 1, 1), ("NEWLINE", "\n", 1, 3), ("IDENTIFIER", "b", 2, 1), ("EOF", "", 2, 2)]),
}


@pytest.fixture(scope="module")
def positioned(spark, sources_of):
    rows = {}
    df = tokens.with_position(sources_of({k: v[0] for k, v in CASES.items()}), 4)
    for r in df.orderBy("file", "pos").collect():
        rows.setdefault(r["file"], []).append((r["pos"], r["type"], r["value"], r["line"], r["col"]))
    return rows


@pytest.mark.parametrize("name", CASES)
def test_tokens(positioned, name):
    rows = positioned[name]
    assert [r[0] for r in rows] == list(range(len(rows)))
    assert [r[1:] for r in rows] == CASES[name][1]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab01_.'\"\\#\n \t\r=*é$", max_size=40), min_size=20, max_size=40))
def test_lexemes_are_lossless_and_positions_point_into_the_text(spark, texts):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "file string, source string")
    glued = df.select(F.concat_ws("", tokens.lexemes(F.col("source"))).alias("glued"), "source").collect()
    assert all(r["glued"] == r["source"] for r in glued)
    lines = {str(i): t.split("\n") for i, t in enumerate(texts)}
    for r in tokens.with_position(df, 4).collect():
        first = r["value"].split("\n")[0]
        assert lines[r["file"]][r["line"] - 1][r["col"] - 1 :].startswith(first)


def test_stats_and_prescreen(spark, sources_of):
    df = sources_of({"a": "x := eval(1) # c\ny += 'SELECT'\n", "b": "os.system\n"})
    found = tokens.tokenize(df)
    row = tokens.token_stats(found).filter("file = 'a'").first()
    assert (row["total_tokens"], row["operators"], row["comments"], row["strings"]) == (13, 1, 1, 1)
    words = {r["file"]: r["suspicious_words"] for r in tokens.prescreen_words(found).collect()}
    assert words == {"a": ["eval"]}  # dotted entries never match, strings keep their quotes
    assert {r["type"] for r in tokens.filter_tokens(found).collect()}.isdisjoint({"COMMENT"})


def test_long_strings_do_not_overflow(spark, sources_of):
    texts = {"escapes": "'" + "\\n" * 200_000 + "'", "quotes": '"""' + '"a' * 200_000 + '"""', "blanks": " " * 300_000}
    counts = tokens.tokenize(sources_of(texts)).groupBy("file").count().collect()
    assert {r["file"]: r["count"] for r in counts} == {"escapes": 2, "quotes": 2, "blanks": 1}
