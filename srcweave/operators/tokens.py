"""Token relation: one regular expression, exploded. No Python in the loop.

A lexeme is a token with the blanks before it, so a file explodes into exactly
as many rows as it has tokens and positions come from running sums of lexeme
lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from srcweave.functions import vocab
from srcweave.session import partitions_for

# Decimal digits, and the non-decimal digits Python's isdigit() also accepts.
_ODD_DIGITS = (
    "²³¹፩-፱᧚⁰⁴-⁹₀-₉"
    "①-⑨⑴-⑼⒈-⒐⓪⓵-⓽⓿"
    "❶-❾➀-➈➊-➒"
)
_DIGIT = rf"[\p{{Nd}}{_ODD_DIGITS}]"
_BLANKS = " \t\r"

_TOKEN_BRANCHES = [
    r"\n",
    r"#[^\n]*+",
    r'"""(?>[^"\\]++|\\[\s\S]|"(?!""))*+(?:"""|\\?\z)',
    r"'''(?>[^'\\]++|\\[\s\S]|'(?!''))*+(?:'''|\\?\z)",
    r'"(?>[^"\\]++|\\[\s\S])*+(?:"|\\?\z)',
    r"'(?>[^'\\]++|\\[\s\S])*+(?:'|\\?\z)",
    rf"(?:0(?:[bB][01_]*|[oO][0-7_]*|[xX](?:{_DIGIT}|[a-fA-F_])*|\.{_DIGIT}*)?"
    rf"|{_DIGIT}(?:{_DIGIT}|_)*(?:\.{_DIGIT}*)?)(?:[eE][+-]?{_DIGIT}*)?[jJ]?",
    r"[\p{L}_][\p{L}\p{N}_]*+",
    r"\.\.\.|//=|\*\*=|<<=|>>=|==|!=|<=|>=|<<|>>|\*\*|//|[+\-*/%&|^@:]=|->",
    r"[^ \t\r]",
]
LEXEME = r"[ \t\r]*+(?:" + "|".join(_TOKEN_BRANCHES) + r")|[ \t\r]++"


def lexemes(source: Column) -> Column:
    """All lexemes of a text, in order; their concatenation is the text."""
    return F.regexp_extract_all(source, F.lit(LEXEME), F.lit(0))


def _with_end(found: Column) -> Column:
    # The end-of-file token is the trailing blanks, or an empty lexeme.
    last = F.ltrim(F.get(found, F.size(found) - 1), F.lit(_BLANKS))
    return F.when(last == "", found).otherwise(F.concat(found, F.array(F.lit(""))))


def token_type(value: Column) -> Column:
    first = F.substring(value, 1, 1)
    spelling = F.create_map(*[F.lit(x) for pair in vocab.OPERATORS.items() for x in pair])
    ascii_letter = first.between("a", "z") | first.between("A", "Z") | (first == "_")
    word = F.when(value.isin(vocab.KEYWORDS), "KEYWORD").otherwise("IDENTIFIER")
    return (
        F.when(value == "", "EOF")
        .when(ascii_letter, word)
        .when(value == "\n", "NEWLINE")
        .when(first == "#", "COMMENT")
        .when(first.isin('"', "'"), "STRING")
        .when(first.between("0", "9"), "NUMBER")
        .when(first < "\x7f", F.coalesce(F.try_element_at(spelling, value), F.lit("ERROR")))
        .when(first.rlike(_DIGIT), "NUMBER")
        .when(first.rlike(r"\p{L}"), word)
        .otherwise("ERROR")
    )


def _exploded(sources: DataFrame) -> DataFrame:
    found = sources.select("file", lexemes(F.col("source")).alias("found"))
    rows = found.select("file", F.posexplode(_with_end(F.col("found"))).alias("pos", "lexeme"))
    return rows.withColumn("value", F.ltrim(F.col("lexeme"), F.lit(_BLANKS)))


def tokenize(sources: DataFrame) -> DataFrame:
    """tokens(file, pos, type, value): narrow, no shuffle."""
    value = F.col("value")
    return _exploded(sources).select("file", "pos", token_type(value).alias("type"), "value")


def with_position(sources: DataFrame, partitions: int | None = None) -> DataFrame:
    """tokens(file, pos, type, value, line, col), both 1-based.

    The raw text is laid out by `file` first: that is the only exchange, and
    it moves the text once instead of every exploded token.
    """
    n = partitions or partitions_for(sources)
    rows = _exploded(sources.select("file", "source").repartition(n, "file"))
    before = Window.partitionBy("file").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    value, lexeme = F.col("value"), F.col("lexeme")
    breaks = F.length(value) - F.length(F.replace(value, F.lit("\n"), F.lit("")))
    tail = F.length(F.substring_index(value, "\n", -1))
    measured = (
        rows.withColumn("width", F.length(lexeme))
        .withColumn("breaks", breaks)
        .withColumn("offset", F.coalesce(F.sum("width").over(before), F.lit(0)))
        .withColumn("line", 1 + F.coalesce(F.sum("breaks").over(before), F.lit(0)))
        .withColumn("line_start", F.when(F.col("breaks") > 0, F.col("offset") + F.col("width") - tail))
        .withColumn("line_start", F.coalesce(F.max("line_start").over(before), F.lit(0)))
    )
    start = F.col("offset") + F.col("width") - F.length(value)
    return measured.select(
        "file",
        "pos",
        token_type(value).alias("type"),
        "value",
        F.col("line").cast("int").alias("line"),
        (1 + start - F.col("line_start")).cast("int").alias("col"),
    )


def filter_tokens(tokens: DataFrame, exclude: tuple[str, ...] = ("COMMENT", "WHITESPACE")) -> DataFrame:
    return tokens.filter(~F.col("type").isin(*exclude))


def token_stats(tokens: DataFrame, *more: Column) -> DataFrame:
    """Seven counts per file, and whatever `more` aggregates ask for; partial aggregation leaves one row per file to move."""
    kind = F.col("type")
    counted = kind.endswith("ASSIGN") | kind.isin(vocab.COUNTED_OPERATORS)
    return tokens.groupBy("file").agg(
        F.count(F.lit(1)).alias("total_tokens"),
        F.count_if(kind == "KEYWORD").alias("keywords"),
        F.count_if(kind == "IDENTIFIER").alias("identifiers"),
        F.count_if(kind == "STRING").alias("strings"),
        F.count_if(kind == "NUMBER").alias("numbers"),
        F.count_if(counted).alias("operators"),
        F.count_if(kind == "COMMENT").alias("comments"),
        *more,
    )


def is_suspicious() -> Column:
    return F.col("value").isin(vocab.SUSPICIOUS_WORDS)


def prescreen_hits(tokens: DataFrame) -> DataFrame:
    """hits(file, pos, value): tokens that are a suspicious word."""
    return tokens.filter(is_suspicious()).select("file", "pos", "value")


def prescreen_words(tokens: DataFrame) -> DataFrame:
    """Per file with a hit: the suspicious words in order, repeats kept."""
    ordered = F.sort_array(F.collect_list(F.struct("pos", "value")))
    return prescreen_hits(tokens).groupBy("file").agg(
        F.transform(ordered, lambda h: h["value"]).alias("suspicious_words"),
        F.count(F.lit(1)).alias("suspicious_tokens"),
    )


def prescreen_gate(
    relation: DataFrame, tokens: DataFrame | None = None, *, kept: bool = True, words: DataFrame | None = None
) -> DataFrame:
    """Rows of any per-file relation whose file passes (or fails) the prescreen.

    Takes the tokens, or the `words` that `prescreen_words` made of them: if
    these are staged in the layout of `relation`, nothing is tokenized or moved.
    """
    hits = (prescreen_hits(tokens) if words is None else words).select("file").distinct()
    return relation.join(hits, "file", "left_semi" if kept else "left_anti")
