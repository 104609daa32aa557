"""Misspelt and run-on SQL words in any text column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from srcweave.functions import text, vocab
from srcweave.session import broadcast_if_small

_PREFIX = "SQL syntax error: "


def sql_words(column: Column) -> Column:
    """Upper-cased words with `( ) , ; ' "` stripped from both ends."""
    words = F.filter(F.split(F.upper(column), text.WHITESPACE), lambda w: w != "")
    return F.transform(words, lambda w: F.btrim(w, F.lit("(),;'\"")))


def typo_table(spark: SparkSession, extra: DataFrame) -> DataFrame:
    """typos(word, fix): the built-in words, with `extra` rows added or replacing fixes."""
    fixed = spark.createDataFrame(list(vocab.SQL_TYPOS.items()), "word string, fix string")
    wanted = extra.select("word", "fix")
    return broadcast_if_small(fixed.join(wanted, "word", "left_anti").unionByName(wanted))


def _lint_message(word: Column, fix: Column) -> Column:
    message = F.when(
        fix.isNotNull(), F.concat(F.lit(_PREFIX + "'"), word, F.lit("' should be '"), fix, F.lit("'"))
    )
    for shapes, tail in vocab.SQL_RUN_ONS:
        before, _, after = tail.partition("{w}")
        shown = F.concat(F.lit(_PREFIX + before), word, F.lit(after)) if after else F.lit(_PREFIX + tail)
        message = message.when(text.contains_any(word, list(shapes)), shown)
    return message


_RUN_ONS = [shape for shapes, _ in vocab.SQL_RUN_ONS for shape in shapes]
# A misspelt word stands between blanks or stripped punctuation, so at word
# boundaries; a run-on may sit anywhere.
_SUSPECT = rf"\b{text.any_word(vocab.SQL_TYPOS)}\b|{text.any_word(_RUN_ONS)}"


def is_suspect(column: Column) -> Column:
    """SQL-like, and holding something the lint would report: one scan of the text."""
    return text.looks_like_sql(column) & F.upper(column).rlike(_SUSPECT)


def lint_words(column: Column) -> Column:
    """Offending words of a text as array<struct<word_idx, word, message>>."""
    fixes = F.create_map(*[F.lit(x) for pair in vocab.SQL_TYPOS.items() for x in pair])
    judged = F.transform(
        sql_words(column),
        lambda word, i: F.struct(
            i.alias("word_idx"), word.alias("word"), _lint_message(word, F.try_element_at(fixes, word)).alias("message")
        ),
    )
    return F.filter(judged, lambda w: w["message"].isNotNull())


def sql_lint(texts: DataFrame, column: str = "text", extra: DataFrame | None = None) -> DataFrame:
    """One row per offending word: the input columns but the text, plus
    `word_idx`, `word` and `message`.

    Texts with nothing to report are dropped by one scan before they are
    split, so only offenders are taken apart.  With caller-supplied words
    every SQL-like text is split and its words are joined to the word table.
    """
    body = F.col(column)
    kept = [c for c in texts.columns if c != column]
    if extra is None:
        return texts.filter(is_suspect(body)).select(*kept, F.inline(lint_words(body)))
    words = texts.filter(text.looks_like_sql(body)).select(
        *kept, F.posexplode(sql_words(body)).alias("word_idx", "word")
    )
    return (
        words.join(typo_table(texts.sparkSession, extra), "word", "left")
        .withColumn("message", _lint_message(F.col("word"), F.col("fix")))
        .filter(F.col("message").isNotNull())
        .select(*kept, "word_idx", "word", "message")
    )
