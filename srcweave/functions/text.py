"""Column predicates over text. Pure Catalyst, usable on any string column."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from srcweave.functions import vocab

# Python's notion of whitespace: Unicode White_Space plus four separators.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"


def any_word(words: Iterable[str]) -> str:
    """Regular expression matching any of `words`, with common prefixes shared.

    A plain alternation tries every word at every position of a text; sharing
    prefixes leaves one test per distinct first letter.
    """
    tails: dict[str, list[str]] = {}
    for word in dict.fromkeys(words):
        tails.setdefault(word[:1], []).append(word[1:])
    branches = [
        re.escape(first) + (any_word(rest) if len(rest) > 1 else re.escape(rest[0]))
        for first, rest in tails.items()
        if first
    ]
    body = branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"
    return f"(?:{body})?" if "" in tails else body


def contains_any(text: Column, words: list[str]) -> Column:
    """True when any of `words` occurs in `text` as a substring."""
    return text.rlike(any_word(words))


def secret_pattern(text: Column) -> Column:
    """A key/secret/password/token assignment somewhere inside the text."""
    return text.rlike("(?i)" + vocab.SECRET_REGEX)


def aws_key(text: Column) -> Column:
    """The text starts with an AWS access key id."""
    return text.rlike(r"\A" + vocab.AWS_KEY_REGEX)


def long_token(text: Column) -> Column:
    """The whole text is one run of 20 or more base64 characters."""
    return text.rlike(r"\A" + vocab.LONG_TOKEN_REGEX + r"\z")


def looks_like_sql(text: Column) -> Column:
    """Upper-cased text holds any SQL keyword as a substring."""
    return contains_any(F.upper(text), vocab.SQL_KEYWORDS)


def severity_rank(severity: Column) -> Column:
    """ERROR 3, WARNING 2, anything else (also none) 1."""
    return F.when(severity == "ERROR", 3).when(severity == "WARNING", 2).otherwise(1)


def type_compatible(expected: Column, actual: Column) -> Column:
    """Equal types, or `numeric` against int/float in either direction."""
    return (
        (expected == actual)
        | ((expected == "numeric") & actual.isin("int", "float"))
        | ((actual == "numeric") & expected.isin("int", "float"))
    )


def ascii_only(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\x00-\x7F]", "")
