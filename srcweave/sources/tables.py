"""Sources that are already rows: text columns and encoded bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A run of well-formed UTF-8, on bytes read as Latin-1 (one character each).
_WELL_FORMED = (
    r"[\x00-\x7F]"
    r"|[\xC2-\xDF][\x80-\xBF]"
    r"|\xE0[\xA0-\xBF][\x80-\xBF]"
    r"|[\xE1-\xEC\xEE\xEF][\x80-\xBF]{2}"
    r"|\xED[\x80-\x9F][\x80-\xBF]"
    r"|\xF0[\x90-\xBF][\x80-\xBF]{2}"
    r"|[\xF1-\xF3][\x80-\xBF]{3}"
    r"|\xF4[\x80-\x8F][\x80-\xBF]{2}"
)


def source_table(df: DataFrame, file_col: str | Column, text_col: str | Column) -> DataFrame:
    """sources(file, source) from any table with a name and a text column."""
    file = F.col(file_col) if isinstance(file_col, str) else file_col
    source = F.col(text_col) if isinstance(text_col, str) else text_col
    return df.select(file.cast("string").alias("file"), source.alias("source"))


def drop_invalid_utf8(content: Column) -> Column:
    """Bytes to text, skipping every byte outside a well-formed sequence."""
    latin = F.decode(content, "ISO-8859-1")
    kept = F.regexp_replace(latin, f"((?:{_WELL_FORMED})++)|[\\x80-\\xFF]", "$1")
    return F.decode(F.encode(kept, "ISO-8859-1"), "UTF-8")


def decode_sources(df: DataFrame, mode: str = "strict") -> DataFrame:
    """sources(file, source, error) from (file, content BINARY).

    `strict` reads text files: bad UTF-8 becomes an error row, line endings
    become `\\n`.  `ignore` drops bad bytes and keeps line endings.
    """
    content = F.col("content")
    text = content.cast("string")
    valid = F.is_valid_utf8(text)
    unread = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    bad = F.lit("'utf-8' codec can't decode bytes")
    if "utf8_error" in df.columns:
        bad = F.coalesce("utf8_error", bad)
    if mode == "strict":
        return df.select(
            "file",
            F.when(valid, F.regexp_replace(text, "\r\n?", "\n")).alias("source"),
            F.coalesce(unread, F.when(~valid, bad)).alias("error"),
        )
    if mode == "ignore":
        return df.select(
            "file", F.when(valid, text).otherwise(drop_invalid_utf8(content)).alias("source"), unread.alias("error")
        )
    raise ValueError("mode is 'strict' or 'ignore'")
