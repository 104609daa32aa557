"""The findings relation: one fixed schema all checks are unioned into."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from srcweave.operators.rules import emit_key

FINDING_FIELDS = {
    "file": "string",
    "lineno": "int",
    "code": "string",
    "message": "string",
    "severity": "string",
    "pattern": "string",
    "tokens": "array<string>",
    "parse_stack": "array<int>",
    "prod": "int",
    "phase": "string",
    "error": "string",
    "emit_key": "struct<pos:int,is_exit:int,neg_depth:int,sub:int>",
}


def conform(df: DataFrame) -> DataFrame:
    """Any check's output in the findings schema; missing columns are null."""
    return df.select(
        *[
            (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in FINDING_FIELDS.items()
        ]
    )


def union_findings(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [conform(p) for p in parts])


def syntax_errors(failures: DataFrame) -> DataFrame:
    """SYNTAX_ERROR findings of files that do not parse."""
    return failures.filter(F.col("kind") == "syntax").select(
        "file",
        F.col("line").alias("lineno"),
        F.lit("SYNTAX_ERROR").alias("code"),
        F.concat(F.lit("Syntax error while parsing: "), "message").alias("message"),
        F.lit("ERROR").alias("severity"),
        F.lit("PHASE_2_SYNTAX").alias("phase"),
        emit_key(F.lit(0)).alias("emit_key"),
    )


def syntax_error_stats(failures: DataFrame) -> DataFrame:
    """stats(file, error, line, offset, text) of files that do not parse."""
    return failures.filter(F.col("kind") == "syntax").select(
        "file", F.col("full").alias("error"), "line", "offset", "text"
    )


def error_rows(failures: DataFrame) -> DataFrame:
    """`{file, error}` rows, without severity, from any (file, error) relation."""
    return failures.filter(F.col("error").isNotNull()).select("file", "error")


def sql_findings(linted: DataFrame) -> DataFrame:
    """SQL_SYNTAX_ERROR findings from `sql_lint` over string literals."""
    return linted.select(
        "file",
        "lineno",
        F.lit("SQL_SYNTAX_ERROR").alias("code"),
        "message",
        F.lit("ERROR").alias("severity"),
        emit_key(F.col("ord"), sub=F.col("word_idx")).alias("emit_key"),
    )
