"""Per-file summaries joined from the relations of one analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from srcweave.functions import vocab
from srcweave.operators import flow, sweeps
from srcweave.operators.tokens import is_suspicious, token_stats

SUMMARY_METRICS = [
    "total_findings", "vulnerability_findings", "semantic_findings", "undefined_variables",
    "duplicate_definitions", "unused_variables", "functions_analyzed", "high_complexity_functions",
    "scopes_created", "symbols_tracked", "imports",
]
_LEVELS = {"ERROR": "errors", "WARNING": "warnings", "INFO": "infos"}


def _named() -> Column:
    """Findings that are counted: those with a code, but for syntax errors."""
    code = F.col("code")
    return code.isNotNull() & (code != "SYNTAX_ERROR")


def semantic_summary(nodes: DataFrame, findings: DataFrame) -> DataFrame:
    """Eleven counts per analysed file.

    Names, flow and findings are each scanned once and give one row per file.
    They share the layout by `file`, so putting them side by side moves nothing.
    """
    code = F.col("code")
    found = findings.filter(_named()).groupBy("file").agg(
        F.count(F.lit(1)).alias("total_findings"),
        F.count_if(code.startswith("GRAMMAR_")).alias("vulnerability_findings"),
        F.count_if(~code.startswith("GRAMMAR_")).alias("semantic_findings"),
        F.count_if(code == "UNDEFINED_VARIABLE").alias("undefined_variables"),
        F.count_if(code.startswith("DUPLICATE_")).alias("duplicate_definitions"),
    )
    measured = flow.final_complexity(nodes).groupBy("file").agg(
        F.count(F.lit(1)).alias("functions_analyzed"),
        F.count_if(F.col("complexity") >= vocab.COMPLEXITY_WARNING).alias("high_complexity_functions"),
    )
    joined = sweeps.name_counts(nodes).join(measured, "file", "left").join(found, "file", "left")
    return joined.select("file", *[F.coalesce(m, F.lit(0)).cast("long").alias(m) for m in SUMMARY_METRICS])


def lexical_part(tokens: DataFrame) -> DataFrame:
    """Token counts and suspicious tokens per file, from one tokenizing."""
    return token_stats(tokens, F.count_if(is_suspicious()).alias("suspicious_tokens"))


def syntactic_part(shredded: DataFrame) -> DataFrame:
    """What one scan of nodes and parse failures tells of each file.

    Counted by (file, node type, owner) first, an owner being the name a
    function or branch counts for, then by node type, then by file.
    """
    kind, failure, n = F.col("node_type"), F.col("error"), F.col("n")
    wrong = failure["kind"] == "syntax"
    rows = shredded.select(
        "file", "node_type", flow.counted_owner().alias("owner"),
        F.when(wrong, failure["full"]).alias("error"), F.when(wrong, failure["line"]).alias("line"),
        F.when(wrong, failure["offset"]).alias("offset"),
    )
    about = ["error", "line", "offset"]
    by_owner = rows.groupBy("file", "node_type", "owner", *about).agg(F.count(F.lit(1)).alias("n"))
    by_type = by_owner.groupBy("file", "node_type", *about).agg(F.sum("n").alias("n"), F.collect_set("owner").alias("owners"))

    def tally(name, *kinds):
        return F.coalesce(F.sum(F.when(kind.isin(*kinds), n)), F.lit(0)).alias(name)

    typed = F.filter(F.collect_list(F.struct("node_type", "n")), lambda t: t["node_type"].isNotNull())
    return by_type.groupBy("file").agg(
        F.sum(F.when(kind.isNotNull(), n)).alias("total_nodes"),
        F.map_from_entries(F.sort_array(typed)).alias("node_types"),
        tally("functions", "FunctionDef", "AsyncFunctionDef"),
        tally("classes", "ClassDef"),
        tally("imports", "Import", "ImportFrom"),
        tally("calls", "Call"),
        tally("assignments", "Assign", "AnnAssign"),
        tally("if_statements", "If"),
        tally("loops", "For", "While"),
        tally("try_blocks", "Try"),
        tally("aliases", "alias"),
        F.size(F.array_distinct(F.flatten(F.collect_list("owners")))).cast("long").alias("functions_analyzed"),
        *[F.max(name).alias(name) for name in about],
    )


def found_part(findings: DataFrame) -> DataFrame:
    """Findings per file, by severity."""
    return findings.filter(_named()).groupBy("file").agg(
        F.count(F.lit(1)).alias("vulnerabilities_found"),
        *[F.count_if(F.col("severity") == level).alias(name) for level, name in _LEVELS.items()],
        F.count_if(F.col("code").startswith("GRAMMAR_")).alias("grammar_rules_applied"),
    )


def phase_report(
    tokens: DataFrame, shredded: DataFrame, findings: DataFrame, partitions: int, *, prescreen: bool
) -> DataFrame:
    """One nested row per file: lexical, syntax, semantic and rule statistics.

    One pass over the tokens, one over the nodes and one over the findings,
    each down to a row per file.  Only the token counts are moved, into the
    `partitions` the other two lie in.  Files the prescreen skips get zero counts
    and `analysis_skipped`; files that do not parse have no semantic part.
    """
    zero = F.lit(0).cast("long")
    lexed = lexical_part(tokens).repartition(partitions, "file")
    joined = lexed.join(syntactic_part(shredded), "file", "left").join(found_part(findings), "file", "left")
    hits = F.col("suspicious_tokens")
    skipped = F.lit(prescreen) & (hits == 0)
    parsed = F.col("total_nodes").isNotNull()

    def count(name, alias=None):
        return F.when(skipped, zero).otherwise(F.coalesce(name, zero)).alias(alias or name)

    def of_parsed(*names):
        return [F.when(parsed, F.col(name)).alias(name) for name in names]

    lexical = F.struct("total_tokens", "keywords", "identifiers", "strings", "numbers", "operators", "comments")
    syntax_part = F.struct(
        *of_parsed("total_nodes", "node_types", "functions", "classes", "imports", "calls", "assignments", "if_statements",
                   "loops", "try_blocks"),
        "error", "line", "offset",
    )
    semantic = F.struct(
        F.lit(True).alias("prescreened"),
        hits.alias("suspicious_tokens"),
        count("vulnerabilities_found"),
        count("errors"),
        count("warnings"),
        count("infos", "info"),
        count("functions_analyzed"),
        count("aliases", "imports_found"),
        F.when(skipped, "No suspicious tokens detected").alias("analysis_skipped"),
    )
    grammar = F.struct(
        zero.alias("patterns_matched"),  # the matcher's own list is never filled
        count("grammar_rules_applied"),
    )
    return joined.select(
        F.col("file").alias("filename"),
        lexical.alias("phase1_lexical_analysis"),
        syntax_part.alias("phase2_syntax_analysis"),
        F.when(parsed, semantic).alias("phase3_semantic_analysis"),
        F.when(parsed, grammar).alias("phase4_grammar_analysis"),
    )
