"""Reports over findings: order, counts, per-line views, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from srcweave.functions.text import ascii_only, severity_rank
from srcweave.operators.rules import with_traces

_LEVELS = {"ERROR": "errors", "WARNING": "warnings", "INFO": "infos"}


def type_key(code: str = "code", pattern: str = "pattern") -> Column:
    """What a finding is counted and selected by: its rule pattern, else its code."""
    ruled = (F.col(code) == "GRAMMAR_VULN") & (F.col(pattern) != "")
    return F.when(ruled, F.col(pattern)).otherwise(F.col(code))


def sorted_report(findings: DataFrame) -> DataFrame:
    """Worst severity first, then file and line, then the order of emission."""
    return findings.orderBy(*_report_order())


def _report_order() -> list[Column]:
    return [
        severity_rank(F.col("severity")).desc(),
        F.coalesce("file", F.lit("")),
        F.coalesce("lineno", F.lit(0)),
        F.col("emit_key"),
    ]


_IN_RANGE = 33  # bits a row number within a partition takes in a monotonically increasing id


def ranged_report(findings: DataFrame) -> DataFrame:
    """The sorted report with `place`, which grows along it; to be written down before it is numbered.

    Sorting deals the findings into ranges; a place is the number of the range
    and the number of the row in it.
    """
    ordered = findings.orderBy(*_report_order(), "code", "message", "error")
    return ordered.withColumn("place", F.monotonically_increasing_id())


def numbered_report(ranged: DataFrame) -> DataFrame:
    """Findings with their `position` in the whole report, from 1, given the written rows of `ranged_report`.

    The rows of each range are counted, the counts summed over the ranges
    before it, and the sum added to the number within the range.  Only one row
    per range meets in one task.
    """
    span = F.lit(1 << _IN_RANGE)
    each = F.floor(F.col("place") / span)
    counted = ranged.groupBy(each.alias("range")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = counted.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rows = ranged.withColumn("range", each).join(F.broadcast(bases), "range")
    return rows.withColumn("position", F.col("base") + F.col("place") % span + 1).drop("range", "base", "place")


def _level_counts() -> list[Column]:
    return [F.count_if(F.col("severity") == level).alias(name) for level, name in _LEVELS.items()]


def severity_counts(findings: DataFrame) -> DataFrame:
    """errors / warnings / infos per file, and overall in the row with null file."""
    known = findings.withColumn("file", F.coalesce("file", F.lit("")))
    return known.rollup("file").agg(F.count(F.lit(1)).alias("total"), *_level_counts())


def type_counts(findings: DataFrame) -> DataFrame:
    """Findings per type, most frequent first. Partial counts absorb a hot type."""
    counted = findings.filter(F.col("code").isNotNull()).groupBy(type_key().alias("type")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.orderBy(F.desc("n"), "type")


def distinct_types(findings: DataFrame) -> DataFrame:
    return findings.agg(
        F.countDistinct("code").alias("distinct_codes"),
        F.countDistinct(F.when(F.col("code") == "GRAMMAR_VULN", F.col("pattern"))).alias("distinct_patterns"),
        F.count_if(F.col("code") == "GRAMMAR_VULN").alias("grammar_findings"),
    )


def filter_findings(
    findings: DataFrame, types: list[str] | None = None, severities: list[str] | None = None
) -> DataFrame:
    if types is not None:
        findings = findings.filter(type_key().isin(*types))
    if severities is not None:
        findings = findings.filter(F.col("severity").isin(*severities))
    return findings


# The labels and line breaks of tooltips, badges and details are fixed values.
def _tooltip(f: Column) -> Column:
    ruled = f["pattern"].isNotNull() & (f["pattern"] != "")
    return F.concat(
        F.lit("["), f["severity"], F.lit("] "), f["code"], F.lit(": "), f["message"],
        F.when(ruled, F.concat(F.lit("\n  → Pattern: "), f["pattern"])).otherwise(""),
        F.when(
            f["tokens"].isNotNull(), F.concat(F.lit("\n  → Tokens: ["), F.array_join(f["tokens"], ", "), F.lit("]"))
        ).otherwise(""),
    )


def _badge(f: Column) -> Column:
    ruled = (f["code"] == "GRAMMAR_VULN") & f["pattern"].isNotNull()
    return F.concat(
        f["severity"], F.lit(": "), f["code"],
        F.when(ruled, F.concat(F.lit(" ["), f["pattern"], F.lit("]"))).otherwise(""),
    )


def badge_detail(f: Column) -> Column:
    """Hover text of one badge."""
    more = F.concat(
        F.when(f["pattern"].isNotNull(), F.concat(F.lit("\nPattern: "), f["pattern"])).otherwise(""),
        F.when(
            f["tokens"].isNotNull(), F.concat(F.lit("\nTokens: ["), F.array_join(f["tokens"], ", "), F.lit("]"))
        ).otherwise(""),
        F.when(
            f["parse_stack"].isNotNull(),
            F.concat(
                F.lit("\nParser States: ["),
                F.array_join(F.transform(f["parse_stack"], lambda s: s.cast("string")), ", "),
                F.lit("]"),
            ),
        ).otherwise(""),
    )
    return F.concat(f["message"], F.when(f["code"] == "GRAMMAR_VULN", more).otherwise(""))


def findings_by_line(findings: DataFrame) -> DataFrame:
    """lines(file, lineno, n, worst, types, badges, details, tooltip), in emission order.

    A group is one line of one file, so it is bounded by what one source row holds.
    """
    item = F.struct("emit_key", "severity", "code", "message", "pattern", "tokens", "parse_stack")
    grouped = (
        findings.filter(F.col("code").isNotNull())
        .groupBy("file", F.coalesce("lineno", F.lit(0)).alias("lineno"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max(severity_rank(F.col("severity"))).alias("rank"),
            F.sort_array(F.collect_list(item)).alias("items"),
        )
    )
    ruled = lambda f: F.when((f["code"] == "GRAMMAR_VULN") & f["pattern"].isNotNull(), f["pattern"])
    return grouped.select(
        "file",
        "lineno",
        "n",
        F.when(F.col("rank") == 3, "ERROR").when(F.col("rank") == 2, "WARNING").otherwise("INFO").alias("worst"),
        F.transform("items", lambda f: ruled(f).otherwise(f["code"])).alias("types"),
        F.transform("items", _badge).alias("badges"),
        F.transform("items", badge_detail).alias("details"),
        F.array_join(F.transform("items", _tooltip), "\n\n").alias("tooltip"),
    )


def first_flagged_line(findings: DataFrame) -> DataFrame:
    """First line of each file that carries a finding (a finding without a line flags none)."""
    flagged = findings.filter(F.col("code").isNotNull() & (F.coalesce("lineno", F.lit(0)) > 0))
    return flagged.groupBy("file").agg(F.min("lineno").alias("first_line"))


def annotate_lines(sources: DataFrame, by_line: DataFrame, partitions: int) -> DataFrame:
    """Every source line with its findings; lines without any are kept.

    The text is laid out by `file` before it is split, so it moves once, and
    the join finds both sides co-located.
    """
    lines = (
        sources.select("file", "source")
        .repartition(partitions, "file")
        .select("file", F.posexplode(F.split("source", "\n")).alias("i", "text"))
        .select("file", (F.col("i") + 1).alias("lineno"), "text")
    )
    return lines.join(by_line, ["file", "lineno"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def report_lines(findings: DataFrame) -> DataFrame:
    """One fixed-width text line per finding, in report order."""
    line = F.format_string(
        "%-7s %s:%4d %-20s - %s",
        F.coalesce("severity", F.lit("INFO")),
        F.coalesce("file", F.lit("<unknown>")),
        F.coalesce("lineno", F.lit(0)),
        F.coalesce("code", F.lit("ISSUE")),
        ascii_only(F.coalesce("message", F.lit(""))),
    )
    return sorted_report(findings).select(line.alias("line"))


def report_totals(findings: DataFrame) -> DataFrame:
    """The headline of the text report."""
    return findings.agg(F.count(F.lit(1)).alias("total"), *_level_counts())


_REPORTED = ("lineno", "code", "message", "severity", "pattern", "tokens", "parse_stack", "parse_trace", "phase", "error")


def file_reports(findings: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """reports(filename, findings): each file's findings as one ordered array, rule findings with their trace.

    `rules` are the caller's own, if the findings were made with some.
    """
    traced = with_traces(findings, rules)
    shown = F.struct("emit_key", *_REPORTED)
    grouped = traced.groupBy(F.col("file").alias("filename")).agg(F.collect_list(shown).alias("f"))
    ordered = F.array_sort("f", lambda a, b: F.when(a["emit_key"] < b["emit_key"], -1).when(a["emit_key"] > b["emit_key"], 1).otherwise(0))
    return grouped.select(
        "filename", F.transform(ordered, lambda f: F.struct(*[f[k].alias(k) for k in _REPORTED])).alias("findings")
    )


def upload_documents(sources: DataFrame, findings: DataFrame, failures: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """documents(filename, content, findings, parse_traces, error): the answer to an upload of each source.

    A file that does not parse has only its name and the error.  An upload goes
    by the last part of its path, in its traces as well.
    """
    short = F.element_at(F.split("file", "/"), -1)
    why = F.when(F.col("kind") == "syntax", F.concat(F.lit("Syntax error in uploaded file: "), "full")).otherwise(
        F.concat(F.lit("Error analyzing file: "), "message")
    )
    failed = failures.select("file", why.alias("error"))
    reports = file_reports(findings, rules).withColumnRenamed("filename", "file")
    answered = sources.select("file", "source").join(reports, "file", "left").join(failed, "file", "left")
    fine, kind = F.col("error").isNull(), dict(reports.dtypes)["findings"]
    found = F.transform(
        F.coalesce("findings", F.array().cast(kind)),
        lambda f: F.when(
            f["parse_trace"].isNotNull(), f.withField("parse_trace", f["parse_trace"].withField("filename", short))
        ).otherwise(f),
    )
    traces = F.transform(F.filter(found, lambda f: f["parse_trace"].isNotNull()), lambda f: f["parse_trace"])
    return answered.select(
        short.alias("filename"),
        F.when(fine, F.col("source")).alias("content"),
        F.when(fine, found).alias("findings"),
        F.when(fine, traces).alias("parse_traces"),
        "error",
    )
