"""End-to-end analysis of a source corpus.

`Analysis` wires the operators into the three ways of running them: a
directory scan (prescreened), an upload, and text already in a table.  Source
text is laid out by `file` once, before parsing; what several queries share
(nodes, resolved names, findings) is staged as tables bucketed by `file`, so
the queries on top of them join and window without moving rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from srcweave import session
from srcweave.operators import findings, flow, report, rules, sql_lint, sweeps, symbols, syntax, tokens
from srcweave.plans import summary
from srcweave.sources.files import scan_sources
from srcweave.sources.tables import source_table


class Analysis:
    """Lazily built relations of one corpus of sources(file, source).

    `file` names a row: two rows must not share it.  A file is one row of the
    input, so whatever is grouped per file is bounded by what one row holds.

    prescreen    only report on files holding a suspicious word
    typos, rules extra rows for the SQL word and rule tables
    partitions   hash partitions of the layout; by default from the input size
    keep_sources write the sources down first, when reading them again is
                 costly or may differ (directories, streams); rows with an
                 `error` column set are reported instead of analysed
    staged       False keeps the sources and nodes of a small corpus (one
                 micro-batch) in executor memory and on their disks instead
                 of tables, and leaves findings to the one job that writes
                 them; what an executor loses is parsed again
    """

    def __init__(
        self,
        sources: DataFrame,
        *,
        prescreen: bool = False,
        typos: DataFrame | None = None,
        rules: DataFrame | None = None,
        partitions: int | None = None,
        keep_sources: bool = False,
        staged: bool = True,
    ):
        session.tune(sources.sparkSession)
        self._staged: list[str] = []
        self._kept: list[DataFrame] = []
        self.staged = staged
        if keep_sources and not staged:
            sources = sources.persist()
            self._kept.append(sources)
        elif keep_sources:
            sources, name = session.store(sources, "sources")
            self._staged.append(name)
        self.read_failures = None
        if "error" in sources.columns:
            self.read_failures = sources.filter(F.col("error").isNotNull()).select("file", "error")
            sources = sources.filter(F.col("error").isNull())
        self.sources = sources.select("file", "source").filter(F.col("source").isNotNull())
        self.prescreen = prescreen
        self.extra_typos = typos
        self.extra_rules = rules
        self.partitions = partitions or session.partitions_for(sources)

    def _stage(self, df: DataFrame, label: str, *, shuffle: bool = True) -> DataFrame:
        if not self.staged:
            kept = (df.repartition(self.partitions, "file") if shuffle else df).persist()
            self._kept.append(kept)
            return kept
        table, name = session.stage(df, label, self.partitions, shuffle=shuffle)
        self._staged.append(name)
        return table

    def release(self) -> None:
        """Drop the staged tables. Relations of this analysis are unusable afterwards."""
        while self._staged:
            session.unstage(self.sources.sparkSession, self._staged.pop())
        while self._kept:
            self._kept.pop().unpersist()

    # -- tokens ------------------------------------------------------------

    @cached_property
    def tokens(self) -> DataFrame:
        return tokens.tokenize(self.sources)

    @cached_property
    def positioned_tokens(self) -> DataFrame:
        return tokens.with_position(self.sources, self.partitions)

    @cached_property
    def suspicious(self) -> DataFrame:
        """suspicious(file, suspicious_words, suspicious_tokens), staged."""
        return self._stage(tokens.prescreen_words(self.tokens), "suspicious")

    # -- syntax ------------------------------------------------------------

    @cached_property
    def shredded(self) -> DataFrame:
        laid_out = self.sources.repartition(self.partitions, "file")
        stored = self._stage(syntax.shred(laid_out), "nodes", shuffle=False)
        # a file has one root row (or one failure row); two mean a shared name
        roots = stored.filter(F.col("ord") <= 0).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
        shared = roots.filter(F.col("n") > 1).agg(F.count(F.lit(1)).alias("n"), F.min("file").alias("file")).first()
        if shared["n"]:
            raise ValueError(f"rows of the source table share the file name {shared['file']!r}")
        return stored

    @cached_property
    def all_nodes(self) -> DataFrame:
        return syntax.nodes(self.shredded)

    @cached_property
    def parse_failures(self) -> DataFrame:
        return syntax.parse_failures(self.shredded)

    @cached_property
    def nodes(self) -> DataFrame:
        """Nodes of the files under analysis: all, or those passing the prescreen.

        The gate sits after parsing, because files it skips still report
        syntax errors and syntax statistics.
        """
        if not self.prescreen:
            return self.all_nodes
        return self.gate(self.all_nodes)

    def gate(self, relation: DataFrame, *, kept: bool = True) -> DataFrame:
        """Rows of a per-file relation whose file passes (or fails) the prescreen, by the staged hits."""
        return tokens.prescreen_gate(relation, words=self.suspicious, kept=kept)

    # -- names -------------------------------------------------------------

    @cached_property
    def define_events(self) -> DataFrame:
        return symbols.define_events(self.nodes)

    @cached_property
    def first_definitions(self) -> DataFrame:
        """First define of every user-code symbol, staged."""
        return self._stage(symbols.first_definitions(self.define_events), "symbols")

    @cached_property
    def resolved(self) -> DataFrame:
        """Every name use with the scope it resolves to, staged."""
        return self._stage(symbols.resolve(symbols.name_uses(self.nodes), self.first_definitions), "resolved")

    def symbol_table(self) -> DataFrame:
        return sweeps.symbol_table(self.nodes)

    # -- findings ----------------------------------------------------------

    @cached_property
    def site_symbols(self) -> DataFrame:
        return rules.site_symbols(self.nodes)

    @cached_property
    def matches(self) -> DataFrame:
        return rules.match_rules(self.site_symbols, self.extra_rules)

    @cached_property
    def grammar_findings(self) -> DataFrame:
        return rules.grammar_findings(self.matches)

    @cached_property
    def traces(self) -> DataFrame:
        return rules.explain_match(self.matches)

    @cached_property
    def sql_findings(self) -> DataFrame:
        literals = syntax.string_literals(self.nodes)
        return findings.sql_findings(sql_lint.sql_lint(literals, "text", self.extra_typos))

    @cached_property
    def semantic_findings(self) -> DataFrame:
        return findings.union_findings(
            symbols.undefined_variables(self.resolved),
            symbols.duplicates(self.define_events),
            symbols.unused_parameters(self.nodes, self.first_definitions, self.resolved),
            flow.flow_findings(flow.complexity(self.nodes)),
        )

    @cached_property
    def error_rows(self) -> DataFrame:
        """Files that could not be read, or failed to parse other than by a syntax error."""
        broken = self.parse_failures.filter(F.col("kind") == "other").select("file", F.col("message").alias("error"))
        rows = findings.error_rows(broken)
        if self.read_failures is not None:
            rows = rows.unionByName(self.read_failures)
        return rows

    def swept_findings(self) -> DataFrame:
        """All findings of the corpus by three scans of the nodes, not staged."""
        parts = [sweeps.site_and_flow_findings(self.nodes, self.extra_rules), sweeps.name_findings(self.nodes)]
        if self.prescreen or self.extra_typos is not None:
            # syntax errors are reported for skipped files too, and own words are joined
            parts += [self.sql_findings, findings.syntax_errors(self.parse_failures), self.error_rows]
        else:
            parts.append(sweeps.literal_and_failure_findings(self.shredded))
            if self.read_failures is not None:
                parts.append(self.read_failures)
        return findings.union_findings(*parts)

    @cached_property
    def findings(self) -> DataFrame:
        """All findings of the corpus, staged (or, kept in memory, as they are worked out)."""
        swept = self.swept_findings()
        return self._stage(swept, "findings") if self.staged else swept

    # -- reports -----------------------------------------------------------

    def report(self) -> DataFrame:
        return report.sorted_report(self.findings)

    def numbered_report(self) -> DataFrame:
        """The report with the position of each finding as a column."""
        ranged, name = session.store(report.ranged_report(self.findings), "report")
        self._staged.append(name)
        return report.numbered_report(ranged)

    def summary(self) -> DataFrame:
        return summary.semantic_summary(self.nodes, self.findings)

    def by_line(self) -> DataFrame:
        return report.findings_by_line(self.findings)

    def annotated_lines(self) -> DataFrame:
        return report.annotate_lines(self.sources, self.by_line(), self.partitions)

    def upload_documents(self) -> DataFrame:
        return report.upload_documents(self.sources, self.findings, self.parse_failures, self.extra_rules)

    def phase_report(self) -> DataFrame:
        return summary.phase_report(
            self.tokens, self.shredded, self.findings, self.partitions, prescreen=self.prescreen
        )


def analyze_table(df: DataFrame, file_col: str, text_col: str, **options) -> Analysis:
    """Text already in a table: no prescreen unless asked for."""
    return Analysis(source_table(df, file_col, text_col), **options)


def scan(spark: SparkSession, path: str, *, prescreen: bool = True, decode: str = "strict", **options) -> Analysis:
    """A directory (or one `.py` file), read as the command line does.

    With `prescreen=False, decode="ignore"`: as an upload is read.
    """
    listing: list[str] = []
    sources = scan_sources(spark, path, decode, options.get("partitions"), listing)
    work = Analysis(sources, prescreen=prescreen, keep_sources=True, **options)
    for name in listing:
        session.unstage(spark, name)
    return work
