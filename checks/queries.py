"""One DataFrame query per operator, over the given tables or the corpus derived from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.corpus import corpus, table
from srcweave import session
from srcweave.functions import text, vocab
from srcweave.operators import features, findings, flow, report, rules, sql_lint, symbols, syntax, tokens
from srcweave.plans.analysis import Analysis
from srcweave.sources.tables import source_table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
_analyses: dict[tuple, Analysis] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(session.tune(spark), sf_dir)

        REGISTRY[name] = tuned
        return tuned

    return register


def analysis(spark: SparkSession, sf_dir: str, *, prescreen: bool = False) -> Analysis:
    """The analysis of the corpus, built once per session and table folder; those of other folders are dropped."""
    app = spark.sparkContext.applicationId
    key = (app, sf_dir, prescreen)
    if key not in _analyses:
        for other in [k for k in _analyses if k[:2] != key[:2]]:
            old = _analyses.pop(other)
            if other[0] == app:
                old.release()
        _analyses[key] = Analysis(corpus(spark, sf_dir), prescreen=prescreen)
    return _analyses[key]


def documents(spark, sf_dir):
    return source_table(table(spark, sf_dir, "documents"), "doc_id", "text")


def pages(spark, sf_dir):
    return source_table(table(spark, sf_dir, "pages"), "page_id", "html")


def talks(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return source_table(turns, F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")), "text")


def all_text(spark, sf_dir):
    def tagged(prefix, df):
        return df.withColumn("file", F.concat(F.lit(prefix), "file"))

    # customer names run into SQL words, so that every lint branch has texts to find
    clients = table(spark, sf_dir, "customer")
    run_on = source_table(clients, "c_custkey", F.concat(F.lit("insertinto"), F.col("c_name"), F.lit(" values")))
    return (
        tagged("d", documents(spark, sf_dir))
        .unionByName(tagged("k", run_on))
        .unionByName(tagged("p", pages(spark, sf_dir)))
        .unionByName(tagged("c", talks(spark, sf_dir)))
        .unionByName(corpus(spark, sf_dir))
    )


def joined(column, sep=","):
    return F.array_join(F.transform(column, lambda x: x.cast("string")), sep)


# -- sources and sinks -----------------------------------------------------------


@query("src2_decode_sources")
def _(spark, sf_dir):
    """Text as bytes, every third document with stray bytes put in; both decoding modes."""
    from srcweave.sources.tables import decode_sources

    docs = table(spark, sf_dir, "documents")
    stray = F.when(F.col("doc_id") % 3 == 0, F.unhex(F.lit("FFE282"))).otherwise(F.unhex(F.lit("")))
    encoded = docs.select(
        F.col("doc_id").cast("string").alias("file"), F.concat(stray, F.encode("text", "UTF-8"), stray).alias("content")
    )
    return (
        decode_sources(encoded, "ignore")
        .select("file", F.col("source").alias("ignored"))
        .join(decode_sources(encoded, "strict").select("file", F.col("source").alias("strict"), "error"), "file")
        .select("file", F.md5("ignored").alias("ignored_md5"), F.md5("strict").alias("strict_md5"),
                F.col("error").isNotNull().alias("failed"))
    )


@query("src3_error_rows")
def _(spark, sf_dir):
    """Documents that are not valid UTF-8 after damage, as findings without severity."""
    from srcweave.sources.tables import decode_sources

    docs = table(spark, sf_dir, "documents")
    damaged = F.when(F.col("doc_id") % 5 == 0, F.unhex(F.lit("80"))).otherwise(F.unhex(F.lit("")))
    content = F.concat(F.encode("text", "UTF-8"), damaged)
    read = decode_sources(docs.select(F.col("doc_id").cast("string").alias("file"), content.alias("content")))
    rows = findings.union_findings(findings.error_rows(read))
    return rows.select("file", "code", "severity", F.col("error").isNotNull().alias("has_error"))


@query("src4_source_table")
def _(spark, sf_dir):
    return corpus(spark, sf_dir).select("file", "source")


def _trace_text(t):
    """A trace as text: its pattern and of each step action, state and what is left of the input."""
    steps = F.transform(
        t["steps"],
        lambda s: F.concat_ws(":", s["action"], s["state"].cast("string"), F.array_join(s["input_remaining"], " ")),
    )
    return F.concat_ws("|", t["pattern"], t["vulnerability"], F.array_join(steps, "|"))


@query("e2_upload_documents")
def _(spark, sf_dir):
    """The answer to an upload of every source of the corpus, all its findings and traces as text."""

    def shown(f):
        texts = [f[n].cast("string") for n in ("lineno", "code", "severity", "message", "pattern", "phase", "error")]
        lists = [joined(f["tokens"], " "), joined(f["parse_stack"])]
        return F.concat_ws("|", *[F.coalesce(x, F.lit("-")) for x in texts + lists])

    answers = analysis(spark, sf_dir).upload_documents()
    traces = F.transform("parse_traces", lambda t: F.concat_ws("|", t["filename"], _trace_text(t)))
    return answers.select(
        "filename", F.md5("content").alias("content_md5"), F.array_join(F.transform("findings", shown), ";").alias("findings"),
        joined(traces, ";").alias("traces"), "error",
    )


@query("snk1_findings_json")
def _(spark, sf_dir):
    """Per-file JSON documents written out and read back."""
    import uuid

    from srcweave.sources.sinks import write_findings_json

    path = f"{session.scratch_dir(spark)}/findings_json_{uuid.uuid4().hex}"
    write_findings_json(analysis(spark, sf_dir).findings, path, per_file=True, compression="gzip")
    from srcweave.operators.rules import TRACE_TYPE

    fields = "lineno:int,code:string,severity:string,message:string,pattern:string,tokens:array<string>,parse_stack:array<int>"
    schema = f"filename string, findings array<struct<{fields},parse_trace:{TRACE_TYPE}>>"
    read = spark.read.schema(schema).json(path)
    plain = F.transform(
        "findings",
        lambda f: F.when(f["code"] == "SYNTAX_ERROR", F.substring_index(f["message"], ": ", 1)).otherwise(f["message"]),
    )
    rules_only = F.filter("findings", lambda f: f["parse_trace"].isNotNull())
    return read.select(
        "filename",
        joined(plain, ";").alias("messages"),
        joined(F.col("findings.severity")).alias("severities"),
        joined(F.transform(rules_only, lambda f: F.array_join(f["tokens"], " ")), ";").alias("tokens"),
        joined(F.transform(rules_only, lambda f: F.array_join(F.transform(f["parse_stack"], lambda x: x.cast("string")), ",")), ";").alias("stacks"),
        joined(F.transform(rules_only, lambda f: _trace_text(f["parse_trace"])), ";").alias("traces"),
        F.size("findings").alias("n"),
        joined(F.col("findings.code")).alias("codes"),
        joined(F.col("findings.lineno")).alias("lines"),
        joined(F.filter("findings.pattern", lambda p: p.isNotNull()), ";").alias("patterns"),
    )


# -- tokens ------------------------------------------------------------------


@query("tok1_tokenize")
def _(spark, sf_dir):
    return tokens.tokenize(documents(spark, sf_dir))


def _token_kinds(name, source, *kinds):
    @query(name)
    def _(spark, sf_dir):
        return tokens.tokenize(source(spark, sf_dir)).filter(F.col("type").isin(*kinds))


_token_kinds("tok2_comments", pages, "COMMENT")
_token_kinds("tok3_strings", pages, "STRING")
_token_kinds("tok4_numbers", pages, "NUMBER")
_token_kinds("tok5_words", talks, "KEYWORD", "IDENTIFIER")
_token_kinds("tok6_operators", pages, "ERROR", *vocab.OPERATORS.values())
_token_kinds("tok7_line_ends", documents, "NEWLINE", "EOF")


@query("tok8_positions")
def _(spark, sf_dir):
    return tokens.with_position(pages(spark, sf_dir))


@query("tok8_positions_corpus")
def _(spark, sf_dir):
    return tokens.with_position(corpus(spark, sf_dir))


@query("tok9_filter_tokens")
def _(spark, sf_dir):
    return tokens.filter_tokens(tokens.tokenize(pages(spark, sf_dir)))


@query("tok10_token_stats")
def _(spark, sf_dir):
    return tokens.token_stats(tokens.tokenize(documents(spark, sf_dir)))


@query("tok11_prescreen_hits")
def _(spark, sf_dir):
    return tokens.prescreen_hits(tokens.tokenize(all_text(spark, sf_dir)))


@query("tok11_prescreen_words")
def _(spark, sf_dir):
    hits = tokens.prescreen_words(tokens.tokenize(corpus(spark, sf_dir)))
    return hits.select("file", joined(F.col("suspicious_words"), " ").alias("words"), "suspicious_tokens")


@query("tok12_prescreen_gate")
def _(spark, sf_dir):
    a = analysis(spark, sf_dir)
    kept = a.gate(a.nodes).select("file", F.lit("kept").alias("gate"))
    skipped = a.gate(a.nodes, kept=False).select("file", F.lit("skipped").alias("gate"))
    return kept.unionByName(skipped).groupBy("file", "gate").agg(F.count(F.lit(1)).alias("n_nodes"))


@query("tok12_gated_findings")
def _(spark, sf_dir):
    return analysis(spark, sf_dir, prescreen=True).findings.select("file", "lineno", "code", "severity", "prod")


# -- syntax --------------------------------------------------------------------


@query("ast1_shred")
def _(spark, sf_dir):
    nodes = analysis(spark, sf_dir).nodes
    return nodes.withColumn("scopes", joined(symbols.scope_chain(F.col("path")))).drop("path")


@query("ast2_syntax_errors")
def _(spark, sf_dir):
    failures = analysis(spark, sf_dir).parse_failures
    stats = findings.syntax_error_stats(failures).select("file", "line", F.col("error").isNotNull().alias("has_error"))
    return findings.syntax_errors(failures).join(stats, "file").select(
        "file", "lineno", "code", "severity", "phase", "line", "has_error"
    )


@query("ast3_node_histogram")
def _(spark, sf_dir):
    return syntax.node_histogram(analysis(spark, sf_dir).nodes)


@query("ast3_node_type_map")
def _(spark, sf_dir):
    counts = syntax.node_type_map(analysis(spark, sf_dir).nodes)
    entries = F.transform(F.map_entries("node_types"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))
    return counts.select("file", F.array_join(F.sort_array(entries), ",").alias("node_types"))


@query("ast4_top_node_types")
def _(spark, sf_dir):
    return syntax.top_node_types(analysis(spark, sf_dir).nodes, 10)


@query("ast5_syntax_stats")
def _(spark, sf_dir):
    return syntax.syntax_stats(analysis(spark, sf_dir).nodes)


@query("ast6_imports")
def _(spark, sf_dir):
    return syntax.imports(analysis(spark, sf_dir).nodes)


@query("ast7_string_literals")
def _(spark, sf_dir):
    return syntax.string_literals(analysis(spark, sf_dir).nodes)


@query("ast8_calls")
def _(spark, sf_dir):
    return syntax.calls(analysis(spark, sf_dir).nodes)


@query("ast9_call_args")
def _(spark, sf_dir):
    return syntax.call_args(analysis(spark, sf_dir).nodes).select(
        "file", "call_ord", "ord", "arg_kind", "arg_idx", "node_type", "name"
    )


# -- features --------------------------------------------------------------------

FEATURE_KEYS = {
    f"f{i}_{name}": name for i, name in enumerate(features.CALL_FEATURES, start=1)
}  # f1_has_concat … f15_no_verify


def _call_feature(key, feature):
    @query(key)
    def _(spark, sf_dir):
        found = features.call_features(analysis(spark, sf_dir).nodes)
        return found.filter(F.col(feature)).select("file", "ord", "lineno")


for _key, _feature in FEATURE_KEYS.items():
    _call_feature(_key, _feature)


@query("f16_secret_pattern")
def _(spark, sf_dir):
    flagged = all_text(spark, sf_dir).select("file", text.secret_pattern(F.col("source")).alias("secret_pattern"))
    return flagged.filter("secret_pattern")


@query("f17_aws_key")
def _(spark, sf_dir):
    words = all_text(spark, sf_dir).select("file", F.posexplode(F.split("source", "[ \n\"]")).alias("i", "word"))
    return words.filter(text.aws_key(F.col("word"))).select("file", "i", "word")


@query("f18_long_token")
def _(spark, sf_dir):
    words = all_text(spark, sf_dir).select("file", F.posexplode(F.split("source", "[ \n\"]")).alias("i", "word"))
    return words.filter(text.long_token(F.col("word"))).select("file", "i", "word")


@query("f16_f18_assign_features")
def _(spark, sf_dir):
    return features.assign_features(analysis(spark, sf_dir).nodes)


@query("f19_sql_left")
def _(spark, sf_dir):
    return features.binop_features(analysis(spark, sf_dir).nodes).select("file", "ord", "lineno", "sql_left")


@query("f20_input_right")
def _(spark, sf_dir):
    return features.binop_features(analysis(spark, sf_dir).nodes).select("file", "ord", "lineno", "input_right")


# -- rules -----------------------------------------------------------------------


def _symbols_of(key, kind):
    @query(key)
    def _(spark, sf_dir):
        found = analysis(spark, sf_dir).site_symbols.filter(F.col("node_type") == kind)
        return found.select("file", "lineno", joined(F.col("symbols"), " ").alias("symbols"))


_symbols_of("r1_call_symbols", "Call")
_symbols_of("r2_assign_symbols", "Assign")
_symbols_of("r3_binop_symbols", "BinOp")


@query("r4_match_rules")
def _(spark, sf_dir):
    matches = analysis(spark, sf_dir).matches
    return matches.select("file", "lineno", "sequence", "prod",
                          rules.is_fallback(F.col("symbols"), F.col("rhs")).alias("fallback"))


@query("r5_grammar_findings")
def _(spark, sf_dir):
    return analysis(spark, sf_dir).grammar_findings.select(
        "file", "lineno", "code", "message", "severity", "pattern",
        joined(F.col("tokens"), " ").alias("tokens"), joined(F.col("parse_stack")).alias("parse_stack"), "prod",
    )


@query("r6_explain_match")
def _(spark, sf_dir):
    """Every field of every step; a missing one is a dash."""

    def shown(s):
        lists = {"stack_before": ",", "symbols_before": " ", "input_remaining": " ", "stack_after": ",", "symbols_after": " "}
        fields = ("step", "action", "state", "lookahead", "next_state", "production", "production_num", "stack_before",
                  "symbols_before", "input_remaining", "goto_state", "stack_after", "symbols_after")
        return F.concat_ws("|", *[
            F.coalesce(joined(s[f], lists[f]) if f in lists else s[f].cast("string"), F.lit("-")) for f in fields
        ])

    return analysis(spark, sf_dir).traces.select(
        "file", "lineno", joined(F.col("tokens"), " ").alias("tokens"), "vulnerability", "pattern", "severity", "message",
        F.array_join(F.transform("steps", shown), ";").alias("steps"),
    )


EXTRA_TYPOS = {"THE": "AN", "DER": "DIE", "FORM": "FORMAT"}
EXTRA_RULE = ("assign", 100, ["ASSIGN", "ANY"], "WARNING", "String constant")


@query("r7_custom_typos")
def _(spark, sf_dir):
    extra = spark.createDataFrame(list(EXTRA_TYPOS.items()), "word string, fix string")
    return sql_lint.sql_lint(documents(spark, sf_dir), "source", extra)


@query("r7_custom_rules")
def _(spark, sf_dir):
    extra = spark.createDataFrame(
        [EXTRA_RULE], "sequence string, prod int, rhs array<string>, severity string, message string"
    )
    matches = rules.match_rules(analysis(spark, sf_dir).site_symbols, extra)
    return rules.grammar_findings(matches).select("file", "lineno", "pattern", "severity", "message", "prod")


# -- SQL lint ----------------------------------------------------------------------


@query("s0_looks_like_sql")
def _(spark, sf_dir):
    return all_text(spark, sf_dir).select("file", text.looks_like_sql(F.col("source")).alias("looks_like_sql"))


@query("s1_sql_words")
def _(spark, sf_dir):
    words = sql_lint.sql_words(F.col("source"))
    return talks(spark, sf_dir).select("file", F.posexplode(words).alias("word_idx", "word"))


def _lint(key, *needles):
    """Lint rows over every text column whose message holds one of the needles."""

    @query(key)
    def _(spark, sf_dir):
        found = sql_lint.sql_lint(all_text(spark, sf_dir), "source")
        return found.filter(text.contains_any(F.col("message"), list(needles)))


LINT_KEYS = {
    "s2_keyword_typos": ["' should be '"],
    "s3_select_run_on": ["(should be 'SELECT FROM'"],
    "s4_insert_run_on": ["(should be 'INSERT INTO'"],
    "s5_delete_run_on": ["(should be 'DELETE FROM'"],
    "s6_order_run_on": ["(should be 'ORDER BY'"],
    "s7_group_run_on": ["(should be 'GROUP BY'"],
}
for _key, _needles in LINT_KEYS.items():
    _lint(_key, *_needles)


@query("s_sql_findings")
def _(spark, sf_dir):
    found = analysis(spark, sf_dir).sql_findings
    return found.select("file", "lineno", "code", "message", "severity", F.col("emit_key.sub").alias("word_idx"))


# -- symbols -------------------------------------------------------------------------


@query("y1_scopes")
def _(spark, sf_dir):
    return symbols.scopes(analysis(spark, sf_dir).nodes).withColumn("chain", joined(F.col("chain")))


@query("y2_definitions")
def _(spark, sf_dir):
    return symbols.definitions(analysis(spark, sf_dir).nodes)


@query("y2_definitions_with_builtins")
def _(spark, sf_dir):
    return symbols.definitions(analysis(spark, sf_dir).nodes, built_ins=True)


@query("y3_symbol_table")
def _(spark, sf_dir):
    every = analysis(spark, sf_dir).symbol_table()
    return every.withColumns({c: joined(F.col(c)) for c in ("assignments", "usages")})


@query("y4_assignment_history")
def _(spark, sf_dir):
    history = symbols.assignment_history(symbols.definitions(analysis(spark, sf_dir).nodes))
    return history.withColumn("assignments", joined(F.col("assignments")))


@query("y5_name_uses")
def _(spark, sf_dir):
    return symbols.name_uses(analysis(spark, sf_dir).nodes).withColumn("chain", joined(F.col("chain")))


@query("y6_resolve")
def _(spark, sf_dir):
    return analysis(spark, sf_dir).resolved


@query("y7_undefined")
def _(spark, sf_dir):
    found = symbols.undefined_variables(analysis(spark, sf_dir).resolved)
    return found.select("file", "lineno", "code", "message", "severity")


@query("y8_usages")
def _(spark, sf_dir):
    return symbols.usages(analysis(spark, sf_dir).resolved).withColumn("usages", joined(F.col("usages")))


def _duplicates(key, code):
    @query(key)
    def _(spark, sf_dir):
        found = symbols.duplicates(analysis(spark, sf_dir).define_events)
        return found.filter(F.col("code") == code).select("file", "lineno", "code", "message", "severity")


_duplicates("y9_duplicate_imports", "DUPLICATE_IMPORT")
_duplicates("y10_duplicate_functions", "DUPLICATE_FUNCTION")
_duplicates("y11_duplicate_classes", "DUPLICATE_CLASS")


@query("y12_unused_parameters")
def _(spark, sf_dir):
    a = analysis(spark, sf_dir)
    found = symbols.unused_parameters(a.nodes, a.first_definitions, a.resolved)
    return found.select("file", "lineno", "code", "message", "severity")


@query("y13_unused_variables")
def _(spark, sf_dir):
    a = analysis(spark, sf_dir)
    return symbols.unused_variables(a.nodes, a.first_definitions, a.resolved)


@query("y14_inferred_types")
def _(spark, sf_dir):
    return symbols.inferred_types(analysis(spark, sf_dir).nodes)


LABELS = ["int", "float", "numeric", "str", "list", ""]


def _type_pairs(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    labels = F.array(*[F.lit(x) for x in LABELS])
    return lines.select(
        F.col("l_orderkey").cast("string").alias("file"),
        F.col("l_linenumber").alias("lineno"),
        F.get(labels, (F.col("l_partkey") % len(LABELS)).cast("int")).alias("expected"),
        F.get(labels, (F.col("l_suppkey") % len(LABELS)).cast("int")).alias("actual"),
        F.col("l_returnflag").alias("context"),
    )


@query("y15_type_compatible")
def _(spark, sf_dir):
    pairs = _type_pairs(spark, sf_dir)
    return pairs.withColumn("compatible", text.type_compatible(F.col("expected"), F.col("actual")))


@query("y16_type_mismatches")
def _(spark, sf_dir):
    return symbols.type_mismatches(_type_pairs(spark, sf_dir))


# -- flow ----------------------------------------------------------------------------


@query("c1_complexity")
def _(spark, sf_dir):
    return flow.complexity(analysis(spark, sf_dir).nodes).select("file", "name", "lineno", "complexity")


@query("c2_high_complexity")
def _(spark, sf_dir):
    found = flow.high_complexity(flow.complexity(analysis(spark, sf_dir).nodes))
    return found.select("file", "lineno", "code", "message", "severity")


@query("c3_has_return")
def _(spark, sf_dir):
    return flow.complexity(analysis(spark, sf_dir).nodes).select("file", "name", "lineno", "has_return")


@query("c4_missing_returns")
def _(spark, sf_dir):
    found = flow.missing_returns(flow.complexity(analysis(spark, sf_dir).nodes))
    return found.select("file", "lineno", "code", "message", "severity")


# -- reports ---------------------------------------------------------------------------


@query("p1_findings")
def _(spark, sf_dir):
    return _flat(analysis(spark, sf_dir).findings)


def _plain_errors(df):
    # SYNTAX_ERROR texts depend on the Python version; only their stem is compared
    stem = F.substring_index("message", ": ", 1)
    return df.withColumn("message", F.when(F.col("code") == "SYNTAX_ERROR", stem).otherwise(F.col("message")))


def _flat(df):
    return _plain_errors(df).select(
        "file", "lineno", "code", "message", "severity", "pattern",
        joined(F.col("tokens"), " ").alias("tokens"), joined(F.col("parse_stack")).alias("parse_stack"),
        "prod", "phase", "error",
    )


@query("p2_sorted_report")
def _(spark, sf_dir):
    """The report with the position of each finding in the order of the whole corpus."""
    ordered = analysis(spark, sf_dir).numbered_report()
    return ordered.select("position", "file", "lineno", "code", "severity", "prod")


@query("p3_severity_counts")
def _(spark, sf_dir):
    return report.severity_counts(analysis(spark, sf_dir).findings)


@query("p4_type_counts")
def _(spark, sf_dir):
    return report.type_counts(analysis(spark, sf_dir).findings)


@query("p4_distinct_types")
def _(spark, sf_dir):
    return report.distinct_types(analysis(spark, sf_dir).findings)


@query("p5_filter_findings")
def _(spark, sf_dir):
    wanted = report.filter_findings(
        analysis(spark, sf_dir).findings, ["UNUSED_PARAMETER", "PATH_OP -> DOTDOT", "SQL_SYNTAX_ERROR"], ["WARNING"]
    )
    return wanted.select("file", "lineno", "code", "severity")


@query("p6_findings_by_line")
def _(spark, sf_dir):
    lines = report.findings_by_line(_plain_errors(analysis(spark, sf_dir).findings))
    return lines.select(
        "file", "lineno", "n", "worst", joined(F.col("types"), ";").alias("types"),
        joined(F.col("badges"), ";").alias("badges"), "tooltip",
    )


@query("p6_first_flagged_line")
def _(spark, sf_dir):
    return report.first_flagged_line(analysis(spark, sf_dir).findings)


@query("p7_annotate_lines")
def _(spark, sf_dir):
    lines = analysis(spark, sf_dir).annotated_lines()
    return lines.select("file", "lineno", "text", "n", "worst", joined(F.col("types"), ";").alias("types"))


@query("p8_semantic_summary")
def _(spark, sf_dir):
    return analysis(spark, sf_dir).summary()


@query("p9_phase_report")
def _(spark, sf_dir):
    """All fields of all four phases."""
    nested = analysis(spark, sf_dir, prescreen=True).phase_report()
    phases = {
        "phase1_lexical_analysis": "lex", "phase2_syntax_analysis": "syn", "phase3_semantic_analysis": "sem",
        "phase4_grammar_analysis": "rule",
    }
    fields = [
        F.col(f"{phase}.{field.name}").alias(f"{short}_{field.name}")
        for phase, short in phases.items()
        for field in nested.schema[phase].dataType.fields
    ]
    entries = F.transform(F.map_entries("syn_node_types"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))
    return nested.select("filename", *fields).withColumn("syn_node_types", F.array_join(F.sort_array(entries), ","))


@query("p10_report_lines")
def _(spark, sf_dir):
    return report.report_lines(_plain_errors(analysis(spark, sf_dir).findings))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity counts per file over SQL lint and secrets of all document text."""
    from srcweave.streaming.scan import text_findings

    return report.severity_counts(text_findings(documents(session.tune(spark), sf_dir)))


REGISTRY["p3_text_severity_counts"] = flagship


# -- files and streams -------------------------------------------------------------


def _scratch(spark, label):
    import uuid

    return f"{session.scratch_dir(spark)}/{label}_{uuid.uuid4().hex}"


# Files a scanned folder holds at a time: a small file takes a whole block of disk, and one that is gone again
# within half a minute mostly never reaches it.
FOLDER_FILES = 200_000


def _save_batches(folder, *, remove=False):
    """Write (file, source) rows as files below a folder, a path or an URI, inside tasks; or remove the same files."""

    def save(batches):
        import os

        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(folder) if "://" in folder else (None, folder)

        def write(path, content):
            if system is None:
                with open(path, "wb", buffering=0) as out:
                    out.write(content)
            else:
                with system.open_output_stream(path) as out:
                    out.write(content)

        def delete(path):  # what a task run again finds gone already is fine
            if system is None:
                try:
                    os.unlink(path)
                except FileNotFoundError:
                    pass
            elif system.get_file_info(path).type != fs.FileType.NotFound:
                system.delete_file(path)

        made = set()
        for batch in batches:
            for file, source in zip(batch["file"].to_pylist(), batch["source"].to_pylist()):
                path = os.path.join(inner, file)
                if remove:
                    delete(path)
                    continue
                above = os.path.dirname(path)
                if above not in made:
                    os.makedirs(above, exist_ok=True) if system is None else system.create_dir(above)
                    made.add(above)
                write(path, source.encode("utf-8"))
            yield batch.select(["file"])

    return save


def _corpus_folders(spark, sf_dir, folder):
    """The corpus as `.py` files in nested folders below `folder`, some hidden or underscored, a part at a time.

    Yields when the files of a part are there and removes them before the next:
    small files take many times their text on disk, so all at once would not fit.
    """
    k = F.regexp_extract("file", r"(\d+)", 1).cast("long")
    place = F.when(k % 3 == 0, F.concat(F.lit("a/.hidden/d"), (k % 7).cast("string"), F.lit("/__init__"), k)).otherwise(
        F.concat(F.lit("a/"), k)
    )
    texts = corpus(spark, sf_dir)
    parts = max(1, -(-texts.count() // FOLDER_FILES))
    part = F.pmod(F.xxhash64("file"), F.lit(parts))
    named = texts.select(F.concat(place, F.lit(".py")).alias("file"), "source", part.alias("part"))
    held = _scratch(spark, "parts")  # the texts by part, so that each part reads its own alone
    named.repartition(parts, "part").write.partitionBy("part").parquet(held)
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for i in range(parts):
        if not system.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{held}/part={i}")):  # no name fell into it
            continue
        rows = spark.read.schema("file string, source string").parquet(f"{held}/part={i}")
        spread = rows.repartition(spark.sparkContext.defaultParallelism)
        spread.mapInArrow(_save_batches(folder), "file string").agg(F.count(F.lit(1))).collect()
        yield i
        spread.mapInArrow(_save_batches(folder, remove=True), "file string").agg(F.count(F.lit(1))).collect()
        system.delete(root, True)  # empty directories
    system.delete(spark._jvm.org.apache.hadoop.fs.Path(held), True)


@query("src1_scan_sources")
def _(spark, sf_dir):
    from srcweave.sources.files import scan_sources

    folder, out = _scratch(spark, "files"), _scratch(spark, "scanned")
    for part in _corpus_folders(spark, sf_dir, folder):
        listing: list[str] = []
        files = scan_sources(spark, folder, staged=listing)
        named = files.select(
            F.expr(f"substring(file, {len(folder) + 2})").alias("file"), F.md5("source").alias("md5"), "error"
        )
        named.write.parquet(f"{out}/part={part}")
        for name in listing:
            session.unstage(spark, name)
    return spark.read.parquet(out).select("file", "md5", "error")


@query("src5_stream_sources")
def _(spark, sf_dir):
    """Files that arrive in one folder part by part, each taken by a run of the same stream before it goes."""
    from srcweave.sources.arrivals import stream_files

    folder, out = _scratch(spark, "files"), _scratch(spark, "streamed")

    def save(sources, batch_id):
        named = sources.select(
            F.expr(f"substring(file, {len(folder) + 2})").alias("file"), F.md5("source").alias("md5"), "error"
        )
        named.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    for _part in _corpus_folders(spark, sf_dir, folder):
        stream_files(spark, folder, save, out + "_progress", settle=0).awaitTermination()
    return spark.read.parquet(out).select("file", "md5", "error")


# Text in one file of a feed: micro-batches of so many files are as large whatever the corpus holds.
FEED_BYTES = 64 << 20


@query("st1_stream_scan")
def _(spark, sf_dir):
    """The corpus as a stream of files in several micro-batches; same findings as the batch."""
    from srcweave.streaming.scan import parquet_sink, stream_scan

    feed, out = _scratch(spark, "feed"), _scratch(spark, "found")
    texts = corpus(spark, sf_dir)
    size = texts.agg(F.sum(F.octet_length("source"))).first()[0] or 0
    texts.repartition(max(6, -(-size // FEED_BYTES))).write.parquet(feed)
    stream = spark.readStream.schema("file string, source string").option("maxFilesPerTrigger", 3).parquet(feed)
    stream_scan(stream, parquet_sink(out), out + "_progress").awaitTermination()
    return _flat(spark.read.parquet(out))


@query("st2_stream_counts")
def _(spark, sf_dir):
    from srcweave.streaming.scan import stream_counts

    schema = table(spark, sf_dir, "documents").schema
    out = _scratch(spark, "counts")
    # a pattern that names one path alone: the table may be one file or a folder of them
    docs = spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parque[t]")
    stream_counts(source_table(docs, "doc_id", "text"), out, out + "_progress").awaitTermination()
    return spark.read.parquet(out)
