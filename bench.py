"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).  Every
query is run to completion into a sink that discards rows.  A pass over the
smallest tables first warms up the JVM and the Python workers; it is not
timed.  Staged relations (nodes, symbols, resolved, findings) are timed where
they are built, including their writes.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from checks import queries
from checks.corpus import corpus
from srcweave.operators import features, flow, report, tokens
from srcweave.plans.analysis import Analysis


def timed_queries(spark, sf_dir):
    """Yield (name, action); each action builds what later ones use."""
    work = Analysis(corpus(spark, sf_dir))

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    yield "text_severity_counts", lambda: drain(queries.flagship(spark, sf_dir))
    yield "tokenize_documents", lambda: drain(tokens.tokenize(queries.documents(spark, sf_dir)))
    yield "token_stats_documents", lambda: drain(tokens.token_stats(tokens.tokenize(queries.documents(spark, sf_dir))))
    yield "token_positions_pages", lambda: drain(tokens.with_position(queries.pages(spark, sf_dir)))
    yield "token_positions_corpus", lambda: drain(work.positioned_tokens)
    yield "prescreen_words_corpus", lambda: drain(tokens.prescreen_words(work.tokens))
    yield "shred_to_nodes", lambda: work.shredded
    yield "call_features", lambda: drain(features.call_features(work.nodes))
    yield "grammar_findings", lambda: drain(work.grammar_findings)
    yield "sql_findings", lambda: drain(work.sql_findings)
    yield "symbols", lambda: work.first_definitions
    yield "resolve_names", lambda: work.resolved
    yield "semantic_findings", lambda: drain(work.semantic_findings)
    yield "flow_findings", lambda: drain(flow.flow_findings(flow.complexity(work.nodes)))
    yield "all_findings", lambda: work.findings
    yield "sorted_report", lambda: drain(work.report())
    yield "severity_counts", lambda: drain(report.severity_counts(work.findings))
    yield "type_counts", lambda: drain(report.type_counts(work.findings))
    yield "annotated_lines", lambda: drain(work.annotated_lines())
    yield "semantic_summary", lambda: drain(work.summary())
    yield "release", work.release


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm):
        for _, action in timed_queries(spark, warm):
            action()
    seconds = {}
    for name, action in timed_queries(spark, sf_dir):
        started = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - started, 3)
    seconds.pop("release")
    files = corpus(spark, sf_dir).count()
    n_tokens = tokens.tokenize(queries.documents(spark, sf_dir)).count()
    end_to_end = ("shred_to_nodes", "symbols", "resolve_names", "all_findings")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "files": files,
                "tokens_per_sec_documents": round(n_tokens / seconds["tokenize_documents"], 1),
                "files_per_sec_source_to_findings": round(files / sum(seconds[q] for q in end_to_end), 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
