"""Rule matching: symbol sequences joined to a small table of accepted ones."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from srcweave.functions import vocab
from srcweave.operators.features import sites
from srcweave.session import broadcast_if_small

RULE_SCHEMA = (
    "sequence string, prod int, rhs array<string>, severity string, message string, states array<int>"
)


def rule_table(spark: SparkSession, extra: DataFrame | None = None) -> DataFrame:
    """Accepted sequences with their rule; `extra` rows (same columns, `states`
    optional) add rules or replace the rule of a sequence."""
    productions = {n: (rhs.split(), severity, message) for n, rhs, severity, message in vocab.PRODUCTIONS}
    rows = [(seq, prod, *productions[prod], states) for seq, prod, states in vocab.ACCEPTED]
    names = ("sequence", "prod", "rhs", "severity", "message", "states")
    # from Arrow it is a local relation, which is broadcast without a job
    columns = {name: pa.array(column) for name, column in zip(names, zip(*rows, strict=True), strict=True)}
    built_in = spark.createDataFrame(pa.table(columns), RULE_SCHEMA)
    if extra is None:
        return F.broadcast(built_in)
    wanted = extra.select(
        "sequence", "prod", "rhs", "severity", "message",
        # states of a rule's own are numbered on from its symbols; the built-in tables hold none for it
        F.coalesce(F.col("states") if "states" in extra.columns else F.lit(None).cast("array<int>"),
                   F.sequence(F.lit(1), F.size(F.split("sequence", " ")))).alias("states"),
    )
    kept = built_in.join(wanted.select("sequence"), "sequence", "left_anti")
    return broadcast_if_small(kept.unionByName(wanted))


def symbols() -> Column:
    """The symbol sequence of a site row, as an array; null when it has none."""
    flag = F.col

    def first(*pairs):
        chain = F.when(flag(pairs[0][0]), F.array(F.lit(pairs[0][1])))
        for name, symbol in pairs[1:]:
            chain = chain.when(flag(name), F.array(F.lit(symbol)))
        return chain.otherwise(F.array().cast("array<string>"))

    head = F.col("head")
    both = F.array_compact(
        F.array(
            F.when(flag("shell_true"), F.lit("shell_true")),
            F.when(flag("has_concat"), F.lit("concat")),
        )
    )
    modifiers = (
        F.when(
            head.isin("execute", "executemany"),
            first(("has_concat", "concat"), ("has_format", "format"), ("has_fstring", "fstring")),
        )
        .when(head == "exec", first(("has_b64decode", "b64decode"), ("is_dynamic", "dynamic")))
        .when(head == "eval", first(("has_user_input", "user_input")))
        .when(head == "subprocess", both)
        .when(head == "os.system", first(("has_format", "format")))
        .when(head == "pickle.load", first(("untrusted_source", "untrusted"), ("has_user_input", "user_input")))
        .when(
            head.isin("open", "Path"),
            first(("has_concat", "concat"), ("has_user_input", "user_input"), ("has_dotdot", "dotdot")),
        )
        .when(head == "hashlib", first(("weak_algo", "weak_algo")))
        .when(head == "random", F.array(F.lit("token_gen")))  # every such name is token_gen
        .when(head == "requests", first(("verify_false", "verify_false")))
        .when(head == "urllib", first(("no_verify", "no_verify")))
    )
    secret = first(("secret_pattern", "secret_pattern"), ("aws_key", "aws_key"), ("long_token", "long_token"))
    return (
        F.when(head.isNotNull(), F.concat(F.array(head), modifiers))
        .when(flag("assigns_string"), F.concat(F.array(F.lit("assign")), secret))
        .when(
            flag("sql_left") & flag("input_right"),
            F.array(*[F.lit(s) for s in ("sql_var", "concat_op", "user_input")]),
        )
    )


def site_symbols(nodes: DataFrame) -> DataFrame:
    """symbols(file, ord, lineno, node_type, symbols) of sites that have any."""
    found = sites(nodes).select("file", "ord", "lineno", "node_type", symbols().alias("symbols"))
    return found.filter(F.col("symbols").isNotNull())


def match_rules(site_symbols: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """Sequences that are accepted, with their rule (inner join on the sequence)."""
    rules = rule_table(site_symbols.sparkSession, extra)
    keyed = site_symbols.withColumn("sequence", F.array_join("symbols", " "))
    return keyed.join(rules, "sequence").select(
        "file", "ord", "lineno", "symbols", "sequence", "prod", "rhs", "severity", "message", "states"
    )


def is_fallback(symbols: Column, rhs: Column) -> Column:
    """A bare head accepted by default: fewer symbols than the rule asks for."""
    return F.size(symbols) < F.size(rhs)


def grammar_findings(matches: DataFrame) -> DataFrame:
    full = F.array(F.lit(0), F.lit(200))
    return matches.select(
        "file",
        "lineno",
        F.lit("GRAMMAR_VULN").alias("code"),
        F.concat(F.lit("Grammar-based detection: "), "message").alias("message"),
        "severity",
        F.array_join("rhs", " -> ").alias("pattern"),
        F.col("symbols").alias("tokens"),
        F.when(is_fallback(F.col("symbols"), F.col("rhs")), F.array().cast("array<int>"))
        .otherwise(full)
        .alias("parse_stack"),
        "prod",
        emit_key(F.col("ord")).alias("emit_key"),
    )


def emit_key(pos: Column, is_exit: int = 0, neg_depth: Column | None = None, sub: Column | None = None) -> Column:
    """Sort key reproducing the order in which one file's findings arise."""
    return F.struct(
        pos.cast("int").alias("pos"),
        F.lit(is_exit).alias("is_exit"),
        (F.lit(0) if neg_depth is None else neg_depth).cast("int").alias("neg_depth"),
        (F.lit(0) if sub is None else sub).cast("int").alias("sub"),
    )


STEP_TYPE = (
    "struct<step:int,action:string,state:int,lookahead:string,next_state:int,production:string,"
    "production_num:int,stack_before:array<int>,symbols_before:array<string>,"
    "input_remaining:array<string>,goto_state:int,stack_after:array<int>,symbols_after:array<string>>"
)


TRACE_TYPE = (
    "struct<filename:string,lineno:int,tokens:array<string>,steps:array<" + STEP_TYPE + ">,"
    "vulnerability:string,pattern:string,severity:string,message:string>"
)


def steps(symbols: Column, states: Column, rhs: Column, prod: Column) -> Column:
    """Ordered trace of a match: one SHIFT per symbol, then one REDUCE.

    A function of the sequence alone, written as array expressions over the
    states stored with the rule.
    """
    stack = F.concat(F.array(F.lit(0)), states)
    n = F.size(symbols)
    none = F.lit(None)

    def step(**fields):
        order = [part.split(":")[0] for part in STEP_TYPE[len("struct<") : -1].split(",")]
        return F.struct(*[fields.get(name, none).alias(name) for name in order]).cast(STEP_TYPE)

    rest = F.concat(symbols, F.array(F.lit("$")))
    shifts = F.transform(
        symbols,
        lambda symbol, i: step(
            step=i + 1,
            action=F.lit("SHIFT"),
            state=F.get(stack, i),
            lookahead=symbol,
            next_state=F.get(states, i),
            stack_before=F.slice(stack, 1, i + 1),
            symbols_before=F.slice(symbols, 1, i),
            input_remaining=F.slice(rest, i + 1, F.size(rest)),
        ),
    )
    full = ~is_fallback(symbols, rhs)
    reduced = step(
        step=n + 1,
        action=F.lit("REDUCE"),
        state=F.get(stack, n),
        production=F.concat(F.lit("VULN -> "), F.array_join(rhs, " ")),
        production_num=prod,
        stack_before=stack,
        symbols_before=symbols,
        input_remaining=F.array(F.lit("$")),
        goto_state=F.when(full, 200),
        stack_after=F.when(full, F.array(F.lit(0), F.lit(200))).otherwise(F.array().cast("array<int>")),
        symbols_after=F.when(full, F.array(F.lit("VULN"))).otherwise(F.array().cast("array<string>")),
    )
    return F.concat(shifts, F.array(reduced))


def explain_match(matches: DataFrame) -> DataFrame:
    """traces(file, lineno, ord, tokens, vulnerability, pattern, severity, message, steps) of rule matches."""
    symbols, states, rhs = F.col("symbols"), F.col("states"), F.col("rhs")
    return matches.filter(states.isNotNull()).select(
        "file",
        "lineno",
        "ord",
        F.col("symbols").alias("tokens"),
        F.lit("VULN").alias("vulnerability"),
        F.array_join(rhs, " -> ").alias("pattern"),
        "severity",
        "message",
        steps(symbols, states, rhs, F.col("prod")).alias("steps"),
    )


def with_traces(findings: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """Findings with `parse_trace`: the trace of a rule finding, null for others.

    Worked out from the tokens and the small rule table where a report asks
    for it, so that staged findings stay narrow.
    """
    rules = rule_table(findings.sparkSession, extra).select(
        F.col("sequence").alias("_sequence"), F.col("rhs").alias("_rhs"), F.col("states").alias("_states"),
        F.col("message").alias("_message"),
    )
    sequence = F.when(F.col("prod").isNotNull(), F.array_join("tokens", " "))
    trace = F.struct(
        F.col("file").alias("filename"), "lineno", "tokens",
        steps(F.col("tokens"), F.col("_states"), F.col("_rhs"), F.col("prod")).alias("steps"),
        F.lit("VULN").alias("vulnerability"), F.array_join("_rhs", " -> ").alias("pattern"), "severity",
        F.col("_message").alias("message"),
    ).cast(TRACE_TYPE)
    joined = findings.join(rules, sequence == F.col("_sequence"), "left")
    return joined.withColumn("parse_trace", F.when(F.col("_states").isNotNull(), trace)).drop(
        "_sequence", "_rhs", "_states", "_message"
    )
