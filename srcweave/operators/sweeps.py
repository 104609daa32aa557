"""All findings of a node table in three scans of it.

Each sweep reads the nodes once, unfolds every node into the events it is part
of, and takes these through one chain of aggregates and windows per file; what
an event does not need passes through untouched.  The layout by `file` serves
all of them, so nothing is moved.  The single checks in `rules`, `symbols`,
`flow` and `sql_lint` give the same rows one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from srcweave.functions import vocab
from srcweave.operators import features, flow, rules, sql_lint, symbols
from srcweave.operators.findings import FINDING_FIELDS
from srcweave.operators.rules import emit_key

_PACK = 1 << 32


def finding(applies: Column, **columns: Column) -> Column:
    """A finding as a struct, its missing fields null; null where it does not apply."""
    fields = [
        columns.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in FINDING_FIELDS.items() if name != "file"
    ]
    return F.when(applies, F.struct(*fields))


def _unfolded(rows: DataFrame, *found: Column) -> DataFrame:
    """The findings of each row. Outer, as Spark else infers a filter from the whole expression, and plans for minutes."""
    return rows.select("file", F.inline_outer(F.array_compact(F.array(*found)))).filter("code is not null")


def site_and_flow_findings(nodes: DataFrame, extra_rules: DataFrame | None = None) -> DataFrame:
    """Rule matches, missing returns and complexity.

    One aggregate by (file, site, owner) serves calls, assignments and
    additions (no owner) as well as functions, branches and returns; matched
    sites then pass the windows over owners as rows of none.
    """
    roles = features.site_roles() | flow.flow_roles()
    routed = features.routed(nodes, roles).withColumn("owner", flow.flow_owner()).withColumn("bits", features.flag_bits())
    grouped = routed.groupBy("file", "site", "owner").agg(*features.site_flags(), *flow.flow_counts())
    known = features.named_sites(grouped.filter("site_kind is not null or what is not null"))
    sequence = F.array_join(rules.symbols(), " ")
    spoken = known.withColumn("sequence", sequence).filter("what is not null or sequence is not null")
    events = flow.moments(spoken.withColumnRenamed("lineno", "site_line"), "sequence", "site_line")
    rows = flow.since_entry(events).filter((F.col("is_exit") == 1) | F.col("sequence").isNotNull())
    for name, column in flow.measures().items():
        rows = rows.withColumn(name, column)
    table = rules.rule_table(nodes.sparkSession, extra_rules).select(
        "sequence", "prod", "rhs", F.col("severity").alias("rule_severity"), F.col("message").alias("rule_message")
    )
    rows = rows.join(table, "sequence", "left").withColumn("tokens", F.split("sequence", " "))
    fallback = rules.is_fallback(F.col("tokens"), F.col("rhs"))
    match = finding(
        F.col("prod").isNotNull(),
        lineno=F.col("site_line"),
        code=F.lit("GRAMMAR_VULN"),
        message=F.concat(F.lit("Grammar-based detection: "), "rule_message"),
        severity=F.col("rule_severity"),
        pattern=F.array_join("rhs", " -> "),
        tokens=F.col("tokens"),
        parse_stack=F.when(fallback, F.array().cast("array<int>")).otherwise(F.array(F.lit(0), F.lit(200))),
        prod=F.col("prod"),
        emit_key=emit_key(F.col("pos")),
    )
    leaves = F.col("is_exit") == 1
    checks = [
        finding(
            leaves & check.isNotNull(),
            lineno=F.col("lineno"), code=check["code"], message=check["message"], severity=check["severity"],
            emit_key=check["emit_key"],
        )
        for check in flow.flow_checks().values()
    ]
    return _unfolded(rows, match, *checks)


def name_findings(nodes: DataFrame) -> DataFrame:
    """Undefined names, duplicates and unused parameters.

    A define is one event, a use one for each scope around it.  A window by
    (file, scope, name) tells which scopes hold the name by then and which
    defines come second; an aggregate by use picks the innermost scope; a
    window by what was picked shows the parameters no use came to.
    """
    defines, what = symbols.define_event()
    owner = F.get(F.col("path"), F.size("path") - 1)
    told = {name: what[name] for name in ("name", "kind", "ord", "sub", "lineno")} | {"end_ord": owner["end_ord"], "depth": owner["depth"]}
    given = {name: F.col(name) for name in ("name", "ord", "lineno")}
    columns = {
        name: (F.when(F.col("is_use"), given[name]) if name in given else F.when(F.col("is_use"), None)).otherwise(told[name])
        for name in told
    }
    placed = nodes.filter(defines | symbols.reads_name()).withColumn("is_use", ~F.coalesce(defines, F.lit(False))).select(
        "file", "is_use", "path", F.when(~F.col("is_use"), what["scope_id"]).alias("own_scope"),
        *[column.alias(f"{name}_") for name, column in columns.items()],
        F.explode(symbols.around(F.col("path"), only=~F.col("is_use"))).alias("level"),
    )
    events = placed.select(
        "file", "is_use", F.coalesce("own_scope", symbols.scope_at(F.col("path"), F.col("level"))).alias("scope_id"), "level",
        *[F.col(f"{name}_").alias(name) for name in columns],
    ).filter("scope_id is not null")
    is_use, kind = F.col("is_use"), F.col("kind")
    at = F.col("ord").cast("long") * _PACK + F.coalesce("sub", F.lit(0))
    same = Window.partitionBy("file", "scope_id", "name")
    builtin = symbols.is_builtin(F.col("scope_id"), F.col("name"))
    first = F.min(F.when(~is_use, F.struct(at.alias("at"), F.col("lineno").alias("line")))).over(same)
    held = events.withColumn("at", at).withColumn("first", first).select(
        "*",
        F.when(is_use & ((F.col("first.at") < F.col("at")) | builtin), F.col("level").cast("long") * _PACK + F.col("scope_id")).alias("visible"),
        F.when(
            ~is_use & kind.isin("import", "function", "class") & ((F.col("first.at") < F.col("at")) | builtin),
            F.when(builtin, 0).otherwise(F.col("first.line")),
        ).alias("first_line"),
        F.when(kind == "parameter", F.col("scope_id")).alias("parameter_of"),
    )
    told = held.filter("is_use or first_line is not null or parameter_of is not null")
    keys = ["file", "is_use", "ord", "sub", "name", "kind", "lineno", "end_ord", "depth", "first_line", "parameter_of"]
    picked = told.groupBy(*keys).agg((F.max("visible") % _PACK).cast("int").alias("resolved"))
    symbol = Window.partitionBy("file", F.coalesce("resolved", "parameter_of"), "name")
    rows = picked.withColumn("used", F.max("is_use").over(symbol))
    duplicate = symbols.duplicate_texts(F.col("first_line"))
    return _unfolded(
        rows,
        finding(
            is_use & F.col("resolved").isNull(),
            lineno=F.col("lineno"),
            code=F.lit("UNDEFINED_VARIABLE"),
            message=F.concat(F.lit("Variable '"), "name", F.lit("' used before definition")),
            severity=F.lit("ERROR"),
            emit_key=emit_key(F.col("ord")),
        ),
        finding(
            F.col("first_line").isNotNull(),
            lineno=F.col("lineno"),
            **duplicate,
            emit_key=emit_key(F.col("ord"), sub=F.col("sub")),
        ),
        finding(
            F.col("parameter_of").isNotNull() & ~F.col("used"),
            lineno=F.col("lineno"),
            code=F.lit("UNUSED_PARAMETER"),
            message=F.concat(F.lit("Parameter '"), "name", F.lit("' is never used")),
            severity=F.lit("WARNING"),
            emit_key=emit_key(F.col("end_ord"), 1, -F.col("depth"), F.col("sub") + 2),
        ),
    )


DEFINE, USE, LABEL, BUILTIN, ROOT = 0, 1, 2, 3, 4


def name_lifetimes(nodes: DataFrame, *, labels: bool) -> DataFrame:
    """Defines and resolved uses: (file, scope_id, name, what, at, kind, label, lineno), from one scan.

    `what` is DEFINE or USE, and ROOT for the module node itself (name null).
    A use is one event for each scope around it and keeps the innermost that
    holds its name by then; uses of no scope are left out.  `labels` adds the
    inferred types of defines; the rows an assigned value becomes go once they
    have told their assignment.
    """
    defines, told = symbols.define_event()
    root, kind = F.col("node_type") == "Module", told["kind"]
    uses = symbols.reads_name()
    what = F.when(defines, DEFINE).when(uses, USE)
    if labels:
        above, field = F.col("parent_type"), F.col("field")
        label = symbols.infer_type(F.col("node_type"), F.col("const_kind"), F.col("op"), F.col("dotted"))
        what = what.when((above == "Assign") & (field == "value") & label.isNotNull(), LABEL)
    rows = nodes.withColumn("what", what.when(root, ROOT)).filter("what is not null")
    what = F.col("what")
    defined = F.when(kind == "import", "module").when(kind.isin("function", "class"), kind)
    columns = {
        "name": F.when(what == DEFINE, told["name"]).when(what == USE, F.col("name")),
        "kind": F.when(what == DEFINE, kind),
        "ord": F.when(what == DEFINE, told["ord"]).when(what == USE, F.col("ord")).when(what == ROOT, -1).otherwise(F.col("parent")),
        "sub": F.when(what == DEFINE, told["sub"]),
        "lineno": F.when(what == DEFINE, told["lineno"]).when(what == USE, F.col("lineno")),
        "label": F.when(what == DEFINE, defined).when(what == LABEL, label) if labels else F.when(what == DEFINE, defined),
    }
    placed = rows.select(
        "file", "what", "path", F.when(what == DEFINE, told["scope_id"]).when(what == ROOT, symbols.MODULE_SCOPE).alias("own_scope"),
        *[column.alias(f"{name}_") for name, column in columns.items()],
        F.explode(symbols.around(F.col("path"), only=what != USE)).alias("level"),
    )
    scope = F.when(what == USE, symbols.scope_at(F.col("path"), F.col("level"))).otherwise(F.col("own_scope"))
    events = placed.select(
        "file", "what", scope.cast("int").alias("scope_id"), "level", *[F.col(f"{name}_").alias(name) for name in columns]
    ).filter((what != USE) | F.col("scope_id").isNotNull())
    what = F.col("what")
    if labels:
        assigned = Window.partitionBy("file", "ord")
        label = F.max(F.when(what == LABEL, F.col("label"))).over(assigned)
        events = events.withColumn("told", label).filter(what != LABEL)
        events = events.withColumn("label", F.when(F.col("kind") == "variable", F.col("told")).otherwise(F.col("label")))
    same = Window.partitionBy("file", "scope_id", "name")
    first = F.min(F.when(what == DEFINE, F.col("ord"))).over(same)
    visible = (F.col("first") < F.col("ord")) | symbols.is_builtin(F.col("scope_id"), F.col("name"))
    at_level = F.col("level").cast("long") * _PACK + F.col("scope_id")
    held = events.withColumn("first", first).select(
        "*",
        F.when(what != USE, F.col("scope_id")).alias("own"),
        F.when((what == USE) & visible, at_level).alias("innermost"),
    )
    keys = ["file", "what", "ord", "sub", "name", "kind", "label", "lineno", "own"]
    picked = held.groupBy(*keys).agg((F.max("innermost") % _PACK).cast("int").alias("resolved"))
    return picked.select(
        "file", F.coalesce("own", "resolved").alias("scope_id"), "name", "what",
        (F.col("ord").cast("long") * _PACK + F.coalesce("sub", F.lit(0))).alias("at"), "kind", "label", "lineno",
    ).filter("scope_id is not null")


def symbol_table(nodes: DataFrame) -> DataFrame:
    """The rows of `symbols.symbol_table` by one scan of the nodes, one list per symbol and no join.

    A list holds the defines and uses of one symbol of one file in time, so it
    is bounded by what one source row holds.  Built-in names are no events: one
    that a file defines or uses gets its definition put before the others, and
    the module's row becomes the rest of them, all known beforehand.
    """
    moment = "struct<at:bigint,what:int,kind:string,label:string,lineno:int>"
    listed = name_lifetimes(nodes, labels=True).groupBy("file", "scope_id", "name").agg(
        F.sort_array(F.collect_list(F.struct("at", "what", "kind", "label", "lineno"))).alias("all")
    )
    builtin = F.coalesce(symbols.is_builtin(F.col("scope_id"), F.col("name")), F.lit(False))
    met = F.collect_list(F.when(F.col("builtin"), F.col("name"))).over(Window.partitionBy("file"))
    rows = listed.withColumn("builtin", builtin).withColumn("met", met)
    by_kind = {kind: [n for n in vocab.BUILTINS if symbols.builtin_kind(n) == kind] for kind in map(symbols.builtin_kind, vocab.BUILTINS)}
    kind_of = F.coalesce(*[F.when(F.col("name").isin(names), F.lit(kind)) for kind, names in by_kind.items()])
    declared = F.struct(F.lit(-1).alias("at"), F.lit(BUILTIN).alias("what"), kind_of.alias("kind"), F.lit(None).alias("label"), F.lit(0).alias("lineno"))
    told = F.filter("all", lambda m: m["what"] != USE)
    split = rows.select(
        "file", "scope_id", "name", "builtin", "met",
        F.when(F.col("builtin"), F.concat(F.array(declared.cast(moment)), told)).otherwise(told).alias("defs"),
        F.transform(F.filter("all", lambda m: m["what"] == USE), lambda m: m["lineno"]).alias("usages"),
    )
    telling = F.filter(
        "defs", lambda m, i: m["label"].isNotNull() & ((m["kind"] == "variable") | ((i == 0) & ~F.col("builtin")))
    )
    assigned = F.filter("defs", lambda m: (m["what"] == DEFINE) & (m["kind"] == "variable"))
    first = F.get("defs", F.lit(0))
    symbol = F.struct(
        "scope_id", "name",
        first["kind"].alias("symbol_type"),
        F.coalesce(F.get(telling, F.size(telling) - 1)["label"], F.when(F.col("builtin"), "builtin")).alias("inferred_type"),
        first["lineno"].alias("declared_line"),
        (F.size("usages") > 0).alias("is_used"),
        F.transform(assigned, lambda m: m["lineno"]).alias("assignments"),
        "usages",
    )
    nothing = F.array().cast("array<int>")
    every = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(symbols.builtin_kind(n)).alias("kind")) for n in vocab.BUILTINS])
    others = F.transform(
        F.filter(every, lambda b: ~F.array_contains("met", b["name"])),
        lambda b: F.struct(
            F.lit(symbols.MODULE_SCOPE).alias("scope_id"), b["name"].alias("name"), b["kind"].alias("symbol_type"),
            F.lit("builtin").alias("inferred_type"), F.lit(0).alias("declared_line"), F.lit(False).alias("is_used"),
            nothing.alias("assignments"), nothing.alias("usages"),
        ),
    )
    return split.select("file", F.inline(F.when(F.col("name").isNull(), others).otherwise(F.array(symbol))))


def name_counts(nodes: DataFrame) -> DataFrame:
    """counts(file, scopes_created, imports, symbols_tracked, unused_variables) of every module, from one scan.

    Built-in names enter by arithmetic: each module has them all, and those
    counted as variables are unused until something reads them.
    """
    what, kind = F.col("what"), F.col("kind")
    defined = what == DEFINE
    per_symbol = name_lifetimes(nodes, labels=False).groupBy("file", "scope_id", "name").agg(
        F.min(F.when(defined, F.col("at"))).alias("first"),
        F.min(F.when(defined & (kind == "variable"), F.col("at"))).alias("first_variable"),
        F.max(F.when(what == USE, 1).otherwise(0)).alias("used"),
        F.count_if(what == ROOT).alias("roots"),
        F.count_if(defined & kind.isin("function", "class")).alias("opened"),
        F.count_if(defined & (kind == "import")).alias("imported"),
    )
    builtin = F.coalesce(symbols.is_builtin(F.col("scope_id"), F.col("name")), F.lit(False))
    own = F.col("first").isNotNull() & ~builtin
    unused, n_variables = F.col("used") == 0, sum(symbols.builtin_kind(b) == "variable" for b in vocab.BUILTINS)
    read = builtin & ~unused & ~F.substring("name", 1, 1).between("a", "z")
    return per_symbol.groupBy("file").agg(
        F.sum(F.col("roots") + F.col("opened")).alias("scopes_created"),
        F.sum("imported").alias("imports"),
        (F.sum("roots") * len(vocab.BUILTINS) + F.count_if(own)).alias("symbols_tracked"),
        (
            F.sum("roots") * n_variables - F.count_if(read)
            + F.count_if(own & unused & (F.col("first") == F.col("first_variable")))
        ).alias("unused_variables"),
    )


def literal_and_failure_findings(shredded: DataFrame) -> DataFrame:
    """Misspelt SQL in string literals, syntax errors, and files that fail to parse otherwise."""
    text, failure = F.col("const_str"), F.col("error")
    failed = F.col("ord") == -1
    literal = (F.col("node_type") == "Constant") & (F.col("const_kind") == "str") & sql_lint.is_suspect(text)
    yes = F.lit(True)
    syntax_error = finding(
        failure["kind"] == "syntax",
        lineno=failure["line"],
        code=F.lit("SYNTAX_ERROR"),
        message=F.concat(F.lit("Syntax error while parsing: "), failure["message"]),
        severity=F.lit("ERROR"),
        phase=F.lit("PHASE_2_SYNTAX"),
        emit_key=emit_key(F.lit(0)),
    )
    broken = finding(failure["kind"] == "other", error=failure["message"])
    misspelt = F.transform(
        sql_lint.lint_words(text),
        lambda w: finding(
            yes,
            lineno=F.col("lineno"),
            code=F.lit("SQL_SYNTAX_ERROR"),
            message=w["message"],
            severity=F.lit("ERROR"),
            emit_key=emit_key(F.col("ord"), sub=w["word_idx"]),
        ),
    )
    found = F.when(failed, F.array_compact(F.array(syntax_error, broken))).otherwise(misspelt)
    return shredded.filter(failed | literal).select("file", F.inline(found))
