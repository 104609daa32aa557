"""Complexity and missing returns, as running totals over definition events.

Counters belong to a function *name*: entering any function of that name
resets them.  Per `(file, name)` the entries, exits, branches and returns are
put in visit order; a running total minus its value at the latest entry is the
counter, read off at each exit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from srcweave.functions import text, vocab
from srcweave.operators.features import routed
from srcweave.operators.rules import emit_key

MODULE_OWNER = "<module>"
_BRANCHES = ["If", "For", "While", "With", "Try", "BoolOp"]


def owner_name(path: Column) -> Column:
    """Name of the nearest enclosing sync function, else `<module>`."""
    functions = F.filter(path, lambda d: d["kind"] == "FunctionDef")
    return F.coalesce(F.get(functions, F.size(functions) - 1)["name"], F.lit(MODULE_OWNER))


# What a routed row is to a function, branch or return: that node itself, a plain parameter, a return annotation.
STEP, PARAMETER, ANNOTATION = 3, 4, 5


def flow_roles() -> dict[int, Column]:
    """By role, the position of the function, branch or return a node row speaks for.

    `arguments` directly follows its function in visit order.  An annotation
    that branches (`-> a or b`) speaks twice: as itself and for its function.
    """
    node, above, field = F.col("node_type"), F.col("parent_type"), F.col("field")
    return {
        STEP: F.when(node.isin("FunctionDef", *_BRANCHES, "Return"), F.col("ord")),
        PARAMETER: F.when((above == "arguments") & (field == "args"), F.col("parent") - 1),
        ANNOTATION: F.when((above == "FunctionDef") & (field == "returns"), F.col("parent")),
    }


def flow_owner() -> Column:
    """Name a routed row counts for: a function's own, for a step inside that of the function around it."""
    path, role = F.col("path"), F.col("role")
    step = F.when(F.col("node_type") == "FunctionDef", F.col("name")).otherwise(owner_name(path))
    return F.when(role == STEP, step).when(role.isin(PARAMETER, ANNOTATION), F.get(path, F.size(path) - 1)["name"])


def counted_owner() -> Column:
    """Name whose complexity a node row gives a value to: of a function its own, of a branch that of the function around it."""
    node = F.col("node_type")
    return F.when(node == "FunctionDef", F.col("name")).when(node.isin(*_BRANCHES), owner_name(F.col("path")))


def flow_counts() -> list[Column]:
    """Aggregates over the routed rows of a function, branch or return; numbers only."""
    node, role = F.col("node_type"), F.col("role")
    literal_none = (node == "Constant") & (F.col("const_kind") == "None")

    def of_own(column):
        return F.max(F.when(role == STEP, column))

    return [
        of_own(F.when(node == "FunctionDef", 1).when(node == "Return", 3).otherwise(2)).alias("what"),
        of_own(F.col("lineno")).alias("step_line"),
        of_own(F.col("end_ord")).alias("end_ord"),
        of_own(F.col("depth")).alias("def_depth"),
        F.count_if(role == PARAMETER).alias("n_params"),
        F.max(F.when(role == ANNOTATION, F.when(literal_none, 1).otherwise(2))).alias("returns"),
    ]


def moments(grouped: DataFrame, *more: str) -> DataFrame:
    """Entries, exits, branches and returns, one row each, from rows grouped by (file, site, owner)."""
    what, zero = F.col("what"), F.lit(0)

    def moment(pos, is_exit, neg_depth):
        return F.struct(pos.alias("pos"), F.lit(is_exit).alias("is_exit"), neg_depth.alias("neg_depth"))

    enters = moment(F.col("site"), 0, zero)
    leaves = moment(F.col("end_ord"), 1, -F.col("def_depth"))
    return grouped.select(
        "*", F.inline(F.when(what == 1, F.array(enters, leaves)).otherwise(F.array(enters)))
    ).select(
        "file",
        "owner",
        "pos",
        "is_exit",
        "neg_depth",
        ((what == 1) & (F.col("is_exit") == 0)).alias("entry"),
        (what == 2).cast("int").alias("branch"),
        (what == 3).cast("int").alias("ret"),
        F.col("site").alias("def_ord"),
        F.col("step_line").alias("lineno"),
        "def_depth",
        "n_params",
        "returns",
        *more,
    )


def _events(nodes: DataFrame) -> DataFrame:
    """One scan feeds all of it, so the layout of `nodes` carries through to the windows."""
    rows = routed(nodes, flow_roles()).withColumn("owner", flow_owner())
    grouped = rows.groupBy("file", "site", "owner").agg(*flow_counts())
    return moments(grouped.filter(F.col("what").isNotNull()))


def since_entry(events: DataFrame) -> DataFrame:
    """Events with `since_branches` / `since_returns`: totals since the latest
    entry of a function of that name."""
    so_far = (
        Window.partitionBy("file", "owner")
        .orderBy("pos", "is_exit", "neg_depth")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    entered = F.col("entry")
    totals = events.withColumn("branches", F.sum("branch").over(so_far)).withColumn(
        "returns_seen", F.sum("ret").over(so_far)
    )
    # totals never fall, so their maximum over entries is their value at the latest
    at_entry = F.max(F.when(entered, F.struct("branches", "returns_seen"))).over(so_far)
    return totals.withColumn("base", at_entry).select(
        "*",
        (F.col("branches") - F.coalesce("base.branches", F.lit(0))).alias("since_branches"),
        (F.col("returns_seen") - F.coalesce("base.returns_seen", F.lit(0))).alias("since_returns"),
    )


def running_counts(nodes: DataFrame) -> DataFrame:
    return since_entry(_events(nodes))


def measures() -> dict[str, Column]:
    """What is known of a function at its exit."""
    return {
        "name": F.col("owner"),
        "end_ord": F.col("pos"),
        "complexity": (F.col("since_branches") + 1).cast("int"),
        "has_return": F.col("since_returns") > 0,
    }


def complexity(nodes: DataFrame) -> DataFrame:
    """functions(file, def_ord, name, lineno, complexity, has_return, …) at each exit."""
    found = {name: column.alias(name) for name, column in measures().items()}
    return (
        running_counts(nodes)
        .filter(F.col("is_exit") == 1)
        .select(
            "file", found["name"], "def_ord", "lineno", found["end_ord"], "def_depth", "n_params", "returns",
            found["complexity"], found["has_return"],
        )
    )


def final_complexity(nodes: DataFrame) -> DataFrame:
    """owners(file, name, complexity): last value per name, `<module>` included
    when the module itself branches."""
    events = running_counts(nodes).withColumn("owner_counts", F.col("entry") | (F.col("branch") == 1))
    last = F.max_by("since_branches", F.struct("pos", "is_exit", "neg_depth"))
    return (
        events.groupBy("file", F.col("owner").alias("name"))
        .agg((last + 1).cast("int").alias("complexity"), F.bool_or("owner_counts").alias("counts"))
        .filter("counts")
        .drop("counts")
    )


def _complex(measured: Column) -> tuple[Column, Column, Column]:
    failing = measured >= vocab.COMPLEXITY_ERROR
    limit = F.when(failing, vocab.COMPLEXITY_ERROR).otherwise(vocab.COMPLEXITY_WARNING)
    message = F.concat(
        F.lit("Function '"), "name", F.lit("' complexity="), measured, F.lit(" (>= "), limit, F.lit(")")
    )
    return measured >= vocab.COMPLEXITY_WARNING, message, F.when(failing, "ERROR").otherwise("WARNING")


def _returns_nothing() -> Column:
    name = F.col("name")
    computes = (
        (F.col("n_params") > 0)
        & ~name.startswith("_")
        & ~text.contains_any(F.lower(name), vocab.PROCEDURE_WORDS)
    )
    suspect = F.when(F.col("returns").isNotNull(), F.col("returns") == 2).otherwise(computes)
    return ~F.col("has_return") & ~name.isin(vocab.NO_RETURN_NAMES) & suspect


def flow_checks() -> dict[str, Column]:
    """By code, the finding of a function at its exit as a struct; null where it does not apply."""
    is_complex, complex_message, complex_severity = _complex(F.col("complexity"))
    missing_message = F.concat(F.lit("Function '"), "name", F.lit("' may be missing return statement"))

    def finding(applies, sub, code, message, severity):
        return F.when(
            applies,
            F.struct(
                F.lit(code).alias("code"),
                message.alias("message"),
                severity.alias("severity"),
                emit_key(F.col("end_ord"), 1, -F.col("def_depth"), F.lit(sub)).alias("emit_key"),
            ),
        )

    return {
        "MISSING_RETURN": finding(_returns_nothing(), 0, "MISSING_RETURN", missing_message, F.lit("WARNING")),
        "HIGH_COMPLEXITY": finding(is_complex, 1, "HIGH_COMPLEXITY", complex_message, complex_severity),
    }


def flow_findings(exits: DataFrame, only: str | None = None) -> DataFrame:
    """Missing returns and high complexity, from one pass over the exits."""
    wanted = [check for code, check in flow_checks().items() if only in (None, code)]
    return exits.select("file", "lineno", F.inline(F.array_compact(F.array(*wanted))))


def high_complexity(exits: DataFrame) -> DataFrame:
    return flow_findings(exits, "HIGH_COMPLEXITY")


def missing_returns(exits: DataFrame) -> DataFrame:
    return flow_findings(exits, "MISSING_RETURN")
