"""Scopes, definitions and name resolution.

A scope is named by the `ord` of the node that opens it (module 0, sync
function or class otherwise).  Every node carries its enclosing definitions in
`path`, so its scope chain is an array expression, and resolving a name is an
equi-join on `(file, scope_id, name)` with "defined before used" as residual.

The 49 built-in names exist once per module scope.  They are answered by
literal membership instead of being multiplied into 49 rows per file; only
the queries that list symbols spell them out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from srcweave.functions import text, vocab
from srcweave.operators.rules import emit_key
from srcweave.operators.syntax import bound_name

MODULE_SCOPE = 0
_PACK = 1 << 32
_VARIABLE_BUILTINS = [b for b in vocab.BUILTINS if not b[0].islower()]


def scope_chain(path: Column) -> Column:
    """Scope ids around a node, outermost (module) first."""
    opened = F.filter(path, lambda d: d["kind"].isin("FunctionDef", "ClassDef"))
    return F.concat(F.array(F.lit(MODULE_SCOPE)), F.transform(opened, lambda d: d["ord"]))


def around(path: Column, *, only: Column | None = None) -> Column:
    """Places of the scopes that may be around a node: 0 for the module, i for the i-th definition of its path.

    Unfolded, `scope_at` tells their ids; unlike `scope_chain` both are generated code. Where `only` holds, just 0.
    """
    places = F.sequence(F.lit(0), F.size(path))
    return places if only is None else F.when(only, F.array(F.lit(0))).otherwise(places)


def scope_at(path: Column, place: Column) -> Column:
    """Scope id at a place of `around`; null if what is there opens no scope."""
    step = F.get(path, place - 1)
    return F.when(place == 0, MODULE_SCOPE).when(step["kind"].isin("FunctionDef", "ClassDef"), step["ord"])


def scope_of(path: Column) -> Column:
    return F.element_at(scope_chain(path), -1)


def builtin_kind(name: str) -> str:
    """Built-in names count as functions, capitalised and dunder ones as variables."""
    return "variable" if name in _VARIABLE_BUILTINS else "function"


def is_builtin(scope_id: Column, name: Column) -> Column:
    return (scope_id == MODULE_SCOPE) & name.isin(vocab.BUILTINS)


def scopes(nodes: DataFrame) -> DataFrame:
    """scopes(file, scope_id, parent_scope_id, name, scope_type, chain)."""
    kind = F.col("node_type")
    chain = F.when(kind == "Module", F.array(F.lit(MODULE_SCOPE))).otherwise(
        F.concat(scope_chain(F.col("path")), F.array("ord"))
    )
    return nodes.filter(kind.isin("Module", "FunctionDef", "ClassDef")).select(
        "file",
        F.col("ord").alias("scope_id"),
        F.when(kind != "Module", scope_of(F.col("path"))).alias("parent_scope_id"),
        F.coalesce("name", F.lit("<global>")).alias("name"),
        F.when(kind == "Module", "global").when(kind == "ClassDef", "class").otherwise("function").alias("scope_type"),
        chain.alias("chain"),
    )


def infer_type(node_type: Column, const_kind: Column, op: Column, dotted: Column) -> Column:
    """Type label of a value node; null when nothing can be said.

    A call counts only by bare name, which is when its dotted form is the name.
    """
    return (
        F.when(
            node_type == "Constant",
            F.when(const_kind.isin("int", "True", "False"), "int")
            .when(const_kind.isin("float", "str"), const_kind)
            .when(const_kind == "None", "NoneType"),
        )
        .when(node_type.isin("List", "ListComp"), "list")
        .when(node_type.isin("Dict", "DictComp"), "dict")
        .when(node_type.isin("Set", "SetComp"), "set")
        .when(node_type == "Tuple", "tuple")
        .when(node_type == "Lambda", "function")
        .when(
            (node_type == "Call") & dotted.isin("int", "float", "str", "list", "dict", "set"), dotted
        )
        .when((node_type == "BinOp") & op.isin("Add", "Sub", "Mult", "Div"), "numeric")
    )


def inferred_types(nodes: DataFrame) -> DataFrame:
    """types(file, assign_ord, inferred_type) of every assigned value."""
    values = nodes.filter((F.col("parent_type") == "Assign") & (F.col("field") == "value"))
    label = infer_type(F.col("node_type"), F.col("const_kind"), F.col("op"), F.col("dotted"))
    return values.select("file", F.col("parent").alias("assign_ord"), label.alias("inferred_type"))


_EVENT = ["file", "scope_id", "name", "kind", "inferred_type", "ord", "sub", "lineno"]


def define_event() -> tuple[Column, dict[str, Column]]:
    """Whether a node row defines a name, and what: scope_id, name, kind, ord, sub, lineno.

    `(ord, sub)` orders the defines of a file in time.  `arguments` directly
    follows its function in visit order, which tells a function's parameters
    from those of a lambda inside it.
    """
    node, above, field = F.col("node_type"), F.col("parent_type"), F.col("field")
    owner = F.get(F.col("path"), F.size("path") - 1)
    target = (above == "Assign") & (field == "targets") & (node == "Name")
    alias = node == "alias"
    named = node.isin("FunctionDef", "ClassDef")
    parameter = (
        (above == "arguments")
        & (field == "args")
        & (owner["kind"] == "FunctionDef")
        & (owner["ord"] == F.col("parent") - 1)
    )
    return target | alias | named | parameter, {
        "scope_id": F.when(parameter, owner["ord"]).otherwise(scope_of(F.col("path"))),
        "name": F.when(alias, bound_name()).otherwise(F.col("name")),
        "kind": F.when(target, "variable")
        .when(alias, "import")
        .when(parameter, "parameter")
        .when(node == "ClassDef", "class")
        .otherwise("function"),
        "ord": F.when(named, F.col("ord")).when(parameter, owner["ord"]).otherwise(F.col("parent")),
        "sub": F.when(named, 0).otherwise(F.col("field_idx")),
        "lineno": F.when(named, F.col("lineno")).otherwise(F.col("stmt_line")),
    }


def define_events(nodes: DataFrame) -> DataFrame:
    """events(file, scope_id, name, kind, ord, sub, lineno): every define in user code.

    Each event comes from one node row, so this is a filter and a projection:
    it keeps the layout of `nodes`, and windows over it need no exchange.
    """
    defines, what = define_event()
    return nodes.filter(defines).select("file", *[column.alias(name) for name, column in what.items()])


def builtin_definitions(nodes: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(b) for b in vocab.BUILTINS])
    return (
        nodes.filter(F.col("node_type") == "Module")
        .select("file", F.posexplode(names).alias("sub", "name"))
        .select(
            "file",
            F.lit(MODULE_SCOPE).alias("scope_id"),
            "name",
            F.when(F.col("name").isin(_VARIABLE_BUILTINS), "variable").otherwise("function").alias("kind"),
            F.lit("builtin").alias("inferred_type"),
            F.lit(-1).alias("ord"),
            "sub",
            F.lit(0).alias("lineno"),
        )
    )


def definitions(nodes: DataFrame, *, built_ins: bool = False) -> DataFrame:
    """Define events with inferred types:
    (file, scope_id, name, kind, inferred_type, ord, sub, lineno)."""
    values = inferred_types(nodes).withColumnRenamed("assign_ord", "ord")
    kind = F.col("kind")
    events = (
        define_events(nodes)
        .join(values, ["file", "ord"], "left")
        .withColumn(
            "inferred_type",
            F.when(kind == "import", "module")
            .when(kind.isin("function", "class"), kind)
            .when(kind == "variable", F.col("inferred_type")),
        )
        .select(*_EVENT)
    )
    return events.unionByName(builtin_definitions(nodes)) if built_ins else events


def first_definitions(events: DataFrame) -> DataFrame:
    """symbols(file, scope_id, name, kind, ord, sub, lineno): the first define wins.

    Built-in names of the module scope keep their line-0 definition.
    """
    first = events.groupBy("file", "scope_id", "name").agg(
        F.min(F.struct("ord", "sub", "kind", "lineno")).alias("first")
    )
    builtin = is_builtin(F.col("scope_id"), F.col("name"))
    variable = F.col("name").isin(_VARIABLE_BUILTINS)
    return first.select(
        "file",
        "scope_id",
        "name",
        F.when(builtin, F.when(variable, "variable").otherwise("function"))
        .otherwise(F.col("first.kind"))
        .alias("kind"),
        F.when(builtin, -1).otherwise(F.col("first.ord")).alias("ord"),
        F.when(builtin, 0).otherwise(F.col("first.sub")).alias("sub"),
        F.when(builtin, 0).otherwise(F.col("first.lineno")).alias("lineno"),
    )


def reads_name() -> Column:
    return (F.col("node_type") == "Name") & (F.col("ctx") == "Load")


def name_uses(nodes: DataFrame) -> DataFrame:
    """uses(file, ord, name, lineno, chain): names read, with their scope chain."""
    return nodes.filter(reads_name()).select("file", "ord", "name", "lineno", scope_chain(F.col("path")).alias("chain"))


def resolve(uses: DataFrame, symbols: DataFrame) -> DataFrame:
    """Every use with the scope its name resolves to; `scope_id` null when none.

    The innermost enclosing scope whose symbol was defined before the use.
    A chain is as long as definitions nest, which Python's own limit on
    indentation bounds, so a use fans out into few candidates.
    """
    candidates = uses.select("file", "ord", "name", "lineno", F.posexplode("chain").alias("level", "scope_id"))
    known = symbols.select("file", "scope_id", "name", F.col("ord").alias("def_ord"))
    joined = candidates.join(known, ["file", "scope_id", "name"], "left")
    visible = (F.col("def_ord") < F.col("ord")) | is_builtin(F.col("scope_id"), F.col("name"))
    # level and scope packed into one number: its maximum is the innermost
    # visible scope, and a numeric buffer keeps this a hash aggregate
    packed = F.col("level").cast("long") * _PACK + F.col("scope_id")
    return (
        joined.groupBy("file", "ord", "name", "lineno")
        .agg(F.max(F.when(visible, packed)).alias("best"))
        .select("file", "ord", "name", "lineno", (F.col("best") % _PACK).cast("int").alias("scope_id"))
    )


def undefined_variables(resolved: DataFrame) -> DataFrame:
    return resolved.filter(F.col("scope_id").isNull()).select(
        "file",
        "lineno",
        F.lit("UNDEFINED_VARIABLE").alias("code"),
        F.concat(F.lit("Variable '"), "name", F.lit("' used before definition")).alias("message"),
        F.lit("ERROR").alias("severity"),
        emit_key(F.col("ord")).alias("emit_key"),
    )


def usages(resolved: DataFrame) -> DataFrame:
    """usages(file, scope_id, name, usages): lines reading each symbol, in visit order."""
    ordered = F.sort_array(F.collect_list(F.struct("ord", "lineno")))
    return (
        resolved.filter(F.col("scope_id").isNotNull())
        .groupBy("file", "scope_id", "name")
        .agg(F.transform(ordered, lambda u: u["lineno"]).alias("usages"))
    )


def assignment_history(definitions: DataFrame) -> DataFrame:
    """Lines assigning each symbol, and its last inferred type.

    The first define sets the type, and a later assignment replaces it when it
    infers one; imports, functions and classes that redefine a symbol change
    nothing.  A built-in name was defined before any of them, so its type is
    null here unless an assignment infers one.
    """
    moment = F.struct("ord", "sub")
    place = Window.partitionBy("file", "scope_id", "name").orderBy("ord", "sub")
    numbered = definitions.filter(F.col("ord") >= 0).withColumn("nth", F.row_number().over(place))
    assigned = F.col("kind") == "variable"
    tells = assigned | ((F.col("nth") == 1) & ~is_builtin(F.col("scope_id"), F.col("name")))
    lines = F.sort_array(F.collect_list(F.when(assigned, F.struct("ord", "sub", "lineno"))))
    return numbered.groupBy("file", "scope_id", "name").agg(
        F.transform(lines, lambda a: a["lineno"]).alias("assignments"),
        F.max_by(
            "inferred_type", F.when(tells & F.col("inferred_type").isNotNull(), moment)
        ).alias("inferred_type"),
    )


def symbol_table(
    nodes: DataFrame, first: DataFrame | None = None, resolved: DataFrame | None = None
) -> DataFrame:
    """The full symbol table, built-ins included.

    symbols(file, scope_id, name, symbol_type, inferred_type, declared_line,
    is_used, assignments, usages).  Own and built-in symbols are completed
    separately and put together last, so that every join keeps the layout.
    """
    key = ["file", "scope_id", "name"]
    first = first_definitions(define_events(nodes)) if first is None else first
    resolved = resolve(name_uses(nodes), first) if resolved is None else resolved
    history, used = assignment_history(definitions(nodes)), usages(resolved)
    builtin = is_builtin(F.col("scope_id"), F.col("name"))
    none = F.array().cast("array<int>")

    def complete(symbols, default_type):
        return (
            symbols.select(*key, "kind", "lineno")
            .join(history, key, "left")
            .join(used, key, "left")
            .select(
                *key,
                F.col("kind").alias("symbol_type"),
                F.coalesce("inferred_type", F.lit(default_type).cast("string")).alias("inferred_type"),
                F.col("lineno").alias("declared_line"),
                F.col("usages").isNotNull().alias("is_used"),
                F.coalesce("assignments", none).alias("assignments"),
                F.coalesce("usages", none).alias("usages"),
            )
        )

    return complete(first.filter(~builtin), None).unionByName(complete(builtin_definitions(nodes), "builtin"))


_DUPLICATES = {
    "import": ("DUPLICATE_IMPORT", "Import", "WARNING"),
    "function": ("DUPLICATE_FUNCTION", "Function", "ERROR"),
    "class": ("DUPLICATE_CLASS", "Class", "ERROR"),
}


def duplicates(events: DataFrame) -> DataFrame:
    """Imports, functions and classes whose name the scope already holds.

    The first definition of any kind is the one cited.
    """
    place = Window.partitionBy("file", "scope_id", "name").orderBy("ord", "sub")
    builtin = is_builtin(F.col("scope_id"), F.col("name"))
    kind = F.col("kind")
    seen = (
        events.withColumn("nth", F.row_number().over(place))
        .withColumn("first_line", F.when(builtin, 0).otherwise(F.first("lineno").over(place)))
        .filter(kind.isin(*_DUPLICATES) & ((F.col("nth") > 1) | builtin))
    )

    return seen.select(
        "file",
        "lineno",
        *[column.alias(name) for name, column in duplicate_texts(F.col("first_line")).items()],
        emit_key(F.col("ord"), sub=F.col("sub")).alias("emit_key"),
    )


def duplicate_texts(first_line: Column) -> dict[str, Column]:
    """code, message and severity of a define whose scope holds the name since `first_line`."""

    def by_kind(i):
        chain = None
        for name, labels in _DUPLICATES.items():
            chain = (F if chain is None else chain).when(F.col("kind") == name, labels[i])
        return chain

    message = F.concat(by_kind(1), F.lit(" '"), "name", F.lit("' already defined at line "), first_line)
    return {"code": by_kind(0), "message": message, "severity": by_kind(2)}


def unused_parameters(nodes: DataFrame, symbols: DataFrame, resolved: DataFrame) -> DataFrame:
    """Parameters no use resolves to, reported when their function ends.

    A parameter is always the first define of its name in its function's
    scope, so the parameters are the symbols of that kind.
    """
    key = ["file", "scope_id", "name"]
    unused = symbols.filter(F.col("kind") == "parameter").join(resolved.select(*key), key, "left_anti")
    spans = nodes.filter(F.col("node_type") == "FunctionDef").select(
        "file", F.col("ord").alias("scope_id"), "end_ord", "depth"
    )
    return unused.join(spans, ["file", "scope_id"]).select(
        "file",
        "lineno",
        F.lit("UNUSED_PARAMETER").alias("code"),
        F.concat(F.lit("Parameter '"), "name", F.lit("' is never used")).alias("message"),
        F.lit("WARNING").alias("severity"),
        emit_key(F.col("end_ord"), 1, -F.col("depth"), F.col("sub") + 2).alias("emit_key"),
    )


def unused_variables(nodes: DataFrame, symbols: DataFrame, resolved: DataFrame) -> DataFrame:
    """Variable symbols never read, the built-ins counted as variables included."""
    key = ["file", "scope_id", "name"]
    variable = F.col("kind") == "variable"
    own = symbols.filter(variable & ~is_builtin(F.col("scope_id"), F.col("name")))

    def unread(df):
        return df.select(*key, "lineno").join(resolved.select(*key), key, "left_anti")

    return unread(own).unionByName(unread(builtin_definitions(nodes).filter(variable)))


def type_mismatches(pairs: DataFrame) -> DataFrame:
    """TYPE_MISMATCH rows for caller-supplied (file, lineno, expected, actual, context)."""
    expected, actual = F.col("expected"), F.col("actual")
    return pairs.filter((expected != "") & (actual != "") & ~text.type_compatible(expected, actual)).select(
        "file",
        "lineno",
        F.lit("TYPE_MISMATCH").alias("code"),
        F.concat(
            F.lit("Type mismatch in "), "context", F.lit(": expected "), expected, F.lit(", got "), actual
        ).alias("message"),
        F.lit("WARNING").alias("severity"),
    )
