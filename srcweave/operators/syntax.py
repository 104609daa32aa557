"""Node relation: each file's syntax tree as rows, and counts over them.

`shred` is the only Python step of the package.  It writes down structure
(position, parent, enclosing definitions, literal attributes) and decides
nothing; every check is a query over these rows.
"""

from __future__ import annotations

import ast
import gc
import warnings
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NODE_FIELDS = {
    "file": "string",
    "ord": "int",  # visit (pre-order) position; the module is 0
    "parent": "int",
    "end_ord": "int",  # last position inside this node's subtree
    "depth": "int",
    # enclosing definitions, outermost first
    "path": "array<struct<ord:int,kind:string,name:string,end_ord:int,depth:int>>",
    "field": "string",
    "field_idx": "int",
    "parent_type": "string",
    "node_type": "string",
    "lineno": "int",
    "col": "int",
    "stmt_ord": "int",  # enclosing statement
    "stmt_line": "int",
    "op": "string",
    "name": "string",
    "dotted": "string",  # a.b.c of a name chain or of a call's function
    "ctx": "string",
    "asname": "string",
    "module": "string",
    "const_kind": "string",
    "const_str": "string",
    "error": "struct<kind:string,message:string,full:string,line:int,offset:int,text:string>",
}
NODE_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in NODE_FIELDS.items())
NODE_COLUMNS = [c for c in NODE_FIELDS if c != "error"]

_INT_COLUMNS = {name for name, kind in NODE_FIELDS.items() if kind == "int"}
_POSITION = [
    "file", "ord", "parent", "depth", "field", "field_idx", "parent_type", "node_type", "lineno", "col",
    "stmt_ord", "stmt_line",
]
_ATTRIBUTES = ["op", "name", "dotted", "ctx", "asname", "module", "const_kind", "const_str"]
_ROW = _POSITION + _ATTRIBUTES
_PATH_TYPE = pa.struct(
    [("ord", pa.int32()), ("kind", pa.string()), ("name", pa.string()), ("end_ord", pa.int32()), ("depth", pa.int32())]
)
_ERROR_TYPE = pa.struct(
    [
        ("kind", pa.string()),
        ("message", pa.string()),
        ("full", pa.string()),
        ("line", pa.int32()),
        ("offset", pa.int32()),
        ("text", pa.string()),
    ]
)
_BATCH_ROWS = 50_000
_DEFINITIONS = (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)
_UNKNOWN = "<unknown>"  # fixed value: a call or chain not rooted in a name


def _clean(text):
    # Arrow strings are UTF-8; lone surrogates from escapes are not.
    return text if text is None or text.isascii() else text.encode("utf-8", "replace").decode("utf-8")


def _dotted(node) -> str:
    parts = []
    while isinstance(node, ast.Attribute):
        parts.append(node.attr)
        node = node.value
    if not isinstance(node, ast.Name):
        return _UNKNOWN
    parts.append(node.id)
    return ".".join(parts[::-1])


def _const_kind(value) -> str:
    return repr(value) if value is None or value is True or value is False else type(value).__name__


def _values(op=None, name=None, dotted=None, ctx=None, asname=None, module=None, const_kind=None, const_str=None):
    return (op, name, dotted, ctx, asname, module, const_kind, const_str)


def _of_constant(node, parent, name=None):
    value = node.value
    if type(value) is str:
        return (None, name, None, None, None, None, "str", _clean(value))
    return (None, name, None, None, None, None, _const_kind(value), None)


def _of_name(node, parent):
    return (None, node.id, node.id, type(node.ctx).__name__, None, None, None, None)


def _of_attribute(node, parent):
    chain = None if type(parent) is ast.Attribute else _dotted(node)
    return (None, node.attr, chain, type(node.ctx).__name__, None, None, None, None)


def _of_call(node, parent):
    called = node.func
    return _values(name=getattr(called, "attr", getattr(called, "id", None)), dotted=_dotted(called))


def _of_keyword(node, parent):
    # A keyword also carries its literal or called function.
    if isinstance(node.value, ast.Constant):
        return _of_constant(node.value, node, node.arg)
    return _values(name=node.arg, dotted=_dotted(node.value.func) if isinstance(node.value, ast.Call) else None)


def _of_other(node, parent):
    op, ctx = getattr(node, "op", None), getattr(node, "ctx", None)
    name, module = getattr(node, "name", None), getattr(node, "module", None)
    return _values(
        op=op and type(op).__name__,
        ctx=ctx and type(ctx).__name__,
        name=name if isinstance(name, str) else None,
        module=module if isinstance(module, str) else None,
    )


# Literal attributes of a node, by its type; whatever it lacks stays null.
_ATTRIBUTES_OF = {
    ast.Name: _of_name,
    ast.Constant: _of_constant,
    ast.Attribute: _of_attribute,
    ast.Call: _of_call,
    ast.keyword: _of_keyword,
    ast.alias: lambda node, parent: _values(
        name=node.name, asname=node.asname, module=getattr(parent, "module", None)
    ),
    ast.arg: lambda node, parent: _values(name=node.arg),
}
_NOTHING = _values()
_PLAIN_FIELDS = (str, int, object, str | None, int | None, object | None, list[str])


@cache
def _shape(kind: type) -> tuple:
    """What all nodes of a type share: name, fields that may hold nodes, reader of attributes, has a line, statement, definition."""
    fields = kind._fields
    types = getattr(kind, "_field_types", {})  # Python 3.13
    inner = tuple(name for name in fields if types.get(name) not in _PLAIN_FIELDS)
    other = _of_other if {"op", "ctx", "name", "module"} & set(fields) else None
    # operators and contexts carry nothing
    return (
        kind.__name__, inner, _ATTRIBUTES_OF.get(kind, other), bool(fields) and "lineno" in kind._attributes,
        bool(fields) and issubclass(kind, ast.stmt), issubclass(kind, _DEFINITIONS),
    )


class _Rows:
    """Node rows on their way to Arrow."""

    def __init__(self):
        self.rows = []
        self.ends = []
        self.path_ids = []
        self.paths = [()]
        self.errors = []

    def __len__(self):
        return len(self.rows)

    def add_tree(self, file, tree):
        rows, path_ids, parents, order, opened = self.rows, self.path_ids, [], 0, []
        # what siblings share: parent type, parent position, depth, path, path id, statement
        pending = [(tree, None, None, 0, (None, -1, 0, (), 0, -1, None))]
        while pending:
            node, parent, field, index, shared = pending.pop()
            above, parent_ord, depth, path, path_id, stmt_ord, stmt_line = shared
            node_type, inner_fields, attributes, has_line, statement, definition = _shape(type(node))
            line, column = (node.lineno, node.col_offset) if has_line else (None, None)
            values = attributes(node, parent) if attributes else _NOTHING
            if statement:
                stmt_ord, stmt_line = order, line
            if inner_fields:
                inner_path, inner_id = path, path_id
                if definition:
                    step = {"ord": order, "kind": node_type, "name": node.name, "depth": depth}
                    opened.append(step)
                    inner_path, inner_id = (*path, step), len(self.paths)
                    self.paths.append(inner_path)
                shared = (node_type, order, depth + 1, inner_path, inner_id, stmt_ord, stmt_line)
                for name in inner_fields[::-1]:
                    value = getattr(node, name, None)
                    if type(value) is list:
                        for i in range(len(value) - 1, -1, -1):
                            if isinstance(value[i], ast.AST):
                                pending.append((value[i], node, name, i, shared))
                    elif isinstance(value, ast.AST):
                        pending.append((value, node, name, 0, shared))
            rows.append(
                (file, order, parent_ord, depth, field, index, above, node_type, line, column, stmt_ord, stmt_line)
                + values
            )
            parents.append(parent_ord)
            path_ids.append(path_id)
            order += 1
        ends = list(range(order))
        for i in range(order - 1, 0, -1):
            above = parents[i]
            if ends[above] < ends[i]:
                ends[above] = ends[i]
        for step in opened:
            step["end_ord"] = ends[step["ord"]]
        self.ends += ends
        self.errors += [None] * order

    def add_error(self, file, kind, problem):
        self.errors.append(
            {
                "kind": kind,
                "message": _clean(getattr(problem, "msg", None) or str(problem)),
                "full": _clean(str(problem)),
                "line": getattr(problem, "lineno", None),
                "offset": getattr(problem, "offset", None),
                "text": _clean(getattr(problem, "text", None)),
            }
        )
        self.rows.append((file, -1) + (None,) * (len(_ROW) - 2))
        self.ends.append(None)
        self.path_ids.append(0)

    def batch(self) -> pa.RecordBatch:
        columns = dict(zip(_ROW, zip(*self.rows)), end_ord=self.ends)
        arrays = []
        for name in NODE_FIELDS:
            if name == "path":
                distinct = pa.array(self.paths, pa.list_(_PATH_TYPE))
                arrays.append(distinct.take(pa.array(self.path_ids, pa.int32())))
            elif name == "error":
                arrays.append(pa.array(self.errors, _ERROR_TYPE))
            else:
                arrays.append(pa.array(columns[name], pa.int32() if name in _INT_COLUMNS else pa.string()))
        return pa.RecordBatch.from_arrays(arrays, names=list(NODE_FIELDS))


def _shred_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    warnings.simplefilter("ignore", SyntaxWarning)
    gc.disable()  # trees and rows hold no cycles; reference counts free them
    try:
        rows = _Rows()
        for batch in batches:
            for file, source in zip(batch["file"].to_pylist(), batch["source"].to_pylist()):
                try:
                    tree = ast.parse(source, filename=file or _UNKNOWN)
                except SyntaxError as problem:
                    rows.add_error(file, "syntax", problem)
                except (ValueError, RecursionError, MemoryError) as problem:
                    rows.add_error(file, "other", problem)
                else:
                    rows.add_tree(file, tree)
                if len(rows) >= _BATCH_ROWS:
                    yield rows.batch()
                    rows = _Rows()
        if len(rows):
            yield rows.batch()
    finally:
        gc.enable()


def shred(sources: DataFrame) -> DataFrame:
    """Every node of every file, and one `ord = -1` row per file that fails to parse."""
    wanted = sources.select("file", "source").filter(F.col("source").isNotNull())
    return wanted.mapInArrow(_shred_batches, NODE_SCHEMA)


def nodes(shredded: DataFrame) -> DataFrame:
    return shredded.filter(F.col("ord") >= 0).select(*NODE_COLUMNS)


def parse_failures(shredded: DataFrame) -> DataFrame:
    """failures(file, kind, message, full, line, offset, text)."""
    return shredded.filter(F.col("ord") == -1).select("file", "error.*")


def node_histogram(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("file", "node_type").agg(F.count(F.lit(1)).alias("n"))


def node_type_map(nodes: DataFrame) -> DataFrame:
    pairs = F.sort_array(F.collect_list(F.struct("node_type", "n")))
    return node_histogram(nodes).groupBy("file").agg(F.map_from_entries(pairs).alias("node_types"))


def top_node_types(nodes: DataFrame, limit: int = 10) -> DataFrame:
    """Most frequent node types per file; ties in breadth-first order of first sight."""
    # depth, then position, as one number: a struct would turn the hash aggregate into a sort of all nodes
    first = F.col("depth").cast("long") * (1 << 32) + F.col("ord")
    counted = nodes.groupBy("file", "node_type").agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("seen"))
    ranking = Window.partitionBy("file").orderBy(F.desc("n"), "seen")
    return (
        counted.withColumn("rank", F.row_number().over(ranking))
        .filter(F.col("rank") <= limit)
        .select("file", "rank", "node_type", "n")
    )


def syntax_stats(nodes: DataFrame) -> DataFrame:
    kind = F.col("node_type")

    def tally(*kinds):
        return F.count_if(kind.isin(*kinds))

    return nodes.groupBy("file").agg(
        F.count(F.lit(1)).alias("total_nodes"),
        tally("FunctionDef", "AsyncFunctionDef").alias("functions"),
        tally("ClassDef").alias("classes"),
        tally("Import", "ImportFrom").alias("imports"),
        tally("Call").alias("calls"),
        tally("Assign", "AnnAssign").alias("assignments"),
        tally("If").alias("if_statements"),
        tally("For", "While").alias("loops"),
        tally("Try").alias("try_blocks"),
    )


def bound_name() -> Column:
    """Name an alias row binds: its `as` name, else the (first part of the) imported name."""
    plain = F.col("parent_type") == "Import"
    return F.coalesce("asname", F.when(plain, F.substring_index("name", ".", 1)).otherwise(F.col("name")))


def imports(nodes: DataFrame) -> DataFrame:
    """imports(file, ord, alias_idx, module, bound, lineno), one row per binding."""
    package = F.when(F.col("parent_type") == "ImportFrom", F.coalesce("module", F.lit(""))).otherwise("")
    return nodes.filter(F.col("node_type") == "alias").select(
        "file",
        F.col("parent").alias("ord"),
        F.col("field_idx").alias("alias_idx"),
        F.when(package == "", F.col("name")).otherwise(F.concat_ws(".", package, "name")).alias("module"),
        bound_name().alias("bound"),
        F.col("stmt_line").alias("lineno"),
    )


def string_literals(nodes: DataFrame) -> DataFrame:
    """Every string constant, docstrings and f-string parts included."""
    literal = (F.col("node_type") == "Constant") & (F.col("const_kind") == "str")
    return nodes.filter(literal).select("file", "ord", "lineno", F.col("const_str").alias("text"))


def calls(nodes: DataFrame) -> DataFrame:
    return nodes.filter(F.col("node_type") == "Call").select(
        "file", "ord", "lineno", F.col("dotted").alias("call_name")
    )


def call_args(nodes: DataFrame) -> DataFrame:
    """Direct positional and keyword arguments of each call."""
    direct = (F.col("parent_type") == "Call") & F.col("field").isin("args", "keywords")
    return nodes.filter(direct).select(
        "file",
        F.col("parent").alias("call_ord"),
        "ord",
        F.col("field").alias("arg_kind"),
        F.col("field_idx").alias("arg_idx"),
        "node_type",
        "name",
        "dotted",
        "op",
        "const_kind",
        "const_str",
    )
