"""Name resolution and flow on random programs, against SQL over spans.

The expected rows come from a separate tree walk and from the definitions
written as intervals: a scope or owner is the innermost span around a node, a
function's count starts at the latest same-named entry before its end.
"""

import ast
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks.oracles import _walk
from srcweave.functions import vocab
from srcweave.operators import flow, symbols, syntax
from srcweave.plans.analysis import Analysis

NAMES = ["a", "b", "f", "g", "print", "len"]


def _block(rng, depth):
    pad = "    " * depth
    lines = []
    for _ in range(rng.randint(1, 4)):
        n, m = rng.choice(NAMES), rng.choice(NAMES)
        kind = rng.randint(0, 13 if depth < 4 else 7)
        if kind <= 1:
            lines.append(f"{pad}{n} = {m}")
        elif kind == 2:
            lines.append(f"{pad}{n} = {m} = {rng.choice(['1', 'a or b', '[f for f in g]'])}")
        elif kind == 3:
            lines.append(f"{pad}import {n}, {m}")
        elif kind == 4:
            lines.append(f"{pad}return {n}" if depth and rng.random() < 0.7 else f"{pad}{n}({m}, lambda {n}: {n})")
        elif kind == 5:
            lines.append(f"{pad}from {n}.x import ({m} as {n},\n{pad}    {m})")
        elif kind == 6:
            lines.append(f"{pad}{n} += {m}")
        elif kind == 7:
            lines.append(f"{pad}pass")
        elif kind <= 10:
            params = rng.sample(NAMES, rng.randint(0, 2))
            deco = f"{pad}@{m}\n" if rng.random() < 0.2 else ""
            word = "async def" if rng.random() < 0.15 else "def"
            ret = rng.choice(["", "", " -> None", f" -> {m}", " -> a or b"])
            lines.append(f"{deco}{pad}{word} {n}({', '.join(params)}){ret}:\n{_block(rng, depth + 1)}")
        elif kind == 11:
            lines.append(f"{pad}class {n}({m}):\n{_block(rng, depth + 1)}")
        else:
            head = rng.choice(["if {}:", "while {} and a:", "for b in {}:", "with {} as a:", "async with {} as a:"])
            if head.startswith("async"):
                head = head[6:]
            lines.append(f"{pad}{head.format(m)}\n{_block(rng, depth + 1)}")
    return "\n".join(lines)


@pytest.fixture(scope="module")
def programs():
    rng = random.Random(7)
    found = {}
    while len(found) < 150:
        source = _block(rng, 0) + "\n"
        try:
            ast.parse(source)
        except SyntaxError:
            continue
        found[f"p{len(found)}.py"] = source
    return found


@pytest.fixture(scope="module")
def expected(programs):
    rows = []
    for file, source in programs.items():
        walked = _walk(ast.parse(source))
        for ord_, (node, parent, field, index, depth, end) in enumerate(walked):
            stmt = ord_
            while stmt >= 0 and not isinstance(walked[stmt][0], ast.stmt):
                stmt = walked[stmt][1]
            name = getattr(node, "id", None) or getattr(node, "arg", None) or getattr(node, "name", None)
            rows.append((file, ord_, parent, end, field, index, type(node).__name__,
                         None if parent < 0 else type(walked[parent][0]).__name__, name,
                         type(getattr(node, "ctx", None)).__name__, getattr(node, "asname", None),
                         getattr(node, "lineno", None), None if stmt < 0 else walked[stmt][0].lineno))
    nodes = pd.DataFrame(rows, columns="file ord parent end_ord field idx kind above name ctx asname line stmt_line".split())
    con = duckdb.connect()
    con.register("nodes", nodes.astype({"line": "Int64", "stmt_line": "Int64"}))
    con.execute("CREATE TABLE builtins AS SELECT unnest(?) AS name", [vocab.BUILTINS])
    con.execute("""
CREATE TABLE scopes AS SELECT * FROM nodes WHERE kind IN ('Module', 'FunctionDef', 'ClassDef');
CREATE TABLE home AS SELECT n.file, n.ord, max(s.ord) AS scope FROM nodes n JOIN scopes s
  ON s.file = n.file AND s.ord < n.ord AND n.ord <= s.end_ord GROUP BY ALL;
CREATE TABLE defs AS
  SELECT file, scope, name, 'variable' AS kind, parent AS ord, idx AS sub, stmt_line AS line FROM nodes JOIN home USING (file, ord)
    WHERE above = 'Assign' AND field = 'targets' AND kind = 'Name'
  UNION ALL SELECT file, scope, coalesce(asname, split_part(name, '.', 1)), 'import', parent, idx, stmt_line
    FROM nodes JOIN home USING (file, ord) WHERE kind = 'alias'
  UNION ALL SELECT file, scope, name, CASE kind WHEN 'ClassDef' THEN 'class' ELSE 'function' END, ord, 0, line
    FROM nodes JOIN home USING (file, ord) WHERE kind IN ('FunctionDef', 'ClassDef')
  UNION ALL SELECT a.file, d.ord, a.name, 'parameter', d.ord, a.idx, d.line FROM nodes a
    JOIN nodes g ON g.file = a.file AND g.ord = a.parent AND g.kind = 'arguments' AND a.field = 'args'
    JOIN nodes d ON d.file = g.file AND d.ord = g.parent AND d.kind = 'FunctionDef'
  UNION ALL SELECT file, 0, b.name, 'builtin', -1, 0, 0 FROM (SELECT DISTINCT file FROM nodes), builtins b;
CREATE TABLE firsts AS SELECT * FROM defs QUALIFY row_number() OVER (PARTITION BY file, scope, name ORDER BY ord, sub) = 1;
CREATE TABLE functions AS SELECT * FROM nodes WHERE kind = 'FunctionDef';
CREATE TABLE owned AS SELECT n.file, n.ord, n.kind, coalesce(max_by(f.name, f.ord), '<module>') AS owner FROM nodes n
  LEFT JOIN functions f ON f.file = n.file AND f.ord < n.ord AND n.ord <= f.end_ord
  WHERE n.kind IN ('If', 'For', 'While', 'With', 'Try', 'BoolOp', 'Return') GROUP BY n.file, n.ord, n.kind;
CREATE TABLE resets AS SELECT d.*, max(r.ord) AS reset FROM functions d
  JOIN functions r ON r.file = d.file AND r.name = d.name AND r.ord <= d.end_ord GROUP BY ALL
""")
    return con


@pytest.fixture(scope="module")
def work(sources_of, programs):
    analysis = Analysis(sources_of(programs), partitions=4)
    yield analysis
    analysis.release()


def _rows(con, sql):
    return sorted(con.execute(sql).fetchall(), key=str)


def _collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_resolution(work, expected):
    got = _collected(work.resolved.select("file", "ord", "name", "scope_id"))
    wanted = _rows(expected, """
SELECT u.file, u.ord, u.name, max(CASE WHEN d.ord < u.ord THEN s.ord END) FROM nodes u
JOIN scopes s ON s.file = u.file AND s.ord < u.ord AND u.ord <= s.end_ord
LEFT JOIN firsts d ON d.file = u.file AND d.scope = s.ord AND d.name = u.name
WHERE u.kind = 'Name' AND u.ctx = 'Load' GROUP BY u.file, u.ord, u.name""")  # fmt: skip
    assert got == wanted and any(r[3] is None for r in got) and any(r[3] for r in got)


def test_duplicates(work, expected):
    got = _collected(symbols.duplicates(work.define_events).select("file", "lineno", "code", "message"))
    wanted = _rows(expected, """
SELECT d.file, d.line, 'DUPLICATE_' || upper(d.kind),
  upper(d.kind[1]) || d.kind[2:] || ' ''' || d.name || ''' already defined at line ' || f.line
FROM defs d JOIN firsts f USING (file, scope, name)
WHERE d.kind IN ('import', 'function', 'class') AND (d.ord, d.sub) > (f.ord, f.sub)""")  # fmt: skip
    assert got == wanted and len(got) > 50


def test_unused_parameters(work, expected):
    found = symbols.unused_parameters(work.nodes, work.first_definitions, work.resolved)
    got = _collected(found.select("file", "emit_key.pos", "emit_key.sub", "message"))
    wanted = _rows(expected, """
WITH used AS (
  SELECT u.file, u.name, max(CASE WHEN d.ord < u.ord THEN s.ord END) AS scope FROM nodes u
  JOIN scopes s ON s.file = u.file AND s.ord < u.ord AND u.ord <= s.end_ord
  LEFT JOIN firsts d ON d.file = u.file AND d.scope = s.ord AND d.name = u.name
  WHERE u.kind = 'Name' AND u.ctx = 'Load' GROUP BY u.file, u.ord, u.name)
SELECT p.file, f.end_ord, 2 + p.sub, 'Parameter ''' || p.name || ''' is never used' FROM defs p
JOIN functions f ON f.file = p.file AND f.ord = p.ord
WHERE p.kind = 'parameter' AND NOT EXISTS (
  SELECT 1 FROM used u WHERE u.file = p.file AND u.scope = p.scope AND u.name = p.name)""")  # fmt: skip
    assert got == wanted and len(got) > 20


def test_complexity_and_returns(work, expected):
    got = _collected(flow.complexity(work.nodes).select("file", "def_ord", "name", "complexity", "has_return"))
    wanted = _rows(expected, """
SELECT d.file, d.ord, d.name, 1 + count(*) FILTER (o.kind <> 'Return'), count(*) FILTER (o.kind = 'Return') > 0
FROM resets d LEFT JOIN owned o ON o.file = d.file AND o.owner = d.name AND o.ord > d.reset AND o.ord <= d.end_ord
GROUP BY d.file, d.ord, d.name""")  # fmt: skip
    assert got == wanted and any(r[3] > 3 for r in got)


def test_final_complexity(work, expected):
    got = _collected(flow.final_complexity(work.nodes))
    wanted = _rows(expected, """
WITH last AS (SELECT file, name, max(ord) AS reset FROM functions GROUP BY ALL
  UNION ALL SELECT DISTINCT file, '<module>', -1 FROM owned WHERE owner = '<module>' AND kind <> 'Return')
SELECT l.file, l.name, 1 + count(o.ord) FROM last l LEFT JOIN owned o
  ON o.file = l.file AND o.owner = l.name AND o.ord > l.reset AND o.kind <> 'Return' GROUP BY l.file, l.name""")  # fmt: skip
    assert got == wanted


def test_summary_symbols(work, expected):
    got = _collected(work.summary().select("file", "scopes_created", "symbols_tracked"))
    wanted = _rows(expected, """
SELECT f.file, (SELECT count(*) FROM scopes s WHERE s.file = f.file), count(*) FROM firsts f GROUP BY f.file""")  # fmt: skip
    assert got == wanted


def test_symbol_table_by_one_scan(work):
    apart = symbols.symbol_table(work.nodes, work.first_definitions, work.resolved)
    got, wanted = (sorted(map(str, df.select(*apart.columns).collect())) for df in (work.symbol_table(), apart))
    assert got == wanted and len(got) > 1000


def test_summary_of_names(work):
    unused = symbols.unused_variables(work.nodes, work.first_definitions, work.resolved).groupBy("file").count()
    assert _collected(work.summary().select("file", "unused_variables")) == _collected(unused)
    aliases = {r["file"]: r["count"] for r in work.nodes.filter("node_type = 'alias'").groupBy("file").count().collect()}
    for row in work.summary().select("file", "imports").collect():
        assert row["imports"] == aliases.get(row["file"], 0)


def test_phase_report_equals_single_statistics(work):
    reports = work.phase_report().select(
        F.col("filename").alias("file"), "phase2_syntax_analysis.*", "phase3_semantic_analysis.functions_analyzed"
    )
    stats = syntax.syntax_stats(work.nodes)
    assert _collected(reports.select(*stats.columns)) == _collected(stats)
    owners = flow.final_complexity(work.nodes).groupBy("file").count()
    some = reports.filter("functions_analyzed > 0").select("file", "functions_analyzed")
    assert _collected(some) == _collected(owners)
    maps = {r["file"]: r["node_types"] for r in reports.select("file", "node_types").collect()}
    assert maps == {r["file"]: r["node_types"] for r in syntax.node_type_map(work.nodes).collect()}
