"""DuckDB SQL giving the expected rows of each query in `checks.queries`.

Three kinds: text operators restated in SQL over the given tables; node
relations of the generated corpus, stored per template and joined to `orders`;
and findings of the generated corpus written down by hand per template.
"""

from __future__ import annotations

import ast

from checks.corpus import BODY, N_SIZES, TEMPLATES
from srcweave.functions import vocab


def quote(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + value.replace("'", "''") + "'"


def values(rows) -> str:
    return ",\n".join("(" + ", ".join(quote(v) for v in row) + ")" for row in rows)


def any_of(expression: str, words) -> str:
    return "(" + " OR ".join(f"contains({expression}, {quote(w)})" for w in words) + ")"


def in_list(words) -> str:
    return "(" + ", ".join(quote(w) for w in words) + ")"


# -- text: tokens ------------------------------------------------------------

_DIGITS = (
    r"[\p{Nd}²³¹፩-፱᧚⁰⁴-⁹₀-₉①-⑨⑴-⑼⒈-⒐⓪⓵-⓽⓿❶-❾➀-➈➊-➒]"
)
_BRANCHES = [
    r"\n",
    r"#[^\n]*",
    r'"""(?:"{0,2}(?:[^"\\]|\\[\s\S]))*(?:"""|"{0,2}\\?\z)',
    r"'''(?:'{0,2}(?:[^'\\]|\\[\s\S]))*(?:'''|'{0,2}\\?\z)",
    r'"(?:[^"\\]|\\[\s\S])*(?:"|\\?\z)',
    r"'(?:[^'\\]|\\[\s\S])*(?:'|\\?\z)",
    rf"(?:0(?:[bB][01_]*|[oO][0-7_]*|[xX](?:{_DIGITS}|[a-fA-F_])*|\.{_DIGITS}*)?|{_DIGITS}(?:{_DIGITS}|_)*(?:\.{_DIGITS}*)?)"
    rf"(?:[eE][+-]?{_DIGITS}*)?[jJ]?",
    r"[\p{L}_][\p{L}\p{N}_]*",
    r"\.\.\.|//=|\*\*=|<<=|>>=|==|!=|<=|>=|<<|>>|\*\*|//|[+\-*/%&|^@:]=|->",
    r"[^ \t\r]",
]
_LEXEME = r"[ \t\r]*(?:" + "|".join(_BRANCHES) + r")|[ \t\r]+"
_BLANKS = "' ' || chr(9) || chr(13)"
_TYPES = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in vocab.OPERATORS.items())


def tokens_sql(source: str) -> str:
    """CTEs ending in `tokens(file, pos, type, value, line, col)` of a (file, source) query."""
    return f"""
WITH src AS ({source}),
found AS (SELECT file, regexp_extract_all(source, {quote(_LEXEME)}) AS ls FROM src WHERE source IS NOT NULL),
ended AS (
  SELECT file, CASE WHEN len(ls) > 0 AND ltrim(ls[len(ls)], {_BLANKS}) = '' THEN ls ELSE list_append(ls, '') END AS ls
  FROM found),
lex AS (
  SELECT file, unnest(ls) AS lexeme, generate_subscripts(ls, 1) - 1 AS pos FROM ended),
val AS (SELECT *, ltrim(lexeme, {_BLANKS}) AS value FROM lex),
off AS (
  SELECT *, coalesce(sum(length(lexeme)) OVER w, 0) AS start_off,
         coalesce(sum(length(value) - length(replace(value, chr(10), ''))) OVER w, 0) AS nl
  FROM val WINDOW w AS (PARTITION BY file ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lines AS (
  SELECT *, coalesce(max(CASE WHEN contains(value, chr(10))
             THEN start_off + length(lexeme) - strpos(reverse(value), chr(10)) + 1 END) OVER w, 0) AS line_start
  FROM off WINDOW w AS (PARTITION BY file ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
tokens AS (
  SELECT file, pos::INT AS pos,
    CASE WHEN value = '' THEN 'EOF' WHEN value = chr(10) THEN 'NEWLINE' WHEN value[1] = '#' THEN 'COMMENT'
         WHEN value[1] IN ('"', '''') THEN 'STRING'
         WHEN regexp_matches(value[1], {quote(_DIGITS)}) THEN 'NUMBER'
         WHEN regexp_matches(value[1], '[\\p{{L}}_]')
           THEN CASE WHEN value IN {in_list(vocab.KEYWORDS)} THEN 'KEYWORD' ELSE 'IDENTIFIER' END
         ELSE CASE value {_TYPES} ELSE 'ERROR' END END AS type,
    value, (1 + nl)::INT AS line,
    (1 + start_off + length(lexeme) - length(value) - line_start)::INT AS col
  FROM lines)
"""


DOCUMENTS = "SELECT doc_id::VARCHAR AS file, text AS source FROM documents"
PAGES = "SELECT page_id::VARCHAR AS file, html AS source FROM pages"
TALKS = "SELECT conv_id::VARCHAR || '/' || turn::VARCHAR AS file, text AS source FROM conversations"

# -- generated corpus --------------------------------------------------------

FILES = """
files AS (
  SELECT o_orderkey AS k, o_orderkey % 17 AS t, (o_orderkey // 17) % 10 AS m,
         o_orderkey::VARCHAR AS ks, 'src/f' || o_orderkey::VARCHAR || '.py' AS file,
         CASE WHEN o_orderkey % 17 = 14 THEN 1400 + (o_orderkey // 17) % 10 ELSE 100 * (o_orderkey % 17) END AS v
  FROM orders)"""

SOURCES = f"""
templates(t, body) AS (VALUES {values((t, text) for t, text in TEMPLATES.items())}),
corpus AS (
  SELECT file, replace(replace(replace(body, '{{k8}}', lpad(ks, 8, '0')), '{{k}}', ks),
                       '{{body}}', repeat({quote(BODY)}, m::INT)) AS source
  FROM files JOIN templates USING (t))"""

CORPUS = f"WITH {FILES.strip()}, {SOURCES.strip()} SELECT file, source FROM corpus"
_MARK = "__k__"


def _variants():
    for t, text in TEMPLATES.items():
        if t == 15:
            continue  # does not parse
        for m in range(N_SIZES) if "{body}" in text else [0]:
            yield 100 * t + m, text.replace("{body}", BODY * m)


def _walk(node, parent=None, field=None, index=0, depth=0, out=None):
    """Nodes of a template, depth first, as [node, parent position, …]."""
    out = [] if out is None else out
    here = len(out)
    out.append([node, -1 if parent is None else parent, field, index, depth, here])
    for name, value in ast.iter_fields(node):
        children = value if isinstance(value, list) else [value]
        for i, child in enumerate(children):
            if isinstance(child, ast.AST):
                _walk(child, here, name, i, depth + 1, out)
    out[here][5] = len(out) - 1
    return out


def _literals(node):
    constant = node.value if isinstance(node, ast.keyword) else node
    if not isinstance(constant, ast.Constant):
        return None, None
    value = constant.value
    if value is None or isinstance(value, bool):
        return str(value), None
    return type(value).__name__, value if isinstance(value, str) else None


def _chain(node):
    if isinstance(node, ast.Name):
        return node.id
    if isinstance(node, ast.Attribute):
        below = _chain(node.value)
        return None if below is None else f"{below}.{node.attr}"
    return None


def _template_nodes():
    for v, text in _variants():
        named, narrow, wide = (
            _walk(ast.parse(text.replace("{k8}", "x" * 8 if fill == _MARK else "0" * 8).replace("{k}", fill)))
            for fill in (_MARK, "1", "22")
        )
        for ord_, ((node, parent, field, index, depth, end), a, b) in enumerate(zip(named, narrow, wide)):
            above = None if parent < 0 else named[parent][0]
            kind, literal = _literals(node)
            dotted = None
            if isinstance(node, ast.Name) or (isinstance(node, ast.Attribute) and not isinstance(above, ast.Attribute)):
                dotted = _chain(node) or "<unknown>"
            elif isinstance(node, ast.Call):
                dotted = _chain(node.func) or "<unknown>"
            elif isinstance(node, ast.keyword) and isinstance(node.value, ast.Call):
                dotted = _chain(node.value.func) or "<unknown>"
            name = getattr(node, "name", None) or getattr(node, "id", None) or getattr(node, "attr", None)
            name = name or getattr(node, "arg", None)
            if isinstance(node, ast.Call):
                name = getattr(node.func, "id", None) or getattr(node.func, "attr", None)
            ca, cb = getattr(a[0], "col_offset", None), getattr(b[0], "col_offset", None)
            op, ctx = getattr(node, "op", None), getattr(node, "ctx", None)
            stmt = ord_
            while stmt >= 0 and not isinstance(named[stmt][0], ast.stmt):
                stmt = named[stmt][1]
            yield (
                v, ord_, parent, end, depth, field, index, None if above is None else type(above).__name__,
                type(node).__name__, getattr(node, "lineno", None), ca, None if ca is None else cb - ca,
                None if stmt < 0 else named[stmt][0].lineno, stmt,
                type(op).__name__ if op else None, name, dotted, type(ctx).__name__ if ctx else None,
                getattr(node, "asname", None),
                getattr(above if isinstance(node, ast.alias) else node, "module", None), kind, literal,
            )


def per_file(inner: str, **named: str) -> str:
    """A query over the template relations of `nodes_cte`, worked out per template and joined to the files at the end.

    `inner` may begin with further CTEs; `named` are columns written anew with
    the file's own key, where the template has a mark.
    """
    inner = "WITH " + inner.lstrip()[1:] if inner.lstrip().startswith(",") else inner
    anew = "".join(f", {expression} AS {column}" for column, expression in named.items())
    gone = [c for c in named if c != "col"] + ["col1", "colk"] * ("col" in named)
    rest = "r.* EXCLUDE (" + ", ".join(["file", *gone]) + ")"
    return f"{nodes_cte()}, result AS ({inner})\nSELECT f.file, {rest}{anew} FROM result r JOIN files f ON f.v = r.file"


def own(column: str) -> str:
    """A name or text of a template with the file's key in it."""
    return f"replace(r.{column}, '{_MARK}', f.ks)"


def own_text(column: str) -> str:
    """A string literal of a template with the file's key in it."""
    return f"CASE WHEN f.t = 9 THEN replace(r.{column}, 'xxxxxxxx', lpad(f.ks, 8, '0')) ELSE r.{column} END"


def nodes_cte() -> str:
    """Relations of the templates' nodes; `file` is the number of the template."""
    return f"""
WITH {FILES.strip()},
tpl(v, ord, parent, end_ord, depth, field, field_idx, parent_type, node_type, lineno, col1, colk, stmt_line,
    stmt_ord, op, name, dotted, ctx, asname, module, const_kind, const_str) AS (VALUES
{values(_template_nodes())}),
nodes AS (
  SELECT v AS file, v // 100 AS t, ord, parent, end_ord, depth, field, field_idx, parent_type, node_type, lineno,
    col1, colk, stmt_line, stmt_ord, op, name, dotted, ctx, asname, module, const_kind, const_str FROM tpl),
scopes AS (
  SELECT s.file, s.ord AS scope_id, s.end_ord, s.node_type, s.name, s.depth FROM nodes s
  WHERE s.node_type IN ('Module', 'FunctionDef', 'ClassDef')),
inner_scope AS (
  SELECT n.file, n.ord, max(s.scope_id) AS scope_id FROM nodes n
  JOIN scopes s ON s.file = n.file AND s.scope_id < n.ord AND n.ord <= s.end_ord GROUP BY ALL),
defs AS (
  SELECT file, scope_id, name, 'variable' AS kind, parent AS ord, field_idx AS sub, stmt_line AS lineno
  FROM nodes JOIN inner_scope USING (file, ord)
  WHERE parent_type = 'Assign' AND field = 'targets' AND node_type = 'Name'
  UNION ALL
  SELECT file, scope_id, coalesce(asname, CASE WHEN parent_type = 'Import' THEN split_part(name, '.', 1) ELSE name END),
         'import', parent, field_idx, stmt_line
  FROM nodes JOIN inner_scope USING (file, ord) WHERE node_type = 'alias'
  UNION ALL
  SELECT file, scope_id, name, CASE node_type WHEN 'ClassDef' THEN 'class' ELSE 'function' END, ord, 0, lineno
  FROM nodes JOIN inner_scope USING (file, ord) WHERE node_type IN ('FunctionDef', 'ClassDef')
  UNION ALL
  SELECT file, scope_id, name, 'parameter', scope_id, field_idx, stmt_line
  FROM nodes JOIN inner_scope USING (file, ord) WHERE node_type = 'arg' AND field = 'args'),
builtins(name, sub, kind) AS (VALUES {values((b, i, "function" if b[0].islower() else "variable")
                                             for i, b in enumerate(vocab.BUILTINS))}),
types AS (
  SELECT file, parent AS ord, CASE
    WHEN node_type = 'Constant' AND const_kind IN ('int', 'True', 'False') THEN 'int'
    WHEN node_type = 'Constant' AND const_kind IN ('float', 'str') THEN const_kind
    WHEN node_type = 'Constant' AND const_kind = 'None' THEN 'NoneType'
    WHEN node_type IN ('List', 'ListComp') THEN 'list'
    WHEN node_type IN ('Dict', 'DictComp') THEN 'dict'
    WHEN node_type IN ('Set', 'SetComp') THEN 'set'
    WHEN node_type = 'Tuple' THEN 'tuple' WHEN node_type = 'Lambda' THEN 'function'
    WHEN node_type = 'Call' AND dotted IN ('int', 'float', 'str', 'list', 'dict', 'set') THEN dotted
    WHEN node_type = 'BinOp' AND op IN ('Add', 'Sub', 'Mult', 'Div') THEN 'numeric' END AS inferred_type
  FROM nodes WHERE parent_type = 'Assign' AND field = 'value'),
syms AS (
  SELECT file, scope_id, name, kind, ord, sub, lineno FROM defs
  QUALIFY row_number() OVER (PARTITION BY file, scope_id, name ORDER BY ord, sub) = 1),
uses AS (
  SELECT file, ord, name, lineno FROM nodes WHERE node_type = 'Name' AND ctx = 'Load'),
resolved AS (
  SELECT u.file, u.ord, u.name, u.lineno, max(CASE
    WHEN d.ord < u.ord OR (s.scope_id = 0 AND u.name IN (SELECT name FROM builtins)) THEN s.scope_id END) AS scope_id
  FROM uses u JOIN scopes s ON s.file = u.file AND s.scope_id < u.ord AND u.ord <= s.end_ord
  LEFT JOIN syms d ON d.file = u.file AND d.scope_id = s.scope_id AND d.name = u.name
  GROUP BY ALL)
"""


# Findings per template, in order of emission: (t, smallest m, largest m, line,
# code, rule or null, 1 for a bare-head match, symbols, name used in the message).
_G, _U, _S = "GRAMMAR_VULN", "UNDEFINED_VARIABLE", "SQL_SYNTAX_ERROR"
EXPECTED = [
    (0, 0, 9, 2, _G, 0, 1, "execute", None),
    (1, 0, 9, 2, _G, 0, 0, "execute concat", None),
    (1, 0, 9, 2, _G, 3, 0, "sql_var concat_op user_input", None),
    (2, 0, 9, 2, _G, 1, 0, "execute format", None),
    (3, 0, 9, 2, _G, 2, 0, "execute fstring", None),
    (4, 0, 9, 3, _G, 6, 0, "exec b64decode", None),
    (4, 0, 9, 3, _U, None, 0, None, "Variable 'exec' used before definition"),
    (4, 0, 9, 4, _G, 7, 1, "eval", None),
    (4, 0, 9, 4, _U, None, 0, None, "Variable 'eval' used before definition"),
    (5, 0, 9, 3, _G, 8, 0, "subprocess shell_true concat", None),
    (5, 0, 9, 5, _G, 10, 1, "subprocess", None),
    (6, 0, 9, 3, _G, 9, 0, "os.system format", None),
    (6, 0, 9, 4, _G, 9, 1, "os.system", None),
    (7, 0, 9, 3, _G, 11, 0, "pickle.load untrusted", None),
    (7, 0, 9, 4, _G, 12, 0, "pickle.load user_input", None),
    (8, 0, 9, 2, _G, 13, 0, "open concat", None),
    (8, 0, 9, 3, _G, 14, 0, "open user_input", None),
    (8, 0, 9, 4, _G, 15, 0, "open dotdot", None),
    (8, 0, 9, 5, _G, 13, 1, "open", None),
    (9, 0, 9, 1, _G, 16, 0, "assign secret_pattern", None),
    (9, 0, 9, 2, _G, 17, 0, "assign aws_key", None),
    (9, 0, 9, 3, _G, 18, 0, "assign long_token", None),
    (9, 0, 9, 4, _G, 16, 1, "assign", None),
    (10, 0, 9, 3, _G, 19, 0, "hashlib weak_algo", None),
    (10, 0, 9, 4, _G, 19, 0, "hashlib weak_algo", None),
    (10, 0, 9, 5, _G, 20, 0, "random token_gen", None),
    (10, 0, 9, 6, _G, 19, 1, "hashlib", None),
    (11, 0, 9, 3, _G, 22, 0, "requests verify_false", None),
    (11, 0, 9, 4, _G, 23, 0, "urllib no_verify", None),
    (11, 0, 9, 5, _G, 23, 1, "urllib", None),
    (11, 0, 9, 6, _G, 22, 1, "requests", None),
    (12, 0, 9, 1, _S, None, 0, None, "SQL syntax error: 'SELCT' should be 'SELECT'"),
    (12, 0, 9, 1, _S, None, 0, None, "SQL syntax error: 'FORM' should be 'FROM'"),
    (12, 0, 9, 1, _S, None, 0, None, "SQL syntax error: 'INSERTINTO' should be 'INSERT INTO'"),
    (12, 0, 9, 1, _S, None, 0, None, "SQL syntax error: Missing space (should be 'ORDER BY')"),
    (12, 0, 9, 1, _S, None, 0, None, "SQL syntax error: Missing space in 'DELETEFROM' (should be 'DELETE FROM')"),
    (12, 0, 9, 1, _S, None, 0, None,
     "SQL syntax error: Missing space in 'SELECTALL' (should be 'SELECT FROM' or 'SELECT ALL')"),
    (12, 0, 9, 1, _S, None, 0, None, "SQL syntax error: Missing space (should be 'GROUP BY')"),
    (13, 0, 9, 2, "DUPLICATE_IMPORT", None, 0, None, "Import 'os' already defined at line 1"),
    (13, 0, 9, 4, _U, None, 0, None, "Variable 'y' used before definition"),
    (13, 0, 9, 7, _U, None, 0, None, "Variable 'i' used before definition"),
    (13, 0, 9, 3, "MISSING_RETURN", None, 0, None, "Function 'g__k__' may be missing return statement"),
    (13, 0, 9, 3, "UNUSED_PARAMETER", None, 0, None, "Parameter 'b' is never used"),
    (13, 0, 9, 8, "DUPLICATE_FUNCTION", None, 0, None, "Function 'g__k__' already defined at line 3"),
    (13, 0, 9, 10, "DUPLICATE_CLASS", None, 0, None, "Class 'g__k__' already defined at line 3"),
    (13, 0, 9, 11, "UNUSED_PARAMETER", None, 0, None, "Parameter 'self' is never used"),
    (14, 4, 6, 1, "HIGH_COMPLEXITY", None, 0, "WARNING", "Function 'c__k__' complexity=__c__ (>= 8)"),
    (14, 7, 9, 1, "HIGH_COMPLEXITY", None, 0, "ERROR", "Function 'c__k__' complexity=__c__ (>= 15)"),
    (15, 0, 9, 1, "SYNTAX_ERROR", None, 0, None, "Syntax error while parsing"),
]
_WARNINGS = ("DUPLICATE_IMPORT", "UNUSED_PARAMETER", "MISSING_RETURN")
# Suspicious words per template (with repeats, in order).
HITS = {
    0: "execute", 1: "execute", 2: "execute", 3: "execute",
    4: "base64 exec base64 b64decode eval",
    5: "subprocess subprocess run shell subprocess run subprocess call",
    7: "pickle pickle load pickle loads",
    8: "open open open open",
    10: "hashlib random hashlib md5 hashlib random hashlib",
    11: "requests ssl urllib request requests get verify urllib request ssl urllib request requests post",
}


def _expected_rows():
    rules = {p[0]: p for p in vocab.PRODUCTIONS}
    states = {seq: s for seq, _, s in vocab.ACCEPTED}
    for i, (t, lo, hi, line, code, prod, bare, extra, message) in enumerate(EXPECTED):
        if code == _G:
            _, rhs, severity, text = rules[prod]
            yield (t, lo, hi, i, line, code, "Grammar-based detection: " + text, severity,
                   " -> ".join(rhs.split()), extra, "" if bare else "0,200", prod, bare,
                   ",".join(map(str, states[extra])))
        else:
            severity = extra or ("WARNING" if code in _WARNINGS else "ERROR")
            yield (t, lo, hi, i, line, code, message, severity, None, None, None, None, bare, None)


FINDINGS_CTE = f"""
WITH {FILES.strip()},
expected(t, lo, hi, i, lineno, code, message, severity, pattern, tokens, parse_stack, prod, bare, states) AS (VALUES
{values(_expected_rows())}),
hits(t, n, words) AS (VALUES {values((t, len(w.split()), w) for t, w in HITS.items())}),
findings AS (
  SELECT file, k, e.t, i, lineno, code, replace(replace(message, '__k__', ks), '__c__', (1 + 2 * m)::VARCHAR) AS message,
         severity, pattern, tokens, parse_stack, prod, bare, states
  FROM files JOIN expected e ON e.t = files.t AND files.m BETWEEN e.lo AND e.hi)
"""


def lint_sql(source: str, extra: dict | None = None) -> str:
    """CTEs ending in `lint(file, word_idx, word, message)` of a (file, source) query."""
    typos = {**vocab.SQL_TYPOS, **(extra or {})}
    return f"""
WITH src AS ({source}),
gated AS (SELECT file, upper(replace(source, 'ß', 'SS')) AS u FROM src WHERE {any_of('upper(source)', vocab.SQL_KEYWORDS)}),
listed AS (
  SELECT file, list_filter(regexp_split_to_array(u, '[\\s\\x{{0B}}\\x{{1C}}-\\x{{1F}}\\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+'),
                     lambda w: w <> '') AS ws FROM gated),
words AS (
  SELECT file, (generate_subscripts(ws, 1) - 1)::INT AS word_idx, trim(unnest(ws), '(),;''"') AS word FROM listed),
typos(bad, fix) AS (VALUES {values(typos.items())}),
lint AS (
  SELECT file, word_idx, word, 'SQL syntax error: ' || CASE
    WHEN fix IS NOT NULL THEN '''' || word || ''' should be ''' || fix || ''''
    WHEN contains(word, 'SELECTFROM') OR contains(word, 'SELECTALL')
      THEN 'Missing space in ''' || word || ''' (should be ''SELECT FROM'' or ''SELECT ALL'')'
    WHEN contains(word, 'INSERTINTO') THEN 'Missing space in ''' || word || ''' (should be ''INSERT INTO'')'
    WHEN contains(word, 'DELETEFROM') THEN 'Missing space in ''' || word || ''' (should be ''DELETE FROM'')'
    WHEN contains(word, 'ORDERBY') THEN 'Missing space (should be ''ORDER BY'')'
    WHEN contains(word, 'GROUPBY') THEN 'Missing space (should be ''GROUP BY'')' END AS message
  FROM words LEFT JOIN typos ON bad = word)
"""


ALL_TEXT = f"""
SELECT 'd' || file AS file, source FROM ({DOCUMENTS}) UNION ALL
SELECT 'p' || file, source FROM ({PAGES}) UNION ALL
SELECT 'c' || file, source FROM ({TALKS}) UNION ALL
SELECT 'k' || c_custkey::VARCHAR, 'insertinto' || c_name || ' values' FROM customer UNION ALL
SELECT file, source FROM ({CORPUS})"""


def oracle_sql() -> dict[str, str]:
    nodes, found = nodes_cte(), FINDINGS_CTE
    q: dict[str, str] = {}

    # sources and sinks
    q["src2_decode_sources"] = """
SELECT doc_id::VARCHAR AS file, md5(text) AS ignored_md5, CASE WHEN doc_id % 3 <> 0 THEN md5(replace(replace(text,
  chr(13) || chr(10), chr(10)), chr(13), chr(10))) END AS strict_md5, doc_id % 3 = 0 AS failed FROM documents"""
    q["src3_error_rows"] = """
SELECT doc_id::VARCHAR AS file, NULL::VARCHAR AS code, NULL::VARCHAR AS severity, true AS has_error
FROM documents WHERE doc_id % 5 = 0"""
    q["src4_source_table"] = CORPUS
    # each rule finding's trace as text
    shown = """pattern || '|VULN|' || list_aggregate(list_transform(range(1, len(string_split(tokens, ' ')) + 1),
    lambda i: 'SHIFT:' || string_split('0,' || states, ',')[i] || ':' || array_to_string(string_split(tokens, ' ')[i:], ' ') || ' $'),
    'string_agg', '|') || '|REDUCE:' || string_split('0,' || states, ',')[len(string_split(tokens, ' ')) + 1] || ':$'"""
    q["e2_upload_documents"] = found + f"""
, {SOURCES.strip()},
per AS (SELECT file, string_agg(lineno::VARCHAR || '|' || code || '|' || severity || '|' || message || '|' || coalesce(pattern, '-')
    || '|-|-|' || coalesce(tokens, '-') || '|' || coalesce(parse_stack, '-'), ';' ORDER BY i) AS found,
    coalesce(string_agg(string_split(file, '/')[-1] || '|' || {shown}, ';' ORDER BY i) FILTER (prod IS NOT NULL), '') AS traces
  FROM findings WHERE code <> 'SYNTAX_ERROR' GROUP BY file)
SELECT string_split(c.file, '/')[-1] AS filename, CASE WHEN t <> 15 THEN md5(source) END AS content_md5,
  CASE WHEN t <> 15 THEN coalesce(found, '') END AS findings, CASE WHEN t <> 15 THEN coalesce(traces, '') END AS traces,
  CASE WHEN t = 15 THEN 'Syntax error in uploaded file: invalid syntax (f' || ks || '.py, line 1)' END AS error
FROM corpus c JOIN files USING (file) LEFT JOIN per USING (file)"""
    q["snk1_findings_json"] = found + f"""
SELECT file AS filename, string_agg(message, ';' ORDER BY i) AS messages, string_agg(severity, ',' ORDER BY i) AS severities,
  coalesce(string_agg(tokens, ';' ORDER BY i) FILTER (prod IS NOT NULL), '') AS tokens,
  coalesce(string_agg(coalesce(parse_stack, ''), ';' ORDER BY i) FILTER (prod IS NOT NULL), '') AS stacks,
  coalesce(string_agg({shown}, ';' ORDER BY i) FILTER (prod IS NOT NULL), '') AS traces, count(*)::INT AS n, string_agg(code, ',' ORDER BY i) AS codes,
  string_agg(lineno::VARCHAR, ',' ORDER BY i) AS lines, coalesce(string_agg(pattern, ';' ORDER BY i), '') AS patterns
FROM findings GROUP BY file"""

    # tokens
    pick = "SELECT file, pos, type, value FROM tokens"
    q["tok1_tokenize"] = tokens_sql(DOCUMENTS) + pick
    q["tok2_comments"] = tokens_sql(PAGES) + pick + " WHERE type = 'COMMENT'"
    q["tok3_strings"] = tokens_sql(PAGES) + pick + " WHERE type = 'STRING'"
    q["tok4_numbers"] = tokens_sql(PAGES) + pick + " WHERE type = 'NUMBER'"
    q["tok5_words"] = tokens_sql(TALKS) + pick + " WHERE type IN ('KEYWORD', 'IDENTIFIER')"
    q["tok6_operators"] = tokens_sql(PAGES) + pick + f" WHERE type IN {in_list(['ERROR', *vocab.OPERATORS.values()])}"
    q["tok7_line_ends"] = tokens_sql(DOCUMENTS) + pick + " WHERE type IN ('NEWLINE', 'EOF')"
    q["tok8_positions"] = tokens_sql(PAGES) + "SELECT * FROM tokens"
    q["tok8_positions_corpus"] = tokens_sql(CORPUS) + "SELECT * FROM tokens"
    q["tok9_filter_tokens"] = tokens_sql(PAGES) + pick + " WHERE type NOT IN ('COMMENT', 'WHITESPACE')"
    stats = f"""
SELECT file, count(*) AS total_tokens, count(*) FILTER (type = 'KEYWORD') AS keywords,
  count(*) FILTER (type = 'IDENTIFIER') AS identifiers, count(*) FILTER (type = 'STRING') AS strings,
  count(*) FILTER (type = 'NUMBER') AS numbers,
  count(*) FILTER (type LIKE '%ASSIGN' OR type IN {in_list(vocab.COUNTED_OPERATORS)}) AS operators,
  count(*) FILTER (type = 'COMMENT') AS comments FROM tokens GROUP BY file"""
    q["tok10_token_stats"] = tokens_sql(DOCUMENTS) + stats
    suspicious = f" WHERE value IN {in_list(vocab.SUSPICIOUS_WORDS)}"
    q["tok11_prescreen_hits"] = tokens_sql(ALL_TEXT) + "SELECT file, pos, value FROM tokens" + suspicious
    q["tok11_prescreen_words"] = found + "SELECT file, words, n::BIGINT AS suspicious_tokens FROM files JOIN hits USING (t)"
    q["tok12_prescreen_gate"] = per_file(f"""
SELECT file, CASE WHEN t IN ({", ".join(map(str, HITS))}) THEN 'kept' ELSE 'skipped' END AS gate, count(*) AS n_nodes
FROM nodes GROUP BY ALL""")
    q["tok12_gated_findings"] = found + f"""
SELECT file, lineno, code, severity, prod FROM findings WHERE t IN ({", ".join(map(str, HITS))}) OR t = 15"""

    # syntax
    q["ast1_shred"] = per_file("""
SELECT n.file, n.ord, n.parent, n.end_ord, n.depth, n.field, n.field_idx, n.parent_type, n.node_type, n.lineno,
  n.col1, n.colk, n.stmt_ord, n.stmt_line, n.op, n.name, n.dotted, n.ctx, n.asname, n.module, n.const_kind, n.const_str,
  coalesce(string_agg(s.scope_id::VARCHAR, ',' ORDER BY s.scope_id), '0') AS scopes
FROM nodes n LEFT JOIN scopes s ON s.file = n.file AND s.scope_id < n.ord AND n.ord <= s.end_ord GROUP BY ALL""", col="(r.col1 + r.colk * (length(f.ks) - 1))::INT", name=own("name"), dotted=own("dotted"), const_str=own_text("const_str"))
    q["ast2_syntax_errors"] = found + """
SELECT file, lineno, code, severity, 'PHASE_2_SYNTAX' AS phase, lineno AS line, true AS has_error
FROM findings WHERE code = 'SYNTAX_ERROR'"""
    q["ast3_node_histogram"] = per_file("SELECT file, node_type, count(*) AS n FROM nodes GROUP BY ALL")
    q["ast3_node_type_map"] = per_file("""
SELECT file, string_agg(node_type || ':' || n::VARCHAR, ',' ORDER BY node_type || ':' || n::VARCHAR) AS node_types
FROM (SELECT file, node_type, count(*) AS n FROM nodes GROUP BY ALL) GROUP BY file""")
    q["ast4_top_node_types"] = per_file("""
, bfs AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY depth, ord) AS seen FROM nodes),
counted AS (SELECT file, node_type, count(*) AS n, min(seen) AS first_seen FROM bfs GROUP BY ALL)
SELECT file, (row_number() OVER (PARTITION BY file ORDER BY n DESC, first_seen))::INT AS rank, node_type, n FROM counted
QUALIFY rank <= 10""")
    q["ast5_syntax_stats"] = per_file("""
SELECT file, count(*) AS total_nodes, count(*) FILTER (node_type IN ('FunctionDef', 'AsyncFunctionDef')) AS functions,
  count(*) FILTER (node_type = 'ClassDef') AS classes, count(*) FILTER (node_type IN ('Import', 'ImportFrom')) AS imports,
  count(*) FILTER (node_type = 'Call') AS calls, count(*) FILTER (node_type IN ('Assign', 'AnnAssign')) AS assignments,
  count(*) FILTER (node_type = 'If') AS if_statements, count(*) FILTER (node_type IN ('For', 'While')) AS loops,
  count(*) FILTER (node_type = 'Try') AS try_blocks FROM nodes GROUP BY file""")
    q["ast6_imports"] = f"""
WITH {FILES.strip()}, imports(t, ord, alias_idx, module, bound, lineno) AS (VALUES
  (4, 1, 0, 'base64', 'base64', 1), (5, 1, 0, 'subprocess', 'subprocess', 1), (6, 1, 0, 'os', 'os', 1),
  (7, 1, 0, 'pickle', 'pickle', 1), (10, 1, 0, 'hashlib', 'hashlib', 1), (10, 1, 1, 'random', 'random', 1),
  (11, 1, 0, 'requests', 'requests', 1), (11, 1, 1, 'ssl', 'ssl', 1), (11, 1, 2, 'urllib.request', 'urllib', 1),
  (13, 1, 0, 'os', 'os', 1), (13, 3, 0, 'os', 'os', 2))
SELECT file, ord, alias_idx, module, bound, lineno FROM files JOIN imports USING (t)"""
    q["ast7_string_literals"] = per_file("""
SELECT file, ord, lineno, const_str AS text FROM nodes WHERE node_type = 'Constant' AND const_kind = 'str'""", text=own_text("text"))
    q["ast8_calls"] = per_file("""
SELECT c.file, c.ord, c.lineno, f.dotted AS call_name FROM (
  SELECT file, ord, lineno FROM nodes WHERE node_type = 'Call') c
JOIN (SELECT file, parent, coalesce(dotted, '<unknown>') AS dotted FROM nodes WHERE field = 'func') f
ON f.file = c.file AND f.parent = c.ord""", call_name=own("call_name"))
    q["ast9_call_args"] = per_file("""
SELECT a.file, a.parent AS call_ord, a.ord, a.field AS arg_kind, a.field_idx AS arg_idx, a.node_type, a.name
FROM nodes a JOIN nodes c ON c.file = a.file AND c.ord = a.parent
WHERE c.node_type = 'Call' AND a.field IN ('args', 'keywords')""", name=own("name"))

    # features
    arg = """
, c AS (SELECT file, ord, lineno, dotted FROM nodes WHERE node_type = 'Call'),
a AS (SELECT n.file, n.parent, n.ord, n.node_type, n.op, n.name, n.dotted, n.const_kind, n.const_str,
        f.node_type AS func_type, f.name AS func_name
      FROM nodes n LEFT JOIN nodes f ON f.file = n.file AND f.parent = n.ord AND f.field = 'func' AND n.node_type = 'Call'
      WHERE n.field = 'args' AND n.parent_type = 'Call'),
kw AS (SELECT k.file, k.parent, k.name, v.node_type, v.const_kind, v.dotted
       FROM nodes k JOIN nodes v ON v.file = k.file AND v.parent = k.ord WHERE k.node_type = 'keyword')
SELECT file, ord, lineno FROM c WHERE """

    def some(relation, test):
        return f"EXISTS (SELECT 1 FROM {relation} x WHERE x.file = c.file AND x.parent = c.ord AND ({test}))"

    call, name = "lower(x.dotted)", "lower(x.name)"
    is_call, is_name = "x.node_type = 'Call'", "x.node_type = 'Name'"
    text_arg = "x.node_type = 'Constant' AND x.const_kind = 'str'"
    tests = {
        "f1_has_concat": some("a", "x.node_type = 'BinOp' AND x.op = 'Add'"),
        "f2_has_format": some("a", "(x.func_type = 'Attribute' AND x.func_name = 'format') OR (x.node_type = 'BinOp' AND x.op = 'Mod')"),
        "f3_has_fstring": some("a", "x.node_type = 'JoinedStr'"),
        "f4_has_b64decode": some("a", f"{is_call} AND {any_of('x.dotted', ['b64decode', 'base64'])}"),
        "f5_is_dynamic": some("a", "x.node_type <> 'Constant'"),
        "f6_has_user_input": some("a", f"({is_call} AND {any_of(call, ['input', 'read', 'get', 'request', 'argv'])}) OR "
                                       f"({is_name} AND {any_of(name, ['input', 'user', 'request', 'data'])})"),
        "f7_shell_true": some("kw", "x.name = 'shell' AND x.const_kind = 'True'"),
        "f8_untrusted_source": some("a", f"{is_call} AND {any_of(call, ['open', 'read', 'request', 'recv', 'socket'])}"),
        "f9_has_dotdot": some("a", f"{text_arg} AND contains(x.const_str, '..')"),
        "f10_weak_algo": any_of("lower(c.dotted)", ["md5", "sha1"]) + " OR "
                         + some("a", f"{text_arg} AND lower(x.const_str) IN ('md5', 'sha1')"),
        "f11_token_gen": "contains(lower(dotted), 'random')",
        "f12_has_seed": "contains(lower(dotted), 'random') AND contains(lower(dotted), 'seed')",
        "f13_predictable_seed": some("a", f"x.node_type = 'Constant' OR ({is_call} AND contains({call}, 'time'))"),
        "f14_verify_false": some("kw", "x.name = 'verify' AND x.const_kind = 'False'"),
        "f15_no_verify": some("kw", f"x.name = 'context' AND {is_call} AND contains({call}, 'unverified')"),
    }
    for key, test in tests.items():
        q[key] = per_file(arg + test)
    secret = quote("(?i)" + vocab.SECRET_REGEX)
    q["f16_secret_pattern"] = f"""
SELECT file, true AS secret_pattern FROM ({ALL_TEXT}) WHERE regexp_matches(source, {secret})"""
    words = f"""
WITH ws AS (SELECT file, regexp_split_to_array(source, '[ \\n"]') AS w FROM ({ALL_TEXT})),
split AS (SELECT file, (generate_subscripts(w, 1) - 1)::INT AS i, unnest(w) AS word FROM ws)
SELECT file, i, word FROM split WHERE """
    q["f17_aws_key"] = words + f"regexp_matches(word, '^{vocab.AWS_KEY_REGEX}')"
    q["f18_long_token"] = words + f"regexp_full_match(word, '{vocab.LONG_TOKEN_REGEX}')"
    q["f16_f18_assign_features"] = f"""
WITH {FILES.strip()}, flags(t, ord, lineno, s, a, l) AS (VALUES
  (9, 1, 1, true, false, false), (9, 5, 2, false, true, true), (9, 9, 3, false, false, true), (9, 13, 4, false, false, false))
SELECT file, ord, lineno, s AS secret_pattern, a AS aws_key, l AS long_token FROM files JOIN flags USING (t)"""
    sides = """
SELECT b.file, b.ord, b.lineno, {test} AS {alias}
FROM (SELECT file, ord, lineno FROM nodes WHERE node_type = 'BinOp' AND op = 'Add') b
JOIN nodes x ON x.file = b.file AND x.parent = b.ord AND x.field = '{side}'"""
    q["f19_sql_left"] = per_file(sides.format(
        side="left", alias="sql_left",
        test=f"coalesce({text_arg} AND {any_of('upper(x.const_str)', vocab.QUERY_WORDS)}, false)"))
    q["f20_input_right"] = per_file(sides.format(
        side="right", alias="input_right",
        test=f"coalesce(({is_name} AND {any_of(name, ['input', 'user', 'data', 'request'])}) "
             f"OR ({is_call} AND contains({call}, 'input')), false)"))  # fmt: skip

    # rules
    matched = "SELECT file, lineno, tokens AS symbols FROM findings WHERE prod IS NOT NULL AND "
    rejected = " UNION ALL SELECT file, 4, 'subprocess concat' FROM files WHERE t = 5"
    q["r1_call_symbols"] = found + matched + "tokens NOT LIKE 'assign%' AND tokens NOT LIKE 'sql_var%'" + rejected
    q["r2_assign_symbols"] = found + matched + "tokens LIKE 'assign%'"
    q["r3_binop_symbols"] = found + matched + "tokens LIKE 'sql_var%'"
    q["r4_match_rules"] = found + """
SELECT file, lineno, tokens AS sequence, prod, bare = 1 AS fallback FROM findings WHERE prod IS NOT NULL"""
    q["r5_grammar_findings"] = found + """
SELECT file, lineno, code, message, severity, pattern, tokens, parse_stack, prod FROM findings WHERE prod IS NOT NULL"""
    q["r6_explain_match"] = found + """
, g AS (SELECT *, string_split(tokens, ' ') AS sy, string_split('0,' || states, ',') AS st FROM findings WHERE prod IS NOT NULL)
SELECT file, lineno, tokens, 'VULN' AS vulnerability, pattern, severity,
  replace(message, 'Grammar-based detection: ', '') AS message,
  array_to_string(list_transform(range(1, len(sy) + 1), lambda i: i::VARCHAR || '|SHIFT|' || st[i] || '|' || sy[i] || '|' || st[i + 1]
      || '|-|-|' || array_to_string(st[1:i], ',') || '|' || array_to_string(sy[1:i - 1], ' ') || '|' || array_to_string(sy[i:], ' ')
      || ' $|-|-|-'), ';')
    || ';' || (len(sy) + 1)::VARCHAR || '|REDUCE|' || st[len(sy) + 1] || '|-|-|VULN -> ' || replace(pattern, ' -> ', ' ') || '|'
    || prod::VARCHAR || '|' || array_to_string(st, ',') || '|' || tokens || '|$|'
    || CASE WHEN bare = 0 THEN '200|0,200|VULN' ELSE '-||' END AS steps
FROM g"""
    from checks.queries import EXTRA_RULE, EXTRA_TYPOS

    shown = "SELECT file, word_idx, word, message FROM lint WHERE message IS NOT NULL"
    q["r7_custom_typos"] = lint_sql(DOCUMENTS, EXTRA_TYPOS) + shown
    q["r7_custom_rules"] = found + f"""
SELECT file, lineno, CASE WHEN tokens = 'assign' THEN {quote(" -> ".join(EXTRA_RULE[2]))} ELSE pattern END AS pattern,
  CASE WHEN tokens = 'assign' THEN {quote(EXTRA_RULE[3])} ELSE severity END AS severity,
  CASE WHEN tokens = 'assign' THEN {quote("Grammar-based detection: " + EXTRA_RULE[4])} ELSE message END AS message,
  CASE WHEN tokens = 'assign' THEN {EXTRA_RULE[1]} ELSE prod END AS prod FROM findings WHERE prod IS NOT NULL"""

    # SQL lint
    q["s0_looks_like_sql"] = f"""
SELECT file, {any_of('upper(source)', vocab.SQL_KEYWORDS)} AS looks_like_sql FROM ({ALL_TEXT})"""
    ungated = lint_sql(TALKS).split(" WHERE ", 1)
    q["s1_sql_words"] = ungated[0] + ")" + ungated[1][ungated[1].index(",\nlisted"):] + "SELECT file, word_idx, word FROM words"
    from checks.queries import LINT_KEYS

    for key, needles in LINT_KEYS.items():
        q[key] = lint_sql(ALL_TEXT) + shown + " AND " + any_of("message", needles)
    q["s_sql_findings"] = f"""
WITH {FILES.strip()}, e(i, word_idx, message) AS (VALUES {values(
        (i, {"SELCT": 0, "FORM": 2, "INSERT": 0, "ORDER": 0, "DELETE": 0, "SELECT": 0, "GROUP": 0}[w], m)
        for i, (w, m) in enumerate(zip(["SELCT", "FORM", "INSERT", "ORDER", "DELETE", "SELECT", "GROUP"],
                                       [r[8] for r in EXPECTED if r[0] == 12])))})
SELECT file, 1 AS lineno, 'SQL_SYNTAX_ERROR' AS code, message, 'ERROR' AS severity, word_idx FROM files, e WHERE t = 12"""

    # symbols
    q["y1_scopes"] = per_file("""
SELECT s.file, s.scope_id, max(p.scope_id) AS parent_scope_id, coalesce(s.name, '<global>') AS name,
  CASE s.node_type WHEN 'Module' THEN 'global' WHEN 'ClassDef' THEN 'class' ELSE 'function' END AS scope_type,
  coalesce(string_agg(p.scope_id::VARCHAR, ',' ORDER BY p.scope_id) || ',', '') || s.scope_id::VARCHAR AS chain
FROM scopes s LEFT JOIN scopes p ON p.file = s.file AND p.scope_id < s.scope_id AND s.scope_id <= p.end_ord
GROUP BY s.file, s.scope_id, s.name, s.node_type""", name=own("name"))
    q["y2_definitions"] = per_file("""
SELECT file, scope_id, name, kind, CASE kind WHEN 'import' THEN 'module' WHEN 'function' THEN 'function'
  WHEN 'class' THEN 'class' WHEN 'variable' THEN inferred_type END AS inferred_type, ord, sub, lineno
FROM defs LEFT JOIN types USING (file, ord)""", name=own("name"))
    q["y2_definitions_with_builtins"] = per_file("""
SELECT file, scope_id, name, kind, CASE kind WHEN 'import' THEN 'module' WHEN 'function' THEN 'function'
  WHEN 'class' THEN 'class' WHEN 'variable' THEN inferred_type END AS inferred_type, ord, sub, lineno
FROM defs LEFT JOIN types USING (file, ord)
UNION ALL SELECT f.file, 0, b.name, b.kind, 'builtin', -1, b.sub, 0 FROM (SELECT DISTINCT file FROM nodes) f, builtins b""",
        name=own("name"))
    history = """
SELECT file, scope_id, name, coalesce(string_agg(lineno::VARCHAR, ',' ORDER BY ord, sub) FILTER (kind = 'variable'), '') AS assignments,
  arg_max(t, (ord, sub)) FILTER (t IS NOT NULL AND (nth = 1 OR kind = 'variable')) AS inferred_type
FROM (SELECT d.*, row_number() OVER (PARTITION BY file, scope_id, name ORDER BY ord, sub) AS nth,
        CASE kind WHEN 'import' THEN 'module' WHEN 'function' THEN 'function' WHEN 'class' THEN 'class'
        WHEN 'variable' THEN inferred_type END AS t
      FROM defs d LEFT JOIN types USING (file, ord)) GROUP BY file, scope_id, name"""
    used = """
SELECT file, scope_id, name, string_agg(lineno::VARCHAR, ',' ORDER BY ord) AS usages FROM resolved
WHERE scope_id IS NOT NULL GROUP BY ALL"""
    q["y3_symbol_table"] = per_file(f"""
, history AS ({history}), used AS ({used}),
every AS (
  SELECT file, scope_id, name, kind, lineno, NULL AS given FROM syms
  WHERE NOT (scope_id = 0 AND name IN (SELECT name FROM builtins))
  UNION ALL SELECT f.file, 0, b.name, b.kind, 0, 'builtin' FROM (SELECT DISTINCT file FROM nodes) f, builtins b)
SELECT file, scope_id, name, kind AS symbol_type, coalesce(inferred_type, given) AS inferred_type, lineno AS declared_line,
  usages IS NOT NULL AS is_used, coalesce(assignments, '') AS assignments, coalesce(usages, '') AS usages
FROM every LEFT JOIN history USING (file, scope_id, name) LEFT JOIN used USING (file, scope_id, name)""", name=own("name"))
    q["y4_assignment_history"] = per_file(history, name=own("name"))
    q["y5_name_uses"] = per_file("""
SELECT u.file, u.ord, u.name, u.lineno, string_agg(s.scope_id::VARCHAR, ',' ORDER BY s.scope_id) AS chain
FROM uses u JOIN scopes s ON s.file = u.file AND s.scope_id < u.ord AND u.ord <= s.end_ord GROUP BY ALL""", name=own("name"))
    q["y6_resolve"] = per_file("SELECT * FROM resolved", name=own("name"))
    q["y8_usages"] = per_file(used, name=own("name"))
    plain = "SELECT file, lineno, code, message, severity FROM findings WHERE code = "
    for key, code in {
        "y7_undefined": "UNDEFINED_VARIABLE",
        "y9_duplicate_imports": "DUPLICATE_IMPORT",
        "y10_duplicate_functions": "DUPLICATE_FUNCTION",
        "y11_duplicate_classes": "DUPLICATE_CLASS",
        "y12_unused_parameters": "UNUSED_PARAMETER",
        "c2_high_complexity": "HIGH_COMPLEXITY",
        "c4_missing_returns": "MISSING_RETURN",
    }.items():
        q[key] = found + plain + quote(code)
    q["y13_unused_variables"] = per_file("""
, held AS (
  SELECT file, scope_id, name, lineno FROM syms WHERE kind = 'variable' AND NOT (scope_id = 0 AND name IN (SELECT name FROM builtins))
  UNION ALL SELECT f.file, 0, b.name, 0 FROM (SELECT DISTINCT file FROM nodes) f, builtins b WHERE b.kind = 'variable')
SELECT file, scope_id, name, lineno FROM held ANTI JOIN resolved USING (file, scope_id, name)""", name=own("name"))
    q["y14_inferred_types"] = per_file("SELECT file, ord AS assign_ord, inferred_type FROM types")
    from checks.queries import LABELS

    labels = "[" + ", ".join(quote(x) for x in LABELS) + "]"
    pairs = f"""
WITH pairs AS (SELECT l_orderkey::VARCHAR AS file, l_linenumber AS lineno, {labels}[(l_partkey % {len(LABELS)} + 1)::INT] AS expected,
  {labels}[(l_suppkey % {len(LABELS)} + 1)::INT] AS actual, l_returnflag AS context FROM lineitem),
judged AS (SELECT *, expected = actual OR (expected = 'numeric' AND actual IN ('int', 'float'))
  OR (actual = 'numeric' AND expected IN ('int', 'float')) AS compatible FROM pairs)"""
    q["y15_type_compatible"] = pairs + "SELECT * FROM judged"
    q["y16_type_mismatches"] = pairs + """
SELECT file, lineno, 'TYPE_MISMATCH' AS code, 'Type mismatch in ' || context || ': expected ' || expected || ', got ' || actual
  AS message, 'WARNING' AS severity FROM judged WHERE NOT compatible AND expected <> '' AND actual <> ''"""

    # flow: no template nests functions of one name, so spans suffice
    spans = """
, f AS (SELECT file, ord, end_ord, name, lineno FROM nodes WHERE node_type = 'FunctionDef'),
inside AS (SELECT f.file, f.name, f.lineno, f.ord, n.node_type FROM f LEFT JOIN nodes n
  ON n.file = f.file AND n.ord > f.ord AND n.ord <= f.end_ord)
SELECT file, name, lineno, {what} FROM inside GROUP BY file, name, lineno, ord"""
    q["c1_complexity"] = per_file(spans.replace(
        "{what}", "(1 + count(*) FILTER (node_type IN ('If', 'For', 'While', 'With', 'Try', 'BoolOp')))::INT AS complexity"), name=own("name"))
    q["c3_has_return"] = per_file(
        spans.replace("{what}", "count(*) FILTER (node_type = 'Return') > 0 AS has_return"), name=own("name"))

    # reports
    q["p1_findings"] = found + """
SELECT file, lineno, code, message, severity, pattern, tokens, parse_stack, prod, CASE WHEN code = 'SYNTAX_ERROR' THEN 'PHASE_2_SYNTAX' END AS phase,
  NULL::VARCHAR AS error FROM findings"""
    q["p2_sorted_report"] = found + """
SELECT row_number() OVER (ORDER BY CASE severity WHEN 'ERROR' THEN 1 ELSE 2 END, file, lineno, i) AS position, file,
  lineno, code, severity, prod FROM findings"""
    counts = """count(*) AS total, count(*) FILTER (severity = 'ERROR') AS errors,
  count(*) FILTER (severity = 'WARNING') AS warnings, count(*) FILTER (severity = 'INFO') AS infos"""
    q["p3_severity_counts"] = found + f"SELECT file, {counts} FROM findings GROUP BY ROLLUP (file)"
    q["p4_type_counts"] = found + "SELECT coalesce(pattern, code) AS type, count(*) AS n FROM findings GROUP BY ALL"
    q["p4_distinct_types"] = found + """
SELECT count(DISTINCT code) AS distinct_codes, count(DISTINCT pattern) AS distinct_patterns,
  count(*) FILTER (code = 'GRAMMAR_VULN') AS grammar_findings FROM findings"""
    q["p5_filter_findings"] = found + """
SELECT file, lineno, code, severity FROM findings WHERE severity = 'WARNING'
AND (code IN ('UNUSED_PARAMETER', 'SQL_SYNTAX_ERROR') OR pattern = 'PATH_OP -> DOTDOT')"""
    q["p6_findings_by_line"] = found + """
SELECT file, lineno, count(*) AS n, CASE WHEN bool_or(severity = 'ERROR') THEN 'ERROR' ELSE 'WARNING' END AS worst,
  string_agg(coalesce(pattern, code), ';' ORDER BY i) AS types,
  string_agg(severity || ': ' || code || coalesce(' [' || pattern || ']', ''), ';' ORDER BY i) AS badges,
  string_agg('[' || severity || '] ' || code || ': ' || message || coalesce(chr(10) || '  → Pattern: ' || pattern, '')
    || coalesce(chr(10) || '  → Tokens: [' || replace(tokens, ' ', ', ') || ']', ''), chr(10) || chr(10) ORDER BY i) AS tooltip
FROM findings GROUP BY file, lineno"""
    q["p6_first_flagged_line"] = found + "SELECT file, min(lineno) AS first_line FROM findings GROUP BY file"
    q["p7_annotate_lines"] = found + f"""
, {SOURCES.strip()},
split AS (SELECT file, string_split(source, chr(10)) AS ls FROM corpus),
lines AS (SELECT file, generate_subscripts(ls, 1)::INT AS lineno, unnest(ls) AS text FROM split),
marks AS (SELECT file, lineno, count(*) AS n, CASE WHEN bool_or(severity = 'ERROR') THEN 'ERROR' ELSE 'WARNING' END AS worst,
  string_agg(coalesce(pattern, code), ';' ORDER BY i) AS types FROM findings GROUP BY file, lineno)
SELECT file, lineno, text, coalesce(n, 0) AS n, worst, types FROM lines LEFT JOIN marks USING (file, lineno)"""
    q["p8_semantic_summary"] = found + """
, facts(t, unused, functions, scopes, symbols, imports) AS (VALUES
  (0, 13, 1, 2, 52, 0), (1, 13, 1, 2, 52, 0), (2, 13, 1, 2, 52, 0), (3, 13, 1, 2, 52, 0), (4, 13, 1, 2, 52, 1),
  (5, 13, 1, 2, 52, 1), (6, 13, 1, 2, 52, 1), (7, 13, 1, 2, 55, 1), (8, 13, 1, 2, 52, 0), (9, 18, 0, 1, 54, 0),
  (10, 13, 1, 2, 53, 2), (11, 13, 1, 2, 54, 3), (12, 14, 0, 1, 50, 0), (13, 14, 2, 5, 58, 2), (14, 13, 1, 2, 51, 0),
  (16, 14, 0, 1, 51, 0)),
n AS (SELECT file, count(*) AS total, count(*) FILTER (code LIKE 'GRAMMAR%') AS g,
        count(*) FILTER (code = 'UNDEFINED_VARIABLE') AS u, count(*) FILTER (code LIKE 'DUPLICATE%') AS d
      FROM findings GROUP BY file)
SELECT file, coalesce(total, 0) AS total_findings, coalesce(g, 0) AS vulnerability_findings,
  coalesce(total - g, 0) AS semantic_findings, coalesce(u, 0) AS undefined_variables, coalesce(d, 0) AS duplicate_definitions,
  unused::BIGINT AS unused_variables, functions::BIGINT AS functions_analyzed,
  CASE WHEN t = 14 AND m >= 4 THEN 1 ELSE 0 END::BIGINT AS high_complexity_functions, scopes::BIGINT AS scopes_created,
  symbols::BIGINT AS symbols_tracked, imports::BIGINT AS imports
FROM files JOIN facts USING (t) LEFT JOIN n USING (file)"""
    gated = lambda x: f"CASE WHEN f.t <> 15 THEN CASE WHEN h.n > 0 THEN coalesce({x}, 0) ELSE 0 END END::BIGINT"
    q["p9_phase_report"] = tokens_sql(CORPUS) + f"""
, {FILES.strip()},
{nodes.strip()[len("WITH " + FILES.strip()) + 1:]},
expected(t, lo, hi, i, lineno, code, message, severity, pattern, tok, parse_stack, prod, bare, states) AS (VALUES
{values(_expected_rows())}),
hits(t, n, words) AS (VALUES {values((t, len(w.split()), w) for t, w in HITS.items())}),
lexical AS ({stats}),
typed AS (SELECT file, string_agg(node_type || ':' || n::VARCHAR, ',' ORDER BY node_type || ':' || n::VARCHAR) AS node_types
  FROM (SELECT file, node_type, count(*) AS n FROM nodes GROUP BY ALL) GROUP BY file),
parsed AS (SELECT file, count(*) AS total_nodes, count(*) FILTER (node_type IN ('FunctionDef', 'AsyncFunctionDef')) AS functions,
    count(*) FILTER (node_type = 'ClassDef') AS classes, count(*) FILTER (node_type IN ('Import', 'ImportFrom')) AS imports,
    count(*) FILTER (node_type = 'Call') AS calls, count(*) FILTER (node_type IN ('Assign', 'AnnAssign')) AS assignments,
    count(*) FILTER (node_type = 'If') AS ifs, count(*) FILTER (node_type IN ('For', 'While')) AS loops,
    count(*) FILTER (node_type = 'Try') AS tries, count(*) FILTER (node_type = 'alias') AS aliases,
    count(DISTINCT CASE WHEN node_type = 'FunctionDef' THEN name END) AS names FROM nodes GROUP BY file),
counted AS (SELECT file, count(*) AS n, count(*) FILTER (severity = 'ERROR') AS e, count(*) FILTER (severity = 'WARNING') AS w,
            count(*) FILTER (code = 'GRAMMAR_VULN') AS g
          FROM files JOIN expected x ON x.t = files.t AND files.m BETWEEN x.lo AND x.hi GROUP BY file)
SELECT f.file AS filename, total_tokens AS lex_total_tokens, keywords AS lex_keywords, identifiers AS lex_identifiers,
  strings AS lex_strings, numbers AS lex_numbers, operators AS lex_operators, comments AS lex_comments,
  total_nodes AS syn_total_nodes, node_types AS syn_node_types, functions AS syn_functions, classes AS syn_classes,
  parsed.imports AS syn_imports, calls AS syn_calls, assignments AS syn_assignments, ifs AS syn_if_statements, loops AS syn_loops,
  tries AS syn_try_blocks, CASE WHEN f.t = 15 THEN 'invalid syntax (f' || ks || '.py, line 1)' END AS syn_error,
  CASE WHEN f.t = 15 THEN 1 END AS syn_line, CASE WHEN f.t = 15 THEN (9 + length(ks))::INT END AS syn_offset,
  CASE WHEN f.t <> 15 THEN true END AS sem_prescreened,
  CASE WHEN f.t <> 15 THEN coalesce(h.n, 0) END::BIGINT AS sem_suspicious_tokens,
  {gated('counted.n')} AS sem_vulnerabilities_found, {gated('e')} AS sem_errors, {gated('w')} AS sem_warnings,
  CASE WHEN f.t <> 15 THEN 0 END::BIGINT AS sem_info, {gated('names')} AS sem_functions_analyzed,
  {gated('aliases')} AS sem_imports_found,
  CASE WHEN f.t <> 15 AND h.n IS NULL THEN 'No suspicious tokens detected' END AS sem_analysis_skipped,
  CASE WHEN f.t <> 15 THEN 0 END::BIGINT AS rule_patterns_matched, {gated('g')} AS rule_grammar_rules_applied
FROM files f JOIN lexical USING (file) LEFT JOIN parsed ON parsed.file = f.v LEFT JOIN typed ON typed.file = f.v
  LEFT JOIN hits h USING (t) LEFT JOIN counted USING (file)"""
    q["p10_report_lines"] = found + """
SELECT rpad(severity, 7, ' ') || ' ' || file || ':' || lpad(lineno::VARCHAR, 4, ' ') || ' '
  || CASE WHEN length(code) < 20 THEN rpad(code, 20, ' ') ELSE code END || ' - ' || message AS line
FROM findings"""
    q["p3_text_severity_counts"] = lint_sql(DOCUMENTS) + f"""
, hits AS (SELECT file, 'ERROR' AS severity FROM lint WHERE message IS NOT NULL
  UNION ALL SELECT file, 'ERROR' FROM src WHERE regexp_matches(source, {secret})
  UNION ALL SELECT file, 'ERROR' FROM src WHERE regexp_matches(source, '^{vocab.AWS_KEY_REGEX}')
  UNION ALL SELECT file, 'WARNING' FROM src WHERE regexp_full_match(source, '{vocab.LONG_TOKEN_REGEX}'))
SELECT file, {counts} FROM hits GROUP BY ROLLUP (file)"""

    # files and streams
    q["src1_scan_sources"] = CORPUS.replace(" SELECT file, source FROM corpus", """
SELECT 'a/' || CASE WHEN k % 3 = 0 THEN '.hidden/d' || (k % 7)::VARCHAR || '/__init__' ELSE '' END || ks || '.py' AS file,
  md5(source) AS md5, NULL::VARCHAR AS error FROM corpus JOIN files USING (file)""")
    q["src5_stream_sources"] = q["src1_scan_sources"]
    q["st1_stream_scan"] = q["p1_findings"]
    q["st2_stream_counts"] = lint_sql(DOCUMENTS) + f"""
, hits AS (SELECT 'ERROR' AS severity, 'SQL_SYNTAX_ERROR' AS type FROM lint WHERE message IS NOT NULL
  UNION ALL SELECT 'ERROR', 'ASSIGN -> SECRET_PATTERN' FROM src WHERE regexp_matches(source, {secret})
  UNION ALL SELECT 'ERROR', 'ASSIGN -> AWS_KEY' FROM src WHERE regexp_matches(source, '^{vocab.AWS_KEY_REGEX}')
  UNION ALL SELECT 'WARNING', 'ASSIGN -> LONG_TOKEN' FROM src WHERE regexp_full_match(source, '{vocab.LONG_TOKEN_REGEX}'))
SELECT severity, type, count(*) AS n FROM hits GROUP BY ALL"""
    return q
