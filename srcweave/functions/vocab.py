"""Fixed vocabularies the answers depend on.

Everything in this module is a fixed value: word lists, lookup tables and
messages that must be exactly these for results to be right.  They are kept as
plain text, in natural order, and turned into literals or small dimension
tables by the operators.
"""

from __future__ import annotations

# Reserved words of the token relation (no soft keywords).
KEYWORDS = """
False None True and as assert async await break class continue def del elif
else except finally for from global if import in is lambda nonlocal not or
pass raise return try while with yield
""".split()

# Operator and delimiter spellings and their token types.
OPERATORS = dict(
    line.split()
    for line in """
    ... ELLIPSIS
    //= DOUBLE_SLASH_ASSIGN
    **= DOUBLE_STAR_ASSIGN
    <<= LSHIFT_ASSIGN
    >>= RSHIFT_ASSIGN
    == EQ
    != NE
    <= LE
    >= GE
    << LSHIFT
    >> RSHIFT
    ** DOUBLE_STAR
    // DOUBLE_SLASH
    += PLUS_ASSIGN
    -= MINUS_ASSIGN
    *= STAR_ASSIGN
    /= SLASH_ASSIGN
    %= PERCENT_ASSIGN
    &= AMPERSAND_ASSIGN
    |= PIPE_ASSIGN
    ^= CARET_ASSIGN
    @= AT_ASSIGN
    -> ARROW
    := WALRUS
    + PLUS
    - MINUS
    * STAR
    / SLASH
    % PERCENT
    @ AT
    < LT
    > GT
    = ASSIGN
    & AMPERSAND
    | PIPE
    ^ CARET
    ~ TILDE
    ( LPAREN
    ) RPAREN
    [ LBRACKET
    ] RBRACKET
    { LBRACE
    } RBRACE
    , COMMA
    : COLON
    ; SEMICOLON
    . DOT
    """.strip().splitlines()
)

# Token types counted as "operators" besides the *ASSIGN family.
COUNTED_OPERATORS = "PLUS MINUS STAR SLASH EQ NE LT GT".split()

# Words whose presence makes a file worth analysing.
SUSPICIOUS_WORDS = """
eval exec compile __import__ importlib subprocess os.system os.popen shell
Popen call run pickle loads load open read write execute executemany cursor
query SELECT INSERT UPDATE request input get post password secret api_key
token aws md5 sha1 hashlib random randint choice requests urllib verify ssl
https certificate base64 b64decode decode Path join dirname
""".split()

# Misspelt SQL words and what they should be.
SQL_TYPOS = {
    "SELCT": "SELECT",
    "SLECT": "SELECT",
    "SELEC": "SELECT",
    "SELET": "SELECT",
    "SELEECT": "SELECT",
    "SELLECT": "SELECT",
    "SELECET": "SELECT",
    "SEELCT": "SELECT",
    "SLELECT": "SELECT",
    "FORM": "FROM",
    "FRON": "FROM",
    "FRUM": "FROM",
    "FOM": "FROM",
    "WHER": "WHERE",
    "WHRE": "WHERE",
    "WERE": "WHERE",
    "WAERE": "WHERE",
    "INSRT": "INSERT",
    "INSER": "INSERT",
    "INSET": "INSERT",
    "INSERTINTO": "INSERT INTO",
    "UPDTE": "UPDATE",
    "UPDAE": "UPDATE",
    "UPDAT": "UPDATE",
    "DELET": "DELETE",
    "DELLETE": "DELETE",
    "DELTE": "DELETE",
    "ORDERBY": "ORDER BY",
    "ODER": "ORDER",
    "ORER": "ORDER",
    "GROUPBY": "GROUP BY",
    "GROPU": "GROUP",
    "GRUP": "GROUP",
    "JION": "JOIN",
    "JON": "JOIN",
    "JOJN": "JOIN",
}

# A text holding any of these (as a substring) is linted as SQL.
SQL_KEYWORDS = """
SELECT FROM WHERE INSERT INTO UPDATE DELETE CREATE ALTER DROP TABLE INDEX VIEW
JOIN INNER LEFT RIGHT OUTER ON ORDER BY GROUP HAVING DISTINCT AND OR NOT IN
BETWEEN LIKE AS SET VALUES LIMIT OFFSET
""".split()

# Run-on words, in order of precedence, and the lint message tail.
SQL_RUN_ONS = [
    (("SELECTFROM", "SELECTALL"), "Missing space in '{w}' (should be 'SELECT FROM' or 'SELECT ALL')"),
    (("INSERTINTO",), "Missing space in '{w}' (should be 'INSERT INTO')"),
    (("DELETEFROM",), "Missing space in '{w}' (should be 'DELETE FROM')"),
    (("ORDERBY",), "Missing space (should be 'ORDER BY')"),
    (("GROUPBY",), "Missing space (should be 'GROUP BY')"),
]

# SQL words that make the left side of a `+` a query.
QUERY_WORDS = "SELECT INSERT UPDATE DELETE FROM WHERE".split()

# Names every module scope starts with (declared at line 0).
BUILTINS = """
print len range str int float bool list dict set tuple abs all any bin chr dir
enumerate filter hex input isinstance iter map max min next open ord pow
reversed round sorted sum type zip Exception ValueError TypeError KeyError
IndexError AttributeError ImportError RuntimeError True False None __name__
__file__
""".split()

# Functions exempt from the missing-return check, and name parts
# that mark a function as a procedure.
NO_RETURN_NAMES = "__init__ __del__ setUp tearDown".split()
PROCEDURE_WORDS = """
print display show log write save update delete remove clear reset init
""".split()

# Thresholds of the complexity check.
COMPLEXITY_WARNING = 8
COMPLEXITY_ERROR = 15

# Secret shapes (regular expressions).
SECRET_REGEX = r"(?:api[_-]?key|secret[_-]?key|password|passwd|token)\s*[:=]\s*['\"]?([A-Za-z0-9\-_+=/]{8,})"
AWS_KEY_REGEX = r"AKIA[0-9A-Z]{16}"
LONG_TOKEN_REGEX = r"[A-Za-z0-9+/=]{20,}"

# Rules as (number, right-hand side, severity, message).
PRODUCTIONS = [
    (0, "SQL_CALL CONCAT_ARG", "ERROR", "SQL injection via concatenated query"),
    (1, "SQL_CALL FORMAT_ARG", "ERROR", "SQL injection via formatted string"),
    (2, "SQL_CALL FSTRING_ARG", "ERROR", "SQL injection via f-string"),
    (3, "SQL_VAR CONCAT_OP USER_INPUT", "ERROR", "SQL string concatenation with user input"),
    (4, "SQL_ASSIGN CONCAT_OP", "ERROR", "SQL string construction via concatenation"),
    (5, "EXEC_CALL DYNAMIC_ARG", "ERROR", "Dynamic code execution detected"),
    (6, "EXEC_CALL B64_DECODE", "ERROR", "Obfuscated code execution"),
    (7, "EVAL_CALL USER_INPUT", "ERROR", "eval() with user-controlled input"),
    (8, "SYSTEM_CALL SHELL_TRUE CONCAT_ARG", "ERROR", "Command injection via shell=True"),
    (9, "OS_SYSTEM FORMAT_ARG", "ERROR", "OS command with formatted input"),
    (10, "SUBPROCESS SHELL_TRUE", "WARNING", "subprocess with shell=True"),
    (11, "PICKLE_LOAD UNTRUSTED_SOURCE", "ERROR", "Unsafe deserialization"),
    (12, "PICKLE_LOAD USER_INPUT", "ERROR", "Pickle load from user input"),
    (13, "FILE_OPEN CONCAT_PATH", "WARNING", "Path traversal via concatenation"),
    (14, "FILE_OPEN USER_INPUT", "WARNING", "File access with user-controlled path"),
    (15, "PATH_OP DOTDOT", "WARNING", "Directory traversal pattern detected"),
    (16, "ASSIGN SECRET_PATTERN", "ERROR", "Hard-coded API key or secret token"),
    (17, "ASSIGN AWS_KEY", "ERROR", "Hard-coded AWS access key"),
    (18, "ASSIGN LONG_TOKEN", "WARNING", "Suspicious hard-coded token or credential"),
    (19, "HASH_CALL WEAK_ALGO", "ERROR", "Weak cryptographic hash algorithm (MD5/SHA1)"),
    (20, "RANDOM_CALL TOKEN_GEN", "ERROR", "Insecure random for cryptographic token generation"),
    (21, "RANDOM_SEED PREDICTABLE", "WARNING", "Predictable random seed"),
    (22, "REQUESTS_CALL VERIFY_FALSE", "ERROR", "SSL certificate verification disabled"),
    (23, "URLLIB_CALL NO_VERIFY", "WARNING", "Insecure HTTPS context"),
]

# Every accepted symbol sequence, the rule it yields, and the
# state numbers a trace shows after each symbol.
ACCEPTED = [
    ("execute", 0, [1]),
    ("executemany", 0, [1]),
    ("execute concat", 0, [1, 2]),
    ("executemany concat", 0, [1, 2]),
    ("execute format", 1, [1, 3]),
    ("executemany format", 1, [1, 3]),
    ("execute fstring", 2, [1, 4]),
    ("executemany fstring", 2, [1, 4]),
    ("sql_var concat_op user_input", 3, [5, 6, 7]),
    ("exec", 5, [10]),
    ("exec dynamic", 5, [10, 12]),
    ("exec b64decode", 6, [10, 13]),
    ("eval", 7, [11]),
    ("eval user_input", 7, [11, 14]),
    ("subprocess", 10, [20]),
    ("subprocess shell_true", 10, [20, 21]),
    ("subprocess shell_true concat", 8, [20, 21, 22]),
    ("os.system", 9, [30]),
    ("os.system format", 9, [30, 31]),
    ("pickle.load", 11, [40]),
    ("pickle.load untrusted", 11, [40, 41]),
    ("pickle.load user_input", 12, [40, 42]),
    ("open", 13, [50]),
    ("Path", 13, [50]),
    ("open concat", 13, [50, 51]),
    ("Path concat", 13, [50, 51]),
    ("open user_input", 14, [50, 52]),
    ("Path user_input", 14, [50, 52]),
    ("open dotdot", 15, [50, 53]),
    ("Path dotdot", 15, [50, 53]),
    ("assign", 16, [60]),
    ("assign secret_pattern", 16, [60, 61]),
    ("assign aws_key", 17, [60, 62]),
    ("assign long_token", 18, [60, 63]),
    ("hashlib", 19, [80]),
    ("hashlib weak_algo", 19, [80, 81]),
    ("random token_gen", 20, [90, 91]),
    ("requests", 22, [100]),
    ("requests verify_false", 22, [100, 101]),
    ("urllib", 23, [110]),
    ("urllib no_verify", 23, [110, 111]),
]

# Words that make the name of a call, argument or operand telling.
DECODING_CALLS = ["b64decode", "base64"]
INPUT_CALLS = ["input", "read", "get", "request", "argv"]
INPUT_NAMES = ["input", "user", "request", "data"]
UNTRUSTED_CALLS = ["open", "read", "request", "recv", "socket"]
WEAK_ALGORITHMS = ["md5", "sha1"]
INPUT_OPERANDS = ["input", "user", "data", "request"]
