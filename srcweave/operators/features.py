"""Features of calls, string assignments and string additions.

One grouped aggregate serves them all.  Each node row is routed to the sites
it speaks for (itself, and the call / assignment / addition it is a direct
operand of), and the sites are aggregated by `(file, ord)`.  A row's flags are
bits of one number and a site's the bits of all its rows, so the aggregation
buffer holds four numbers and it stays a hash aggregate; on a node table laid
out by `file` it needs no exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from srcweave.functions import text, vocab

# Heads of the rule language in order of precedence: the first match wins.
HEADS = [
    "executemany", "execute", "exec", "eval", "subprocess", "os.system", "pickle.load",
    "open", "Path", "hashlib", "random", "requests", "urllib",
]


def _head(call: Column) -> Column:
    lowered = F.lower(call)
    tests = {
        "executemany": lowered.contains("execute") & call.contains("many"),
        "execute": lowered.contains("execute"),
        "exec": call == "exec",
        "eval": call == "eval",
        "subprocess": call.contains("subprocess"),
        "os.system": call.contains("system"),
        "pickle.load": call.contains("pickle.load"),
        "open": call == "open",
        "Path": call == "Path",
        "hashlib": call.contains("hashlib") | call.isin("md5", "sha1", "new"),
        "random": call.contains("random"),
        "requests": call.contains("requests") | call.isin("get", "post", "request"),
        "urllib": call.contains("urllib") | call.contains("urlopen"),
    }
    number = F.lit(None).cast("int")
    for i in range(len(HEADS), 0, -1):
        number = F.when(tests[HEADS[i - 1]], i).otherwise(number)
    return number


# What a routed row is to its site: the site itself, or an operand of it.
OWN, OPERAND = 1, 2


def site_roles() -> dict[int, Column]:
    """By role, the position of the site a node row speaks for in that role; null where it has no such role."""
    kind, field, above = F.col("node_type"), F.col("field"), F.col("parent_type")
    is_site = kind.isin("Call", "Assign") | ((kind == "BinOp") & (F.col("op") == "Add"))
    is_operand = (
        ((above == "Call") & field.isin("args", "keywords"))
        | ((above == "Assign") & (field == "value"))
        | ((above == "BinOp") & field.isin("left", "right"))
    )
    return {OWN: F.when(is_site, F.col("ord")), OPERAND: F.when(is_operand, F.col("parent"))}


def routed(nodes: DataFrame, roles: dict[int, Column]) -> DataFrame:
    """Every node row once for each role it has, with `role` and `site`.

    The roles are columns before they are unfolded by place: so all of it is generated code, and keeps the layout.
    """
    names = [f"__role_{r}" for r in roles]
    any_role = F.coalesce(*[F.col(name) for name in names]).isNotNull()
    placed = nodes.select("*", *[at.alias(name) for name, at in zip(names, roles.values(), strict=True)]).filter(any_role)
    spoken = placed.select(*nodes.columns, F.posexplode(F.array(*names)).alias("__place", "site")).filter("site is not null")
    number = F.lit(None).cast("int")
    for place, r in enumerate(roles):
        number = F.when(F.col("__place") == place, r).otherwise(number)
    return spoken.withColumn("role", number).drop("__place")


FLAGS = [
    "has_concat", "has_format", "has_fstring", "has_b64decode", "is_dynamic", "has_user_input", "shell_true",
    "untrusted_source", "has_dotdot", "weak_algo", "token_gen", "has_seed", "predictable_seed", "verify_false",
    "no_verify", "assigns_string", "secret_pattern", "aws_key", "long_token", "sql_left", "input_right",
]


def flag_bits() -> Column:
    """What a routed row says about its site, one bit a flag.

    The cases part the rows, so a row is tested only for the flags its place can set.
    """
    kind, field, above = F.col("node_type"), F.col("field"), F.col("parent_type")
    call, name, literal = F.col("dotted"), F.col("name"), F.col("const_str")
    lower_call, lower_name = F.lower(call), F.lower(name)
    is_call, is_name = kind == "Call", kind == "Name"
    string = (kind == "Constant") & (F.col("const_kind") == "str")
    truth = F.col("const_kind")
    own = {
        "weak_algo": text.contains_any(lower_call, vocab.WEAK_ALGORITHMS),
        "token_gen": lower_call.contains("random"),
        "has_seed": lower_call.contains("random") & lower_call.contains("seed"),
    }
    argument = {
        "has_concat": (kind == "BinOp") & (F.col("op") == "Add"),
        # `name` is the attribute; a plain name equals its own dotted form
        "has_format": (is_call & (name == "format") & (call != "format")) | ((kind == "BinOp") & (F.col("op") == "Mod")),
        "has_fstring": kind == "JoinedStr",
        "has_b64decode": is_call & text.contains_any(call, vocab.DECODING_CALLS),
        "is_dynamic": kind != "Constant",
        "has_user_input": (is_call & text.contains_any(lower_call, vocab.INPUT_CALLS))
        | (is_name & text.contains_any(lower_name, vocab.INPUT_NAMES)),
        "untrusted_source": is_call & text.contains_any(lower_call, vocab.UNTRUSTED_CALLS),
        "has_dotdot": string & literal.contains(".."),
        "weak_algo": string & F.lower(literal).isin(*vocab.WEAK_ALGORITHMS),
        "predictable_seed": (kind == "Constant") | (is_call & lower_call.contains("time")),
    }
    keyword = {
        "shell_true": (name == "shell") & (truth == "True"),
        "verify_false": (name == "verify") & (truth == "False"),
        "no_verify": (name == "context") & lower_call.contains("unverified"),
    }
    value = {
        "assigns_string": F.lit(True),
        "secret_pattern": text.secret_pattern(literal),
        "aws_key": text.aws_key(literal),
        "long_token": text.long_token(literal),
    }
    left = {"sql_left": string & text.contains_any(F.upper(literal), vocab.QUERY_WORDS)}
    right = {
        "input_right": (is_name & text.contains_any(lower_name, vocab.INPUT_OPERANDS))
        | (is_call & lower_call.contains("input"))
    }

    def bits(tests):
        total = None
        for flag, test in tests.items():
            bit = F.when(test, F.lit(1 << FLAGS.index(flag))).otherwise(F.lit(0))
            total = bit if total is None else total.bitwiseOR(bit)
        return total

    operand = (
        F.when((above == "Call") & (field == "args"), bits(argument))
        .when(above == "Call", bits(keyword))
        .when((above == "Assign") & string, bits(value))
        .when((above == "BinOp") & (field == "left"), bits(left))
        .when((above == "BinOp") & (field == "right"), bits(right))
    )
    return F.when((F.col("role") == OWN) & is_call, bits(own)).when(F.col("role") == OPERAND, operand)


def site_flags() -> list[Column]:
    """Aggregates over the routed rows of a site, with their `bits` (`flag_bits`); the buffer holds four numbers."""
    kind, own = F.col("node_type"), F.col("role") == OWN

    def of_own(column):
        return F.max(F.when(own, column))

    return [
        of_own(F.col("lineno")).alias("lineno"),
        of_own(F.when(kind == "Call", 1).when(kind == "Assign", 2).otherwise(3)).alias("site_kind"),
        of_own(F.when(kind == "Call", _head(F.col("dotted")))).alias("head"),
        # named here, not in a projection above: filters on flags then meet plain columns
        *[(F.coalesce(F.bit_or("bits"), F.lit(0)).bitwiseAND(1 << i) != 0).alias(flag) for i, flag in enumerate(FLAGS)],
    ]


def named_sites(grouped: DataFrame) -> DataFrame:
    """Numbers of site kinds and heads back to their names."""
    kinds = F.array(*[F.lit(k) for k in ("Call", "Assign", "BinOp")])
    heads = F.array(*[F.lit(h) for h in HEADS])
    return (
        grouped.withColumn("node_type", F.get(kinds, F.col("site_kind") - 1))
        .withColumn("head", F.get(heads, F.col("head") - 1))
        .drop("site_kind")
    )


def sites(nodes: DataFrame) -> DataFrame:
    """sites(file, ord, lineno, node_type, head, F1…F20 flags), one row per
    call, assignment and `+`; flags that do not apply to a site are false."""
    rows = routed(nodes, site_roles()).withColumn("bits", flag_bits())
    grouped = rows.groupBy("file", F.col("site").alias("ord")).agg(*site_flags())
    return named_sites(grouped.filter(F.col("site_kind").isNotNull()))


CALL_FEATURES = FLAGS[:15]


def call_features(nodes: DataFrame) -> DataFrame:
    """F1–F15 per call."""
    only = sites(nodes).filter(F.col("node_type") == "Call")
    return only.select("file", "ord", "lineno", "head", *CALL_FEATURES)


def assign_features(nodes: DataFrame) -> DataFrame:
    """F16–F18 per assignment of a string."""
    only = sites(nodes).filter((F.col("node_type") == "Assign") & F.col("assigns_string"))
    return only.select("file", "ord", "lineno", "secret_pattern", "aws_key", "long_token")


def binop_features(nodes: DataFrame) -> DataFrame:
    """F19–F20 per addition."""
    only = sites(nodes).filter(F.col("node_type") == "BinOp")
    return only.select("file", "ord", "lineno", "sql_left", "input_right")
