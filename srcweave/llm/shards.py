"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard levels.  On each level every child draws
`-ln(u) / weight`, where `u` is a hash of the row's key and the child's name,
and the smallest draw wins: a child is chosen with a probability proportional
to its weight, and changing one child's weight moves rows only into it or out
of it.  Weights of inner nodes are the sums of their shards, so a change stays
in the subtrees whose weights change.

Law `key`: the key and the tree decide.  `grown` adds a shard as a region of
its own, so only the top level changes weight and rows move only into the new
shard; adding it below an old region would let that region's other shards take
rows as well.
"""

from __future__ import annotations

from collections import namedtuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from srcweave.llm.common import Scratch

Node = namedtuple("Node", "name weight children shard")


def tree(regions: int, racks: int, shards: int, weights: dict[int, float] | None = None) -> Node:
    """A regular tree; `weights` gives shards another weight than 1."""
    weights = weights or {}
    number = iter(range(regions * racks * shards))

    def grow(name: str, fans: tuple[int, ...]) -> Node:
        if not fans:
            shard = next(number)
            return Node(name, float(weights.get(shard, 1.0)), (), shard)
        return _inner(name, [grow(f"{name}/{i}", fans[1:]) for i in range(fans[0])])

    return grow("", (regions, racks, shards))


def _inner(name: str, children: list[Node]) -> Node:
    return Node(name, sum(c.weight for c in children), tuple(children), None)


def leaves(node: Node) -> list[Node]:
    return [node] if node.shard is not None else [leaf for c in node.children for leaf in leaves(c)]


def grown(root: Node, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region and rack of its own."""
    name = f"/{len(root.children)}"
    shard = Node(f"{name}/0/0", weight, (), len(leaves(root)))
    return _inner("", [*root.children, _inner(name, [_inner(f"{name}/0", [shard])])])


def _draw(key: Column, child: Node) -> Column:
    unit = (F.shiftrightunsigned(F.xxhash64(key, F.lit(child.name)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(unit) / child.weight


def with_shard(df: DataFrame, root: Node, key: str, name: str) -> DataFrame:
    """`df` with the shard number of each row: one weighted draw on each level, a column per level."""
    nodes, at = [root], F.lit(0)
    steps = []
    while any(n.shard is None for n in nodes):
        below: list[Node] = []
        branches = []
        for node in nodes:
            children = [c for c in node.children if c.weight > 0] or [node]
            places = range(len(below), len(below) + len(children))
            below += children
            draws = [F.struct(_draw(F.col(key), c).alias("draw"), F.lit(i).alias("at")) for i, c in zip(places, children, strict=True)]
            branches.append(F.array_min(F.array(*draws))["at"] if len(draws) > 1 else F.lit(places[0]))
        chosen = F.when(at == 0, branches[0])
        for i, branch in enumerate(branches[1:], 1):
            chosen = chosen.when(at == i, branch)
        steps.append(f"{name}_level_{len(steps)}")
        df = df.withColumn(steps[-1], chosen)
        nodes, at = below, F.col(steps[-1])
    return df.withColumn(name, F.array(*(F.lit(n.shard) for n in nodes))[at]).drop(*steps)


def assign_shards(docs: DataFrame, root: Node, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot, grown_shard) of every row of `docs`.

    size is the UTF-8 length of the text plus 8; slot counts the rows of a
    shard from 0 in key order without gaps.  Only these narrow rows move, never
    texts.  Slots are numbered per range of keys and shifted by the rows of the
    ranges before, so no task holds a whole shard.

    A null text has no bytes; null keys and repeated keys go to one shard
    together, each row with a slot of its own; an empty table gives no rows;
    other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "shards")
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = scratch.stage(
        docs.select(
            F.col(key).alias("key"),
            (F.octet_length(raw).cast("long") + 8).alias("size"),
            F.crc32(raw).alias("text_crc32"),
            F.monotonically_increasing_id().alias("seen"),
        ),
        "rows",
    )
    ranged = rows.repartitionByRange("key", "text_crc32", "seen").select("*", F.spark_partition_id().alias("range"))
    placed = scratch.stage(with_shard(with_shard(ranged, root, "key", "shard"), grown(root), "key", "grown_shard"), "placed")
    scratch.drop("rows")
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        placed.groupBy("range", "shard")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("range", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    )
    own = Window.partitionBy("range", "shard").orderBy("key", "text_crc32", "seen")
    return (
        placed.select("*", (F.row_number().over(own) - 1).cast("long").alias("nth"))
        .join(shifts, ["range", "shard"])
        .select(
            F.col("key").alias(key), "size", "text_crc32", "shard", (F.col("shift") + F.col("nth")).alias("slot"), "grown_shard"
        )
    )


def write_shards(docs: DataFrame, root: Node, path: str, key: str = "doc_id", spread: int = 8) -> None:
    """Write the rows to one folder per shard, `spread` files each; every column is kept."""
    taken = {c.lower() for c in docs.columns}
    shard = next(x for x in ("shard", "shard_", *(f"shard_{i}" for i in range(len(taken) + 1))) if x not in taken)
    parts = len(leaves(root)) * spread
    salted = with_shard(docs, root, key, shard)
    laid = salted.repartition(parts, F.col(shard), F.pmod(F.xxhash64(*docs.columns), F.lit(spread)))
    laid.write.partitionBy(shard).parquet(path)
