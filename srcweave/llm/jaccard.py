"""Jaccard join of shingle sets by prefixes under a global order.

Two sets of similarity t or more share a token among the first
n - ceil(t n) + 1 of each, under any order of all tokens.  A posting is written
for these tokens under one order, rarest words first; two documents meet only
in a list of one token, and what meets is verified, exactly.

Documents with equal sets are one node from the start.  What is wanted is the
components of the link graph, so a long list isn't turned into all its pairs:
its members are compared with one of them, the centre.  With d = 1 - similarity,
a metric, and the limit e = 1 - t, members within e are linked with the centre
and need no comparison with each other; members beyond 2e cannot link with
those, and go on as a list of their own with another centre; those between are
compared with the near ones they may still reach, |d(x,c) - d(y,c)| <= e, unless
already in the centre's component.  The centre is a member with the fewest rarer
tokens before the list's: of near copies the one with the fewest words of its own.
Lists of SHORT members or fewer give their pairs.

What is still long after ROUNDS centres, and what lies between, are documents
alike but mostly not linked.  To know that takes all their comparisons, but no row
for each: members are dealt into blocks of BLOCK, two blocks with their sets are
one cell, and a cell counts what its sets share by a matrix product and gives the
links of a spanning forest, at most one for each member.  So the rows grow with
the members times their blocks.  A list of more than SPLIT is dealt by the prefix
tokens of a second order first: members of it meet only where they share one of
these as well.

Sets sent to cells and to pairs grow faster than the documents: in a list of m
members each is sent to m / BLOCK cells.  So they are sent in waves, each of no
more bytes than all sets have together, and what one wave shuffled is gone
before the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from srcweave.llm.common import Scratch, raw_bytes, small_batches, text_slices
from srcweave.llm.components import components
from srcweave.llm.shingles import mixed, shingle_sets

# Counters of words, by hash; their sum over all documents orders the tokens.
BUCKETS = 1 << 20
SHORT = 24
ROUNDS = 3
# Members of a block: two fill a cell, some megabytes of sets.
BLOCK = 512
SPLIT = 8192
# Bytes of sets that may be sent at a time, even if all documents have fewer.
ROOM = 256 << 20
# Ids up to which a filter on nodes is broadcast (16 bytes each); beyond it the join shuffles.
FEW = 1_000_000


def _ordered(tokens: np.ndarray, common: np.ndarray, order: int) -> np.ndarray:
    """Place of each token in one global order: rarest words first, then by a hash of its own."""
    rank = np.zeros(len(tokens), np.uint64)
    np.floor(np.log2(common + 1.0) * 2, out=(half := np.empty(len(tokens))))
    rank += half.astype(np.uint64)
    return (rank << np.uint64(56)) | (mixed(tokens, 10 + order) >> np.uint64(8))


def _prefix(keys: np.ndarray, num: int, den: int) -> np.ndarray:
    """The first n - ceil(t n) + 1 keys in order."""
    n = len(keys)
    size = n - -(-num * n // den) + 1
    return np.sort(np.partition(keys, size - 1)[:size]) if size < n else np.sort(keys)


def few(df: DataFrame) -> DataFrame:
    """`df`, marked for broadcast if it has at most FEW rows."""
    n = df.limit(FEW + 1).agg(F.count(F.lit(1))).first()[0]
    return F.broadcast(df) if n <= FEW else df


class _Join:
    def __init__(self, docs: DataFrame, width: int, num: int, den: int, key: str, text: str, digests: bool):
        self.docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        self.width, self.num, self.den, self.digests = width, num, den, digests
        self.spark = docs.sparkSession
        self.scratch = Scratch(self.spark, "jaccard")

    def profile(self) -> tuple[DataFrame, DataFrame]:
        """(key, digest, n, node) of every document, node naming its set; and classes (node, rep)."""
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, tally, kind = ["key", "digest", "n", "node", "bucket", "words"], np.zeros(BUCKETS, np.int64), None
            for batch in batches:
                kind = batch.column("key").type
                # sets of one slice at a time: what a worker once held it keeps
                for first, piece in text_slices(batch.column("text")):
                    sets = shingle_sets(raw_bytes(piece), width, tally=tally)
                    node = np.array([mixed(s, 5).sum(dtype=np.uint64) if len(s) else 0 for s, _ in sets], np.uint64)
                    empty = pa.nulls(len(sets), pa.int64())
                    n = pa.array([len(s) for s, _ in sets], pa.int64())
                    key, digest = (batch.column(c).slice(first, len(sets)) for c in ("key", "digest"))
                    yield pa.RecordBatch.from_arrays(
                        [key, digest, n, pa.array(node.view(np.int64)), empty, empty], names=names
                    )
            used = np.flatnonzero(tally)
            if len(used):
                empty = pa.nulls(len(used), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(used), kind), pa.nulls(len(used), pa.string()), empty, empty, pa.array(used), pa.array(tally[used])],
                    names=names,
                )

        kinds = "digest string, n long, node long, bucket long, words long"
        schema = f"key {self.docs.schema['key'].dataType.simpleString()}, {kinds}"
        digest = F.sha2(F.coalesce("text", F.lit("")), 256) if self.digests else F.lit(None).cast("string")
        with small_batches(self.spark, 1000):
            both = self.scratch.stage(self.docs.withColumn("digest", digest).mapInArrow(run, schema), "profile")
        rows = both.where("bucket is null").select("key", "digest", "n", "node")
        sums = both.where("bucket is not null").groupBy("bucket").agg(F.sum("words").alias("words")).toArrow()
        counts = np.zeros(BUCKETS, np.int64)
        counts[sums["bucket"].to_numpy()] = sums["words"].to_numpy()
        self.counts = self.spark.sparkContext.broadcast(counts)
        classes = rows.where("n > 0 and key is not null").groupBy("node").agg(F.min("key").alias("rep"), F.max("n").alias("n"))
        classes = self.scratch.stage(classes, "classes")
        self.room = max(ROOM, 8 * (classes.agg(F.sum("n")).first()[0] or 0))
        return rows, classes

    def waves(self, sent: DataFrame, node: str, classes: DataFrame) -> int:
        """In how many waves to send the set of `node` along with every row."""
        sizes = classes.select(F.col("node").alias(node), "n")
        return max(1, -(-8 * (sent.join(sizes, node).agg(F.sum("n")).first()[0] or 0) // self.room))

    def _sets(self, wanted: DataFrame, make, schema: str, *, filtered: bool) -> DataFrame:
        """`make(node, tokens, common)` for one document of every wanted (node, rep)."""
        width, counts = self.width, self.counts
        docs = self.docs.where("key is not null")
        if filtered:
            docs = docs.join(few(wanted.select(F.col("rep").alias("key")).distinct()), "key", "left_semi")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            common = counts.value
            for batch in batches:
                for first, piece in text_slices(batch.column("text")):
                    keys = batch.column("key").slice(first, len(piece))
                    sets = shingle_sets(raw_bytes(piece), width, counts=common)
                    made = [(i, *make(s, c)) for i, (s, c) in enumerate(sets) if len(s)]
                    if not made:
                        continue
                    at, *columns = zip(*made, strict=True)
                    node = np.array([mixed(sets[i][0], 5).sum(dtype=np.uint64) for i in at], np.uint64).view(np.int64)
                    arrays = [pa.array(c) for c in columns]
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(at)), pa.array(node), *arrays], names=["rep", "node", *names]
                    )

        names = [part.split()[0] for part in schema.split(", ")]
        kind = self.docs.schema["key"].dataType.simpleString()
        found = docs.mapInArrow(run, f"rep {kind}, node long, {schema}")
        return found.join(wanted.select("rep", "node"), ["rep", "node"]).drop("rep").dropDuplicates(["node"])

    def lists(self, classes: DataFrame) -> DataFrame:
        """(token, node, n, pos, size, center): postings of tokens that more than one node has in its prefix."""
        num, den = self.num, self.den

        def make(tokens: np.ndarray, common: np.ndarray) -> tuple:
            return len(tokens), _prefix(_ordered(tokens, common, 0), num, den).tobytes()

        with small_batches(self.spark, 1000):
            signed = self.scratch.stage(self._sets(classes, make, "n long, prefix binary", filtered=False), "signed")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
                raw = raw_bytes(batch.column("prefix"))
                sizes = np.array([len(x) // 8 for x in raw], np.int64)
                token = np.frombuffer(b"".join(raw), np.int64)
                node, n = (np.repeat(batch.column(c).to_numpy(), sizes) for c in ("node", "n"))
                pos = np.arange(len(token)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                arrays = [pa.array(token), pa.array(node), pa.array(n.astype(np.int32)), pa.array(pos.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(arrays, names=["token", "node", "n", "pos"])

        postings = signed.select("node", "n", "prefix").mapInArrow(run, "token long, node long, n int, pos int")
        sizes = _measured(postings)
        found = self.scratch.stage(postings.join(sizes, "token"), "lists")
        self.scratch.drop("signed")
        return found

    def fits(self, a: str, b: str):
        """Length filter, and what may still be shared behind a shared token."""
        x, y = F.col(f"{a}.n"), F.col(f"{b}.n")
        behind = F.least(x - F.col(f"{a}.pos"), y - F.col(f"{b}.pos"))
        return (F.least(x, y) * self.den >= F.greatest(x, y) * self.num) & (
            behind * (self.num + self.den) >= (x + y) * self.num
        )

    def pairs_within(self, lists: DataFrame) -> DataFrame:
        a, b = lists.alias("a"), lists.alias("b")
        met = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.node") < F.col("b.node")) & self.fits("a", "b"))
        return met.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()

    def dealt(self, lists: DataFrame, classes: DataFrame) -> DataFrame:
        """(token, part, low, high, node): cells in which all members of a list meet."""
        num, den = self.num, self.den

        def make(tokens: np.ndarray, common: np.ndarray) -> tuple:
            return (_prefix(_ordered(tokens, common, 1), num, den).view(np.int64),)

        members = lists.where(F.col("size") <= SPLIT).select("token", F.lit(0).cast("long").alias("part"), "node", "size")
        huge = lists.where(F.col("size") > SPLIT).select("token", "node")
        if not huge.isEmpty():
            wanted = self.scratch.stage(classes.join(huge.select("node").distinct(), "node"), "split-wanted")
            with small_batches(self.spark, 2000):
                seconds = self.scratch.stage(self._sets(wanted, make, "seconds array<long>", filtered=True), "split-sets")
            split = huge.join(seconds.select("node", F.explode("seconds").alias("part")), "node")
            sizes = split.groupBy("token", "part").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
            members = members.unionByName(split.join(sizes, ["token", "part"]))
        blocks = F.ceil(F.col("size") / BLOCK).cast("int")
        return (
            members.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .select("token", "part", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node")
        )

    def crossed(self, near: DataFrame, middle: DataFrame, reach: float) -> DataFrame:
        """(token, part, low, high, node): cells in which near members meet the middle ones; part -1, -2, … is the turn."""
        by = ["token", "part"]
        asked = middle.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.min("apart").alias("least"))
        near = near.join(asked, by).where(F.col("apart") >= F.col("least") - reach)
        given = near.groupBy(by).agg(F.count(F.lit(1)).alias("columns"))

        def placed(rows: DataFrame, own: str, other: str, low: str, high: str) -> DataFrame:
            blocks, others = (F.ceil(F.col(c) / BLOCK).cast("int") for c in (own, other))
            return rows.select(
                *by, F.pmod(F.xxhash64("node"), blocks).cast("int").alias(low),
                F.explode(F.sequence(F.lit(0), others - 1)).alias(high), "node",
            ).select(*by, "low", "high", "node")

        return placed(near.join(given, by), "columns", "rows", "low", "high").unionByName(
            placed(middle.join(asked, by).join(given, by), "rows", "columns", "high", "low")
        )

    def cells(self, sent: DataFrame, classes: DataFrame) -> DataFrame:
        """Edges (a, b) with the same components as the links inside these cells."""
        num, den = self.num, self.den
        sent = self.scratch.stage(_distinct_cells(self.scratch.stage(sent, "cells-all")), "cells-sent")
        wanted = self.scratch.stage(classes.join(sent.select("node").distinct(), "node"), "cells-wanted")

        def make(tokens: np.ndarray, common: np.ndarray) -> tuple:
            return (tokens.tobytes(),)

        with small_batches(self.spark, 1000):
            sets = self.scratch.stage(self._sets(wanted, make, "tokens binary", filtered=True), "cells-sets")

        def run(table: pa.Table) -> pa.Table:
            node = table.column("node").to_numpy()
            label = _forest(raw_bytes(table.column("tokens")), num, den)
            at = np.flatnonzero(label != np.arange(len(label)))
            return pa.table([pa.array(node[label[at]]), pa.array(node[at])], names=["a", "b"])

        by = ["token", "part", "low", "high"]
        waves, names = self.waves(sent, "node", wanted), []
        for wave in range(waves):
            now = sent.where(_in_wave(wave, waves, *by)).join(sets, "node").groupBy(*by).applyInArrow(run, "a long, b long")
            names.append(f"cells-{wave}")
            self.scratch.stage(now.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), names[-1])
        parts = [self.spark.read.schema("a long, b long").parquet(self.scratch.path(name)) for name in names]
        found = self.scratch.stage(_union(parts).distinct(), "cells")
        self.scratch.drop(*names, "cells-all", "cells-sent", "cells-wanted", "cells-sets", "split-wanted", "split-sets")
        return found

    def verified(self, pairs: DataFrame, classes: DataFrame, name: str) -> DataFrame:
        """(a, b, shared, united) of the pairs, by their whole sets."""
        pairs = self.scratch.stage(pairs, f"{name}-pairs")
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = self.scratch.stage(classes.join(nodes, "node"), f"{name}-wanted")

        def make(tokens: np.ndarray, common: np.ndarray) -> tuple:
            return (tokens.tobytes(),)

        with small_batches(self.spark, 2000):
            sets = self.scratch.stage(self._sets(wanted, make, "tokens binary", filtered=True), f"{name}-sets")
        one = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
        two = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def shared(x: np.ndarray, y: np.ndarray) -> int:
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                return int((y[np.minimum(at, len(y) - 1)] == x).sum())

            for batch in batches:
                inter, union = [], []
                for i in range(batch.num_rows):
                    x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in ("ta", "tb"))
                    inter.append(n := shared(x, y))
                    union.append(len(x) + len(y) - n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a"), batch.column("b"), pa.array(inter, pa.int64()), pa.array(union, pa.int64())],
                    names=["a", "b", "shared", "united"],
                )

        kinds = "a long, b long, shared long, united long"
        waves, parts = self.waves(pairs, "a", wanted), []
        with small_batches(self.spark, 200):  # a row holds two whole sets
            for wave in range(waves):
                mine = _in_wave(wave, waves, "a")
                both = pairs.where(mine).join(one.where(mine), "a").join(two, "b")
                parts.append(f"{name}-verified/{wave}")
                self.scratch.stage(both.mapInArrow(run, kinds), parts[-1])
        found = self.spark.read.schema(kinds).parquet(*[self.scratch.path(part) for part in parts])
        self.scratch.drop(f"{name}-pairs", f"{name}-wanted", f"{name}-sets")
        return found

    def linked(self, verified: DataFrame) -> DataFrame:
        return verified.where(F.col("shared") * self.den >= F.col("united") * self.num).select("a", "b")

    def links(self, classes: DataFrame) -> DataFrame:
        """Edges (a, b) with the same components as all links."""
        lists = self.lists(classes)
        edges: list[DataFrame] = []
        nears: list[DataFrame] = []  # (token, part, node, center, apart) of each turn
        middles: list[DataFrame] = []  # those that may link with near ones although their centre didn't settle it
        short = [lists.where(F.col("size") <= SHORT)]
        long_ = lists.where(F.col("size") > SHORT)
        limit, slack = 1 - self.num / self.den, 1e-9
        for turn in range(ROUNDS):
            if long_.isEmpty():
                break
            stars = long_.where("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
            known = self.verified(stars, classes, f"star-{turn}")
            edges.append(self.linked(known))
            apart = (F.lit(1.0) - F.col("shared") / F.col("united")).alias("apart")
            members = self.scratch.stage(
                long_.join(known.select(F.col("a").alias("center"), F.col("b").alias("node"), apart), ["center", "node"], "left")
                .select("token", F.lit(-1 - turn).cast("long").alias("part"), "node", "center", "n", "pos", F.coalesce("apart", F.lit(0.0)).alias("apart")),
                f"members-{turn}",
            )
            rest = members.where(F.col("apart") > limit - slack)
            nears.append(members.where(F.col("apart") <= limit + slack).drop("n", "pos"))
            middles.append(rest.where(F.col("apart") <= 2 * limit + slack).drop("n", "pos"))
            left = rest.select("token", "node", "n", "pos")
            again = self.scratch.stage(left.join(_measured(left), "token"), f"long-{turn}")
            short.append(again.where(F.col("size") <= SHORT))
            long_ = again.where(F.col("size") > SHORT)
        # a token's list is short once, so all lists meet themselves in one join
        pairs = self.pairs_within(_union(short))
        sent = [] if long_.isEmpty() else [self.dealt(long_, classes)]
        if edges:
            reach = components(self.scratch.stage(_union(edges), "edges"), self.scratch, "reach")

            def apart_from(rows: DataFrame, a: str, b: str) -> DataFrame:
                """Rows whose nodes aren't known to be in one component."""
                x, y = (reach.select(F.col("node").alias(c), F.col("component").alias(f"c{c}")) for c in (a, b))
                both = rows.join(x, a, "left").join(y, b, "left")
                return both.where(F.coalesce(f"c{a}", a) != F.coalesce(f"c{b}", b)).select(rows.columns)

            pairs = apart_from(pairs, "a", "b")
            middle = self.scratch.stage(apart_from(_union(middles), "node", "center"), "middle")
            sent.append(self.crossed(_union(nears), middle, limit + slack))
        if sent:
            edges.append(self.cells(_union(sent), classes))
        edges.append(self.linked(self.verified(pairs, classes, "pairs")))
        return _union(edges)


def _measured(lists: DataFrame) -> DataFrame:
    """(token, size, center) of the lists with more than one member."""
    sizes = lists.groupBy("token").agg(F.count(F.lit(1)).alias("size"), F.min_by("node", "pos").alias("center"))
    return sizes.where("size > 1")


def _in_wave(wave: int, waves: int, *by: str):
    """Rows of one of so many waves; rows with equal `by` are in the same."""
    return F.lit(True) if waves == 1 else F.pmod(F.xxhash64(*by), F.lit(waves)) == wave


def _distinct_cells(sent: DataFrame) -> DataFrame:
    """The rows of one cell of all that have the same nodes, as lists of several tokens often do; its links are theirs.

    Nodes are compared by their number and two sums of 64-bit hashes.
    """
    by = ["token", "part", "low", "high"]
    sums = [F.sum(F.xxhash64("node", F.lit(i)).cast("decimal(20,0)")).alias(f"sum{i}") for i in (0, 1)]
    kinds = sent.groupBy(*by).agg(F.count(F.lit(1)).alias("members"), *sums)
    first = kinds.groupBy("members", "sum0", "sum1").agg(F.min(F.struct(*by)).alias("cell")).select("cell.*")
    return sent.join(first, by).select(sent.columns)


def _forest(sets: list[bytes], num: int, den: int) -> np.ndarray:
    """Of each set the smallest place reachable by links among these sets."""
    sizes = np.array([len(x) // 8 for x in sets], np.int64)
    tokens, of = np.frombuffer(b"".join(sets), np.uint64), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(tokens)
    tokens, of = tokens[order], of[order]
    new = np.concatenate(([True], tokens[1:] != tokens[:-1]))
    name = np.cumsum(new) - 1
    common = np.bincount(name) > 1  # a token of one set is shared with none
    kept = common[name]
    of, name = of[kept], (np.cumsum(common) - 1)[name[kept]]
    shared = np.zeros((len(sets), len(sets)), np.float32)  # counts below 2^24 are exact
    width = 2048
    for first in range(0, int(common.sum()), width):
        a, b = np.searchsorted(name, (first, first + width))
        has = np.zeros((len(sets), width), np.float32)
        has[of[a:b], name[a:b] - first] = 1
        shared += has @ has.T
    shared = shared.astype(np.int64)
    link = shared * den >= (sizes[:, None] + sizes - shared) * num
    label = np.arange(len(sets))
    np.fill_diagonal(link, True)
    while True:
        least = np.where(link, label, len(sets)).min(axis=1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def similar_documents(
    docs: DataFrame, width: int = 5, num: int = 4, den: int = 5, key: str = "doc_id", text: str = "text",
    *, digests: bool = False,
) -> DataFrame:
    """(key, n_shingles, component_id) of every row: components of links den * shared >= num * united.

    Sets hold the distinct shingles of `width` words of the whole text, letters
    A-Z lowered; component_id is the smallest key reachable.  A text that is
    null or has no word has no shingles and no links.  Rows with a null key
    belong to no component (null).  Repeated rows have the same component each.
    An empty table gives no rows; other columns are ignored.  Sets are compared
    by 64-bit hashes of shingles, equal sets known by a 64-bit hash.  With
    `digests`, text_sha256 tells rows apart that repeat a key with other texts,
    and group_id their components.
    """
    join = _Join(docs, width, num, den, key, text, digests)
    rows, classes = join.profile()
    found = components(join.links(classes), join.scratch, "final")
    reps = classes.select("node", "rep")
    of = found.join(reps, "node").select("node", "component", "rep")
    least = of.groupBy("component").agg(F.min("rep").alias("first"))
    labels = join.scratch.stage(of.join(least, "component").select("node", "first", "component"), "labels")
    join.counts.destroy()
    turns = [f"{name}-{turn}" for turn in range(ROUNDS) for name in ("star", "members", "long")]
    join.scratch.drop("lists", "edges", "middle", "cells", "pairs-verified", *(t + "-verified" * t.startswith("star") for t in turns))
    named = rows.join(reps, "node", "left").join(labels, "node", "left")
    component = F.when(F.col("n") > 0, F.coalesce("first", "rep")).otherwise(F.col("key"))
    return named.select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNotNull(), component).alias("component_id"),
        *([F.col("digest").alias("text_sha256"), F.coalesce("component", "node").alias("group_id")] if digests else []),
    )
