"""Exact top-k inner products over norm-sorted, SVD-rotated vectors.

Candidates are sorted by descending length and packed into blocks.  Blocks are
dealt over lanes so that every lane begins with long vectors.  A task takes one
lane and one group of queries and walks the lane's blocks in order: the product
is bounded by |q||c|, so once that is below a query's k-th score for the
longest vector left, the rest of the lane is skipped.  Within a block a partial
sum over the HEAD leading singular directions plus the Cauchy-Schwarz bound of
the remaining ones discards candidates; survivors get their exact integer
product.  Lanes are merged by query at the end.

Work is queries times candidates before pruning, in blocks: a lane's vectors
are sent once for each group of queries and a query once to each lane.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from srcweave.llm.common import Scratch

BLOCK = 2048
LANE_BLOCKS = 32
QUERY_BLOCK = 512
GROUP_BLOCKS = 16
HEAD = 16
_EXACT = float(1 << 53)  # up to here doubles hold integers exactly


def quantised(vector: str | Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component as an integer; null if a component or the vector is unusable or it is empty."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite & (F.size(vector) > 0), F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _runs(dims: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(dims)) + 1
    return zip([0, *edges.tolist()], [*edges.tolist(), len(dims)], strict=True)


def _rotations(rows: DataFrame) -> dict[int, np.ndarray]:
    """Right singular vectors of all vectors of each dimension, largest singular value first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for d in np.unique(dims).tolist():
                own = _matrix(batch.column("v").filter(pa.array(dims == d))).astype(np.float64)
                sums[d] = sums.get(d, 0) + own.T @ own
        for d, gram in sums.items():
            i, j = np.triu_indices(d)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), d), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(gram[i, j])],
                names=["dim", "i", "j", "x"],
            )

    parts = rows.select("dim", "v").mapInArrow(run, "dim int, i int, j int, x double")
    found: dict[int, np.ndarray] = {}
    for r in parts.groupBy("dim", "i", "j").agg(F.sum("x").alias("x")).toLocalIterator():
        gram = found.setdefault(r["dim"], np.zeros((r["dim"], r["dim"])))
        gram[r["i"], r["j"]] = gram[r["j"], r["i"]] = r["x"]
    return {d: np.linalg.eigh(gram)[1][:, ::-1].copy() for d, gram in found.items()}


def _packed(rows: DataFrame, size: int, best: int | None) -> DataFrame:
    """Blocks of rows in the order they come.

    Of equal vectors next to each other only those of the first `best` + 1 ids
    stay, up to `best` rows of each id: among them are the first `best` rows
    by id that don't have the id of a query, whichever that is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for a, b in _runs(dims) if len(dims) else ():
                for s in range(a, b, size):
                    n = min(size, b - s)
                    ids = batch.column("id").slice(s, n).to_numpy()
                    v = _matrix(batch.column("v").slice(s, n))
                    if best is not None:
                        new = np.concatenate(([True], (v[1:] != v[:-1]).any(1)))
                        other = new | np.concatenate(([True], ids[1:] != ids[:-1]))
                        number = np.cumsum(other)
                        id_place = number - number[np.flatnonzero(new)[np.cumsum(new) - 1]]
                        row_place = np.arange(n) - np.flatnonzero(other)[number - 1]
                        kept = (id_place <= best) & (row_place < best)
                        ids, v = ids[kept], v[kept]
                    longest = float(np.sqrt((v.astype(np.float64) ** 2).sum(1)).max())
                    kind = next(k for k in (np.int16, np.int32, np.int64) if np.abs(v).max() <= np.iinfo(k).max)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([int(dims[a])], pa.int32()),
                            pa.array([(part << 32) + made], pa.int64()),
                            pa.array([longest]),
                            pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                            pa.array([np.dtype(kind).str]),
                            pa.array([v.astype(kind).tobytes()], pa.binary()),
                        ],
                        names=["dim", "block", "longest", "ids", "kind", "v"],
                    )
                    made += 1

    return rows.select("id", "dim", "v").mapInArrow(
        run, "dim int, block long, longest double, ids binary, kind string, v binary"
    )


def _unpacked(blocks: pa.Table) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
    """(longest, ids, vectors) of blocks, longest first."""
    rows = sorted(blocks.to_pylist(), key=lambda r: (-r["longest"], r["block"]))
    for r in rows:
        ids = np.frombuffer(r["ids"], "<i8")
        yield r["longest"], ids, np.frombuffer(r["v"], r["kind"]).reshape(len(ids), -1)


def _best(found: tuple, k: int) -> tuple:
    """The k best (score, then smaller id) of each query among (query, score, id) arrays."""
    query, score, ids = found
    order = np.lexsort((ids, -score, query))
    query, score, ids = query[order], score[order], ids[order]
    first = np.concatenate(([True], query[1:] != query[:-1])) if len(query) else np.zeros(0, bool)
    place = np.arange(len(query)) - np.flatnonzero(first)[np.cumsum(first) - 1] if len(query) else np.arange(0)
    kept = place < k
    return query[kept], score[kept], ids[kept]


def search_lane(blocks, ids: np.ndarray, queries: np.ndarray, rotation: np.ndarray, k: int) -> tuple:
    """(query number, score, id) of the k best candidates of each query, blocks given longest first.

    A block meets QUERY_BLOCK queries at a time, which bounds the tables of
    scores whatever the number of queries.
    """
    exact = queries.astype(np.float64)
    turned = exact @ rotation
    lengths = np.sqrt((exact**2).sum(1))
    rest = np.sqrt((turned[:, HEAD:] ** 2).sum(1))
    largest = float(np.abs(exact).max(initial=0))
    found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    bar = np.full(len(ids), -np.inf)  # k-th score so far
    for longest, own, vectors in blocks:
        bound = lengths * longest
        slack = 1e-6 * (1 + bound)
        alive = np.flatnonzero(bound + slack >= bar)
        if not len(alive):
            break
        c = vectors.astype(np.float64)
        wide = largest * float(np.abs(c).max(initial=0)) * c.shape[1] >= _EXACT
        if not wide:
            cr = c @ rotation
            left_over = np.sqrt((cr[:, HEAD:] ** 2).sum(1))
        hits = [found]
        for some in (alive[at : at + QUERY_BLOCK] for at in range(0, len(alive), QUERY_BLOCK)):
            if wide:
                scores = queries[some].astype(np.int64) @ vectors.astype(np.int64).T
                open_ = np.ones(scores.shape, bool)
            else:
                upper = turned[some, :HEAD] @ cr[:, :HEAD].T
                upper += rest[some, None] * left_over[None, :]
                open_ = upper + slack[some, None] >= bar[some, None]
                if open_.mean() > 0.1:
                    scores = np.rint(exact[some] @ c.T).astype(np.int64)
                else:
                    i, j = np.nonzero(open_)
                    scores = np.zeros(open_.shape, np.int64)
                    for a in range(0, len(i), 1 << 16):
                        p, q = i[a : a + (1 << 16)], j[a : a + (1 << 16)]
                        scores[p, q] = np.rint(np.einsum("nd,nd->n", exact[some[p]], c[q])).astype(np.int64)
            open_ &= own[None, :] != ids[some, None]
            low = np.where(open_, scores, np.iinfo(np.int64).min)
            if low.shape[1] > k:  # only what may be among the block's own k best
                open_ &= scores >= np.partition(low, -k, axis=1)[:, -k][:, None]
            open_ &= scores >= bar[some, None]
            i, j = np.nonzero(open_)
            # ties may be many: of the block's own hits only the best go on
            hits.append(_best((some[i], scores[i, j], own[j]), k))
        found = _best(tuple(map(np.concatenate, zip(*hits, strict=True))), k)
        n = np.bincount(found[0], minlength=len(ids))
        full = np.flatnonzero(n == k)
        bar[full] = found[1][(np.cumsum(n) - 1)[full]]
    return found


def top_products(vectors: DataFrame, is_query: Column, k: int, key: str, ints: str) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query row with any other row.

    `ints` is a column of integer arrays; rows where it or `key` is null take
    no part, and vectors of different length don't meet.  Ties go to the
    smaller id; fewer than k candidates give fewer rows.  A row doesn't meet
    rows of its own id.  If an id occurs in several rows, each query row and
    each candidate row counts by itself.  Scores have to fit 64 bits.  An empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    given = vectors.select(F.col(key).cast("long").alias("id"), F.col(ints).alias("v"), is_query.alias("asks"))
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = scratch.stage(
        given.where("id is not null and v is not null").select("*", F.size("v").alias("dim"), norm2.alias("norm2")), "rows"
    )
    rotation = spark.sparkContext.broadcast(_rotations(rows))
    order = ["dim", F.col("norm2").desc(), F.xxhash64("v"), "id"]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = scratch.stage(_packed(sorted_rows, BLOCK, k), "blocks")
    asked = rows.where("asks").repartitionByRange(*order).sortWithinPartitions(*order)
    queries = scratch.stage(_packed(asked, QUERY_BLOCK, None), "queries")
    scratch.drop("rows")
    sizes = {r["dim"]: r["n"] for r in blocks.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    cores = spark.sparkContext.defaultParallelism
    lanes = {d: min(n, max(cores, math.ceil(n / LANE_BLOCKS))) for d, n in sizes.items()}
    asking = {r["dim"]: r["n"] for r in queries.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    groups = {d: math.ceil(n / GROUP_BLOCKS) for d, n in asking.items()}

    def per_dim(numbers: dict[int, int]) -> Column:
        chosen = F.lit(0)
        for d, n in numbers.items():
            chosen = F.when(F.col("dim") == d, n).otherwise(chosen)
        return chosen

    def dealt(df: DataFrame, numbers: dict[int, int], name: str) -> DataFrame:
        return df.select("*", F.pmod(F.xxhash64("block"), per_dim(numbers)).cast("int").alias(name)).where(per_dim(numbers) > 0)

    def copied(df: DataFrame, numbers: dict[int, int], name: str) -> DataFrame:
        return df.where(per_dim(numbers) > 0).select("*", F.explode(F.sequence(F.lit(0), per_dim(numbers) - 1)).alias(name))

    def search(key_, left: pa.Table, right: pa.Table) -> pa.Table:
        d, hits = key_[0].as_py(), []
        if len(left) and len(right):
            asks = list(_unpacked(left))
            ids, own = np.concatenate([x[1] for x in asks]), np.concatenate([x[2] for x in asks])
            at, score, other = search_lane(_unpacked(right), ids, own, rotation.value[d], k)
            hits = [ids[at], at, other, score]
        names = ["query_id", "asked", "vec_id", "score"]
        if not hits:
            hits = [np.zeros(0, np.int64)] * 4
        # which query row of the group: rows of one id are told apart
        group = int(key_[2].as_py())
        hits[1] = hits[1] + (group << 32)
        return pa.table([pa.array(x.astype(np.int64)) for x in hits], names=names)

    left = copied(dealt(queries, groups, "part"), lanes, "lane")
    right = copied(dealt(blocks, lanes, "lane"), groups, "part")
    found = (
        left.groupBy("dim", "lane", "part")
        .cogroup(right.groupBy("dim", "lane", "part"))
        .applyInArrow(search, "query_id long, asked long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id", "asked").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.select("*", F.row_number().over(best).alias("rank")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
