"""Removal of byte strings repeated across documents, by a distributed suffix sort.

A byte goes if a string of LENGTH bytes over it also starts in a document with
a smaller key.  Sorting every suffix would move many times the text, so the
work is cut down first, without losing a string:

1. Anchors.  Among the GRAM-byte strings of every LENGTH bytes the one with the
   smallest hash is an anchor, so equal strings of LENGTH bytes hold the same
   anchor at the same place.  An anchor's context is all the bytes of the
   strings that hold it.  (anchor, context hash, key) entries are packed and
   grouped by anchor.  An anchor in one document only is dropped; a context
   that a smaller document also has is covered whole; what is left are the
   first holders of each context of an anchor that has several.
2. Suffix sort.  The contexts left are grouped by anchor, so strings that may
   be equal meet; the suffixes of each group of contexts are sorted to LENGTH
   bytes by prefix tripling (`suffixes`): of suffixes with one rank, the strings
   whose smallest holder is another document are covered.
3. Covered strings come back to their documents and are cut out.

Contexts of an anchor with very many of them (text repeated everywhere with
different neighbours) would make one large group: within a task more than HOT
contexts of an anchor are spread by their hash in step 1, and in step 2 the
strings of these, and of anchors with more than GROUP contexts, are compared by
64-bit hash with an ordinary aggregation.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from srcweave.llm.common import Scratch, raw_bytes, sized_slices
from srcweave.llm.shingles import _powers, mixed
from srcweave.llm.suffixes import suffix_ranks

LENGTH = 50
GRAM = 20
HOT = 2000
SPREAD = 64
# Contexts of one anchor that are still sorted together.
GROUP = 10_000
# Anchors of a task before they are packed and sent; text of one suffix sort, small enough for
# a processor's cache; packed bytes of one bucket.
FLUSH = 1_000_000
SORTED_BYTES = 250_000
BUCKET_BYTES = 12 << 20
_STARTS = LENGTH - GRAM + 1  # strings that hold an anchor


_SHORT = np.uint64(16)  # 48 bits of each of the two hashes are sent


def _slide(x: np.ndarray, width: int, take) -> np.ndarray:
    """`take` over every `width` consecutive values."""
    y, have = x, 1
    while have * 2 <= width:
        y, have = take(y[:-have], y[have:]), have * 2
    n = len(x) - width + 1
    return take(y[:n], y[width - have : width - have + n])


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, context hash, number of the text, place in the text) of all anchors."""
    flat = np.frombuffer(b"".join(texts), np.uint8)
    n = len(flat)
    if n < LENGTH:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    up, down = _powers(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(mixed(np.arange(256, dtype=np.uint64), 1)[flat] * up[:n], out=sums[1:])
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    of = np.repeat(np.arange(len(texts)), sizes)
    grams = n - GRAM + 1
    h = mixed((sums[GRAM:] - sums[:grams]) * down[:grams], 7)
    least = _slide(h, _STARTS, np.minimum)
    least[of[: len(least)] != of[LENGTH - 1 :]] = 0  # strings across two texts
    edge = np.zeros(_STARTS - 1, np.uint64)
    most = _slide(np.concatenate((edge, least, edge)), _STARTS, np.maximum)
    at = np.flatnonzero(most == h)
    doc = of[at]
    s, e = np.maximum(at - (LENGTH - GRAM), starts[doc]), np.minimum(at + LENGTH, ends[doc])
    place = ((at - s) * 64 + (e - at)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return h[at] >> _SHORT, mixed((sums[e] - sums[s]) * down[s] + place, 8) >> _SHORT, doc, at - starts[doc]


def _first(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination of the sorted columns begins."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = False
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return new


def _spans(new: np.ndarray) -> np.ndarray:
    return np.cumsum(new) - 1


def _planes(x: np.ndarray) -> bytes:
    """Numbers as planes of bytes, first bytes first, so that empty high bytes compress."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


_ENTRY = "bucket int, kind int, n long, data binary"


def _pack(kind: int, bucket: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each bucket, holding its entries column by column."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    edges = np.flatnonzero(_first(bucket)).tolist() + [len(bucket)]
    columns = [c[order] for c in columns]
    for a, b in zip(edges, edges[1:], strict=False):
        data = b"".join(_planes(c[a:b]) for c in columns)
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(bucket[a])], pa.int32()), pa.array([kind], pa.int32()), pa.array([b - a]), pa.array([data])],
            names=["bucket", "kind", "n", "data"],
        )


def _entries(rows: list[dict]) -> list[np.ndarray]:
    """anchor, context, key, place of packed rows."""
    kinds = (np.uint64, np.uint64, np.int64, np.int32)
    found: list[list[np.ndarray]] = [[] for _ in kinds]
    for r in rows:
        at = 0
        for part, kind in zip(found, kinds, strict=True):
            size = r["n"] * np.dtype(kind).itemsize
            planes = np.frombuffer(r["data"], np.uint8, size, at).reshape(-1, r["n"])
            part.append(np.ascontiguousarray(planes.T).view(kind)[:, 0])
            at += size
    return [np.concatenate(p) if p else np.zeros(0, k) for p, k in zip(found, kinds, strict=True)]


COVERED, OPEN, OPEN_HOT = 1, 2, 3


def _settled(table: pa.Table) -> pa.Table:
    """Entries of one bucket: those covered whole, and the first holders of contexts still to be compared."""
    rows = table.select(["kind", "n", "data"]).to_pylist()
    out = []
    passed = _entries([r for r in rows if r["kind"] == 1])
    out.append((*passed, np.full(len(passed[0]), COVERED)))
    for kind in (0, 2):  # 2: part of the contexts of a hot anchor
        g, c, key, place = _entries([r for r in rows if r["kind"] == kind])
        order = np.lexsort((key, c, g))
        g, c, key, place = g[order], c[order], key[order], place[order]
        if not len(g):
            continue
        new_g, new_c = _first(g), _first(g, c)
        anchor, context = _spans(new_g), _spans(new_c)
        holder = key[new_c]
        later = key > holder[context]
        contexts = np.bincount(anchor, weights=new_c)[anchor]
        # several contexts, and a second document
        several = np.ones(len(g), bool)
        if kind == 0:
            low, high = (f.reduceat(key, np.flatnonzero(new_g)) for f in (np.minimum, np.maximum))
            several = (contexts > 1) & (low != high)[anchor]
        many = OPEN_HOT if kind == 2 else np.where(contexts > GROUP, OPEN_HOT, OPEN)
        state = np.where(later, COVERED, np.where(several, many, 0))
        kept = state > 0
        out.append((g[kept], c[kept], key[kept], place[kept], state[kept]))
    g, c, key, place, state = (np.concatenate(x) for x in zip(*out, strict=True))
    return pa.table(
        [pa.array(g.view(np.int64)), pa.array(c.view(np.int64)), pa.array(key), pa.array(place), pa.array(state.astype(np.int32))],
        names=["g", "c", "key", "place", "state"],
    )


def _compared(table: pa.Table) -> pa.Table:
    """Strings of the contexts of a group that a smaller document holds as well, by suffix sort."""
    rows = table.sort_by([("g", "ascending")])
    g = rows.column("g").to_numpy()
    texts = raw_bytes(rows.column("text"))
    sizes = [len(t) + 1 for t in texts]
    edges = np.flatnonzero(_first(g)).tolist() + [len(g)]
    weight = np.concatenate(([0], np.cumsum(sizes)))
    masks = np.zeros(len(g), np.int64)
    keys, lead = rows.column("key").to_numpy(), rows.column("lead").to_numpy()
    for a, b in sized_slices([int(weight[y] - weight[x]) for x, y in zip(edges, edges[1:], strict=False)], SORTED_BYTES):
        first, last = edges[a], edges[b]
        flat = np.frombuffer(b"\0".join(texts[first:last]) + b"\0", np.uint8).astype(np.int64) + 1
        rank = suffix_ranks(flat, LENGTH)
        count = np.array(sizes[first:last], np.int64) - LENGTH  # strings that fit
        of = np.repeat(np.arange(first, last), count)
        start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        held = rank[weight[of] - weight[first] + start]
        key = keys[of]
        order = np.lexsort((key, held))
        new = _first(held[order])
        smallest = key[order][new][_spans(new)]
        hit = order[key[order] > smallest]
        np.bitwise_or.at(masks, of[hit], np.int64(1) << (start[hit] - lead[of[hit]] + LENGTH - GRAM))
    return rows.select(["key", "place", "c"]).append_column("mask", pa.array(masks)).filter(pa.array(masks != 0))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, spans, kept) of every row: merged byte spans [start, end) removed, and the bytes left.

    Texts are UTF-8 bytes and judged as given; strings never cross texts.  A
    null text is empty; one below LENGTH bytes loses nothing.  `key` is an
    integer.  Rows with equal keys don't remove from each other; a row with a
    null key loses nothing and removes nothing.  An empty table gives no rows;
    other columns are ignored.  Contexts are told apart by 96 bits of
    hashes, strings inside a suffix sort by their bytes.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    given = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    volume = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(shuffles, math.ceil(volume / _STARTS * 2 * 28 / BUCKET_BYTES))
    parts = max(shuffles, math.ceil(volume / (64 << 20)))
    table = "repeats_" + scratch.root.rsplit("-", 1)[1]
    placed = given.where(F.octet_length("text") >= LENGTH).where("key is not null")
    (
        placed.repartition(parts, "key")
        .write.option("path", scratch.path("texts"))
        .option("compression", "zstd")
        .bucketBy(parts, "key")
        .saveAsTable(table)
    )
    texts = spark.table(table)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            g, c, k, place = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((k, c, g))
            g, c, k, place = g[order], c[order], k[order], place[order]
            new_c = _first(g, c)
            later = k > k[new_c][_spans(new_c)]
            spread = (k % buckets).astype(np.int32)
            yield from _pack(1, spread[later], g[later], c[later], k[later], place[later])
            g, c, k, place, new_c = g[~later], c[~later], k[~later], place[~later], new_c[~later]
            new_g = _first(g)
            hot = (np.bincount(_spans(new_g), weights=new_c) > HOT)[_spans(new_g)] if len(g) else new_g
            home = (mixed(g, 9) % np.uint64(buckets)).astype(np.int32)
            stay = ~hot
            if hot.any():  # its first and last document tell the others' bucket that it is shared
                low, high = (f.reduceat(k, np.flatnonzero(new_g))[_spans(new_g)] for f in (np.minimum, np.maximum))
                stay |= (k == low) | (k == high)
            yield from _pack(0, home[stay], g[stay], c[stay], k[stay], place[stay])
            away = (mixed(g[hot] + c[hot] % np.uint64(SPREAD), 9) % np.uint64(buckets)).astype(np.int32)
            yield from _pack(2, away, g[hot], c[hot], k[hot], place[hot])

        waiting = 0
        for batch in batches:
            keys, raw = batch.column("key").to_numpy(), raw_bytes(batch.column("text"))
            for a, b in sized_slices(map(len, raw), 2 << 20):
                g, c, doc, place = anchors(raw[a:b])
                held.append((g, c, keys[a:b][doc], place.astype(np.int32)))
                waiting += len(g)
                if waiting > FLUSH:
                    yield from flush()
                    waiting = 0
        if waiting:
            yield from flush()

    found = scratch.stage(
        texts.mapInArrow(find, _ENTRY)
        .groupBy("bucket")
        .applyInArrow(_settled, "g long, c long, key long, place int, state int"),
        "found",
    )
    hot = found.where(F.col("state") == OPEN_HOT).select("g").distinct()
    open_ = found.where(F.col("state") >= OPEN).join(hot.withColumn("hot", F.lit(True)), "g", "left")
    asked = open_.groupBy("key").agg(F.collect_list(F.struct("place", "g", "c", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("asked"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = raw_bytes(batch.column("text"))
            for first, last in sized_slices(map(len, raw), 2 << 20):
                doc, ask = _listed(batch.column("asked").slice(first, last - first), ("place", "g", "c", "hot"))
                known = _known(raw[first:last], doc, ask["place"], ask["c"])
                doc, ask = doc[known], {name: x[known] for name, x in ask.items()}
                lead = np.minimum(ask["place"], LENGTH - GRAM)
                texts_ = [
                    raw[first + d][p - n : p + LENGTH]
                    for d, p, n in zip(doc.tolist(), ask["place"].tolist(), lead.tolist(), strict=True)
                ]
                keys = batch.column("key").slice(first, last - first).take(pa.array(doc))
                columns = [pa.array(ask["g"]), keys, pa.array(ask["place"]), pa.array(ask["c"]), pa.array(ask["hot"])]
                columns += [pa.array(lead.astype(np.int32)), pa.array(texts_, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["g", "key", "place", "c", "hot", "lead", "text"])

    contexts = scratch.stage(
        texts.join(asked.repartition(parts, "key"), "key").mapInArrow(
            cut, "g long, key long, place int, c long, hot boolean, lead int, text binary"
        ),
        "contexts",
    )
    groups = max(shuffles, math.ceil((contexts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / (4 << 20)))
    plain = contexts.where("not hot").select("g", "key", "place", "c", "lead", "text", F.pmod(F.xxhash64("g"), F.lit(groups)).alias("group"))
    sorted_ = plain.groupBy("group").applyInArrow(_compared, "key long, place int, c long, mask long")
    starts = F.sequence(F.lit(0), F.octet_length("text") - LENGTH)
    strings = (
        contexts.where("hot")
        .select("key", "place", "c", "lead", "text", F.explode(starts).alias("start"))
        .select("key", "place", "c", F.expr(f"start - lead + {LENGTH - GRAM}").alias("nth"), F.expr(f"xxhash64(substring(text, start + 1, {LENGTH}))").alias("h"))
    )
    smallest = strings.groupBy("h").agg(F.min("key").alias("least"))
    hashed = (
        strings.join(smallest, "h")
        .where("key > least")
        .groupBy("key", "place", "c")
        .agg(F.bit_or(F.expr("shiftleft(1L, nth)")).alias("mask"))
    )
    whole = F.lit((1 << _STARTS) - 1)
    masks = (
        found.where(F.col("state") == COVERED)
        .select("key", "place", "c", whole.alias("mask"))
        .unionByName(sorted_)
        .unionByName(hashed)
        .groupBy("key")
        .agg(F.collect_list(F.struct("place", "c", "mask")).alias("masks"))
    )
    schema = "key long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = raw_bytes(batch.column("text"))
            for first, last in sized_slices(map(len, raw), 2 << 20):
                own = raw[first:last]
                doc, masks_ = _listed(batch.column("masks").slice(first, last - first), ("place", "c", "mask"))
                gone = _gone(own, doc, masks_["place"], masks_["c"], masks_["mask"])
                kept = []
                for t, pairs in zip(own, gone, strict=True):
                    at = [0, *(x for pair in pairs for x in pair), len(t)]
                    kept.append(b"".join(t[s:e] for s, e in zip(at[::2], at[1::2], strict=True)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(first, last - first),
                        pa.array([len(t) for t in own], pa.int64()),
                        pa.array([[{"start": s, "end": e} for s, e in pairs] for pairs in gone], kind),
                        pa.array(kept, pa.binary()),
                    ],
                    names=["key", "n_bytes", "spans", "kept"],
                )

    judged = texts.join(masks.repartition(parts, "key"), "key", "left").mapInArrow(remove, schema)
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    others = given.where(F.expr(f"key is null or text is null or octet_length(text) < {LENGTH}")).select(
        "key",
        F.octet_length(raw).cast("long").alias("n_bytes"),
        F.array().cast("array<struct<start: bigint, end: bigint>>").alias("spans"),
        raw.alias("kept"),
    )
    return judged.unionByName(others).withColumnRenamed("key", key)


def _listed(column: pa.Array, names: tuple[str, ...]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Row number and fields of all structs in a list column; a null list has none."""
    flat = column.flatten()
    sizes = column.value_lengths().fill_null(0).to_numpy()
    fields = {name: flat.field(name).to_numpy(zero_copy_only=False) for name in names}
    return np.repeat(np.arange(len(column)), sizes), fields


def _known(texts: list[bytes], doc: np.ndarray, place: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Whether the text has that context there; a row of the same key may have another text."""
    _, c, of, at = anchors(texts)
    if not len(at):
        return np.zeros(len(doc), bool)
    found = (of << 40) | at
    wanted = (doc.astype(np.int64) << 40) | place
    i = np.minimum(np.searchsorted(found, wanted), len(found) - 1)
    return (found[i] == wanted) & (c[i].view(np.int64) == context)


def _gone(
    texts: list[bytes], doc: np.ndarray, place: np.ndarray, context: np.ndarray, mask: np.ndarray
) -> list[list[tuple[int, int]]]:
    """Merged spans of each text covered by the strings that the masks of its contexts name."""
    known = _known(texts, doc, place, context)
    doc, place, mask = doc[known], place[known].astype(np.int64), mask[known]
    sizes = np.array([len(t) for t in texts], np.int64)
    base = np.cumsum(sizes + 1) - sizes - 1  # a byte between texts keeps spans apart
    edge = np.zeros(int((sizes + 1).sum()) + 1, np.int32)
    whole = mask == (1 << _STARTS) - 1
    first = np.maximum(place[whole] - (LENGTH - GRAM), 0) + base[doc[whole]]
    last = np.minimum(place[whole], sizes[doc[whole]] - LENGTH) + base[doc[whole]] + LENGTH
    np.add.at(edge, first, 1)
    np.add.at(edge, last, -1)
    start, bits = (place + base[doc] - (LENGTH - GRAM))[~whole], mask[~whole]
    for i in range(_STARTS):
        hit = start[(bits >> i) & 1 == 1] + i
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + LENGTH, -1)
    turn = np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(edge) > 0)).astype(np.int8)))
    starts, ends = turn[::2], turn[1::2]
    of = np.searchsorted(base, starts, side="right") - 1
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    for d, s, e in zip(of.tolist(), (starts - base[of]).tolist(), (ends - base[of]).tolist(), strict=True):
        spans[d].append((s, e))
    return spans


def digests(removed: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and the checksum of what is left, from the rows of `remove_repeats`."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return removed.select(
        key,
        "n_bytes",
        gone.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
