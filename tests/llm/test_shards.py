import math
import struct
import zlib
from collections import defaultdict

import xxhash

from srcweave.llm import shards

SF = "/root/testdata/sf0.01/documents.parquet"


def draw(key, child):
    seed = 42
    if key is not None:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", key), seed=seed)
    bits = xxhash.xxh64_intdigest(child.name.encode(), seed=seed) >> 11
    return -math.log((bits + 0.5) / 2**53) / child.weight


def brute(node, key):
    while node.shard is None:
        node = min(node.children, key=lambda c: draw(key, c))
    return node.shard


def test_descent_slots_and_growth(spark):
    root = shards.tree(2, 3, 4)
    docs = spark.read.parquet(SF)
    rows = shards.assign_shards(docs, root).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    slots = defaultdict(list)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
        assert r.shard == brute(root, r.doc_id)
        assert r.grown_shard == brute(shards.grown(root), r.doc_id)
        assert r.grown_shard in (r.shard, 24)
        slots[r.shard].append((r.slot, r.doc_id))
    assert sum(r.grown_shard == 24 for r in rows) > 0
    for found in slots.values():
        assert [s for s, _ in sorted(found)] == list(range(len(found)))
        assert [d for _, d in sorted(found)] == sorted(d for _, d in found)


def test_weights_and_zero_weight(spark):
    root = shards.tree(1, 2, 2, {0: 3.0, 3: 0.0})
    rows = shards.with_shard(spark.range(4000), root, "id", "shard").groupBy("shard").count().collect()
    share = {r.shard: r["count"] / 4000 for r in rows}
    assert set(share) == {0, 1, 2}
    assert abs(share[0] - 0.6) < 0.05


def test_a_changed_weight_moves_rows_only_out_of_or_into_its_subtree(spark):
    old, new = shards.tree(2, 2, 2), shards.tree(2, 2, 2, {5: 2.0})
    both = shards.with_shard(shards.with_shard(spark.range(3000), old, "id", "a"), new, "id", "b")
    moved = both.where("a <> b").collect()
    assert moved
    assert all(r.b in (4, 5, 6, 7) for r in moved)  # into the region of shard 5
    assert all(r.b in (4, 5) for r in moved if r.a >= 4)  # within it, into its rack
    assert all(r.b == 5 for r in moved if r.a in (4, 5))


def test_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, shard string, slot int, size int"
    data = [(1, None, "x", 0, 0), (1, None, "x", 0, 0), (None, "a", None, 1, 1), (2, "é" * 100_000, "y", 2, 2), (3, "", "", 3, 3)]
    docs = spark.createDataFrame(data, schema)
    rows = shards.assign_shards(docs, shards.tree(1, 1, 1)).collect()
    assert sorted(r.slot for r in rows) == [0, 1, 2, 3, 4]
    assert sorted(r["size"] for r in rows) == [8, 8, 8, 9, 200_008]
    assert shards.assign_shards(docs.limit(0), shards.tree(2, 3, 4)).count() == 0
    shards.write_shards(docs, shards.tree(2, 3, 4), str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 5 and set(back.columns) == {*docs.columns, "shard_"}
