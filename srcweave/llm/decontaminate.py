"""Benchmark decontamination with an Aho-Corasick automaton.

Test items are cut into windows of consecutive normalised words; the windows
of all items go into one automaton, and each text is scanned once.  A match is
mapped back to words, and words to byte offsets of the text as it was given.

The windows of one automaton are bounded by PATTERN_BYTES.  A larger benchmark
gets more automata, scanned one after the other over the same texts with one in
memory at a time, and their matches are united; the result is the same.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from srcweave.llm.common import raw_bytes, worker_memory

# Characters of the windows of one automaton: a node for each, of some 50 bytes.
PATTERN_BYTES = 4 << 20
# A-Z to a-z; 0-9, a-z and every byte of a non-ASCII character stay; the rest separates words.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
        T.StructField(
            "spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
        ),
    ]
)


def normal_words(raw: bytes) -> list[bytes]:
    return raw.translate(_FOLD).split()


def windows(raw: bytes, width: int) -> Iterator[tuple[str, int]]:
    """(pattern, words in it): every `width` consecutive words, or all words of a shorter item."""
    words = normal_words(raw)
    size = min(width, len(words))
    for i in range(len(words) - size + 1 if words else 0):
        yield f" {b' '.join(words[i : i + size]).decode('latin-1')} ", size


def _pattern_groups(items: DataFrame, key: str, text: str, width: int):
    """Bounded dictionaries pattern -> (words, item ids), read through the driver one item at a time."""
    held: dict[str, tuple[int, set[str]]] = {}
    size = 0
    rows = items.where(F.col(text).isNotNull() & F.col(key).isNotNull())
    for row in rows.select(F.col(key).cast("string"), F.col(text).cast("binary")).toLocalIterator():
        for pattern, n in windows(bytes(row[1]), width):
            if pattern not in held:
                if size + len(pattern) > PATTERN_BYTES and held:
                    yield held
                    held, size = {}, 0
                size += len(pattern)
                held[pattern] = (n, set())
            held[pattern][1].add(row[0])
    if held:
        yield held


def _automaton(name: str, group) -> ahocorasick.Automaton:
    """The automaton of a broadcast group; a worker keeps the last one it built."""
    memory = worker_memory("automaton")
    if memory.get("automaton", ("",))[0] != name:
        made = ahocorasick.Automaton()
        for pattern, value in group.value.items():
            made.add_word(pattern, value)
        made.make_automaton()
        memory["automaton"] = (name, made)
    return memory["automaton"][1]


def _scan(automaton, joined: bytes) -> list[tuple[int, int, set[str]]]:
    """(last byte, words, items) of each occurrence in the joined words of a text."""
    return [(end, n, ids) for end, (n, ids) in automaton.iter(joined.decode("latin-1"))]


def _found(raw: bytes, n_words: int, joined: bytes, matches: list) -> tuple[int, list[str], list[dict]]:
    """Words hit, items, and merged byte spans of the text as given."""
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    edge = np.zeros(n_words + 1, np.int64)
    for end, n, _ in matches:
        last = int(np.searchsorted(gaps, end)) - 1
        edge[last + 1 - n] += 1
        edge[last + 1] -= 1
    hit = np.cumsum(edge[:-1]) > 0
    inside = np.frombuffer(raw.translate(_FOLD), np.uint8) != 32
    step = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    turn = np.diff(np.concatenate(([False], hit, [False])).astype(np.int8))
    spans = [
        {"start": int(starts[a]), "end": int(ends[b - 1])}
        for a, b in zip(np.flatnonzero(turn == 1), np.flatnonzero(turn == -1), strict=True)
    ]
    return int(hit.sum()), sorted(set().union(*(ids for _, _, ids in matches))), spans


def find_benchmark(
    docs: DataFrame, items: DataFrame, width: int = 10, text: str = "text", item_key: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Every row of `docs` with a struct column `found`: n_words, n_hit, item_ids, spans.

    found.spans are byte offsets [start, end) into the given text, merged over
    adjoining words.  A null or empty text has no words and no hit.  Items with
    a null id or text, or without words, take no part; an item given twice
    counts once.  Tables without rows, repeated rows and further columns are
    fine (a column `found` of the input is replaced).
    """
    spark = docs.sparkSession
    groups = {
        uuid.uuid4().hex: spark.sparkContext.broadcast(held)
        for held in _pattern_groups(items, item_key, item_text, width)
    }
    kept = docs.drop("found")
    schema = T.StructType([*kept.schema.fields, T.StructField("found", FOUND)])
    kind = pa.struct(
        [
            ("n_words", pa.int64()),
            ("n_hit", pa.int64()),
            ("item_ids", pa.list_(pa.string())),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw_bytes(batch.column(text))
            counts, matches = [0] * len(texts), [[] for _ in texts]
            for i, raw in enumerate(texts if not groups else ()):
                counts[i] = len(normal_words(raw))
            for name, group in groups.items():
                automaton = _automaton(name, group)
                for i, raw in enumerate(texts):
                    words = normal_words(raw)
                    counts[i] = len(words)
                    if words:
                        matches[i] += _scan(automaton, b" %b " % b" ".join(words))
            rows = []
            for raw, n, found in zip(texts, counts, matches, strict=True):
                hits, ids, spans = _found(raw, n, b" %b " % b" ".join(normal_words(raw)), found) if found else (0, [], [])
                rows.append({"n_words": n, "n_hit": hits, "item_ids": ids, "spans": spans})
            columns = [*batch.columns, pa.array(rows, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "found"])

    return kept.mapInArrow(run, schema)
