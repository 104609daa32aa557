"""Language identification by prediction by partial matching over bytes.

Each language has a context tree of order ORDER: how often each byte followed
each context of up to ORDER bytes.  A byte costs its code length under the
longest context the tree knows; a byte new to a context costs an escape (method
C) and is coded by the next shorter one, without the bytes already excluded,
down to all 256 bytes equally likely.  The statistics are frozen after
training, so a byte's cost depends on the ORDER + 1 bytes ending at it alone,
and all costs are laid out in one table.  A text belongs to the language that
codes it in the fewest bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from srcweave.llm.common import raw_bytes, slices

ORDER = 3
# Labelled texts learnt from, about so many for each language.
SAMPLE = 2000
UNDETERMINED = "und"


@dataclass
class Model:
    languages: list[str]
    symbols: bytes  # byte -> symbol number, as a translation table; the last number is for unknown bytes
    contexts: np.ndarray  # symbols of ORDER bytes as one number -> row of `bits`
    bits: np.ndarray  # (context * symbols + symbol, language) -> code length

    @property
    def n_symbols(self) -> int:
        return max(self.symbols) + 1


def _grams(texts: list[bytes]) -> np.ndarray:
    """Every byte with the ORDER bytes before it, packed; zero bytes stand before a text."""
    flat = np.frombuffer(b"".join(b"\0" * ORDER + t for t in texts), np.uint8).astype(np.uint32)
    packed = flat[:-ORDER] << (8 * ORDER)
    for i in range(1, ORDER + 1):
        packed |= flat[i : len(flat) - ORDER + i] << (8 * (ORDER - i))
    inside = np.ones(len(packed), bool)
    at = 0
    for t in texts:
        at += len(t)
        inside[at : at + ORDER] = False  # these end in the next text's padding
        at += ORDER
    return packed[inside[: len(packed)]]


def count_grams(labelled: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n) over all rows given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(lang).to_pylist(), raw_bytes(batch.column(text))
            for a, b in slices(texts):
                for name in sorted(set(langs[a:b])):
                    own = [t for t, x in zip(texts[a:b], langs[a:b], strict=True) if x == name and t]
                    if own:
                        grams, n = np.unique(_grams(own), return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * len(n)), pa.array(grams.astype(np.int64)), pa.array(n.astype(np.int64))],
                            names=["lang", "gram", "n"],
                        )

    parts = labelled.select(lang, text).mapInArrow(run, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """Learn from about `sample` labelled texts of each language.

    Rows without a text or language teach nothing; a text given twice counts
    once.  Sampling hashes the text alone, so it depends neither on the layout
    nor on other columns.
    """
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & (F.length(text) > 0))
    texts = F.approx_count_distinct(F.xxhash64(F.col(text))).alias("n")
    sizes = {r[lang]: r["n"] for r in rows.groupBy(lang).agg(texts).collect()}
    if not sizes:
        return Model([], bytes(256), np.zeros(1, np.int32), np.zeros((1, 0), np.float32))
    steps = 1 << 30
    drawn = F.pmod(F.xxhash64(F.col(text)), F.lit(steps))
    chosen = F.lit(False)
    for name, n in sizes.items():
        chosen |= (F.col(lang) == name) & (drawn < int(steps * min(1.0, sample / n)))
    counts = count_grams(rows.where(chosen).select(lang, text).distinct(), text, lang).toArrow()
    return build(counts["lang"].to_numpy().astype(str), counts["gram"].to_numpy(), counts["n"].to_numpy())


def build(langs: np.ndarray, grams: np.ndarray, n: np.ndarray) -> Model:
    """Cost table from gram counts."""
    languages = sorted(set(langs.tolist()))
    columns = [(grams >> (8 * (ORDER - i))) & 255 for i in range(ORDER + 1)]
    known = np.unique(np.concatenate(columns))
    size = len(known) + 1  # and one for every other byte
    table = np.full(256, size - 1, np.uint8)
    table[known] = np.arange(size - 1)
    code = [table[c].astype(np.int64) for c in columns]
    # Contexts of each order as numbers in base `size`, and each order's counts per language.
    lists, counts = [], []
    for order in range(ORDER + 1):
        number = np.zeros(len(grams), np.int64)
        for c in code[ORDER - order : ORDER]:
            number = number * size + c
        seen, place = np.unique(number, return_inverse=True)
        tally = np.zeros((len(languages), len(seen), size - 1), np.float64)
        np.add.at(tally, (np.searchsorted(languages, langs), place, code[ORDER]), n)
        lists.append(seen)
        counts.append(tally)
    bits = []
    for order in range(ORDER + 1):
        each = np.empty((len(lists[order]), size, len(languages)), np.float32)
        suffixes = [np.searchsorted(lists[j], lists[order] % size**j) for j in range(order + 1)]
        for k in range(len(languages)):
            each[:, :, k] = _code_lengths([counts[j][k] for j in range(order + 1)], suffixes)
        bits.append(each)
    first = np.cumsum([0, *(len(x) for x in lists[::-1])])  # longest contexts come first
    row = {order: first[ORDER - order] for order in range(ORDER + 1)}
    contexts = np.full(size**ORDER, row[0], np.int32)
    every = np.arange(size**ORDER, dtype=np.int64)
    for order in range(1, ORDER + 1):
        tail = every % size**order
        at = np.searchsorted(lists[order], tail).clip(max=len(lists[order]) - 1)
        contexts = np.where(lists[order][at] == tail, row[order] + at, contexts).astype(np.int32)
    laid = np.concatenate(bits[::-1]).reshape(-1, len(languages))
    return Model(languages, table.tobytes(), contexts, np.ascontiguousarray(laid))


def _code_lengths(tallies: list[np.ndarray], suffixes: list[np.ndarray]) -> np.ndarray:
    """Bits of every symbol after every context: tallies[j] are the counts of order j."""
    rows, symbols = len(suffixes[-1]), tallies[0].shape[1]
    bits = np.zeros((rows, symbols + 1))
    escape = np.zeros(rows)
    excluded = np.zeros((rows, symbols), bool)
    with np.errstate(divide="ignore", invalid="ignore"):
        for tally, suffix in zip(tallies[::-1], suffixes[::-1], strict=True):
            own = tally[suffix]
            open_counts = np.where(excluded, 0, own)
            total, kinds = open_counts.sum(1), (open_counts > 0).sum(1)
            price = escape[:, None] + np.log2(total + kinds)[:, None] - np.log2(open_counts)
            bits[:, :symbols] = np.where(open_counts > 0, price, bits[:, :symbols])
            escape += np.where(kinds > 0, np.log2(total + kinds) - np.log2(np.maximum(kinds, 1)), 0)
            excluded |= own > 0
    rest = escape + np.log2(256 - excluded.sum(1))
    bits[:, :symbols] = np.where(excluded, bits[:, :symbols], rest[:, None])
    bits[:, symbols] = rest
    return bits


def code_lengths(model: Model, texts: list[bytes]) -> np.ndarray:
    """Bits of each text in each language."""
    size = model.n_symbols
    pad = bytes(ORDER)
    flat = np.frombuffer(b"".join(pad + t for t in texts).translate(model.symbols), np.uint8)
    number = flat[:-ORDER].astype(np.int32)
    for i in range(1, ORDER):
        number *= size
        number += flat[i : len(flat) - ORDER + i]
    cell = model.contexts[number]
    cell *= size
    cell += flat[ORDER:]
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + ORDER) - sizes - ORDER
    edges = np.stack([starts, starts + sizes], 1).ravel()
    out = np.empty((len(texts), len(model.languages)))
    cell = np.append(cell, np.int32(0))
    for k in range(len(model.languages)):
        out[:, k] = np.add.reduceat(model.bits[:, k][cell], edges, dtype=np.float64)[::2]
    out[sizes == 0] = 0
    return out


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Every row of `docs` with `lang_pred` and `score`.

    score is the probability of that language among the learnt ones, all
    equally likely before.  A text that is null or has no letter is `und` with
    score 0, as is every text if nothing was learnt; ties go to the first name
    in order.  Columns of these names in the input are replaced.
    """
    kept = docs.drop("lang_pred", "score")
    schema = T.StructType(
        [*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.symbols, model.contexts, model.bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            texts = raw_bytes(batch.column(text))
            names, scores = [], []
            for a, b in slices(texts):
                lettered = [bool(own.languages) and any(map(str.isalpha, t.decode())) for t in texts[a:b]]
                if not any(lettered):
                    names += [UNDETERMINED] * (b - a)
                    scores += [0.0] * (b - a)
                    continue
                bits = code_lengths(own, texts[a:b])
                best = bits.argmin(1)
                chance = 1 / np.exp2(bits.min(1)[:, None] - bits).sum(1)
                names += [own.languages[k] if ok else UNDETERMINED for k, ok in zip(best, lettered, strict=True)]
                scores += [float(p) if ok else 0.0 for p, ok in zip(chance, lettered, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    return kept.mapInArrow(run, schema)
