"""Occurrences of terms in slices of text, counted by sorting packed words.

A term is a run of letters A-Z (lowered) and bytes above 127.  Terms are dealt
by length: up to 16 bytes they become one or two 64-bit words, which are sorted
by radix, two bytes a pass, in as many passes as the bucket's length needs;
longer ones lie in buckets of doubling width and are sorted as bytes.  Equal
terms are then runs, and runs are counted without a loop over terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from srcweave.llm.common import raw_bytes, text_slices

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
# Text counted at once.
SLICE_BYTES = 4 << 20
# Bytes of the longest term that is packed.
_PACKED = 16

Counts = tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]  # term, group, occurrences, documents


def radix_order(words: list[np.ndarray], digits: int) -> np.ndarray:
    """Stable order of rows of 64-bit words, most significant first, by their leading 16-bit digits."""
    order = None
    for d in reversed(range(digits)):
        digit = (words[d // 4] >> np.uint64(48 - 16 * (d % 4))).astype(np.uint16)
        if order is None:
            order = np.argsort(digit, kind="stable")
        else:
            order = order[np.argsort(digit[order], kind="stable")]
    return order


def _packed(pairs: np.ndarray, starts: np.ndarray, digits: int) -> list[np.ndarray]:
    """Terms as one or two words; an odd length ends in the blank after the term, which no term holds."""
    words = [np.zeros(len(starts), np.uint64) for _ in range((digits + 3) // 4)]
    for d in range(digits):
        words[d // 4] |= pairs[starts + 2 * d].astype(np.uint64) << np.uint64(48 - 16 * (d % 4))
    return words


def _padded(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """Terms as fixed-width byte strings, filled up with zeros."""
    rows = np.zeros((len(starts), width), np.uint8)
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    rows[np.repeat(np.arange(len(starts)), sizes), at] = flat[np.repeat(starts, sizes) + at]
    return rows.reshape(-1).view(f"S{width}")


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before in any column; the first row does."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _cut_out(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The terms at these places as an Arrow string column."""
    ends = np.cumsum(sizes)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
    offsets = np.zeros(len(sizes) + 1, np.int32)
    offsets[1:] = ends
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(flat[at]))


def count_slice(texts: list[bytes], groups: np.ndarray) -> Iterator[Counts]:
    """Terms of each group's texts with their occurrences and documents; texts of a group lie together."""
    flat = np.frombuffer(b" ".join(texts).translate(_FOLD) + b"  ", np.uint8)
    pairs = (flat[:-1].astype(np.uint16) << np.uint16(8)) | flat[1:]
    turns = np.flatnonzero(np.diff(np.concatenate(([False], flat != 32))))
    starts, ends = turns[::2], turns[1::2]
    sizes = ends - starts
    borders = np.cumsum([0] + [len(t) + 1 for t in texts])
    doc = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, borders)))
    digits = np.minimum((sizes + 1) // 2, _PACKED // 2 + 1).astype(np.uint8)

    def runs(at: np.ndarray, order: np.ndarray, keys: list[np.ndarray]) -> Counts:
        at, keys = at[order], [k[order] for k in keys]
        document = doc[at]
        new_term = _changes(*keys)
        group = groups[document]
        first = np.flatnonzero(new_term | _changes(group))
        documents = np.add.reduceat((new_term | _changes(document)).astype(np.int64), first)
        sample = at[first]
        return _cut_out(flat, starts[sample], sizes[sample]), group[first], np.diff(np.append(first, len(at))), documents

    for d in range(1, _PACKED // 2 + 1):
        at = np.flatnonzero(digits == d)
        if len(at):
            words = _packed(pairs, starts[at], d)
            yield runs(at, radix_order(words, d), words)
    long = np.flatnonzero(sizes > _PACKED)
    width = 2 * _PACKED
    while len(long):
        inside = sizes[long] <= width
        at, long = long[inside], long[~inside]
        if len(at):
            keys = _padded(flat, starts[at], sizes[at], width)
            yield runs(at, np.argsort(keys, kind="stable"), [keys])
        width *= 2


def _pieces(text: bytes, limit: int) -> Iterator[bytes]:
    """A long text in pieces of about `limit` bytes, cut between terms."""
    text, at = text.translate(_FOLD), 0
    while len(text) - at > limit:
        cut = text.find(b" ", at + limit)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def count_long(text: bytes, group: int, limit: int = SLICE_BYTES) -> Iterator[Counts]:
    """The same for one text of any length, piece by piece."""
    found = [c for piece in _pieces(text, limit) for c in count_slice([piece], np.array([group]))]
    if found:
        table = pa.table({"term": pa.chunked_array([c[0] for c in found]), "n": pa.chunked_array([pa.array(c[2]) for c in found])})
        table = table.group_by("term").aggregate([("n", "sum")]).combine_chunks()
        ones = np.ones(len(table), np.int64)
        yield table["term"].combine_chunks(), ones * group, table["n_sum"].to_numpy(), ones


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to (lang, source, term, n, docs), for each slice of text by itself."""
    for batch in batches:
        keys = pa.StructArray.from_arrays([batch["lang"], batch["source"]], ["lang", "source"])
        numbers: dict = {}
        row_group = np.array([numbers.setdefault(tuple(k.values()), len(numbers)) for k in keys.to_pylist()], np.int64)
        names = [pa.array([k[i] for k in numbers], pa.string()) for i in (0, 1)]
        for first, piece in text_slices(batch["text"], SLICE_BYTES):
            texts, group = raw_bytes(piece), row_group[first : first + len(piece)]
            if len(texts) == 1 and len(texts[0]) > 2 * SLICE_BYTES:
                found = count_long(texts[0], int(group[0]))
            else:
                order = np.argsort(group, kind="stable")
                found = count_slice([texts[i] for i in order.tolist()], group[order])
            for term, of, n, docs in found:
                columns = [pc.take(name, pa.array(of)) for name in names]
                yield pa.RecordBatch.from_arrays(
                    [*columns, term, pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
                    names=["lang", "source", "term", "n", "docs"],
                )
