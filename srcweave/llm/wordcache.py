"""Token ids of texts, encoded once per distinct word.

Holds for tokenizers that never join characters across white space: their
normaliser and pre-tokenizer treat every white-space run as a boundary, so the
ids of a text are the ids of its white-space separated pieces, one after the
other.  Pieces are kept in a bounded table; `encode` gives the same ids as the
tokenizers library does for the whole text.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from srcweave.llm.common import raw_bytes, worker_memory

# Pieces a worker keeps in each of two generations; about 250 bytes each.
KEPT = 200_000
# Splits letters and single digits off everything else, so a piece ends wherever a mark follows a letter or digit.
_APART = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# 1 for ASCII letters and digits, 2 for ASCII marks
_KIND = np.array([1 if chr(b).isalnum() else 2 if 32 < b < 127 else 0 for b in range(128)] + [0] * 128, np.uint8)
# Letters that are their own composed form and whose lower case is one letter.
_LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")


def _byte_letters() -> dict[int, str]:
    """Byte-level pre-tokenizers write a byte as a printable character: itself, or the next one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(others)) for b in range(256)}


def _words_whole(tokenizer) -> bool:
    """Whether a run of letters is lowered, written as bytes, and handed to the model as one word."""
    parts = json.loads(tokenizer.to_str())
    normal = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
    steps = (parts["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (
        normal == ["NFC", "Replace", "Lowercase"]
        and [s["type"] for s in steps] == ["Split", "ByteLevel"]
        and "|[\\p{L}]+|" in steps[0]["pattern"].get("Regex", "")
        and steps[0]["invert"]
        and not steps[1]["add_prefix_space"]
        and not steps[1]["use_regex"]
    )


def _split_regex(tokenizer) -> str | None:
    """The pattern of a first pre-tokenizer that splits by one."""
    return json.loads(tokenizer.to_str())["pre_tokenizer"]["pretokenizers"][0]["pattern"].get("Regex")


class _Pieces(dict):
    """bytes of a piece -> its ids as unsigned 32-bit integers."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.model = tokenizer.model if _words_whole(tokenizer) else None
        self.parted = self.model is not None and _split_regex(tokenizer) == _APART
        self.letters = _byte_letters()
        self.older: dict[bytes, bytes] = {}
        added = tokenizer.get_added_tokens_decoder().values()
        self.added = [a.content.encode().lower() for a in added]

    def lowered(self, text: bytes) -> bytes:
        """The text with A-Z lowered if that leaves its ids as they are, else the text as given.

        The tokenizer lowers last.  Added tokens are matched before, so a text
        that holds one, in whatever case, stays; and letters are composed
        before.  All marks that compose with A-Z are in U+0300-U+037F (their
        first byte is CC or CD), so a text that holds one of these stays too.
        """
        low = text.lower()
        if low == text or self.model is None or b"\xcc" in text or b"\xcd" in text or any(a in low for a in self.added):
            return text
        return low

    def apart(self, texts: list[bytes]) -> pa.Array:
        """The texts, with a blank put between an ASCII letter or digit and an ASCII mark, if that leaves their ids as they are.

        So a word is looked up once, whatever marks follow it.  The
        pre-tokenizer ends a piece at these places, and no ASCII mark composes
        with what stands before it.  Added tokens are matched before, so a text
        that holds one stays as it is.
        """
        flat = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        if self.parted:
            kind = _KIND[flat]
            cut = np.flatnonzero((kind[:-1] == 1) & (kind[1:] == 2)) + 1
            holds = np.array([any(a in low for a in self.added) for low in map(bytes.lower, texts)], bool)
            if holds.any():
                cut = cut[~holds[np.searchsorted(ends, cut, "right")]]
            flat = np.insert(flat, cut, 32)
            ends = ends + np.searchsorted(cut, ends)
        offsets = pa.py_buffer(np.concatenate(([0], ends)))
        return pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, pa.py_buffer(flat)])

    def _ids(self, piece: str) -> bytes:
        if self.model is not None and _LATIN.fullmatch(piece):
            word = piece.lower().encode().decode("latin-1").translate(self.letters)
            ids = [token.id for token in self.model.tokenize(word)]
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.older.get(piece)
        if ids is None and self.model is not None and piece.isalpha() and piece.islower():
            ids = array("I", [token.id for token in self.model.tokenize(piece.decode())]).tobytes()
        elif ids is None:
            low, stem, tail = self.lowered(piece), piece, b""
            if low is piece and self.model is not None and len(piece) > 1 and piece[-1] in b".,":
                if _LATIN.fullmatch(piece[:-1].decode()):  # the mark behind a word is a piece of its own
                    stem, tail = piece[:-1], self[piece[-1:]]
            if low is not piece:
                ids = self[low]
            elif stem is piece:
                ids = self._ids(piece.decode())
            else:
                ids = self[stem] + tail
        if len(self) >= KEPT:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids


def pieces(path: str, ordinary: bool = False) -> _Pieces:
    """The table of a tokenizer file in this worker process.

    `ordinary` treats the strings of special tokens in a text as text.
    """
    memory, name = worker_memory("words"), f"pieces {ordinary} {path}"
    if name not in memory:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = ordinary
        memory[name] = _Pieces(tokenizer)
    return memory[name]


def encode(texts: pa.Array, table: _Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of whole texts one after the other, and the number of ids of each; a null is an empty text.

    Words are told apart by Arrow, so that only the distinct ones of these
    texts are looked up.
    """
    # lowered and parted there are fewer distinct words
    words = pc.ascii_split_whitespace(table.apart([table.lowered(t) for t in raw_bytes(texts)]))
    named = words.flatten().dictionary_encode()
    distinct = named.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
    known = [table[w] for w in distinct.tolist()]
    flat = np.frombuffer(b"".join(known), np.uint32)
    sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
    codes = named.indices.to_numpy()
    each = sizes[codes]
    ends = np.cumsum(each)
    shift = (np.cumsum(sizes) - sizes)[codes] - (ends - each)
    ids = flat[np.repeat(shift, each) + np.arange(len(shift) and ends[-1])]
    upto = np.concatenate(([0], ends))[np.cumsum(words.value_lengths().to_numpy())]
    return ids, np.diff(upto, prepend=0)
