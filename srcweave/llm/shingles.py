"""Sets of word shingles as sorted 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

import numpy as np

from srcweave.llm.common import slices, worker_memory

# A-Z to a-z; the six ASCII white-space bytes to a blank; every other byte is part of a word.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if b in (9, 10, 11, 12, 13) else b for b in range(256))
_STEP = 0x9E3779B97F4A7C15 | 1
# Text hashed at a time; some 50 bytes of numbers stand for each of its bytes.
SLICE = 256 << 10


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit numbers; different salts give unrelated orders."""
    x = x ^ np.uint64(salt * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_STEP to the powers 0 to n - 1 and to their negatives, modulo 2^64."""
    memory = worker_memory("hashes")
    held = memory.get("powers")
    if held is None or len(held[0]) < n:
        size = max(n, 2 * SLICE)
        up, down = np.full(size, _STEP, np.uint64), np.full(size, pow(_STEP, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        memory["powers"] = held = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
    return held


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts in order, and the number of words of each text."""
    flat = np.frombuffer(b" ".join(texts).translate(_FOLD) + b" ", np.uint8)
    up, down = _powers(len(flat))
    letters = mixed(np.arange(256, dtype=np.uint64), 1)
    totals = np.empty(len(flat) + 1, np.uint64)
    totals[0] = 0
    np.cumsum(letters[flat] * up[: len(flat)], out=totals[1:])
    inside = flat != 32
    turns = np.flatnonzero(np.diff(np.concatenate(([False], inside)))) if len(flat) else np.zeros(0, np.int64)
    starts, ends = turns[::2], turns[1::2]
    hashes = mixed((totals[ends] - totals[starts]) * down[starts], 2)
    borders = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(starts, np.concatenate(([0], borders))))


def shingle_sets(
    texts: list[bytes], width: int, counts: np.ndarray | None = None, tally: np.ndarray | None = None
) -> list[tuple[np.ndarray, np.ndarray | None]]:
    """Of each text: sorted distinct shingles of `width` words, and how common each one's rarest word is.

    All words of a shorter text are one shingle; a text without words has none.
    `counts` are word counts by the low bits of the word's hash; without them
    the second part is None.  `tally` is such an array to add these texts to.
    """
    out: list[tuple[np.ndarray, np.ndarray | None]] = []
    turn = [np.uint64((2 * i + 1) * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF) for i in range(width)]
    for a, b in slices(texts, SLICE):
        words, sizes = _word_hashes(texts[a:b])
        if tally is not None:
            np.add.at(tally, (words & np.uint64(len(tally) - 1)).astype(np.int64), 1)
        common = None if counts is None else counts[(words & np.uint64(len(counts) - 1)).astype(np.int64)]
        joint = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for i in range(width):
            joint += mixed(words[i : i + len(joint)] * turn[i])
        joint = mixed(joint, 3)
        rarest = common
        if common is not None and len(joint):
            rarest = np.min([common[i : i + len(joint)] for i in range(width)], axis=0)
        at = 0
        for n in sizes.tolist():
            if n >= width:
                found, place = np.unique(joint[at : at + n - width + 1], return_index=True)
                out.append((found, None if rarest is None else rarest[at + place]))
            elif n:
                short = sum((mixed(w[None] * t) for w, t in zip(words[at : at + n], turn, strict=False)), np.array([n], np.uint64))
                out.append((mixed(short, 4), None if common is None else common[at : at + n].min()[None]))
            else:
                out.append((np.zeros(0, np.uint64), None if common is None else np.zeros(0, np.int64)))
            at += n
    return out
