"""Suffix ranks by prefix tripling, to a given depth."""

from __future__ import annotations

import numpy as np

# Bits of a symbol or rank; three fill a sort key.
_BITS = 21


def suffix_ranks(s: np.ndarray, depth: int) -> np.ndarray:
    """Rank of every suffix of `s` by its first `depth` symbols; suffixes equal that far share a rank.

    Symbols are from 1 to 2^21 - 1, as is the length; behind the end stand
    zeros.  As many symbols as a 63-bit key holds are sorted first.  Ranks by d
    symbols then give ranks by up to 3 d: three of them, of which the last two
    may overlap, make the next key.  Bytes take three sorts to a depth of 50.
    """
    n = len(s)
    bits = max(1, int(s.max()).bit_length()) if n else 1
    have = max(1, min(depth, 63 // bits))
    key = np.zeros(n, np.int64)
    for i in range(have):
        key <<= bits
        key[: max(n - i, 0)] |= s[i:]
    ranks = _ranked(key)
    while have < depth:
        following = min(depth, 3 * have)
        # 0 is behind the end
        one = ranks + 1
        key = one << (2 * _BITS)
        for place, at in ((1, min(have, following - have)), (0, following - have)):
            key[: max(n - at, 0)] |= one[at:] << (place * _BITS)
        ranks, have = _ranked(key), following
    return ranks


def _ranked(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    held = keys[order]
    new = np.zeros(len(keys), np.int64)
    new[1:] = held[1:] != held[:-1]
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks
