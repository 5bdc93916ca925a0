"""Normalised Indel similarity of strings: twice the longest common subsequence by the sum of lengths."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def common_subsequence(a: str, b: str) -> int:
    """The length of the longest common subsequence, all cells of a row at once in one long integer."""
    if not a or not b:
        return 0
    seen: dict[str, int] = {}
    for i, c in enumerate(a):
        seen[c] = seen.get(c, 0) | 1 << i
    mask = (1 << len(a)) - 1
    row = mask
    for c in b:
        hit = row & seen.get(c, 0)
        row = ((row + hit) | (row - hit)) & mask
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """Similarity from 0 to 1; two empty strings are equal."""
    n = len(a) + len(b)
    return 1.0 if n == 0 else 2.0 * common_subsequence(a, b) / n


@F.pandas_udf(T.DoubleType())
def indel_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """`indel_ratio` of two columns; null where either is null."""
    return pd.Series([None if not isinstance(x, str) or not isinstance(y, str) else indel_ratio(x, y) for x, y in zip(a, b)], index=a.index, dtype="float64")


#: Code points up to which many pairs are compared at once.
LONGEST = 512


def common_subsequences(left: list[str], right: list[str], i: np.ndarray, j: np.ndarray, step: int = 20_000) -> np.ndarray:
    """The lengths of the longest common subsequences of left[i] and right[j], many pairs at once.

    Each left text is a row of bits by character, held in as many 64-bit words as it needs; all pairs of a step go
    through the characters of their right texts together.  Long texts are compared one by one.
    """
    out = np.zeros(len(i), np.int64)
    la, lb = np.array([len(x) for x in left], np.int64), np.array([len(x) for x in right], np.int64)
    if not len(i):
        return out
    long = (la[i] > LONGEST) | (lb[j] > LONGEST)
    for k in np.flatnonzero(long):
        out[k] = common_subsequence(left[i[k]], right[j[k]])
    # right texts with few words of bits first, and of like length, so that a step ends early
    todo = np.flatnonzero(~long)
    todo = todo[np.lexsort((lb[j[todo]], (la[i[todo]] + 63) // 64))]
    alphabet: dict[str, int] = {}
    codes = np.zeros((len(right), int(lb[lb <= LONGEST].max(initial=0)) + 1), np.int32)
    for b, x in enumerate(right):
        if len(x) <= LONGEST:
            codes[b, : len(x)] = [alphabet.setdefault(c, len(alphabet) + 1) for c in x]
    for words in range(1, LONGEST // 64 + 1):
        own = todo[(la[i[todo]] + 63) // 64 == words]
        if not len(own):
            continue
        used, place = np.unique(i[own], return_inverse=True)
        bits = np.zeros((len(used), len(alphabet) + 1, words), np.uint64)
        for row, a in enumerate(used):
            for at, c in enumerate(left[a]):
                if k := alphabet.get(c):
                    bits[row, k, at >> 6] |= np.uint64(1 << (at & 63))
        for s in range(0, len(own), step):
            part, rows = own[s : s + step], place[s : s + step]
            texts, most = codes[j[part]], int(lb[j[part]].max())
            v = np.full((words, len(part)), ~np.uint64(0), np.uint64)
            for at in range(most):
                hit = bits[rows, texts[:, at]]
                carry = np.zeros(len(part), np.uint64)
                for w in range(words):
                    u = v[w] & hit[:, w]
                    total = v[w] + u
                    over = total < v[w]
                    total = total + carry
                    over |= total < carry
                    v[w] = total | (v[w] & ~u)
                    carry = over.astype(np.uint64)
            n = la[i[part]]
            zeros = np.zeros(len(part), np.int64)
            for w in range(words):
                inside = np.clip(n - 64 * w, 0, 64)
                mask = np.where(inside >= 64, ~np.uint64(0), (np.uint64(1) << np.minimum(inside, 63).astype(np.uint64)) - np.uint64(1))
                zeros += np.bitwise_count(~v[w] & mask)
            out[part] = zeros
    return out
