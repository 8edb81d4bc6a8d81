"""Longest-common-subsequence ratio of two strings, as an Arrow function."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T


def places_of(a: str) -> dict[str, int]:
    """The positions of each character, as bits."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    return where


def lcs_length_of(where: dict[str, int], n: int, b: str) -> int:
    """Length of the longest common subsequence of ``b`` and the string of ``n`` characters at these places."""
    full = (1 << n) - 1
    v = full
    for c in b:
        u = v & where.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over the first string's positions."""
    return lcs_length_of(places_of(a), len(a), b)


def lcs_ratio_of(a: str | None, b: str | None) -> float:
    """2 * common / (len + len); 1 for equal strings, 0 where one is empty."""
    a, b = a or "", b or ""
    if a == b:
        return 1.0
    return 2 * lcs_length(a, b) / (len(a) + len(b)) if a and b else 0.0


#: Bits of a word of positions; the rest holds carries.
LIMB = 62
_CODE = np.full(256, 38, np.uint8)
_CODE[[ord(c) for c in " abcdefghijklmnopqrstuvwxyz0123456789"]] = np.arange(37)


def coded(titles: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of titles of a-z, 0-9 and spaces as numbers, filled up with 37, and lengths; 38 is any other character."""
    size = np.array([len(t) for t in titles], np.int64)
    out = np.full((len(titles), int(size.max(initial=0))), 37, np.uint8)
    for k, t in enumerate(titles):
        out[k, : len(t)] = _CODE[np.frombuffer(t.encode("latin-1", "replace"), np.uint8)]
    return out, size


def lcs_lengths(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], i: np.ndarray, j: np.ndarray, span: int = 50_000) -> np.ndarray:
    """Lengths of the longest common subsequences of titles i of ``a`` and j of ``b``, both coded; many pairs at once."""
    (ca, na), (cb, nb) = a, b
    out = np.zeros(len(i), np.int64)
    if not len(i) or not ca.shape[1]:
        return out
    limbs = -(-ca.shape[1] // LIMB)
    places = np.zeros((limbs, len(na) * 39), np.uint64)
    row = np.arange(len(na)) * 39
    for k in range(ca.shape[1]):
        places[k // LIMB, row + ca[:, k]] |= np.uint64(1 << (k % LIMB))
    places[:, row + 37] = 0
    whole = np.uint64((1 << LIMB) - 1)
    order = np.argsort(-nb[j], kind="stable")
    for lo in range(0, len(order), span):
        at = order[lo : lo + span]
        x, y, size = row[i[at]], j[at], nb[j[at]]
        n = na[i[at]]
        v = [np.where(n >= (w + 1) * LIMB, whole, (np.uint64(1) << np.clip(n - w * LIMB, 0, LIMB).astype(np.uint64)) - np.uint64(1)) for w in range(limbs)]
        full = [z.copy() for z in v]
        for k in range(int(size[0])):
            m = int(np.searchsorted(-size, -k, side="left"))  # titles longer than k
            slot = x[:m] + cb[y[:m], k]
            carry = np.uint64(0)
            for w in range(limbs):
                head = v[w][:m]
                u = head & places[w][slot]
                total = head + u + carry
                carry = total >> np.uint64(LIMB)
                v[w][:m] = (total & whole) | (head ^ u)
        out[at] = n - sum(np.bitwise_count(z & f).astype(np.int64) for z, f in zip(v, full))
    return out


@F.pandas_udf(T.DoubleType())
def lcs_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """The ratio, row by row of an Arrow batch."""
    return pd.Series([lcs_ratio_of(x, y) for x, y in zip(a, b)], dtype="float64")
