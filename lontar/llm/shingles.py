"""Vectorised word-n-gram fingerprints of texts, shared by the similarity operators.

Words are runs of letters, digits or underscores in the lower-cased text. Every n-gram is a 64-bit value that depends only on its
words, so fingerprints made on different executors can be compared. No per-word Python work: a whole Arrow batch is one code-point
array, and word hashes come from prefix sums of a polynomial modulo 2**64.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_TABLES: dict[str, np.ndarray] = {}
#: Code points handled at once; bounds the working memory of a worker whatever the batch holds.
BLOCK = 500_000


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def _word_table() -> np.ndarray:
    if "word" not in _TABLES:
        t = np.zeros(0x110000, dtype=bool)
        t[[i for i in range(0x110000) if chr(i).isalnum()]] = True
        t[ord("_")] = True
        _TABLES["word"] = t
    return _TABLES["word"]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if "pow" not in _TABLES or len(_TABLES["pow"]) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            base = np.full(size, _BASE, dtype=U64)
            base[0] = 1
            inverse = np.full(size, pow(_BASE, -1, 1 << 64), dtype=U64)
            inverse[0] = 1
            _TABLES["pow"], _TABLES["inv"] = np.cumprod(base), np.cumprod(inverse)
    return _TABLES["pow"], _TABLES["inv"]


def _spans(s: str) -> list[tuple[int, int]]:
    """Spans of at most ``BLOCK`` characters that together are the string and split no word; a longer word makes a longer span."""
    out, at = [], 0
    while len(s) - at > BLOCK:
        stop = max(s.rfind(" ", at, at + BLOCK), s.rfind("\n", at, at + BLOCK))
        if stop <= at:
            ahead = [x for x in (s.find(" ", at + BLOCK), s.find("\n", at + BLOCK)) if x >= 0]
            stop = min(ahead) if ahead else len(s)
        out.append((at, stop))
        at = stop
    return out + [(at, len(s))]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the (already lower-cased) texts in order, and the text number of each word."""
    joined = "\n".join(texts)
    if not joined:
        return np.empty(0, U64), np.empty(0, np.int64)
    hashes, starts = [], []
    for lo, hi in _spans(joined):
        cp = np.frombuffer(joined[lo:hi].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        is_word = _word_table()[cp]
        edge = np.diff(is_word.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        pw, inv = _powers(len(cp))
        with np.errstate(over="ignore"):
            prefix = np.zeros(len(cp) + 1, dtype=U64)
            np.cumsum(mix(cp.astype(U64) + U64(0x51ED27)) * pw[: len(cp)], out=prefix[1:])
            hashes.append(mix((prefix[end] - prefix[start]) * inv[start] + (end - start).astype(U64)))
        starts.append(start + lo)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    doc = np.searchsorted(np.cumsum(lengths), np.concatenate(starts), side="right")
    return np.concatenate(hashes), doc


def ngrams(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word sequences that lie within one text, and their text numbers."""
    if len(h) < n:
        return np.empty(0, U64), np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        out = np.zeros(len(h) - n + 1, dtype=U64)
        for i in range(n):
            out = mix(out * U64(0x2545F4914F6CDD1D) + h[i : len(h) - n + 1 + i] + U64(i + 1))
    inside = doc[: len(h) - n + 1] == doc[n - 1 :]
    return out[inside], doc[: len(h) - n + 1][inside]


def sets(titles: list[str | None], bodies: list[str | None], n: int, min_words: int) -> list[np.ndarray | None]:
    """Of each text its sorted set of n-grams over title, line feed and body; None where the body has under ``min_words`` words.

    Null counts as empty. A text with fewer than n words has an empty set.
    """
    out: list[np.ndarray | None] = []
    at = 0
    while at < len(bodies):
        stop, size = at, 0
        while stop < len(bodies) and (stop == at or size < BLOCK):
            size += len(titles[stop] or "") + len(bodies[stop] or "")
            stop += 1
        parts = [s for t, b in zip(titles[at:stop], bodies[at:stop]) for s in ((t or "").lower(), (b or "").lower())]
        h, part = word_hashes(parts)
        words = np.bincount(part[part % 2 == 1] // 2, minlength=stop - at)
        g, doc = ngrams(h, part // 2, n)
        bounds = np.searchsorted(doc, np.arange(stop - at + 1))
        for i in range(stop - at):
            if words[i] < min_words:
                out.append(None)
            else:
                out.append(np.unique(g[bounds[i] : bounds[i + 1]]))
        at = stop
    return out


def set_key(s: np.ndarray) -> bytes:
    """A 128-bit key of a set; equal sets have equal keys."""
    with np.errstate(over="ignore"):
        a, b = mix(s + U64(0xA5A5)).sum(dtype=U64), mix(s ^ U64(0x5BD1E995C0FFEE)).sum(dtype=U64)
        return np.array([a + U64(len(s)), b], dtype=">u8").tobytes()


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets; 0 where both are empty."""
    if not len(a) and not len(b):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)
