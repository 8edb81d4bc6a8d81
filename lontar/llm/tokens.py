"""Problem 7: encoding of the whole corpus with a public byte-level BPE vocabulary.

Two tiers. Whole pre-tokens that are in the vocabulary are resolved by a minimal perfect hash over the vocabulary's byte strings
(one displacement per bucket, one slot per entry, one byte comparison to reject strangers). The rest are merged by rank with a heap
over a linked list of byte pieces, O(n log n) in the length of the pre-token, whatever that length is.

A pre-token that is itself in the vocabulary need not be what merging gives; such entries are found once, when the vocabulary is
loaded, and left out of the first tier, so both tiers agree with merging.

The vocabulary is read from a file of ranks whose path is a parameter, by the driver alone: what is made of it, a few megabytes
whatever the corpus, is broadcast, so executors need neither the file nor the time to build the hash.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Where the vocabulary files are; LONTAR_TOKENIZERS names another folder.
FOLDER = os.environ.get("LONTAR_TOKENIZERS", "/opt/tokenizers")
#: Fixed value: how this vocabulary's texts are split before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _hash(data: bytes, seed: int) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(data, seed)


class PerfectHash:
    """A minimal perfect hash from distinct byte strings to values: as many slots as entries, none empty."""

    def __init__(self, entries: dict[bytes, int], per_bucket: int = 4) -> None:
        self.size = len(entries)
        self.buckets = max(1, self.size // per_bucket)
        groups: dict[int, list[bytes]] = {}
        for k in entries:
            groups.setdefault(_hash(k, 0) % self.buckets, []).append(k)
        self.displace = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * self.size
        self.values = [0] * self.size
        free = None
        for b, members in sorted(groups.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(members) == 1:  # singles take what is left, by its number
                free = free or [i for i in range(self.size) if self.keys[i] is None]
                at = free.pop()
                self.displace[b] = -at - 1
                slots = [at]
            else:
                seed = 1
                while True:
                    slots = [_hash(k, seed) % self.size for k in members]
                    if len(set(slots)) == len(slots) and all(self.keys[s] is None for s in slots):
                        break
                    seed += 1
                self.displace[b] = seed
            for k, s in zip(members, slots):
                self.keys[s], self.values[s] = k, entries[k]

    def get(self, key: bytes) -> int:
        """The value of ``key``, or -1 for a stranger."""
        if not self.size:
            return -1
        d = self.displace[_hash(key, 0) % self.buckets]
        at = -d - 1 if d < 0 else _hash(key, d) % self.size
        return self.values[at] if self.keys[at] == key else -1


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte-pair encoding of one pre-token: a heap of mergeable neighbours over a doubly linked list of pieces.

    The lowest rank is merged first, the leftmost of equal ranks first. Heap entries of pieces that have changed since are skipped.
    """
    n = len(piece)
    if n == 1:
        return [ranks[piece]]
    parts: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, int]] = []
    for i in range(n - 1):
        if (r := ranks.get(piece[i : i + 2])) is not None:
            heap.append((r, i, 2))
    heapq.heapify(heap)
    while heap:
        r, i, size = heapq.heappop(heap)
        left = parts[i]
        if left is None or (j := after[i]) >= n or len(left) + len(parts[j]) != size or ranks.get(left + parts[j]) != r:
            continue
        joined = left + parts[j]
        parts[i], parts[j] = joined, None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get(joined + parts[k])) is not None:
                heapq.heappush(heap, (r, i, len(joined) + len(parts[k])))
        if (h := before[i]) >= 0 and (r := ranks.get(parts[h] + joined)) is not None:
            heapq.heappush(heap, (r, h, len(parts[h]) + len(joined)))
    return [ranks[p] for p in parts if p is not None]


class Encoder:
    """Encodes texts with one vocabulary. Pre-tokens met before are remembered, up to ``remember`` of them."""

    def __init__(self, path: str, remember: int = 200_000) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.whole = PerfectHash({k: r for k, r in self.ranks.items() if merge(k, self.ranks) == [r]})
        self.split = regex.compile(PATTERN).findall
        self.remember, self.known = remember, {}

    def __getstate__(self) -> tuple:
        return self.ranks, self.whole, self.remember

    def __setstate__(self, state: tuple) -> None:
        self.ranks, self.whole, self.remember = state
        self.split, self.known = regex.compile(PATTERN).findall, {}

    def piece(self, pre_token: str) -> list[int]:
        """The ids of one pre-token."""
        data = pre_token.encode("utf-8", "replace")
        at = self.whole.get(data)
        return [at] if at >= 0 else merge(data, self.ranks)

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text; none for empty and for null text. Strings that look like special tokens are ordinary text."""
        out: list[int] = []
        known = self.known
        for p in self.split(text or ""):
            ids = known.get(p)
            if ids is None:
                ids = self.piece(p)
                if len(known) < self.remember and len(p) < 64:
                    known[p] = ids
            out += ids
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, made once in each process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def shared_encoder(spark: SparkSession, path: str) -> Broadcast:
    """The encoder of a vocabulary file, for executors."""
    return spark.sparkContext.broadcast(encoder(path))


def vocabulary(name: str = "byte_bpe_50k", folder: str | None = None) -> str:
    """The path of a vocabulary's file of ranks."""
    return os.path.join(folder or FOLDER, f"{name}.tiktoken")


def encode_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, ids) of every row, in one pass without a shuffle; ``keep`` names columns to carry along.

    Null and empty texts get an empty list; a repeated row is encoded as often as it occurs; a null id stays null. Texts of any
    length are encoded whole. Columns not named are ignored, whatever their names.
    """
    shared = shared_encoder(docs.sparkSession, path or vocabulary())
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), *[F.col(c) for c in keep])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = shared.value
        for b in batches:
            b["ids"] = [np.array(enc.encode(t if isinstance(t, str) else None), np.int32) for t in b["text"]]
            yield b[["id", "ids", *keep]]

    kinds = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInPandas(run, f"id string, ids array<int>{kinds}").withColumn("id", F.col("id").cast(docs.schema[id_col].dataType))


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, tokens) of every row; as ``encode_column``, but only the number of ids leaves Python."""
    shared = shared_encoder(docs.sparkSession, path or vocabulary())
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), *[F.col(c) for c in keep])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = shared.value
        for b in batches:
            b["tokens"] = [len(enc.encode(t if isinstance(t, str) else None)) for t in b["text"]]
            yield b[["id", "tokens", *keep]]

    kinds = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInPandas(run, f"id string, tokens long{kinds}").withColumn("id", F.col("id").cast(docs.schema[id_col].dataType))
