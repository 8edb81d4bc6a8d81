"""Scoring of article pairs in pairs of blocks, so that no pair is shuffled before it is scored.

Articles are packed into blocks by time, each a few megabytes of arrays. A block of later articles meets every block of earlier ones
within the hours apart in one task: shared anchors, phrases and weights are counted there over the earlier block's inverted index,
and only what is asked for leaves the task. What is shuffled is each block, once for each block it meets.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lontar.config import Clustering
from lontar.functions.lcs import coded, lcs_lengths
from lontar.session import cut, small_side

#: Articles of a block: a share of all of them within these limits.
SHARE, LEAST, MOST = 24, 1_000, 50_000
ROWS_OUT = 200_000
#: Rows of ids that are broadcast at most, each with its block or seed.
MEMBERS = 500_000


def _spans(docs: DataFrame) -> list[tuple[int, int, int, int]]:
    """(first block, number of blocks, first hour, last hour) in order of time: hours are put together, or split by id, into blocks of about one size."""
    hours = [(int(r.h), r.n) for r in docs.groupBy(F.floor(F.unix_millis("at") / 3_600_000).alias("h")).agg(F.count("*").alias("n")).orderBy("h").collect()]
    size = min(MOST, max(LEAST, sum(n for _, n in hours) // SHARE))
    out: list[list[int]] = []
    held = size
    for h, n in hours:
        if held + n > size:
            out.append([sum(x[1] for x in out), -(-n // size), h, h])
            held = n
        else:
            out[-1][3] = h
            held += n
    return [tuple(x) for x in out]


def _entries(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """(id, word, pos, w, anchor): tokens that two documents and more have, with their weight 1 / log2(df + 1), and phrases without one.
    Words are numbered in the order of their tokens."""
    freq = docs.select(F.explode(F.array_distinct("all_tokens")).alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    anchor = marks.where("kind = 'a'").select("token").distinct().withColumn("anchor", F.lit(True))
    words = freq.where("df >= 2").join(anchor, "token", "left").select(F.lit("a").alias("kind"), "token", (F.lit(1.0) / F.log2(F.col("df") + 1.0)).alias("w"), F.coalesce("anchor", F.lit(False)).alias("anchor"))
    phrases = marks.where("kind = 'p' and df >= 2").select("kind", "token", F.lit(None).cast("double").alias("w"), F.lit(False).alias("anchor")).distinct()
    vocabulary = small_side(words.unionByName(phrases).orderBy("kind", "token").withColumn("word", F.monotonically_increasing_id()))
    single = docs.select("id", F.lit("a").alias("kind"), F.posexplode("all_tokens").alias("pos", "token"))
    double = marks.where("kind = 'p' and df >= 2").select("id", "kind", "pos", "token")
    return single.unionByName(double).join(vocabulary, ["kind", "token"]).select("id", "word", "pos", "w", "anchor")


def _pack(docs: pd.DataFrame, entries: pd.DataFrame) -> bytes:
    """A block: its articles in order and their entries by article and word."""
    docs = docs.sort_values(["ms", "sid"], kind="stable").reset_index(drop=True)
    at = pd.Index(docs["id"]).get_indexer(entries["owner"])
    e = entries.assign(doc=at).sort_values(["doc", "word"], kind="stable")
    words, word = np.unique(e["word"].to_numpy(np.int64), return_inverse=True)
    n = len(docs)
    w = e["w"].to_numpy(np.float64, na_value=np.nan)
    doc, single = e["doc"].to_numpy(np.int64), ~np.isnan(w)
    weight, anchor = np.full(len(words), np.nan), np.zeros(len(words), bool)
    weight[word], anchor[word] = w, e["anchor"].to_numpy(bool)
    # tokens of one document only have weight 1 and are in no pair
    total = np.bincount(doc[single], weights=w[single], minlength=n) + docs["tokens"].to_numpy(np.float64) - np.bincount(doc[single], minlength=n)
    return pickle.dumps({"id": docs["id"].to_numpy(), "sid": docs["sid"].tolist(), "ms": docs["ms"].to_numpy(np.int64), "title": docs["t"].tolist(), "total": total, "words": words, "weight": weight, "anchor": anchor, "word": word.astype(np.int32), "pos": e["pos"].to_numpy(np.int32), "start": np.searchsorted(doc, np.arange(n + 1))})


def meet(later: dict, earlier: dict, c: Clustering, accepted: bool) -> Iterator[tuple]:
    """For each later article (place, places of earlier ones, anchors, phrases, first_pos, wj, near, candidates): ``candidates`` are all
    places that share an anchor; the rest is of them or, if only the ``accepted`` are asked for, of pairs that may be accepted. ``near``:
    accepted by words or with three anchors."""
    n = len(earlier["id"])
    words, ia, ib = np.intersect1d(later["words"], earlier["words"], assume_unique=True, return_indices=True)
    here = np.full(len(later["words"]), -1, np.int64)
    here[ia] = ib
    by = np.argsort(earlier["word"], kind="stable")
    doc = np.repeat(np.arange(n), np.diff(earlier["start"]))[by]
    bound = np.searchsorted(earlier["word"][by], np.arange(len(earlier["words"]) + 1))
    weight, anchor = earlier["weight"], earlier["anchor"]
    phrase = np.isnan(weight)
    key = list(zip(earlier["ms"].tolist(), earlier["sid"]))
    apart = c.hours_apart * 3_600_000
    ms, total = earlier["ms"], earlier["total"]
    low = np.searchsorted(ms, later["ms"] - apart, side="left")
    none = np.empty(0, np.int64)

    for x in range(len(later["id"])):
        lo, hi = int(low[x]), bisect_left(key, (int(later["ms"][x]), later["sid"][x]))
        if lo >= hi:
            continue
        s, e = later["start"][x], later["start"][x + 1]
        word, pos = here[later["word"][s:e]], later["pos"][s:e]
        word, pos = word[word >= 0], pos[word >= 0]
        is_anchor = anchor[word]
        if not is_anchor.any():
            continue
        hits = [doc[bound[k] : bound[k + 1]] for k in word]
        mine = [h for h, k in zip(hits, is_anchor) if k]
        a = np.bincount(np.concatenate(mine), minlength=n)
        cand = np.flatnonzero(a[lo:hi]) + lo
        if not len(cand):
            continue
        is_phrase = phrase[word]
        p = np.bincount(np.concatenate([h for h, k in zip(hits, is_phrase) if k]), minlength=n) if is_phrase.any() else np.zeros(n, np.int64)
        y = cand[(a[cand] >= 2) | (p[cand] >= 1)] if accepted else cand
        if not len(y):
            yield x, none, none, none, none, none, none, cand
            continue
        tokens = [(h, weight[k]) for h, k, q in zip(hits, word, is_phrase) if not q]
        common = np.bincount(np.concatenate([h for h, _ in tokens]), weights=np.repeat([w for _, w in tokens], [len(h) for h, _ in tokens]), minlength=n)[y]
        union = later["total"][x] + total[y] - common
        wj = np.round(np.divide(common, union, out=np.zeros(len(y)), where=union > 0), 12)
        by_words = ((a[y] >= 2) & (wj >= c.jaccard)) | ((p[y] >= 1) & (wj >= c.phrase_jaccard))
        near = by_words | (a[y] >= 3)
        if accepted:
            y, wj, near = y[near], wj[near], near[near]
        down = sorted(((q, h) for q, h, k in zip(pos.tolist(), hits, is_anchor) if k), key=lambda z: -z[0])
        first = np.zeros(n, np.int64)
        first[np.concatenate([h for _, h in down])] = np.repeat([q for q, _ in down], [len(h) for _, h in down])  # the smallest is written last
        yield x, y, a[y], p[y], first[y], wj, near, cand


def placed_rows(docs: DataFrame) -> DataFrame:
    """(id, ms, sid, t, tokens): what a block holds of an article besides its entries."""
    return docs.select("id", F.unix_millis("at").alias("ms"), F.col("ord.id").alias("sid"), F.array_join("title_tokens", " ").alias("t"), F.size("all_tokens").alias("tokens"))


def _in_spans(docs: DataFrame, spans: list[tuple[int, int, int, int]]) -> DataFrame:
    """Rows of articles with their block of these spans."""
    edge = F.floor(F.col("ms") / 3_600_000)
    first = F.filter(F.array(*[F.struct(F.lit(lo).cast("long").alias("h"), F.lit(b).alias("b"), F.lit(m).alias("m")) for b, m, lo, _ in spans]), lambda s: s["h"] <= edge)
    return cut(placed_rows(docs).withColumn("_s", F.element_at(first, -1)).withColumn("block", (F.col("_s.b") + F.pmod(F.xxhash64("id"), F.col("_s.m"))).cast("int")).drop("_s"))


def packed(docs: DataFrame, marks: DataFrame, placed: DataFrame) -> DataFrame:
    """(block, blob): the packed blocks of articles in ``placed``, which has their rows and ``block``. Where the numbers of words and blocks
    fit a broadcast, entries are exchanged once, to their block."""
    entries = _entries(docs, marks).toDF("owner", "word", "pos", "w", "anchor").join(small_side(placed.select(F.col("id").alias("owner"), F.col("block").alias("part")), MEMBERS), "owner")

    def pack(k: tuple, d: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": [k[0]], "blob": [_pack(d, e)]}) if len(d) else pd.DataFrame({"block": [], "blob": []})

    return placed.groupBy("block").cogroup(entries.groupBy("part")).applyInPandas(pack, "block int, blob binary")


def block_pairs(docs: DataFrame, marks: DataFrame, c: Clustering, ratio: bool = True) -> DataFrame:
    """(later, earlier, shared_anchors, shared_phrases, first_pos, wj, lcs) of all candidate pairs; ``lcs`` is computed, with ``ratio``, of pairs by words
    or with three anchors."""
    spark = docs.sparkSession
    spans = _spans(docs)
    kind = docs.schema["id"].dataType.simpleString()
    out = f"later {kind}, earlier {kind}, shared_anchors long, shared_phrases long, first_pos int, wj double, lcs double"
    if not spans:
        return spark.createDataFrame([], out)
    blobs = packed(docs, marks, _in_spans(docs, spans))
    reach = c.hours_apart + 1
    meets = [(i, j) for b, m, lo, _ in spans for b2, m2, lo2, hi2 in spans if lo2 <= lo and hi2 >= lo - reach for i in range(b, b + m) for j in range(b2, b2 + m2)]
    ends = [(k, b, side) for k, (i, j) in enumerate(meets) for side, b in ((0, i), (1, j))]
    roles = F.broadcast(spark.createDataFrame(ends, "k int, block int, side int"))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wait: dict[int, dict[int, bytes]] = {}
        for batch in batches:
            for k, side, blob in zip(batch["k"], batch["side"], batch["blob"]):
                wait.setdefault(k, {})[side] = blob
                if len(wait[k]) == 2:
                    both = wait.pop(k)
                    yield from _scored(pickle.loads(both[0]), pickle.loads(both[1]), c, ratio)

    return blobs.join(roles, "block").select("k", "side", "blob").repartitionById(len(meets), F.col("k")).mapInPandas(score, out)


def joint(rows: list[tuple], titles: tuple | None, c: Clustering, accepted: bool) -> tuple[np.ndarray, ...]:
    """x, y, anchors, phrases, first_pos, wj, lcs of rows of ``meet``, of ``accepted`` pairs only if that is asked for; ``titles``: both
    blocks' coded titles, without which there is no lcs."""
    x = np.repeat([r[0] for r in rows], [len(r[1]) for r in rows])
    y, a, p, first, wj, near = (np.concatenate([r[k] for r in rows]) for k in range(1, 7))
    lcs = np.full(len(y), np.nan)
    if titles:
        at = np.flatnonzero(near)
        i, j = x[at], y[at]
        size = titles[0][1][i] + titles[1][1][j]
        lcs[at] = np.where(size > 0, 2 * lcs_lengths(*titles, i, j) / np.maximum(size, 1), 1.0)
    out = x, y, a, p, first, wj, lcs
    if accepted:
        keep = ((a >= 2) & (wj >= c.jaccard)) | ((p >= 1) & (wj >= c.phrase_jaccard)) | ((a >= 3) & (lcs >= c.sequence))
        out = tuple(z[keep] for z in out)
    return out


def _scored(later: dict, earlier: dict, c: Clustering, ratio: bool) -> Iterator[pd.DataFrame]:
    titles = (coded(later["title"]), coded(earlier["title"])) if ratio else None
    held, rows = 0, []

    def frame() -> pd.DataFrame:
        x, y, *rest = joint(rows, titles, c, False)
        return pd.DataFrame(dict(zip(["later", "earlier", "shared_anchors", "shared_phrases", "first_pos", "wj", "lcs"], [later["id"][x], earlier["id"][y], *rest])))

    for r in meet(later, earlier, c, False):
        rows.append(r)
        held += len(r[1])
        if held > ROWS_OUT:
            yield frame()
            held, rows = 0, []
    if rows:
        yield frame()
