"""The greedy pass over articles in order of time, block by block and against seeds only.

What an article is depends on the seeds before it and on nothing else: pairs of which the earlier article is a member are never
needed. Blocks follow each other in order. The seeds of earlier blocks within the hours apart meet a block in parallel tasks, each of
which gives every article's best seed; one task then goes through the block itself. No pair leaves its task, so what is kept on disk is
the articles, the seeds and one row for each article.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lontar.config import Clustering
from lontar.functions.lcs import coded
from lontar.operators.pairblocks import ROWS_OUT, joint, meet, packed, placed_rows
from lontar.session import cut, shared_dir

#: Articles of a block: a share of all of them within these limits; and those that one task goes through at a time.
SHARE, LEAST, MOST = 24, 2_000, 8_000
PASS = 500

#: By place of a later article: (-score, first_pos, ms, sid, id) of its best seed so far.
Best = dict[int, tuple]


def taken(block: dict, at: np.ndarray) -> dict:
    """The articles at these places of a packed block, as one."""
    at = np.asarray(at, np.int64)
    size = np.diff(block["start"])[at]
    ends = np.cumsum(size)
    e = np.repeat(block["start"][at] - ends + size, size) + np.arange(size.sum())
    words, word = np.unique(block["word"][e], return_inverse=True)
    return {k: block[k][at] for k in ("id", "ms", "total")} | {k: [block[k][i] for i in at.tolist()] for k in ("sid", "title")} | {k: block[k][words] for k in ("words", "weight", "anchor")} | {"word": word.astype(np.int32), "pos": block["pos"][e], "start": np.concatenate([[0], ends]).astype(np.int64)}


def _accepted(later: dict, earlier: dict, c: Clustering) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(places that share an anchor, by later article; x, y, first_pos, score of accepted pairs), some pairs at a time, in order of x."""
    titles = coded(later["title"]), coded(earlier["title"])

    def judged(rows: list[tuple]) -> tuple:
        x, y, a, _, first, wj, lcs = joint(rows, titles, c, True)
        score = np.minimum(1.0, 0.55 * wj + 0.25 * lcs + 0.20 * np.minimum(a, 5) / 5)
        return [r[7] for r in rows], x, y, first, np.floor(score * 1e10 + 0.5) / 1e10

    held, rows = 0, []
    for r in meet(later, earlier, c, True):
        rows.append(r)
        held += len(r[1])
        if held > ROWS_OUT:
            yield judged(rows)
            held, rows = 0, []
    if rows:
        yield judged(rows)


def _enter(best: Best, seeds: dict, x: np.ndarray, y: np.ndarray, first: np.ndarray, score: np.ndarray) -> None:
    order = np.lexsort((y, first, -score, x))
    head = order[np.flatnonzero(np.diff(x[order], prepend=-1))]
    for i, j, f, s in zip(x[head].tolist(), y[head].tolist(), first[head].tolist(), score[head].tolist()):
        it = (-s, f, int(seeds["ms"][j]), seeds["sid"][j], seeds["id"][j])
        if i not in best or it[:4] < best[i][:4]:
            best[i] = it


def against(later: dict, seeds: dict, c: Clustering, best: Best) -> int:
    """Enter each later article's best of these seeds; the number of candidate pairs."""
    n = 0
    for shared, x, y, first, score in _accepted(later, seeds, c):
        n += sum(len(s) for s in shared)
        _enter(best, seeds, x, y, first, score)
    return n


def settled(block: dict, best: Best, c: Clustering) -> tuple[list[int], int]:
    """The places of a block's seeds, given each article's best earlier seed, and the number of candidate pairs with them; the members'
    best seeds are entered."""
    seeds: list[int] = []
    n = 0
    for lo in range(0, len(block["id"]), PASS):
        at = np.arange(lo, min(len(block["id"]), lo + PASS))
        part = taken(block, at)
        mine = {x: best[k] for x, k in enumerate(at.tolist()) if k in best}
        if seeds:
            n += against(part, taken(block, seeds), c, mine)
        free = [x for x in range(len(at)) if x not in mine]
        if free:
            own, new = taken(part, free), np.zeros(len(free), bool)
            got = list(_accepted(part, own, c))
            if got:
                x, y, first, score = (np.concatenate([g[k] for g in got]) for k in range(1, 5))
                start = np.searchsorted(x, np.arange(len(at) + 1))
            for k, i in enumerate(free):
                new[k] = not (got and new[y[start[i] : start[i + 1]]].any())
            if got:
                keep = new[y]
                _enter(mine, own, x[keep], y[keep], first[keep], score[keep])
                n += sum(int(new[s].sum()) for g in got for s in g[0])
            seeds += [lo + i for k, i in enumerate(free) if new[k]]
        best.update({lo + x: b for x, b in mine.items()})
    return seeds, n


def seeded(docs: DataFrame, marks: DataFrame, c: Clustering) -> tuple[DataFrame, int]:
    """(id, seed, score): seeds with themselves at score 1, every other article with its best seed; and the number of candidate pairs of
    which the earlier article is a seed."""
    spark = docs.sparkSession
    kind = docs.schema["id"].dataType.simpleString()
    rows = cut(placed_rows(docs).orderBy("ms", "sid").withColumn("n", F.monotonically_increasing_id()))
    part = F.shiftright("n", 33).cast("int")
    before, offset = 0, {}
    for r in rows.groupBy(part.alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect():
        offset[r.p] = before
        before += r.n
    if not before:
        return spark.createDataFrame([], f"id {kind}, seed {kind}, score double"), 0
    size = min(MOST, max(LEAST, before // SHARE))
    starts = F.create_map(*[F.lit(x).cast("long" if k % 2 else "int") for k, x in enumerate(x for pair in offset.items() for x in pair)])
    placed = rows.withColumn("block", F.floor((starts[part] + F.col("n").bitwiseAND((1 << 33) - 1)) / size).cast("int")).drop("n")
    spans = [(r.lo, r.hi) for r in placed.groupBy("block").agg(F.min("ms").alias("lo"), F.max("ms").alias("hi")).orderBy("block").collect()]

    folder = f"{shared_dir(spark)}/seeds-{uuid.uuid4().hex}"
    packed(docs, marks, placed).write.partitionBy("block").parquet(f"{folder}/blocks")
    shape = f"id {kind}, seed {kind}, score double, candidates long, seeds binary"

    def parallel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: Best = {}
        n, later = 0, None
        for batch in batches:
            for seeds, blob in zip(batch["seeds"], batch["blob"]):
                later = later or pickle.loads(blob)
                n += against(later, pickle.loads(seeds), c, best)
        if later:
            yield pd.DataFrame({"best": [pickle.dumps((best, n))], "blob": [None]})

    def resolve(g: pd.DataFrame) -> pd.DataFrame:
        block = pickle.loads(g["blob"].dropna().iloc[0])
        best: Best = {}
        n = 0
        for got, m in map(pickle.loads, g["best"].dropna()):
            n += m
            for x, b in got.items():
                if x not in best or b[:4] < best[x][:4]:
                    best[x] = b
        seeds, m = settled(block, best, c)
        ids = block["id"].tolist()
        out = [(ids[x], ids[x], 1.0, 0, None) for x in seeds] + [(ids[x], b[4], -b[0], 0, None) for x, b in best.items()]
        return pd.DataFrame([*out, (None, None, None, n + m, pickle.dumps(taken(block, seeds)) if seeds else None)], columns=["id", "seed", "score", "candidates", "seeds"], dtype=object)

    done = [f"{folder}/done={k}" for k in range(len(spans))]
    for k, (lo, _) in enumerate(spans):
        block = spark.read.schema("blob binary").parquet(f"{folder}/blocks/block={k}")
        every = block.select(F.lit(None).cast("binary").alias("best"), "blob")
        near = [done[j] for j in range(k) if spans[j][1] >= lo - c.hours_apart * 3_600_000]
        if near:
            seeds = spark.read.schema(shape).parquet(*near).where("seeds is not null").select("seeds")
            every = every.unionByName(seeds.crossJoin(F.broadcast(block)).mapInPandas(parallel, "best binary, blob binary"))
        every.groupBy().applyInPandas(resolve, shape).write.parquet(done[k])

    every = spark.read.schema(shape).parquet(*done)
    assigned = cut(every.where("id is not null").select("id", "seed", "score"))
    candidates = every.agg(F.sum("candidates")).first()[0]
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return assigned, candidates
