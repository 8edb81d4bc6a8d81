"""Problem 4: lines repeated across one site's documents.

Three passes, none of which shuffles texts:

1. Every partition keeps, for each source, a heavy-hitter summary (Misra-Gries) of line hashes, counting a line once per document.
   Summaries are mergeable: counters of the same line are summed by a partially aggregated group-by, and the summed decrements of
   a source bound by how much any counter is too low. The capacity is ``2 / share`` times the mean number of lines of a document,
   so the error stays under half of the share. No line that reaches the threshold can be lost.
2. Lines whose counter plus error reaches the threshold are candidates; their documents are counted exactly, by the line itself.
3. Confirmed lines, a set whose size is checked before it is broadcast, are looked up in every document.

Lines are compared after lower-casing, deleting the digits 0-9, turning each run of white space into one space, and trimming;
lines without a letter don't count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lontar.session import cut, small_side

#: White space in the sense of Unicode and of the information separators.
SPACE = "[\\s\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+"


def normal_line(line: Column) -> Column:
    """The form in which two lines are compared."""
    no_digits = F.regexp_replace(F.lower(line), "[0-9]", "")
    return F.trim(F.regexp_replace(no_digits, SPACE, " "))


def counts(line: Column) -> Column:
    """Whether a normalised line counts: it has a letter."""
    return line.rlike("\\p{L}")


class HeavyHitters:
    """A mergeable Misra-Gries summary of 64-bit items; true counts are at most ``error`` above the counters."""

    def __init__(self) -> None:
        self.items, self.counters, self.error = np.empty(0, np.int64), np.empty(0, np.int64), 0

    def add(self, items: np.ndarray, counters: np.ndarray, capacity: int) -> None:
        """Merge counted items, then shrink to ``capacity`` counters."""
        keys, inverse = np.unique(np.concatenate([self.items, items]), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate([self.counters, counters])).astype(np.int64)
        if len(keys) > capacity:
            cut = int(np.partition(total, len(total) - capacity - 1)[len(total) - capacity - 1])
            self.error += cut
            keys, total = keys[total > cut], total[total > cut] - cut
        self.items, self.counters = keys, total


def _summaries(docs: DataFrame, share: float) -> DataFrame:
    """Counters (source, hash, c), and for each source and partition one row with hash null: its error, documents and lines."""

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[str | None, list] = {}
        for b in batches:
            for source, g in b.groupby("source", dropna=False):
                source = None if source is None or source != source else source
                mine = kept.setdefault(source, [HeavyHitters(), 0, 0])
                h = np.concatenate([np.asarray(x, np.int64) for x in g["hashes"]]) if len(g) else np.empty(0, np.int64)
                mine[1] += len(g)
                mine[2] += len(h)
                items, c = np.unique(h, return_counts=True)
                mine[0].add(items, c, int(2 / share * max(1.0, mine[2] / max(1, mine[1]))) + 1)
        for source, (hh, n_docs, _) in kept.items():
            yield pd.DataFrame({"source": [source], "hash": pd.array([None], dtype="Int64"), "c": [0], "error": [hh.error], "docs": [n_docs]})
            if len(hh.items):
                yield pd.DataFrame({"source": source, "hash": pd.array(hh.items, dtype="Int64"), "c": hh.counters, "error": 0, "docs": 0})

    return docs.mapInPandas(summarise, "source string, hash long, c long, error long, docs long")


def _lines(articles: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    return articles.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.split(F.col(text_col).cast("string"), "\n", -1).alias("lines")).where("lines is not null")


def _reach(least_docs: int, share: float) -> Column:
    return F.greatest(F.lit(least_docs), F.ceil(F.col("n_all") * F.lit(share) - 1e-9))


def candidates(hashed: DataFrame, sizes: DataFrame, least_docs: int, share: float) -> DataFrame:
    """(s, h, n_all), sources and hashes that may reach the threshold, none that does left out, from each document's distinct hashes
    (source, hashes) and the documents of each source (source, n_all)."""
    # one shuffle: counters by line, with the error and size rows of the source (hash null) beside them
    merged = cut(_summaries(hashed, share).groupBy("source", "hash").agg(F.sum("c").alias("c"), F.sum("error").alias("error")))
    error = small_side(merged.where("hash is null").select(F.col("source").alias("s"), F.col("error").alias("e")))
    near = (
        merged.where("hash is not null")
        .join(error, F.col("source").eqNullSafe(F.col("s")))
        .drop("s", "error")
        .join(sizes.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .where(F.col("c") + F.col("e") >= _reach(least_docs, share))
        .select(F.col("source").alias("s"), F.col("hash").alias("h"), "n_all")
    )
    return small_side(near)


def repeated_hashes(hashed: DataFrame, least_docs: int, share: float) -> DataFrame:
    """(source, hash): hashes in at least ``least_docs`` documents and ``share`` of their source's documents, counted over all rows
    (source, hashes), each document's distinct hashes; a document without any counts for its source."""
    sizes = small_side(hashed.groupBy("source").agg(F.count("*").alias("n_all")))
    near = candidates(hashed, sizes, least_docs, share)
    own = hashed.select("source", F.explode("hashes").alias("hash"))
    met = own.join(near, F.col("source").eqNullSafe(F.col("s")) & (F.col("hash") == F.col("h")))
    return met.groupBy("source", "hash", "n_all").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= _reach(least_docs, share)).select("source", "hash")


def repeated_lines(articles: DataFrame, id_col: str = "article_id", source_col: str = "source_id", text_col: str = "content_text", least_docs: int = 5, share: float = 0.02) -> DataFrame:
    """(source, line, n_docs, n_all): normalised lines in at least ``least_docs`` documents and ``share`` of their source's documents.

    A null source counts as one source of its own. Documents with null text have no lines but count as documents of their source.
    Repeated rows count as often as they occur. An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    lines = _lines(articles, id_col, source_col, text_col)
    distinct = lines.select("source", F.array_distinct(F.filter(F.transform("lines", normal_line), counts)).alias("own"))
    hashed = distinct.select("source", F.transform("own", lambda x: F.xxhash64(x)).alias("hashes"))
    sizes = small_side(articles.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.count("*").alias("n_all")))
    near = candidates(hashed, sizes, least_docs, share)
    own = distinct.select("source", F.explode("own").alias("line"))
    exact = (
        own.join(near, F.col("source").eqNullSafe(F.col("s")) & (F.xxhash64("line") == F.col("h")))
        .groupBy("source", "line", "n_all")
        .agg(F.count("*").alias("n_docs"))
        .where(F.col("n_docs") >= _reach(least_docs, share))
    )
    return exact.select("source", "line", "n_docs", "n_all")


def occurrences(articles: DataFrame, repeated: DataFrame, id_col: str = "article_id", source_col: str = "source_id", text_col: str = "content_text") -> DataFrame:
    """(id, line_no): where the repeated lines stand; lines are counted from 1, all lines included."""
    at = _lines(articles, id_col, source_col, text_col).select("id", "source", F.posexplode("lines").alias("pos", "raw"))
    wanted = small_side(repeated.select(F.col("source").alias("s"), F.col("line").alias("l")))
    hit = at.withColumn("line", normal_line(F.col("raw"))).join(wanted, F.col("source").eqNullSafe(F.col("s")) & (F.col("line") == F.col("l")))
    return hit.select("id", (F.col("pos") + 1).cast("int").alias("line_no"))


def hashed_lines(articles: DataFrame, id_col: str = "article_id", source_col: str = "source_id", text_col: str = "content_text") -> DataFrame:
    """(id, source, hashes): of every document the 64-bit hashes of its normalised lines in their order, null for lines that don't count."""
    lines = F.transform(F.split(F.col(text_col).cast("string"), "\n", -1), normal_line)
    return articles.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.transform(lines, lambda x: F.when(counts(x), F.xxhash64(x))).alias("hashes"))


def repeated_places(articles: DataFrame, id_col: str = "article_id", source_col: str = "source_id", text_col: str = "content_text", least_docs: int = 5, share: float = 0.02) -> DataFrame:
    """(id, line_no): where lines stand that ``repeated_lines`` would give. Texts are normalised once: summaries, exact counts and look-up
    all read the kept hashes, so a line is told from the repeated ones of its source by 64 bits."""
    hashed = cut(hashed_lines(articles, id_col, source_col, text_col))
    own = F.coalesce(F.array_distinct(F.array_compact("hashes")), F.array().cast("array<long>"))
    wanted = small_side(repeated_hashes(hashed.select("source", own.alias("hashes")), least_docs, share).select(F.col("source").alias("s"), F.col("hash").alias("h")))
    at = hashed.select("id", "source", F.posexplode("hashes").alias("pos", "hash")).where("hash is not null")
    return at.join(wanted, F.col("source").eqNullSafe(F.col("s")) & (F.col("hash") == F.col("h"))).select("id", (F.col("pos") + 1).cast("int").alias("line_no"))


def without_lines(articles: DataFrame, repeated: DataFrame, id_col: str = "article_id", source_col: str = "source_id", text_col: str = "content_text") -> DataFrame:
    """(id, text): every document without its source's repeated lines; null text stays null.

    The lines of a source go with its documents as one array, bounded by the lines of a document over the share; the sources' arrays
    are broadcast if the counted lines allow, else they join by shuffle, where a large source is split by adaptive execution.
    """
    wanted = small_side(repeated.select("source", "line"), 50_000)
    by_source = wanted.groupBy("source").agg(F.collect_set("line").alias("gone")).withColumnRenamed("source", "s")
    docs = articles.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    joined = docs.join(by_source, F.col("source").eqNullSafe(F.col("s")), "left")
    kept = F.filter(F.split("text", "\n", -1), lambda x: ~F.coalesce(F.array_contains(F.col("gone"), normal_line(x)), F.lit(False)))
    return joined.select("id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"))
