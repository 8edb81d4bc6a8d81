"""Lexical clustering of articles into events, as set operations.

A pair's score depends only on its two articles and on document frequencies, so the greedy pass over articles in time order equals:
accepted pairs (candidate pairs that share an anchor within the hours apart, scored), then the lexicographically first maximal
independent set of the accepted pairs as seeds, then every other article with its best seed. ``assign`` finds that from listed pairs,
``cluster`` block by block of articles in order (``operators/greedy.py``), without listing any.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from lontar.config import Clustering
from lontar.functions.text import GENERIC_ANCHORS, bigrams, tokens
from lontar.operators.greedy import seeded
from lontar.operators.pairblocks import MEMBERS, block_pairs
from lontar.session import cut, small_side


def windowed(articles: DataFrame, hours: int, anchor: Column | None = None) -> DataFrame:
    """Articles collected from ``hours`` before the anchor on, the latest collection by default; no upper bound."""
    if anchor is None:  # a literal, so that the limit reaches the scan
        anchor = F.lit(articles.agg(F.max("collected_at")).first()[0]).cast("timestamp")
    return articles.where(F.col("collected_at") >= anchor - F.expr(f"interval {hours} hours"))


def prepared(articles: DataFrame, strict: bool = True) -> DataFrame:
    """(id, source_id, title, at, ord, title_tokens, all_tokens, phrases) of articles. One without an id or a source is an error when
    run, or is left out unless ``strict``."""
    if strict:
        given = lambda c: F.when(F.col(c).isNotNull(), F.col(c)).otherwise(F.raise_error(F.lit(f"an article without {c}"))).alias(c)
        rows = articles.select(*[given(c) if c in ("article_id", "source_id") else F.col(c) for c in articles.columns])
    else:
        rows = articles.where("article_id is not null and source_id is not null")
    title = F.array_distinct(tokens(F.col("title")))
    summary = F.array_distinct(tokens(F.col("summary")))
    # moments count to the millisecond, ids as strings break ties
    order = F.struct(F.date_trunc("millisecond", "collected_at").alias("at"), F.col("article_id").cast("string").alias("id"))
    out = rows.select(F.col("article_id").alias("id"), "source_id", "title", F.date_trunc("millisecond", "collected_at").alias("at"), order.alias("ord"), title.alias("title_tokens"), summary.alias("summary_tokens"))
    return out.select("id", "source_id", "title", "at", "ord", "title_tokens", F.array_union("title_tokens", "summary_tokens").alias("all_tokens"), bigrams(F.col("title_tokens")).alias("phrases"))


def document_frequency(docs: DataFrame, column: str = "all_tokens") -> DataFrame:
    """(token, df): in how many documents a token or phrase is."""
    return docs.select(F.explode(F.array_distinct(column)).alias("token")).groupBy("token").agg(F.count("*").alias("df"))


def anchors(docs: DataFrame) -> DataFrame:
    """(id, kind, token, df, pos): tokens that are rare enough and not generic, and phrases of such words; kind 'a' or 'p'."""
    most = max(40, int(docs.count() * 0.025))
    rare = document_frequency(docs).where(F.col("df") <= most).where(~F.col("token").isin(GENERIC_ANCHORS))
    single = docs.select("id", F.posexplode("all_tokens").alias("pos", "token")).join(rare, "token").select("id", F.lit("a").alias("kind"), "token", "df", "pos")
    phrase = document_frequency(docs, "phrases").where("df <= 12")
    generic = F.exists(F.split("token", " "), lambda w: w.isin(GENERIC_ANCHORS))
    double = docs.select("id", F.posexplode("phrases").alias("pos", "token")).where(~generic).join(phrase, "token").select("id", F.lit("p").alias("kind"), "token", "df", "pos")
    return single.unionByName(double)


def candidate_pairs(docs: DataFrame, marks: DataFrame, hours_apart: int = 36) -> DataFrame:
    """(later, earlier, shared_anchors, shared_phrases, first_pos): pairs that share an anchor within the hours apart, the earlier first in order.

    Frequencies bound the fan-out of every key, and time slices of the hours apart go into the join key, so that a term spread over
    weeks pairs only within two neighbouring slices.
    """
    slice_s = hours_apart * 3600
    timed = marks.join(docs.select("id", "at", "ord"), "id").withColumn("slice", F.floor(F.unix_timestamp("at") / slice_s))
    x = timed.select(F.col("id").alias("later"), F.col("at").alias("ax"), F.col("ord").alias("ox"), "kind", "token", F.col("pos").alias("px"), F.explode(F.array(F.col("slice"), F.col("slice") - 1)).alias("slice"))
    y = timed.select(F.col("id").alias("earlier"), F.col("at").alias("ay"), F.col("ord").alias("oy"), "kind", "token", "slice")
    near = x.join(y, ["kind", "token", "slice"]).where((F.col("oy") < F.col("ox")) & (F.unix_millis("ax") - F.unix_millis("ay") <= slice_s * 1000))
    pairs = near.groupBy("later", "earlier").agg(F.count_if(F.col("kind") == "a").alias("shared_anchors"), F.count_if(F.col("kind") == "p").alias("shared_phrases"), F.min(F.when(F.col("kind") == "a", F.col("px"))).alias("first_pos"))
    return pairs.where("shared_anchors > 0")


def _judged(pairs: DataFrame, c: Clustering) -> DataFrame:
    """Pairs with by_words, accepted and score."""
    by_words = ((F.col("shared_anchors") >= 2) & (F.col("wj") >= c.jaccard)) | ((F.col("shared_phrases") >= 1) & (F.col("wj") >= c.phrase_jaccard))
    out = pairs.withColumn("lcs", F.coalesce(F.nanvl("lcs", F.lit(0.0)), F.lit(0.0))).withColumn("by_words", by_words)
    accepted = F.col("by_words") | ((F.col("shared_anchors") >= 3) & (F.col("lcs") >= c.sequence))
    score = F.least(F.lit(1.0), 0.55 * F.col("wj") + 0.25 * F.col("lcs") + 0.20 * F.least(F.col("shared_anchors"), F.lit(5)) / 5)
    return out.withColumn("accepted", accepted).withColumn("score", F.when(F.col("accepted"), F.round(score, 10)))


def scored_pairs(docs: DataFrame, marks: DataFrame, c: Clustering | None = None, ratio: bool = True) -> DataFrame:
    """Candidate pairs with weighted Jaccard, accepted and score, scored in pairs of blocks.

    Common weight is summed over the shared tokens in a fixed order, united weight follows from the totals. The subsequence ratio is
    computed, with ``ratio``, only where it matters: for pairs accepted by their words and those with three shared anchors; it is 0
    elsewhere, and without it ``accepted`` and ``score`` mean nothing.
    """
    c = c or Clustering()
    return _judged(block_pairs(docs, marks, c, ratio=ratio), c)


def assign(docs: DataFrame, scored: DataFrame, small: int = 500_000) -> DataFrame:
    """(id, seed, score): seeds with themselves at score 1, every other article with its best seed.

    Up to ``small`` accepted pairs are resolved in order by one task; more of them in rounds: an undecided article whose accepted earlier partners are all members is a seed; one with a seed among them is a member.
    Decisions are cut from the plan in every round; rounds are as many as the longest chain of dependence, a handful on news.
    """
    edges = cut(scored.where("accepted").select("later", "earlier", "score", "first_pos"))
    if edges.count() <= small:
        return _assign_in_order(docs, edges)
    state = cut(docs.select("id").join(edges.select(F.col("later").alias("id")).distinct().withColumn("waits", F.lit(True)), "id", "left").select("id", F.when(F.col("waits"), F.lit(None)).otherwise(F.lit(True)).cast("boolean").alias("seed")))
    while state.where("seed is null").limit(1).count():
        open_ = edges.join(state.where("seed is null").select(F.col("id").alias("later")), "later").join(state.select(F.col("id").alias("earlier"), "seed"), "earlier")
        verdict = open_.groupBy("later").agg(F.bool_or(F.coalesce("seed", F.lit(False))).alias("member"), F.bool_and(F.col("seed").isNotNull() & ~F.coalesce("seed", F.lit(True))).alias("lonely"))
        state = cut(state.join(verdict.withColumnRenamed("later", "id"), "id", "left").select("id", F.when(F.col("seed").isNotNull(), F.col("seed")).when(F.col("member"), F.lit(False)).when(F.col("lonely"), F.lit(True)).alias("seed")))
    seeds = state.where("seed").select("id")
    order = docs.select(F.col("id").alias("earlier"), F.col("ord").alias("seed_ord"))
    best = edges.join(state.where("not seed").select(F.col("id").alias("later")), "later").join(seeds.select(F.col("id").alias("earlier")), "earlier").join(order, "earlier").groupBy("later").agg(F.min_by(F.struct("earlier", "score"), F.struct((-F.col("score")).alias("s"), "first_pos", "seed_ord")).alias("b"))
    return seeds.select("id", F.col("id").alias("seed"), F.lit(1.0).alias("score")).unionByName(best.select(F.col("later").alias("id"), F.col("b.earlier").alias("seed"), F.col("b.score").alias("score")))


def _assign_in_order(docs: DataFrame, edges: DataFrame) -> DataFrame:
    """``assign`` for a bounded number of accepted pairs: one pass over the later articles in order."""
    order = docs.select("id", "ord")
    known = edges.join(order.toDF("later", "ox"), "later").join(order.toDF("earlier", "oy"), "earlier").select(F.lit(1).alias("k"), "later", "earlier", "score", "first_pos", F.col("ox.at").alias("xa"), F.col("ox.id").alias("xi"), F.col("oy.at").alias("ya"), F.col("oy.id").alias("yi"))

    def resolve(g: pd.DataFrame) -> pd.DataFrame:
        out: dict = {}
        g = g.sort_values(["xa", "xi", "score", "first_pos", "ya", "yi"], ascending=[True, True, False, True, True, True], kind="stable")
        for later, earlier, score in zip(g["later"], g["earlier"], g["score"]):
            if later not in out and earlier not in out:  # an article that is no member is a seed
                out[later] = (earlier, score)
        return pd.DataFrame([(m, s, x) for m, (s, x) in out.items()], columns=["id", "seed", "score"])

    kind = docs.schema["id"].dataType.simpleString()
    members = cut(known.groupBy("k").applyInPandas(resolve, f"id {kind}, seed {kind}, score double"))
    return docs.select("id").join(members.select("id"), "id", "left_anti").select("id", F.col("id").alias("seed"), F.lit(1.0).alias("score")).unionByName(members)


def coverage_score(media: Column, n: Column) -> Column:
    """Ten points a medium plus the binary logarithm of the number of articles."""
    return F.round(10 * media + F.log2(F.greatest(F.lit(1), n)), 4)


def events(docs: DataFrame, marks: DataFrame, assigned: DataFrame) -> DataFrame:
    """One row for each cluster of two sources and more: representative title, up to twelve anchors, counts, span, coverage; in report order.

    The representative is the member whose title tokens recur most in the others' titles, summed from token counts of the event. Ids go to
    where articles and anchors are, as far as they fit a broadcast; each event's words then lie together and are exchanged once.
    """
    placed = docs.select("id", "source_id", "at").join(small_side(assigned.select("id", "seed"), MEMBERS), "id")
    roll = small_side(placed.groupBy("seed").agg(F.count("*").alias("article_count"), F.count_distinct("source_id").alias("media_count"), F.min("at").alias("first_seen_at"), F.max("at").alias("last_seen_at")).where("media_count >= 2"))
    members = small_side(placed.join(roll.select("seed"), "seed").select("id", "seed", "at"), MEMBERS)
    order = (F.col("at"), F.col("id").cast("string").alias("sid"))
    words = docs.select("id", "title_tokens").join(members, "id").repartition("seed").select("seed", "id", "at", F.explode_outer("title_tokens").alias("token"))
    others = F.when(F.col("token").isNotNull(), F.count("*").over(Window.partitionBy("seed", "token")) - 1).otherwise(0)
    central = words.withColumn("others", others).groupBy("seed", "id").agg(F.sum("others").alias("c"), F.first("at").alias("at"))
    chosen = small_side(central.groupBy("seed").agg(F.min_by("id", F.struct((-F.col("c")).alias("c"), *order)).alias("id")))
    named = docs.select("id", F.col("title").alias("representative_title")).join(chosen, "id").drop("id")
    tokens_of = marks.where("kind = 'a'").select("id", "token", "pos").join(members, "id").groupBy("seed", "token").agg(F.min(F.struct(*order, "pos")).alias("first"))
    place = F.row_number().over(Window.partitionBy("seed").orderBy("first", "token"))
    top = tokens_of.withColumn("r", place).where("r <= 12").groupBy("seed").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "token"))), lambda s: s["token"]).alias("anchor_terms"))
    out = roll.join(named, "seed").join(top, "seed", "left").withColumn("coverage_score", coverage_score(F.col("media_count"), F.col("article_count")))
    return out.orderBy(F.desc("media_count"), F.desc("article_count"), "seed")


def cluster(articles: DataFrame, hours: int = 72, anchor: Column | None = None, c: Clustering | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events, assignments and one row of metrics of one window: article_count, candidate_count, accepted_edges, event_count."""
    docs = cut(prepared(windowed(articles, hours, anchor)))
    marks = cut(anchors(docs))
    assigned, candidates = seeded(docs, marks, c or Clustering())
    found = cut(events(docs, marks, assigned))
    one = lambda df, name: df.agg(F.count("*").alias(name)).withColumn("_k", F.lit(1))
    metrics = one(docs, "article_count").withColumn("candidate_count", F.lit(candidates).cast("long")).join(one(assigned.where("id != seed"), "accepted_edges"), "_k").join(one(found, "event_count"), "_k").drop("_k")
    return found, assigned, metrics
