"""Problem 8: mixing sources to target weights.

Each listed source gets a budget of tokens: its share of the total. All its documents are used as often as fits whole, and what is
left of the budget is filled by subset-sum fitting: the source's documents are counted by exact token length, every length gives its
proportional part, and a bounded-knapsack dynamic programme over the lengths closes the remaining gap, coming as near to the budget
as the lengths and repeats allow. Which documents of a length are taken is decided by a seeded hash.

Only the histogram (source, length, count) reaches the fitting, one task for each source; it is bounded by the lengths that occur,
not by the documents. Selection ranks documents within (source, length, hash bucket), so a length that very many documents share is
spread over buckets.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from lontar.llm.tokens import token_counts
from lontar.session import cut, small_side

#: Documents of one length of one source that one hash bucket should hold; a length has ``LEAST_BUCKETS`` at least.
IN_BUCKET, LEAST_BUCKETS = 50_000, 64
#: The programme closes a gap of at most so many tokens.
REACH = 1 << 16


def knapsack(lengths: list[int], counts: list[int], budget: int, over: int = 0) -> list[int]:
    """How many of each length to take so that the sum is nearest to ``budget``, at most ``over`` above it; below wins a tie.

    Exact bounded subset sum: reachable sums are the bits of one integer per length. The budget must be moderate (``REACH``), lengths
    may be many.
    """
    take = [0] * len(lengths)
    most = budget + over
    if budget <= 0:
        return take
    full = (1 << (most + 1)) - 1
    sums = [1]
    used = []
    for i, (n, c) in enumerate(zip(lengths, counts)):
        c = min(c, most // n) if n > 0 else 0
        if c <= 0:
            continue
        reach, left, step = sums[-1], c, 1
        while left:  # c copies of n as powers of two and a rest
            k = min(step, left)
            reach |= (reach << (k * n)) & full
            left -= k
            step *= 2
        used.append((i, n, c))
        sums.append(reach)
        if reach >> budget & 1:
            break
    below = (sums[-1] & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = sums[-1] >> (budget + 1)
    at = below
    if above and (above & -above).bit_length() < budget - below:
        at = budget + (above & -above).bit_length()
    for (i, n, c), before in zip(reversed(used), reversed(sums[:-1])):
        for k in range(c + 1):
            if at >= k * n and before >> (at - k * n) & 1:
                take[i] = k
                at -= k * n
                break
    return take


def fit_lengths(lengths: np.ndarray, counts: np.ndarray, budget: int, repeats: int = 1, seed: int = 0) -> np.ndarray:
    """How many more uses each length gets so that their tokens come nearest to ``budget``.

    A document gets at most ``repeats`` more uses, and so does a length for each of its documents; the budget is under one use of all.
    """
    total = int((lengths * counts).sum())
    if budget <= 0 or repeats <= 0 or not len(lengths):
        return np.zeros(len(lengths), np.int64)
    if budget >= total * repeats:
        return counts * repeats
    take = np.array([int(c) * budget // total for c in counts.tolist()], np.int64)
    gap = budget - int((take * lengths).sum())
    order = np.random.default_rng(seed).permutation(len(lengths))
    for i in order:  # bring the gap into the programme's reach
        if gap <= REACH:
            break
        k = min(int(counts[i] - take[i]), max(0, (gap - REACH // 2) // int(lengths[i])))
        take[i] += k
        gap -= k * int(lengths[i])
    for i in order:  # and leave it enough room to choose
        if gap >= REACH // 4:
            break
        k = min(int(take[i]), -(-(REACH // 4 - gap) // int(lengths[i])))
        k = min(k, max(0, (REACH - gap) // int(lengths[i])))
        take[i] -= k
        gap += k * int(lengths[i])
    free = counts * repeats - take
    over = int(min(gap, REACH))
    at = [int(i) for i in order if free[i] > 0 and lengths[i] <= gap + over]
    for i, k in zip(at, knapsack([int(lengths[i]) for i in at], [int(free[i]) for i in at], gap, over)):
        take[i] += k
    return take


def mix(sized: DataFrame, targets: DataFrame, total: int | None = None, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Uses (id, source, tokens, uses) and report (one row per listed source) of a mixture.

    ``sized`` has id, source and tokens; ``targets`` has source, target_share and max_repeats, one row per source, a bounded list.
    Without ``total`` it is the largest at which every listed source that has tokens can reach its share within its repeats.
    Documents without tokens, with a null source or of sources that aren't listed are not used. A source that can't fill its budget
    is used up and reported as short; one without documents, a null or non-positive share or repeats under 1 contributes nothing.
    A repeated id is another document. Empty tables give an empty mixture and a report of what is listed.
    """
    spark = sized.sparkSession
    goals = targets.groupBy("source").agg(F.max("target_share").cast("double").alias("target_share"), F.max("max_repeats").cast("long").alias("max_repeats")).where("source is not null")
    listed = small_side(goals, 100_000)
    kept = cut(sized.where("tokens > 0 and source is not null").join(listed.select("source"), "source", "left_semi").select("id", "source", "tokens"))
    hist = cut(kept.groupBy("source", "tokens").agg(F.count("*").alias("n")))
    buckets = max(LEAST_BUCKETS, -(-(hist.agg(F.max("n")).first()[0] or 0) // IN_BUCKET))
    have = listed.join(hist.groupBy("source").agg(F.sum(F.col("tokens") * F.col("n")).alias("available"), F.sum("n").alias("docs")), "source", "left").na.fill(0, ["available", "docs"])
    may = (F.col("target_share") > 0) & (F.col("max_repeats") >= 1)
    if total is None:
        room = have.where(may & (F.col("available") > 0)).agg(F.min(F.col("available") * F.col("max_repeats") / F.col("target_share"))).first()[0]
        total = int(room or 0)
    budgets = small_side(
        have.withColumn("budget", F.when(may, F.floor(F.lit(total) * F.col("target_share"))).otherwise(0).cast("long"))
        .withColumn("within", F.when(may, F.least("budget", F.col("available") * F.col("max_repeats"))).otherwise(0).cast("long"))
        .withColumn("rounds", F.when(F.col("available") > 0, F.floor(F.col("within") / F.col("available"))).otherwise(0).cast("long"))
        .withColumn("rest", F.col("within") - F.col("rounds") * F.col("available")),
        100_000,
    )

    def fit(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("tokens")
        return pd.DataFrame({"source": g["source"], "tokens": g["tokens"], "docs": g["n"], "more": fit_lengths(g["tokens"].to_numpy(np.int64), g["n"].to_numpy(np.int64), int(g["rest"].iloc[0]), int(g["repeats"].iloc[0]), seed)})

    more = cut(hist.join(budgets.select("source", "rest", (F.col("max_repeats") - F.col("rounds")).alias("repeats")), "source").groupBy("source").applyInPandas(fit, "source string, tokens long, docs long, more long"))
    more = more.withColumn("each", F.floor(F.col("more") / F.col("docs"))).withColumn("once", F.col("more") % F.col("docs"))
    ranked = kept.withColumn("h", F.xxhash64(F.lit(seed), F.col("id"))).withColumn("bucket", F.pmod(F.shiftrightunsigned("h", 40), F.lit(buckets)).cast("int"))
    in_bucket = ranked.groupBy("source", "tokens", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source", "tokens").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    quota = (
        in_bucket.withColumn("before", F.coalesce(before, F.lit(0)))
        .join(more, ["source", "tokens"])
        .select("source", "tokens", "bucket", "each", F.greatest(F.lit(0), F.least(F.col("n"), F.col("once") - F.col("before"))).alias("quota"))
    )
    place = F.row_number().over(Window.partitionBy("source", "tokens", "bucket").orderBy("h", "id"))
    uses = (
        ranked.withColumn("place", place)
        .join(quota, ["source", "tokens", "bucket"])
        .join(budgets.select("source", "rounds"), "source")
        .withColumn("uses", F.col("rounds") + F.col("each") + F.when(F.col("place") <= F.col("quota"), 1).otherwise(0))
        .where("uses > 0")
        .select("id", "source", "tokens", F.col("uses").cast("int").alias("uses"))
    )
    used = budgets.join(more.groupBy("source").agg(F.sum(F.col("tokens") * F.col("more")).alias("extra")), "source", "left").withColumn("used_tokens", F.coalesce(F.col("rounds") * F.col("available"), F.lit(0)) + F.coalesce("extra", F.lit(0)))
    everything = int(used.agg(F.sum("used_tokens")).first()[0] or 0)
    report = used.select(
        "source", "target_share", "max_repeats", F.col("docs").alias("documents"), F.col("available").alias("available_tokens"), F.col("budget").alias("target_tokens"), "used_tokens",
        (F.col("used_tokens") / F.lit(max(1, everything))).alias("share"),
        F.greatest(F.lit(0), F.col("budget") - F.col("used_tokens")).alias("short_tokens"),
        F.lit(total).cast("long").alias("total_target"),
    )
    return uses, report


def size_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", path: str | None = None) -> DataFrame:
    """(id, tokens, source) of every document, sizes in tokens of the vocabulary."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).cast("string").alias("source"))
    return token_counts(rows, "id", "text", path, keep=("source",))
