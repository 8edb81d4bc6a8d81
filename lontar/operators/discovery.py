"""Discovery: what of a listing is taken on, in set form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lontar.functions.dates import older_than
from lontar.functions.urls import normalize_url, without_params


def channel_union(items: DataFrame, order: Column, limit: int | None = None) -> DataFrame:
    """Items of several channels, first of a URL wins by ``order``, then at most ``limit`` of each source.

    The first of each URL is an aggregate, combined before the shuffle; only what is left is ranked.
    """
    first = items.withColumn("_o", order).groupBy("source_id", "normalized_url").agg(F.min_by(F.struct(*[c for c in items.columns if c not in ("source_id", "normalized_url")], "_o"), F.struct("_o", "raw_url")).alias("v"))
    out = first.select("source_id", "normalized_url", "v.*")
    if limit is not None:
        out = out.withColumn("_r", F.row_number().over(Window.partitionBy("source_id").orderBy("_o", "normalized_url"))).where(F.col("_r") <= limit).drop("_r")
    return out.drop("_o")


def shared_limit(items: DataFrame, order: Column, limit: int) -> DataFrame:
    """Items where the channels of a source share its limit: each gives its first ``limit`` over the number of channels, rounded up."""
    by = items.select("source_id", "discovery_channel").distinct().groupBy("source_id").agg(F.count("*").alias("_n"))
    ranked = items.withColumn("_r", F.row_number().over(Window.partitionBy("source_id", "discovery_channel").orderBy(order, "normalized_url")))
    return ranked.join(by, "source_id").where(F.col("_r") <= F.ceil(F.lit(limit) / F.col("_n"))).drop("_r", "_n")


def overlap_prefix(items: DataFrame, cutoff: Column, position: str = "position", hint: str = "published_hint", listing: list[str] | None = None) -> DataFrame:
    """Items of each listing before the first one that is surely older than the cut-off; unreadable hints never stop a listing."""
    by = listing or ["source_id"]
    stop = items.where(older_than(F.col(hint), cutoff)).groupBy(*by).agg(F.min(position).alias("_stop"))
    return items.join(stop, by, "left").where(F.col("_stop").isNull() | (F.col(position) < F.col("_stop"))).drop("_stop")


def recently_seen(discovered: DataFrame, now: Column, hours: Column | int) -> DataFrame:
    """Distinct (source_id, normalized_url) seen within the last hours, the limit itself excluded."""
    h = hours if isinstance(hours, Column) else F.lit(hours)
    limit = F.timestamp_micros((F.unix_micros(now) - h * F.lit(3_600_000_000)).cast("long"))
    return discovered.where(F.col("last_discovered_at") > limit).select("source_id", "normalized_url").distinct()


def to_enqueue(items: DataFrame, seen: DataFrame) -> DataFrame:
    """Items that weren't seen, each URL once."""
    return items.join(seen, ["source_id", "normalized_url"], "left_anti").dropDuplicates(["source_id", "normalized_url"])


def due_jobs(sources: DataFrame, start: Column, end: Column) -> DataFrame:
    """(source_id, due_at): when enabled sources' listings are due between two moments."""
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.col("crawl_interval_minutes"))
    return sources.where(F.col("enabled") & (F.col("crawl_interval_minutes") > 0)).select("source_id", F.explode(F.sequence(start, end, step)).alias("due_at"))


def prune_schedules(stored: DataFrame, sources: DataFrame, live: bool = False, bounded: bool = True) -> DataFrame:
    """(source_id, every_minutes, action) of recurring schedules: ``upsert`` what enabled sources should have, ``prune`` what they
    shouldn't; an unbounded live crawl has none at all."""
    wanted = sources.where(F.col("enabled") & (F.col("crawl_interval_minutes") > 0) & F.lit(bounded or not live)).select("source_id", F.col("crawl_interval_minutes").alias("every_minutes"))
    have = stored.select("source_id", F.lit(True).alias("_have")).distinct()
    both = have.join(wanted, "source_id", "full_outer")
    return both.select("source_id", "every_minutes", F.when(F.col("every_minutes").isNull(), "prune").otherwise("upsert").alias("action"))


# Attempts of a job, and the milliseconds before the second.
ATTEMPTS, BACKOFF_MS = 3, 5000


def retries(failed: DataFrame, attempts: int = ATTEMPTS, backoff_ms: int = BACKOFF_MS) -> DataFrame:
    """Failed jobs (.., attempts_made, failed_at) with ``retry_at``, the delay doubling with every attempt; null where none is left."""
    wait = F.lit(backoff_ms) * F.pow(F.lit(2), F.col("attempts_made") - 1)
    at = F.timestamp_micros(F.unix_micros("failed_at") + (wait * 1000).cast("long"))
    return failed.withColumn("retry_at", F.when((F.col("attempts_made") >= 1) & (F.col("attempts_made") < attempts), at))


def merge_pages(pages: DataFrame) -> DataFrame:
    """(article_url, paragraphs, pages): paragraphs of a multi-page article in order, up to the first missing or foreign page.

    ``pages`` has article_url, page_no, canonical_url, paragraphs; page 1 sets the canonical URL. A later page is foreign if it names
    another one, both in normal form without their page parameter; a page that names none is merged. Paragraphs within a page that
    carry their own page numbers are put in order by ``in_page_order`` before. An article's pages are few.
    """
    named = pages.withColumn("_c", without_params(normalize_url(F.col("canonical_url")), "page"))
    w = Window.partitionBy("article_url").orderBy("page_no")
    first = F.first("_c").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    fits = (F.row_number().over(w) == F.col("page_no")) & F.coalesce(F.col("_c") == first, F.lit(True))
    judged = named.withColumn("_ok", fits).withColumn("_on", F.bool_and("_ok").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).where("_on")
    return judged.groupBy("article_url").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("page_no", "paragraphs"))), lambda s: s["paragraphs"])).alias("paragraphs"), F.count("*").cast("int").alias("pages"))


def in_page_order(blocks: Column) -> Column:
    """Paragraphs of blocks (page, paragraphs) that one document holds, by page number; blocks without a number come first, as they stand."""
    ordered = F.array_sort(F.transform(blocks, lambda b, i: F.struct(F.coalesce(b["page"], F.lit(-1)).alias("p"), i.alias("i"), b["paragraphs"].alias("t"))))
    return F.flatten(F.transform(ordered, lambda b: b["t"]))
