"""The read side: pages of articles, events with their articles, DTO projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lontar.config import limit as page_size, page as page_number, window
from lontar.functions.text import presence
from lontar.session import small_side

#: DTO key by stored column; others keep their name.
DTO_ALIASES = {"content_text": "content", "thumbnail_url": "featured_image"}
DTO_COLUMNS = ["article_id", "source_id", "external_article_id", "canonical_url", "normalized_url", "title", "subtitle", "content_text", "author_name", "category", "tags", "thumbnail_url", "published_at", "updated_at_source", "collected_at", "content_hash", "adapter_version", "parser_version", "validation_status", "validation_warnings", "summary", "language"]


def dto(articles: DataFrame) -> DataFrame:
    """Articles under the keys the read contract names, with source_url: canonical, else normalised."""
    return articles.select(*[F.col(c).alias(DTO_ALIASES.get(c, c)) for c in DTO_COLUMNS], F.coalesce(presence(F.col("canonical_url")), presence(F.col("normalized_url"))).alias("source_url"))


def matching(articles: DataFrame, source: str | None = None, search: str | None = None) -> DataFrame:
    """Valid articles, of one source, whose title or summary matches; % and _ in the search are wildcards."""
    rows = articles.where(F.col("validation_status") == "valid")
    rows = rows if source is None else rows.where(F.col("source_id") == source)
    return rows if not search else rows.where(F.col("title").ilike(f"%{search}%") | F.coalesce("summary", F.lit("")).ilike(f"%{search}%"))


def article_page(articles: DataFrame, sources: DataFrame, page: int | str | None = 1, limit: int | str | None = 20, source: str | None = None, search: str | None = None) -> DataFrame:
    """One page, newest first, with the number of all matches on every row.

    The number is one aggregate joined on, not a window over the whole table; a page past the end has no rows and so reports none.
    """
    n, size = page_number(page), page_size(limit)
    rows = matching(articles, source, search).withColumn("shown_at", F.coalesce("published_at", "collected_at"))
    rows = rows.join(sources.select("source_id", "display_name"), "source_id")
    top = rows.orderBy(F.desc("shown_at"), F.desc("article_id")).offset((n - 1) * size).limit(size)
    total = rows.agg(F.count("*").alias("total")).withColumn("_k", F.lit(1))
    return top.withColumn("_k", F.lit(1)).join(total, "_k").drop("_k")


def card(rows: DataFrame) -> DataFrame:
    """Articles as list entries: prefixed id, link or '#', tags always a list."""
    return rows.select(
        F.concat(F.lit("crawl-"), F.col("article_id").cast("string")).alias("id"), "title", F.coalesce(presence(F.col("canonical_url")), presence(F.col("normalized_url")), F.lit("#")).alias("url"), "source_id",
        presence(F.col("thumbnail_url")).alias("thumbnail"), F.coalesce("tags", F.array().cast("array<string>")).alias("tags"), F.coalesce("published_at", "collected_at").alias("shown_at"),
    )


def latest_run(runs: DataFrame, window_hours: int | str | None = None) -> DataFrame:
    """The last finished run of a window: by time of finishing, unfinished last, then by id."""
    return runs.where((F.col("status") == "succeeded") & (F.col("window_hours") == window(window_hours))).orderBy(F.desc_nulls_last("finished_at"), F.desc("run_id")).limit(1)


def issues(run: DataFrame, events: DataFrame, members: DataFrame, articles: DataFrame, sources: DataFrame, limit: int | str | None = 50) -> DataFrame:
    """The run's first ``limit`` events with their articles nested, newest first, events by media and article counts.

    ``run`` is one row. Events are cut before articles are joined, so only articles of events that are shown are read on; their ids go to
    the articles, of which none is exchanged unless the shown ones are too many for that.
    """
    size = page_size(limit)
    own = events.join(F.broadcast(run.select("run_id")), "run_id")
    first = own.orderBy(F.desc("media_count"), F.desc("article_count"), "event_id").limit(size)
    rank = F.row_number().over(Window.partitionBy("run_id").orderBy(F.desc("media_count"), F.desc("article_count"), "event_id"))
    first = F.broadcast(first.withColumn("position", rank))
    shown = small_side(first.join(members.select("run_id", "event_id", "article_id", "match_score"), ["run_id", "event_id"]))
    nested = (
        articles.select("article_id", "source_id", "title", "canonical_url", F.coalesce("published_at", "collected_at").alias("shown_at"))
        .join(shown, "article_id")
        .join(sources.select("source_id", "display_name"), "source_id")
        .groupBy("run_id", "event_id", "representative_title", "media_count", "article_count", "coverage_score", "position")
        .agg(F.sort_array(F.collect_list(F.struct("shown_at", "article_id", "source_id", "display_name", "title", "canonical_url", "match_score")), asc=False).alias("articles"))
    )
    summary = F.format_string("%d articles by %d media", F.col("article_count"), F.col("media_count"))
    return nested.withColumn("id", F.concat(F.lit("event-"), F.col("event_id").cast("string"))).withColumn("summary", summary).orderBy("position")


def envelope(data: object, code: int = 200, message: str = "ok") -> dict:
    """The response envelope."""
    return {"success": code < 400, "data": data, "message": message, "code": code}


def service_health(spark: SparkSession, tables: dict[str, DataFrame]) -> dict:
    """The answer of the health endpoint: ok where every table can be read, else degraded with the tables that can't."""
    broken = []
    for name, df in tables.items():
        try:
            df.limit(1).collect()
        except Exception as e:  # noqa: BLE001 - whatever a source throws, it can't be read
            broken.append(f"{name}: {type(e).__name__}")
    return envelope({"status": "degraded" if broken else "ok", "spark": spark.version, "broken": broken}, 503 if broken else 200, "ok" if not broken else "degraded")
