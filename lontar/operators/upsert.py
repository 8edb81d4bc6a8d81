"""Keyed merges: what the store does when rows arrive. Plain Parquet has no MERGE, so a merge is one full outer join and a rewrite.

Incoming rows are reduced to one per key before they meet the stored table, so a key that very many incoming rows share is combined
on the map side.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def last_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order``, as an aggregate."""
    others = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_v"))
    return best.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in others])


def _full(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> tuple[DataFrame, Column]:
    """Stored (o_...) and incoming (n_...) rows side by side; whether the key is new."""
    o = stored.select(*[F.col(c).alias(f"o_{c}") for c in stored.columns], F.lit(True).alias("o__"))
    n = incoming.select(*[F.col(c).alias(f"n_{c}") for c in incoming.columns], F.lit(True).alias("n__"))
    on = [F.col(f"o_{k}").eqNullSafe(F.col(f"n_{k}")) for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return o.join(n, cond, "full_outer"), F.col("o__").isNull()


def upsert_sources(stored: DataFrame, incoming: DataFrame, now: Column) -> DataFrame:
    """Sources by id: incoming values win, enabled is true by default, created_at stays."""
    new = last_per_key(incoming.withColumn("enabled", F.coalesce("enabled", F.lit(True))), ["source_id"], ["display_name"])
    both, is_new = _full(stored, new, ["source_id"])
    pick = lambda c: F.when(F.col("n__"), F.col(f"n_{c}")).otherwise(F.col(f"o_{c}")).alias(c)
    kept = [c for c in stored.columns if c not in ("created_at", "updated_at")]
    return both.select(*[pick(c) for c in kept], F.coalesce("o_created_at", now).alias("created_at"), F.when(F.col("n__"), now).otherwise(F.col("o_updated_at")).alias("updated_at"))


def discovered_batch(items: DataFrame) -> DataFrame:
    """Sightings (source_id, raw_url, normalized_url, discovery_channel, discovery_page, listing_title, published_hint, seen_at) as one row per key."""
    known = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seen_at"))).alias(c)
    return items.groupBy("source_id", "normalized_url", "discovery_channel").agg(
        F.min_by("raw_url", F.struct("seen_at", "raw_url")).alias("raw_url"), F.min_by("discovery_page", F.struct("seen_at", "raw_url")).alias("discovery_page"), known("listing_title"), known("published_hint"),
        F.min("seen_at").alias("first_discovered_at"), F.max("seen_at").alias("last_discovered_at"), F.count("*").cast("int").alias("discovery_count"),
    )


def upsert_discovered(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Discovered URLs by source, URL and channel: counts add up, the last sighting and known hints are kept, raw_url and page stay the first."""
    keys = ["source_id", "normalized_url", "discovery_channel"]
    both, _ = _full(stored.select(*batch.columns), batch, keys)
    return both.select(
        *[F.coalesce(f"o_{k}", f"n_{k}").alias(k) for k in keys], F.when(F.col("o__"), F.col("o_raw_url")).otherwise(F.col("n_raw_url")).alias("raw_url"), F.when(F.col("o__"), F.col("o_discovery_page")).otherwise(F.col("n_discovery_page")).alias("discovery_page"),
        F.coalesce("n_listing_title", "o_listing_title").alias("listing_title"), F.coalesce("n_published_hint", "o_published_hint").alias("published_hint"), F.least("o_first_discovered_at", "n_first_discovered_at").alias("first_discovered_at"),
        F.greatest("o_last_discovered_at", "n_last_discovered_at").alias("last_discovered_at"), (F.coalesce("o_discovery_count", F.lit(0)) + F.coalesce("n_discovery_count", F.lit(0))).cast("int").alias("discovery_count"),
    )


REQUIRED = ["source_id", "requested_url", "final_url", "canonical_url", "normalized_url", "title", "content_text", "content_hash", "adapter_version", "parser_version"]


def storable() -> Column:
    """Whether a parsed article has all required fields."""
    ok = F.lit(True)
    for c in REQUIRED:
        ok = ok & F.col(c).isNotNull() & (F.col(c) != "")
    return ok


def with_warnings(articles: DataFrame) -> DataFrame:
    """Adds the warning of a missing publication date, once."""
    have = F.coalesce("validation_warnings", F.array().cast("array<string>"))
    return articles.withColumn("validation_warnings", F.when(F.col("published_at").isNull(), F.array_union(have, F.array(F.lit("missing_published_at")))).otherwise(F.col("validation_warnings")))


def upsert_articles(stored: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Merged articles, new revisions and outcomes of incoming versions, by (source_id, canonical_url).

    Incoming rows may hold several versions of a page; ``collected_at`` orders them. All but first_discovered_at are overwritten by the
    last version. A version is a revision where it is new or its hash differs from the version before it. Outcomes are stored with
    new_article or content_updated, or duplicate with duplicate_content.
    """
    keys = ["source_id", "canonical_url"]
    old = stored.select(*keys, F.col("content_hash").alias("_old_hash"), F.col("first_discovered_at").alias("_old_first"))
    # versions are ranked by their hashes alone; texts join only the versions that are kept
    versions = incoming.select(*keys, "content_hash", "collected_at").join(old, keys, "left")
    before = F.lag("content_hash").over(Window.partitionBy(*keys).orderBy("collected_at", "content_hash"))
    versions = versions.withColumn("_before", F.coalesce(before, "_old_hash"))
    outcome = versions.withColumn("status", F.when(F.col("_before").isNull() | (F.col("_before") != F.col("content_hash")), F.lit("stored")).otherwise("duplicate")).withColumn("reason", F.when(F.col("_before").isNull(), F.lit("new_article")).when(F.col("_before") != F.col("content_hash"), F.lit("content_updated")).otherwise("duplicate_content"))
    texts = incoming.select(*keys, "content_hash", "collected_at", "title", "content_text", "parser_version").dropDuplicates([*keys, "content_hash", "collected_at"])
    revisions = outcome.where("status = 'stored'").select(*keys, "content_hash", "collected_at").join(texts, [*keys, "content_hash", "collected_at"]).withColumnRenamed("collected_at", "captured_at")
    last = last_per_key(incoming, keys, ["collected_at", "content_hash"])
    both, _ = _full(stored, last, keys)
    firsts = F.coalesce("o_first_discovered_at", "n_first_discovered_at")
    merged = both.select(*[(firsts if c == "first_discovered_at" else F.when(F.col("n__"), F.col(f"n_{c}")).otherwise(F.col(f"o_{c}"))).alias(c) for c in stored.columns])
    return merged, revisions, outcome.select(*keys, "collected_at", "content_hash", "status", "reason")


def upsert_status(stored: DataFrame, changes: DataFrame) -> DataFrame:
    """Processing status by (source_id, normalized_url): last status and reason, attempts add up, a known article stays known.

    ``changes`` has source_id, normalized_url, status, reason, article_id, at.
    """
    keys = ["source_id", "normalized_url"]
    new = changes.groupBy(*keys).agg(F.max_by(F.struct("status", "reason"), F.struct("at", "status")).alias("v"), F.max_by("article_id", F.when(F.col("article_id").isNotNull(), F.col("at"))).alias("article_id"), F.count("*").cast("int").alias("attempts"), F.min("at").alias("first_seen_at"), F.max("at").alias("status_updated_at"))
    new = new.select(*keys, F.col("v.status").alias("status"), F.col("v.reason").alias("reason"), "article_id", "attempts", "first_seen_at", "status_updated_at")
    both, _ = _full(stored.select(*new.columns), new, keys)
    pick = lambda c: F.when(F.col("n__"), F.col(f"n_{c}")).otherwise(F.col(f"o_{c}")).alias(c)
    return both.select(
        *[F.coalesce(f"o_{k}", f"n_{k}").alias(k) for k in keys], pick("status"), pick("reason"), F.coalesce("n_article_id", "o_article_id").alias("article_id"),
        (F.coalesce("o_attempts", F.lit(0)) + F.coalesce("n_attempts", F.lit(0))).cast("int").alias("attempts"), F.least("o_first_seen_at", "n_first_seen_at").alias("first_seen_at"), F.greatest("o_status_updated_at", "n_status_updated_at").alias("status_updated_at"),
    )


RUN_TABLES = ("news_events", "news_event_articles", "event_runs")


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def replace_run(path: str, run_key: str, events: DataFrame, members: DataFrame, run: DataFrame) -> None:
    """Write a run's snapshot so that writing it again replaces it as a whole: events, members and the run together, or none of them.

    The snapshot goes to a folder of its own; then one file, the run's pointer, is swapped to name it. Readers follow the pointer, so
    they see the old snapshot or the new one, also where the new one has no events. A run that fails half-way leaves the old one. The
    snapshot before the last is removed. The run's row gets status ``succeeded`` and ``finished_at``.
    """
    spark = events.sparkSession
    version = f"{run_key}-{uuid.uuid4().hex}"
    done = run.withColumn("status", F.lit("succeeded")).withColumn("finished_at", F.current_timestamp())
    for name, df in zip(RUN_TABLES, (events, members, done)):
        df.withColumn("run_key", F.lit(run_key)).write.parquet(f"{path}/versions/{version}/{name}")
    before = current_version(spark, path, run_key)
    fs, part = _files(spark, f"{path}/current/{run_key}.{uuid.uuid4().hex}.part")
    out = fs.create(part, False)
    out.write(bytearray(version.encode()))
    out.close()
    # the one step that readers see
    where = [part.toUri()] if part.toUri().getScheme() else []
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(*where, spark._jsc.hadoopConfiguration())
    overwrite = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
    context.rename(part, _files(spark, f"{path}/current/{run_key}")[1], overwrite)
    if before:
        fs.delete(_files(spark, f"{path}/versions/{before}")[1], True)


def current_version(spark: SparkSession, path: str, run_key: str) -> str | None:
    """The folder of a run's snapshot, None if it has none."""
    fs, at = _files(spark, f"{path}/current/{run_key}")
    return spark.read.text(f"{path}/current/{run_key}", wholetext=True).first()[0] if fs.exists(at) else None


def read_run(spark: SparkSession, path: str, run_key: str) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """Events, members and run of a run's snapshot, None if it has none."""
    version = current_version(spark, path, run_key)
    return None if version is None else tuple(spark.read.parquet(f"{path}/versions/{version}/{t}") for t in RUN_TABLES)
