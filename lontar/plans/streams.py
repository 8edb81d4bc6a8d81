"""Streaming queries, run over what is stored and drained into files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from lontar.plans.catalog import query
from lontar.session import shared_dir
from lontar.sources.tables import table
from lontar.streaming import jobs


def _sightings(spark: SparkSession, sf: str) -> DataFrame:
    """The sightings as a stream; the pattern fits a file as well as a folder."""
    like = table(spark, sf, "discovered_urls")
    return jobs.stream_of(spark, f"{sf}/discovered_urls.parq*t", like, files_per_trigger=10_000)


def _drained(spark: SparkSession, df: DataFrame) -> DataFrame:
    at = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    return jobs.drain_to(df, f"{at}/out", f"{at}/state")


@query("stream_seen", "SELECT DISTINCT source_id, normalized_url FROM discovered_urls")
def stream_seen(spark: SparkSession, sf: str) -> DataFrame:
    """First sightings within a retention longer than the crawl."""
    return _drained(spark, jobs.first_sightings(_sightings(spark, sf).select("source_id", "normalized_url", "first_discovered_at"), "first_discovered_at", 24 * 30)).select("source_id", "normalized_url")


@query("stream_unseen", """WITH s AS (SELECT source_id, normalized_url, first_discovered_at AS t, lag(first_discovered_at) OVER (PARTITION BY source_id, normalized_url ORDER BY first_discovered_at, discovery_id) AS p FROM discovered_urls)
 SELECT source_id, normalized_url, epoch_us(t) AS at_us FROM s WHERE p IS NULL OR t - p >= INTERVAL 6 HOUR""")
def stream_unseen(spark: SparkSession, sf: str) -> DataFrame:
    """Sightings of URLs that weren't seen within six hours before, each sighting renewing the retention."""
    out = _drained(spark, jobs.unseen(_sightings(spark, sf), "first_discovered_at", 6))
    return out.select("source_id", "normalized_url", F.unix_micros("first_discovered_at").alias("at_us"))


@query("stream_jobs", "SELECT DISTINCT sha1(concat_ws('|', source_id, nullif(normalized_url, ''))) AS job_id FROM discovered_urls")
def stream_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """Fetch jobs, one for each URL while it is retained."""
    items = _sightings(spark, sf).select("source_id", "normalized_url", "first_discovered_at")
    return _drained(spark, jobs.jobs_of(items, "first_discovered_at", F.col("source_id"), F.col("normalized_url"), keep_hours=24 * 30).select("job_id"))


@query("stream_windows", """WITH m AS (SELECT max(first_discovered_at) - INTERVAL 6 HOUR AS mark FROM discovered_urls), c AS (SELECT time_bucket(INTERVAL 1 HOUR, first_discovered_at) AS b, source_id, count(*) AS sightings FROM discovered_urls GROUP BY 1, 2)
 SELECT epoch_us(b) AS start_us, source_id, sightings FROM c, m WHERE b + INTERVAL 1 HOUR <= mark""")
def stream_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly sightings of each source, of hours the watermark has closed."""
    out = _drained(spark, jobs.windowed_counts(_sightings(spark, sf).select("source_id", "first_discovered_at"), "first_discovered_at"))
    return out.select(F.unix_micros("start").alias("start_us"), "source_id", "sightings")
