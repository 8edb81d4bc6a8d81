"""Fetching pages: what is at hand first, the network only where it is asked for."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

FETCHED = "source_id string, url string, http_status int, final_url string, body string, content_type string, started_at timestamp, ms long, from_cache boolean, error string"
# Fixed value: seconds until a request is given up.
TIMEOUT_S = 15


def _get(url: str, agent: str) -> tuple[int, str, str, str | None]:
    """Status, final address, body and content type of a GET request; every status is a result."""
    request = urllib.request.Request(url, headers={"User-Agent": agent})
    try:
        with urllib.request.urlopen(request, timeout=TIMEOUT_S) as r:  # noqa: S310 - only http(s) URLs get here
            return r.status, r.geturl(), r.read().decode(r.headers.get_content_charset() or "utf-8", "replace"), r.headers.get("Content-Type")
    except urllib.error.HTTPError as e:
        return e.code, e.geturl() or url, e.read().decode("utf-8", "replace"), e.headers.get("Content-Type")


def fetch_pages(wanted: DataFrame, stored: DataFrame, live: bool = False, delay_ms: int = 2000, agent: str = "lontar", get: Callable[[str, str], tuple[int, str, str, str | None]] = _get, by_source: int | None = None) -> DataFrame:
    """Pages of wanted (source_id, url) as ``FETCHED``: from ``stored`` (url, body) where they are there, else live, else with an error.

    Without ``live`` nothing leaves the cluster: what isn't stored has the error ``not_stored`` and no status. Live requests of one
    source are made one after the other, ``delay_ms`` apart, in one task of ``by_source`` (sources may share one); a null or foreign
    address has the error ``not_http``, a failed request the name of what failed. Each wanted address is fetched once.
    """
    asked = wanted.select("source_id", "url").distinct()
    have = stored.select(F.col("url").alias("_u"), F.col("body").alias("_b")).dropDuplicates(["_u"])
    both = asked.join(have, F.col("url") == F.col("_u"), "left")
    null = lambda kind: F.lit(None).cast(kind)

    def shaped(df: DataFrame, status: Column, body: Column, cached: bool, error: Column) -> DataFrame:
        return df.select("source_id", "url", status.alias("http_status"), F.col("url").alias("final_url"), body.alias("body"), F.when(body.isNotNull(), "text/html; charset=utf-8").alias("content_type"), null("timestamp").alias("started_at"), null("long").alias("ms"), F.lit(cached).alias("from_cache"), error.alias("error"))

    here = shaped(both.where("_u is not null"), F.lit(200), F.col("_b"), True, null("string"))
    away = both.where("_u is null")
    if not live:
        return here.unionByName(shaped(away, null("int"), null("string"), False, F.lit("not_stored")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: dict[str, float] = {}
        for b in batches:
            out = []
            for source, url in zip(b["source_id"], b["url"]):
                began, at = datetime.now(timezone.utc), time.monotonic()
                if not isinstance(url, str) or not url.lower().startswith(("http://", "https://")):
                    out.append((source, url, None, None, None, None, began, 0, False, "not_http"))
                    continue
                time.sleep(max(0.0, last.get(source, -1e9) + delay_ms / 1000 - at))
                began, at = datetime.now(timezone.utc), time.monotonic()
                try:
                    status, final, body, kind = get(url, agent)
                    row = (status, final, body, kind)
                    error = None
                except Exception as e:  # noqa: BLE001 - a failed request is a result
                    row, error = (None, None, None, None), type(e).__name__
                last[source] = time.monotonic()
                out.append((source, url, *row, began, int((last[source] - at) * 1000), False, error))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in FETCHED.split(", ")])

    queue = away.select("source_id", "url")
    queue = queue.repartition(by_source, "source_id") if by_source else queue.repartition("source_id")
    return here.unionByName(queue.sortWithinPartitions("source_id", "url").mapInPandas(run, FETCHED))
