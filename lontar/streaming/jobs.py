"""The stages as streaming queries: seen-URL state, queue hand-offs, sliding re-aggregation."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lontar.config import WINDOWS
from lontar.functions.text import job_id
from lontar.operators.upsert import discovered_batch, upsert_discovered


def stream_of(spark: SparkSession, path: str, like: DataFrame, files_per_trigger: int = 8) -> DataFrame:
    """A folder of Parquet files as a stream, with the schema of ``like``."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def as_event_time(df: DataFrame, column: str) -> DataFrame:
    """The column as a moment with time zone, which watermarks need."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def first_sightings(items: DataFrame, moment: str, hours: int) -> DataFrame:
    """Items whose URL wasn't seen within the last hours; state is bounded by the watermark, late items within it still count."""
    return as_event_time(items, moment).withWatermark(moment, f"{hours} hours").dropDuplicatesWithinWatermark(["source_id", "normalized_url"])


def unseen(items: DataFrame, moment: str, hours: int) -> DataFrame:
    """Sightings (source_id, normalized_url, moment) of URLs that weren't seen within the hours before them.

    Every sighting renews the retention, so the state of a URL is its last sighting; it expires when the watermark has passed that by
    the hours. Sightings of a batch are taken in their order; one that comes after a later one of its URL is no news.
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        at = np.sort(pd.concat([f["_us"] for f in frames]).dropna().astype("int64").to_numpy())
        if not len(at):
            return
        last = state.get[0] if state.exists else None
        fresh = np.diff(at, prepend=at[0] - span if last is None else last) >= span
        end = int(max(at[-1], last or at[-1]))
        state.update((end,))
        state.setTimeoutTimestamp(max((end + span) // 1000, state.getCurrentWatermarkMs() + 1))
        if fresh.any():
            yield pd.DataFrame({"source_id": key[0], "normalized_url": key[1], "_us": at[fresh]})

    span = hours * 3_600_000_000
    rows = as_event_time(items, moment).select("source_id", "normalized_url", moment, F.unix_micros(moment).alias("_us")).withWatermark(moment, f"{hours} hours")
    out = rows.groupBy("source_id", "normalized_url").applyInPandasWithState(run, "source_id string, normalized_url string, _us long", "last long", "append", GroupStateTimeout.EventTimeTimeout)
    return out.select("source_id", "normalized_url", F.timestamp_micros("_us").alias(moment))


def stop_within(query: StreamingQuery, seconds: float = 30) -> bool:
    """Let a query finish what it is at, for so many seconds at most, and stop it; whether it finished."""
    end = time.monotonic() + seconds
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < end:
        time.sleep(0.1)
    done = not (query.isActive and query.status["isTriggerActive"])
    query.stop()
    return done


def jobs_of(items: DataFrame, moment: str, *key: Column, keep_hours: int = 1) -> DataFrame:
    """Work items with their job id, one of a kind while it is retained."""
    return as_event_time(items, moment).withColumn("job_id", job_id(*key)).withWatermark(moment, f"{keep_hours} hours").dropDuplicatesWithinWatermark(["job_id"])


def windowed_counts(items: DataFrame, moment: str, length: str = "1 hour", slide: str | None = None, late: str = "6 hours") -> DataFrame:
    """Sightings of each source by sliding or tumbling window, late ones admitted for a while."""
    w = F.window(moment, length, slide) if slide else F.window(moment, length)
    return as_event_time(items, moment).withWatermark(moment, late).groupBy(w.alias("w"), "source_id").agg(F.count("*").alias("sightings")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "source_id", "sightings")


def merge_discovered(stream: DataFrame, folder: str, checkpoint: str, drain: bool = True) -> StreamingQuery:
    """Merge a stream of sightings into a stored table, batch by batch: versions of the table are folders, the newest is current."""

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = discovered_batch(batch)
        if number > 0:
            new = upsert_discovered(spark.read.parquet(f"{folder}/version={number - 1}"), new)
        new.write.mode("overwrite").parquet(f"{folder}/version={number}")

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer.trigger(processingTime="15 minutes")).start()


def reaggregate(stream: DataFrame, run: Callable[[DataFrame, int], None], articles: Callable[[], DataFrame], checkpoint: str, windows: tuple[int, ...] = WINDOWS) -> StreamingQuery:
    """On new articles run the clustering anew for every trailing window over what is stored."""

    def apply(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        for hours in windows:
            run(articles(), hours)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drain(df: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a streaming frame over what is there, into a table of this session, and return that table. For tests and small results."""
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def drain_to(df: DataFrame, folder: str, checkpoint: str) -> DataFrame:
    """Run an append-mode streaming frame over what is there, into Parquet files, and read them."""
    q = df.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(folder)
