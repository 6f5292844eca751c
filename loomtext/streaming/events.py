"""Streaming forms over an event table (event_id, ts, user_id, event_type, value) and over arriving files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.operators.relational import sessions, tumbling


def windowed(events: DataFrame, *, width: str = "1 hour", slide: str | None = None, late: str = "2 hours") -> DataFrame:
    """Count and sum of values by window and type; rows later than the watermark are dropped on a stream."""
    marked = events.withWatermark("ts", late) if events.isStreaming else events
    return tumbling(marked, time="ts", width=width, slide=slide, by=["event_type"], aggregates={"n": F.count("*"), "total": F.sum("value")})


def session_counts(events: DataFrame, *, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    marked = events.withWatermark("ts", late) if events.isStreaming else events
    return sessions(marked, by="user_id", time="ts", gap=gap)


def deduplicated(events: DataFrame, *, late: str = "2 hours") -> DataFrame:
    """Each event once."""
    if events.isStreaming:
        return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])
    return events.dropDuplicates(["event_id"])


def start(df: DataFrame, path: str, checkpoint: str, *, mode: str = "append", available_now: bool = True):
    """Write a stream to parquet; restarts go on where the checkpoint stands."""
    writer = df.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def each_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str):
    """Hand every micro-batch with its number to a function; the number makes commits idempotent."""
    return df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def progress(discovered: DataFrame, downloaded: DataFrame, failed: DataFrame) -> DataFrame:
    """(url, state): downloaded over failed over discovered."""
    tag = lambda df, state, rank: df.select("url", F.lit(state).alias("state"), F.lit(rank).alias("r"))
    every = tag(discovered, "discovered", 2).unionByName(tag(failed, "failed", 1)).unionByName(tag(downloaded, "downloaded", 0))
    return every.groupBy("url").agg(F.min_by("state", "r").alias("state"))


def remaining(states: DataFrame, incomplete: DataFrame, limit: int | None = None) -> DataFrame:
    """Addresses to fetch: not downloaded, or incomplete; in order, up to a limit."""
    todo = states.where("state <> 'downloaded'").select("url").unionByName(incomplete.select("url")).distinct().orderBy("url")
    return todo if limit is None else todo.limit(limit)
