"""Sliding-window rates of keys on a stream, with state for each bucket of keys.

An event waits in its bucket's state until the watermark has passed its time, so that what arrives late, or out of order
within the allowed delay, is counted where it belongs. A timer of the bucket then gives out all events that are due, each
with the number of events of its key in the window that ends with it, and keeps the events that a later one can still
see. When the last of those has left the window, a second timer clears the bucket. State is thus bounded by the events in
delay plus window. Keys are dealt into buckets by a hash, as a call of the state costs as much for one event as for
thousands: what arrives in a batch is one entry, an Arrow stream.

Defined results: the same as the window over a whole table; events with equal times count each other; rows with a null
key are one key; rows with a null time, or later than the allowed delay, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DataType, LongType, StructField, StructType

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _packed(rows: pa.Table) -> tuple[bytes]:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows)
    return (sink.getvalue().to_pybytes(),)


def _unpacked(value: tuple) -> pa.Table:
    return pa.ipc.open_stream(bytes(value[0])).read_all()


def window_counts(keys: pa.ChunkedArray, at: np.ndarray, span: int) -> np.ndarray:
    """For each row the rows of its key with a time from ``span`` before its own up to its own."""
    codes = keys.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
    times = np.unique(np.concatenate([at, at - span]))  # places instead of times, so that key and time fit into one number
    base, last, first = codes * len(times), np.searchsorted(times, at), np.searchsorted(times, at - span)
    ordered = np.sort(base + last)
    return np.searchsorted(ordered, base + last, "right") - np.searchsorted(ordered, base + first, "left")


class WindowCounts(StatefulProcessor):
    """Rows (bucket, no_key, key, no_event, event, at_us) in; (event, key, in_window) out when the watermark has passed the time."""

    def __init__(self, seconds: int, key: str, event: str, kinds: tuple[DataType, DataType]):
        self.span, self.names, self.kinds = seconds * 1_000_000, [event, key, "in_window"], kinds

    def init(self, handle: StatefulProcessorHandle) -> None:
        from pyspark.sql.pandas.types import to_arrow_type

        self.handle = handle
        self.schema = pa.schema([("key", to_arrow_type(self.kinds[0])), ("event", to_arrow_type(self.kinds[1])), ("at", pa.int64())])
        self.waiting = handle.getListState("waiting", "rows binary")
        self.recent = handle.getValueState("recent", "rows binary")
        self.next = handle.getValueState("next", "at bigint")  # of the earliest timer that counts

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [
            pa.table([pa.array(p["key"], self.schema.types[0], mask=p["no_key"].to_numpy(bool)), pa.array(p["event"], self.schema.types[1], mask=p["no_event"].to_numpy(bool)), pa.array(p["at_us"], pa.int64())], schema=self.schema)
            for p in rows
            if len(p)
        ]
        if parts:
            arrived = pa.concat_tables(parts).combine_chunks()
            self.waiting.appendValue(_packed(arrived))
            self._wake(int(arrived["at"].to_numpy().min()))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        if not self.next.exists() or self.next.get()[0] > watermark:
            return  # an older timer, whose events have been given out
        passed = watermark * 1000
        none = self.schema.empty_table()
        waiting = pa.concat_tables([none, *map(_unpacked, self.waiting.get())])
        before = _unpacked(self.recent.get()) if self.recent.exists() else none
        at = waiting["at"].to_numpy()
        due, rest = waiting.filter(pa.array(at < passed)), waiting.filter(pa.array(at >= passed))
        seen = pa.concat_tables([before, due])  # what was given out before is older
        times = seen["at"].to_numpy()
        kept = seen.filter(pa.array(times >= passed - self.span))
        if len(due):
            self.waiting.clear()
            if len(rest):
                self.waiting.appendValue(_packed(rest))
        if len(kept):
            self.recent.update(_packed(kept))
        elif self.recent.exists():
            self.recent.clear()
        self.next.clear()
        if len(rest):
            self._wake(int(rest["at"].to_numpy().min()))
        elif len(kept):
            self._wake(int(kept["at"].to_numpy().max()) + self.span)
        if len(due):
            counts = window_counts(seen["key"], times, self.span)[len(before) :]
            yield pd.DataFrame(dict(zip(self.names, [_series(due["event"]), _series(due["key"]), pd.Series(counts)], strict=True)))

    def _wake(self, at: int) -> None:
        """A timer for the first millisecond with everything up to ``at`` (microseconds) before it, unless an earlier one is set."""
        due = at // 1000 + 1
        if not self.next.exists() or due < self.next.get()[0]:
            self.handle.registerTimer(due)
            self.next.update((due,))

    def close(self) -> None:
        pass


def _series(values: pa.ChunkedArray) -> pd.Series:
    """Beside a null, pandas would make floats of whole numbers."""
    return pd.Series(values.to_pylist(), dtype=object) if values.null_count else values.to_pandas()


def use_rocks(spark: SparkSession) -> None:
    """State with timers is kept by RocksDB; to be set before the query starts."""
    spark.conf.set(PROVIDER, ROCKS)


def stream_window_counts(events: DataFrame, *, by: str, time: str, event: str, seconds: int, late: str = "0 seconds", buckets: int = 256) -> DataFrame:
    """(event, key, in_window) of a stream: events of the same key in the ``seconds`` up to and including each event.

    The keys are dealt into ``buckets``; a bucket's events in delay plus window should fit into a task's memory.
    """
    fields = events.schema

    def solid(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0).cast(fields[name].dataType))

    # beside a null, pandas makes floats of all whole numbers of a batch, which holds many keys: so a null goes as a flag
    marked = events.where(F.col(time).isNotNull()).select(
        F.pmod(F.xxhash64(by), F.lit(buckets)).alias("bucket"), F.col(by).isNull().alias("no_key"), solid(by).alias("key"), F.col(event).isNull().alias("no_event"), solid(event).alias("event"),
        F.unix_micros(F.col(time).cast("timestamp")).alias("at_us"), F.col(time).cast("timestamp").alias("at_time"),
    ).withWatermark("at_time", late)
    schema = StructType([fields[event], fields[by], StructField("in_window", LongType())])
    processor = WindowCounts(seconds, by, event, (fields[by].dataType, fields[event].dataType))
    return marked.groupBy("bucket").transformWithStateInPandas(processor, schema, outputMode="Append", timeMode="EventTime")


def stream_violations(events: DataFrame, *, by: str, time: str, event: str, limit: int, seconds: int, late: str = "0 seconds", buckets: int = 256) -> DataFrame:
    """Events beyond ``limit`` in the sliding window of their key."""
    return stream_window_counts(events, by=by, time=time, event=event, seconds=seconds, late=late, buckets=buckets).where(F.col("in_window") > limit)
