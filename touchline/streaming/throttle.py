"""Keyed throttling with state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from touchline.operators.throttle import accept

#: Session settings: state with a lifetime needs this store, and a query that drains its input and stops must not wait for the
#: lifetimes to end in triggers without data.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
_CHUNK = 8192


class _Sliding(StatefulProcessor):
    """The last accepted times of a key; they expire on their own once a client has been silent long enough."""

    def __init__(self, window_us: int, limit: int, lifetime_ms: int):
        self.window_us, self.limit, self.lifetime_ms = window_us, limit, lifetime_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.log = handle.getValueState("log", "times array<bigint>", ttlDurationMs=self.lifetime_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # two numbers per event of the key and trigger; the events themselves are judged one after the other
        frames = [frame[["t", "o"]].to_numpy(np.int64) for frame in rows]
        events = np.concatenate(frames)
        events = events[np.lexsort((events[:, 1], events[:, 0]))]
        log = list(self.log.get()[0]) if self.log.exists() else []
        for at in range(0, len(events), _CHUNK):
            part = events[at : at + _CHUNK]
            verdicts = [accept(log, int(t), 1, self.window_us, self.limit) == 1 for t in part[:, 0]]
            yield pd.DataFrame({"k": key[0], "t": part[:, 0], "o": part[:, 1], "accepted": verdicts})
        self.log.update((log,))

    def close(self) -> None:
        pass


def throttle_stream(
    events: DataFrame, key: str, time: str, order: str, window_seconds: float, limit: int, lateness_seconds: float = 0.0
) -> DataFrame:
    """M10 on a stream: ``(key, time, order, accepted)`` rows.

    The state of a key is its last accepted times, at most ``limit``. It expires one window (and the ``lateness_seconds`` that
    events may take to arrive) of processing time after the key's last trigger, so silent clients hold no state; a client that
    returns later starts anew, as its times have run out by then. Replaying an old table faster than it was written is safe,
    reading it slower than it was written needs a larger ``lateness_seconds``. Events are judged in time order within a trigger;
    one that arrives after later ones were judged meets the log as it is then. A NULL key is a client of its own, and an event
    without a time is refused. A trigger's events of one key take 16 bytes each in their task: bound triggers at the source
    (``maxFilesPerTrigger``, ``maxBytesPerTrigger``). The session needs ``SETTINGS``.
    """
    window_us = int(window_seconds * 1_000_000)
    asked = events.select(
        F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")).alias("k"),
        F.unix_micros(F.col(time).cast("timestamp")).alias("t"),
        F.col(order).cast("bigint").alias("o"),
    )
    processor = _Sliding(window_us, limit, int((window_seconds + lateness_seconds) * 1000))
    judged = asked.filter("t is not null").groupBy("k").transformWithStateInPandas(
        processor, "k string, t bigint, o bigint, accepted boolean", "append", "ProcessingTime"
    )
    timeless = asked.filter("t is null").withColumn("accepted", F.lit(False))
    return judged.unionByName(timeless).select(
        F.when(F.col("k") != "", F.substring("k", 2, 1 << 30)).alias(key), F.timestamp_micros("t").alias(time),
        F.col("o").alias(order), "accepted",
    )
