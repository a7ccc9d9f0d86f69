"""Sliding-log throttling over a whole event table.

An event is accepted when fewer than ``limit`` accepted events of its key lie within the window before it; refused events leave
no trace. The verdict depends on earlier verdicts, so a window count cannot express it, and one sequential pass per key would
put a hot key into one task.

Each key's time line is cut into slices at least one window long, so that a slice needs nothing of the past but the last
``limit`` accepted times of the slice before it. A *run* is a chain of neighbouring slices; a slice without events between two
others means a pause in which every time expires, so runs are independent of each other. All slices are first scanned in
parallel from an empty past. Slices whose real past turned out different are then scanned again in blocks: of two neighbouring
slices in the first round, of twice as many in every further one. Within a block the times are handed from slice to slice, and a
scan ends where it meets the past that a slice was scanned with before. After round r every block of 2^r slices agrees with
itself, so a run of n slices is settled after log2(n) + 1 rounds even if it never pauses; mostly the slices agree after one or two.

Between rounds travel slice ends only: at most ``limit`` times each. A block is a sorted stream with constant memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.lineage import cut_lineage
from touchline.operators.ranking import topk_per_key

_VERDICTS = "k string, t bigint, taken int"
_ENDS = "k string, slice bigint, start bigint, past array<bigint>, tail array<bigint>"


def accept(log: list[int], t: int, n: int, window_us: int, limit: int) -> int:
    """How many of ``n`` events at time ``t`` pass; ``log`` holds the accepted times and follows."""
    while log and t - log[0] > window_us:
        log.pop(0)
    free = min(n, limit - len(log))
    log.extend([t] * free)
    return free


def _verdicts(window_us: int, limit: int):
    """Rows sorted by (key, slice, time), each slice with its past, to the number of events that pass."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, log = None, []
        for batch in batches:
            taken = []
            for k, s, t, n, past in zip(batch["k"], batch["slice"], batch["t"], batch["n"], batch["past"]):
                if (k, s) != current:
                    current, log = (k, s), [] if past is None else list(past)
                taken.append(accept(log, t, n, window_us, limit))
            yield pd.DataFrame({"k": batch["k"], "t": batch["t"], "taken": taken})

    return run


def _block_ends(window_us: int, limit: int):
    """Rows sorted by (key, run, block, slice, time) to the new ends of the slices scanned.

    A block starts at its first stale slice. ``real`` is the past a stale slice should have had, ``past`` the one that every slice
    was scanned with; where both meet, the slices that follow stand, up to the next stale one.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, current, start, entered, log, scanning = None, None, None, None, [], False
        columns = ["k", "slice", "start", "past", "tail"]
        for batch in batches:
            ended = []
            names = ("k", "run", "block", "slice", "t", "n", "stale", "real", "past")
            for k, r, b, s, t, n, stale, real, past in zip(*(batch[c] for c in names)):
                if (k, s) != current:
                    if scanning:
                        ended.append((*current, start, entered or None, log))
                    if (k, r, b) == block and scanning:
                        log = [x for x in log if t - x <= window_us]
                        scanning = log != ([] if past is None else list(past))
                    elif stale:
                        log, scanning = [] if real is None else list(real), True
                    else:
                        scanning = False
                    block, current, start, entered = (k, r, b), (k, s), t, list(log)
                if scanning:
                    accept(log, t, n, window_us, limit)
            yield pd.DataFrame(ended, columns=columns)
        if scanning:
            yield pd.DataFrame([(*current, start, entered or None, log)], columns=columns)

    return run


def _live(past: Column, start: Column, window_us: int) -> Column:
    kept = F.filter(past, lambda t: start - t <= window_us)
    return F.when(F.size(kept) > 0, kept)


def _scan_blocks(grains: DataFrame, slices: DataFrame, window_us: int, limit: int) -> DataFrame:
    """New ends of the ``slices`` (k, run, block, slice, stale, real, past)."""
    rows = grains.join(slices, ["k", "slice"]).select("k", "run", "block", "slice", "t", "n", "stale", "real", "past")
    parts = rows.repartition("k", "run", "block").sortWithinPartitions("k", "run", "block", "slice", "t")
    return parts.mapInPandas(_block_ends(window_us, limit), _ENDS)


def settle_slices(grains: DataFrame, window_us: int, limit: int) -> tuple[DataFrame, int]:
    """The accepted times each ``(k, slice)`` inherits, as ``(k, slice, past)``, and the number of rounds after the first scan."""
    none = F.lit(None).cast("array<bigint>")
    by_slice = Window.partitionBy("k").orderBy("slice")
    begins = F.when(~F.lag("slice").over(by_slice).eqNullSafe(F.col("slice") - 1), F.col("slice"))
    places = grains.select("k", "slice").distinct().withColumn("begins", begins)
    places = cut_lineage(places.select("k", "slice", F.max("begins").over(by_slice).alias("run")))
    alone = places.select("k", "run", F.lit(0).cast("bigint").alias("block"), "slice", F.lit(True).alias("stale"), none.alias("real"), none.alias("past"))
    state = cut_lineage(_scan_blocks(grains, alone.withColumn("block", F.col("slice")), window_us, limit))
    rounds = 0
    while True:
        before = state.select("k", (F.col("slice") + 1).alias("slice"), F.col("tail").alias("inherited"))
        real = _live(F.col("inherited"), F.col("start"), window_us)
        judged = state.join(before, ["k", "slice"], "left").withColumn("real", real)
        stale = cut_lineage(judged.filter(~F.col("past").eqNullSafe(F.col("real"))).select("k", "slice", "real"))
        if stale.isEmpty():
            return state.select("k", "slice", "past"), rounds
        rounds += 1
        blocked = places.withColumn("block", F.floor((F.col("slice") - F.col("run")) / F.lit(1 << rounds)))
        first = stale.join(blocked, ["k", "slice"]).groupBy("k", "run", "block").agg(F.min("slice").alias("first"))
        again = (
            blocked.join(first, ["k", "run", "block"]).filter(F.col("slice") >= F.col("first"))
            .join(stale.withColumn("stale", F.lit(True)), ["k", "slice"], "left")
            .join(state.select("k", "slice", "past"), ["k", "slice"])
            .select("k", "run", "block", "slice", F.coalesce("stale", F.lit(False)).alias("stale"), "real", "past")
        )
        ends = cut_lineage(_scan_blocks(grains, again, window_us, limit))
        state = cut_lineage(state.join(ends, ["k", "slice"], "left_anti").unionByName(ends))


def throttle(
    events: DataFrame,
    key: str,
    time: str,
    order: str,
    window_seconds: float,
    limit: int,
    windows_per_slice: int = 16,
) -> DataFrame:
    """Every event with ``accepted``; ``order`` is unique among events of one key and instant.

    A NULL key is a client of its own, an event without a time is refused.
    """
    window_us = int(window_seconds * 1_000_000)
    tagged = events.withColumns({
        "k": F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")),
        "t": F.unix_micros(F.col(time).cast("timestamp")),
    }).withColumn("slice", F.floor(F.col("t") / F.lit(window_us * windows_per_slice)))
    timed = tagged.filter(F.col("t").isNotNull())
    grains = cut_lineage(
        timed.groupBy("k", "slice", "t").agg(F.least(F.count(F.lit(1)), F.lit(limit)).alias("n"))
    )
    pasts, _ = settle_slices(grains, window_us, limit)
    inherited = grains.join(pasts, ["k", "slice"]).select("k", "slice", "t", "n", "past")
    sliced = inherited.repartition("k", "slice").sortWithinPartitions("k", "slice", "t")
    taken = sliced.mapInPandas(_verdicts(window_us, limit), _VERDICTS).filter("taken > 0")
    # within one instant the first `taken` events pass: the order value of the last of them decides
    first = topk_per_key(timed.select("k", "t", F.col(order).alias("o")), ["k", "t"], [F.col("o").asc()], limit)
    cutoff = first.join(taken, ["k", "t"]).filter("rank <= taken").groupBy("k", "t").agg(F.max("o").alias("o"))
    accepted = F.coalesce(tagged[order] <= cutoff["o"], F.lit(False)).alias("accepted")
    return tagged.join(cutoff, ["k", "t"], "left").select(*[tagged[c] for c in events.columns], accepted)
