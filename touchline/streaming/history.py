"""Type-2 history fed by a stream of standings batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from touchline.operators.ranking import latest_per_key
from touchline.plans.history import scd2_changes
from touchline.sources.tables import HistoryTable, VersionTaken

ATTEMPTS = 5


def history_table(spark: SparkSession, path: str, current: DataFrame, keys: Sequence[str], check_cols: Sequence[str]) -> HistoryTable:
    """The history of tables shaped like ``current``, kept below ``path``."""
    types = dict(current.dtypes)
    columns = [f"`{c}` {types[c]}" for c in (*keys, *check_cols)]
    return HistoryTable(spark, path, ", ".join([*columns, "valid_from timestamp", "valid_to timestamp"]))


def apply_batch(
    table: HistoryTable, batch: DataFrame, stream: str, batch_id: int, keys: Sequence[str], check_cols: Sequence[str], run_ts: Column
) -> bool:
    """One history run for one batch of the named stream; a batch that this stream has already committed is skipped.

    The run reads and rewrites open versions only. Where another writer commits first, the run is repeated on its result.
    """
    if not stream:
        raise ValueError("a stream needs an id, batch numbers alone are not unique")
    label = f"{stream}-batch-{batch_id}"
    for attempt in range(ATTEMPTS):
        if table.has(label):
            return False
        base = table.latest_version()
        try:
            table.commit(base, scd2_changes(table.open_rows(base), batch, keys, check_cols, run_ts), label)
            return True
        except VersionTaken:
            if attempt == ATTEMPTS - 1:
                raise
    return False


def start_history(
    standings: DataFrame, table: HistoryTable, keys: Sequence[str], check_cols: Sequence[str], loaded_at: str,
    checkpoint: str, run_ts: Callable[[DataFrame], Column] = lambda batch: F.current_timestamp(),
) -> StreamingQuery:
    """Keep the history of a streamed standings table: the newest row per key of each batch counts.

    ``run_ts`` gives a batch's moment of change, by default the time of the run.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        # batch numbers start again with each new checkpoint, whose metadata names it
        stream = batch.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"]
        order = [F.col(loaded_at).desc(), *[F.col(c).asc_nulls_last() for c in check_cols]]
        apply_batch(table, latest_per_key(batch, keys, order), stream, batch_id, keys, check_cols, run_ts(batch))

    return (
        standings.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
