"""Streaming Type-2 history: every micro-batch is applied to a ``HistoryStore``.

All versions of a key in a micro-batch are kept, so the table does not depend on how
the rows fall into micro-batches as long as each key's rows arrive in time order; a
retried batch overwrites its own folder, and rows that were applied before change
nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakehold.operators.history_store import HistoryStore


def scd2_foreach_batch(store: HistoryStore):
    """A ``foreachBatch`` function applying each micro-batch."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        store.apply(batch, batch_id)

    return apply


def run_scd2_stream(stream: DataFrame, store: HistoryStore, checkpoint: str, timeout_s: int | None = None) -> None:
    q = (stream.writeStream.foreachBatch(scd2_foreach_batch(store))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.exception():
        raise q.exception()
