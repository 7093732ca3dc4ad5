"""Continuous upsert of arriving loci into a cumulative store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources.store import CumulativeStore


def start_upsert(arriving: DataFrame, store: CumulativeStore, checkpoint: str, source_id: str, tie: list[str] | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None, available_now: bool = True) -> StreamingQuery:
    """Upsert every micro-batch of a streaming frame.

    A batch is named by source and number; one whose version was finished is
    not applied again after a restart. An older observation never replaces a
    newer one, in whatever order they arrive, so no watermark is needed.
    """

    def apply(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            store.upsert(prepare(batch) if prepare else batch, tie, f"{source_id}-{number}")

    writer = arriving.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
