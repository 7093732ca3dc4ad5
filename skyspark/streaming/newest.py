"""Late rows dropped before a store is touched.

A stateful operator holds the newest time of each locus. Of a micro-batch it passes one row
for each locus, the newest, and nothing if a newer one has passed before; so a batch of late
rows rewrites no bucket, and the store's rule is not needed twice. The state is one small value
for each locus, in RocksDB on the executors' disks, with its changes in the checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..schema import ID, MJD
from ..sources.store import CumulativeStore
from .upsert import start_upsert

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class NewestRow(StatefulProcessor):
    """The order is that of ``newest_per_locus``: time, then the ``tie`` columns; a missing time is newest (or oldest)."""

    def __init__(self, tie: list[str], null_time: str = "newest"):
        self.tie, self.missing_first = tie, null_time == "newest"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "missing boolean, mjd double")

    def _time(self, row: Row) -> tuple[bool, float]:
        missing = row[MJD] is None
        return missing == self.missing_first, 0.0 if missing else row[MJD]

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        best = max(rows, key=lambda r: (self._time(r), [(r[c] is not None, *([r[c]] if r[c] is not None else [])) for c in self.tie]))
        time = self._time(best)
        if self.newest.exists() and time < tuple(self.newest.get()):
            return
        self.newest.update(time)  # an equal time passes: the store's tie rule decides
        yield best

    def close(self) -> None:
        pass


def newest_only(arriving: DataFrame, tie: list[str] | None = None, null_time: str = "newest") -> DataFrame:
    """The rows of a streaming frame that are newest for their locus as they arrive; rows without an id are one locus."""
    processor = NewestRow(tie or [], null_time)
    return arriving.groupBy(ID).transformWithState(processor, arriving.schema, "Append", "None").select(*arriving.columns)


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """The state store that stateful processors need; a query keeps what the session says as it starts."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def start_newest_upsert(arriving: DataFrame, store: CumulativeStore, checkpoint: str, source_id: str, tie: list[str] | None = None, available_now: bool = True) -> StreamingQuery:
    """``start_upsert`` of the rows that are not late."""
    with _rocksdb(arriving.sparkSession):
        return start_upsert(newest_only(arriving, tie, store.null_time), store, checkpoint, source_id, tie, None, available_now)
