"""Counts at the finest level of a plan, kept beside a store and added to by night.

Planning a range needs the number of rows in each small piece of time, not the rows. A
piece is 1 / PIECES of a day. Every batch adds its counts by piece as a file of its own;
counts of a piece are added up when they are read, and ``compact`` writes them as one. All
plans whose windows are whole pieces (roots of whole days, halved) derive from them, and
planning reads the pieces of its range alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import MJD, empty
from . import storage
from .commits import CommitLog

#: Pieces of a day: halving a day DEPTH times gives windows of 5.3 s.
DEPTH = 14
PIECES = 1 << DEPTH
_COUNTS = "day long, piece int, n long"


class CountTable:
    """A log entry lists the files that count, so a batch is added whole or not at all, and once for its name."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, f"{self.path}/log")

    def add(self, rows: DataFrame, batch: str | None = None) -> bool:
        """Add the rows' counts; rows without a time are in no piece. False if the batch is known already."""
        at = F.col(MJD) - F.floor(MJD)
        piece = F.least(F.floor(at * PIECES), F.lit(PIECES - 1)).cast("int")
        counted = rows.filter(F.col(MJD).isNotNull()).groupBy(F.floor(MJD).cast("long").alias("day"), piece.alias("piece")).agg(F.count("*").alias("n"))
        return self._commit(counted, lambda files, new: [*files, new], batch)

    def compact(self) -> None:
        """Write the counts as one file."""
        latest = self.log.latest()
        if latest:
            seen = latest[1]["files"]
            self._commit(self._read(seen), lambda files, new: [new, *[f for f in files if f not in seen]], None)

    def _commit(self, counts: DataFrame, change, batch: str | None) -> bool:
        path = storage.new_name("counts")
        counts.coalesce(1).sortWithinPartitions("day", "piece").write.parquet(f"{self.path}/{path}")
        while True:
            number, entry = self.log.latest() or (0, {"files": [], "batches": []})
            if batch is not None and batch in entry["batches"]:
                storage.remove(self.spark, f"{self.path}/{path}")
                return False
            batches = entry["batches"] if batch is None else [*entry["batches"], batch]
            if self.log.commit(number + 1, {"files": change(entry["files"], path), "batches": batches}):
                if number > 1:
                    self.log.drop(number - 1)
                return True

    def _read(self, files: list[str]) -> DataFrame:
        if not files:
            return empty(self.spark, _COUNTS)
        return self.spark.read.schema(_COUNTS).parquet(*[f"{self.path}/{f}" for f in files]).groupBy("day", "piece").agg(F.sum("n").alias("n"))

    def read(self, first_day: int | None = None, last_day: int | None = None) -> DataFrame:
        """day, piece and n, of the days asked for (both ends included)."""
        latest = self.log.latest()
        counts = self._read(latest[1]["files"] if latest else [])
        if first_day is not None:
            counts = counts.filter(F.col("day") >= first_day)
        return counts if last_day is None else counts.filter(F.col("day") <= last_day)
