"""Ingest of raw records with its checks made on the write.

Records are parsed, parted into good and rejected ones and written in one pass; what the
checks need is observed on the rows as they go by, so nothing is read again. Rejected
records keep their text in a quarantine folder, to be looked at and sent again. In a stream
the same numbers come with every micro-batch, and ``CheckListener`` turns them into
check rows. Checks that need all ids at once (6 and 7) belong to the store, whose
ids are unique, and to sketches.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..functions.sky import coordinate_ok
from ..operators.quality import ERA_SHARE, ERA_START, MJD_TOLERANCE
from ..operators.ranges import tag_contains
from ..schema import ID, LOCI, MJD, conform, empty
from . import storage
from .raw import BAD, flatten_loci, parse_properties

CHECKS = "check_no int, range_label string, name string, status string, observed double, detail string"
Range = tuple[str, float, float]


def _rejected(parsed: DataFrame) -> Column:
    """Malformed records, and those without an id."""
    return F.col(BAD).isNotNull() | F.col(ID).isNull()


def metrics(span: Range, era_start: float = ERA_START, info_tag: str = "in_LSSTDDF") -> list[Column]:
    """What the checks of a range count, over parsed rows with ``_rejected``."""
    _, lo, hi = span
    good, mjd = ~F.col("_rejected"), F.col(MJD)
    ra_ok, dec_ok = coordinate_ok(F.col("ra"), F.col("dec"))
    count = lambda cond: F.count_if(good & cond)
    return [
        F.count_if(F.col("_rejected")).alias("rejected"), F.count_if(good).alias("n"), count(mjd.isNotNull()).alias("n_mjd"),
        count(mjd < lo - MJD_TOLERANCE).alias("below"), count(mjd > hi + MJD_TOLERANCE).alias("above"), count(~ra_ok).alias("bad_ra"), count(~dec_ok).alias("bad_dec"),
        count(mjd < era_start).alias("early"), count(tag_contains(info_tag)).alias("tagged"),
    ]


def check_rows(span: Range, seen: dict[str, int]) -> list[tuple]:
    """Rows of CHECKS from the numbers seen, as ``quality_checks`` has them, and check 0: no record was rejected."""
    label, lo, hi = span
    n = seen["n"]

    def graded(ok: bool, bad: str) -> str:
        return ("PASS" if ok else bad) if n else "SKIP"

    outside = seen["below"] + seen["above"]
    early = seen["early"] / seen["n_mjd"] if seen["n_mjd"] else 0.0
    return [
        (0, label, "well_formed", "PASS" if not seen["rejected"] else "WARN", float(seen["rejected"]), f"{seen['rejected']} rejected"),
        (1, label, "data_present", "PASS" if n else "FAIL", float(n), f"{n} loci"),
        (2, label, "mjd_in_window", graded(not outside, "FAIL"), float(outside), f"{seen['below']} below, {seen['above']} above"),
        (3, label, "ra_valid", graded(not seen["bad_ra"], "WARN"), float(seen["bad_ra"]), f"{seen['bad_ra']} bad"),
        (3, label, "dec_valid", graded(not seen["bad_dec"], "WARN"), float(seen["bad_dec"]), f"{seen['bad_dec']} bad"),
        (4, label, "survey_era", graded(early < ERA_SHARE, "WARN"), early, f"{seen['early']} of {seen['n_mjd']} early"),
        (4, None, "tagged", "INFO", float(seen["tagged"]), f"{seen['tagged']} loci"),
        (8, label, "range_order", "PASS", hi - lo, ""),
    ]


def parted(raw: DataFrame, properties: str) -> DataFrame:
    """Loci of the core schema and further properties, with ``_rejected`` and the record's text where it was rejected. Works on a stream."""
    parsed = parse_properties(raw, properties)
    text = F.coalesce(F.col(BAD), F.to_json(F.struct(*[c for c in raw.columns if c != "properties"])))
    marked = parsed.withColumn("_rejected", _rejected(parsed)).withColumn("_record", F.when(F.col("_rejected"), text))
    return conform(flatten_loci(marked.withColumn(BAD, F.lit(None).cast("string"))), LOCI)


@dataclass(frozen=True)
class Ingested:
    spark: SparkSession
    folder: str
    span: Range
    seen: dict[str, int]

    def loci(self) -> DataFrame:
        return self._part(False).drop("_record")

    def quarantine(self) -> DataFrame:
        """Rejected records: what could be read of them, and their text in ``_record``."""
        return self._part(True)

    def _part(self, rejected: bool) -> DataFrame:
        return self.spark.read.parquet(self.folder).filter(F.col("_rejected") == rejected).drop("_rejected")

    def checks(self) -> DataFrame:
        return self.spark.createDataFrame(check_rows(self.span, self.seen), CHECKS)


def ingest(raw: DataFrame, properties: str, folder: str, span: Range, **options) -> Ingested:
    """Write raw records of one range in one pass; the checks are made of what was seen on the way."""
    seen = Observation()
    columns = metrics(span, **options)
    rows = parted(raw, properties).observe(seen, *columns)
    rows.write.partitionBy("_rejected").parquet(folder)
    names = ["rejected", "n", "n_mjd", "below", "above", "bad_ra", "bad_dec", "early", "tagged"]
    return Ingested(raw.sparkSession, folder, span, {k: storage.observed(seen, k) for k in names})


class CheckListener(StreamingQueryListener):
    """Check rows of each micro-batch of streams whose rows are observed by ``metrics`` under the name of their range."""

    def __init__(self, spans: list[Range]):
        self.spans = {s[0]: s for s in spans}
        self.batches: list[tuple[int, str, dict[str, int]]] = []  # one for each batch, a few numbers each
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        for label, row in event.progress.observedMetrics.items():
            if label in self.spans:
                with self._lock:
                    self.batches.append((event.progress.batchId, label, row.asDict()))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def checks(self, spark: SparkSession) -> DataFrame:
        """Rows of CHECKS with ``batch_id``."""
        with self._lock:
            rows = [(batch, *row) for batch, label, seen in self.batches for row in check_rows(self.spans[label], seen)]
        schema = f"batch_id long, {CHECKS}"
        return spark.createDataFrame(rows, schema) if rows else empty(spark, schema)
