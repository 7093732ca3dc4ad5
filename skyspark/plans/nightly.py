"""The sampled comparison and the complete nightly ingest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.alerts import alerts_for
from ..operators.chunks import adaptive_pull
from ..operators.density import magnitude_series, sky_density
from ..operators.quality import quality_checks
from ..operators.ranges import ranges_frame, require_valid
from ..operators.sample import sample_ranges
from ..operators.summary import range_summary
from ..sources.store import CumulativeStore, UpsertStats

Range = tuple[str, float, float]


@dataclass(frozen=True)
class Comparison:
    """Lazy frames of one comparison of ranges."""

    loci: DataFrame
    alerts: DataFrame
    ranges: list[Range]

    def summary(self) -> DataFrame:
        return range_summary(self.loci, self.alerts)

    def density(self) -> DataFrame:
        return sky_density(self.loci)

    def magnitudes(self) -> DataFrame:
        return magnitude_series(self.loci, self.alerts)

    def checks(self) -> DataFrame:
        return quality_checks(self.loci, self.alerts, ranges_frame(self.loci.sparkSession, self.ranges))


def sampled_comparison(loci: DataFrame, alerts: DataFrame, ranges: list[Range], n: int, seed: int | None, tag: str | None = None) -> Comparison:
    """A sample of each range and its alerts."""
    require_valid(ranges)
    sample = sample_ranges(loci, ranges, n, seed, tag)
    return Comparison(sample, alerts_for(sample, alerts, n * len(ranges)), ranges)


def nightly_ingest(loci: DataFrame, alerts: DataFrame, store: CumulativeStore, night: Range, history: Range, tie: list[str], **plan) -> tuple[Comparison, DataFrame, UpsertStats]:
    """All loci of the night against the stored history, which is read before the night is added to it.

    The comparison's frames are made from files of the version read, which
    stays until three later ones are written.
    """
    new, report = adaptive_pull(loci, night[0], night[1], night[2], tie, **plan)
    past = store.read_range(history[1], history[2])
    both = new.withColumn("range_label", F.lit(night[0])).unionByName(past.withColumn("range_label", F.lit(history[0])), allowMissingColumns=True)
    stats = store.upsert(new, tie)
    return Comparison(both, alerts_for(both, alerts), [night, history]), report, stats
