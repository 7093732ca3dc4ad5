"""Distinct counts by mergeable sketches, for when exact ones cost a shuffle of all ids.

A sketch is made once for each night, while the night's rows are at hand, and kept in a
small table. The ids of any set of nights are then estimated by merging, and those that
two sets share by comparing their union with the two; no locus is read again. With
2**LG_K registers the relative standard error is about 0.02, and small sets are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import ID, MJD

LG_K = 12
#: Error that an estimate keeps to in all but very few cases: four standard deviations.
BOUND = 4 * 1.04 / (1 << LG_K) ** 0.5


def nightly_sketches(loci: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """night (whole MJD; null for a missing time), n and the sketch of the night's ids. Sketches are merged map-side, so a night of any size is no hot key. Missing ids are not counted."""
    night = F.floor(MJD).cast("long").alias("night")
    return loci.groupBy(night).agg(F.count("*").alias("n"), F.hll_sketch_agg(ID, lg_k).alias("sketch"))


def distinct_in(sketches: DataFrame, ranges: DataFrame) -> DataFrame:
    """range_label, n, n_distinct and n_duplicates (estimates) for ranges (range_label, first_night, last_night, both within)."""
    inside = sketches.join(F.broadcast(ranges), F.col("night").between(F.col("first_night"), F.col("last_night")))  # the caller's few ranges
    merged = inside.groupBy("range_label").agg(F.sum("n").alias("n"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))
    return merged.withColumn("n_duplicates", F.greatest(F.col("n") - F.col("n_distinct"), F.lit(0).cast("long")))


def overlap_of(sketches: DataFrame, first: tuple[int, int], second: tuple[int, int]) -> DataFrame:
    """n1, n2, n_shared and pct as ``range_overlap`` has them, estimated, for two sets of nights (first, last). The error of n_shared is that of the union, not of itself."""
    one, two = (F.col("night").between(*nights) for nights in (first, second))
    estimate = lambda cond: F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(F.when(cond, F.col("sketch")))), F.lit(0).cast("long"))
    counted = sketches.filter(one | two).agg(estimate(one).alias("n1"), estimate(two).alias("n2"), estimate(one | two).alias("n_union"))
    shared = F.greatest(F.col("n1") + F.col("n2") - F.col("n_union"), F.lit(0).cast("long")).alias("n_shared")
    return counted.select("n1", "n2", shared).withColumn("pct", F.coalesce(F.try_divide(F.col("n_shared"), F.least("n1", "n2")) * 100, F.lit(0.0)))
