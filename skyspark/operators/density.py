"""The data of the plots: sky density, magnitude histograms, all-sky points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sky import bin_edge, bin_index, wrapped_radians
from ..schema import ALERT_BAND, ALERT_MAG, ID, MAG, bands


def all_sky_points(loci: DataFrame) -> DataFrame:
    """Wrapped coordinates in radians of the loci that have both."""
    both = loci.dropna(how="any", subset=["ra", "dec"])
    return both.select(ID, "range_label", wrapped_radians(F.col("ra")).alias("ra_rad"), F.radians("dec").alias("dec_rad"))


def sky_density(loci: DataFrame, bins: int = 80, bounds: DataFrame | None = None) -> DataFrame:
    """Loci in a grid over each range's own extent: range_label, bx, by, n and the range's size.

    ``bounds`` (range_label, x0, x1, y0, y1) saves the pass that finds the
    extents; it has one row for each range, so it is broadcast.
    """
    both = loci.dropna(how="any", subset=["ra", "dec"]).select("range_label", "ra", "dec")
    if bounds is None:
        found = both.groupBy("range_label").agg(F.min("ra").alias("x0"), F.max("ra").alias("x1"), F.min("dec").alias("y0"), F.max("dec").alias("y1"), F.count("*").alias("n_range"))
    else:
        found = bounds.join(both.groupBy("range_label").agg(F.count("*").alias("n_range")), "range_label")

    def spread(lo: str, hi: str) -> tuple:
        flat = F.col(lo) == F.col(hi)  # as numpy does: half a unit to either side
        return F.when(flat, F.col(lo) - 0.5).otherwise(F.col(lo)), F.when(flat, F.col(hi) + 0.5).otherwise(F.col(hi))

    (x0, x1), (y0, y1) = spread("x0", "x1"), spread("y0", "y1")
    found = found.select("range_label", "n_range", x0.alias("x0"), x1.alias("x1"), y0.alias("y0"), y1.alias("y1"))
    placed = both.join(F.broadcast(found), "range_label")
    bx, by = bin_index(F.col("ra"), F.col("x0"), F.col("x1"), bins), bin_index(F.col("dec"), F.col("y0"), F.col("y1"), bins)
    return placed.groupBy("range_label", "n_range", bx.alias("bx"), by.alias("by")).agg(F.count("*").alias("n"))


def magnitude_histogram(alerts: DataFrame, lo: float = 15.0, hi: float = 25.0, bins: int = 40) -> DataFrame:
    """Alerts in equal bins over [lo, hi] for each range and known band; empty bins are listed with 0."""
    low, high = F.lit(float(lo)), F.lit(float(hi))
    inside = alerts.filter(F.col(ALERT_MAG).between(lo, hi)).join(F.broadcast(bands(alerts.sparkSession)), ALERT_BAND)
    counted = inside.groupBy("range_label", "band", bin_index(F.col(ALERT_MAG), low, high, bins).alias("bin")).agg(F.count("*").alias("n"))
    return _all_bins(counted, ["range_label", "band"], low, high, bins)


def fallback_histogram(loci: DataFrame, lo: float = 15.0, hi: float = 25.0, bins: int = 40) -> DataFrame:
    """The same over the loci's brightest magnitudes, one series for each range."""
    low, high = F.lit(float(lo)), F.lit(float(hi))
    counted = loci.filter(F.col(MAG).between(lo, hi)).groupBy("range_label", bin_index(F.col(MAG), low, high, bins).alias("bin")).agg(F.count("*").alias("n"))
    return _all_bins(counted, ["range_label"], low, high, bins)


def magnitude_series(loci: DataFrame, alerts: DataFrame, lo: float = 15.0, hi: float = 25.0, bins: int = 40) -> DataFrame:
    """G11, or G12 if no range has an alert or the alerts have no magnitude column.

    As in the survey's own plots, alerts whose magnitudes are all missing still count as
    alerts: their histogram is empty, and the loci's don't stand in for it. The choice is part of the
    plan; nothing is run here, and the alerts are gone through once.
    """
    low, high = F.lit(float(lo)), F.lit(float(hi))
    instead = fallback_histogram(loci, lo, hi, bins).withColumn("band", F.lit(None).cast("string"))
    if ALERT_MAG not in alerts.columns:
        return instead
    bin_ = F.when(F.col(ALERT_MAG).between(lo, hi), bin_index(F.col(ALERT_MAG), low, high, bins))
    counted = alerts.groupBy("range_label", ALERT_BAND, bin_.alias("bin")).agg(F.count("*").alias("n"))
    inside = counted.filter(F.col("bin").isNotNull()).join(F.broadcast(bands(alerts.sparkSession)), ALERT_BAND)
    found = _all_bins(inside.select("range_label", "band", "bin", "n"), ["range_label", "band"], low, high, bins)
    none = counted.agg(F.count("*").alias("_groups")).filter("_groups = 0")  # one row or none
    return found.unionByName(instead.join(F.broadcast(none)).drop("_groups").select(found.columns))


def _all_bins(counted: DataFrame, series: list[str], low, high, bins: int) -> DataFrame:
    """Every bin of each series that has a row, with its lower edge and the series' size."""
    by_series = counted.groupBy(*series).agg(F.sum("n").alias("n_series"), F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("counts"))  # at most ``bins`` entries
    filled = by_series.select(*series, "n_series", "counts", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    n = F.coalesce(F.try_element_at("counts", F.col("bin")), F.lit(0).cast("long"))
    return filled.select(*series, "bin", bin_edge(F.col("bin"), low, high, bins).alias("edge"), n.alias("n"), "n_series")
