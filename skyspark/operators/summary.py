"""Summaries of a range, and overlap of two."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import ALERT_BAND, ALERT_MAG, ID, MAG, MJD, OBS
from ..sources.storage import written
from .alerts import with_band
from .dedupe import union_all
from .selection import ACCURACY, bracket, exact_medians


#: Metrics of loci, and the columns that they are taken from.
EXTENTS = {"ra": "ra", "dec": "dec"}
MEDIANS = {"mjd": MJD, "mag": MAG, "obs": OBS}


def range_summary(loci: DataFrame, alerts: DataFrame, approximate: bool = False) -> DataFrame:
    """range_label, metric, value.

    Either input is written once with the columns needed and aggregated in one pass, the
    alerts by range and by range and band together. Medians are exact and interpolated:
    that pass brackets them by sketches, and ``exact_medians`` counts and ranks around
    the middle; ``approximate`` takes them from the sketches. Metrics without a value
    are left out, as is a range without loci.
    """
    n_columns = len([c for c in loci.columns if c != "range_label"])
    loci = written(loci.select("range_label", *[F.col(c).cast("double").alias(name) for name, c in (EXTENTS | MEDIANS).items()]), "summary-loci")
    alerts = written(alerts.select("range_label", ALERT_BAND, F.col(ALERT_MAG).cast("double").alias("alert_mag")), "summary-alerts")
    ends = (lambda c: F.array(F.percentile_approx(c, 0.5, ACCURACY))) if approximate else (lambda c: bracket(F.col(c)))
    of = lambda c: [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    middle = lambda c: F.struct(F.count(c).alias("n"), ends(c).alias("ends")).alias(f"_{c}")
    by_locus = loci.groupBy("range_label").agg(
        F.count("*").cast("double").alias("loci"), F.lit(float(n_columns)).alias("columns"), *[m for c in (*EXTENTS, *MEDIANS) for m in of(c)], *[middle(c) for c in MEDIANS]
    )
    sets = [[F.col("range_label"), F.col(ALERT_BAND)], [F.col("range_label")]]
    total = F.grouping_id("range_label", ALERT_BAND).alias("_level")
    by_alert = alerts.groupingSets(sets, "range_label", ALERT_BAND).agg(total, F.count("*").alias("n"), *of("alert_mag"), middle("alert_mag"))
    by_locus, by_alert = written(by_locus, "summary"), written(by_alert, "summary")  # a row for each range and band
    by_band = with_band(by_alert.filter("_level = 0").filter(F.col(ALERT_BAND).isNotNull()).select("range_label", ALERT_BAND, "n"))
    by_band = by_band.select("range_label", F.concat(F.lit("alerts_"), "band").alias("metric"), F.col("n").cast("double").alias("value"))
    by_range = by_alert.filter("_level > 0").drop(ALERT_BAND, "_level").withColumn("alerts", F.col("n").cast("double")).drop("n")
    wide = [(by_locus, [*MEDIANS]), (by_range, ["alert_mag"])]
    sketched = union_all(*[d.select("range_label", F.lit(c).alias("metric"), f"_{c}.*") for d, names in wide for c in names])
    if approximate:
        medians = sketched.select("range_label", "metric", F.col("ends")[0].cast("double").alias("median")).filter(F.col("median").isNotNull())
    else:
        long = loci.select("range_label", *MEDIANS).unpivot("range_label", [*MEDIANS], "metric", "value")
        values = long.unionByName(alerts.select("range_label", F.lit("alert_mag").alias("metric"), F.col("alert_mag").alias("value"))).filter(F.col("value").isNotNull())
        medians = exact_medians(values, sketched, ["range_label", "metric"])
    medians = medians.select("range_label", F.concat("metric", F.lit("_median")).alias("metric"), F.col("median").alias("value"))
    return union_all(*[_tidy(d.drop(*[f"_{c}" for c in names])) for d, names in wide], by_band, medians)


def _tidy(wide: DataFrame) -> DataFrame:
    metrics = [c for c in wide.columns if c != "range_label"]
    return wide.unpivot("range_label", metrics, "metric", "value").filter(F.col("value").isNotNull())


def range_overlap(first: DataFrame, second: DataFrame) -> DataFrame:
    """One row with the numbers of distinct ids, shared ids and their per cent of the smaller set (0 if one is empty).

    One shuffle of both id sets: an id is shared if both sides list it.
    """
    sides = first.select(ID, F.lit(True).alias("first")).unionByName(second.select(ID, F.lit(False).alias("first")))
    return shared_ids(sides)


def shared_ids(sides: DataFrame) -> DataFrame:
    """The same for one frame of ids with a boolean ``first``."""
    by_id = sides.groupBy(ID).agg(F.bool_or("first").alias("one"), F.bool_or(~F.col("first")).alias("two"))
    counted = by_id.agg(F.count_if("one").alias("n1"), F.count_if("two").alias("n2"), F.count_if(F.col("one") & F.col("two")).alias("n_shared"))
    return counted.withColumn("pct", F.coalesce(F.try_divide(F.col("n_shared"), F.least("n1", "n2")) * 100, F.lit(0.0)))
