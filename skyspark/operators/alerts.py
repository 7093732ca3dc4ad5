"""Alerts of loci, and the band dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import ALERT_BAND, ID, bands


#: Loci up to which a sample of known size is sent to every task rather than shuffled with the alerts.
BROADCAST_LOCI = 500_000


def alerts_for(loci: DataFrame, alerts: DataFrame, at_most: int | None = None) -> DataFrame:
    """Alerts of the loci with the loci's range label. Loci without alerts drop out; a locus listed twice gives its alerts twice.

    ``at_most`` is a bound on the loci that the caller knows, such as a sample's
    size. A bound of no more than BROADCAST_LOCI lets the alerts, the large side,
    stay where they are; otherwise both sides are shuffled.
    """
    ids = loci.select(ID, "range_label")
    if at_most is not None and at_most <= BROADCAST_LOCI:
        ids = F.broadcast(ids)
    return alerts.drop("range_label").join(ids, ID)


def with_band(df: DataFrame, known_only: bool = False) -> DataFrame:
    """Band names; an unknown id is shown as itself, or its rows drop out. The dimension has three rows."""
    named = df.join(F.broadcast(bands(df.sparkSession)), ALERT_BAND, "inner" if known_only else "left")
    return named if known_only else named.withColumn("band", F.coalesce("band", F.col(ALERT_BAND).cast("string")))


def band_counts(alerts: DataFrame) -> DataFrame:
    """Alerts by range and band, missing ids left out."""
    counted = alerts.filter(F.col(ALERT_BAND).isNotNull()).groupBy("range_label", ALERT_BAND).agg(F.count("*").alias("n"))
    return with_band(counted)
