"""Loci, alerts and raw records derived from an order and event archive (parquet folders)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.mjd import timestamp_to_mjd
from ..functions.text import join_tags
from ..schema import ALERT_BAND, ALERT_MAG, ID, MAG, MJD, OBS


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _day_fraction(key) -> F.Column:
    return ((key * 7919) % 86400).cast("double") / F.lit(86400.0)


def loci(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as loci: one row each."""
    o, key = table(spark, folder, "orders"), F.col("o_orderkey")
    tags = F.array("o_orderpriority", "o_orderstatus")
    return o.select(
        F.concat(F.lit("L"), key.cast("string")).alias(ID),
        (((key * 7919) % 36000).cast("double") / F.lit(100.0)).alias("ra"),
        (((key * 104729) % 18001).cast("double") / F.lit(100.0) - F.lit(90.0)).alias("dec"),
        join_tags(tags).alias("tags"),
        tags.alias("tags_arr"),
        (timestamp_to_mjd(F.col("o_orderdate")) + _day_fraction(key)).alias(MJD),
        F.when(key % 97 != 0, F.lit(14.0) + F.col("o_totalprice") / F.lit(500000.0) * F.lit(12.0)).alias(MAG),
        (F.col("o_custkey") % 50).cast("int").alias(OBS),
    )


def dirty_loci(spark: SparkSession, folder: str) -> DataFrame:
    """The same with bad coordinates and repeated ids, for the quality suite."""
    found, key = loci(spark, folder), F.substring(ID, 2, 20).cast("long")
    ra = F.when(key % 101 == 0, F.lit(360.0)).when(key % 103 == 0, F.lit(None).cast("double")).otherwise(F.col("ra"))
    dec = F.when(key % 107 == 0, F.lit(91.0)).otherwise(F.col("dec"))
    twice = F.when(key % 109 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return found.withColumns({"ra": ra, "dec": dec}).withColumn("_copy", F.explode(twice)).drop("_copy")


def alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as alerts; several for each locus."""
    li = table(spark, folder, "lineitem")
    return li.select(
        F.concat(F.lit("L"), F.col("l_orderkey").cast("string")).alias(ID),
        (1 + F.col("l_linenumber") % 4).cast("int").alias(ALERT_BAND),
        F.when(F.col("l_partkey") % 53 != 0, F.lit(14.0) + F.col("l_quantity") * F.lit(0.25)).alias(ALERT_MAG),
    )


def from_events(events: DataFrame) -> DataFrame:
    """Events as raw records with repeated ids; works on a stream too."""
    return events.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias(ID),
        timestamp_to_mjd(F.col("ts")).alias(MJD),
        F.col("props").alias("properties"),
        F.array("event_type").alias("tags_arr"),
        F.col("value").alias(MAG),
        F.col("event_id").alias("ingest_seq"),
    )


def raw_records(spark: SparkSession, folder: str) -> DataFrame:
    return from_events(table(spark, folder, "events"))
