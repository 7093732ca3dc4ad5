"""Time ranges, windows and tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import MJD


def ranges_frame(spark: SparkSession, ranges: list[tuple[str, float, float]]) -> DataFrame:
    """range_no, label, mjd_min, mjd_max and valid (P14: mjd_min <= mjd_max), numbered from 1."""
    rows = [F.struct(F.lit(i).alias("range_no"), F.lit(label).alias("label"), F.lit(float(lo)).alias("mjd_min"), F.lit(float(hi)).alias("mjd_max")) for i, (label, lo, hi) in enumerate(ranges, 1)]
    return spark.range(1).select(F.inline(F.array(*rows))).withColumn("valid", F.col("mjd_min") <= F.col("mjd_max"))


def require_valid(ranges: list[tuple[str, float, float]]) -> list[tuple[str, float, float]]:
    """The valid ranges; it is an error if none is."""
    valid = [r for r in ranges if r[1] <= r[2]]
    if not valid:
        raise ValueError("no range has mjd_min <= mjd_max")
    return valid


def in_window(col: Column, lo: float, hi: float, include_upper: bool = True) -> Column:
    """Closed window, or half-open without its upper end; NULL is outside."""
    return col.between(lo, hi) if include_upper else (col >= lo) & (col < hi)


def window_scan(loci: DataFrame, lo: float, hi: float, tag: str | None = None, include_upper: bool = True) -> DataFrame:
    """S1 without its limit: time window and tag, both pushed to the scan where the source can."""
    if lo > hi:
        return loci.filter(F.lit(False))
    found = loci.filter(in_window(F.col(MJD), lo, hi, include_upper))
    return has_tag(found, tag)


def has_tag(loci: DataFrame, tag: str | None) -> DataFrame:
    """Exact membership; None and '' do not filter."""
    return loci.filter(F.array_contains("tags_arr", tag)) if tag else loci


def tag_contains(text: str) -> Column:
    """P5: substring of the joined tags; missing tags are no match."""
    return F.coalesce(F.col("tags").contains(text), F.lit(False))


def label_ranges(loci: DataFrame, ranges: list[tuple[str, float, float]], spark: SparkSession | None = None) -> DataFrame:
    """One row for each range a locus lies in (both, on a shared bound), with ``range_label``.

    The range table has a handful of rows given by the caller, so it is
    broadcast; the outer bounds are added as a plain filter for the scan.
    """
    valid = require_valid(ranges)
    frame = ranges_frame(spark or loci.sparkSession, valid).select(F.col("label").alias("range_label"), "mjd_min", "mjd_max")
    outer = loci.filter(F.col(MJD).between(float(min(r[1] for r in valid)), float(max(r[2] for r in valid))))
    joined = outer.drop("range_label").join(F.broadcast(frame), F.col(MJD).between(F.col("mjd_min"), F.col("mjd_max")))
    return joined.drop("mjd_min", "mjd_max")


def range_report(ranges: DataFrame) -> DataFrame:
    """Spans, validity and how many later-numbered ranges each one overlaps in more than a bound."""
    a, b = ranges.alias("a"), ranges.alias("b")
    meet = (F.col("a.range_no") < F.col("b.range_no")) & F.col("a.valid") & F.col("b.valid") & (F.col("a.mjd_min") < F.col("b.mjd_max")) & (F.col("b.mjd_min") < F.col("a.mjd_max"))
    joined = a.join(F.broadcast(b), meet, "left")  # the caller's few ranges
    keys = ["range_no", "label", "mjd_min", "mjd_max", "valid"]
    counted = joined.groupBy(*[F.col(f"a.{k}").alias(k) for k in keys]).agg(F.count("b.range_no").alias("n_overlaps"))
    return counted.withColumn("span_days", F.col("mjd_max") - F.col("mjd_min"))
