"""The data-quality suite (V1-V9): a table of checks, one aggregation for each input."""

from __future__ import annotations

from collections.abc import Set

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sky import coordinate_ok
from ..schema import ALERT_MAG, ID, MJD
from .ranges import tag_contains
from .summary import shared_ids

#: Tolerance of the window check in days, first day of the survey's era, greatest share before it.
MJD_TOLERANCE = 0.02
ERA_START = 60200.0
ERA_SHARE = 0.05
MAG_SHARE = 0.5
#: Per cent of shared ids from which disjoint ranges give a warning and a failure.
OVERLAP_WARN, OVERLAP_FAIL = 5.0, 20.0


def _check(no: int, name: str, status: Column, observed: Column, detail: Column) -> Column:
    return F.struct(F.lit(no).alias("check_no"), F.lit(name).alias("name"), status.alias("status"), observed.cast("double").alias("observed"), detail.alias("detail"))


def _share(part: Column, whole: Column) -> Column:
    """0.0 of nothing."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def quality_checks(
    loci: DataFrame,
    alerts: DataFrame,
    ranges: DataFrame,
    mag_min: float = 15.0,
    mag_max: float = 25.0,
    loci_columns: Set[str] = frozenset((ID, MJD)),
    alert_columns: Set[str] = frozenset((ALERT_MAG,)),
    era_start: float = ERA_START,
    info_tag: str = "in_LSSTDDF",
) -> DataFrame:
    """check_no, range_label, name, status (PASS, WARN, FAIL, SKIP, INFO), observed, detail.

    ``loci`` and ``alerts`` carry ``range_label``; ``ranges`` has range_no,
    label, mjd_min, mjd_max and valid for a handful of ranges. The column sets
    say which columns the inputs really had. ``info_tag`` is counted over all
    ranges together (U3).
    """
    bounds = ranges.select(F.col("label").alias("range_label"), "range_no", "mjd_min", "mjd_max", "valid")
    ra_ok, dec_ok = coordinate_ok(F.col("ra"), F.col("dec"))
    mjd = F.col(MJD)
    placed = loci.join(F.broadcast(bounds.select("range_label", "mjd_min", "mjd_max")), "range_label")
    by_range = placed.groupBy("range_label").agg(
        F.count("*").alias("n"),
        F.count(MJD).alias("n_mjd"),
        F.count_if(mjd < F.col("mjd_min") - MJD_TOLERANCE).alias("below"),
        F.count_if(mjd > F.col("mjd_max") + MJD_TOLERANCE).alias("above"),
        F.count_if(~ra_ok).alias("bad_ra"),
        F.count_if(~dec_ok).alias("bad_dec"),
        F.count_if(mjd < era_start).alias("early"),
        (F.count("*") - F.countDistinct(ID)).alias("duplicates"),
        F.count_if(tag_contains(info_tag)).alias("tagged"),
    )
    by_alert = alerts.groupBy("range_label").agg(F.count("*").alias("n_alerts"), F.count(ALERT_MAG).alias("n_mag"), F.count_if(F.col(ALERT_MAG).between(mag_min, mag_max)).alias("in_window"))
    zero = F.lit(0).cast("long")
    counts = ["n", "n_mjd", "below", "above", "bad_ra", "bad_dec", "early", "duplicates", "n_alerts", "n_mag", "in_window"]
    wide = bounds.join(by_range, "range_label", "left").join(by_alert, "range_label", "left").withColumns({c: F.coalesce(c, zero) for c in counts})
    valid, some = F.col("valid"), F.col("n") > 0

    def graded(applies: Column, ok: Column, bad: str) -> Column:
        return F.when(~applies, "SKIP").when(ok, "PASS").otherwise(bad)

    has_mjd, has_id, has_mag = F.lit(MJD in loci_columns), F.lit(ID in loci_columns), F.lit(ALERT_MAG in alert_columns)
    early, bright = _share(F.col("early"), F.col("n_mjd")), _share(F.col("in_window"), F.col("n_mag"))
    number = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    checks = F.array(
        _check(1, "data_present", graded(valid, some, "FAIL"), F.col("n"), number(F.col("n"), " loci")),
        _check(2, "mjd_in_window", graded(valid & some & has_mjd, (F.col("below") == 0) & (F.col("above") == 0), "FAIL"), F.col("below") + F.col("above"), number(F.col("below"), " below, ", F.col("above"), " above")),
        _check(3, "ra_valid", graded(valid & some, F.col("bad_ra") == 0, "WARN"), F.col("bad_ra"), number(F.col("bad_ra"), " bad")),
        _check(3, "dec_valid", graded(valid & some, F.col("bad_dec") == 0, "WARN"), F.col("bad_dec"), number(F.col("bad_dec"), " bad")),
        _check(4, "survey_era", graded(valid & some & has_mjd, early < ERA_SHARE, "WARN"), early, number(F.col("early"), " of ", F.col("n_mjd"), " early")),
        _check(5, "magnitudes", F.when(~valid, "SKIP").when((F.col("n_alerts") == 0) | ~has_mag, "WARN").when(bright >= MAG_SHARE, "PASS").otherwise("FAIL"), bright, number(F.col("in_window"), " of ", F.col("n_mag"), " in window")),
        _check(6, "unique_ids", graded(valid & some & has_id, F.col("duplicates") == 0, "WARN"), F.col("duplicates"), number(F.col("duplicates"), " duplicates")),
        _check(8, "range_order", F.when((F.col("mjd_min") > F.col("mjd_max")) & valid, "FAIL").otherwise("PASS"), F.col("mjd_max") - F.col("mjd_min"), F.lit("")),
    )
    each = wide.select("range_label", F.inline(checks))
    both = by_range.agg(F.coalesce(F.sum("tagged"), zero).alias("tagged"))
    tagged = both.select(F.lit(None).cast("string").alias("range_label"), F.inline(F.array(_check(4, "tagged", F.lit("INFO"), F.col("tagged"), number(F.col("tagged"), " loci")))))
    return each.unionByName(tagged).unionByName(_overlap_checks(loci, ranges)).select("check_no", "range_label", "name", "status", "observed", "detail")


def _overlap_checks(loci: DataFrame, ranges: DataFrame) -> DataFrame:
    """V7 for the ranges numbered 1 and 2."""
    one, two = (ranges.filter(F.col("range_no") == k).select(F.col("label").alias(f"l{k}"), F.col("mjd_min").alias(f"lo{k}"), F.col("mjd_max").alias(f"hi{k}")) for k in (1, 2))
    pair = one.join(F.broadcast(two))  # one row
    labelled = loci.join(F.broadcast(pair), F.col("range_label").isin(F.col("l1"), F.col("l2"))).select(ID, (F.col("range_label") == F.col("l1")).alias("first"))
    shared = shared_ids(labelled)
    row = pair.join(F.broadcast(shared))
    disjoint = (F.col("lo1") >= F.col("hi2")) | (F.col("lo2") >= F.col("hi1"))
    known = (F.col("n1") > 0) & (F.col("n2") > 0)
    pct = F.col("pct")
    status = F.when(~known | ~disjoint, "INFO").when(pct < OVERLAP_WARN, "PASS").when(pct < OVERLAP_FAIL, "WARN").otherwise("FAIL")
    inside = (F.col("lo1") >= F.col("lo2")) & (F.col("hi1") <= F.col("hi2"))
    detail = F.when(~known, "a range is empty").when(disjoint, "disjoint ranges").when(inside, "range 1 lies in range 2").otherwise("ranges overlap")
    return row.select(F.lit(None).cast("string").alias("range_label"), F.inline(F.array(_check(7, "shared_ids", F.lit("INFO"), F.col("n_shared"), F.lit("")), _check(7, "overlap", status, pct, detail))))


def verdict(checks: DataFrame) -> DataFrame:
    """V9: checks by status."""
    return checks.groupBy("status").agg(F.count("*").alias("n"))
