"""Ordered and seeded limits; each plans as TakeOrderedAndProject."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import ID, MJD
from .ranges import require_valid, window_scan


def newest_first(loci: DataFrame, n: int) -> DataFrame:
    """L1: the n newest, ties by id."""
    return loci.orderBy(F.col(MJD).desc_nulls_last(), ID).limit(n)


def seeded_sample(loci: DataFrame, n: int, seed: int) -> DataFrame:
    """L2: n rows in an order that depends on the seed and the ids alone."""
    return loci.orderBy(F.md5(F.concat_ws("#", F.lit(str(seed)), F.col(ID)).cast("binary")), ID).limit(n)


def first_by_id(loci: DataFrame, n: int) -> DataFrame:
    """L3: the n smallest ids."""
    return loci.orderBy(ID).limit(n)


def sample_ranges(loci: DataFrame, ranges: list[tuple[str, float, float]], n: int, seed: int | None, tag: str | None = None) -> DataFrame:
    """S1 for each valid range, labelled: seeded if a seed is given, else newest first. One limit for each range, so none needs a window over all rows."""

    def one(label: str, lo: float, hi: float) -> DataFrame:
        found = window_scan(loci, lo, hi, tag)
        found = newest_first(found, n) if seed is None else seeded_sample(found, n, seed)
        return found.withColumn("range_label", F.lit(label))

    return reduce(DataFrame.unionByName, [one(*r) for r in require_valid(ranges)])
