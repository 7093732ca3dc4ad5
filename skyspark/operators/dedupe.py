"""Newest row per locus, and unions that keep all columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import ID, MJD


def newest_per_locus(df: DataFrame, tie: list[str], null_time: str = "newest", id_col: str = ID, mjd_col: str = MJD, within: list[str] | None = None) -> DataFrame:
    """One row for each id, the one with the latest time; ties by the ``tie`` columns, largest first.

    A missing time counts as newest (or, on request, as oldest); missing ids
    are one id. Without the time column the ties decide, without the id column
    the rows stay as they are.
    """
    if null_time not in ("newest", "oldest"):
        raise ValueError("null_time is 'newest' or 'oldest'")
    if id_col not in df.columns:
        return df
    order = [F.col(c).desc_nulls_last() for c in tie]
    if mjd_col in df.columns:
        order.insert(0, F.col(mjd_col).desc_nulls_first() if null_time == "newest" else F.col(mjd_col).desc_nulls_last())
    rank = F.row_number().over(Window.partitionBy(*(within or []), id_col).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows of all frames, columns of any, those of the first frame first."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
