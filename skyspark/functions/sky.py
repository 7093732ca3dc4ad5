"""Sky coordinates and equal-width bins."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def wrapped_radians(degrees: Column) -> Column:
    """radians in [-pi, pi]; exactly pi stays."""
    r = F.radians(degrees)
    return F.when(r > F.lit(math.pi), r - F.lit(2 * math.pi)).otherwise(r)


def bin_index(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Bin of a value in ``bins`` equal bins over [lo, hi], the last one closed."""
    return F.least(F.floor((value - lo) / (hi - lo) * F.lit(float(bins))).cast("int"), F.lit(bins - 1))


def bin_edge(index: Column, lo: Column, hi: Column, bins: int) -> Column:
    """lower edge of a bin."""
    return lo + index * (hi - lo) / F.lit(float(bins))


def coordinate_ok(ra: Column, dec: Column) -> tuple[Column, Column]:
    """0 <= RA < 360 and -90 <= Dec <= 90; a missing coordinate is bad."""
    false = F.lit(False)
    return F.coalesce((ra >= 0) & (ra < 360), false), F.coalesce(dec.between(-90, 90), false)
