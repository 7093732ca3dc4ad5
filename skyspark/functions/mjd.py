"""Modified Julian Dates as columns; sessions' time zones play no part."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400.0
#: MJD of 1970-01-01.
UNIX_EPOCH = 40587.0


def seconds_to_days(seconds: Column) -> Column:
    """F6."""
    return seconds / F.lit(SECONDS_PER_DAY)


def days_to_seconds(days: Column) -> Column:
    """F7."""
    return days * F.lit(SECONDS_PER_DAY)


def mjd_to_date(mjd: Column) -> Column:
    """calendar date of an MJD."""
    return F.date_add(F.lit("1858-11-17").cast("date"), F.floor(mjd).cast("int"))


def timestamp_to_mjd(ts: Column) -> Column:
    """MJD of a timestamp without time zone."""
    local = ts.cast("timestamp_ntz")
    days = F.datediff(local.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = F.hour(local).cast("long") * 3600 + F.minute(local) * 60
    micros = (days * 86400 + seconds) * 1000000 + (F.extract(F.lit("SECOND"), local) * 1000000).cast("long")
    return F.lit(UNIX_EPOCH) + micros / F.lit(86400000000.0)
