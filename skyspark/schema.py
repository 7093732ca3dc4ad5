"""Core schemas, and the one place where NaN becomes NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID = "locus_id"
MJD = "newest_alert_observation_time"
MAG = "brightest_alert_magnitude"
OBS = "num_mag_values"
ALERT_BAND = "ztf_fid"
ALERT_MAG = "ztf_magpsf"

LOCI = f"{ID} string, ra double, dec double, tags string, tags_arr array<string>, {MJD} double, {MAG} double, {OBS} int"
ALERTS = f"{ID} string, range_label string, {ALERT_BAND} int, {ALERT_MAG} double"
#: Band ids and names.
BANDS = {1: "g", 2: "r", 3: "i"}


def _fields(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Every NaN in a double or float column becomes NULL."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in doubles})


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Cast the core columns, add absent ones as typed NULL, keep extras; NaN becomes NULL."""
    core = _fields(ddl)
    have = set(df.columns)
    columns = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in core]
    return nan_to_null(df.select(*columns, *[c for c in df.columns if c not in core.names]))


def present(df: DataFrame, ddl: str) -> frozenset[str]:
    """Core columns that the input really has: "absent" and "all NULL" differ in quality check 5."""
    return frozenset(_fields(ddl).names) & frozenset(df.columns)


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    """No rows, but the schema."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in _fields(ddl)])


def bands(spark: SparkSession) -> DataFrame:
    """The band dimension (D10), three rows."""
    rows = F.array(*[F.struct(F.lit(k).alias(ALERT_BAND), F.lit(v).alias("band")) for k, v in BANDS.items()])
    return spark.range(1).select(F.inline(rows))
