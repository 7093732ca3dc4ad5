"""Tables kept in buckets of the locus id, so that loci and alerts join where they lie.

The alerts are by far the larger table. Bucketed once, when they arrive, they are read by
every later join in the partitions they have, and only the loci asked for are shuffled to
them, or nothing if those are bucketed alike. A hot locus makes its bucket large; as a locus
has at most some thousand alerts, buckets of many loci even out.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..schema import ID

BUCKETS = 64


def save_bucketed(df: DataFrame, table: str, buckets: int = BUCKETS) -> DataFrame:
    """Write ``df`` as a table in buckets of the locus id, sorted within, and return it. Tables to be joined take one number of buckets."""
    df.repartition(buckets, ID).write.bucketBy(buckets, ID).sortBy(ID).mode("overwrite").saveAsTable(table)  # one file for each bucket
    return df.sparkSession.table(table)


def new_table(spark: SparkSession, name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:12]}"
