"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import new_folder

#: The ASCII white space the contracts name: blank, tab, \n, \v, \f, \r.
ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A side that does not grow with the corpus (a benchmark, a table of shards) is
#: broadcast when it was counted and has no more than this many narrow rows.
BROADCAST_ROWS = 500_000
#: A key is hot beyond HOT_ROWS rows, and beyond this share of all rows: so there are never more hot keys than HOT_KEYS.
HOT_ROWS = 1_000
HOT_KEYS = 100_000


def materialize(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage at files that outlive any executor, and lets several
    consumers read a result that was computed once.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000, keep: dict | None = None) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that what is made of one stays small; at the end the worker gives its memory back, but for the cache ``keep``."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)
    release_memory(keep)


#: Caches of this worker process that are emptied at the end of a task.
CACHES: list[dict] = []


def release_memory(keep: dict | None = None) -> None:
    """Empty the caches (but ``keep``, which the next task of the operator needs) and give freed memory back to the system.

    Workers live on after a task, and what they keep counts against the executor
    while other operators run in the JVM. Small objects that a cache keeps would
    hold whole arenas of freed ones.
    """
    for cache in CACHES:
        if cache is not keep:
            cache.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def small_side(df: DataFrame, rows: int | None = None, limit: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows are within ``limit``, else unchanged (a shuffle join).

    For sides made from small inputs. What grows with the corpus joins by
    shuffle at every size, so that plans and their costs stay the same.
    """
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= (BROADCAST_ROWS if limit is None else limit) else df


def salted_join(left: DataFrame, right: DataFrame, on: list[str], spread: list[str], how: str = "inner", counts: DataFrame | None = None) -> DataFrame:
    """Shuffle join in which a hot key of ``left`` is dealt to several tasks by the ``spread`` columns.

    ``left`` must be written out already, as it is counted first; ``right`` has few
    rows for each key, and those of a hot key are copied to each of its tasks.
    The counts are added up map-side. A key is hot beyond max(HOT_ROWS, rows /
    HOT_KEYS) rows, so the table of hot keys, which is broadcast, has no more
    than HOT_KEYS rows at any size. ``how``: inner or left. ``counts``: the keys with
    their rows ``_n`` in ``left``, where the caller has counted them.
    """
    most = max(HOT_ROWS, left.count() // HOT_KEYS)
    hot = (left.groupBy(*on).agg(F.count("*").alias("_n")) if counts is None else counts).filter(F.col("_n") > most)
    hot = F.broadcast(materialize(hot.select(*on, F.ceil(F.col("_n") / F.lit(most)).cast("long").alias("_groups")), "hot-keys"))
    one = F.lit(1).cast("long")
    without = reduce(Column.__or__, (F.col(c).isNull() for c in on))  # joins nothing, so it may go anywhere
    groups = F.when(without, F.lit(HOT_ROWS).cast("long")).otherwise(F.coalesce("_groups", one))
    dealt = left.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread), groups)).drop("_groups")
    copied = right.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(one - 1, F.coalesce("_groups", one) - 1))).drop("_groups")
    return dealt.join(copied, [*on, "_salt"], how).drop("_salt")


def fresh(name: str, columns: list[str]) -> str:
    """``name``, or a longer one that clashes with no column."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def join_small(left: DataFrame, right: DataFrame, on: list[str], spread: list[str]) -> DataFrame:
    """Join with a side that does not grow with the corpus: broadcast where it is counted and small, else ``salted_join``."""
    if right.count() <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), on)
    return salted_join(materialize(left, "large-side"), right, on, spread)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written in decimal, modulo ``modulus`` (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "stars") -> DataFrame:
    """(node, label) with the smallest node reachable, for every node with an edge.

    Large-star and small-star steps alternate until every node hangs on the
    smallest of its component. Each round is a few shuffles of narrow rows and
    is written to the shared folder; only two numbers per round reach the driver.
    """
    cur = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    cur = materialize(cur, name)
    mark = None
    while True:
        state = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == mark or not state[0]:
            return cur.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(cur.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        mark = state
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        cur = materialize(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), name)
