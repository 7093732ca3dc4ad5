"""Snapshot sets: several result tables under one key, all or nothing.

A set is written into a folder of its own and becomes the snapshot when the log names
it, so a save that fails or stops between two members leaves the earlier set as it
was, and no set has members of two saves. The set before the newest is kept for those
who still read it; older ones go.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import mjd_part, safe_part
from . import storage
from .commits import CommitLog

KEEP_SETS = 2


def snapshot_key(spark: SparkSession, ranges: list[tuple[str, float, float]], n_samples: int, tag: str | None = None, seed: int | None = None) -> str:
    """A folder name that holds every parameter of the run."""
    parts = [p for label, lo, hi in ranges for p in (safe_part(F.lit(label)), mjd_part(F.lit(float(lo))), mjd_part(F.lit(float(hi))))]
    parts += [F.lit(f"n{n_samples}"), safe_part(F.lit(tag).cast("string")), F.lit(f"s{seed}")]
    return spark.range(1).select(F.concat_ws("__", *parts)).first()[0]


def save_snapshot(folder: str, members: dict[str, DataFrame]) -> None:
    """Write each member once; a member without rows is noted by name and its files are removed."""
    spark = next(iter(members.values())).sparkSession
    log, name = CommitLog(spark, f"{folder}/log"), uuid.uuid4().hex
    empty = []
    for member, df in members.items():
        path = f"{folder}/sets/{name}/{member}"
        df.write.parquet(path)
        if spark.read.schema(df.schema).parquet(path).isEmpty():
            empty.append(member)
            storage.remove(spark, path)
    entry = {"set": name, "empty": empty, "written": [m for m in members if m not in empty]}
    while True:
        numbers = log.numbers()
        if log.commit(numbers[-1] + 1 if numbers else 1, entry):
            break
    for old in log.numbers()[:-KEEP_SETS]:
        storage.remove(spark, f"{folder}/sets/{log.entry(old)['set']}")
        log.drop(old)


def load_snapshot(spark: SparkSession, folder: str, members: dict[str, str], use_cache: bool = True) -> dict[str, DataFrame] | None:
    """All members (name -> schema for an empty one), or None if any was neither written nor noted as empty."""
    latest = CommitLog(spark, f"{folder}/log").latest() if use_cache else None
    if latest is None:
        return None
    entry = latest[1]
    found: dict[str, DataFrame] = {}
    for member, ddl in members.items():
        if member in entry["empty"]:
            found[member] = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(ddl)])
        elif member in entry["written"]:
            found[member] = spark.read.parquet(f"{folder}/sets/{entry['set']}/{member}")
        else:
            return None
    return found
