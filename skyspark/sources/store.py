"""The cumulative store: one row for each locus, the newest seen.

Rows are hashed by id into buckets; a bucket is a few files, each with a stretch of
observation times. A version is a manifest: bucket, file, rows and least and largest
time of each file. An upsert reads and rewrites the buckets that its rows fall into and
keeps the files of all others, and a read of a range opens the files whose times meet it.

Versions are published through a log (``commits``). Two writers at a time lose no row:
the one that comes second finds the number taken and, if the other changed none of its
buckets, only puts its files into the newer manifest, or else merges again. A write that
fails changes nothing. Three versions are kept, with the files they name.

Upserts may carry a batch name: a batch that one of the last BATCHES upserts named is not
applied again.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import safe_part
from ..operators.dedupe import newest_per_locus, union_all
from ..schema import ID, LOCI, MJD, conform, empty
from . import storage
from .commits import CommitLog

KEEP_VERSIONS, BATCHES = 3, 1_000
#: Buckets of a new store, and rows of a file. 4,096 buckets of eight such files hold 3 * 10**10 loci.
N_BUCKETS, FILE_ROWS = 32, 1_000_000
MANIFEST = "bucket int, file string, rows long, mjd_min double, mjd_max double"


@dataclass(frozen=True)
class UpsertStats:
    old_rows: int
    new_rows: int
    stored_rows: int
    path: str

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.range(1).select(F.lit(self.old_rows).cast("long").alias("old_rows"), F.lit(self.new_rows).cast("long").alias("new_rows"), F.lit(self.stored_rows).cast("long").alias("stored_rows"))


class CumulativeStore:
    """``n_buckets`` holds for a store that is made; an existing one keeps its number."""

    def __init__(self, spark: SparkSession, path: str, null_time: str = "newest", n_buckets: int = N_BUCKETS, file_rows: int = FILE_ROWS):
        self.spark, self.path, self.null_time, self.n_buckets, self.file_rows = spark, path.rstrip("/"), null_time, n_buckets, file_rows
        self.log = CommitLog(spark, f"{self.path}/log")

    # --- reading ---

    def versions(self) -> list[tuple[int, str | None, str]]:
        """(number, batch, manifest folder) of the kept versions, oldest first."""
        entries = [(n, self.log.entry(n)) for n in self.log.numbers()]
        return [(n, e["batch"], f"{self.path}/{e['manifest']}") for n, e in entries]

    def manifest(self, number: int | None = None) -> DataFrame:
        """Files of a version (the newest), with paths below the store's folder."""
        if number is None:
            latest = self.log.latest()
            entry = latest and latest[1]
        else:
            entry = self.log.entry(number)
        return self._manifest_of(entry)

    def _manifest_of(self, entry: dict | None) -> DataFrame:
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/{entry['manifest']}") if entry else empty(self.spark, MANIFEST)

    def _rows(self, entry: dict | None, files: DataFrame) -> DataFrame:
        """Rows of some of a version's files. Their names pass the driver, as those of any table's files do."""
        if entry is None:
            return empty(self.spark, LOCI)
        schema = StructType.fromJson(json.loads(entry["schema"]))
        names = [f"{self.path}/{r.file}" for r in files.select("file").collect()]
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*names)

    def read(self) -> DataFrame:
        """The current version; no rows if there is none yet."""
        latest = self.log.latest()
        entry = latest and latest[1]
        return self._rows(entry, self._manifest_of(entry))

    def read_range(self, lo: float, hi: float, mjd_col: str = MJD) -> DataFrame:
        """Rows with lo <= MJD <= hi, from the files whose times overlap; none if the store or its time column is missing."""
        latest = self.log.latest()
        entry = latest and latest[1]
        files = self._manifest_of(entry)
        if mjd_col == MJD:
            files = files.filter((F.col("mjd_max") >= lo) & (F.col("mjd_min") <= hi))
        current = self._rows(entry, files)
        return current.filter(F.col(mjd_col).between(lo, hi)) if mjd_col in current.columns else current.filter(F.lit(False))

    # --- writing ---

    def upsert(self, new: DataFrame, tie: list[str] | None = None, batch: str | None = None) -> UpsertStats:
        """The newest row of each id of the stored and the new rows; on equal times new rows win, then the ``tie`` columns.

        The new rows are reduced to one for each id (map-side first, so an id may have any
        share of them) and, if there is a store to merge with, written to a folder of this
        upsert; all that follows reads that.
        """
        name = self.spark.range(1).select(safe_part(F.lit(batch))).first()[0] if batch else None
        latest = self.log.latest()
        if name and latest and name in latest[1]["batches"]:
            return UpsertStats(-1, 0, latest[1]["rows"], f"{self.path}/{latest[1]['manifest']}")
        n_buckets = latest[1]["n_buckets"] if latest else self.n_buckets
        ties, counted = [*(tie or []), "_hash"], Observation()
        rows = conform(new, LOCI)
        chosen = newest_per_locus(rows.observe(counted, F.count(F.lit(1)).alias("n")).withColumn("_hash", F.xxhash64(*rows.columns)), ties, self.null_time)
        chosen = chosen.withColumn("_bucket", self._bucket(n_buckets))
        staged = f"{self.path}/staged/{uuid.uuid4().hex}"
        if latest:  # read for its buckets and to be merged; a new store takes it as it is
            chosen.write.parquet(staged)
            chosen = self.spark.read.schema(chosen.schema).parquet(staged)
        merged_on = None
        while True:
            latest = self.log.latest()
            number, entry = latest if latest else (0, None)
            if entry and entry["n_buckets"] != n_buckets:  # another writer has made the store meanwhile
                storage.remove(self.spark, staged)
                return self.upsert(new, tie, batch)
            if name and entry and name in entry["batches"]:
                storage.remove(self.spark, staged)
                return UpsertStats(-1, 0, entry["rows"], f"{self.path}/{entry['manifest']}")
            touched = sorted(r[0] for r in chosen.select("_bucket").distinct().collect()) if entry else []  # at most n_buckets
            if merged_on is None or self._changed_since(merged_on, number, touched):
                schema, rewritten, files = self._merge(entry, chosen, ties, touched, f"data/{uuid.uuid4().hex}")
                merged_on = number
            old = self._manifest_of(entry)
            kept = old.filter(~F.col("bucket").isin(rewritten)) if rewritten else old
            target = f"manifests/{uuid.uuid4().hex}"
            summed = Observation()
            listed = kept.unionByName(files).coalesce(1).observe(summed, F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
            listed.write.parquet(f"{self.path}/{target}")
            total = storage.observed(summed, "rows")
            batches = [*(entry["batches"] if entry else []), *([name] if name else [])][-BATCHES:]
            mine = {"manifest": target, "schema": schema, "n_buckets": n_buckets, "rows": total, "batch": name, "batches": batches, "buckets": rewritten}
            if self.log.commit(number + 1, mine):
                break
        storage.remove(self.spark, staged)
        self._forget()
        return UpsertStats(entry["rows"] if entry else 0, storage.observed(counted, "n"), total, f"{self.path}/{target}")

    @staticmethod
    def _bucket(n_buckets: int) -> Column:
        return F.pmod(F.xxhash64(ID), F.lit(n_buckets)).cast("int")

    def _changed_since(self, base: int, number: int, touched: list[int]) -> bool:
        """Whether a version after ``base`` rewrote one of these buckets, or is no longer kept."""
        kept = set(self.log.numbers())
        return any(n not in kept or set(self.log.entry(n)["buckets"]) & set(touched) for n in range(base + 1, number + 1))

    def _merge(self, entry: dict | None, chosen: DataFrame, ties: list[str], touched: list[int], target: str) -> tuple[str, list[int], DataFrame]:
        """Write the touched buckets anew: (schema, buckets written, their manifest rows). A column whose type changes makes that all buckets."""
        manifest = self._manifest_of(entry)
        incoming = chosen.drop("_hash")
        if entry:
            stored = StructType.fromJson(json.loads(entry["schema"]))
            types = {f.name: f.dataType for f in incoming.schema}
            if any(types.get(f.name, f.dataType) != f.dataType for f in stored):
                touched = sorted({*touched, *(r[0] for r in manifest.select("bucket").distinct().collect())})
        if entry:
            old = self._rows(entry, manifest.filter(F.col("bucket").isin(touched)))
            old = old.withColumns({"_bucket": self._bucket(entry["n_buckets"]), "_source": F.lit(0)})
            both = union_all(old, incoming.withColumn("_source", F.lit(1)))
            columns = [c for c in both.columns if c not in ("_bucket", "_source")]
            # both sides hold an id once, so a bucket's rows may meet in one task
            dealt = both.withColumn("_hash", F.xxhash64(*columns)).repartition("_bucket")
            kept = newest_per_locus(dealt, ["_source", *ties], self.null_time, within=["_bucket"]).select("_bucket", *columns)
        else:
            kept = incoming.repartition("_bucket").select("_bucket", *[c for c in incoming.columns if c != "_bucket"])
        folder = f"{self.path}/{target}"
        sorted_rows = kept.sortWithinPartitions("_bucket", MJD)
        sorted_rows.write.option("maxRecordsPerFile", self.file_rows).partitionBy("_bucket").parquet(folder)
        schema = StructType([f for f in kept.schema if f.name != "_bucket"])
        written = self.spark.read.schema(StructType([*schema.fields, kept.schema["_bucket"]])).parquet(folder)
        # no row crosses a file, so counts are added up where files are read
        file = F.concat(F.lit(f"{target}/"), F.concat_ws("/", F.slice(F.split(F.col("_metadata.file_path"), "/"), -2, 2)))
        files = written.groupBy(F.col("_bucket").cast("int").alias("bucket"), file.alias("file")).agg(F.count("*").alias("rows"), F.min(MJD).alias("mjd_min"), F.max(MJD).alias("mjd_max"))
        return schema.json(), touched, files

    def _forget(self) -> None:
        """Drop versions beyond the newest KEEP_VERSIONS, and the files that no kept version names."""
        numbers = self.log.numbers()
        gone, kept = numbers[:-KEEP_VERSIONS], numbers[-KEEP_VERSIONS:]
        for number in gone:
            entry = self.log.entry(number)
            old, new = self._manifest_of(entry), self.manifest(kept[0])  # a file once left out never returns
            for row in old.select("file").join(new.select("file"), "file", "left_anti").collect():
                storage.remove(self.spark, f"{self.path}/{row.file}")
            storage.remove(self.spark, f"{self.path}/{entry['manifest']}")
            self.log.drop(number)
