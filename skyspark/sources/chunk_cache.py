"""Rows of finished chunks of a range.

A write puts the rows of many chunks into one folder, sorted by chunk, and appends to
the manifest one row for each chunk and file: chunk key, bounds, status, rows of the
chunk, and name, length and rows of the file. The manifest is parted by label and tag, so
a pull reads its own part of it and, of the rows, the files of its own chunks.

A chunk counts as cached if its files are there with the length noted and their footers
give the rows noted; no row is read for that. So an unreadable, cut-off or missing file
makes its chunks misses, and a write that stopped halfway noted nothing. An
empty chunk is noted without a file and is a hit without rows. The newest note of a chunk
counts.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.dedupe import union_all
from ..schema import empty
from . import storage

PARTS = ["label_key", "tag_key", "chunk_key"]
BOUNDS = ["mjd_min", "mjd_max", "include_upper"]
_NOTE = "chunk_key string, mjd_min double, mjd_max double, include_upper boolean, status string, n long, file string, file_bytes long, file_rows long, file_chunk_rows long, row_schema string, seq long"
_MANIFEST = f"{_NOTE}, label_key string, tag_key string"


class ChunkCache:
    """``packed=False`` writes one folder for each chunk, as for few and large chunks."""

    def __init__(self, spark: SparkSession, path: str, packed: bool = True):
        self.spark, self.path, self.packed = spark, path.rstrip("/"), packed

    # --- writing ---

    def write(self, rows: DataFrame, chunks: DataFrame | None = None) -> None:
        """Replace the chunks that the rows (with the key columns) belong to; other chunks stay.

        ``chunks``: all chunks meant, with the key columns and, where they are known, bounds
        and status. Those without rows are noted as empty.
        Rows are computed once and rebalanced, so a hot chunk is written by several tasks.
        """
        rows = rows.withColumns({c: F.col(c).cast("string") for c in PARTS})
        folder = f"rows/{uuid.uuid4().hex}"
        dealt = rows.hint("rebalance", *([] if self.packed else PARTS)).sortWithinPartitions(*PARTS)
        (dealt.write if self.packed else dealt.write.partitionBy(*PARTS)).parquet(f"{self.path}/{folder}")
        values = StructType([f for f in rows.schema.fields if f.name not in PARTS])
        written = self._read_files([f"{self.path}/{folder}"], rows.schema)
        # where the files end differs from run to run, so they are asked and not the plan
        found = written.groupBy(*PARTS, _file_name(folder).alias("file"), F.col("_metadata.file_size").alias("file_bytes")).agg(F.count("*").alias("file_chunk_rows"))
        by_file, by_chunk = Window.partitionBy("file"), Window.partitionBy(*PARTS)
        found = found.withColumns({"file_rows": F.sum("file_chunk_rows").over(by_file), "n": F.sum("file_chunk_rows").over(by_chunk)})
        if chunks is None:
            notes = found
        else:
            notes = chunks.select(*PARTS, *[c for c in (*BOUNDS, "status") if c in chunks.columns]).join(found, PARTS, "left")
        for name, kind in (("mjd_min", "double"), ("mjd_max", "double"), ("include_upper", "boolean"), ("status", "string")):
            notes = notes if name in notes.columns else notes.withColumn(name, F.lit(None).cast(kind))
        notes = notes.withColumns({"n": F.coalesce("n", F.lit(0).cast("long")), "status": F.coalesce("status", F.lit("accepted")), "row_schema": F.lit(values.json()), "seq": F.lit(time.time_ns())})
        # one narrow row for each chunk and file, in one file for each label and tag, which is there whole or not at all
        notes.select(*StructType.fromDDL(_MANIFEST).names).repartition(1).write.partitionBy("label_key", "tag_key").mode("append").parquet(f"{self.path}/manifest")

    def _read_files(self, files: list[str], schema: StructType, skip: bool = False) -> DataFrame:
        reader = self.spark.read.schema(schema).option("ignoreCorruptFiles", str(skip).lower()).option("ignoreMissingFiles", str(skip).lower())
        return reader.parquet(*files)

    # --- reading ---

    def _manifest(self, label_key: str | None = None, tag_key: str | None = None) -> DataFrame | None:
        """The newest notes of each chunk, of one label and tag if they are given; None if nothing was cached."""
        if not storage.children(self.spark, f"{self.path}/manifest"):
            return None
        notes = self.spark.read.schema(_MANIFEST).option("ignoreCorruptFiles", "true").parquet(f"{self.path}/manifest")
        if label_key is not None:
            notes = notes.filter((F.col("label_key") == label_key) & (F.col("tag_key") == tag_key))
        newest = F.max("seq").over(Window.partitionBy(*PARTS))
        return notes.withColumn("_newest", newest).filter("seq = _newest").drop("_newest")

    def known(self, label_key: str | None = None, tag_key: str | None = None) -> Known | None:
        """What is noted, of one label and tag if they are given, and what of it can be read in full; None if nothing was cached."""
        notes = self._manifest(label_key, tag_key)
        return None if notes is None else Known(self, notes)

    def chunks(self) -> DataFrame | None:
        """Keys and ``n`` of all chunks that can be read in full; None if nothing was cached."""
        known = self.known()
        return None if known is None else known.chunks.select(*PARTS, "n")

    def read(self) -> DataFrame | None:
        """The rows, with the key columns, of all chunks that can be read in full; None if nothing was cached."""
        known = self.known()
        return None if known is None else known.read()

    def missing(self, planned: DataFrame) -> DataFrame:
        """Planned chunks that are not cached: an anti join with the cached keys."""
        whole = self.chunks()
        return planned if whole is None else planned.join(whole.select(*PARTS), PARTS, "left_anti")


class Known:
    """One look at the cache. ``chunks``: key columns, bounds, status and n of the chunks that can be read in full."""

    def __init__(self, cache: ChunkCache, notes: DataFrame):
        self.cache, self.notes, self.spark = cache, notes, cache.spark
        # files of this part of the manifest, whose names pass the driver as those of any table's files do
        self.files = notes.select("file", "file_bytes", "file_rows", "row_schema").distinct().collect()
        self.sound = self._sound()
        chunks = notes.dropDuplicates(PARTS).select(*PARTS, *BOUNDS, "status", "n")
        bad = [r.file for r in self.files if r.file is not None and r.file not in self.sound]
        if bad:  # a chunk with rows in one of these is none
            chunks = chunks.join(notes.filter(F.col("file").isin(bad)).select(*PARTS), PARTS, "left_anti")
        self.chunks = chunks

    def _sound(self) -> set[str]:
        """Noted files whose length and rows are as noted. Lengths come from the folders' listings, rows from the footers."""
        noted = {storage.decoded(r.file): r for r in self.files if r.file is not None}
        there: dict[str, int] = {}
        for folder in {n.split("/")[1] for n in noted}:
            for name, size in storage.lengths(self.spark, f"{self.cache.path}/rows/{folder}").items():
                there[f"rows/{folder}/" + name.split(f"/rows/{folder}/", 1)[1]] = size
        likely = {n: r for n, r in noted.items() if there.get(n) == r.file_bytes}
        if not likely:
            return set()
        footers = self.cache._read_files([f"{self.cache.path}/{n}" for n in likely], StructType(), skip=True)
        counted = footers.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n")).collect()
        rows = {storage.decoded("rows/" + r.path.rsplit("/rows/", 1)[1]): r.n for r in counted}
        return {r.file for n, r in likely.items() if rows.get(n) == r.file_rows}

    def read(self, wanted: DataFrame | None = None) -> DataFrame:
        """Rows, with the key columns, of the sound chunks, or of some of them: the key columns of ``chunks`` that are ``wanted``."""
        schemas: dict[str, list[str]] = {}
        for r in self.files:
            schemas.setdefault(r.row_schema, []).extend([r.file] if r.file in self.sound else [])
        if not schemas:
            return empty(self.spark, ", ".join(f"{c} string" for c in PARTS))
        rows = union_all(*[self._rows(StructType.fromJson(json.loads(text)), files) for text, files in schemas.items()])
        keys = self.notes.filter(F.col("file").isNotNull()).select(*PARTS, "file").join((self.chunks if wanted is None else wanted).select(*PARTS), PARTS, "left_semi")
        # a chunk written again lies in an older file too, so rows go by chunk and file
        return rows.join(keys, [*PARTS, "file"], "left_semi").drop("file")

    def _rows(self, values: StructType, files: list[str]) -> DataFrame:
        schema = StructType(list(values.fields))
        for c in PARTS:
            schema = schema.add(c, "string")
        folders: dict[str, list[str]] = {}
        for f in files:
            folders.setdefault("/".join(f.split("/")[:2]), []).append(f"{self.cache.path}/{storage.decoded(f)}")
        reader = lambda folder: self.spark.read.schema(schema).option("ignoreCorruptFiles", "true").option("basePath", f"{self.cache.path}/{folder}")
        parts = [reader(folder).parquet(*names).withColumn("file", _file_name(folder)) for folder, names in folders.items()]
        return union_all(*parts) if parts else self.spark.createDataFrame([], schema.add("file", "string"))


def _file_name(folder: str) -> Column:
    """The name of a row's file below the cache's folder, as the manifest has it."""
    return F.concat(F.lit(f"{folder}/"), F.element_at(F.split("_metadata.file_path", f"/{folder}/"), 2))
