"""Reversible line deduplication (operator 8).

A line's key is the line with ASCII white space stripped from both ends and A-Z
lower-cased. The index keeps

* an exact reference table: one row for each (key, document), so that adding a
  document and taking it away again leave the same table,
* the repeated keys: those referenced by ``min_docs`` documents or more, with
  the count and the largest document, and
* for each shard of the key space a cuckoo filter of its repeated keys, updated
  by insertions and deletions when a key's count crosses ``min_docs``.

Deduplication tests lines against the filters first; only the few that hit go
on to the exact join, which confirms them. Keys are the first 16 bytes of a
line's SHA-256.

Defined cases: a null or empty text is one empty line; keys of fewer than
``min_chars`` code points are never dropped; rows with the same doc_id are one
document; rows with a null doc_id keep all lines and are not counted; of
documents that tie on a line only the largest doc_id keeps it, with all its
repeats there; texts of any length are cut whole; an empty table gives an empty
index; further columns pass through untouched, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, fresh, materialize, release_memory, salted_join, slices, small_side

MIN_CHARS = 20
MIN_DOCS = 3
#: Repeated keys that a shard is laid out for.
KEYS_PER_SHARD = 100_000
#: Rows that meet a filter in one group.
GROUP_ROWS = 500_000
_STRIP = ASCII_SPACE.encode()


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The key of one line, or None if it is too short to count."""
    line = line.strip(_STRIP)
    if len(line) < min_chars or len(line) < 4 * min_chars and len(line.decode("utf-8", "replace")) < min_chars:
        return None
    return hashlib.sha256(line.lower()).digest()[:16]  # bytes.lower() changes A-Z only


class CuckooFilter:
    """16-bit fingerprints in buckets of four, each key with two candidate buckets; keys are 16-byte hashes."""

    SLOTS = 4
    MAX_KICKS = 500

    def __init__(self, capacity: int):
        buckets = 1
        while buckets * self.SLOTS * 0.8 < max(1, capacity):
            buckets *= 2
        self.table = np.zeros((buckets, self.SLOTS), np.uint16)

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        made = cls(1)
        made.table = np.frombuffer(data, np.uint16).reshape(-1, cls.SLOTS).copy()
        return made

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def places(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint (never 0) and the two buckets of each key."""
        parts = np.frombuffer(b"".join(keys), "<u4").reshape(-1, 4)
        prints = (parts[:, 2] % 65535 + 1).astype(np.int64)
        mask = len(self.table) - 1
        first = parts[:, 1].astype(np.int64) & mask
        return prints, first, first ^ self._jump(prints)

    def _jump(self, prints: np.ndarray) -> np.ndarray:
        return (prints * 0x5BD1E995 >> 3) & (len(self.table) - 1)

    def insert(self, keys: list[bytes]) -> bool:
        """Add keys, which must not be in already; False if the table is too full (it is then to be rebuilt)."""
        rng = np.random.default_rng(len(keys))
        for mark, one, two in zip(*map(np.ndarray.tolist, self.places(keys))) if keys else ():
            for at in (one, two):
                free = np.flatnonzero(self.table[at] == 0)
                if len(free):
                    self.table[at, free[0]] = mark
                    break
            else:
                at = two
                for _ in range(self.MAX_KICKS):
                    slot = int(rng.integers(self.SLOTS))
                    mark, self.table[at, slot] = int(self.table[at, slot]), mark
                    at ^= int(self._jump(np.int64(mark)))
                    free = np.flatnonzero(self.table[at] == 0)
                    if len(free):
                        self.table[at, free[0]] = mark
                        break
                else:
                    return False
        return True

    def delete(self, keys: list[bytes]) -> None:
        """Take away keys that were inserted."""
        for mark, one, two in zip(*map(np.ndarray.tolist, self.places(keys))) if keys else ():
            for at in (one, two):
                held = np.flatnonzero(self.table[at] == mark)
                if len(held):
                    self.table[at, held[0]] = 0
                    break

    def contains(self, keys: list[bytes]) -> np.ndarray:
        """True for every key that is in; seldom true for one that is not."""
        if not keys:
            return np.zeros(0, bool)
        prints, first, second = self.places(keys)
        return ((self.table[first] == prints[:, None]) | (self.table[second] == prints[:, None])).any(axis=1)


def build_filter(keys: list[bytes]) -> CuckooFilter:
    room = len(keys)
    while True:
        made = CuckooFilter(room)
        if made.insert(keys):
            return made
        room = 2 * room + 1


def shard_of(key: Column, shards: int) -> Column:
    return F.conv(F.hex(F.substring(key, 1, 4)), 16, 10).cast("long") % F.lit(shards)


def references(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, doc_id) for the distinct countable lines of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, keys = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                lines = (text.as_py() or "").encode("utf-8", "surrogatepass").split(b"\n")
                found = {k for k in (line_key(x, min_chars) for x in lines) if k is not None}
                keys += found
                ids += [doc] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], ["key", "doc_id"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter(F.col("doc_id").isNotNull())
    return picked.mapInArrow(run, "key binary, doc_id long")


def _counted(refs: DataFrame) -> DataFrame:
    """Documents and the largest document of each key; both steps combine map-side, so a hot key is one row per task."""
    return refs.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))


@dataclass(frozen=True)
class LineIndex:
    """A version of the index: tables in the shared folder. Updates give a new version and leave this one as it is."""

    refs: DataFrame  # key, doc_id: one row each
    repeated: DataFrame  # key, n_docs, last_doc, shard
    filters: DataFrame  # shard, data
    shards: int
    min_chars: int = MIN_CHARS
    min_docs: int = MIN_DOCS

    @classmethod
    def build(cls, docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> LineIndex:
        refs = materialize(references(docs, min_chars).distinct(), "line-refs")
        repeated = materialize(_counted(refs).filter(F.col("n_docs") >= min_docs), "line-repeated")
        shards = max(8, -(-repeated.count() // KEYS_PER_SHARD))
        repeated = repeated.withColumn("shard", shard_of(F.col("key"), shards))
        filters = repeated.select("shard", "key").groupBy("shard").applyInPandas(_build_shard, "shard long, data binary")
        return cls(refs, repeated, materialize(filters, "line-filters"), shards, min_chars, min_docs)

    def insert(self, docs: DataFrame) -> LineIndex:
        """Add documents; pairs of line and document that are in already change nothing."""
        new = references(docs, self.min_chars).distinct()
        new = materialize(new.join(self.refs, ["key", "doc_id"], "left_anti"), "line-new")
        return self._updated(self.refs.unionByName(new), new.select("key").distinct())

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """Take documents away again."""
        gone = doc_ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
        return self._updated(self.refs.join(gone, "doc_id", "left_anti").select("key", "doc_id"), self.refs.join(gone, "doc_id", "left_semi").select("key").distinct())

    def _updated(self, refs: DataFrame, touched: DataFrame) -> LineIndex:
        refs, touched = materialize(refs, "line-refs"), materialize(touched, "line-touched")
        old = self.repeated.drop("shard")
        recounted = _counted(refs.join(touched, "key", "left_semi")).filter(F.col("n_docs") >= self.min_docs)
        repeated = materialize(old.join(touched, "key", "left_anti").unionByName(recounted), "line-repeated")
        was, now = old.select("key", F.lit(1).alias("was")), repeated.select("key", F.lit(1).alias("now"))
        change = was.join(now, "key", "full").select(shard_of(F.col("key"), self.shards).alias("shard"), "key", F.coalesce("was", F.lit(0)).alias("was"), F.coalesce("now", F.lit(0)).alias("now"))
        filters = change.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInPandas(_update_shard, "shard long, data binary")
        return replace(self, refs=refs, repeated=repeated.withColumn("shard", shard_of(F.col("key"), self.shards)), filters=materialize(filters, "line-filters"))

    def droppable(self, refs: DataFrame) -> DataFrame:
        """The (key, doc_id) whose lines go: repeated keys, except in the largest document that holds them."""
        hits = materialize(self._filtered(refs), "line-hits")
        return salted_join(hits, self.repeated.select("key", "last_doc"), ["key"], ["doc_id"]).filter(F.col("doc_id") < F.col("last_doc")).select("key", "doc_id")

    def _filtered(self, refs: DataFrame) -> DataFrame:
        """The rows whose key passes its shard's filter.

        Rows meet their filter by shuffle, and filters never pass through the
        driver. A shard with many rows (a hot key is in one) is dealt to as many
        groups as it needs, each with a copy of its small filter.
        """
        placed = refs.select("key", "doc_id", shard_of(F.col("key"), self.shards).alias("shard"))
        groups = F.greatest(F.lit(1), F.ceil(F.count("*") / F.lit(GROUP_ROWS))).cast("long")
        sizes = materialize(placed.groupBy("shard").agg(groups.alias("groups")), "line-groups")  # a row for each shard
        dealt = placed.join(small_side(sizes), "shard").select("key", "doc_id", "shard", F.pmod(F.xxhash64("doc_id"), F.col("groups")).alias("part"))
        copies = self.filters.join(small_side(sizes), "shard").select("shard", "data", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("part"))
        return dealt.groupBy("shard", "part").cogroup(copies.groupBy("shard", "part")).applyInPandas(_probe_shard, "key binary, doc_id long")

    def dedup(self, docs: DataFrame) -> DataFrame:
        """``docs`` with text cut to the lines that stay, n_lines (before) and n_dropped.

        For documents of the index. Columns of those names in the input are replaced.
        """
        drops = self.droppable(self.refs).groupBy("doc_id").agg(F.collect_list("key").alias("drop_keys"))  # at most a document's own lines
        docs = docs.drop("n_lines", "n_dropped")
        by, gone_keys = fresh("line_doc", docs.columns), fresh("line_drops", docs.columns)
        drops = materialize(drops, "line-drops").select(F.col("doc_id").alias(by), F.col("drop_keys").alias(gone_keys))
        joined = docs.join(drops, docs["doc_id"].cast("long") == F.col(by), "left").drop(by)
        min_chars = self.min_chars

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                kept, total, dropped = [], [], []
                for text, drop in zip(batch.column("text"), batch.column(gone_keys)):
                    text, gone = text.as_py() or "", drop.as_py()
                    total.append(text.count("\n") + 1)
                    if gone:
                        gone = set(gone)
                        lines = text.encode("utf-8", "surrogatepass").split(b"\n")
                        stay = [x for x in lines if line_key(x, min_chars) not in gone]
                        text = b"\n".join(stay).decode("utf-8", "surrogatepass")
                        dropped.append(len(lines) - len(stay))
                    else:
                        dropped.append(0)
                    kept.append(text)
                out = batch.drop_columns([gone_keys])
                out = out.set_column(out.schema.get_field_index("text"), "text", pa.array(kept, pa.string()))
                yield out.append_column("n_lines", pa.array(total, pa.int64())).append_column("n_dropped", pa.array(dropped, pa.int64()))

        schema = joined.drop(gone_keys).withColumn("text", F.col("text").cast("string")).withColumn("n_lines", F.lit(0).cast("long")).withColumn("n_dropped", F.lit(0).cast("long")).schema
        return joined.mapInArrow(run, schema)


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    made = build_filter([bytes(k) for k in rows["key"]])
    return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "data": [made.to_bytes()]})


def _probe_shard(lines: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
    if not len(lines) or not len(held):  # no rows, or no repeated key in the shard
        return lines.iloc[:0].reindex(columns=["key", "doc_id"])
    hit = CuckooFilter.from_bytes(held["data"].iloc[0]).contains([bytes(k) for k in lines["key"]])
    found = lines.loc[hit, ["key", "doc_id"]]
    release_memory()
    return found


def _update_shard(change: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
    """Delete and insert what changed; a table that gets too full is built again from the exact keys."""
    shard = change["shard"].iloc[0] if len(change) else held["shard"].iloc[0]
    was, now = change["was"].to_numpy() == 1, change["now"].to_numpy() == 1
    keys = np.array([bytes(k) for k in change["key"]], object)
    made = CuckooFilter.from_bytes(held["data"].iloc[0]) if len(held) else None
    if made is not None:
        made.delete(list(keys[was & ~now]))
    if made is None or not made.insert(list(keys[~was & now])):
        made = build_filter(list(keys[now]))
    return pd.DataFrame({"shard": [shard], "data": [made.to_bytes()]})
