"""Jaccard join on word n-grams by blocked sparse products (operator 10).

The document by n-gram incidence matrix is never formed as a whole:

1. Documents with equal shingle sets become one class (its smallest doc_id).
2. The columns are cut into blocks by hash. A class can only have a partner if
   80 % of its shingles occur in another class, so each column block counts, for
   every class, the shingles it holds elsewhere; the others leave here.
3. Of the classes left, each keeps its rarest shingles: two sets that overlap
   enough must share one of the rarest |x| - ceil(0.8 |x|) + 1. Classes that
   share one, and whose sizes allow a link, are put in one row block.
4. Within a row block the sparse product adds up overlap counts, and pairs below
   the bound that follows from their sizes are discarded. Rows already joined to
   the block's largest component need no product among themselves. A block too
   large for one task is cut into tiles, after one row (a pivot) has joined most
   of it.
5. Components of the links are spread from the classes to their documents.

Column blocks travel as packed arrays, a row for each task and block (never more
than one for each shingle), so counts of rows do not grow with the sizes of groups.
Blocks are dealt to partitions by number, and a task holds one at a time.

Defined cases: texts without words (null, empty, white space) have no shingles,
link with nothing and form their own component; long texts give all their
shingles; shingles that tie in rarity are taken by hash; repeated rows get equal
results; rows that share a doc_id but not the text are one document that links
wherever one of its texts does; a null doc_id gets a null component and links
nothing; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import connected_components, materialize, release_memory, salted_join, slices, small_side
from .shingles import shingle_set

SIZE = 5
#: A link needs 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Shingles packed at a time in a task, shingles laid out for one column block, classes for one bucket of counts.
CHUNK = 1_000_000
BLOCK_ENTRIES = 2_000_000
BUCKET_CLASSES = 100_000
#: Shingles of a row block that one task takes whole; larger ones are cut into tiles of TILE_ENTRIES.
ROW_BLOCK_ENTRIES = 6_000_000
TILE_ENTRIES = 1_000_000
NO_OWNER = np.uint32(0xFFFFFFFF)


def _picked(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def set_sizes(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, n_shingles, set_hash) of each row; set_hash is null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(x.as_py(), size) for x in batch.column(1)]
            hashes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(map(len, sets)), pa.int64()), pa.array(hashes, pa.binary())], ["doc_id", "n_shingles", "set_hash"])

    return _picked(docs).mapInArrow(run, "doc_id long, n_shingles long, set_hash binary")


def _pack(ids: list[int], sets: list[np.ndarray], shards: int, keep_hashes: bool) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
    """The column blocks of some rows: for each shard its keys, owners, owners' ids and counts already known to be shared.

    Without ``keep_hashes`` keys are 32 bits (with the shard, some 37: chance
    equals only make the filter wider), and a key met several times here is
    counted at once and sent a single time, without owner.
    """
    if not ids:
        return
    hashes = np.concatenate(sets)
    owners = np.repeat(np.arange(len(ids), dtype=np.uint32), list(map(len, sets)))
    order = np.argsort(hashes, kind="stable")
    hashes, owners = hashes[order], owners[order]
    new = np.r_[True, hashes[1:] != hashes[:-1]] if len(hashes) else np.zeros(0, bool)
    single = new & np.r_[new[1:], True]
    places = ((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
    cuts = np.searchsorted(places, np.arange(shards + 1, dtype=np.uint64))
    all_ids = np.array(ids, np.int64)
    for shard in range(shards):
        lo, hi = cuts[shard], cuts[shard + 1]
        if lo == hi:
            continue
        who, local = np.unique(owners[lo:hi], return_inverse=True)
        local = local.astype(np.uint32)
        if keep_hashes:
            known, keys = np.zeros(0, np.uint32), hashes[lo:hi]
        else:
            known = np.bincount(local[~single[lo:hi]], minlength=len(who)).astype(np.uint32)
            first = new[lo:hi]
            keys = (hashes[lo:hi][first] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            local = np.where(single[lo:hi], local, NO_OWNER)[first]
        yield shard, keys.tobytes(), local.tobytes(), all_ids[who].tobytes(), known.tobytes()


_BLOCK_SCHEMA = "shard long, keys binary, owners binary, ids binary, known binary"


def _blocks(batches: Iterator[pa.RecordBatch], sets_of, shards: int, keep_hashes: bool) -> Iterator[pa.RecordBatch]:
    ids: list[int] = []
    sets: list[np.ndarray] = []
    held = 0
    names = ["shard", "keys", "owners", "ids", "known"]
    types = [pa.int64(), *[pa.binary()] * 4]

    def flush() -> pa.RecordBatch:
        columns = list(zip(*_pack(ids, sets, shards, keep_hashes))) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    for batch in slices(batches):
        for doc, found in sets_of(batch):
            ids.append(doc)
            sets.append(found)
            held += len(found)
            if held >= CHUNK:
                yield flush()
                ids, sets, held = [], [], 0
    if ids:
        yield flush()


#: Partitions that numbered blocks are dealt to, at most.
MAX_PARTITIONS = 20_000


def _dealt(packed: DataFrame, key: str, count: int, work, schema: str) -> DataFrame:
    """``work`` on the rows of each value (0 to count - 1) of ``key``, one value at a time in a task."""
    parts = min(count, MAX_PARTITIONS)
    placed = packed.repartitionById(parts, F.col(key).cast("int") % F.lit(parts)).sortWithinPartitions(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, key):
            found = pa.RecordBatch.from_pandas(work(table.to_pandas()), preserve_index=False)
            del table
            yield found
            release_memory()

    return placed.mapInArrow(run, schema)


def _unpack(rows: pd.DataFrame, key_type: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, owners as positions in ids, and ids of all rows of a shard."""
    keys, owners, ids, base = [], [], [], 0
    for k, o, i in zip(rows["keys"], rows["owners"], rows["ids"]):
        keys.append(np.frombuffer(k, key_type))
        own = np.frombuffer(o, np.uint32).astype(np.int64)
        owners.append(np.where(own == int(NO_OWNER), -1, own + base))
        ids.append(np.frombuffer(i, np.int64))
        base += len(ids[-1])
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(ids)


def _by_bucket(ids: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    where = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(buckets)
    order = np.argsort(where, kind="stable")
    cuts = np.searchsorted(where[order], np.arange(buckets + 1, dtype=np.uint64))
    for b in range(buckets):
        if cuts[b] < cuts[b + 1]:
            yield b, order[cuts[b] : cuts[b + 1]]


def _count_shared(rows: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """Of one column block: how many of its keys each class shares with another one."""
    keys, owners, ids = _unpack(rows, np.uint32)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    shared = np.zeros(len(keys), bool)
    shared[order[1:]] |= same
    shared[order[:-1]] |= same
    known = np.concatenate([np.frombuffer(k, np.uint32) for k in rows["known"]]).astype(np.int64)
    counts = known + np.bincount(owners[shared & (owners >= 0)], minlength=len(ids))
    found = counts > 0
    ids, counts = ids[found], counts[found]
    out = [(b, ids[at].tobytes(), counts[at].tobytes()) for b, at in _by_bucket(ids, buckets)]
    return pd.DataFrame(out, columns=["bucket", "ids", "counts"])


def _sum_shared(rows: pd.DataFrame) -> pd.DataFrame:
    ids = np.concatenate([np.frombuffer(x, np.int64) for x in rows["ids"]])
    counts = np.concatenate([np.frombuffer(x, np.int64) for x in rows["counts"]])
    who, where = np.unique(ids, return_inverse=True)
    return pd.DataFrame({"doc_id": who, "n_shared": np.bincount(where, counts, len(who)).astype(np.int64)})


def _send_counts(rows: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """Of one column block: for each class its keys and in how many classes they occur."""
    keys, owners, ids = _unpack(rows, np.uint64)
    order = np.argsort(keys, kind="stable")
    new = np.r_[True, keys[order][1:] != keys[order][:-1]]
    run = np.cumsum(new) - 1
    df = np.empty(len(keys), np.uint16)
    df[order] = np.minimum(np.bincount(run), 65535).astype(np.uint16)[run]
    owner_ids = ids[owners]
    out = [(b, owner_ids[at].tobytes(), keys[at].tobytes(), df[at].tobytes()) for b, at in _by_bucket(owner_ids, buckets)]
    return pd.DataFrame(out, columns=["bucket", "ids", "keys", "df"])


def _rarest(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """The prefix of each row: its rarest shingles, of which those in other classes too are returned."""
    ids = np.concatenate([np.frombuffer(x, np.int64) for x in rows["ids"]])
    keys = np.concatenate([np.frombuffer(x, np.uint64) for x in rows["keys"]])
    df = np.concatenate([np.frombuffer(x, np.uint16) for x in rows["df"]])
    order = np.lexsort((keys, df, ids))
    ids, keys, df = ids[order], keys[order], df[order]
    _, start, size = np.unique(ids, return_index=True, return_counts=True)
    place = np.arange(len(ids)) - np.repeat(start, size)
    size = np.repeat(size, size)
    keep = (place < size - -(-percent * size // 100) + 1) & (df > 1)
    return pd.DataFrame({"shingle": keys[keep].view(np.int64), "row": ids[keep], "n": size[keep].astype(np.int64)})


def product_links(sets: list[np.ndarray], percent: int = PERCENT, every: bool = False, rows: np.ndarray | None = None) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Component label of each set, and with ``every`` all links as (i, j, overlap), i multiplied.

    ``rows``: which sets are multiplied with all others; all by default. A link
    between two of them is given once, with i < j. The product is formed for a few rows at a time from the columns' postings.
    """
    m = len(sets)
    sizes = np.array(list(map(len, sets)), np.int64)
    starts = np.r_[0, np.cumsum(sizes)]
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(m), sizes)
    posting = owner[np.argsort(column, kind="stable")]
    df = np.bincount(column)
    pointer = np.r_[0, np.cumsum(df)]
    work = np.add.reduceat(df[column], starts[:-1]) if m else df
    label, done = np.arange(m), np.zeros(m, bool)
    wanted = np.ones(m, bool) if rows is None else rows
    links: list[tuple[int, int, int]] = []
    block = np.array([int(np.argmax(work * wanted))])
    while len(block):
        columns = np.concatenate([column[starts[x] : starts[x + 1]] for x in block])
        lengths = df[columns]
        flat = np.repeat(pointer[columns] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        row = np.repeat(np.repeat(np.arange(len(block)), sizes[block]), lengths)
        overlap = np.bincount(row * m + posting[flat], minlength=len(block) * m).reshape(len(block), m)
        # equal to 100 * overlap >= percent * union, as a bound on the overlap from the two sizes
        linked = (100 + percent) * overlap >= percent * (sizes[block][:, None] + sizes[None, :])
        for k, x in enumerate(block):
            partners = np.flatnonzero(linked[k])
            merged = np.unique(label[partners])
            if len(merged) > 1:
                label[np.isin(label, merged)] = merged[0]
            if every:
                links += [(x, y, int(overlap[k, y])) for y in partners.tolist() if y > x or not wanted[y]]
        done[block] = True
        outside = label != np.bincount(label).argmax()
        # a row of the largest component may only be skipped if all rows it could still be linked to are multiplied or in it
        left = np.flatnonzero(wanted & ~done & (every | outside | (outside & ~wanted).any()))
        room = min(len(left), max(1, 16_000_000 // m), int(np.searchsorted(np.cumsum(work[left]), 8_000_000)) + 1)
        block = left[:room]
    return label, links


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of the rows with one key, of batches that come sorted by it."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for lo, hi in zip(cuts, cuts[1:]):
            if held and values[lo] != current:
                yield pa.Table.from_batches(held)
                held = []
            current = values[lo]
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def _sets_in(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), np.uint64) for x in table.column("shingles")]


_LINKS_SCHEMA = "a long, b long, overlap long"


def _links_batch(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "overlap"])


def _links_of(ids: np.ndarray, sets: list[np.ndarray], percent: int, every: bool, rows: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """All links, or links enough to hold each component together (overlap -1)."""
    label, links = product_links(sets, percent, every, rows)
    if every:
        return [(int(ids[i]), int(ids[j]), o) for i, j, o in links]
    return [(int(ids[i]), int(ids[label[i]]), -1) for i in range(len(ids)) if label[i] != i]


def _whole_blocks(blocks: DataFrame, percent: int, every: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, "block"):
            yield _links_batch(_links_of(table.column("doc_id").to_numpy(), _sets_in(table), percent, every))
        release_memory()

    return blocks.repartition("block").sortWithinPartitions("block").select("block", "doc_id", "shingles").mapInArrow(run, _LINKS_SCHEMA)


def _tiled_blocks(blocks: DataFrame, sizes: DataFrame, percent: int, every: bool) -> DataFrame:
    """Row blocks too large for a task: the pivot's row first, then tiles of the rows it did not join with all rows."""
    tiles = F.ceil(F.col("entries") / TILE_ENTRIES)
    sizes = sizes.select("block", tiles.alias("tiles"), "pivot")
    blocks = materialize(blocks, "jaccard-large-rows")
    pivots = blocks.join(sizes.select("block", F.col("pivot").alias("doc_id"), "tiles"), ["block", "doc_id"]).select("block", F.col("doc_id").alias("pivot"), F.col("shingles").alias("pivot_shingles"), "tiles")
    pivots = materialize(pivots.dropDuplicates(["block"]), "jaccard-pivots")
    with_pivot = salted_join(blocks, pivots, ["block"], ["doc_id"])

    def against(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            core = []
            for x, p in zip(batch.column("shingles"), batch.column("pivot_shingles")):
                x, p = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(p.as_py(), np.uint64)
                common = len(np.intersect1d(x, p, assume_unique=True))
                core.append((100 + percent) * common >= percent * (len(x) + len(p)))
            yield batch.drop_columns(["pivot_shingles"]).append_column("core", pa.array(core, pa.bool_()))

    schema = "block long, doc_id long, n long, shingles binary, pivot long, tiles long, core boolean"
    rows = with_pivot.select("block", "doc_id", "n", "shingles", "pivot", "pivot_shingles", "tiles").mapInArrow(against, schema)
    rows = materialize(rows.withColumn("tile", F.pmod(F.xxhash64("doc_id"), F.col("tiles"))), "jaccard-tiles")
    joined = rows.filter(F.col("core") & (F.col("doc_id") != F.col("pivot"))).select(F.col("doc_id").alias("a"), F.col("pivot").alias("b"), F.lit(-1).cast("long").alias("overlap"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    asked = rows if every else rows.filter(~F.col("core"))
    left = asked.select("block", F.col("tile").alias("i"), other.alias("j"), "doc_id", "shingles", F.lit(True).alias("asks"))
    right = rows.select("block", other.alias("i"), F.col("tile").alias("j"), "doc_id", "shingles", F.lit(False).alias("asks"), "core")
    # in the cell of a tile with itself the rows that ask are there already
    right = right.filter((F.col("i") != F.col("j")) | (F.col("core") & F.lit(not every))).drop("core")
    cells = left.unionByName(right).withColumn("cell", F.xxhash64("block", "i", "j"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, "cell"):
            asks = table.column("asks").to_numpy(zero_copy_only=False).astype(bool)
            if asks.any():
                yield _links_batch(_links_of(table.column("doc_id").to_numpy(), _sets_in(table), percent, every, asks))
        release_memory()

    products = cells.repartition("cell").sortWithinPartitions("cell").select("cell", "doc_id", "shingles", "asks").mapInArrow(run, _LINKS_SCHEMA)
    return products.filter(F.col("a") != F.col("b")) if every else products.unionByName(joined)


def neighbours(prefix: DataFrame, percent: int) -> DataFrame:
    """(a, b) of rows that are next to each other in the list of a shingle, sorted by size, and whose sizes allow a link.

    Members of a list whose sizes allow a link are joined by a chain of such
    neighbours. The lists are cut by range, so that a very long one lies in many
    partitions; the two ends of each partition are joined afterwards.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first = last = None  # shingle, size and row of the ends
        for batch in batches:
            if not batch.num_rows:
                continue
            shingle, n, row = (batch.column(k).to_numpy() for k in range(3))
            ends = [(shingle[k], n[k], row[k]) for k in (0, -1)]
            if last is not None:
                shingle, n, row = (np.r_[x, y] for x, y in zip(last, (shingle, n, row)))
            first, last = first or ends[0], ends[1]
            found = np.flatnonzero((shingle[1:] == shingle[:-1]) & (100 * n[:-1] >= percent * n[1:]) & (row[1:] != row[:-1]))
            yield edges(row[found + 1], row[found], [None] * len(found), [None] * len(found), [None] * len(found))
        if last is not None:
            yield edges([int(x[2]) for x in (first, last)], [0, 1], [part] * 2, [int(x[0]) for x in (first, last)], [int(x[1]) for x in (first, last)])

    def edges(*columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "part", "shingle", "n"])

    found = prefix.select("shingle", "n", "row").repartitionByRange("shingle", "n", "row").sortWithinPartitions("shingle", "n", "row")
    found = materialize(found.mapInArrow(run, "a long, b long, part long, shingle long, n long"), "jaccard-neighbours")
    ends = found.filter(F.col("part").isNotNull())  # two rows for each partition, so one window may hold them
    at = Window.orderBy("part", "b")
    across = ends.select("a", F.lag("a").over(at).alias("before"), ((F.lag("shingle").over(at) == F.col("shingle")) & (100 * F.lag("n").over(at) >= percent * F.col("n"))).alias("linked"))
    across = across.filter(F.col("linked") & (F.col("a") != F.col("before"))).select("a", F.col("before").alias("b"))
    return found.filter(F.col("part").isNull()).select("a", "b").unionByName(across).distinct()


def class_links(docs: DataFrame, classes: DataFrame, size: int = SIZE, percent: int = PERCENT, every: bool = False) -> DataFrame:
    """Links (a, b, overlap) between class representatives; without ``every`` just links enough for the components."""
    totals = classes.agg(F.sum("n_shingles").alias("n"), F.count("*").alias("classes")).first()
    shards = max(1, -(-(totals.n or 0) // BLOCK_ENTRIES))
    buckets = max(1, -(-totals.classes // BUCKET_CLASSES))
    usable = _picked(docs).filter(F.col("doc_id").isNotNull())

    def from_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _blocks(batches, lambda b: zip(b.column(0).to_pylist(), (shingle_set(x.as_py(), size) for x in b.column(1))), shards, False)

    # copies of a class are counted too: a class that has some stays, and the texts need no shuffle here
    blocks = usable.mapInArrow(from_text, _BLOCK_SCHEMA)
    shared = _dealt(blocks, "shard", shards, lambda rows: _count_shared(rows, buckets), "bucket long, ids binary, counts binary")
    shared = _dealt(shared, "bucket", buckets, _sum_shared, "doc_id long, n_shared long")
    enough = shared.join(classes.select(F.col("rep").alias("doc_id"), F.col("n_shingles").alias("n")), "doc_id").filter(100 * F.col("n_shared") >= percent * F.col("n"))
    survivors = materialize(enough.select("doc_id").distinct(), "jaccard-survivors")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shingle_set(x.as_py(), size) for x in batch.column(1)]
            packed = [s.tobytes() for s in found]
            hashes = [xxhash.xxh3_128_digest(s) for s in packed]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes, pa.binary()), pa.array(list(map(len, found)), pa.int64()), pa.array(packed, pa.binary())], ["doc_id", "set_hash", "n", "shingles"])

    kept = usable.join(survivors, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(sets, "doc_id long, set_hash binary, n long, shingles binary")
    # numbered, as a doc_id may come with several sets, and once written the numbers stay; of rows with one set the representative's is left
    kept = materialize(kept.filter(F.col("n") > 0).withColumn("row", F.monotonically_increasing_id()), "jaccard-sets")
    repeated = kept.groupBy("set_hash").agg(F.min(F.struct("doc_id", "row")).getField("row").alias("first"), F.count("*").alias("times")).filter("times > 1")
    repeated = materialize(repeated.select("set_hash", "first"), "jaccard-repeated")
    extra = materialize(kept.select("set_hash", "row").join(repeated, "set_hash").filter(F.col("row") != F.col("first")).select("row"), "jaccard-extra")
    kept = kept.join(extra, "row", "left_anti")
    left = kept.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-left // BLOCK_ENTRIES))

    def from_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _blocks(batches, lambda b: zip(b.column(0).to_pylist(), (np.frombuffer(x.as_py(), np.uint64) for x in b.column(1))), parts, True)

    counted = _dealt(kept.select("row", "shingles").mapInArrow(from_sets, _BLOCK_SCHEMA), "shard", parts, lambda rows: _send_counts(rows, parts), "bucket long, ids binary, keys binary, df binary")
    prefix = materialize(_dealt(counted, "bucket", parts, lambda rows: _rarest(rows, percent), "shingle long, row long, n long"), "jaccard-prefixes")
    chain = neighbours(prefix, percent)
    labels = connected_components(chain, name="jaccard-blocks").select(F.col("node").alias("row"), F.col("label").alias("block"))
    rows = materialize(kept.join(labels, "row").select("block", "doc_id", "n", "shingles"), "jaccard-rows")
    entries = rows.groupBy("block").agg(F.sum("n").alias("entries"), F.min("doc_id").alias("pivot"))
    large = materialize(entries.filter(F.col("entries") > ROW_BLOCK_ENTRIES), "jaccard-large")
    if large.isEmpty():
        return _whole_blocks(rows, percent, every)
    sized = salted_join(rows, large.select("block", F.lit(True).alias("large")), ["block"], ["doc_id"], "left")
    whole = _whole_blocks(sized.filter(F.col("large").isNull()).drop("large"), percent, every)
    return whole.unionByName(_tiled_blocks(sized.filter("large").drop("large"), large, percent, every))


def classes_of(sizes: DataFrame) -> DataFrame:
    """(set_hash, n_shingles, rep): documents with equal sets, under the smallest doc_id."""
    usable = sizes.filter(F.col("set_hash").isNotNull() & F.col("doc_id").isNotNull())
    return usable.groupBy("set_hash").agg(F.first("n_shingles").alias("n_shingles"), F.min("doc_id").alias("rep"))


def near_duplicates(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """One row for each input row: doc_id, n_shingles and component_id (the smallest doc_id reachable by links)."""
    sizes = materialize(set_sizes(docs, size), "jaccard-sizes")
    classes = materialize(classes_of(sizes), "jaccard-classes")
    links = class_links(docs, classes, size, percent).select("a", "b")
    # a doc_id with several texts ties their classes together
    named = sizes.filter(F.col("doc_id").isNotNull())
    some_hash = F.coalesce("set_hash", F.lit(b""))
    several = named.groupBy("doc_id").agg(F.min(some_hash).alias("one"), F.max(some_hash).alias("other")).filter(F.col("one") != F.col("other")).select("doc_id")
    tied = named.join(materialize(several, "jaccard-several"), "doc_id", "left_semi").distinct()
    tied = tied.join(classes.select("set_hash", "rep"), "set_hash", "left").select("doc_id", F.coalesce("rep", "doc_id").alias("rep"))
    ties = tied.join(tied.groupBy("doc_id").agg(F.min("rep").alias("b")), "doc_id").filter(F.col("rep") != F.col("b")).select(F.col("rep").alias("a"), "b").distinct()
    labels = materialize(connected_components(links.unionByName(ties), name="jaccard-components"), "jaccard-labels")
    # labels meet the classes first and then, class by class, the documents
    labelled = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("set_hash", F.coalesce("label", "rep").alias("component_id"))
    with_set = F.col("set_hash").isNotNull() & F.col("doc_id").isNotNull()
    found = salted_join(sizes.filter(with_set), labelled, ["set_hash"], ["doc_id"]).select("doc_id", "n_shingles", "component_id")
    rest = sizes.filter(~with_set).join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id"))
    return found.unionByName(rest)


def similar_pairs(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """Every link between class representatives: a < b, overlap. Members of a class are linked by definition and are not listed."""
    sizes = materialize(set_sizes(docs, size), "jaccard-sizes")
    classes = materialize(classes_of(sizes), "jaccard-classes")
    found = class_links(docs, classes, size, percent, every=True)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "overlap").filter(F.col("a") != F.col("b")).distinct()
