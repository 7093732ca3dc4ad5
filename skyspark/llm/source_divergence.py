"""Audit of how the sources of a language differ in their terms, by chunk factorization.

Texts are split at white space into chunks. A batch of documents keeps, for each of its
distinct chunks, the documents that hold it and how often (its postings); the chunks
themselves are dealt to buckets by their hash, where all batches meet, so that each globally
distinct chunk is split into terms once. The terms go back to the batches, which join them
with the postings and add up occurrences by source and documents by language; a
document that holds a term in several chunks ("End," and "end") counts once. The sums of
batches are added up by buckets of terms. What is shuffled is the distinct chunks of batches
and back their terms, never words; the postings, which are most of the data, go once to
the task of their batch, and a common chunk or term is one line of each batch, so no bucket
is hot.

All arithmetic is exact, in integers of 64 bits; a language of more than 9 * 10**15
occurrences is an error.

Defined cases: null text, lang and source are empty texts; every row is a document, so
repeated rows count as often as they come; the doc_id is not used; a language without
kept terms has pairs of value 0 and no term rows; an empty table gives no rows; ties are
ranked by the item's UTF-8 bytes; texts and chunks of any length are read as a whole;
further columns are left out.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, release_memory, slices, small_side

#: The characters of a term, in the bytes of UTF-8, after A-Z became a-z.
TERM = re.compile(rb"[a-z\x80-\xff]+")
MIN_DOCS, TOP_TERMS = 30, 50
SCALE, PRIOR = 1_000_000_000, 5

#: A batch ends after so many documents or bytes of text, whichever comes first; a longer text is a batch of its own.
BATCH_DOCS, BATCH_BYTES = 16_384, 16 << 20
#: Buckets of chunks, and of terms. One task takes one bucket at a time and holds its distinct chunks or terms.
BUCKETS = 1_024
#: Sums of a bucket that wait before they are added up.
PENDING = 1_000_000
#: Terms of a language that one task compares over all its sources.
BLOCK_TERMS = 4_096
#: Sources of a language whose pairs with all others one task adds up.
TILE_SOURCES = 512

#: Rows of a batch: its postings (bucket -1: groups of the documents, and packed numbers), and the chunks of one bucket, later their terms.
BATCH = "batch long, bucket int, lines binary, langs array<string>, sources array<string>, sizes binary, owners binary, counts binary"
#: Rows of a batch after that: the terms of one bucket, the groups that hold one, and packed numbers.
TERMS = "bucket int, lines binary, langs array<string>, sources array<string>, numbers binary"
KEPT = "lang string, term string, n_docs long, n long, held array<struct<source: string, n: long>>"
_TEXTS = pa.list_(pa.string())
_BATCH = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("lines", pa.binary()), ("langs", _TEXTS), ("sources", _TEXTS), ("sizes", pa.binary()), ("owners", pa.binary()), ("counts", pa.binary())])
_TERMS = pa.schema([("bucket", pa.int32()), ("lines", pa.binary()), ("langs", _TEXTS), ("sources", _TEXTS), ("numbers", pa.binary())])
_KEPT = pa.schema([("lang", pa.string()), ("term", pa.string()), ("n_docs", pa.int64()), ("n", pa.int64()), ("held", pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())])))])
PARTS = "lang string, source string, part string, item string, value long"


def pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def stable_order(codes: np.ndarray) -> np.ndarray:
    """The order of 32-bit codes, by two passes over 16 bits each, which numpy sorts by radix."""
    order = np.argsort((codes & 0xFFFF).astype(np.uint16), kind="stable")
    return order[np.argsort((codes >> 16).astype(np.uint16)[order], kind="stable")] if len(codes) and codes.max() > 0xFFFF else order


class _Batch:
    """Documents read so far: their groups, and for each distinct chunk its code."""

    def __init__(self, number: int):
        self.number, self.bytes = number, 0
        self.langs: list[str] = []
        self.sources: list[str] = []
        self.index: dict[bytes, int] = {}
        self.codes: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, lang: str, source: str, text: bytes) -> None:
        found = Counter(text.split())  # bytes split at blank, \t, \n, \v, \f and \r alone
        index = self.index
        self.codes.append(np.fromiter((index.setdefault(c, len(index)) for c in found), np.int32, len(found)))
        self.counts.append(np.fromiter(found.values(), np.uint32, len(found)))
        self.langs.append(lang)
        self.sources.append(source)
        self.bytes += len(text)

    def full_with(self, text: bytes) -> bool:
        return bool(self.langs) and (self.bytes + len(text) > BATCH_BYTES or len(self.langs) >= BATCH_DOCS)

    def rows(self) -> pa.RecordBatch:
        """The chunks of each bucket, one a line, and the postings in the order of those lines."""
        chunks = list(self.index)
        self.index.clear()
        bucket = np.fromiter((zlib.crc32(c) % BUCKETS for c in chunks), np.int32, len(chunks))
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(chunks), np.int32)
        place[order] = np.arange(len(chunks), dtype=np.int32)
        codes, counts = place[np.concatenate(self.codes)], np.concatenate(self.counts)
        owners = np.repeat(np.arange(len(self.codes), dtype=np.uint16), [len(c) for c in self.codes])
        sizes = np.bincount(codes, minlength=len(chunks)).astype(np.uint32)
        by_chunk = stable_order(codes)
        steps = np.diff(owners[by_chunk], prepend=np.uint16(0))  # small numbers, modulo 2**16
        rows = [(self.number, -1, None, self.langs, self.sources, *(pack(v.tobytes()) for v in (sizes, steps, counts[by_chunk])))]
        held, starts = np.unique(bucket[order], return_index=True)
        for b, lo, hi in zip(held.tolist(), starts.tolist(), [*starts.tolist()[1:], len(chunks)]):
            rows.append((self.number, b, pack(b"\n".join([chunks[i] for i in order[lo:hi].tolist()])), None, None, None, None, None))
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), _BATCH)], schema=_BATCH)


def _count_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of documents, batch by batch. Batches are numbered by task, so a task that is run again gives the same."""
    current = _Batch(TaskContext.get().partitionId() << 32)
    for part in slices(batches):
        for lang, source, text in zip(*(part.column(c).to_pylist() for c in ("lang", "source", "text"))):
            if current.full_with(text):
                yield current.rows()
                current = _Batch(current.number + 1)
            current.add(lang, source, text)
    if current.langs:
        yield current.rows()
    del current
    release_memory()


def _split_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The terms of each line in place of its chunk, with blanks between. Rows come by bucket; a chunk is split when it comes first."""
    bucket, known = None, {}
    for part in slices(batches, 500):
        lines = []
        for b, packed in zip(part.column("bucket").to_pylist(), part.column("lines").to_pylist()):
            if b != bucket:
                bucket, known = b, {}
            chunks = unpack(packed).split(b"\n")
            for c in chunks:
                if c not in known:
                    known[c] = b" ".join(TERM.findall(c.lower()))
            lines.append(pack(b"\n".join([known[c] for c in chunks])))
        yield pa.RecordBatch.from_arrays([part.column("batch"), part.column("bucket"), pa.array(lines, pa.binary())], ["batch", "bucket", "lines"])
    known.clear()
    release_memory()


def _count_terms(table: pa.Table) -> pa.Table:
    """Occurrences and documents of each term by language and source in one batch, from its terms by line and its postings; terms are dealt to buckets by their hash."""
    rows = sorted(table.to_pylist(), key=lambda r: r["bucket"])
    head, lines = rows[0], b"\n".join(unpack(r["lines"]) for r in rows[1:])
    sizes, owners, counts = (np.frombuffer(unpack(head[c]), t) for c, t in (("sizes", np.uint32), ("owners", np.uint16), ("counts", np.uint32)))
    # documents are numbered by group, so that an order by document is one by group too
    groups: dict[tuple[str, str], int] = {}
    group_of = np.array([groups.setdefault(g, len(groups)) for g in zip(head["langs"], head["sources"])], np.int32)
    by_group = np.argsort(group_of, kind="stable")
    rank = np.empty(len(by_group), np.int32)
    rank[by_group] = np.arange(len(by_group), dtype=np.int32)
    owners, group_of = rank[np.cumsum(owners, dtype=np.uint16)], group_of[by_group]
    index: dict[bytes, int] = {}
    code, line = array("i"), array("i")
    for i, terms in enumerate(lines.split(b"\n") if len(sizes) else []):
        for t in terms.split():
            code.append(index.setdefault(t, len(index)))
            line.append(i)
    del rows, table, lines
    if not code:
        return _TERMS.empty_table()
    terms = list(index)
    index.clear()
    # terms are renumbered by bucket, and lines put in the order of their terms
    bucket = np.fromiter((zlib.crc32(t) % BUCKETS for t in terms), np.int32, len(terms))
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(terms), np.int32)
    place[order] = np.arange(len(terms), dtype=np.int32)
    code, line = place[np.frombuffer(code, np.int32)], np.frombuffer(line, np.int32)
    by_term = stable_order(code)
    code, line = code[by_term], line[by_term]
    # the postings of each (line, term): those of the line's chunk
    starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    many = sizes[line].astype(np.int64)
    at = np.arange(many.sum()) + np.repeat(starts[line] - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
    n, key = counts[at], np.repeat(code.astype(np.int64) * len(group_of), many) + owners[at]
    del at
    if (key[1:] < key[:-1]).any():
        order_of_keys = np.argsort(key, kind="stable")  # nearly sorted, and quick for that
        key, n = key[order_of_keys], n[order_of_keys]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))  # of each (term, document)
    term, owner = np.divmod(key[first], len(group_of))
    n = np.add.reduceat(n.astype(np.int64), first)
    group = group_of[owner]
    first = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (group[1:] != group[:-1])]))
    term, group, n_docs, n = term[first], group[first], np.diff(first, append=len(group)), np.add.reduceat(n, first)
    labels, out = list(groups), []
    ordered = bucket[order]
    held, begins = np.unique(ordered, return_index=True)
    for b, lo, hi in zip(held.tolist(), begins.tolist(), [*begins.tolist()[1:], len(terms)]):
        part = slice(*np.searchsorted(term, [lo, hi]))
        names, local = np.unique(group[part], return_inverse=True)
        numbers = [term[part] - lo, local, n_docs[part], n[part]]
        named = [labels[g] for g in names.tolist()]
        out.append((b, pack(b"\n".join([terms[i] for i in order[lo:hi].tolist()])), [g[0] for g in named], [g[1] for g in named], pack(np.concatenate(numbers).astype(np.int64).tobytes())))
    return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*out), _TERMS)], schema=_TERMS)


class _Sums:
    """Documents and occurrences by term and group in one bucket of terms, added up as batches come."""

    def __init__(self):
        self.terms: dict[bytes, int] = {}
        self.groups: dict[tuple[str, str], int] = {}
        self.parts: list[np.ndarray] = []  # rows: key (term, group), documents, occurrences
        self.pending = 0

    def add(self, lines: bytes, langs: list[str], sources: list[str], numbers: bytes) -> None:
        terms = np.array([self.terms.setdefault(t, len(self.terms)) for t in lines.split(b"\n")], np.int64)
        groups = np.array([self.groups.setdefault(g, len(self.groups)) for g in zip(langs, sources)], np.int64)
        term, group, n_docs, n = np.frombuffer(numbers, np.int64).reshape(4, -1)
        self.parts.append(np.stack([terms[term] << 31 | groups[group], n_docs, n]))
        self.pending += len(n)
        if self.pending > PENDING:
            self.parts, self.pending = [self._added()], 0

    def _added(self) -> np.ndarray:
        key, n_docs, n = np.concatenate(self.parts, axis=1)
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        return np.stack([key[first], np.add.reduceat(n_docs[order], first), np.add.reduceat(n[order], first)])

    def kept(self, min_docs: int) -> list[tuple[str, str, int, int, list[dict]]]:
        """(lang, term, n_docs, n, held) of the terms in so many documents of a language."""
        if not self.parts:
            return []
        key, n_docs, n = self._added()
        labels, terms = list(self.groups), list(self.terms)
        codes: dict[str, int] = {}
        lang_of = np.array([codes.setdefault(lang, len(codes)) for lang, _ in labels], np.int64)
        term, group = key >> 31, key & ((1 << 31) - 1)
        order = np.lexsort((lang_of[group], term))
        term, group, n_docs, n = term[order], group[order], n_docs[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (lang_of[group][1:] != lang_of[group][:-1])]))
        docs, total, ends, out = np.add.reduceat(n_docs, first), np.add.reduceat(n, first), np.append(first[1:], len(term)), []
        for i in np.flatnonzero(docs >= min_docs).tolist():
            lo, hi = first[i], ends[i]
            held = [{"source": labels[g][1], "n": c} for g, c in zip(group[lo:hi].tolist(), n[lo:hi].tolist())]
            out.append((labels[group[lo]][0], terms[term[lo]].decode("utf-8", "replace"), int(docs[i]), int(total[i]), held))
        return out


def _add_batches(min_docs: int):
    """Kept terms of buckets of terms, whose rows come bucket by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = lambda rows: pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(list(zip(*rows)) or [[]] * len(_KEPT), _KEPT)], schema=_KEPT)
        bucket, sums = None, _Sums()
        for part in slices(batches, 200):
            for row in part.to_pylist():
                if row["bucket"] != bucket:
                    yield table(sums.kept(min_docs))
                    bucket, sums = row["bucket"], _Sums()
                sums.add(unpack(row["lines"]), row["langs"], row["sources"], unpack(row["numbers"]))
        yield table(sums.kept(min_docs))
        release_memory()

    return run


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term, n_docs, n and ``held`` (source, n) of the terms in at least ``min_docs`` documents of a language."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(text("lang").alias("lang"), text("source").alias("source"), text("text").cast("binary").alias("text"))
    batches = materialize(rows.mapInArrow(_count_chunks, BATCH), "chunk-postings")
    chunks = batches.filter(F.col("bucket") >= 0).select("batch", "bucket", "lines")
    terms = chunks.repartition("bucket").sortWithinPartitions("bucket", "batch").mapInArrow(_split_chunks, "batch long, bucket int, lines binary")
    both = batches.filter(F.col("bucket") < 0).unionByName(terms, allowMissingColumns=True)
    counted = both.groupBy("batch").applyInArrow(_count_terms, TERMS)
    kept = counted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_add_batches(min_docs), KEPT)
    return materialize(kept, "kept-terms")


def shares(counts: np.ndarray, total: int, n_terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * n_terms)), three decimal digits at a time, so that no product leaves 64 bits."""
    whole = total + PRIOR * n_terms
    if whole > (1 << 63) // 1000:
        raise OverflowError(f"{whole} occurrences are more than 64 bits can divide exactly")
    share, rest = np.zeros(len(counts), np.int64), counts + PRIOR
    for _ in range(3):  # SCALE is 1000 ** 3
        digits, rest = np.divmod(rest * 1000, max(whole, 1))
        share = share * 1000 + digits
    return 1 + share


def _compare(key: tuple, terms: pa.Table, groups: pa.Table) -> pa.Table:
    """Parts of one block of terms of a language: for the sources of one tile, sums over the block of the distance to each other source, and the terms that may be among the first."""
    lang, tile = key[0].as_py(), key[2].as_py()
    names, totals = groups["source"].to_pylist(), groups["total"].to_pylist()
    order = sorted(range(len(names)), key=lambda i: names[i].encode())
    names, totals = [names[i] for i in order], [totals[i] for i in order]
    n_terms, total = groups["n_terms"][0].as_py(), groups["lang_total"][0].as_py()
    place = {s: i for i, s in enumerate(names)}
    held = terms["held"].to_pylist() if terms.num_rows else []
    counts = np.zeros((len(names), len(held)), np.int64)
    for j, entries in enumerate(held):
        for e in entries:
            counts[place[e["source"]], j] = e["n"]
    p = np.stack([shares(c, t, n_terms) for c, t in zip(counts, totals)])
    q = shares(np.array(terms["n"].to_pylist() if held else [], np.int64), total, n_terms)
    items = terms["term"].to_pylist() if held else []
    source, part, item, value = [], [], [], []
    for i in range(tile * TILE_SOURCES, min((tile + 1) * TILE_SOURCES, len(names))):
        far = np.abs(p - p[i]).sum(axis=1)
        others = [j for j in range(len(names)) if j != i]
        above = np.flatnonzero((counts[i] > 0) & (p[i] > q))
        gain = p[i][above] - q[above]
        if len(above) > TOP_TERMS:  # equal values may all be among the first
            least = np.partition(gain, len(gain) - TOP_TERMS)[len(gain) - TOP_TERMS]
            above, gain = above[gain >= least], gain[gain >= least]
        source += [names[i]] * (len(others) + len(above))
        part += ["pair"] * len(others) + ["term"] * len(above)
        item += [names[j] for j in others] + [items[j] for j in above]
        value += far[others].tolist() + gain.tolist()
    text = lambda v: pa.array(v, pa.string())
    return pa.table({"lang": text([lang] * len(source)), "source": text(source), "part": text(part), "item": text(item), "value": pa.array(value, pa.int64())})


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source of a language is from every other, and the terms it has most above the language.

    ``top`` is at most TOP_TERMS, as tasks keep so many of each block.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    kept = term_counts(docs, min_docs)
    counted = kept.select("lang", F.explode("held").alias("h")).groupBy("lang", F.col("h.source").alias("source")).agg(F.sum("h.n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = docs.select(text("lang"), text("source")).distinct().join(counted, ["lang", "source"], "left").withColumn("total", F.coalesce("total", zero))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("n_terms"))
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.count("*").alias("n_sources")).join(sizes, "lang", "left")
    langs = langs.withColumn("n_terms", F.coalesce("n_terms", zero))
    langs = materialize(langs.withColumns({"blocks": F.greatest(F.lit(1), F.ceil(F.col("n_terms") / BLOCK_TERMS)).cast("long"), "tiles": F.ceil(F.col("n_sources") / TILE_SOURCES).cast("long")}), "languages")
    langs = small_side(langs)  # one row for each language
    tile = F.explode(F.sequence(zero, F.col("tiles") - 1)).alias("tile")
    terms = kept.join(langs.select("lang", "blocks", "tiles"), "lang").select("lang", F.pmod(F.xxhash64("term"), "blocks").alias("block"), tile, "term", "n", "held")
    copies = groups.join(langs, "lang").select("lang", F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("block"), "tiles", "source", "total", "n_terms", "lang_total")
    copies = copies.select("lang", "block", tile, "source", "total", "n_terms", "lang_total")
    keys = ["lang", "block", "tile"]
    parts = terms.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInArrow(_compare, PARTS)
    added = parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))  # a term lies in one block
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = added.withColumn("rank", F.row_number().over(order)).filter((F.col("part") == "pair") | (F.col("rank") <= top))
    return ranked.select("lang", "source", "part", "item", "value", "rank")
