"""Fill-in-the-middle transformation by content-defined chunks.

A text is cut at two code points drawn from its doc_id and written with sentinels,
so that a model learns to fill the middle. Where code point k begins is found by
chunks: a rolling hash over the UTF-8 bytes cuts a text where its content says so, so
texts that share passages share chunks. What a chunk adds (``Summary``) is kept in a
cache whose key is the chunk's bytes, so an equal hash alone never makes two chunks
the same. Sums of the code points that begin in each chunk give n and the chunk that
holds a cut, and only that chunk is searched for the byte.

Defined cases: a null or empty text is form ``plain`` with n = 0; a null doc_id counts
as an empty one in the hash; rows that repeat give equal rows; an empty table gives an
empty one; texts of any length are cut as a whole; further columns are left out.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CACHES, slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
PLAIN_FROM, SPM_BELOW = 90, 20

#: Chunks have MIN_CHUNK to MAX_CHUNK bytes (the last may have fewer), some 400 on average.
WINDOW, MIN_CHUNK, MAX_CHUNK, MASK = 32, 64, 2048, 0xFF
#: Bytes of chunks that a worker keeps before it forgets them all.
CACHE_BYTES = 24 << 20

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

_GEAR = np.random.default_rng(13).integers(0, 1 << 63, 256, dtype=np.uint64)
_IS_LEAD = (np.arange(256) & 0xC0) != 0x80
_LENGTH = np.select([np.arange(256) >= 0xF0, np.arange(256) >= 0xE0, np.arange(256) >= 0xC0], [4, 3, 2], 1)


class Summary(NamedTuple):
    """What a chunk adds to its text: code points that begin in it, bytes at its start that end an earlier one, bytes its last one lacks."""

    leads: int
    head: int
    lacks: int


def summarize(chunk: bytes) -> Summary:
    if chunk.isascii():
        return Summary(len(chunk), 0, 0)
    data = np.frombuffer(chunk, np.uint8)
    leads = np.flatnonzero(_IS_LEAD[data])
    if not len(leads):
        return Summary(0, len(chunk), 0)
    last = int(leads[-1])
    return Summary(len(leads), int(leads[0]), max(0, int(_LENGTH[data[last]]) - (len(chunk) - last)))


def joined(first: Summary, second: Summary) -> Summary:
    """The summary of two chunks that follow each other."""
    if not second.leads:
        return Summary(first.leads, first.head + (0 if first.leads else second.head), max(0, first.lacks - second.head))
    return Summary(first.leads + second.leads, first.head if first.leads else first.head + second.head, second.lacks)


class ChunkMemo:
    """Summaries by content."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.size, self.hits = limit, 0, 0
        self.known: dict[bytes, Summary] = {}

    def __call__(self, chunk: bytes) -> Summary:
        found = self.known.get(chunk)
        if found is not None:
            self.hits += 1
            return found
        if self.size > self.limit or not self.known:
            self.known.clear()
            self.size = 0
        found = self.known[chunk] = summarize(chunk)
        self.size += len(chunk) + 200
        return found


_memo = ChunkMemo()
CACHES.append(_memo.known)


def cut_places(data: np.ndarray) -> np.ndarray:
    """Ends that the rolling hash of the last WINDOW bytes allows for chunks, ascending."""
    h = _GEAR[data]
    width = 1
    while width < WINDOW:  # the hash of 2w bytes from two of w
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint64(width)
        h, width = wider, width * 2
    return np.flatnonzero((h >> np.uint64(40)) & np.uint64(MASK) == 0) + 1


def chunk_ends(places: np.ndarray, lo: int, hi: int) -> list[int]:
    """Ends of the chunks of the text in bytes lo to hi. A window never reaches beyond the text, as no chunk is shorter than it."""
    mine = places[np.searchsorted(places, lo + MIN_CHUNK) : np.searchsorted(places, hi)].tolist()
    ends, at = [], lo
    for place in mine:
        while place - at > MAX_CHUNK:
            at += MAX_CHUNK
            ends.append(at)
        if place - at >= MIN_CHUNK:
            at = place
            ends.append(at)
    while hi - at > MAX_CHUNK:
        at += MAX_CHUNK
        ends.append(at)
    if hi > at:
        ends.append(hi)
    return ends


def byte_of(text: bytes, starts: list[int], before: list[int], k: int) -> int:
    """Where code point ``k`` begins: ``before`` are the code points that begin before each chunk, and in all."""
    if k >= before[-1]:
        return len(text)
    i = bisect_right(before, k) - 1
    chunk, rest = text[starts[i] : starts[i + 1]], k - before[i]
    if chunk.isascii():
        return starts[i] + rest
    return starts[i] + int(np.flatnonzero(_IS_LEAD[np.frombuffer(chunk, np.uint8)])[rest])


def draws(doc_id: int | None) -> list[int]:
    digest = hashlib.sha256(b"1:" + (b"" if doc_id is None else str(doc_id).encode())).hexdigest()
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


def transform(doc_id: int | None, text: bytes, ends: list[int], memo: ChunkMemo) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of a text whose chunks end at ``ends``."""
    starts = [0, *ends]
    found = [memo(text[a:b]) for a, b in zip(starts, ends)]
    before = [0, *accumulate(s.leads for s in found)]
    n = before[-1]
    h1, h2, h3, h4 = draws(doc_id)
    if not text or h3 % 100 >= PLAIN_FROM or any(s in text for s in SENTINELS):
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = byte_of(text, starts, before, low), byte_of(text, starts, before, high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SPM_BELOW:
        return n, "spm", low, high - low, b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", low, high - low, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def _transform_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 500):
        ids = batch.column("doc_id").to_pylist()
        texts = [t or b"" for t in batch.column("text").to_pylist()]
        data = np.frombuffer(b"".join(texts), np.uint8)
        places = cut_places(data)
        rows, lo = [], 0
        for doc_id, text in zip(ids, texts):
            ends = [e - lo for e in chunk_ends(places, lo, lo + len(text))]
            rows.append((doc_id, *transform(doc_id, text, ends, _memo)))
            lo += len(text)
        columns = list(zip(*rows))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays([*arrays[:5], arrays[5].view(pa.string())], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the output text of every document."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(_transform_batches, SCHEMA)


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made from. A text with a sentinel stays plain, and no sentinel ends as another begins, so the parts are exact."""
    parts = F.split(output, "<[PSM]>", -1)
    part = lambda i: F.try_element_at(parts, F.lit(i))
    return F.when(form == "psm", F.concat(part(2), part(4), part(3))).when(form == "spm", F.concat(part(3), part(4), part(2))).otherwise(output)
