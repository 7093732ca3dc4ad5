"""Removal of passages that an earlier document holds (operator 9).

A window of 50 words that two documents share also shares its anchor: the
16-word run in it with the lowest hash. Anchors are found in one pass; where an
anchor occurs in several documents, the stretch of words whose windows have it
as their anchor becomes a segment, and segments are dealt to shards by anchor,
so that equal windows meet. Each shard builds an FM-index of its segments, equal
ones as one sequence with the smallest document as its owner, and streams the
segments through it: backward search over the wavelet matrix gives the length
matched in documents with a smaller id, and windows matched in full are reported
as intervals. A sequence is asked once for its owner and once for all later
documents that hold it. Documents with equal words are one document with several
owners and are indexed and searched once.

The segments of an anchor with more than HOT_ANCHOR places do not fit one shard.
Such an anchor is dealt to many shards by the words around it: its segments are
cut into single windows, equal ones are added up map-side to one sequence with
its first owner, and the shards of these answer in the same way.

Words in segments are 48-bit hashes, so windows that differ in a single word
are taken for equal with a chance of 2**-48.

Defined cases: a null text has no words; texts of fewer than 50 words lose
nothing; a long text is cut whole; of anchors that tie in a window the first is
taken; repeated rows get equal results and do not remove each other; rows
that share a doc_id are one document for the comparison, and each has its own
result; rows with a null doc_id lose nothing and remove nothing; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release_memory, salted_join, slices
from .fm_index import FMIndex
from .shingles import rolling, word_hashes

WINDOW = 50
GRAM = 16
#: Words that a shard's segments are laid out for.
SHARD_WORDS = 800_000
#: Places of an anchor beyond which it is dealt to many shards, window by window.
HOT_ANCHOR = 15_000
#: Bytes of a word's hash in a segment.
WORD_BYTES = 6


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()  # of bytes: ASCII white space only


def sequence_hash(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def packed(hashes: np.ndarray) -> bytes:
    """The low bytes of some words' hashes."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // WORD_BYTES, 8), np.uint8)
    wide[:, :WORD_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, WORD_BYTES)
    return wide.view("<u8").ravel()


def window_anchors(grams: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """For each window of words the place of its anchor."""
    per_window = window - gram + 1
    if len(grams) < per_window:
        return np.zeros(0, np.int64)
    found = np.empty(len(grams) - per_window + 1, np.int64)
    for lo in range(0, len(found), 65536):  # bounds the memory for very long texts
        part = grams[lo : lo + 65536 + per_window - 1]
        view = np.lib.stride_tricks.sliding_window_view(part, per_window)
        found[lo : lo + len(view)] = view.argmin(axis=1) + np.arange(len(view)) + lo
    return found


def _picked(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def anchors(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, seq, anchors, places) of the texts with at least one window; seq is a hash of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, seqs, hashes, places = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                if len(words) >= window:
                    grams = rolling(word_hashes(words), GRAM)
                    at = np.unique(window_anchors(grams, window))
                    ids.append(doc)
                    seqs.append(sequence_hash(words))
                    hashes.append(grams[at].view(np.int64))
                    places.append(at.astype(np.int32))
            columns = [pa.array(ids, pa.int64()), pa.array(seqs, pa.binary()), pa.array(hashes, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "seq", "anchors", "places"])

    usable = _picked(docs).filter(F.col("doc_id").isNotNull())
    return usable.mapInArrow(run, "doc_id long, seq binary, anchors array<long>, places array<int>")


def _segments(words: np.ndarray, shared: dict[int, tuple[int, bool]], window: int) -> Iterator[tuple[int, int, int]]:
    """(anchor place, first window start, last window start) for the anchors asked for."""
    at = window_anchors(rolling(words, GRAM), window)
    cuts = np.flatnonzero(np.r_[True, at[1:] != at[:-1], True])
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if int(at[lo]) in shared:
            yield int(at[lo]), lo, hi - 1


def _cut(joined: DataFrame, shards: int, window: int) -> DataFrame:
    """Segments of each document with shared anchors. Those of hot anchors come as single windows with their hash, and no shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "doc_id", "seq", "start", "seed", "last", "first_doc", "words", "hash"]
        types = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int64()]
        for batch in slices(batches):
            rows = []
            for doc, seq, text, found in zip(batch.column("doc_id").to_pylist(), batch.column("seq").to_pylist(), batch.column("text"), batch.column("shared")):
                words = words_of(text.as_py())
                if len(words) < window or sequence_hash(words) != seq:
                    continue  # another text under the same doc_id
                shared = {x["place"]: (x["first_doc"], x["hot"], x["anchor"]) for x in found.as_py()}
                hashes = word_hashes(words)
                for place, lo, hi in _segments(hashes, shared, window):
                    first, hot, anchor = shared[place]
                    if hot:
                        whole = rolling(hashes[lo : hi + window], window).view(np.int64).tolist()
                        rows += [(None, doc, seq, s, place - s, 0, first, packed(hashes[s : s + window]), h) for s, h in enumerate(whole, lo)]
                    else:
                        rows.append((anchor % shards, doc, seq, lo, place - lo, hi - lo, first, packed(hashes[lo : hi + window]), None))
            columns = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    schema = "shard long, doc_id long, seq binary, start int, seed int, last int, first_doc long, words binary, hash long"
    return joined.select("doc_id", "seq", "text", "shared").mapInArrow(run, schema)


def _intervals(starts: np.ndarray, window: int) -> Iterator[tuple[int, int]]:
    """Window starts as intervals; overlapping or touching windows are one."""
    cuts = np.flatnonzero(np.r_[True, starts[1:] > starts[:-1] + window])
    for lo, hi in zip(starts[cuts].tolist(), starts[np.r_[cuts[1:], len(starts)] - 1].tolist()):
        yield lo, hi + window


def _search(rows: pd.DataFrame, window: int) -> pd.DataFrame:
    """Intervals of one shard: (doc_id, seq, lo, hi), hi exclusive."""
    # equal segments are one sequence, owned by the smallest document that holds it
    keys = [w + int(s).to_bytes(4, "little") for w, s in zip(rows["words"], rows["seed"])]
    codes, _ = pd.factorize(pd.Series(keys, dtype=object))
    docs, first = rows["doc_id"].to_numpy(), rows["first_doc"].to_numpy()
    order = np.lexsort((docs, codes))
    head = order[np.flatnonzero(np.r_[True, codes[order][1:] != codes[order][:-1]])]  # by code
    later = np.zeros(len(head), bool)
    later[codes[docs > docs[head][codes]]] = True
    own, others = np.flatnonzero(docs[head] > first[head]), np.flatnonzero(later)
    asked = np.r_[own, others]
    out: list[tuple[int, bytes, int, int]] = []
    if len(asked):
        index = FMIndex([unpacked(rows["words"].iat[i]) for i in head], docs[head])
        pick = head[asked]
        below = np.r_[docs[head[own]], docs[head[others]] + 1]  # owners that count are smaller than this
        found = index.matching_starts(asked, below, rows["seed"].to_numpy()[pick].astype(np.int64), GRAM, rows["last"].to_numpy()[pick].astype(np.int64), window)
        for_owner, for_later = dict(zip(own.tolist(), found)), dict(zip(others.tolist(), found[len(own) :]))
        begin, seqs, none = rows["start"].to_numpy(), rows["seq"], np.zeros(0, np.int64)
        for i, code in enumerate(codes.tolist()):
            at = (for_later if docs[i] > docs[head[code]] else for_owner).get(code, none)
            if len(at):
                out += [(docs[i], seqs.iat[i], begin[i] + lo, begin[i] + hi) for lo, hi in _intervals(at, window)]
        del index
    release_memory()
    return pd.DataFrame(out, columns=["doc_id", "seq", "lo", "hi"])


def _confirm(rows: pd.DataFrame, window: int) -> pd.DataFrame:
    """The windows of one shard, one sequence each, that documents after their owner hold: (hash, first)."""
    index = FMIndex([unpacked(w) for w in rows["words"]], rows["first"].to_numpy())
    asked = np.arange(len(rows))
    found = index.matching_starts(asked, rows["first"].to_numpy() + 1, rows["seed"].to_numpy().astype(np.int64), GRAM, np.zeros(len(rows), np.int64), window)
    return rows.loc[[len(x) > 0 for x in found], ["hash", "first"]]


def _hot_intervals(hot: DataFrame, window: int) -> DataFrame:
    """Intervals of the windows of hot anchors. Equal windows are added up map-side; those of several documents are indexed and searched."""
    equal = hot.groupBy("hash").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last_doc"), F.min("seed").alias("seed"), F.min("words").alias("words"))
    equal = materialize(equal.filter(F.col("first") < F.col("last_doc")).drop("last_doc"), "hot-windows")
    shards = max(1, -(-equal.count() * (window + 1) // SHARD_WORDS))
    dealt = equal.withColumn("shard", F.pmod("hash", F.lit(shards)))
    confirmed = dealt.groupBy("shard").applyInPandas(lambda rows: _confirm(rows, window), "hash long, first long")
    places = salted_join(hot.select("hash", "doc_id", "seq", "start"), confirmed, ["hash"], ["doc_id"])
    return places.filter(F.col("doc_id") > F.col("first")).select("doc_id", "seq", F.col("start").alias("lo"), (F.col("start") + window).alias("hi"))


def repeated_intervals(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, seq, lo, hi): word intervals that documents with smaller ids hold too; hi is null where the whole text is a copy."""
    table = materialize(anchors(docs, window), "anchors")
    classes = materialize(table.groupBy("seq").agg(F.min("doc_id").alias("rep")), "anchor-classes")
    copies = salted_join(table.select("doc_id", "seq"), classes, ["seq"], ["doc_id"]).filter(F.col("doc_id") != F.col("rep")).select("doc_id", "seq").distinct()
    single = table.join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "seq"], "left_semi").dropDuplicates(["doc_id", "seq"])
    places = single.select("doc_id", "seq", F.explode(F.arrays_zip("anchors", "places")).alias("x")).select("doc_id", "seq", F.col("x.anchors").alias("anchor"), F.col("x.places").alias("place"))
    places = materialize(places, "anchor-places")
    shared = places.groupBy("anchor").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")).filter(F.col("first_doc") < F.col("last_doc"))
    shared = materialize(shared.select("anchor", "n", "first_doc"), "anchor-shared")
    total = shared.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total * 70 // SHARD_WORDS))
    asked = salted_join(places, shared, ["anchor"], ["doc_id"]).select("doc_id", "seq", F.struct("place", "anchor", "first_doc", (F.col("n") > HOT_ANCHOR).alias("hot")).alias("x"))
    asked = asked.groupBy("doc_id", "seq").agg(F.collect_list("x").alias("shared"))  # a document's own anchors
    segments = materialize(_cut(_picked(docs).join(asked, "doc_id"), shards, window), "segments")
    found = segments.filter(F.col("shard").isNotNull()).groupBy("shard").applyInPandas(lambda rows: _search(rows, window), "doc_id long, seq binary, lo int, hi int")
    late = _hot_intervals(segments.filter(F.col("shard").isNull()), window)
    whole = copies.select("doc_id", "seq", F.lit(0).alias("lo"), F.lit(None).cast("int").alias("hi"))
    return found.unionByName(late).unionByName(whole)


def drop_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row for each document: doc_id, n_words, n_removed and text (the words kept, joined by one blank)."""
    gone = repeated_intervals(docs, window).groupBy("doc_id", "seq").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))  # of one document
    gone = materialize(gone.groupBy("doc_id").agg(F.collect_list(F.struct("seq", "spans")).alias("_gone")), "repeats")
    joined = _picked(docs).join(gone, "doc_id", "left").select("doc_id", "text", "_gone")  # both grow with the corpus: a shuffle at every size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            total, removed, kept = [], [], []
            for text, found in zip(batch.column(1), batch.column(2)):
                words = words_of(text.as_py())
                total.append(len(words))
                spans = found.as_py()
                if spans:
                    seq = sequence_hash(words)
                    cut = np.zeros(len(words), bool)
                    for group in spans:
                        if group["seq"] == seq:
                            for span in group["spans"]:
                                cut[span["lo"] : span["hi"]] = True
                    words = [w for w, c in zip(words, cut.tolist()) if not c]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            columns = [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "text"])

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, text string")
