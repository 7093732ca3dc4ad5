"""Quality by compression (operator 6).

One zstandard dictionary is trained on blocks of good labelled text and one on
blocks of bad labelled text. A text is compressed block by block with either;
the normalised difference of the two sizes, with the normalised size itself (it
gives away text that repeats one word), is turned into a probability by a
logistic calibration fitted on labelled documents that neither dictionary saw.

Defined cases: a null or empty text gets the score of equal sizes; labels that
are null or neither 0 nor 1 are not learned from; without labels of both
classes every score is 0.5; repeated rows are scored once each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder

#: Bound of the labelled sample: documents and 1 KB blocks of each class.
SAMPLE_DOCS = 4000
SAMPLE_BLOCKS = 8000
TRAIN_BLOCK = 1024
DICTIONARY_BYTES = 112_640
#: Texts are compressed in blocks of so many bytes, so that a dictionary counts to the end of a long text.
BLOCK = 256
LEVEL = 3
#: A score of at least this is a prediction of 1.
THRESHOLD = 0.3
MODULUS = 5


def blocks(text: str | None, size: int) -> list[bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return [raw[i : i + size] for i in range(0, len(raw), size)]


class Sizer:
    """Compressed sizes of a text with the two dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.compressors = []
        for data in (good, bad):
            dictionary = zstandard.ZstdCompressionDict(data)
            dictionary.precompute_compress(level=LEVEL)
            self.compressors.append(
                zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False)
            )

    def features(self, text: str | None) -> tuple[float, float]:
        """(bad - good) / larger, and the good size for each byte, both 0 if empty; the latter no more than 1/2."""
        parts = blocks(text, BLOCK)
        if not parts:
            return 0.0, 0.5
        good, bad = (sum(map(len, map(c.compress, parts))) for c in self.compressors)
        return (bad - good) / max(good, bad), min(0.5, good / sum(map(len, parts)))


@dataclass(frozen=True)
class CompressionClassifier:
    """Dictionaries and calibration; ``None`` for the dictionaries stands for "nothing learned"."""

    good: bytes | None
    bad: bytes | None
    weights: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)

    def probability(self, difference: float, ratio: float) -> float:
        z = sum(w * x for w, x in zip(self.weights, _terms(difference, ratio), strict=True))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))

    def score(self, docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
        """doc_id, score and predicted for every row; narrow, no shuffle."""
        model = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sizer = Sizer(model.good, model.bad) if model.good is not None else None
            for batch in batches:
                scores = [model.probability(*sizer.features(x.as_py())) if sizer else 0.5 for x in batch.column(1)]
                columns = [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted"])

        return _picked(docs).mapInArrow(run, "doc_id long, score double, predicted int")


def _terms(difference: float, ratio: float) -> tuple[float, ...]:
    """Calibration inputs: constant, difference, and how far the size is below what prose reaches."""
    return 1.0, 10 * difference, 10 * max(0.0, 0.2 - ratio), 10 * min(0.0, difference)


def _picked(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _sample_blocks(texts: DataFrame, limit: int) -> list[bytes]:
    """At most ``limit`` blocks of the texts, chosen by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(doc, i, b) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)) for i, b in enumerate(blocks(text.as_py(), TRAIN_BLOCK))]
            ids, numbers, data = zip(*found) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(numbers, pa.int64()), pa.array(data, pa.binary())], ["doc_id", "number", "block"])

    cut = texts.select("doc_id", "text").mapInArrow(run, "doc_id long, number long, block binary")
    rows = cut.orderBy(F.xxhash64("doc_id", "number"), "doc_id", "number").limit(limit).select("block").collect()
    return [bytes(r.block) for r in rows]


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; too few samples for training serve as they are."""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES] or b" "


def _calibrate(points: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, ...]:
    """Weighted logistic regression by Newton steps with a small ridge."""
    beta = np.zeros(points.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(points @ beta, -30, 30)))
        gradient = points.T @ (weights * (labels - p)) - 1e-2 * beta
        hessian = (points * (weights * p * (1 - p))[:, None]).T @ points + 1e-2 * np.eye(len(beta))
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(map(float, beta))


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_blocks: int = SAMPLE_BLOCKS) -> CompressionClassifier:
    """Learn from labels whose crc32(doc_id) mod 5 is not 0.

    At most ``sample_docs`` labels of either class are used, chosen by a hash
    of the id; of these, remainders 1 to 3 feed the dictionaries (at most
    ``sample_blocks`` blocks a class) and remainder 4 the calibration, weighted
    back to the classes' counts over all labels.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter(
        F.col("quality").isin(0, 1) & (remainder(F.col("doc_id"), MODULUS) != 0)
    )
    counts = {r.quality: r["count"] for r in usable.groupBy("quality").count().collect()}
    if len(counts) < 2:
        return CompressionClassifier(None, None)
    picked = [usable.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs) for q in (0, 1)]
    sample = picked[0].unionByName(picked[1]).withColumn("part", remainder(F.col("doc_id"), MODULUS))
    texts = _picked(docs).join(F.broadcast(sample), "doc_id")  # at most 2 * sample_docs narrow rows
    learned = {q: _sample_blocks(texts.filter((F.col("part") != MODULUS - 1) & (F.col("quality") == q)), sample_blocks) for q in (0, 1)}
    if not learned[0] or not learned[1]:
        return CompressionClassifier(None, None)
    good, bad = _dictionary(learned[1]), _dictionary(learned[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizer = Sizer(good, bad)
        for batch in batches:
            found = [sizer.features(x.as_py()) for x in batch.column(0)]
            differences, ratios = zip(*found) if found else ([], [])
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(differences, pa.float64()), pa.array(ratios, pa.float64())], ["quality", "difference", "ratio"])

    measured = texts.filter(F.col("part") == MODULUS - 1).select("text", "quality").mapInArrow(run, "quality int, difference double, ratio double").collect()
    labelled = np.array([r.quality for r in measured], float)
    if len(set(labelled)) < 2:
        return CompressionClassifier(good, bad, (1.0, 1.0, 0.0, 0.0))
    points = np.array([_terms(r.difference, r.ratio) for r in measured])
    share = {q: counts[q] / (labelled == q).sum() for q in (0, 1)}
    weights = np.where(labelled == 1, share[1], share[0])
    return CompressionClassifier(good, bad, _calibrate(points, labelled, weights / weights.mean()))
