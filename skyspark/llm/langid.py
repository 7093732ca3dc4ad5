"""Language identification by a bidirectional gated recurrent network over bytes (operator 1).

A text's UTF-8 bytes are cut into windows of 64. In every window one gated
network reads forwards and one backwards; the two states at a position label
that position, and a document's probabilities are the mean over all its
positions. The network is trained in numpy by backpropagation through time on a
bounded sample of labelled windows; squashing is by x / (1 + |x|), which keeps
a step to a few vector operations on thousands of windows at once.

Defined cases: a null text or one without a letter is ``und`` with score 0; of
languages that tie the first in order is taken; a long text is labelled whole,
a bounded number of windows at a time; rows without a language or labelled ``und`` are not
learned from; if nothing can be learned every text is ``und``; a row is learned with its
own language, whatever other rows of its doc_id say, and a row given twice counts twice;
repeated rows are labelled once each; an empty table gives an empty result; further columns are ignored by
``predict`` and kept by ``annotate``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, remainder, slices

UNKNOWN = "und"
STEPS = 64
HIDDEN = 8
#: Windows that go through the network together.
LANES = 4096
#: Bounds of the training sample: documents of each language, windows in all (but one of each language at least).
SAMPLE_DOCS = 400
SAMPLE_WINDOWS = 12_000
#: Groups of tasks in which documents are picked before they are picked from all.
GROUPS = 512
EPOCHS = 5
BATCH = 256
MODULUS, HELD_OUT = 3, 1


def squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|) in place."""
    y = np.abs(x)
    y += 1
    x /= y
    return x


@dataclass(frozen=True)
class Direction:
    """Weights of one reading direction: from the byte and from the state to update gate, reset gate and candidate."""

    byte: np.ndarray  # 256 x 3H
    state: np.ndarray  # H x 3H

    def read(self, rows: np.ndarray, backwards: bool, keep: list | None = None) -> np.ndarray:
        """States at every position, position first. ``keep`` collects what training needs."""
        steps, lanes = rows.shape
        hidden = self.state.shape[0]
        states = np.empty((steps, lanes, hidden), np.float32)
        h = np.zeros((lanes, hidden), np.float32)
        for t in range(steps - 1, -1, -1) if backwards else range(steps):
            x = self.byte.take(rows[t], axis=0)
            u = h @ self.state
            x[:, : 2 * hidden] += u[:, : 2 * hidden]
            gates = squash(x[:, : 2 * hidden])
            gates *= 0.5
            gates += 0.5
            update, reset = gates[:, :hidden], gates[:, hidden:]
            candidate = squash(x[:, 2 * hidden :] + reset * u[:, 2 * hidden :])
            if keep is not None:
                keep.append((t, h, update, reset, u[:, 2 * hidden :], candidate))
            h = h + update * (candidate - h)
            states[t] = h
        return states

    def gradients(self, rows: np.ndarray, outer: np.ndarray, keep: list) -> tuple[np.ndarray, np.ndarray]:
        """Backpropagation through time of the gradient at every state."""
        hidden = self.state.shape[0]
        by_byte, by_state = np.zeros_like(self.byte), np.zeros_like(self.state)
        carry = np.zeros(outer.shape[1:], np.float32)
        for t, h, update, reset, inner, candidate in reversed(keep):
            g = outer[t] + carry
            g_candidate = g * update * (1 - np.abs(candidate)) ** 2
            g_update = g * (candidate - h) * 0.5 * (1 - np.abs(2 * update - 1)) ** 2
            g_reset = g_candidate * inner * 0.5 * (1 - np.abs(2 * reset - 1)) ** 2
            g_x = np.concatenate([g_update, g_reset, g_candidate], axis=1)
            g_u = np.concatenate([g_update, g_reset, g_candidate * reset], axis=1)
            for k in range(3 * hidden):
                by_byte[:, k] += np.bincount(rows[t], g_x[:, k], 256)
            by_state += h.T @ g_u
            carry = g * (1 - update) + g_u @ self.state.T
        return by_byte, by_state


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes in windows (rows), the bytes that count in each, and the text each is from; a text without bytes has no window."""
    sizes = np.array(list(map(len, texts)), np.int64)
    per_text = -(-sizes // STEPS)
    start = np.r_[0, np.cumsum(per_text)]
    buffer = np.zeros(int(start[-1]) * STEPS, np.uint8)
    for text, at in zip(texts, (start * STEPS).tolist()):
        buffer[at : at + len(text)] = np.frombuffer(text, np.uint8)
    counts = np.full(int(start[-1]), STEPS, np.int64)
    filled = per_text > 0
    counts[start[1:][filled] - 1] = (sizes - (per_text - 1) * STEPS)[filled]
    return buffer.reshape(-1, STEPS), counts, np.repeat(np.arange(len(texts)), per_text)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    forwards: Direction
    backwards: Direction
    out: np.ndarray  # 2H x languages
    bias: np.ndarray

    @classmethod
    def start(cls, languages: tuple[str, ...], hidden: int = HIDDEN) -> LanguageModel:
        rng = np.random.default_rng(0)
        draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        return cls(languages, Direction(draw(256, 3 * hidden), draw(hidden, 3 * hidden)), Direction(draw(256, 3 * hidden), draw(hidden, 3 * hidden)), draw(2 * hidden, len(languages)), np.zeros(len(languages), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.forwards.byte, self.forwards.state, self.backwards.byte, self.backwards.state, self.out, self.bias]

    def positions(self, rows: np.ndarray, keep: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of the languages at every position of the windows (position first), and the states."""
        hidden = self.out.shape[0] // 2
        ahead = self.forwards.read(rows, False, keep and keep[0])
        back = self.backwards.read(rows, True, keep and keep[1])
        p = ahead @ self.out[:hidden]
        p += back @ self.out[hidden:]
        p += self.bias
        p -= p.max(axis=2, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=2, keepdims=True)
        return p, ahead, back

    def label_positions(self, text: str) -> list[str]:
        """The language of every byte of a text."""
        rows, counts, _ = windows([text.encode("utf-8", "surrogatepass")])
        if not len(rows):
            return []
        best = self.positions(np.ascontiguousarray(rows.T))[0].argmax(axis=2).T
        return [self.languages[k] for row, n in zip(best, counts.tolist()) for k in row[:n]]

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities over all positions of each text."""
        rows, counts, owner = windows(texts)
        total = np.zeros((len(texts), len(self.languages)))
        for lo in range(0, len(rows), LANES):
            part, n = np.ascontiguousarray(rows[lo : lo + LANES].T), counts[lo : lo + LANES]
            p, _, _ = self.positions(part)
            short = np.flatnonzero(n < STEPS)
            summed = p.sum(axis=0)
            for k in short.tolist():
                summed[k] = p[: n[k], k].sum(axis=0)
            for k in range(len(self.languages)):
                total[:, k] += np.bincount(owner[lo : lo + LANES], summed[:, k], len(texts))
        return total / np.maximum(1, np.array(list(map(len, texts))))[:, None]

    def train(self, rows: np.ndarray, counts: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS) -> None:
        """Adam on the cross-entropy of every position, in place."""
        rng = np.random.default_rng(1)
        first = [np.zeros_like(p) for p in self.parameters()]
        second = [np.zeros_like(p) for p in self.parameters()]
        hidden, step, steps = self.out.shape[0] // 2, 0, epochs * -(-len(rows) // BATCH)
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for lo in range(0, len(order), BATCH):
                pick = order[lo : lo + BATCH]
                part = np.ascontiguousarray(rows[pick].T)
                keep: tuple[list, list] = ([], [])
                g, ahead, back = self.positions(part, keep)
                g[:, np.arange(len(pick)), labels[pick]] -= 1
                counted = np.arange(STEPS)[:, None] < counts[pick][None, :]
                g *= counted[:, :, None] / counted.sum()
                g = g.astype(np.float32)
                flat = g.reshape(-1, g.shape[2])
                by_out = np.concatenate([ahead.reshape(-1, hidden).T @ flat, back.reshape(-1, hidden).T @ flat])
                ahead_byte, ahead_state = self.forwards.gradients(part, g @ self.out[:hidden].T, keep[0])
                back_byte, back_state = self.backwards.gradients(part, g @ self.out[hidden:].T, keep[1])
                step += 1
                rate = 0.02 * (1 - step / (steps + 1))
                for p, d, m, v in zip(self.parameters(), [ahead_byte, ahead_state, back_byte, back_state, by_out, flat.sum(axis=0)], first, second):
                    d = d * min(1.0, 1.0 / (np.linalg.norm(d) + 1e-9))
                    m += 0.1 * (d - m)
                    v += 0.01 * (d * d - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)

    def predict(self, docs: DataFrame) -> DataFrame:
        """doc_id, lang_pred and score of every row; narrow, no shuffle."""
        model = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                langs, scores = model.label([x.as_py() for x in batch.column(1)])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

        return _picked(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")

    def annotate(self, docs: DataFrame, pred: str = "lang_pred", score: str = "lang_score") -> DataFrame:
        """``docs`` with all its columns, the predicted language and its score; narrow, no shuffle."""
        model = self
        docs = docs.drop(pred, score).withColumn("text", F.col("text").cast("string"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                langs, scores = model.label(batch.column("text").to_pylist())
                yield batch.append_column(pred, pa.array(langs, pa.string())).append_column(score, pa.array(scores, pa.float64()))

        return docs.mapInArrow(run, docs.withColumn(pred, F.lit("")).withColumn(score, F.lit(0.0)).schema)

    def label(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        with_letter = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        if not self.languages:
            return langs, scores
        lo = 0
        while lo < len(with_letter):  # a bounded number of bytes at a time
            hi, size = lo, 0
            while hi < len(with_letter) and (hi == lo or size < 8 << 20):
                size += len(texts[with_letter[hi]])
                hi += 1
            some = with_letter[lo:hi]
            p = self.pooled([texts[i].encode("utf-8", "surrogatepass") for i in some])
            for i, best, top in zip(some, p.argmax(axis=1).tolist(), p.max(axis=1).tolist()):
                langs[i], scores[i] = self.languages[best], min(1.0, top)
            lo = hi
        return langs, scores


def _picked(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def sample_documents(docs: DataFrame, most: int) -> DataFrame:
    """(doc_id, lang) of the ``most`` documents of each language with the lowest hashes of their ids."""
    first = docs.withColumn("_group", F.spark_partition_id() % GROUPS)
    for keys in (["lang", "_group"], ["lang"]):  # the lowest of all are among the lowest of the groups
        by_hash = Window.partitionBy(*keys).orderBy(F.xxhash64("doc_id"), "doc_id")
        first = first.withColumn("_rank", F.row_number().over(by_hash)).filter(F.col("_rank") <= most)
    return first.select("doc_id", "lang").distinct()


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_windows: int = SAMPLE_WINDOWS) -> LanguageModel:
    """Train on texts and languages of documents whose crc32(doc_id) mod 3 is not 1.

    Every language there is becomes a class. Of each, ``sample_docs`` documents
    are picked by a hash of the id, and of these ``sample_windows`` windows in
    all are used. Both picks are ranked windows, which Spark limits within each
    task before it shuffles, so a hot language sends no more than its limit.
    Documents are first picked within GROUPS groups of tasks, so that no task
    meets the picks of all; the windows are those of the picked documents alone.
    """
    usable = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN) & (remainder(F.col("doc_id"), MODULUS) != HELD_OUT)
    )
    picked = materialize(sample_documents(usable, sample_docs), "languages")
    languages = tuple(sorted(r.lang for r in picked.select("lang").distinct().collect()))
    if not languages:
        return LanguageModel.start(languages)
    each = max(1, sample_windows // len(languages))
    numbers = {lang: k for k, lang in enumerate(languages)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, counts, owner = windows([(x.as_py() or "").encode("utf-8", "surrogatepass") for x in batch.column(1)])
            langs, ids = batch.column(2).to_pylist(), batch.column(0).to_pylist()
            columns = [[r.tobytes() for r in rows], counts, [numbers[langs[i]] for i in owner], [ids[i] for i in owner], np.arange(len(rows))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64()])], ["bytes", "counts", "label", "doc_id", "number"])

    # a row is learned with its own language, also where rows of other languages share its id
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    texts = rows.join(picked, ["doc_id", "lang"]).select("doc_id", "text", "lang")
    cuts = texts.mapInArrow(cut, "bytes binary, counts long, label int, doc_id long, number long")
    # short texts teach little by number, so they are put first
    order = Window.partitionBy("label").orderBy(F.col("counts") == STEPS, F.xxhash64("doc_id", "number"), "doc_id", "number")
    rows = cuts.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= each).orderBy("label", "_rank").select("bytes", "counts", "label").collect()
    if not rows:
        return LanguageModel.start(())
    model = LanguageModel.start(languages)
    data = np.stack([np.frombuffer(r["bytes"], np.uint8) for r in rows])
    model.train(data, np.array([r["counts"] for r in rows]), np.array([r["label"] for r in rows]))
    return model
