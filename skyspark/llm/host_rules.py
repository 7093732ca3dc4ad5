"""Quality rules by host (operator 7).

Each document is measured once in Arrow batches. The rule failures are then
added up by host, a host's failure rate is shrunk towards the rate of all hosts
with a beta prior fitted to the hosts themselves, and the host's verdict is
joined back to its documents.

Defined cases: a null text has no words and fails the base rules; a null host
gets no verdict, so its documents stand or fall alone; repeated rows are
measured, counted and returned once each; a long text is measured whole; hosts
that tie in rate get the same verdict; an empty table gives an empty result;
further input columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, materialize, salted_join

SYMBOLS = "#*$%&|<>"
#: Fewest words of a document, and the greatest share of words in repeated windows (per cent).
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A host is rejected when its shrunk failure rate is above this.
MAX_HOST_RATE = 0.8
#: Bounds of the prior's weight, in documents.
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1000.0

METRICS_SCHEMA = "doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, the first occurrence included."""
    grams = list(zip(words, words[1:], words[2:]))
    if len(set(grams)) == len(grams):
        return 0
    counts = Counter(grams)
    covered = end = 0
    for i, gram in enumerate(grams):
        if counts[gram] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def duplicate_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = raw.split(b"\n")
    if len(set(lines)) == len(lines):
        return 0
    worded = [x for x in lines if x.split(None, 1)]
    return len(worded) - len(set(worded))


def measure(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of one text."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # of bytes: splits at ASCII white space only
    return (
        len(words),
        len(text) - sum(map(text.count, ASCII_SPACE)),
        sum(map(text.count, SYMBOLS)),
        duplicate_lines(raw),
        repeated_words(words),
    )


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [measure(x.as_py()) for x in batch.column(2)]
        columns = zip(*rows) if rows else [[]] * 5
        arrays = [pa.array(c, pa.int64()) for c in columns]
        names = ["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names)


def document_metrics(docs: DataFrame, host: str | Column = "source") -> DataFrame:
    """One row of counts for each document."""
    host_col = F.col(host) if isinstance(host, str) else host
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), host_col.cast("string").alias("host"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(_measure_batches, METRICS_SCHEMA)


def base_failed(min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def host_rates(metrics: DataFrame) -> DataFrame:
    """One row per host: documents, failures and the failure rate shrunk by the empirical beta prior.

    The prior's mean is the failure rate of all documents with a host. Its
    weight comes from the spread of the hosts' own rates (method of moments,
    hosts weighted by documents), kept within MIN_STRENGTH and MAX_STRENGTH.
    """
    hosts = (
        metrics.filter(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    )
    mean = hosts.agg((F.sum("n_failed") / F.sum("n_docs")).alias("mean"))
    spread = hosts.crossJoin(F.broadcast(mean)).agg(  # one row
        F.first("mean").alias("mean"),
        (F.sum(F.col("n_docs") * F.pow(F.col("n_failed") / F.col("n_docs") - F.col("mean"), F.lit(2.0))) / F.sum("n_docs")).alias("spread"),
    )
    weight = F.when(F.col("spread") > 0, F.col("mean") * (1 - F.col("mean")) / F.col("spread") - 1).otherwise(F.lit(MAX_STRENGTH))
    prior = spread.select("mean", F.greatest(F.lit(MIN_STRENGTH), F.least(F.lit(MAX_STRENGTH), weight)).alias("strength"))
    return hosts.crossJoin(F.broadcast(prior)).select(  # one row
        "host", "n_docs", "n_failed", ((F.col("n_failed") + F.col("mean") * F.col("strength")) / (F.col("n_docs") + F.col("strength"))).alias("rate")
    )


def host_quality(
    docs: DataFrame,
    host: str | Column = "source",
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    max_host_rate: float = MAX_HOST_RATE,
) -> DataFrame:
    """Each document's counts with base_failed, host_rate, host_failed and kept.

    The texts are read once; what the two consumers (host totals and the join
    back) share is the narrow table of counts, written to the shared folder.
    Hosts are summed map-side first; documents of a hot host are dealt to
    several tasks when the verdicts are joined back.
    """
    measured = document_metrics(docs, host).withColumn("base_failed", base_failed(min_words, max_repeat_percent))
    metrics = materialize(measured, "host-metrics")
    rates = materialize(host_rates(metrics), "host-rates").select("host", F.col("rate").alias("host_rate"))
    failed = F.coalesce(F.col("host_rate") > max_host_rate, F.lit(False))
    return (
        salted_join(metrics, rates, ["host"], ["doc_id"], "left")
        .withColumn("host_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))
    )
