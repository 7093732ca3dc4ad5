"""From raw documents to tokens: five stages over the training-data operators.

Each stage takes (spark, docs, sf_dir), reads all its predecessor kept and
returns a DataFrame; all but the last return the columns of ``documents``.
Stages that train or look up (languages, benchmark) use their own input and
``sf_dir``.

Defined cases, for every stage: an empty table gives an empty one; further
columns are left out; texts of any length are judged whole; each row is judged
by its own text, with or without a doc_id. Beyond that:

* ``language_id`` drops rows whose text is null or has no letter,
* ``line_dedup`` leaves the lines of a row without a doc_id alone, as such a row
  is no document of the index; an empty text stays,
* ``near_duplicates`` takes rows that share a doc_id for one document, of which
  the row with the least text (then lang, source, n_chars) may stay. Rows without
  a doc_id are documents named by a hash of their text, after all others in order,
* ``decontamination`` judges each row, so of two texts with one doc_id one may go,
* ``bpe_tokens`` gives every row a result, a null text no tokens.

SQL cannot express the language model or the tokenizer, so there is no
ORACLE_SQL; the tests hold the stages against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyspark.llm import queries as llm
from skyspark.llm.bpe import token_digests
from skyspark.llm.common import materialize, read_table
from skyspark.llm.decontam import contamination
from skyspark.llm.jaccard_join import near_duplicates
from skyspark.llm.langid import UNKNOWN, fit
from skyspark.llm.line_dedup import LineIndex

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents whose language is no likelier than this are rejected; it lies below what clean text of a few words gets.
MIN_LANGUAGE_SCORE = 0.3
#: Names of rows without a doc_id start here.
NAMELESS = 1 << 62


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in one of the learned languages; ``lang`` becomes the prediction where it was null."""
    found = fit(docs).annotate(docs.select(COLUMNS), "_pred", "_score")
    known = found.filter((F.col("_pred") != UNKNOWN) & (F.col("_score") >= MIN_LANGUAGE_SCORE))
    return known.withColumn("lang", F.coalesce("lang", "_pred")).select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop repeated lines from the texts; ``n_chars`` follows the text. No document goes."""
    found = LineIndex.build(docs).dedup(docs.select(COLUMNS))
    return found.withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each component of near duplicates."""
    name = F.coalesce(F.col("doc_id").cast("long"), F.lit(NAMELESS) + F.pmod(F.xxhash64("text"), F.lit(NAMELESS)))
    named = docs.select(*COLUMNS, name.alias("_name"))
    found = near_duplicates(named.select(F.col("_name").alias("doc_id"), "text"))
    kept = found.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_name")).distinct()
    order = Window.partitionBy("_name").orderBy("text", "lang", "source", "n_chars")
    return named.join(kept, "_name", "left_semi").withColumn("_place", F.row_number().over(order)).filter("_place = 1").select(COLUMNS)


def _row_name() -> Column:
    return F.concat_ws(":", F.col("doc_id").cast("string"), F.xxhash64("text").cast("string"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that hold no window of a benchmark item."""
    named = docs.select(*COLUMNS, _row_name().alias("_name"))
    found = contamination(named.select(F.col("_name").alias("doc_id"), "text"), read_table(spark, sf_dir, "benchmark"))
    gone = found.filter("contaminated").select(F.col("doc_id").alias("_name"))
    return named.join(gone, "_name", "left_anti").select(COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode and decode every document; one row each with the token count and digests."""
    return token_digests(docs, llm.tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicate),
    ("decontamination", decontaminate),
    ("bpe_tokens", tokenize),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
