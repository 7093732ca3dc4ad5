"""Benchmark decontamination with a positional inverted index (operator 4).

The index stores a posting (term, uid, pos) for every word of the corpus. It is
cut into segments as search engines do: each task writes the postings of its
own documents, sorted by term, so that building it shuffles nothing. A row with
a null term heads each document and holds its id and length.

A phrase is sought from its rarest terms. Of every window of ten item words the
rarest term gives candidates (document, offset-adjusted position); the list of
the next rarest term, adjusted the same way, is intersected with them; only what
is left is compared word by word. Terms are 64-bit hashes of words. All of it is
DataFrame operations. What derives from the benchmark is broadcast where it is
counted and small; beyond that it joins by shuffle, with the keys that are hot in
the corpus dealt to several tasks.

Defined cases: a null or empty text has no words and no hits; texts of any
length are indexed whole; every input row is a document of its own, so repeated
rows give repeated results; windows that tie in rarity are taken in item order;
items without words or with a null id match nothing; the same item given twice
counts once; an empty benchmark hits nothing, an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.storage import new_folder
from .common import ascii_lower, join_small, materialize, small_side

#: What lies between words, which before lower-casing are digits, A-Z, a-z and everything beyond ASCII.
BETWEEN = r"[^0-9A-Za-z\x80-\x{10FFFF}]+"
WINDOW = 10
ROW_GROUP_BYTES = 16 << 20
#: Words that all terms of a proximity match must lie within, on either side of the rarest one.
SPAN = 20


def words_of(text: Column) -> Column:
    """The words of a text, A-Z not yet lower-cased (that is cheaper word by word). Splitting makes fewer objects than matching."""
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), BETWEEN), "")


def term_of(word: Column) -> Column:
    """Hash of the word with A-Z in lower case; ``lower`` does just that where all characters are ASCII."""
    return F.xxhash64(F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(ascii_lower(word)))


@dataclass(frozen=True)
class PositionalIndex:
    """Postings in the shared folder: term, uid, doc_id (heads only), pos."""

    table: DataFrame

    @classmethod
    def build(cls, docs: DataFrame, path: str | None = None) -> PositionalIndex:
        """Index every word of every document; one narrow pass, no shuffle."""
        spark = docs.sparkSession
        rows = docs.select(F.col("doc_id").alias("doc_id"), words_of(F.col("text")).alias("words")).select(F.monotonically_increasing_id().alias("uid"), "doc_id", "words")
        spread = rows.select("uid", "doc_id", F.size("words").alias("n"), F.posexplode(F.concat(F.array(F.lit("")), F.col("words"))).alias("at", "word"))
        head = F.col("at") == 0
        postings = spread.select(
            F.when(~head, term_of(F.col("word"))).alias("term"),
            "uid",
            F.when(head, F.col("doc_id")).alias("doc_id"),
            F.when(head, F.col("n")).otherwise(F.col("at") - 1).alias("pos"),
        )
        path = path or new_folder(spark, "postings")
        # small row groups: what the writers hold counts against the sort
        postings.sortWithinPartitions("term").write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
        return cls.open(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> PositionalIndex:
        return cls(spark.read.parquet(path))

    @property
    def documents(self) -> DataFrame:
        return self.table.filter(F.col("term").isNull()).select("uid", "doc_id", F.col("pos").cast("long").alias("n_words"))

    @property
    def postings(self) -> DataFrame:
        return self.table.filter(F.col("term").isNotNull()).select("term", "uid", "pos")

    def of(self, terms: DataFrame) -> DataFrame:
        """(term, uid, pos) of distinct terms from the benchmark."""
        return self.postings.join(small_side(terms), "term", "left_semi")


@dataclass(frozen=True)
class BenchmarkTerms:
    """Items cut into terms, and the terms of each window ranked from the rarest."""

    items: DataFrame  # iid, item_id, n_words
    terms: DataFrame  # iid, off, term
    ranked: DataFrame  # iid, start, off, term, rank

    @classmethod
    def prepare(cls, benchmark: DataFrame, index: PositionalIndex, window: int = WINDOW) -> BenchmarkTerms:
        rows = benchmark.select("item_id", "text").filter(F.col("item_id").isNotNull()).distinct().select("item_id", words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
        items = materialize(rows.select(F.monotonically_increasing_id().alias("iid"), "item_id", F.size("words").alias("n_words"), "words"), "items")
        terms = materialize(items.select("iid", F.posexplode("words").alias("off", "word")).select("iid", "off", term_of(F.col("word")).alias("term")), "item-terms")
        vocabulary = terms.select("term").distinct()
        counted = index.of(vocabulary).groupBy("term").agg(F.count("*").alias("df"))
        counts = materialize(counted, "item-df")
        length = F.least(F.lit(window), F.col("n_words"))
        starts = items.select("iid", length.alias("length"), F.explode(F.sequence(F.lit(0), F.col("n_words") - length)).alias("start"))
        places = starts.select("iid", "start", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("off"))
        known = places.join(terms, ["iid", "off"]).join(counts, "term", "left").withColumn("df", F.coalesce("df", F.lit(0)))
        rarest = Window.partitionBy("iid", "start").orderBy("df", "off")
        ranked = known.withColumn("rank", F.row_number().over(rarest)).select("iid", "start", "off", "term", "rank")
        return cls(items.drop("words"), terms, materialize(ranked, "item-windows"))

    def at_rank(self, rank: int) -> DataFrame:
        return self.ranked.filter(F.col("rank") == rank)


def _candidates(index: PositionalIndex, bench: BenchmarkTerms) -> DataFrame:
    """(iid, off, uid, pos) for every posting of a window's rarest term."""
    anchors = materialize(bench.at_rank(1).select("iid", "off", "term").distinct(), "item-anchors")
    return join_small(index.postings, anchors, ["term"], ["uid"]).select("iid", "off", "uid", "pos")


def phrase_hits(index: PositionalIndex, bench: BenchmarkTerms, window: int = WINDOW) -> DataFrame:
    """(iid, uid, start, pos) of every document word inside an occurrence of a window: pos is the word's place, start the item's first word's."""
    first = bench.at_rank(1).select("iid", "start", "off")
    second = bench.at_rank(2).select("iid", "start", F.col("off").alias("next_off"), F.col("term").alias("next_term"))
    # off and next_off are the same for many windows of an item: keep each pair once
    pairs = materialize(first.join(second, ["iid", "start"], "left").select("iid", "off", "next_off", "next_term").distinct(), "item-pairs")
    shifted = join_small(_candidates(index, bench), pairs, ["iid", "off"], ["uid"]).withColumn("diag", F.col("pos") - F.col("off"))
    shifted = materialize(shifted.select("iid", "uid", "diag", "next_off", "next_term"), "phrase-shifted")
    lone = shifted.filter(F.col("next_off").isNull()).select("iid", "uid", "diag")  # windows of one word
    wanted = shifted.filter(F.col("next_off").isNotNull()).select("iid", "uid", "diag", F.col("next_term").alias("term"), (F.col("diag") + F.col("next_off")).alias("pos"))
    next_terms = pairs.select(F.col("next_term").alias("term")).filter(F.col("term").isNotNull()).distinct()
    both = wanted.join(index.of(next_terms), ["term", "uid", "pos"]).select("iid", "uid", "diag")
    found = materialize(both.unionByName(lone).distinct(), "phrase-candidates")
    needed = join_small(found, bench.terms, ["iid"], ["uid"]).select("iid", "uid", "diag", "off", "term", (F.col("diag") + F.col("off")).alias("pos"))
    near = index.of(bench.terms.select("term").distinct()).join(found.select("uid").distinct(), "uid", "left_semi")
    equal = near.join(needed, ["uid", "pos", "term"]).select("iid", "uid", "diag", "off")
    alignment = Window.partitionBy("iid", "uid", "diag")  # no more rows than the item has words
    runs = equal.withColumn("run", F.col("off") - F.row_number().over(alignment.orderBy("off")))
    sized = runs.withColumn("length", F.count("*").over(Window.partitionBy("iid", "uid", "diag", "run")))
    whole = join_small(sized, bench.items.select("iid", "n_words"), ["iid"], ["uid"]).filter(F.col("length") >= F.least(F.lit(window), F.col("n_words")))
    return whole.select("iid", "uid", F.col("diag").alias("start"), (F.col("diag") + F.col("off")).alias("pos"))


def proximity_matches(index: PositionalIndex, bench: BenchmarkTerms, terms: int = 3, span: int = SPAN) -> DataFrame:
    """(item_id, doc_id, pos) where the ``terms`` rarest terms of a window all lie within ``span`` words of its rarest one, at ``pos``, in any order."""
    anchor = bench.at_rank(1).select("iid", "start", "off")
    others = bench.ranked.filter((F.col("rank") > 1) & (F.col("rank") <= terms))
    sets = others.groupBy("iid", "start").agg(F.array_sort(F.collect_set("term")).alias("others"))  # at most terms - 1
    wanted = materialize(anchor.join(sets, ["iid", "start"]).select("iid", "off", "others").distinct(), "item-sets")
    near = join_small(_candidates(index, bench), wanted, ["iid", "off"], ["uid"])
    sought = near.select("iid", "uid", F.col("pos").alias("anchor"), "others", F.explode("others").alias("term"))
    reach = F.sequence(F.floor((F.col("anchor") - span) / span), F.floor((F.col("anchor") + span) / span))
    sought = sought.select("iid", "uid", "anchor", "others", "term", F.explode(reach).alias("bucket"))
    other_terms = wanted.select(F.explode("others").alias("term")).distinct()
    lists = index.of(other_terms).withColumn("bucket", F.floor(F.col("pos") / span))
    within = sought.join(lists, ["uid", "term", "bucket"]).filter(F.abs(F.col("pos") - F.col("anchor")) <= span)
    full = within.groupBy("iid", "uid", "anchor", "others").agg(F.countDistinct("term").alias("n")).filter(F.col("n") == F.size("others"))
    hits = full.select("iid", "uid", F.col("anchor").alias("pos")).distinct()
    return hits.join(bench.items.select("iid", "item_id"), "iid").join(index.documents.select("uid", "doc_id"), "uid").select("item_id", "doc_id", "pos").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row for each document: doc_id, n_words, n_hit, items (ids that occur, as sorted strings) and contaminated."""
    index = PositionalIndex.build(docs)
    bench = BenchmarkTerms.prepare(benchmark, index, window)
    hits = materialize(phrase_hits(index, bench, window), "phrase-hits")
    words = hits.select("uid", "pos").distinct().groupBy("uid").agg(F.count("*").alias("n_hit"))
    named = join_small(hits.select("uid", "iid").distinct(), bench.items.select("iid", "item_id"), ["iid"], ["uid"])
    items = named.groupBy("uid").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))  # bounded by the benchmark
    joined = index.documents.join(words.join(items, "uid"), "uid", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), (n_hit > 0).alias("contaminated"))
