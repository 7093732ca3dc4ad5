"""The registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import token_digests
from .common import read_table, remainder
from .decontam import contamination
from .fill_in_middle import fill_in_middle, restore
from .host_rules import host_quality
from .html_extract import fit as fit_pages
from .jaccard_join import near_duplicates
from .langid import fit as fit_languages
from .license_scan import fit as fit_licenses
from .line_dedup import LineIndex
from .quality_zstd import fit as fit_quality
from .source_divergence import divergence
from .substring_dedup import drop_repeats
from .warc import write_archive

#: Where the public tokenizer file lies when no other path is given.
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document from a network trained on the documents outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents")
    found = fit_languages(docs).predict(docs)
    return found.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = read_table(spark, sf_dir, "pages")
    return fit_pages(pages).extract(pages)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License families stated in every document, and the paragraphs that state one."""
    docs = read_table(spark, sf_dir, "documents")
    return fit_licenses(docs).documents(docs)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside a 10-word window of a benchmark item, and the items."""
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated"
    )


def op5_bpe_automaton(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Encode and decode every document; digests of both."""
    return token_digests(read_table(spark, sf_dir, "documents"), tokenizer or tokenizer_path())


def op6_zstd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document from a model learned from the labels outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents")
    scored = fit_quality(docs, read_table(spark, sf_dir, "labels")).score(docs)
    return scored.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts of every document, with the verdict of its host (its source)."""
    found = host_quality(read_table(spark, sf_dir, "documents"), "source")
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document before and after dropping repeated ones, and a digest of what stays."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = LineIndex.build(docs).dedup(docs)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op9_fm_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document without the 50-word windows that an earlier document holds."""
    found = drop_repeats(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle set size of every document and its component of near duplicates."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of each source to every other of its language, and the terms it has most above the language."""
    return divergence(read_table(spark, sf_dir, "documents"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a record of an archive, and what the archive gives back."""
    found = write_archive(read_table(spark, sf_dir, "pages")).read()
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-the-middle form of every document; digests of the output and of the text restored from it."""
    found = fill_in_middle(read_table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restore(F.col("output"), F.col("form"))).alias("restored_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_html_extraction": op2_html_extraction,
    "op3_license_scan": op3_license_scan,
    "op4_decontamination": op4_decontamination,
    "op5_bpe_automaton": op5_bpe_automaton,
    "op6_zstd_quality": op6_zstd_quality,
    "op7_host_rules": op7_host_rules,
    "op8_line_dedup": op8_line_dedup,
    "op9_fm_substring_dedup": op9_fm_substring_dedup,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_source_divergence": op11_source_divergence,
    "op12_warc": op12_warc,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLE_SQL: dict[str, str] = {
    "op4_decontamination": r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_no, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS words
  FROM documents
), items AS (
  SELECT DISTINCT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS words
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS size, array_to_string(words[s:s + least(10, len(words)) - 1], ' ') AS phrase
  FROM items, unnest(range(1, greatest(len(words) - 10, 0) + 2)) AS t(s) WHERE len(words) > 0 AND item_id IS NOT NULL
), sizes AS (
  SELECT DISTINCT size FROM windows
), places AS (
  SELECT row_no, size, s, array_to_string(words[s:s + size - 1], ' ') AS phrase
  FROM docs, sizes, unnest(range(1, len(words) - size + 2)) AS t(s)
), found AS (
  SELECT row_no, item_id, p.size, s FROM places p JOIN windows USING (size, phrase)
), hits AS (
  SELECT row_no, count(DISTINCT s + k) AS n_hit FROM found, unnest(range(0, size)) AS t(k) GROUP BY row_no
), named AS (
  SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT row_no, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY row_no
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (row_no) LEFT JOIN named USING (row_no)
""",
    "op7_host_rules": r"""
WITH texts AS (
  SELECT row_number() OVER () AS row_no, doc_id, source AS host, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT row_no, doc_id, host, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts
), grams AS (
  SELECT row_no, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM words, unnest(range(1, len(words) - 1)) AS t(i)
), repeated AS (
  SELECT row_no, i FROM grams QUALIFY count(*) OVER (PARTITION BY row_no, gram) > 1
), repeats AS (
  SELECT row_no, count(DISTINCT i + k) AS n FROM repeated, unnest([0, 1, 2]) AS t(k) GROUP BY row_no
), lines AS (
  SELECT row_no, unnest(string_split(text, chr(10))) AS line FROM texts
), dups AS (
  SELECT row_no, count(*) - count(DISTINCT line) AS n FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row_no
), base AS (
  SELECT w.row_no, w.doc_id, w.host, CAST(len(w.words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(w.text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(w.text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(d.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM words w LEFT JOIN dups d USING (row_no) LEFT JOIN repeats r USING (row_no)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base
), hosts AS (
  SELECT host, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (base_failed) AS DOUBLE) AS f
  FROM judged WHERE host IS NOT NULL GROUP BY host
), mean AS (
  SELECT sum(f) / sum(n) AS m FROM hosts
), spread AS (
  SELECT any_value(m) AS m, sum(n * pow(f / n - m, 2)) / sum(n) AS v FROM hosts, mean
), prior AS (
  SELECT m, greatest(1.0, least(1000.0, CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE 1000.0 END)) AS k FROM spread
), rates AS (
  SELECT host, (f + m * k) / (n + k) AS rate FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(rate > 0.8, false) AS kept
FROM judged LEFT JOIN rates USING (host)
""",
    "op8_line_dedup": r"""
WITH space AS (
  SELECT ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) AS chars
), lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT doc_id, i, line, translate(trim(line, chars), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines, space
), repeated AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.*, coalesce(k.doc_id <> r.last_doc, false) AS gone FROM keyed k LEFT JOIN repeated r USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
    "op10_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM words, unnest(range(1, greatest(len(words) - 3, 2))) AS t(i) WHERE len(words) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, low AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a) USING (doc_id)
""",
    "op9_fm_substring_dedup": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, s, md5(array_to_string(words[s:s + 49], ' ')) AS w FROM words, unnest(range(1, len(words) - 48)) AS t(s)
), late AS (
  SELECT doc_id, s FROM windows QUALIFY min(doc_id) OVER (PARTITION BY w) < doc_id
), cut AS (
  SELECT DISTINCT doc_id, s + k AS i FROM late, unnest(range(0, 50)) AS t(k)
), cuts AS (
  SELECT doc_id, list(i) AS places FROM cut GROUP BY doc_id
), kept AS (
  SELECT w.doc_id, i, words[i] AS word FROM words w, unnest(range(1, len(words) + 1)) AS t(i)
  WHERE NOT EXISTS (SELECT 1 FROM cut c WHERE c.doc_id = w.doc_id AND c.i = t.i)
), joined AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM kept GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM words w LEFT JOIN cuts c USING (doc_id) LEFT JOIN joined j USING (doc_id)
""",
    "op11_source_divergence": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM docs
), kept AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 30
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), sizes AS (
  SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
), totals AS (
  SELECT lang, source, sum(n) AS n FROM counts GROUP BY ALL
), shares AS (
  SELECT lang, source, term, coalesce(c.n, 0) AS n,
    1 + CAST((1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(t.n, 0) + 5 * v) AS BIGINT) AS p,
    1 + CAST((1000000000::HUGEINT * (k.n + 5)) // (s.n + 5 * v) AS BIGINT) AS q
  FROM groups JOIN kept k USING (lang) JOIN sizes s USING (lang) LEFT JOIN counts c USING (lang, source, term) LEFT JOIN totals t USING (lang, source)
), far AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
""",
    "op12_warc": r"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), named AS (
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)), '') AS payload_digest
  FROM payloads
), firsts AS (
  SELECT payload_digest, min(page_id) AS first FROM named GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM named JOIN firsts USING (payload_digest)
""",
    "op13_fill_in_middle": r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS hex FROM documents
), draws AS (
  SELECT doc_id, text, n, CAST('0x' || hex[1:8] AS BIGINT) % (n + 1) AS a, CAST('0x' || hex[9:16] AS BIGINT) % (n + 1) AS b,
    CAST('0x' || hex[17:24] AS BIGINT) % 100 AS c, CAST('0x' || hex[25:32] AS BIGINT) % 100 AS d
  FROM texts
), formed AS (
  SELECT doc_id, text, n, least(a, b) AS lo, greatest(a, b) AS hi,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR c >= 90 THEN 'plain' WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM draws
), cut AS (
  SELECT *, substring(text, 1, lo) AS prefix, substring(text, lo + 1, hi - lo) AS middle, substring(text, hi + 1) AS suffix FROM formed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars, CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
""",
}
