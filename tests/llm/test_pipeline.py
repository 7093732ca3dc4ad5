"""The stages, one after the other, against plain versions of their decisions."""

import pytest

from llm_samples import docs_frame
from test_text_operators import expected_components, expected_hits, expected_lines

pipeline = pytest.importorskip("corpus_pipeline")


def test_stages_act_on_what_is_left(spark, sf_dir):
    from tokenizers import Tokenizer

    from skyspark.llm.queries import tokenizer_path

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").unionByName(spark.createDataFrame([(-1, "123 456", None, None, 7), (-2, None, None, None, None), (-3, items[0][1], "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long"))
    stages = dict(pipeline.STAGES)
    rows = lambda df: sorted((r.doc_id, r.text) for r in df.collect())
    start = rows(docs.filter("text is not null"))

    known = stages["language_id"](spark, docs, sf_dir).cache()
    assert rows(known) == [r for r in start if r[0] != -1] and known.columns == docs.columns

    lines = stages["line_dedup"](spark, known, sf_dir).cache()
    assert rows(lines) == sorted((d, t) for d, _, _, t in expected_lines(rows(known)))
    assert lines.columns == docs.columns and all(r.n_chars == len(r.text) for r in lines.collect())

    single = stages["near_duplicates"](spark, lines, sf_dir).cache()
    firsts = {c for _, _, c in expected_components(rows(lines))}
    assert rows(single) == [r for r in rows(lines) if r[0] in firsts]

    clean = stages["decontamination"](spark, single, sf_dir).cache()
    hit = {d for d, _, n, _ in expected_hits(rows(single), items) if n}
    assert -3 in {d for d, _ in rows(single)} and rows(clean) == [r for r in rows(single) if r[0] not in hit and r[0] != -3]

    real = Tokenizer.from_file(tokenizer_path())
    got = {r.doc_id: r.n_tokens for r in stages["bpe_tokens"](spark, clean, sf_dir).collect()}
    assert got == {d: len(real.encode(t, add_special_tokens=False).ids) for d, t in rows(clean)}


def test_run_equals_the_last_stage(spark, sf_dir):
    got = pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0 < got.count() < 200


def test_stages_take_empty_and_awkward_tables(spark, sf_dir, awkward):
    awkward_docs = docs_frame(spark, awkward).select(pipeline.COLUMNS)
    for docs in (awkward_docs, awkward_docs.filter("false")):
        for _, stage in pipeline.STAGES:
            assert stage(spark, docs, sf_dir).count() <= len(awkward)
