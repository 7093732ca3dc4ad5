"""Frames for the tests."""

#: Columns that clash with names used inside the operators and in their results.
CLASHING = "n_words int, score int, kept int, shard int, key int, term int, uid int, label int, node int, rep int, block int, host int, predicted int, _gone int, n int, words int, n_lines int"


def docs_frame(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(*r, *(None,) * (4 - len(r))) for r in rows]
    extra = [0] * CLASHING.count(",") + [0]
    return spark.createDataFrame([(d, t, lang, src, None, *extra) for d, t, lang, src in full], f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}")
