"""Operators 1, 2, 3, 5 and 6: accuracy on held-out rows, exact round trips, known pages and statements."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyspark.llm import bpe, html_extract, langid, license_scan, quality_zstd
from skyspark.llm.boosted_trees import BoostedTrees
from skyspark.llm.queries import QUERIES, tokenizer_path

from llm_samples import docs_frame


def test_language_accuracy_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op1_language_id"](spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id")
    row = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("right"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert row.right > 0.98 and 0 <= row.lo <= row.hi <= 1


def test_language_gradients():
    rng = np.random.default_rng(0)
    model = langid.LanguageModel.start(("a", "b", "c"), 3)
    for k, p in enumerate(model.parameters()):
        p[...] = rng.standard_normal(p.shape) * 0.5
    rows = rng.integers(0, 5, (langid.STEPS, 4)).astype(np.uint8)
    labels = np.array([0, 1, 2, 1])

    def loss():
        p = model.positions(rows)[0]
        return -np.log(p[:, np.arange(4), labels]).mean()

    keep = ([], [])
    g, ahead, back = model.positions(rows, keep)
    g[:, np.arange(4), labels] -= 1
    g /= langid.STEPS * 4
    by_byte, by_state = model.forwards.gradients(rows, g @ model.out[:3].T, keep[0])
    back_byte, back_state = model.backwards.gradients(rows, g @ model.out[3:].T, keep[1])
    for weights, gradient in ((model.forwards.byte, by_byte), (model.forwards.state, by_state), (model.backwards.byte, back_byte), (model.backwards.state, back_state)):
        for _ in range(6):
            at = (int(rng.integers(0, min(5, len(weights)))), int(rng.integers(0, weights.shape[1])))
            old = weights[at]
            weights[at] = old + 0.02
            up = loss()
            weights[at] = old - 0.02
            down = loss()
            weights[at] = old
            assert abs((up - down) / 0.04 - gradient[at]) < 2e-3


def test_language_edge_cases(spark, awkward, awkward_docs, no_docs):
    lines = {"en": "the cat and the dog were here with that ", "fr": "le chat et la chienne étaient là avec ça "}
    train = [(i, lines[lang] * 5, lang) for i, lang in enumerate(["en", "fr"] * 20)] + [(100, "x" * 99, None)]
    model = langid.fit(docs_frame(spark, train))
    assert model.languages == ("en", "fr")
    rows = [(1, None), (2, ""), (3, "123 !!"), (4, "the dog"), (4, "the dog"), (5, "étaient là"), (6, "the dog " * 3000)]
    got = sorted(map(tuple, model.predict(docs_frame(spark, rows)).collect()))
    assert [g[1] for g in got] == ["und", "und", "und", "en", "en", "fr", "en"] and got[0][2] == 0.0
    labels = model.label_positions("the dog is here with the cat")
    assert len(labels) == 28 and labels.count("en") > 20
    assert model.predict(awkward_docs).count() == len(awkward) and model.predict(no_docs).count() == 0
    assert {r.lang_pred for r in langid.fit(no_docs).predict(awkward_docs).collect()} == {"und"}


def test_sampled_documents_are_those_with_the_lowest_hashes(spark):
    rows = [(i, "x", "en" if i % 3 else "fr") for i in range(3000)] + [(7, "x", "en")]
    docs = docs_frame(spark, rows).repartition(40)
    hashes = {r.doc_id: r.h for r in docs.selectExpr("doc_id", "xxhash64(cast(doc_id as bigint)) h").collect()}
    expected = [x for lang in ("en", "fr") for x in sorted((hashes[i], i, lang) for i, _, at in rows if at == lang)[:50]]
    usable = docs.selectExpr("cast(doc_id as bigint) doc_id", "lang")
    got = [(hashes[r.doc_id], r.doc_id, r.lang) for r in langid.sample_documents(usable, 50).collect()]
    assert sorted(got) == sorted(expected)


def test_windows_cover_all_bytes():
    texts = [b"", b"a", b"b" * 64, b"c" * 65]
    rows, counts, owner = langid.windows(texts)
    assert owner.tolist() == [1, 2, 3, 3] and counts.tolist() == [1, 64, 64, 1]
    assert b"".join(bytes(r[:n]) for r, n in zip(rows, counts)) == b"".join(texts)


def article(page):
    """The blocks of the article, cut out by its tag."""
    import html
    import re

    inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner.replace("<br>", " ")))
    return "\n\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)


def test_main_text_of_every_page(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.page_id: r for r in QUERIES["op2_html_extraction"](spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert all(got[p.page_id].text == article(p.html) and got[p.page_id].n_chars == len(got[p.page_id].text) for p in pages)


@pytest.fixture(scope="module")
def page_model():
    rng = random.Random(1)
    return html_extract.train([" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(5, 120))) + "." for _ in range(300)])


def test_composed_pages(page_model):
    rng = random.Random(99)
    lines = ["Some words of a sentence, with a stop.", "Another sentence that is quite a bit longer than the first one was, and ends here.", "Short."]
    pages = [html_extract.Page(html_extract.compose_page(rng, lines), composed=True) for _ in range(200)]
    features, parent, depth = html_extract.tree_features(pages)
    kept = html_extract.decode(page_model.trees.logit(features), parent, depth)
    marks = np.concatenate([np.array(p.marks) for p in pages])
    assert (kept == (marks == "1"))[marks != ""].mean() > 0.97
    inner = depth > 0
    assert not (kept[inner] & ~kept[parent[inner]]).any()


def test_hand_written_pages(page_model, spark):
    text = "A paragraph of the article with enough words, stops and so on to be one. It goes on a little. "
    page = f"""<!DOCTYPE html><body><header class="site"><h2>Site</h2></header><nav><a href=1>Home</a> <a href=2>News</a></nav>
<div class=sidebar><ul><li><a href=3>Old</a><li><a href=4>Older</a></ul></div><main><article><h1>Title &amp;
  more</h1><p>{text}<p>Second&nbsp;<b>bold</b> <a href=5>link</a>.<br>{text}<ul><li>first item of a list</li><li>second item of a list</li></ul></article></main>
<div class="cookie-notice"><p>We use cookies.</p></div><section id=comments><div class=comment><p>Nice one, thanks for the article.</p></div></section>
<form><label>Mail</label><input><button>Go</button></form><script>var x = "<p>no</p>";</script><footer>&copy; 2020</footer>"""
    want = "\n\n".join(["Title & more", text.strip(), f"Second bold link. {text.strip()}", "first item of a list", "second item of a list"])
    rows = [(1, "u", page, 0), (2, None, None, 0), (3, "u", "", 0), (4, "u", "<p>A sentence of the article that is cut off, with words of it &amp; <b", 0), (4, "u", "<p>A sentence of the article that is cut off, with words of it &amp; <b", 0), (None, "u", "plain <!-- open", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    cut = "A sentence of the article that is cut off, with words of it &"
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in page_model.extract(df).collect())
    assert got == [(0, "plain", 5), (1, want, len(want)), (2, "", 0), (3, "", 0), (4, cut, len(cut)), (4, cut, len(cut))]
    assert page_model.extract(df.filter("false")).count() == 0 and html_extract.fit(df.filter("false")) is not None


def test_attributes_like_the_training_mark(page_model, spark):
    text = "A paragraph of the article with enough words, stops and so on to be one. It goes on a little."
    page = lambda tag: f"<article {tag}><p {tag}>{text}</p></article>"
    tags = ["", "data-main", "data-main-nav='1'", "title='data-main'", "data-main=", "data-main='x'", "data-main=9"]
    df = spark.createDataFrame([(i, "u", page(t)) for i, t in enumerate(tags)], "page_id long, url string, html string")
    assert [r.text for r in page_model.extract(df).collect()] == [text] * len(tags)
    assert html_extract.fit(df) is not None


@pytest.mark.parametrize(
    "source",
    ["<a " * 1_700_000, "<div>" * 100_000 + "deep", "<p>x</b>" * 100_000, "<ul><li><div>" * 40_000, "<a '>' " * 300_000, "</script " * 300_000, "<noscript>" * 300_000, "<!-- a --!> " * 200_000, "<div></p>" * 100_000, "<!--" * 500_000],
)
def test_long_and_odd_pages_take_seconds(page_model, source):
    began = time.perf_counter()
    page_model.texts([source, "<article><p>" + "Some words of a plain text. " * 9 + "</p></article>"])
    assert time.perf_counter() - began < 20


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    model = BoostedTrees(trees=40).fit(x[:3000], y[:3000])
    assert ((model.logit(x[3000:]) > 0) == (y[3000:] == 1)).mean() > 0.97


LICENSES = [("Licensed under the Apache License, Version 2.0.", "Apache-2.0"), ("Released under the MIT License.", "MIT"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC"), ("This work is licensed under the GNU General Public License, version 3.", "GPL")]


def test_license_lines_are_found_exactly(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r.families for r in QUERIES["op3_license_scan"](spark, folder).collect()}
    for row in spark.read.parquet(f"{folder}/documents.parquet").collect():
        want = sorted({f for line, f in LICENSES if line in row.text.split("\n")})
        assert got[row.doc_id] == ",".join(want)


def test_license_edge_cases(spark, awkward, awkward_docs, no_docs):
    plain = [x.encode().split() for x in ("the cat sat on the mat and looked about", "words without any law in them") for _ in range(40)]
    model = license_scan.train(plain)
    long = "word " * 500 + "This software is available under BSD 3-Clause License " + "word " * 500
    rows = [(1, None), (2, ""), (3, "the cat sat\nReleased under the MIT License.\nLicensed under CC BY-SA 4.0"), (4, long), (4, long), (5, "A driving license is required."), (6, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License")]
    got = sorted((r.doc_id, r.n_paragraphs, r.families) for r in model.documents(docs_frame(spark, rows)).collect())
    assert got == [(1, 0, ""), (2, 0, ""), (3, 3, "CC-BY-SA,MIT"), (4, 1, "BSD"), (4, 1, "BSD"), (5, 1, ""), (6, 1, "GPL")]
    assert {(r.line, r.family) for r in model.paragraphs(docs_frame(spark, rows[2:3])).filter("confirmed").collect()} == {(1, "MIT"), (2, "CC-BY-SA")}
    assert model.documents(awkward_docs).count() == len(awkward) and license_scan.fit(no_docs).documents(no_docs).count() == 0


def test_all_families_of_wrapped_and_dual_statements():
    model = license_scan.train([b"the cat sat on the mat and looked about".split()] * 40)
    gnu = "This {} is free software{} you can redistribute it and/or modify\nit under the terms of the GNU {} Public License"
    isc = "Permission to use, copy, modify, and/or distribute this software\nfor any purpose with or without fee is hereby granted"
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met"
    texts = {
        "Dual licensed under the MIT License and the Apache License, Version 2.0": "Apache-2.0,MIT",
        bsd: "BSD",
        f"word\n\n{isc}\nword": "ISC",
        f"# {bsd}".replace("\n", "\n# "): "BSD",
        f"{isc}\n\n{bsd}": "BSD,ISC",
        "Released under the Mozilla Public\nLicense 2.0": "MPL-2.0",
        gnu.format("program", ":", "General"): "GPL",
        gnu.format("library", ";", "Lesser General"): "LGPL",
        gnu.format("program", ":", "Affero General"): "AGPL-3.0",
        "Licensed under CC BY-SA 4.0 or GPLv3": "CC-BY-SA,GPL",
        "with or without\n\nmodification is the general public": "",
    }
    hits = model.scan(list(texts))
    assert [",".join(sorted({f for _, f, _, sure in h if sure})) for h in hits] == list(texts.values())
    assert [x for h in hits[1:4] for x in h if not x[3]] == [] and [h[0][0] for h in hits[1:4]] == [0, 2, 0]


@pytest.fixture(scope="module")
def real():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def fuzz(n, seed):
    rng = random.Random(seed)
    pools = ["abcdefghij ABC'sdtrevml 0123 !?.,<|>startofend", "éèÀßñ²³¹¼½ªº\x85\xa0\x1c\x1d\x1f", "ΣσςİıǅǄ", "漢字かな한국", "é̀̈ÅΩﬁ", "😀👍🏽‍🚀", "ⅷⅣ①٣४", " 　 ﻿", "АБВабвѲ", "ttttooooaa"]
    special = ["<|startoftext|>", "<|endoftext|>", "<|endoftext", "'s", "'LL", "don't"]
    return ["".join(rng.choice(rng.choice(pools)) if rng.random() < 0.93 else rng.choice(special) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_tokens_equal_the_library(real, awkward):
    mine = bpe.tokenizer(tokenizer_path())
    for text in [t or "" for _, t in awkward] + fuzz(6000, 1) + ["a" * 3000, "abcdefgh" * 400]:
        ids = real.encode(text, add_special_tokens=False).ids
        assert mine.encode(text) == (ids, " ".join(map(str, ids)))
        assert mine.decode(ids) == real.decode(ids, skip_special_tokens=False)


def test_every_character_is_split_as_in_the_library(real):
    mine = bpe.tokenizer(tokenizer_path())
    points = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x40000), *range(0xE0000, 0xE1000), *range(0x10FF00, 0x110000)]]
    for k in range(0, len(points), 40):
        for text in ("".join(points[k : k + 40]), "a ".join(points[k : k + 40])):
            assert mine.encode(text)[0] == real.encode(text, add_special_tokens=False).ids


def merged_in_turn(symbols, merges):
    """BPE by its definition: the lowest-ranked pair first, from the left."""
    while len(symbols) > 1:
        rank, at = min((merges.get(pair, 1 << 30), i) for i, pair in enumerate(zip(symbols, symbols[1:])))
        if rank == 1 << 30:
            break
        symbols[at : at + 2] = ["".join(symbols[at : at + 2])]
    return symbols


@pytest.mark.parametrize("seed", range(20))
def test_automaton_equals_merging_for_random_merges(seed):
    rng = random.Random(seed)
    tokens, merges = list("abc"), []
    while len(merges) < 25:
        pair = (rng.choice(tokens), rng.choice(tokens))
        if pair not in merges and "".join(pair) not in tokens:
            merges.append(pair)
            tokens.append("".join(pair))
    automaton = bpe.TokenAutomaton({t: i for i, t in enumerate([*tokens, ""])}, merges, "")
    automaton.end = ""
    ranks = {p: i for i, p in enumerate(merges)}
    for _ in range(300):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 14)))
        last, token = rng.randrange(len(tokens)), rng.randrange(len(tokens))
        assert {last, token} & automaton.dead or automaton.follows(last, token) == automaton._has_arc(last, token)
        assert [tokens[i] for i in automaton.word(word)] == merged_in_turn(list(word), ranks)


def test_token_tables(spark, real, awkward, awkward_docs, no_docs):
    got = sorted((r.doc_id or -1, len(r.ids), r.decoded) for r in bpe.encode_documents(awkward_docs, tokenizer_path()).collect())
    want = sorted((d or -1, len(x := real.encode(t or "", add_special_tokens=False).ids), real.decode(x, skip_special_tokens=False)) for d, t in awkward)
    assert got == want
    assert bpe.token_digests(no_docs, tokenizer_path()).count() == 0


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op6_zstd_quality"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out").collect()
    good, bad = ([r.score for r in got if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.98
    assert np.mean([r.predicted == r.quality for r in got]) > 0.96


def test_quality_edge_cases(spark, awkward, awkward_docs, no_docs):
    rng = random.Random(0)
    prose = lambda: " ".join(rng.choice(["some", "plain", "words", "of", "text", "and", "more"]) for _ in range(80))
    junk = lambda: "".join(rng.choice("#$%&|<>*") for _ in range(300))
    docs = docs_frame(spark, [(i, prose() if i % 2 else junk()) for i in range(300)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(5, None), (None, 1), (7, 9)], "doc_id long, quality int")
    model = quality_zstd.fit(docs, labels)
    got = {r.doc_id: r for r in model.score(docs_frame(spark, [(1, prose()), (2, junk()), (3, None), (4, "")])).collect()}
    assert got[1].score > 0.7 > 0.3 > got[2].score and got[3].score == got[4].score and 0 <= got[3].score <= 1
    assert model.score(awkward_docs).count() == len(awkward) and model.score(no_docs).count() == 0
    assert {r.score for r in quality_zstd.fit(docs, labels.filter("quality = 1")).score(awkward_docs).collect()} == {0.5}
