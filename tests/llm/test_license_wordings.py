"""License statements in wordings that the model never saw, and who decides."""

import dataclasses
import random

import duckdb
import numpy as np
import pytest

from skyspark.llm import license_scan as ls

UNSEEN = {
    "You are free to copy this under GPL version 3": "GPL",
    "Use it under the conditions of the Apache 2 licence": "Apache-2.0",
    "Code is MIT licensed": "MIT",
    "Everything here is licensed MIT": "MIT",
    "Our code is BSD licensed": "BSD",
    "Text under CC BY-SA": "CC-BY-SA",
    "Photos: CC BY-NC 3.0 licensed": "CC-BY-NC",
    "Redistribution allowed under LGPL v2.1": "LGPL",
    "Licence: MPL 2": "MPL-2.0",
    "This file is under the AGPL": "AGPL-3.0",
    "placed under CC0 terms": "CC0",
}
NONE = [
    "Boost Software License - Version 1.0",
    "This software is provided 'as-is', without any express or implied warranty.",
    "The zlib/libpng license",
    "Under the GNU Free Documentation License",
    "under the terms of the EPL-2.0",
    "Er kam mit der Lizenz zum Bahnhof",
    "A driving license is required.",
    "The general public is free to use the library.",
    "he came under attack with MIT students",
    "Copyright law was discussed under the old terms.",
]


@pytest.fixture(scope="module")
def model():
    rows = duckdb.connect().execute("SELECT text FROM '/root/testdata/sf0.01/documents.parquet' WHERE text IS NOT NULL ORDER BY doc_id").fetchall()
    windows = [words[lo:hi] for (text,) in rows[:300] for words in map(ls.words_of, text.encode().split(b"\n")) for lo, hi in ls.windows_of(words)]
    random.Random(1).shuffle(windows)
    return ls.train(windows[:6000])


def families(model, text):
    return ",".join(sorted({f for _, f, _, sure in model.scan_text(text) if sure}))


def test_wordings_are_held_apart():
    composed = {s.lower() for _, s in ls.statements(ls.FRAMES + ls.HELD_FRAMES)}
    assert not composed & {s.lower() for s in (*UNSEEN, *NONE)} and not set(ls.FRAMES) & set(ls.HELD_FRAMES) and not set(ls.OTHERS) & set(ls.HELD_OTHERS)


def test_unseen_wordings(model):
    got = {text: families(model, text) for text in UNSEEN}
    wrong = {t: f for t, f in got.items() if f != UNSEEN[t]}
    assert len(wrong) <= 1, wrong
    assert {t: families(model, t) for t in NONE} == dict.fromkeys(NONE, "")


def test_neither_the_model_nor_a_template_decides_alone(model):
    text = "Released under the MIT License."
    assert families(model, text) == "MIT"
    blank = dataclasses.replace(model, weights=np.zeros_like(model.weights), bias=np.zeros_like(model.bias))
    assert families(blank, text) == "" and all(families(blank, t) == "" for t in UNSEEN)
    assert ls.template_families(ls.words_of(text.encode())) == {"MIT"}
    unconfirmed = [h for h in model.scan_text("This file is licensed under version 2.0 of the well known license of its foundation") if h[3]]
    assert unconfirmed == []


def test_few_of_the_unknown_pass(model):
    held = [ls.words_of(x.encode()) for x in ls.HELD_OTHERS]
    assert ls.LEAST <= model.threshold <= ls.MOST
    assert (ls.odds(model.probabilities(held)).max(axis=1) >= model.threshold).mean() <= 0.5  # whole licenses here; what passes needs a template too


def test_megabytes_and_many_statements(model):
    text = ("plain words of a text " * 2000 + "\n\nReleased under the MIT License.\n\n") * 40
    hits = [h for h in model.scan_text(text) if h[3]]
    assert len(hits) == 40 and {f for _, f, _, _ in hits} == {"MIT"}
