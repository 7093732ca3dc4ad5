"""License statements in documents (operator 3).

Each line of a text is judged, long ones in overlapping windows of words, and so are the
words around every place that looks like a template. A logistic regression on hashed word
n-grams (one to three words) gives the odds of each license family and of "unknown", the
class of ordinary text and of other licenses. It learns from statements in some wordings;
in other wordings, and on licenses it never saw, its confidence is calibrated and the least
odds of a prediction against "unknown" are chosen, so that of what is unknown there at most
one in a hundred would pass (or the odds are MOST).

What is predicted is then compared with the templates of its family: one of its sentences,
of which nearly all word pairs must be there, one of its names beside a word of licensing, or,
where a line is predicted as a whole, one of its short names beside such a word. A family
counts as confirmed if both agree, so neither a template nor a prediction alone makes one.
Templates are sought in blocks, the lines between two blank ones taken together, so a
hard-wrapped statement is found and stands at its first line. A line that is only
predicted counts as unconfirmed.

Defined cases: a null or empty text has no paragraphs; lines of white space are none; a long
line is judged in all its windows; of families that tie in a line the first by name is
predicted; repeated rows are scanned once each; an empty table gives an empty result, also
for training, which then knows only the statements here; further columns are ignored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import rolling, word_hashes

#: Names of license families and sentences of their texts.
NAMES = {
    "AGPL-3.0": ["GNU Affero General Public License", "GNU AGPL version 3", "AGPL-3.0", "AGPLv3"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0", "Apache 2.0 license", "ASL 2.0"],
    "BSD": ["BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "BSD-3-Clause", "BSD-2-Clause", "New BSD license"],
    "CC-BY": ["Creative Commons Attribution 4.0 International License", "CC BY 4.0", "CC-BY-4.0", "CC BY 3.0"],
    "CC-BY-NC": ["Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0", "CC-BY-NC-4.0", "CC BY-NC-SA 4.0", "CC BY-NC-ND 4.0"],
    "CC-BY-SA": ["Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0", "CC-BY-SA-4.0", "CC BY-SA 3.0"],
    "CC0": ["CC0 1.0 Universal", "CC0 1.0", "CC0 Public Domain Dedication", "CC0-1.0"],
    "GPL": ["GNU General Public License, version 3", "GNU General Public License version 2", "GNU GPL version 3", "GNU General Public License", "GPL-3.0", "GPLv3", "GPLv2", "GPL-2.0"],
    "ISC": ["ISC License"],
    "LGPL": ["GNU Lesser General Public License", "GNU LGPL", "LGPL-3.0", "LGPL-2.1", "LGPLv3"],
    "MIT": ["MIT License", "MIT license", "Expat License"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0", "MPL 2.0"],
    "Unlicense": ["Unlicense", "The Unlicense"],
}
SENTENCES = {
    "Apache-2.0": ["you may not use this file except in compliance with the License", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "GPL": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "LGPL": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"],
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License"],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
}
#: Short names that confirm a predicted line, as words.
SHORT = {
    "AGPL-3.0": ["agpl", "agplv3", "affero"],
    "Apache-2.0": ["apache", "asl"],
    "BSD": ["bsd"],
    "CC-BY": ["cc by", "creative commons attribution"],
    "CC-BY-NC": ["cc by nc", "attribution noncommercial", "attribution non commercial"],
    "CC-BY-SA": ["cc by sa", "attribution sharealike", "attribution share alike"],
    "CC0": ["cc0", "cc zero"],
    "GPL": ["gpl", "gplv2", "gplv3", "gnu general public"],
    "ISC": ["isc"],
    "LGPL": ["lgpl", "lgplv3", "lesser general public", "lesser gpl"],
    "MIT": ["mit", "expat"],
    "MPL-2.0": ["mpl", "mozilla"],
    "Unlicense": ["unlicense"],
}
FRAMES = [
    "Licensed under {}", "Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.", "Distributed under the terms of the {}.", "This software is available under {}",
    "License: {}", "SPDX-License-Identifier: {}", "This content is licensed under a {}.", "Published under {}.", "The code is covered by the {}.", "Dual licensed under {}", "Copyright 2021. All rights granted under {}.",
    "You may copy and change this under the {} or any later version", "Use of this file is governed by the {}", "See the file COPYING for the {}", "All files here fall under {}",
    "This is {} licensed software", "The {} licence applies to the sources", "licensed {}",
]
#: Wordings that are not learned from but calibrated with.
HELD_FRAMES = [
    "The contents of this page are offered under {}", "This project uses the {} license", "Source code in this directory may be redistributed under terms of {}.", "Unless noted otherwise, {} applies to this document.", "Available under {} from the author",
]
#: Statements of other licenses, for the unknown class: the first are learned from, the others calibrated with.
OTHERS = [
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely",
    "Licensed under the zlib License.", "Eclipse Public License - v 2.0", "This program is made available under the terms of the Eclipse Public License 2.0", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE", "Released under the WTFPL",
    "The Artistic License 2.0", "Licensed under the Academic Free License version 3.0", "Common Development and Distribution License (CDDL) Version 1.0", "Licensed under the EUPL", "Open Font License Version 1.1", "All rights reserved.", "This is proprietary software. A commercial license is required.",
]
HELD_OTHERS = [
    "Boost Software License - Version 1.0", "Distributed under the Boost Software License, Version 1.0.", "Permission is hereby granted to any person or organization obtaining a copy of the software covered by this license", "PostgreSQL License", "Python Software Foundation License Version 2",
    "This font is licensed under the SIL Open Font License", "Microsoft Public License (Ms-PL)", "Released under the Beerware license", "Open Software License 3.0", "The end user license agreement applies", "Licensed to the customer under the terms of the sales contract", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License",
]
LICENSING = {"license", "licensed", "licence", "licenced", "licensing", "under", "terms", "released", "distributed", "spdx", "identifier", "copyright", "dedication", "published", "covered"}
#: Ordinary sentences with words of licensing, for the unknown class.
ORDINARY = ["A driving license is required.", "The software was released in May.", "Under the terms of the contract the work is free.", "He holds a public license.", "Copyright questions were discussed.", "The general public is free to use the library.", "Version 2.0 of the file.", "The apache helicopter and the mit campus.", "Creative work and commons."]

UNKNOWN = "unknown"
FAMILIES = [UNKNOWN, *sorted(NAMES)]
WINDOW, STRIDE = 32, 16
BUCKETS = 1 << 15
#: Bound of the corpus sample for the unknown class: documents and windows.
SAMPLE_DOCS = 400
SAMPLE_WINDOWS = 8000
#: Share of the unknown that may pass as predicted, and between what the least odds are chosen.
PASS_SHARE = 0.01
LEAST, MOST = 0.5, 0.9
TEMPLATE_SHARE = 0.8
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(paragraph: bytes) -> list[bytes]:
    return _WORD.findall(paragraph.lower())


def windows_of(words: list[bytes]) -> list[tuple[int, int]]:
    if len(words) <= WINDOW:
        return [(0, len(words))]
    return [(lo, min(lo + WINDOW, len(words))) for lo in range(0, len(words) - STRIDE, STRIDE)]


def _features(windows: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of all windows, and the window of each."""
    flat = word_hashes([w for words in windows for w in words])
    owner = np.repeat(np.arange(len(windows)), list(map(len, windows)))
    buckets, owners = [], []
    for size in (1, 2, 3):
        grams = rolling(flat, size) + np.uint64(size)
        inside = owner[: len(grams)] == owner[size - 1 :]
        buckets.append((grams[inside] % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(owner[: len(grams)][inside])
    return np.concatenate(buckets), np.concatenate(owners)


def _pairs(words: list[bytes]) -> set[tuple[bytes, ...]]:
    return set(zip(words, words[1:])) if len(words) > 1 else {tuple(words)}


_NAME_WORDS = {f: [b" " + b" ".join(words_of(n.encode())) + b" " for n in names] for f, names in NAMES.items()}
_LICENSING = {w.encode() for w in LICENSING}
_SHORT = {f: [b" " + n.encode() + b" " for n in names] for f, names in SHORT.items()}


def short_name(family: str, words: list[bytes]) -> bool:
    """Whether the words hold a short name of the family and one of licensing."""
    text = b" " + b" ".join(words) + b" "
    return not _LICENSING.isdisjoint(words) and any(n in text for n in _SHORT[family])


@dataclass(frozen=True)
class Sentence:
    family: str
    size: int  # words
    pairs: frozenset
    #: The longest pairs and their places; a text with TEMPLATE_SHARE of the pairs holds one of these.
    anchors: tuple[tuple[bytes, int], ...]

    @classmethod
    def of(cls, family: str, sentence: str) -> Sentence:
        words = words_of(sentence.encode())
        pairs = _pairs(words)
        places = {p: i for i, p in reversed(list(enumerate(zip(words, words[1:]))))}
        missing = sum(len(pairs) - k >= TEMPLATE_SHARE * len(pairs) for k in range(1, len(pairs)))
        longest = sorted(pairs, key=lambda p: (-len(p[0]) - len(p[1]), p))[: missing + 1]
        return cls(family, len(words), frozenset(pairs), tuple((b" " + b" ".join(p) + b" ", places[p]) for p in longest))


_SENTENCES = [Sentence.of(f, s) for f, sentences in SENTENCES.items() for s in sentences]


def _places(text: bytes, part: bytes) -> list[int]:
    """The words of a text (a blank before and after each) at which a part starts."""
    out, at, word, last = [], text.find(part), 0, 0
    while at >= 0:
        word, last = word + text.count(b" ", last, at), at
        out.append(word)
        at = text.find(part, at + 1)
    return out


def template_matches(words: list[bytes]) -> list[tuple[str, int, int]]:
    """(family, first word, end) of every name beside a word of licensing and every sentence of which nearly all is there. A longer name outdoes a shorter one in it."""
    text = b" " + b" ".join(words) + b" "
    names: list[tuple[str, int, int]] = []
    if not _LICENSING.isdisjoint(words):
        for family, parts in _NAME_WORDS.items():
            for part in parts:
                if part in text:
                    size = part.count(b" ") - 1
                    names += [(family, i, i + size) for i in _places(text, part) if not _LICENSING.isdisjoint(words[max(0, i + size - WINDOW) : i + WINDOW])]
        reach: dict[int, int] = {}
        for _, i, end in names:
            reach[i] = max(reach.get(i, 0), end)
        names = [x for x in names if reach[x[1]] == x[2] and not any(reach.get(i, 0) >= x[2] for i in range(x[1] - WINDOW, x[1]))]
    family_at = {i: family for family, i, _ in names}
    found: dict[int, list[tuple[float, str, int, int]]] = {}  # by first word // WINDOW
    for sentence in _SENTENCES:
        spots = sorted({i - k for anchor, k in sentence.anchors if anchor in text for i in _places(text, anchor)})
        end = -1
        for spot in spots:
            if spot < end:
                continue
            lo = max(0, spot - WINDOW + sentence.size)
            near = list(zip(words[lo : spot + WINDOW], words[lo + 1 : spot + WINDOW]))
            share = len(sentence.pairs.intersection(near)) / len(sentence.pairs)
            if share >= TEMPLATE_SHARE:
                first = next((i for i in range(max(0, spot), lo + len(near)) if near[i - lo] in sentence.pairs), max(0, spot))
                end = spot + sentence.size
                inside = {family_at[i] for i in range(first, end) if i in family_at}
                if not inside or sentence.family in inside:  # the sentence of another license in the same words
                    found.setdefault(first // WINDOW, []).append((share, sentence.family, first, min(end, len(words))))
    # of two sentences that differ in a few words the better match counts
    kept = [
        x
        for at, some in found.items()
        for x in some
        if not any(y[1] != x[1] and y[0] > x[0] and min(x[3], y[3]) - max(x[2], y[2]) > (x[3] - x[2]) / 2 for k in (at - 1, at, at + 1) for y in found.get(k, ()))
    ]
    return sorted({*names, *(x[1:] for x in kept)}, key=lambda x: (x[1], x))


def template_families(words: list[bytes]) -> set[str]:
    """Families of which a template is found in the words."""
    return {f for f, _, _ in template_matches(words)}


def odds(p: np.ndarray) -> np.ndarray:
    """Of each family (all but the first column) against "unknown" alone, so that two families in one window don't weaken each other."""
    return p[:, 1:] / (p[:, 1:] + p[:, :1])


@dataclass
class LicenseModel:
    weights: np.ndarray  # buckets x families
    bias: np.ndarray
    temperature: float = 1.0
    #: A predicted family has odds against "unknown" above this.
    threshold: float = LEAST

    def logits(self, windows: list[list[bytes]]) -> np.ndarray:
        buckets, owners = _features(windows)
        order = np.argsort(owners, kind="stable")
        buckets, owners = buckets[order], owners[order]
        counts = np.bincount(owners, minlength=len(windows))
        out = np.zeros((len(windows), len(FAMILIES)), np.float32)
        filled = np.flatnonzero(counts)
        if len(filled):
            starts = np.r_[0, np.cumsum(counts[filled])][:-1]
            out[filled] = np.add.reduceat(self.weights[buckets], starts, axis=0) / np.sqrt(counts[filled])[:, None]
        return out + self.bias

    def probabilities(self, windows: list[list[bytes]]) -> np.ndarray:
        z = self.logits(windows) / self.temperature
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        return p / p.sum(axis=1, keepdims=True)

    def train(self, windows: list[list[bytes]], target: np.ndarray, epochs: int = 12) -> None:
        """Softmax regression on shares of families (windows x families) by full-batch steps with per-weight scaling."""
        buckets, owners = _features(windows)
        size = np.sqrt(np.bincount(owners, minlength=len(windows)))
        scale = np.full(self.weights.shape, 1e-8, np.float32)
        for _ in range(epochs * 5):
            p = (self.probabilities(windows) - target) / np.maximum(size, 1)[:, None]
            for k in range(len(FAMILIES)):
                g = np.bincount(buckets, p[owners, k], BUCKETS).astype(np.float32)
                scale[:, k] += g * g
                self.weights[:, k] -= 0.5 * g / np.sqrt(scale[:, k])

    def calibrate(self, windows: list[list[bytes]], labels: np.ndarray) -> None:
        """Temperature and least odds from windows that nothing was learned from."""
        z, loss = self.logits(windows), {}
        for t in np.geomspace(0.25, 4, 17):
            q = z / t
            q = q - q.max(axis=1, keepdims=True)
            loss[t] = -(q[np.arange(len(labels)), labels] - np.log(np.exp(q).sum(axis=1))).mean()
        self.temperature = float(min(loss, key=loss.get))
        unknown = odds(self.probabilities([w for w, k in zip(windows, labels) if not k])).max(axis=1)
        self.threshold = float(np.clip(np.quantile(unknown, 1 - PASS_SHARE), LEAST, MOST)) if len(unknown) else LEAST

    def scan_text(self, text: str | None) -> list[tuple[int, str, float, bool]]:
        return self.scan([text])[0]

    def scan(self, texts: list[str | None]) -> list[list[tuple[int, str, float, bool]]]:
        """For each text its lines that state a license: line number, family, probability, confirmed."""
        best: list[dict[tuple[int, str], tuple[bool, float]]] = [{} for _ in texts]
        heads: list[set[tuple[int, str]]] = [set() for _ in texts]  # first lines of confirmed statements, and all of them
        inside: list[set[tuple[int, str]]] = [set() for _ in texts]
        windows: list[list[bytes]] = []
        places: list[tuple[int, int, str | None, set[int]]] = []  # text, line, and if a template is there its family and lines

        def judge() -> None:
            p = self.probabilities(windows)
            top, against = p[:, 1:].argmax(axis=1) + 1, odds(p)
            for i, (number, line, family, lines) in enumerate(places):
                if family is None:
                    k = int(top[i])
                    stated = bool(against[i, k - 1] > self.threshold)
                    sure = stated and short_name(FAMILIES[k], windows[i])
                else:
                    k = FAMILIES.index(family)
                    stated = sure = bool(against[i, k - 1] > self.threshold)
                    if sure:
                        heads[number].add((line, family))
                        inside[number] |= {(x, family) for x in lines}
                if stated:
                    key = (line, FAMILIES[k])
                    best[number][key] = max(best[number].get(key, (False, 0.0)), (sure, float(p[i, k])))
            windows.clear()
            places.clear()

        for number, text in enumerate(texts):
            words: list[bytes] = []
            lines: list[int] = []
            for line, paragraph in enumerate([*(text or "").encode("utf-8", "surrogatepass").split(b"\n"), b""]):
                some = words_of(paragraph)
                if some:
                    for lo, hi in windows_of(some):
                        windows.append(some[lo:hi])
                        places.append((number, line, None, set()))
                    words += some
                    lines += [line] * len(some)
                if words and not paragraph.strip():
                    for family, first, end in template_matches(words):
                        lo = max(0, min(first, (first + end - WINDOW) // 2))
                        windows.append(words[lo : lo + WINDOW])
                        places.append((number, lines[first], family, set(lines[first:end])))
                    words, lines = [], []
                if len(windows) >= 20_000:
                    judge()
        if windows:
            judge()
        # a confirmed statement stands at its first line alone
        return [sorted((*key, score, sure) for key, (sure, score) in x.items() if key in h or key not in y) for x, y, h in zip(best, inside, heads)]

    def paragraphs(self, docs: DataFrame) -> DataFrame:
        """One row for each paragraph that states a license: doc_id, line, family, score, confirmed."""
        model = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(doc, *x) for doc, hits in zip(batch.column(0).to_pylist(), model.scan([t.as_py() for t in batch.column(1)])) for x in hits]
                columns = list(zip(*rows)) or [[]] * 5
                types = [pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "line", "family", "score", "confirmed"])

        return _picked(docs).mapInArrow(run, "doc_id long, line int, family string, score double, confirmed boolean")

    def documents(self, docs: DataFrame) -> DataFrame:
        """One row for each document: doc_id, n_paragraphs, families (confirmed, sorted, comma-joined), n_licensed and n_unconfirmed paragraphs."""
        model = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = [t.as_py() for t in batch.column(1)]
                hits = model.scan(texts)
                columns = [
                    batch.column(0),
                    pa.array([sum(map(bool, map(str.strip, (t or "").split("\n")))) for t in texts], pa.int64()),
                    pa.array([",".join(sorted({f for _, f, _, sure in h if sure})) for h in hits], pa.string()),
                    pa.array([len({x[0] for x in h if x[3]}) for h in hits], pa.int64()),
                    pa.array([len({x[0] for x in h} - {x[0] for x in h if x[3]}) for h in hits], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_paragraphs", "families", "n_licensed", "n_unconfirmed"])

        return _picked(docs).mapInArrow(run, "doc_id long, n_paragraphs long, families string, n_licensed long, n_unconfirmed long")


def _picked(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def statements(frames: list[str]) -> list[tuple[str, str]]:
    """(family, statement) from every name, full or short, in every frame, and the sentences."""
    names = [(f, name) for f in NAMES for name in [*NAMES[f], *(n.upper() for n in SHORT[f])]]
    return [(f, frame.format(name)) for f, name in names for frame in frames] + [(f, s) for f, sentences in SENTENCES.items() for s in sentences for _ in frames]


def train(corpus: list[list[bytes]]) -> LicenseModel:
    """Learn from composed statements, alone, by twos and amid corpus words, against other licenses and corpus windows that hold no template; calibrate in other wordings."""
    rng = random.Random(5)
    plain = [w for w in corpus if w and not template_families(w)]
    cut = len(plain) * 4 // 5
    model = LicenseModel(np.zeros((BUCKETS, len(FAMILIES)), np.float32), np.zeros(len(FAMILIES), np.float32))

    def composed(frames: list[str], around: list[list[bytes]]) -> list[tuple[list[bytes], list[str]]]:
        out, stated = [], statements(frames)
        for family, statement in stated:
            words = words_of(statement.encode())
            some = rng.choice(around) if around and rng.random() < 0.5 else []
            part = rng.randint(0, min(len(some), max(0, WINDOW - len(words))))
            out.append((words + some[:part] if rng.random() < 0.5 else some[:part] + words, [family]))
            other, second = rng.choice(stated)
            if other != family:
                out.append((words + rng.choice([b"or", b"and"]).split() + words_of(second.encode()), [family, other]))
        return out

    known = composed(FRAMES, plain[:cut])
    unknown = [*plain[:cut], *(words_of(x.encode()) for x in (*ORDINARY, *OTHERS) for _ in range(5)), *(words_of(f.format("").encode()) for f in FRAMES)]
    windows = [w for w, _ in known] + unknown
    target = np.zeros((len(windows), len(FAMILIES)), np.float32)
    for i, (_, families) in enumerate(known):
        for f in families:
            target[i, FAMILIES.index(f)] = 1 / len(families)
    target[len(known) :, 0] = 1
    model.train(windows, target)
    held = [(w, FAMILIES.index(f[0])) for w, f in composed(HELD_FRAMES, plain[cut:]) if len(f) == 1]
    held += [(w, 0) for w in (*plain[cut:], *(words_of(x.encode()) for x in HELD_OTHERS))]
    model.calibrate([w for w, _ in held], np.array([k for _, k in held]))
    return model


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_windows: int = SAMPLE_WINDOWS) -> LicenseModel:
    """Train against at most ``sample_windows`` windows of at most ``sample_docs`` documents, picked by hashes of their ids."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter(F.col("doc_id").isNotNull()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for line in (text.as_py() or "").encode("utf-8", "surrogatepass").split(b"\n"):
                    words = words_of(line)
                    rows += [(doc, len(rows), b" ".join(words[lo:hi])) for lo, hi in windows_of(words)]
            columns = list(zip(*rows)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.binary()])], ["doc_id", "number", "words"])

    sample = _picked(docs).join(F.broadcast(ids), "doc_id", "left_semi").mapInArrow(cut, "doc_id long, number long, words binary")  # ids: at most sample_docs
    rows = sample.orderBy(F.xxhash64("words"), "words").limit(sample_windows).select("words").collect()
    return train([bytes(r.words).split() for r in rows])
