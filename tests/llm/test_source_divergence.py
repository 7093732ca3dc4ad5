"""Source divergence against a count over plain strings."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_samples import docs_frame

from skyspark.llm import source_divergence as sd

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def by_words(rows, min_docs, top=50):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [((lang or ""), (source or ""), TERM.findall((text or "").translate(lower))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        in_docs = Counter(t for d in mine for t in set(d[2]))
        kept = sorted(t for t, n in in_docs.items() if n >= min_docs)
        sources = sorted({d[1] for d in mine})
        counts = {s: Counter(t for d in mine if d[1] == s for t in d[2]) for s in sources}

        def share(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + (1_000_000_000 * (count[t] + 5)) // (total + 5 * len(kept)) for t in kept}

        p = {s: share(c) for s, c in counts.items()}
        q = share(sum(counts.values(), Counter()))
        for s in sources:
            pairs = [("pair", o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [("term", t, p[s][t] - q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part in (pairs, sorted(terms, key=lambda x: (-x[2], x[1].encode()))[:top]):
                out += [(lang, s, *x, i) for i, x in enumerate(sorted(part, key=lambda x: (-x[2], x[1].encode())), 1)]
    return sorted(out)


def corpus(n=400):
    rng = random.Random(5)
    words = ["The", "the", "THE,", "end.", "End", "naïve", "NAÏVE", "漢字", "a-b", "x1y2z", "--", "42", "it's", "É\u00a0é", "\x1cend\x1c", *[f"w{c}" for c in "abcdefghij"]]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "en", "de", None])
        some = rng.sample(words, rng.randint(1, len(words)))
        rows.append((i, rng.choice([" ", "\n", "\t ", "\x0b"]).join(rng.choice(some) for _ in range(rng.randint(0, 60))), lang, rng.choice(["s0", "s0", "s1", "s2", None, "Ünder"])))
    rows += [(n, None, "en", "s0"), (n, None, "en", "s0"), (n + 1, "", "xx", "alone"), (n + 2, "rare words only", "yy", "a"), (n + 3, "rare words", "yy", "b"), (None, "the " * 20_000 + "x" * 100_000, "en", "s9")]
    return rows


@pytest.mark.parametrize("min_docs, batch", [(30, None), (1, None), (5, 7), (1000, None)])
def test_equals_counting_words(spark, monkeypatch, min_docs, batch):
    rows = corpus()
    docs = docs_frame(spark, rows).repartition(3)
    if batch:  # so that batches, blocks and tiles are several; tasks get the values with the functions
        found = run_with(spark, docs, min_docs, BATCH_DOCS=batch, BLOCK_TERMS=4, TILE_SOURCES=2)
    else:
        found = sorted(map(tuple, sd.divergence(docs, min_docs).collect()))
    assert found == by_words(rows, min_docs)


def run_with(spark, docs, min_docs, **values):
    """Spark's workers import the module themselves, so the constants are set inside the tasks as well."""
    held = {k: getattr(sd, k) for k in values}
    count, compare = sd._count_chunks, sd._compare

    def wrapped(f, *args):
        import skyspark.llm.source_divergence as module

        for k, v in values.items():
            setattr(module, k, v)
        try:
            result = f(*args)
            return iter(list(result)) if f.__name__ == "_count_chunks" else result
        finally:
            for k, v in held.items():
                setattr(module, k, v)

    try:
        for k, v in values.items():
            setattr(sd, k, v)
        sd._count_chunks = lambda batches: wrapped(count, batches)
        sd._compare = lambda key, a, b: wrapped(compare, key, a, b)
        return sorted(map(tuple, sd.divergence(docs, min_docs).collect()))
    finally:
        sd._count_chunks, sd._compare = count, compare
        for k, v in held.items():
            setattr(sd, k, v)


def test_no_rows(spark, no_docs):
    assert sd.divergence(no_docs).count() == 0


def test_equal_values_beyond_the_top_are_ranked_by_bytes(spark):
    names = [f"t{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(80)]
    rows = [(i, " ".join(names), "en", "a") for i in range(3)] + [(9, "other other other", "en", "b")] * 3
    found = [r for r in sd.divergence(docs_frame(spark, rows), 3).collect() if r.part == "term" and r.source == "a"]
    assert [r.item for r in sorted(found, key=lambda r: r.rank)] == names[:50]


def test_shares_are_exact_beyond_float_and_product():
    rng = random.Random(1)
    for total in (0, 10, 10**9, 5 * 10**12, 9 * 10**15):
        counts = [0, 1, total, total // 3, rng.randint(0, total)]
        got = sd.shares(np.array(counts, np.int64), total, 77).tolist()
        assert got == [1 + 10**9 * (c + 5) // (total + 5 * 77) for c in counts]
    with pytest.raises(OverflowError):
        sd.shares(np.array([1]), 10**16, 1)
