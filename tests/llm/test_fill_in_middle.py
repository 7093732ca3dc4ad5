"""Fill-in-the-middle: chunks, cuts and the exact way back."""

import hashlib
import random

import numpy as np
import pytest
from llm_samples import docs_frame
from pyspark.sql import functions as F

from skyspark.llm import fill_in_middle as fim


def by_code_points(doc_id, text):
    """The contract, over Python strings."""
    text = text or ""
    n = len(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def some_texts(n=300):
    rng = random.Random(9)
    shared = "".join(rng.choice("abc é漢😀\n") for _ in range(6000))
    rows = [(i, "".join(rng.choice("ab <PSM>é漢😀ß\n") for _ in range(rng.choice([0, 1, 2, 40, 700, 5000])))) for i in range(n)]
    rows += [(1000 + i, "x" * i + shared[i * 10 :]) for i in range(20)]
    rows += [(2000, None), (2001, ""), (2001, ""), (None, "no id " * 50), (2002, "a<P>b"), (2003, "<<P"), (2004, "<"), (2005, "漢" * 300_000), (2006, "y" * 3_000_000), (2006, "y" * 3_000_000)]
    rows += [(3000 + i, "<" * 40 + "S>" * i) for i in range(20)]
    return rows


def test_equals_code_points_and_comes_back(spark):
    rows = some_texts()
    found = fim.fill_in_middle(docs_frame(spark, rows).repartition(3))
    got = found.withColumn("restored", fim.restore(F.col("output"), F.col("form"))).collect()
    want = sorted((repr((i, *by_code_points(i, t), t or "")) for i, t in rows))
    assert sorted(repr(tuple(r)) for r in got) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_empty_table(spark, no_docs):
    assert fim.fill_in_middle(no_docs).count() == 0


def split(text):
    data = np.frombuffer(text, np.uint8)
    ends = fim.chunk_ends(fim.cut_places(data), 0, len(text))
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def test_chunks_follow_content():
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh éß漢") for _ in range(60_000)).encode()
    chunks = split(text)
    assert b"".join(chunks) == text
    assert all(fim.MIN_CHUNK <= len(c) <= fim.MAX_CHUNK for c in chunks[:-1])
    moved = split(b"some words before it all, " * 7 + text)
    assert len(set(chunks) & set(moved)) > 0.9 * len(set(chunks))
    assert split(b"z" * 5000) == [b"z" * fim.MAX_CHUNK, b"z" * fim.MAX_CHUNK, b"z" * (5000 - 2 * fim.MAX_CHUNK)] and split(b"") == []


def test_a_text_is_cut_alike_wherever_it_lies_in_a_batch():
    rng = random.Random(3)
    texts = ["".join(rng.choice("abé ") for _ in range(rng.randint(0, 3000))).encode() for _ in range(40)]
    places, lo = fim.cut_places(np.frombuffer(b"".join(texts), np.uint8)), 0
    for text in texts:
        ends = [e - lo for e in fim.chunk_ends(places, lo, lo + len(text))]
        assert [text[a:b] for a, b in zip([0, *ends], ends)] == split(text)
        lo += len(text)


def test_summaries_combine_at_any_byte():
    text = "aé漢😀b漢漢é😀".encode()
    whole = fim.summarize(text)
    assert whole == (9, 0, 0)
    for i in range(len(text) + 1):
        for j in range(i, len(text) + 1):
            assert fim.joined(fim.joined(fim.summarize(text[:i]), fim.summarize(text[i:j])), fim.summarize(text[j:])) == whole


def test_memo_goes_by_content_and_forgets():
    memo = fim.ChunkMemo(limit=1000)
    assert memo(b"abc") == memo(b"abc") == (3, 0, 0) and memo.hits == 1
    for i in range(100):
        chunk = ("é" * 50 + str(i)).encode()
        assert memo(chunk) == (50 + len(str(i)), 0, 0)
    assert len(memo.known) < 10
    memo.known.clear()  # as tasks do at their end
    assert memo(b"abc") == (3, 0, 0)


@pytest.mark.parametrize("size", [1, 63, 64, 65, 2047, 2048, 2049, 4500])
def test_cuts_of_every_code_point(size):
    text = ("é漢a😀" * size)[:size].encode()
    ends = fim.chunk_ends(fim.cut_places(np.frombuffer(text, np.uint8)), 0, len(text))
    before = [0]
    for a, b in zip([0, *ends], ends):
        before.append(before[-1] + fim.summarize(text[a:b]).leads)
    plain = text.decode()
    for k in range(0, size + 1, max(1, size // 50)):
        assert fim.byte_of(text, [0, *ends], before, k) == len(plain[:k].encode())
