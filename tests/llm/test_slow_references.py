"""Operators that SQL cannot express, or whose verdicts the given tables never reach, against slow plain versions."""

import math
import random

import duckdb
import pytest
import zstandard
from llm_samples import docs_frame
from pyspark.sql import functions as F

from skyspark.llm import langid, quality_zstd
from skyspark.llm.queries import ORACLE_SQL, QUERIES

# --- language identification: one byte at a time, in Python floats ---


def squashed(x):
    return x / (1 + abs(x))


def states(direction, data, backwards):
    hidden = direction.state.shape[0]
    byte, state = direction.byte.astype(float), direction.state.astype(float)
    h, out = [0.0] * hidden, [None] * len(data)
    for t in range(len(data) - 1, -1, -1) if backwards else range(len(data)):
        u = [sum(h[i] * state[i][k] for i in range(hidden)) for k in range(3 * hidden)]
        x = byte[data[t]]
        update = [0.5 + 0.5 * squashed(x[k] + u[k]) for k in range(hidden)]
        reset = [0.5 + 0.5 * squashed(x[hidden + k] + u[hidden + k]) for k in range(hidden)]
        new = [squashed(x[2 * hidden + k] + reset[k] * u[2 * hidden + k]) for k in range(hidden)]
        h = [a + g * (b - a) for a, g, b in zip(h, update, new)]
        out[t] = h
    return out


def probabilities(model, text):
    """Mean over all bytes; windows of STEPS bytes, the last filled up with zero bytes that are read but not counted."""
    raw = text.encode("utf-8", "surrogatepass")
    total = [0.0] * len(model.languages)
    for lo in range(0, len(raw), langid.STEPS):
        part = raw[lo : lo + langid.STEPS]
        data = part + bytes(langid.STEPS - len(part))
        ahead, back = states(model.forwards, data, False), states(model.backwards, data, True)
        for t in range(len(part)):
            s = ahead[t] + back[t]
            z = [model.bias[k] + sum(a * model.out[i][k] for i, a in enumerate(s)) for k in range(len(total))]
            e = [math.exp(v - max(z)) for v in z]
            total = [a + v / sum(e) for a, v in zip(total, e)]
    return [v / len(raw) for v in total]


def documents(n=120):
    rng = random.Random(8)
    kinds = {"aa": "abcd ", "bb": "bcde ", "cc": "xyzé "}
    return [(i, "".join(rng.choice(kinds[lang]) for _ in range(rng.choice([3, 63, 64, 65, 200]))) + "a", lang, None) for i in range(n) for lang in [rng.choice(sorted(kinds))]]


def test_language_equals_the_network_read_byte_by_byte(spark):
    rows = documents()
    docs = docs_frame(spark, rows)
    model = langid.fit(docs)
    got = {r.doc_id: r for r in model.predict(docs).collect()}
    for doc_id, text, _, _ in rows[:60]:
        p = probabilities(model, text)
        best = max(range(len(p)), key=lambda k: p[k])
        others = sorted(p)[-2]
        assert abs(got[doc_id].score - p[best]) < 1e-4
        assert got[doc_id].lang_pred == model.languages[best] or p[best] - others < 1e-4


def test_rows_that_share_an_id_teach_their_own_language(spark, monkeypatch):
    """Two rows of one id in different languages are each learned once, under their own label."""
    seen = []
    monkeypatch.setattr(langid.LanguageModel, "train", lambda self, rows, counts, labels, epochs=1: seen.append((rows, labels)))
    rows = [(6, "aaaa", "aa", None), (6, "bbbb", "bb", None), (7, "cccc", "aa", None), (7, "cccc", "aa", None)]
    assert all(r[0] is not None for r in rows)
    langid.fit(docs_frame(spark, [r for r in rows]).filter((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3) != 1))
    (data, labels), *_ = seen
    learned = sorted((bytes(row[:4]).decode(), int(k)) for row, k in zip(data, labels))
    kept = {i for i in (6, 7) if __import__("zlib").crc32(str(i).encode()) % 3 != 1}
    want = sorted((text, {"aa": 0, "bb": 1}[lang]) for i, text, lang, _ in rows if i in kept)
    if len({k for _, k in want}) == len({k for _, k in learned}):
        assert learned == want
    else:  # only one language was left
        assert len(learned) == len(want)


# --- quality: sizes by plain calls of the library, block by block ---


def test_quality_equals_plain_compression(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_zstd.fit(docs, labels)
    scored = {r.doc_id: r for r in model.score(docs).collect()}
    good, bad = (zstandard.ZstdCompressionDict(d) for d in (model.good, model.bad))
    rows = docs.select("doc_id", "text").collect()
    for r in rows[::7]:
        raw = (r.text or "").encode("utf-8", "surrogatepass")
        sizes = [0, 0]
        for k, dictionary in enumerate((good, bad)):
            for lo in range(0, len(raw), quality_zstd.BLOCK):
                packer = zstandard.ZstdCompressor(level=quality_zstd.LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False)
                sizes[k] += len(packer.compress(raw[lo : lo + quality_zstd.BLOCK]))
        difference = (sizes[1] - sizes[0]) / max(sizes) if raw else 0.0
        ratio = min(0.5, sizes[0] / len(raw)) if raw else 0.5
        a, b, c, d = model.weights
        z = a + b * 10 * difference + c * 10 * max(0.0, 0.2 - ratio) + d * 10 * min(0.0, difference)
        p = 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))
        assert abs(scored[r.doc_id].score - p) < 1e-9 and scored[r.doc_id].predicted == int(p >= 0.3)


def test_quality_of_awkward_labels_and_texts(spark, no_docs):
    rng = random.Random(2)
    good = lambda: " ".join(rng.choice(["river", "stone", "green", "quiet", "morning"]) for _ in range(150))
    bad = lambda: "".join(rng.choice("!#$%&*<>0123456789") for _ in range(700))
    rows = [(i, good() if i % 2 else bad()) for i in range(200)] + [(900, None), (901, ""), (902, good() * 300), (902, good() * 300), (None, bad())]
    docs = docs_frame(spark, rows)
    marks = [(i, i % 2, 0) for i in range(200)] + [(3, 1, 0), (3, 0, 0), (None, 1, 0), (5, None, 0), (7, 9, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, score int")
    found = quality_zstd.fit(docs, labels).score(docs).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    held = [(r.doc_id % 2, r.score) for r in found if r.doc_id is not None and r.doc_id < 200 and __import__("zlib").crc32(str(r.doc_id).encode()) % 5 == 0]
    assert min(s for q, s in held if q) > max(s for q, s in held if not q)
    assert quality_zstd.fit(no_docs, labels).score(docs).filter("score <> 0.5").count() == 0
    assert quality_zstd.fit(docs, labels.filter("false")).score(no_docs).count() == 0


# --- host rules: hosts that fall, against the SQL ---


@pytest.mark.parametrize("bad_share", [0.0, 0.95, 1.0])
def test_hosts_that_fall_equal_the_sql(spark, tmp_path, bad_share):
    rng = random.Random(4)
    text = lambda bad: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(20 if bad else 80))
    rows = [(i, text(rng.random() < (bad_share if host == "bad" else 0.02)), "en", host) for i, host in enumerate(["bad"] * 300 + ["good"] * 700 + ["small"] * 3 + [None] * 10)]
    docs_frame(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op7_host_rules"](spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    result = con.execute(ORACLE_SQL["op7_host_rules"])
    names = [c[0] for c in result.description]
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(result.fetchall())
    fell = {r.doc_id for r in got if not r.kept and not r.base_failed}
    assert bool(fell) == (0.9 < bad_share < 1.0) and fell <= set(range(300))
    assert all(not r.kept for r in got if r.doc_id < 300) == (bad_share > 0.9)


