"""Operators 4, 7, 8, 9 and 10 against brute force on awkward documents, and all queries with SQL against DuckDB."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyspark.llm import decontam, host_rules, jaccard_join, line_dedup, substring_dedup
from skyspark.llm.common import connected_components
from skyspark.llm.queries import ORACLE_SQL, QUERIES

from llm_samples import docs_frame

SPACE = " \t\n\x0b\x0c\r"


def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def null(x):
    return -1 if x is None else x


def words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, duck, same_rows, name):
    same_rows(QUERIES[name](spark, sf_dir), duck, ORACLE_SQL[name])


def test_host_rules(spark, awkward, awkward_docs):
    def measure(text):
        w = words(text)
        grams = Counter(zip(w, w[1:], w[2:]))
        covered = {k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
        lines = [x for x in (text or "").split("\n") if x.strip(SPACE)]
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)

    got = sorted((null(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in host_rules.host_quality(awkward_docs).collect())
    assert got == sorted((null(d), *measure(t)) for d, t in awkward)


def test_bad_hosts_take_their_documents_along(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, "short", None, "bad") for i in range(95)] + [(100 + i, good, None, "bad") for i in range(5)]
    rows += [(200 + i, good if i % 10 else "short", None, "fine") for i in range(100)] + [(400, good, None, None), (401, good, None, "new")]
    got = {r.doc_id: r for r in host_rules.host_quality(docs_frame(spark, rows)).collect()}
    assert not got[100].kept and got[100].host_failed and not got[100].base_failed
    assert got[201].kept and not got[200].kept and got[400].kept and got[401].kept
    assert got[400].host_rate is None


def expected_lines(rows, least=20, docs=3):
    key = lambda line: lower(line.strip(SPACE))
    holders = defaultdict(set)
    for d, t in rows:
        if d is not None:
            for line in (t or "").split("\n"):
                if len(key(line)) >= least:
                    holders[key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or len(holders.get(key(x), ())) < docs or max(holders[key(x)]) == d]
        out.append((null(d), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def found_lines(index, docs):
    return sorted((null(r.doc_id), r.n_lines, r.n_dropped, r.text) for r in index.dedup(docs).collect())


@pytest.mark.parametrize("group_rows", [500_000, 2])
def test_line_dedup(awkward, awkward_docs, monkeypatch, group_rows):
    monkeypatch.setattr(line_dedup, "GROUP_ROWS", group_rows)  # 2: shards are dealt to several groups
    assert found_lines(line_dedup.LineIndex.build(awkward_docs), awkward_docs) == expected_lines(awkward)


def test_line_index_is_reversible(spark, awkward, awkward_docs):
    more = [(60, "This line is in very many documents."), (61, "a line that two documents hold"), (62, "a line that two documents hold"), (63, "A LINE that two documents hold")]
    index = line_dedup.LineIndex.build(awkward_docs)
    added = docs_frame(spark, more)
    both = index.insert(added)
    assert found_lines(both, awkward_docs.unionByName(added)) == expected_lines(awkward + more)
    again = both.insert(added)
    assert again.refs.count() == both.refs.count()
    back = both.delete(added.select("doc_id"))
    assert found_lines(back, awkward_docs) == expected_lines(awkward)
    rows = lambda i: (sorted(map(tuple, i.refs.collect())), sorted(map(tuple, i.repeated.select("key", "n_docs", "last_doc").collect())))
    assert rows(back) == rows(index)
    some = both.delete(spark.createDataFrame([(44,), (62,)], "doc_id long"))
    left = [r for r in awkward + more if r[0] not in (44, 62)]
    assert found_lines(some, docs_frame(spark, left)) == expected_lines(left)


def test_cuckoo_filter_has_no_false_negatives():
    keys = [hashlib.sha256(str(i).encode()).digest()[:16] for i in range(3000)]
    made = line_dedup.build_filter(keys[:1500])
    assert made.contains(keys[:1500]).all() and made.contains(keys[1500:]).mean() < 0.01
    made.delete(keys[:700])
    assert made.contains(keys[700:1500]).all() and made.contains(keys[:700]).mean() < 0.01
    copy = line_dedup.CuckooFilter.from_bytes(made.to_bytes())
    assert copy.insert(keys[:700]) and copy.contains(keys[:1500]).all()
    assert not line_dedup.CuckooFilter(4).insert(keys)


def expected_repeats(rows, window=50):
    first = {}
    for d, t in rows:
        w = words(t)
        for s in range(len(w) - window + 1) if d is not None else ():
            k = tuple(w[s : s + window])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, t in rows:
        w = words(t)
        gone = {k for s in range(len(w) - window + 1) if d is not None and first[tuple(w[s : s + window])] < d for k in range(s, s + window)}
        out.append((null(d), len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out)


def found_repeats(docs):
    return sorted((null(r.doc_id), r.n_words, r.n_removed, r.text) for r in substring_dedup.drop_repeats(docs).collect())


@pytest.mark.parametrize("hot", [15_000, 2])
def test_repeated_passages(awkward, awkward_docs, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_ANCHOR", hot)
    assert found_repeats(awkward_docs) == expected_repeats(awkward)


@pytest.mark.parametrize("seed", range(3))
def test_repeated_passages_of_mixed_documents(spark, seed, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 2000)
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(rng.choice([4, 300]))]
    pool = [[rng.choice(vocabulary) for _ in range(rng.randint(45, 160))] for _ in range(6)]
    rows = []
    for _ in range(40):
        w = []
        for _ in range(rng.randint(1, 4)):
            w += [x if rng.random() > 0.01 else rng.choice(vocabulary) for x in rng.choice(pool)[rng.randint(0, 20) :]]
            w += [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
        rows.append((rng.randint(1, 30), " ".join(w)))
    assert found_repeats(docs_frame(spark, rows)) == expected_repeats(rows)


def shingles(text, size=5):
    w = words(lower(text or ""))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def expected_components(rows):
    sets = [shingles(t) for _, t in rows]
    label = {d: d for d, _ in rows}
    links = [(a, b) for (a, x), (b, y) in itertools.combinations([(d, s) for (d, _), s in zip(rows, sets)], 2) if a is not None and b is not None and x and y and 100 * len(x & y) >= 80 * len(x | y)]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return sorted((d if d is not None else -1, len(s), label[d] if d is not None else -1) for (d, _), s in zip(rows, sets))


def found_components(docs):
    return sorted((null(r.doc_id), r.n_shingles, null(r.component_id)) for r in jaccard_join.near_duplicates(docs).collect())


def test_near_duplicates(awkward, awkward_docs):
    assert found_components(awkward_docs) == expected_components(awkward)


def near_copies(seed, groups=4, copies=12):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"b{rng.randint(0, 400)}" for _ in range(rng.randint(20, 120))]
        for _ in range(copies):
            edited = [w if rng.random() > rng.choice([0.0, 0.01, 0.04]) else f"n{rng.randint(0, 9999)}" for w in base]
            rows.append((rng.randint(0, 10_000), " ".join(edited)))
    return list({d: (d, t) for d, t in rows}.values())


@pytest.mark.parametrize("whole", [6_000_000, 200])
def test_near_duplicates_of_edited_copies(spark, monkeypatch, whole):
    monkeypatch.setattr(jaccard_join, "ROW_BLOCK_ENTRIES", whole)  # 200: row blocks are cut into tiles
    monkeypatch.setattr(jaccard_join, "TILE_ENTRIES", whole)
    monkeypatch.setattr(jaccard_join, "BLOCK_ENTRIES", 1000)
    rows = near_copies(whole)
    assert found_components(docs_frame(spark, rows)) == expected_components(rows)


@pytest.mark.parametrize("whole", [6_000_000, 200])
def test_near_duplicates_of_repeated_ids(spark, monkeypatch, whole):
    monkeypatch.setattr(jaccard_join, "ROW_BLOCK_ENTRIES", whole)
    monkeypatch.setattr(jaccard_join, "TILE_ENTRIES", whole)
    text = lambda name, n=100: " ".join(f"{name}{i}" for i in range(n))
    rows = [(2, text("a")), (2, text("a")), (1, text("a") + " more")]  # a row given twice beside a near copy
    rows += [(10, text("b")), (10, text("c", 300)), (11, text("b") + " x"), (12, text("c", 300) + " y")]  # two texts, each with a near copy
    rows += [(20, text("d")), (21, text("e")), (22, text("f")), (25, text("d")), (25, text("e")), (25, text("f")), (26, text("e") + " z")]  # three texts tie three classes
    rows += [(30, text("g")), (30, text("g") + " own"), (31, text("h"))]  # two texts near each other
    assert found_components(docs_frame(spark, rows).repartition(3)) == expected_components(rows)
    if whole > 200:
        pairs = [tuple(r)[:2] for r in jaccard_join.similar_pairs(docs_frame(spark, rows)).collect()]
        assert sorted(pairs) == [(1, 2), (10, 11), (10, 12), (21, 26)]


@pytest.mark.parametrize("whole", [6_000_000, 200])
def test_similar_pairs_are_complete(spark, monkeypatch, whole):
    monkeypatch.setattr(jaccard_join, "ROW_BLOCK_ENTRIES", whole)
    monkeypatch.setattr(jaccard_join, "TILE_ENTRIES", whole)
    rows = near_copies(5)
    by_set = {}
    for d, t in sorted(rows):
        by_set.setdefault(frozenset(shingles(t)), d)
    want = {(min(a, b), max(a, b), len(x & y)) for (x, a), (y, b) in itertools.combinations(by_set.items(), 2) if 100 * len(x & y) >= 80 * len(x | y)}
    assert {tuple(r) for r in jaccard_join.similar_pairs(docs_frame(spark, rows)).collect()} == want


def test_product_equals_set_intersections():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, 40)).astype(np.uint64) for _ in range(30)]
    _, links = jaccard_join.product_links(sets, 50, every=True)
    want = {(i, j, len(set(a) & set(b))) for (i, a), (j, b) in itertools.combinations(enumerate(sets), 2) if 100 * len(set(a) & set(b)) >= 50 * len(set(a) | set(b))}
    assert {(int(min(i, j)), int(max(i, j)), o) for i, j, o in links} == want


def test_product_of_some_rows_finds_links_to_the_others():
    full = np.arange(100, dtype=np.uint64)
    x, y = full[:90], full[:75]
    sets = [full, full[:99], full[:98], x, y]  # Z, Z', Z'' and X ask, Y does not
    near = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))
    assert [near(s, y) for s in sets] == [False, False, False, True, True] and all(near(a, b) for a, b in itertools.combinations(sets[:4], 2))
    label, _ = jaccard_join.product_links(sets, rows=np.array([True, True, True, True, False]))
    assert len(set(label.tolist())) == 1


def test_product_of_some_rows_gives_links_in_either_order():
    sets = [np.arange(n, dtype=np.uint64) for n in (99, 100, 98, 97)]
    _, links = jaccard_join.product_links(sets, every=True, rows=np.array([False, True, True, False]))
    assert {(int(i), int(j), o) for i, j, o in links} == {(1, 0, 99), (1, 2, 98), (1, 3, 97), (2, 0, 98), (2, 3, 97)} and len(links) == 5


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


BENCHMARK = [(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short item"), (2, "short item"), (3, None), (4, "..."), (None, "short item"), (5, "été 10"), (6, "w w w w w w w w w w w w")]


def expected_hits(rows, items, window=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    found = defaultdict(set)
    for i, t in items:
        w = split(t)
        for s in range(max(1, len(w) - window + 1)) if w and i is not None else ():
            found[tuple(w[s : s + window])].add(i)
    out = []
    for d, t in rows:
        w, hit, ids = split(t), set(), set()
        for size in {len(k) for k in found}:
            for s in range(len(w) - size + 1):
                if (k := tuple(w[s : s + size])) in found:
                    ids |= found[k]
                    hit |= set(range(s, s + size))
        out.append((null(d), len(w), len(hit), ",".join(sorted(map(str, ids)))))
    return sorted(out)


PLANTED = [(70, "x ALPHA, beta-gamma delta epsilon zeta eta theta iota kappa lambda. y"), (71, "alpha beta gamma delta epsilon zeta eta theta iota"), (72, "a Short, ITEM. short item"), (73, "ÉTÉ 10 été 10"), (74, "mu lambda kappa iota theta eta zeta epsilon delta gamma beta alpha")]


def test_decontamination(spark, awkward):
    rows = awkward + PLANTED
    items = spark.createDataFrame(BENCHMARK, "item_id long, text string").withColumns({"uid": F.lit(1), "term": F.lit(2)})
    got = decontam.contamination(docs_frame(spark, rows).repartition(3), items).collect()
    assert sorted((null(r.doc_id), r.n_words, r.n_hit, ",".join(r["items"])) for r in got) == expected_hits(rows, BENCHMARK)


def test_proximity_finds_terms_in_any_order(spark):
    items = spark.createDataFrame(BENCHMARK[:1], "item_id long, text string")
    far = (75, "alpha " + "f " * 60 + "beta " + "f " * 60 + "gamma")
    index = decontam.PositionalIndex.build(docs_frame(spark, [*PLANTED, far]))
    bench = decontam.BenchmarkTerms.prepare(items, index)
    # 71 lacks some of the rarest terms of every window
    assert {r.doc_id for r in decontam.proximity_matches(index, bench).collect()} == {70, 74}


def test_empty_tables(spark, no_docs, awkward_docs):
    items = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    assert decontam.contamination(no_docs, items).count() == 0
    assert decontam.contamination(awkward_docs, items.filter("false")).filter("contaminated").count() == 0
    assert host_rules.host_quality(no_docs).count() == 0
    assert line_dedup.LineIndex.build(no_docs).dedup(no_docs).count() == 0
    assert substring_dedup.drop_repeats(no_docs).count() == 0
    assert jaccard_join.near_duplicates(no_docs).count() == 0


def test_salted_join_equals_a_plain_one(spark, monkeypatch):
    from skyspark.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 3)
    left = spark.createDataFrame([(k, i) for i in range(60) for k in ("hot", f"k{i % 7}", None)], "k string, i long")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k3", 3), (None, 4)], "k string, v long")
    rows = lambda df: sorted(map(str, df.select("k", "i", "v").collect()))
    for how in ("inner", "left"):
        assert rows(common.salted_join(left, right, ["k"], ["i"], how)) == rows(left.join(right, "k", how))


def test_line_dedup_passes_columns_of_any_name(spark):
    docs = spark.createDataFrame([(i, "one line that three documents hold", i, i, i) for i in range(3)], "doc_id long, text string, line_doc long, line_drops long, _line_doc long")
    got = line_dedup.LineIndex.build(docs).dedup(docs).orderBy("doc_id").collect()
    assert [(r.text, r.line_doc, r.line_drops, r["_line_doc"], r.n_dropped) for r in got] == [("", 0, 0, 0, 1), ("", 1, 1, 1, 1), ("one line that three documents hold", 2, 2, 2, 0)]
