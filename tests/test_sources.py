"""Commits, snapshots, the bucketed store and the chunk cache: what fails, who comes second, what is read."""

import threading

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from skyspark.operators import chunks
from skyspark.schema import ID, MJD
from skyspark.sources import storage
from skyspark.sources.chunk_cache import ChunkCache
from skyspark.sources.commits import CommitLog
from skyspark.sources.snapshots import load_snapshot, save_snapshot
from skyspark.sources.store import CumulativeStore
from skyspark.streaming.upsert import start_upsert

ROWS = f"{ID} string, {MJD} double, seq long"


def frame(spark, rows, ddl=ROWS):
    return spark.createDataFrame(rows, ddl)


def stored(store):
    return sorted((r[ID] or "", r[MJD] is None, r[MJD] or 0.0, r.seq) for r in store.read().collect())


def newest(rows):
    best = {}
    for key, mjd, seq in rows:
        rank = (mjd is None, mjd or 0.0, seq)
        if key not in best or rank >= best[key]:
            best[key] = rank
    return sorted((k or "", *v) for k, v in best.items())


# --- commits ---


@pytest.mark.parametrize("rename", [False, True])
def test_one_of_many_writers_gets_a_number(spark, tmp_path, monkeypatch, rename):
    if rename:  # the way of file systems without hard links
        monkeypatch.setattr(storage.os, "link", lambda a, b: (_ for _ in ()).throw(FileExistsError()) if not storage._rename(spark, f"file://{a}", f"file://{b}") else None)
    log = CommitLog(spark, f"file://{tmp_path}/log")
    assert log.latest() is None and log.numbers() == []
    won = []
    start = threading.Barrier(6)

    def write(i):
        start.wait()
        if log.commit(1, {"writer": i, "text": "é" * 10_000}):
            won.append(i)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 or rename  # a local rename looks before it leaps; HDFS does both in one
    assert log.latest()[0] == 1 and log.latest()[1]["writer"] in won
    assert not log.commit(1, {"writer": "late"}) and log.latest()[1]["writer"] in won
    assert log.commit(2, {"writer": "next"}) and log.numbers() == [1, 2]
    assert storage.children(spark, f"{tmp_path}/log") == [n for n in storage.children(spark, f"{tmp_path}/log") if n.endswith(".json") or n.endswith(".crc")]


# --- snapshots ---


def test_a_failed_save_leaves_the_snapshot(spark, tmp_path):
    ddl = {"a": ROWS, "b": ROWS, "none": ROWS}
    folder = f"{tmp_path}/snap"
    one = frame(spark, [("x", 1.0, 1)])
    save_snapshot(folder, {"a": one, "b": one, "none": one.filter("false")})
    two = frame(spark, [("y", 2.0, 2), ("z", 3.0, 3)])
    broken = two.withColumn("seq", F.when(F.col(ID) == "z", F.raise_error(F.lit("lost"))).otherwise(F.col("seq")).cast("long"))
    with pytest.raises(PySparkException, match="lost"):
        save_snapshot(folder, {"a": two, "b": broken, "none": two})
    held = load_snapshot(spark, folder, ddl)
    assert {m: [tuple(r) for r in held[m].collect()] for m in ddl} == {"a": [("x", 1.0, 1)], "b": [("x", 1.0, 1)], "none": []}
    save_snapshot(folder, {"a": two, "b": two.filter("false"), "none": two})
    again = load_snapshot(spark, folder, ddl)
    assert [again[m].count() for m in ddl] == [2, 0, 2] and held["a"].count() == 1  # its reader isn't cut off
    for _ in range(3):
        save_snapshot(folder, {"a": one, "b": one, "none": one})
    assert len(storage.children(spark, f"{folder}/sets")) <= 3  # the sets kept, and the one that failed


def test_members_are_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    df = frame(spark, [(f"i{i}", 1.0, i) for i in range(50)]).withColumn(MJD, counting(seen)(F.col(MJD)))
    save_snapshot(f"{tmp_path}/once", {"a": df})
    assert seen.value == 50


def counting(accumulator):
    def see(x):
        accumulator.add(1)
        return x

    return F.udf(see, "double").asNondeterministic()


# --- store ---


def test_upsert_rewrites_only_the_buckets_it_meets(spark, tmp_path):
    store = CumulativeStore(spark, f"{tmp_path}/s", n_buckets=8)
    rows = [(f"l{i}", float(i), i) for i in range(200)]
    store.upsert(frame(spark, rows), ["seq"])
    files = lambda: {r.file: r.bucket for r in store.manifest().collect()}
    before = files()
    assert len(set(before.values())) == 8
    stats = store.upsert(frame(spark, [("l7", 999.0, 1000)]), ["seq"])
    after = files()
    assert len(set(before) - set(after)) == len(set(after) - set(before)) == 1
    assert {before[f] for f in set(before) - set(after)} == {after[f] for f in set(after) - set(before)}
    assert (stats.old_rows, stats.new_rows, stats.stored_rows) == (200, 1, 200)
    assert stored(store) == newest([*rows, ("l7", 999.0, 1000)])


def test_store_with_awkward_rows(spark, tmp_path):
    store = CumulativeStore(spark, f"{tmp_path}/s", n_buckets=4)
    assert store.upsert(frame(spark, []), ["seq"]).stored_rows == 0 and store.read().count() == 0
    hot = [("hot", float(i % 50), i) for i in range(3000)]
    rows = [*hot, (None, 1.0, 1), (None, 2.0, 0), ("a", None, 5), ("a", 7.0, 6), ("b", float("nan"), 1), ("b", 4.0, 2)]
    plain = [(k, None if m is not None and m != m else m, s) for k, m, s in rows]
    stats = store.upsert(frame(spark, rows), ["seq"])
    assert (stats.old_rows, stats.new_rows, stats.stored_rows) == (0, len(rows), 4)
    assert stored(store) == newest(plain)
    assert store.upsert(frame(spark, []), ["seq"]).stored_rows == 4
    assert stored(store) == newest(plain)


def test_columns_that_come_and_change(spark, tmp_path):
    store = CumulativeStore(spark, f"{tmp_path}/s", n_buckets=4)
    store.upsert(frame(spark, [(f"l{i}", 1.0, i) for i in range(20)], f"{ID} string, {MJD} double, seq int"), ["seq"])
    store.upsert(frame(spark, [("l3", 2.0, 99, "new")], f"{ID} string, {MJD} double, seq int, more string"), ["seq"])
    assert {r[ID]: r.more for r in store.read().collect() if r.more} == {"l3": "new"} and store.read().count() == 20
    store.upsert(frame(spark, [("l4", 2.0, 1 << 40)]), ["seq"])  # int becomes long in every bucket
    found = {r[ID]: r.seq for r in store.read().collect()}
    assert found["l4"] == 1 << 40 and found["l5"] == 5 and len(found) == 20


def test_a_range_opens_the_files_of_its_nights(spark, tmp_path):
    store = CumulativeStore(spark, f"{tmp_path}/s", n_buckets=4, file_rows=25)
    rows = [(f"l{i}", 100.0 + i / 40, i) for i in range(400)] + [("x", None, 1)]
    store.upsert(frame(spark, rows), ["seq"])
    whole = len(store.read().inputFiles())
    night = store.read_range(104.0, 105.0)
    manifest = store.manifest().collect()
    meet = [r for r in manifest if r.mjd_min is not None and r.mjd_max >= 104.0 and r.mjd_min <= 105.0]
    assert len(night.inputFiles()) == len(meet) < whole / 2
    assert sorted(r.seq for r in night.collect()) == [i for _, m, i in rows if m is not None and 104.0 <= m <= 105.0]
    assert store.read_range(50.0, 60.0).count() == 0 and sum(r.rows for r in manifest) == 401
    for bucket in {r.bucket for r in manifest}:  # files of a bucket are stretches of time
        spans = sorted((r.mjd_min, r.mjd_max) for r in manifest if r.bucket == bucket and r.mjd_min is not None)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_two_writers_lose_no_row(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/s"
    rows = [(f"l{i}", 1.0, i) for i in range(100)]
    CumulativeStore(spark, path, n_buckets=4).upsert(frame(spark, rows), ["seq"])
    second = CumulativeStore(spark, path)
    merges = []
    merge = CumulativeStore._merge

    def slow(self, *args):
        merges.append(self)
        done = merge(self, *args)
        if self is second and merges.count(second) == 1:  # while it merges, another comes and commits
            CumulativeStore(spark, path).upsert(frame(spark, [(f"m{i}", 2.0, i) for i in range(50)] + [("l1", 5.0, 500)]), ["seq"])
        return done

    monkeypatch.setattr(CumulativeStore, "_merge", slow)
    stats = second.upsert(frame(spark, [("l1", 4.0, 400), ("l2", 4.0, 401), ("n", 4.0, 402)]), ["seq"])
    assert stored(second) == newest([*rows, *[(f"m{i}", 2.0, i) for i in range(50)], ("l1", 5.0, 500), ("l1", 4.0, 400), ("l2", 4.0, 401), ("n", 4.0, 402)])
    assert stats.stored_rows == 151 and merges.count(second) == 2 and len(second.versions()) == 3


def test_a_writer_of_other_buckets_need_not_merge_again(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/s"
    rows = [(f"l{i}", 1.0, i) for i in range(40)]
    store = CumulativeStore(spark, path, n_buckets=64)
    store.upsert(frame(spark, rows), ["seq"])
    bucket = {r[ID]: r.b for r in store.read().select(ID, F.pmod(F.xxhash64(ID), F.lit(64)).alias("b")).collect()}
    other = next(f"l{i}" for i in range(1, 40) if bucket[f"l{i}"] != bucket["l0"])
    merges = []
    merge = CumulativeStore._merge

    def slow(self, *args):
        merges.append(self)
        done = merge(self, *args)
        if self is store and merges.count(store) == 1:
            CumulativeStore(spark, path).upsert(frame(spark, [(other, 9.0, 9)]), ["seq"])
        return done

    monkeypatch.setattr(CumulativeStore, "_merge", slow)
    store.upsert(frame(spark, [("l0", 8.0, 8)]), ["seq"])
    assert stored(store) == newest([*rows, (other, 9.0, 9), ("l0", 8.0, 8)]) and merges.count(store) == 1


def test_a_failed_upsert_changes_nothing(spark, tmp_path):
    store = CumulativeStore(spark, f"{tmp_path}/s")
    store.upsert(frame(spark, [("a", 1.0, 1)]), ["seq"])
    bad = frame(spark, [("a", 2.0, 2)]).withColumn("seq", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(PySparkException, match="lost"):
        store.upsert(bad, ["seq"])
    assert stored(store) == [("a", False, 1.0, 1)] and len(store.versions()) == 1


def test_files_of_old_versions_go(spark, tmp_path):
    store = CumulativeStore(spark, f"{tmp_path}/s", n_buckets=2)
    for i in range(6):
        store.upsert(frame(spark, [(f"l{j}", float(i), i) for j in range(10)]), ["seq"])
    kept = {r.file for n in store.log.numbers() for r in store.manifest(n).collect()}
    there = {n.split("/s/", 1)[1] for n in storage.lengths(spark, f"{tmp_path}/s/data") if n.endswith(".parquet")}
    assert there == kept and len(store.versions()) == 3


def test_a_micro_batch_touches_one_bucket(spark, tmp_path):
    store = CumulativeStore(spark, f"{tmp_path}/store", n_buckets=8)
    store.upsert(frame(spark, [(f"l{i}", 1.0, i) for i in range(100)]), ["seq"])
    before = {r.file for r in store.manifest().collect()}
    frame(spark, [("l5", 9.0, 9)]).write.parquet(f"{tmp_path}/in")
    start_upsert(spark.readStream.schema(ROWS).parquet(f"{tmp_path}/in"), store, f"{tmp_path}/check", "s", ["seq"]).awaitTermination()
    assert len({r.file for r in store.manifest().collect()} - before) == 1 and store.read().count() == 100


# --- chunk cache ---

PLAN = {"initial_days": 1.0, "min_seconds": 3600.0, "max_results": 8, "split_threshold": 6}


def source(spark, n=60):
    return frame(spark, [(f"L{i % 45}", 100.0 + i / 10, i) for i in range(n)])


def wanted(lo=100.0, hi=107.0, n=60):
    """What a pull of ``source`` gives."""
    best = {}
    for i in range(n):
        if lo <= 100.0 + i / 10 <= hi:
            best[f"L{i % 45}"] = (f"L{i % 45}", 100.0 + i / 10, i)
    return sorted(best.values())


def pull(rows, cache, lo=100.0, hi=107.0, **options):
    found, report = chunks.adaptive_pull(rows, "night", lo, hi, ["seq"], None, cache, **{**PLAN, **options})
    return sorted((r[ID], r[MJD], r.seq) for r in found.select(ID, MJD, "seq").collect()), {(round(r.mjd_min, 6), round(r.mjd_max, 6)): (r.n_loci, r.status, r.source) for r in report.collect()}


def test_a_cached_range_is_pulled_without_its_source(spark, tmp_path):
    cache, seen = ChunkCache(spark, f"{tmp_path}/c"), spark.sparkContext.accumulator(0)
    rows = source(spark)
    watched = rows.withColumn("seq", F.udf(lambda x: (seen.add(1), x)[1], "long").asNondeterministic()(F.col("seq")))
    plain, report = pull(rows, None)
    first, _ = pull(watched, cache)
    assert first == plain == wanted() and seen.value > 0
    seen.value = 0
    again, cached = pull(watched, cache)
    assert again == plain and seen.value == 0
    assert {k: v[:2] for k, v in cached.items()} == {k: v[:2] for k, v in report.items()}
    assert {v[2] for v in cached.values() if v[1] != "split"} == {"cache"}


def test_the_source_is_read_for_what_is_not_cached(spark, tmp_path):
    cache, seen = ChunkCache(spark, f"{tmp_path}/c"), spark.sparkContext.accumulator(0)
    rows = source(spark)
    pull(rows, cache, 100.0, 103.0)
    watched = rows.withColumn("seq", F.udf(lambda x: (seen.add(1), x)[1], "long").asNondeterministic()(F.col("seq")))
    wide, report = pull(watched, cache)
    assert wide == wanted()
    # the last window of the first pull had a closed end, so it is another chunk
    assert {k for k, v in report.items() if v[2] == "cache"} == {(100.0, 100.5), (100.5, 101.0), (101.0, 101.5), (101.5, 102.0), (102.0, 102.5), (102.5, 102.75)}
    assert 0 < seen.value <= 3 * 35  # rows from 102.75 on, in three passes at most


def test_files_of_other_chunks_are_not_opened(spark, tmp_path):
    cache = ChunkCache(spark, f"{tmp_path}/c")
    rows = source(spark)
    for lo in (100.0, 102.0):
        pull(rows, cache, lo, lo + 1.0)
    known = cache.known("night", "all")
    assert len(known.files) == len(known.sound) + sum(r.file is None for r in known.files)
    found, _ = chunks.adaptive_pull(rows, "night", 102.0, 103.0, ["seq"], None, cache, **PLAN)
    assert found.count() == 11
    assert cache.known("other", "all").chunks.count() == 0


def test_many_chunks_share_a_file(spark, tmp_path):
    cache = ChunkCache(spark, f"{tmp_path}/c")
    pull(source(spark, 400), cache, 100.0, 140.0)
    files = [n for n in storage.lengths(spark, f"{tmp_path}/c/rows") if n.endswith(".parquet")]
    assert cache.chunks().count() > 60 and len(files) < 8


def test_a_packed_file_that_is_damaged_misses_its_chunks_only(spark, tmp_path):
    cache = ChunkCache(spark, f"{tmp_path}/c")
    rows = source(spark)
    pull(rows, cache, 100.0, 102.0)
    pull(rows, cache, 102.0, 104.0)
    before = pull(rows, cache, 100.0, 104.0)[0]  # caches the windows that ended a range as open ones, in a third file
    part = min((tmp_path / "c" / "rows").rglob("*.parquet"), key=lambda p: p.stat().st_mtime)
    part.write_bytes(part.read_bytes()[:-9])
    found, report = pull(rows, cache, 100.0, 104.0)
    live = {k for k, v in report.items() if v[2] == "live" and v[1] != "split"}
    assert found == before == wanted(100.0, 104.0) and live and live < {k for k, v in report.items() if v[1] != "split"}
    assert {v[2] for v in pull(rows, cache, 100.0, 104.0)[1].values() if v[1] != "split"} == {"cache"}


def test_other_settings_and_tags_are_other_chunks(spark, tmp_path):
    cache = ChunkCache(spark, f"{tmp_path}/c")
    rows = source(spark)
    pull(rows, cache)
    found, report = pull(rows, cache, max_results=20, split_threshold=15)
    assert {v[2] for v in report.values()} == {"live"} and found == wanted()


def test_chunks_of_two_schemas(spark, tmp_path):
    cache = ChunkCache(spark, f"{tmp_path}/c")
    keys = lambda df, k: df.withColumns({"label_key": F.lit("l"), "tag_key": F.lit("all"), "chunk_key": F.lit(k)})
    cache.write(keys(frame(spark, [("a", 1.0, 1)]), "one"))
    cache.write(keys(frame(spark, [("b", 1.0, "x")], f"{ID} string, {MJD} double, word string"), "two"))
    assert sorted((r[ID], r.seq, r.word) for r in cache.read().collect()) == [("a", 1, None), ("b", None, "x")]
    cache.write(keys(frame(spark, [("c", 2.0, 2)]), "one"))
    assert sorted(r[ID] for r in cache.read().collect()) == ["b", "c"] and cache.chunks().count() == 2


def test_a_window_that_holds_a_cached_one_is_split_around_it(spark, tmp_path):
    """Rows that left the source meanwhile don't make windows overlap."""
    cache = ChunkCache(spark, f"{tmp_path}/c")
    rows = source(spark)
    pull(rows, cache, 100.0, 101.0)
    part = ChunkCache(spark, f"{tmp_path}/d")
    known = cache.known("night", "all")
    one = known.chunks.filter("mjd_min = 100.0")
    part.write(known.read(one), one)
    found, report = pull(rows.filter(F.col(MJD) >= 100.75), part, 100.0, 101.0)
    assert report[(100.0, 101.0)][1] == "split" and report[(100.0, 100.5)][2] == "cache"
    assert len(found) == 5 + 3


def test_empty_and_reversed_ranges(spark, tmp_path):
    cache = ChunkCache(spark, f"{tmp_path}/c")
    none = source(spark).filter("false")
    assert pull(none, cache)[0] == []
    found, report = pull(none, cache)
    assert found == [] and {v[2] for v in report.values()} == {"cache"}
    assert pull(source(spark), cache, 5.0, 4.0) == ([], {})
    assert pull(source(spark), cache, 101.0, 101.0)[0] == wanted(101.0, 101.0) and len(wanted(101.0, 101.0)) == 1
