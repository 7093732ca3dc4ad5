"""Hand-written frames for null, tie and boundary rules, and properties of the operators."""

import math
import random

import pytest
from pyspark.sql import functions as F

from skyspark import schema
from skyspark.functions.mjd import mjd_to_date, timestamp_to_mjd
from skyspark.functions.sky import coordinate_ok, wrapped_radians
from skyspark.functions.text import join_tags, mjd_part, safe_part
from skyspark.operators import alerts as al
from skyspark.operators import chunks, density, quality, ranges, sample, summary
from skyspark.operators.dedupe import newest_per_locus
from skyspark.plans.nightly import nightly_ingest, sampled_comparison
from skyspark.schema import ALERT_BAND, ALERT_MAG, ID, MAG, MJD
from skyspark.sources.raw import flatten_loci, malformed_count, parse_properties, read_loci
from skyspark.sources.snapshots import load_snapshot, save_snapshot
from skyspark.sources.store import CumulativeStore
from skyspark.streaming.upsert import start_upsert


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def points(spark, mjds, label="r"):
    return frame(spark, [(f"p{i}", m, label) for i, m in enumerate(mjds)], f"{ID} string, {MJD} double, range_label string")


@pytest.mark.parametrize(
    "rows, null_time, kept",
    [
        ([("a", 1.0, 0, "x"), ("a", None, 1, "y")], "newest", {"y"}),
        ([("a", None, 0, "y"), ("a", 9.0, 1, "z")], "newest", {"y"}),
        ([("a", None, 0, "y"), ("a", 9.0, 1, "z")], "oldest", {"z"}),
        ([(None, 1.0, 0, "z"), (None, 2.0, 1, "w")], "newest", {"w"}),
        ([("a", 5.0, 0, "old"), ("a", 5.0, 1, "new")], "newest", {"new"}),
    ],
)
def test_newest_row_wins(spark, rows, null_time, kept):
    df = frame(spark, rows, f"{ID} string, {MJD} double, seq int, v string")
    assert {r.v for r in newest_per_locus(df, ["seq"], null_time).collect()} == kept


def test_newest_without_time_or_id(spark):
    df = frame(spark, [("a", 1, "x"), ("a", 2, "y")], f"{ID} string, seq int, v string")
    assert [r.v for r in newest_per_locus(df, ["seq"]).collect()] == ["y"]
    assert newest_per_locus(df.drop(ID), ["seq"]).count() == 2
    with pytest.raises(ValueError):
        newest_per_locus(df, ["seq"], "never")


def test_bad_coordinates_include_missing_and_nan(spark):
    df = schema.nan_to_null(frame(spark, [(10.0,), (360.0,), (-1.0,), (None,), (math.nan,)], "ra double"))
    assert df.filter(~coordinate_ok(F.col("ra"), F.lit(0.0))[0]).count() == 4


def test_histogram_edges_closed(spark):
    df = frame(spark, [("r", 1, 15.0), ("r", 1, 25.0), ("r", 1, 14.99), ("r", 9, 20.0), ("r", 1, None)], f"range_label string, {ALERT_BAND} int, {ALERT_MAG} double")
    bins = {r.bin: r.n for r in density.magnitude_histogram(df).collect()}
    assert len(bins) == 40 and bins[0] == 1 and bins[39] == 1 and sum(bins.values()) == 2


def test_shared_bound_is_in_both_ranges(spark):
    df = points(spark, [61102.0, 61103.5])
    found = ranges.label_ranges(df, [("night", 61102.0, 61103.0), ("past", 60200.0, 61102.0)])
    assert sorted(r.range_label for r in found.collect()) == ["night", "past"]
    with pytest.raises(ValueError):
        ranges.label_ranges(df, [("none", 2.0, 1.0)])


def test_window_and_tags(spark):
    df = frame(spark, [("a", 1.0, ["x", "y"]), ("b", 2.0, ["xy"]), ("c", None, None)], f"{ID} string, {MJD} double, tags_arr array<string>")
    assert ranges.window_scan(df, 1.0, 2.0).count() == 2
    assert ranges.window_scan(df, 1.0, 2.0, include_upper=False).count() == 1
    assert ranges.window_scan(df, 1.0, 2.0, "x").count() == 1
    assert ranges.window_scan(df, 1.0, 2.0, "").count() == 2
    assert ranges.window_scan(df, 2.0, 1.0).count() == 0
    tagged = df.withColumn("tags", join_tags(F.col("tags_arr")))
    assert sorted(r.tags for r in tagged.collect()) == ["", "x, y", "xy"]
    assert tagged.filter(ranges.tag_contains("y")).count() == 2


def test_keys_and_dates(spark):
    row = spark.range(1).select(
        safe_part(F.lit("Last Night!")).alias("a"), safe_part(F.lit("!!")).alias("b"), safe_part(F.lit(None).cast("string")).alias("c"),
        mjd_part(F.lit(60200.5)).alias("d"), mjd_to_date(F.lit(61103.0)).cast("string").alias("e"), wrapped_radians(F.lit(180.0)).alias("f"), wrapped_radians(F.lit(270.0)).alias("g"),
    ).first()
    assert (row.a, row.b, row.c, row.d, row.e) == ("Last_Night", "all", "all", "60200p50000000", "2026-03-04")
    assert row.f == math.pi and abs(row.g + math.pi / 2) < 1e-12


def test_mjd_does_not_depend_on_the_session_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00.25' AS ts")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", name)
            assert df.select(timestamp_to_mjd(F.col("ts"))).first()[0] == 40587.0 + 1710037800250000 / 86400000000.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_samples_repeat_and_ignore_partitioning(spark):
    df = points(spark, [float(i) for i in range(500)])
    ids = lambda d: [r[ID] for r in d.collect()]
    one = ids(sample.seeded_sample(df, 20, 7))
    assert one == ids(sample.seeded_sample(df.repartition(7), 20, 7)) != ids(sample.seeded_sample(df, 20, 8))
    assert ids(sample.newest_first(df, 2)) == ["p499", "p498"]
    assert sample.seeded_sample(df, 0, 7).count() == 0
    assert sample.sample_ranges(df, [("a", 0.0, 9.0), ("b", 5.0, 1.0)], 3, None).count() == 3


def test_density_total_and_flat_extent(spark):
    rows = [("r", float(i % 9), float(i % 7)) for i in range(200)] + [("r", None, 1.0), ("one", 5.0, 5.0), ("one", 5.0, 5.0)]
    found = density.sky_density(frame(spark, rows, "range_label string, ra double, dec double"), 10).collect()
    assert sum(r.n for r in found if r.range_label == "r") == 200
    assert [(r.bx, r.by, r.n) for r in found if r.range_label == "one"] == [(5, 5, 2)]


def test_loci_stand_in_for_alerts_only_if_there_are_none(spark):
    loci = frame(spark, [("r", 20.0)], f"range_label string, {MAG} double")
    ddl = f"range_label string, {ALERT_BAND} int, {ALERT_MAG} double"
    series = lambda alerts: [(r.range_label, r.band, r.bin, r.n) for r in density.magnitude_series(loci, alerts).collect() if r.n]
    assert series(frame(spark, [], ddl)) == [("r", None, 20, 1)]
    assert series(frame(spark, [("r", 1)], f"range_label string, {ALERT_BAND} int")) == [("r", None, 20, 1)]  # no such column
    assert series(frame(spark, [("r", 1, None)], ddl)) == []  # alerts there are, if without magnitudes
    assert series(frame(spark, [("r", 1, 99.0), ("r", 9, 20.0), ("q", 2, 15.0)], ddl)) == [("q", "r", 0, 1)]


def test_fixed_chunks_tile_the_range(spark):
    spine = chunks.chunk_spine(spark, 0.0, 1.0, 0.3).orderBy("chunk").collect()
    assert [r.include_upper for r in spine] == [False, False, False, True]
    assert spine[0].mjd_min == 0.0 and spine[-1].mjd_max == 1.0
    assert all(a.mjd_max == b.mjd_min for a, b in zip(spine, spine[1:]))
    assert [r.include_upper for r in chunks.chunk_spine(spark, 2.0, 2.0, 1.0).collect()] == [True]
    assert chunks.chunk_spine(spark, 3.0, 2.0, 1.0).count() == 0
    with pytest.raises(ValueError):
        chunks.chunk_spine(spark, 0.0, 1.0, 0.0)


def split_in_turn(mjds, lo, hi, width, least, cap, threshold):
    """The plan by splitting one window after the other."""
    n = max(1, math.ceil((hi - lo) / width))
    pending = [(lo + i * width, min(lo + (i + 1) * width, hi)) for i in range(n)]
    out = []
    while pending:
        a, b = pending.pop(0)
        count = min(cap, sum(a <= m < b or (m == b == hi) for m in mjds))
        if count >= min(threshold, cap) and b - a > 1.01 * least:
            status = "split"
            pending[:0] = [(a, (a + b) / 2), ((a + b) / 2, b)]
        else:
            status = "accepted_at_minimum_saturated" if count >= min(threshold, cap) else "accepted"
        out.append((round(a, 9), round(b, 9), count, status))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_adaptive_plan_equals_splitting_in_turn(spark, seed):
    rng = random.Random(seed)
    lo, hi = 100.0, 103.5
    mjds = [lo + 3.5 * rng.random() ** 3 for _ in range(400)] + [hi, lo] + [lo + 0.25] * 30
    plan = chunks.adaptive_report(points(spark, mjds), "x", lo, hi, 1.0, 600.0, 20, 15)
    got = [(round(r.mjd_min, 9), round(r.mjd_max, 9), r.n_loci, r.status) for r in chunks.ordered_report(plan).collect()]
    assert got == split_in_turn(mjds, lo, hi, 1.0, 600 / 86400, 20, 15)
    accepted = sorted(g[:2] for g in got if g[3] != "split")
    assert accepted[0][0] == lo and accepted[-1][1] == hi and all(a[1] == b[0] for a, b in zip(accepted, accepted[1:]))


def suite(spark, loci_rows, spans=(("one", 0.0, 10.0), ("two", 10.0, 20.0)), alert_rows=(), **options):
    loci = frame(spark, loci_rows, f"range_label string, {ID} string, {MJD} double, ra double, dec double, tags string")
    alerts = frame(spark, list(alert_rows), f"range_label string, {ALERT_MAG} double")
    found = quality.quality_checks(loci, alerts, ranges.ranges_frame(spark, list(spans)), era_start=5.0, **options)
    return {(r.check_no, r.name, r.range_label): r.status for r in found.collect()}


def test_era_share_is_strict_and_empty_ranges_skip(spark):
    rows = [("one", f"a{i}", 1.0 if i < 5 else 6.0, 1.0, 1.0, "") for i in range(100)]
    got = suite(spark, rows, alert_rows=[("one", 20.0), ("one", 99.0)])
    assert got[4, "survey_era", "one"] == "WARN" and got[5, "magnitudes", "one"] == "PASS"
    assert got[1, "data_present", "two"] == "FAIL" and got[2, "mjd_in_window", "two"] == "SKIP"
    assert got[5, "magnitudes", "two"] == "WARN" and got[7, "overlap", None] == "INFO"
    assert suite(spark, rows[1:])[4, "survey_era", "one"] == "PASS"


def test_quality_failures(spark):
    rows = [("one", "a", 10.03, 360.0, 91.0, None), ("one", "a", None, None, 0.0, "in_LSSTDDF")]
    got = suite(spark, rows, spans=(("one", 0.0, 10.0), ("two", 3.0, 1.0)), alert_rows=[("one", None)])
    assert got[2, "mjd_in_window", "one"] == "FAIL" and got[3, "ra_valid", "one"] == "WARN" and got[6, "unique_ids", "one"] == "WARN"
    assert got[5, "magnitudes", "one"] == "FAIL" and got[1, "data_present", "two"] == "SKIP" and got[8, "range_order", "two"] == "PASS"
    assert suite(spark, rows, loci_columns=frozenset((ID,)))[2, "mjd_in_window", "one"] == "SKIP"


@pytest.mark.parametrize("shared, status", [(49, "PASS"), (50, "WARN"), (199, "WARN"), (200, "FAIL")])
def test_overlap_thresholds(spark, shared, status):
    rows = [("one", f"a{i}", 6.0, 1.0, 1.0, "") for i in range(1000)]
    rows += [("two", f"a{i}" if i < shared else f"b{i}", 16.0, 1.0, 1.0, "") for i in range(1000)]
    assert suite(spark, rows)[7, "overlap", None] == status


def test_overlap_of_empty_sets(spark):
    none = points(spark, [1.0]).filter("false")
    assert summary.range_overlap(none, none).first().pct == 0.0


def test_unknown_band_shows_itself(spark):
    df = frame(spark, [("r", 1), ("r", 4), ("r", None)], f"range_label string, {ALERT_BAND} int")
    assert {r.band: r.n for r in al.band_counts(df).collect()} == {"g": 1, "4": 1}
    assert al.with_band(df, known_only=True).count() == 1


def test_raw_records(spark):
    rows = [("a", '{"ra": 7.0, "x": 1}', ["t"]), ("b", "{broken", ["t"]), ("c", "{}", [None]), ("d", None, None)]
    raw = frame(spark, [(i, 1.0, 2.0, t, p) for i, p, t in rows], f"{ID} string, ra double, dec double, tags_arr array<string>, properties string")
    parsed = parse_properties(raw, "ra double, x int")
    assert tuple(malformed_count(parsed).first()) == (4, 2)
    flat = {r[ID]: r for r in flatten_loci(parsed).collect()}
    assert set(flat) == {"a", "d"} and flat["a"].ra == 7.0 and flat["a"].x == 1 and flat["d"].tags == ""
    loci = read_loci(raw, "ra double, x int")
    assert loci.schema[MJD].dataType.simpleString() == "double" and "x" in loci.columns


def test_store_upserts_commute_with_union(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"l{rng.randint(0, 20)}", float(i), i) for i in range(100)]
    rng.shuffle(rows)
    df = frame(spark, rows, f"{ID} string, {MJD} double, seq int")
    one = CumulativeStore(spark, f"{tmp_path}/one")
    assert one.read().count() == 0 and one.read_range(0, 9).count() == 0
    for k in range(5):
        stats = one.upsert(df.filter(F.col("seq") % 5 == k), ["seq"])
    assert stats.stored_rows == one.read().count() and stats.new_rows == 20
    assert len(one.versions()) == 3
    two = CumulativeStore(spark, f"{tmp_path}/two")
    two.upsert(df, ["seq"])
    read = lambda s: sorted((r[ID], r.seq) for r in s.read().collect())
    assert read(one) == read(two)
    before = read(one)
    one.upsert(df, ["seq"], batch="b 1")
    one.upsert(df.withColumn(MJD, F.lit(1e6)), ["seq"], batch="b 1")  # a batch known already
    assert read(one) == before


def test_stream_restart_applies_each_batch_once(spark, tmp_path):
    ddl = f"{ID} string, {MJD} double"
    frame(spark, [("a", 2.0), ("b", 1.0)], ddl).write.parquet(f"{tmp_path}/in/x")
    store = CumulativeStore(spark, f"{tmp_path}/store")
    for rows in ([], [("a", 1.0), ("c", None)]):
        if rows:
            frame(spark, rows, ddl).write.mode("append").parquet(f"{tmp_path}/in/x")
        arriving = spark.readStream.schema(ddl).parquet(f"{tmp_path}/in/x")
        start_upsert(arriving, store, f"{tmp_path}/check", "s").awaitTermination()
    assert sorted((r[ID], r[MJD]) for r in store.read().collect() if r[ID] != "c") == [("a", 2.0), ("b", 1.0)]
    assert len(store.versions()) == 2


def test_snapshots_are_all_or_nothing(spark, tmp_path):
    df = frame(spark, [("a", 1.0)], "x string, y double")
    members = {"full": "x string, y double", "none": "x string, y double"}
    folder = f"{tmp_path}/snap"
    assert load_snapshot(spark, folder, members) is None
    save_snapshot(folder, {"full": df, "none": df.filter("false")})
    loaded = load_snapshot(spark, folder, members)
    assert loaded["full"].count() == 1 and loaded["none"].count() == 0 and loaded["none"].columns == ["x", "y"]
    assert load_snapshot(spark, folder, {**members, "more": "x string"}) is None
    assert load_snapshot(spark, folder, members, use_cache=False) is None


def test_plans(spark, tmp_path):
    loci = frame(spark, [(f"l{i}", float(i % 360), float(i % 90), "", 1.0 + i / 100, 20.0, 3) for i in range(300)], f"{ID} string, ra double, dec double, tags string, {MJD} double, {MAG} double, num_mag_values int")
    loci = loci.withColumn("tags_arr", F.array().cast("array<string>"))
    alerts = frame(spark, [(f"l{i}", 1 + i % 3, 18.0) for i in range(300)], f"{ID} string, {ALERT_BAND} int, {ALERT_MAG} double")
    run = sampled_comparison(loci, alerts, [("a", 1.0, 2.0), ("b", 2.0, 4.0)], 50, 1)
    assert run.loci.count() == 100 and run.alerts.count() == 100 and run.magnitudes().count() == 240
    assert run.summary().filter("metric = 'loci'").count() == 2 and run.density().count() > 0
    store = CumulativeStore(spark, f"{tmp_path}/s")
    store.upsert(loci.filter(F.col(MJD) < 3))
    both, report, stats = nightly_ingest(loci, alerts, store, ("night", 3.0, 4.0), ("past", 1.0, 3.0), [], max_results=50, split_threshold=40)
    assert stats.new_rows == 100 and both.loci.filter("range_label = 'past'").count() == 200
    assert report.filter("status = 'split'").count() > 0
    assert both.checks().filter("status = 'FAIL'").count() <= 2


def test_unreadable_chunks_are_misses(spark, tmp_path):
    from skyspark.operators.chunks import adaptive_pull
    from skyspark.sources.chunk_cache import ChunkCache

    rows = spark.createDataFrame([(f"L{i}", 100.0 + i / 10, i) for i in range(40)], f"{ID} string, {MJD} double, seq long")
    cache = ChunkCache(spark, str(tmp_path / "cache"), packed=False)
    assert cache.read() is None and cache.chunks() is None
    plan = {"initial_days": 1.0, "min_seconds": 3600.0, "max_results": 8, "split_threshold": 6}
    pull = lambda: adaptive_pull(rows, "night", 100.0, 106.0, ["seq"], None, cache, **plan)
    sources = lambda report: {(round(r.mjd_min, 6), r.status): r.source for r in report.collect()}
    want = sorted(map(tuple, rows.collect()))
    found, report = pull()
    assert sorted(tuple(r) for r in found.select(ID, MJD, "seq").collect()) == want and set(sources(report).values()) == {"live"}
    again, report = pull()
    second = sources(report)
    assert sorted(tuple(r) for r in again.select(ID, MJD, "seq").collect()) == want
    assert {s for (_, status), s in second.items() if status != "split"} == {"cache"} and (105.0, "accepted") in second  # an empty chunk too
    part = next((tmp_path / "cache" / "rows").rglob("*.parquet"))
    part.write_bytes(part.read_bytes()[:20])
    third, report = pull()
    assert sorted(tuple(r) for r in third.select(ID, MJD, "seq").collect()) == want
    assert sum(s == "live" for (_, status), s in sources(report).items() if status != "split") == 1
    for part in (tmp_path / "cache" / "rows").rglob("*.parquet"):
        part.write_bytes(b"no parquet")
    assert cache.read().count() == 0 and cache.missing(cache._manifest()).count() > 0


def test_snapshot_of_an_empty_member_with_commas_in_its_type(spark, tmp_path):
    from skyspark.sources.snapshots import load_snapshot, save_snapshot

    ddl = "a decimal(10,2), b array<struct<x: int, y: string>>"
    save_snapshot(str(tmp_path / "s"), {"none": spark.createDataFrame([], ddl)})
    assert load_snapshot(spark, str(tmp_path / "s"), {"none": ddl})["none"].schema == spark.createDataFrame([], ddl).schema


def test_negative_mjd_keys(spark):
    from skyspark.functions.text import mjd_part

    values = [-0.5, -1.25, 0.0, 2.5, -61000.000000015]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(mjd_part(F.col("x"))).collect()]
    assert got == [f"{v:.8f}".replace(".", "p") for v in values]
