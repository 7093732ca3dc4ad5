"""What is kept beside the tables: sketches, buckets, counts, and the state of a stream."""

import random

import pytest
from pyspark.sql import functions as F

from skyspark.operators import alerts as al
from skyspark.operators import chunks, density, ranges, sketches
from skyspark.schema import ALERT_BAND, ALERT_MAG, ID, MJD
from skyspark.sources.bucketed import new_table, save_bucketed
from skyspark.sources.counts import CountTable
from skyspark.sources.store import CumulativeStore
from skyspark.streaming.newest import newest_only, start_newest_upsert

ROWS = f"{ID} string, {MJD} double, seq long"


def frame(spark, rows, ddl=ROWS):
    return spark.createDataFrame(rows, ddl)


# --- sketches ---


def test_sketches_of_nights_merge(spark):
    rng = random.Random(1)
    rows = [(f"l{rng.randint(0, 30_000)}", rng.choice([100.0, 101.5, 102.25, 103.0]), i) for i in range(60_000)] + [(None, 100.0, 0), ("x", None, 0)]
    kept = sketches.nightly_sketches(frame(spark, rows)).cache()
    assert {r.night: r.n for r in kept.collect()} == {n: sum(m is not None and int(m) == n for _, m, _ in rows) for n in (100, 101, 102, 103)} | {None: 1}
    ids = lambda lo, hi: {k for k, m, _ in rows if k is not None and m is not None and lo <= int(m) <= hi}
    spans = frame(spark, [("two", 100, 101), ("all", 0, 999), ("none", 5, 6)], "range_label string, first_night long, last_night long")
    found = {r.range_label: r for r in sketches.distinct_in(kept, spans).collect()}
    assert set(found) == {"two", "all"}
    for label, lo, hi in (("two", 100, 101), ("all", 0, 999)):
        assert abs(found[label].n_distinct - len(ids(lo, hi))) <= sketches.BOUND * len(ids(lo, hi))
        assert found[label].n_duplicates == found[label].n - found[label].n_distinct
    both = sketches.overlap_of(kept, (100, 101), (102, 103)).first()
    one, two = ids(100, 101), ids(102, 103)
    assert abs(both.n_shared - len(one & two)) <= sketches.BOUND * (len(one) + len(two) + len(one | two))
    nothing = sketches.overlap_of(kept, (1, 2), (3, 4)).first()
    assert tuple(nothing) == (0, 0, 0, 0.0)


def test_small_sets_are_exact(spark):
    kept = sketches.nightly_sketches(frame(spark, [(f"l{i % 40}", 100.0 + i % 2, i) for i in range(200)]))
    row = sketches.overlap_of(kept, (100, 100), (101, 101)).first()
    assert (row.n1, row.n2, row.n_shared) == (20, 20, 0)


# --- buckets ---


def exchanges(df, capsys, table):
    """Whether the plan shuffles the rows of ``table``."""
    df.explain("simple")
    plan = capsys.readouterr().out
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if table in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    for line in reversed(lines[:at]):  # the operators above the scan, up to the join
        here = len(line) - len(line.lstrip(" :+-"))
        if here < depth:
            depth = here
            if "Exchange" in line:
                return True
            if "Join" in line:
                return False
    return False


def test_alerts_in_buckets_are_not_shuffled(spark, capsys):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of size
    try:
        loci = frame(spark, [(f"l{i}", 100.0 + i / 10, i) for i in range(200)])
        alerts = frame(spark, [(f"l{i % 250}", 1 + i % 3, 15.0 + i % 10) for i in range(2000)], f"{ID} string, {ALERT_BAND} int, {ALERT_MAG} double")
        spans = [("a", 100.0, 110.0), ("b", 110.0, 115.0)]
        plain = density.magnitude_histogram(al.alerts_for(ranges.label_ranges(loci, spans), alerts))
        names = new_table(spark, "loci"), new_table(spark, "alerts")
        kept_loci, kept_alerts = save_bucketed(loci, names[0], 4), save_bucketed(alerts, names[1], 4)
        found = density.magnitude_histogram(al.alerts_for(ranges.label_ranges(kept_loci, spans), kept_alerts))
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
        assert not exchanges(found, capsys, names[1])
        sampled = density.magnitude_histogram(al.alerts_for(ranges.label_ranges(loci, spans), kept_alerts))  # only the loci go to the alerts
        assert not exchanges(sampled, capsys, names[1]) and sorted(map(tuple, sampled.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


# --- counts ---


def test_plans_from_kept_counts(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"l{i}", 100.0 + 4 * rng.random() ** 2, i) for i in range(3000)] + [("x", None, 0), ("y", 104.0, 1), ("z", 99.9, 2)]
    kept = CountTable(spark, f"{tmp_path}/counts")
    assert kept.read().count() == 0
    for k in range(3):
        assert kept.add(frame(spark, [r for r in rows if r[2] % 3 == k]), f"batch {k}")
    assert not kept.add(frame(spark, rows), "batch 1")  # known
    plan = {"min_seconds": 30.0, "max_results": 40, "split_threshold": 30}
    inside = [r for r in rows if r[1] is not None and 100.0 <= r[1] < 104.0]

    def report(df):
        return sorted((round(r.mjd_min, 9), round(r.mjd_max, 9), r.n_loci, r.status) for r in df.collect())

    want = report(chunks.adaptive_report(frame(spark, inside), "x", 100.0, 104.0, 1.0, **plan))
    assert report(chunks.counted_report(kept.read(100, 103), "x", 100, 104, **plan)) == want and any(r[3] == "split" for r in want)
    kept.compact()
    assert report(chunks.counted_report(kept.read(), "x", 100, 104, **plan)) == want and len(kept.log.latest()[1]["files"]) == 1
    assert kept.add(frame(spark, [("n", 101.0, 1)]), "batch 9") and kept.read(101, 101).agg(F.sum("n")).first()[0] == sum(101 <= r[1] < 102 for r in inside) + 1
    with pytest.raises(ValueError):
        chunks.counted_report(kept.read(), "x", 100, 104, min_seconds=1.0)


def test_planning_reads_no_row(spark, tmp_path):
    kept, seen = CountTable(spark, f"{tmp_path}/counts"), spark.sparkContext.accumulator(0)
    rows = frame(spark, [(f"l{i}", 100.0 + i / 1000, i) for i in range(500)])
    watched = rows.withColumn(MJD, F.udf(lambda x: (seen.add(1), x)[1], "double").asNondeterministic()(F.col(MJD)))
    kept.add(watched)
    once = seen.value
    chunks.counted_report(kept.read(), "x", 100, 101, max_results=40, split_threshold=30).collect()
    assert seen.value == once > 0


# --- stream ---


@pytest.mark.parametrize("null_time", ["newest", "oldest"])
def test_late_rows_stop_before_the_store(spark, tmp_path, null_time):
    batches = [
        [("a", 5.0, 1), ("a", 4.0, 2), ("b", 1.0, 3), ("c", None, 4)],
        [("a", 3.0, 5), ("b", 2.0, 6), (None, 1.0, 7)],  # a is late
        [("a", 5.0, 8), ("b", 1.5, 9), ("c", 9.0, 10), (None, 0.5, 11)],  # of one time as before; b is late
        [("a", 1.0, 12), ("b", 0.0, 13)],  # all late
    ]
    store = CumulativeStore(spark, f"{tmp_path}/store", null_time, n_buckets=4)
    for i, rows in enumerate(batches):
        frame(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
        arriving = spark.readStream.schema(ROWS).parquet(f"{tmp_path}/in/*")
        start_newest_upsert(arriving, store, f"{tmp_path}/check", "s", ["seq"]).awaitTermination()
    late_c = null_time == "newest"
    want = [("", False, 1.0, 7), ("a", False, 5.0, 8), ("b", False, 2.0, 6), ("c", True, 0.0, 4) if late_c else ("c", False, 9.0, 10)]
    assert sorted((r[ID] or "", r[MJD] is None, r[MJD] or 0.0, r.seq) for r in store.read().collect()) == want
    assert len(store.log.entry(store.log.numbers()[-1])["batches"]) == 3  # the last batch reached no store


def test_rows_that_pass(spark, tmp_path):
    frame(spark, [("a", 5.0, 1), ("a", 6.0, 2), ("a", 6.0, 3), ("b", 1.0, 4)]).coalesce(1).write.parquet(f"{tmp_path}/in/0")
    passed = []
    provider = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        query = newest_only(spark.readStream.schema(ROWS).parquet(f"{tmp_path}/in/*"), ["seq"]).writeStream.foreachBatch(lambda df, _: passed.extend(map(tuple, df.collect())))
        query.option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset(provider)
    assert sorted(passed) == [("a", 6.0, 3), ("b", 1.0, 4)]


# --- ingest ---


def raw(spark, rows):
    return spark.createDataFrame(rows, f"{ID} string, ra double, dec double, tags_arr array<string>, {MJD} double, properties string")


INGEST = [
    ("a", 10.0, 1.0, ["in_LSSTDDF"], 60300.0, '{"k": 1}'),
    ("b", 360.0, 91.0, [], 60200.5, '{"k": 2}'),
    ("c", None, 0.0, None, 60302.5, "{}"),
    ("d", 1.0, 1.0, ["x"], None, None),
    ("e", 1.0, 1.0, ["x"], 60300.5, "{broken"),
    ("f", 1.0, 1.0, [None], 60300.5, "{}"),
    (None, 1.0, 1.0, ["x"], 60300.5, '{"k": 3}'),
]


def test_checks_on_the_write_are_those_of_the_suite(spark, tmp_path):
    from skyspark.operators.quality import quality_checks
    from skyspark.sources.ingest import ingest

    seen = spark.sparkContext.accumulator(0)
    records = raw(spark, INGEST * 20).withColumn("properties", F.udf(lambda x: (seen.add(1), x)[1], "string").asNondeterministic()(F.col("properties")))
    span = ("night", 60300.0, 60301.0)
    done = ingest(records, "k int", f"{tmp_path}/in", span)
    assert seen.value == len(INGEST) * 20  # one pass
    assert {r[ID] for r in done.loci().collect()} == {"a", "b", "c", "d"} and done.loci().count() == 80
    gone = {r._record for r in done.quarantine().collect()}
    assert done.quarantine().count() == 60 and "{broken" in gone and all(x is not None for x in gone)
    labelled = done.loci().withColumn("range_label", F.lit("night"))
    none = frame(spark, [], f"range_label string, {ALERT_MAG} double")
    suite = quality_checks(labelled, none, ranges.ranges_frame(spark, [span])).filter(F.col("check_no").isin(1, 2, 3, 4, 8))
    mine = done.checks().filter("check_no > 0")
    key = lambda r: (r.check_no, r.name, r.range_label or "", r.status, round(r.observed, 9), r.detail)
    assert sorted(map(key, mine.collect())) == sorted(map(key, suite.collect()))
    assert [(r.status, r.observed) for r in done.checks().filter("check_no = 0").collect()] == [("WARN", 60.0)]


def test_ingest_of_nothing(spark, tmp_path):
    from skyspark.sources.ingest import ingest

    done = ingest(raw(spark, INGEST).filter("false"), "k int", f"{tmp_path}/in", ("night", 1.0, 2.0))
    assert {r.name: r.status for r in done.checks().collect()} == {"well_formed": "PASS", "data_present": "FAIL", "mjd_in_window": "SKIP", "ra_valid": "SKIP", "dec_valid": "SKIP", "survey_era": "SKIP", "tagged": "INFO", "range_order": "PASS"}


def test_a_stream_reports_each_batch(spark, tmp_path):
    import time

    from skyspark.sources.ingest import CheckListener, metrics, parted

    span = ("night", 60300.0, 60301.0)
    listener = CheckListener([span])
    spark.streams.addListener(listener)
    try:
        for i, rows in enumerate((INGEST[:2], INGEST[2:])):
            raw(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
            arriving = spark.readStream.schema(raw(spark, INGEST).schema).parquet(f"{tmp_path}/in/*")
            rows = parted(arriving, "k int").observe("night", *metrics(span))
            rows.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/check").partitionBy("_rejected").trigger(availableNow=True).start().awaitTermination()
        for _ in range(50):
            if len({b for b, _, s in listener.batches if s["n"]}) == 2:
                break
            time.sleep(0.2)
        found = {(r.batch_id, r.name): r.observed for r in listener.checks(spark).filter("check_no < 4").collect()}
        assert (found[0, "data_present"], found[0, "well_formed"], found[0, "ra_valid"]) == (2.0, 0.0, 1.0)
        assert (found[1, "data_present"], found[1, "well_formed"], found[1, "ra_valid"]) == (2.0, 3.0, 1.0)
    finally:
        spark.streams.removeListener(listener)
