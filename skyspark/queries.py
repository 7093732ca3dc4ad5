"""The registered queries of the survey operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.mjd import mjd_to_date, seconds_to_days, timestamp_to_mjd
from .functions.text import chunk_key, mjd_part, safe_part
from .operators import alerts as al
from .operators import chunks, density, quality, ranges, sample, sketches, summary
from .operators.dedupe import newest_per_locus, union_all
from .schema import ALERT_BAND, ALERT_MAG, ID, LOCI, MAG, MJD, OBS, empty
from .sources import storage, tables
from .sources.bucketed import new_table, save_bucketed
from .sources.chunk_cache import ChunkCache
from .sources.counts import CountTable
from .sources.ingest import ingest
from .sources.raw import flatten_loci, malformed_count, parse_properties
from .sources.snapshots import load_snapshot, save_snapshot, snapshot_key
from .sources.store import CumulativeStore
from .streaming.newest import start_newest_upsert
from .streaming.upsert import start_upsert

LAST, HISTORY = ("last", 52000.0, 52122.9), ("history", 49718.0, 52000.0)
RANGES = [LAST, HISTORY]
#: Bounds of the event records' times.
FIRST_DAY, LAST_DAY = 60310.0, 60340.0
SAMPLE, SEED = 500, 42
PLAN = {"initial_days": 1.0, "min_seconds": 30.0, "max_results": 30, "split_threshold": 25}
CORE = [ID, "ra", "dec", "tags", MJD, MAG, OBS]


def window_scan_closed(spark: SparkSession, d: str) -> DataFrame:
    """S1, P2."""
    return ranges.window_scan(tables.loci(spark, d), LAST[1], LAST[2]).select(CORE)


def window_scan_half_open(spark: SparkSession, d: str) -> DataFrame:
    """The event records of half a day, whose bounds are event times."""
    return ranges.window_scan(tables.raw_records(spark, d), 60320.0, 60320.5, include_upper=False).select(ID, MJD, "ingest_seq")


def tag_filter(spark: SparkSession, d: str) -> DataFrame:
    """P4."""
    return ranges.has_tag(tables.loci(spark, d), "1-URGENT").select(ID, "tags")


def tag_contains(spark: SparkSession, d: str) -> DataFrame:
    """P5, F1."""
    return tables.loci(spark, d).filter(ranges.tag_contains("URG")).groupBy("tags").agg(F.count("*").alias("n"))


def flatten_properties(spark: SparkSession, d: str) -> DataFrame:
    """P1, F2, S12."""
    parsed = parse_properties(tables.raw_records(spark, d), "k bigint")
    return flatten_loci(parsed).select(ID, "tags", MJD, MAG, "ingest_seq", "k")


def malformed_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows read and rejected, some of them with broken JSON."""
    records = tables.raw_records(spark, d)
    broken = F.when(F.col("ingest_seq") % 50 == 0, F.concat(F.lit("{"), "properties")).otherwise(F.col("properties"))
    return malformed_count(parse_properties(records.withColumn("properties", broken), "k bigint"))


def newest_first_topn(spark: SparkSession, d: str) -> DataFrame:
    """L1."""
    return sample.newest_first(ranges.window_scan(tables.loci(spark, d), HISTORY[1], HISTORY[2]), SAMPLE).select(ID, MJD)


def seeded_sample_topn(spark: SparkSession, d: str) -> DataFrame:
    """L2."""
    return sample.sample_ranges(tables.loci(spark, d), RANGES, SAMPLE, SEED).select("range_label", ID, MJD)


def first_loci(spark: SparkSession, d: str) -> DataFrame:
    """L3."""
    return sample.first_by_id(tables.loci(spark, d), SAMPLE).select(ID, MJD)


def two_range_label(spark: SparkSession, d: str) -> DataFrame:
    """S2, J4, P14."""
    return ranges.label_ranges(tables.loci(spark, d), [*RANGES, ("invalid", 2.0, 1.0)]).select("range_label", ID, MJD)


def alerts_for_sample(spark: SparkSession, d: str) -> DataFrame:
    """S3, J1, L3, P13."""
    chosen = sample.sample_ranges(tables.loci(spark, d), RANGES, SAMPLE, SEED)
    return al.alerts_for(chosen, tables.alerts(spark, d), SAMPLE * len(RANGES)).select("range_label", ID, ALERT_BAND, ALERT_MAG)


def _all_alerts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    labelled = ranges.label_ranges(tables.loci(spark, d), RANGES)
    return labelled, al.alerts_for(labelled, tables.alerts(spark, d))


def band_counts(spark: SparkSession, d: str) -> DataFrame:
    """G5, J3, L4."""
    return al.band_counts(_all_alerts(spark, d)[1]).select("range_label", ALERT_BAND, "band", "n").orderBy("range_label", ALERT_BAND)


def dedupe_newest(spark: SparkSession, d: str) -> DataFrame:
    """W1, U5."""
    return newest_per_locus(tables.raw_records(spark, d), ["ingest_seq"]).select(ID, MJD, MAG, "ingest_seq")


def dedupe_null_time(spark: SparkSession, d: str) -> DataFrame:
    """W1 with missing times."""
    records = tables.raw_records(spark, d).withColumn(MJD, F.when(F.col("ingest_seq") % 500 != 0, F.col(MJD)))
    return newest_per_locus(records, ["ingest_seq"]).select(ID, MJD, MAG, "ingest_seq")


def _stored(spark: SparkSession, d: str) -> tuple[CumulativeStore, list]:
    """A store of the even records, then the odd ones upserted."""
    store = CumulativeStore(spark, storage.new_folder(spark, "store"))
    records = tables.raw_records(spark, d).drop("properties")
    stats = [store.upsert(records.filter(F.col("ingest_seq") % 2 == half), ["ingest_seq"]) for half in (0, 1)]
    return store, stats


def cumulative_upsert(spark: SparkSession, d: str) -> DataFrame:
    """S6, U2."""
    return _stored(spark, d)[0].read().select(ID, MJD, MAG, "ingest_seq")


def cumulative_range_read(spark: SparkSession, d: str) -> DataFrame:
    """S5."""
    return _stored(spark, d)[0].read_range(60339.5, 60339.9).select(ID, MJD, "ingest_seq")


def store_stats(spark: SparkSession, d: str) -> DataFrame:
    """G16."""
    return _stored(spark, d)[1][1].frame(spark)


def fixed_chunks(spark: SparkSession, d: str) -> DataFrame:
    """The hour of every record, from the spine."""
    records, hour = tables.raw_records(spark, d), 3600 / 86400.0
    spine = chunks.chunk_spine(spark, FIRST_DAY, LAST_DAY, hour)
    placed = records.withColumn("chunk", chunks.chunk_of(F.col(MJD), FIRST_DAY, LAST_DAY, hour)).join(spine, "chunk")
    return placed.select("ingest_seq", "chunk", F.round("mjd_min", 9).alias("mjd_min"), F.round("mjd_max", 9).alias("mjd_max"), "include_upper")


def fixed_chunk_counts(spark: SparkSession, d: str) -> DataFrame:
    """C1, G14, J6."""
    counted = chunks.chunk_counts(tables.raw_records(spark, d), FIRST_DAY, LAST_DAY, 600 / 86400.0)
    return counted.select("chunk", F.round("mjd_min", 9).alias("mjd_min"), "include_upper", "n")


def adaptive_chunk_report(spark: SparkSession, d: str) -> DataFrame:
    """C2-C4, L4, F7."""
    report = chunks.adaptive_report(tables.raw_records(spark, d), "events", FIRST_DAY, LAST_DAY, **PLAN)
    edges = {c: F.round(c, 9) for c in ("mjd_min", "mjd_max")} | {"width_seconds": F.round("width_seconds", 6)}
    return chunks.ordered_report(report.withColumns(edges))


def chunk_status_counts(spark: SparkSession, d: str) -> DataFrame:
    """G15."""
    return chunks.status_counts(chunks.adaptive_report(tables.raw_records(spark, d), "events", FIRST_DAY, LAST_DAY, **PLAN))


def adaptive_pull(spark: SparkSession, d: str) -> DataFrame:
    """S4, C5."""
    rows, _ = chunks.adaptive_pull(tables.raw_records(spark, d), "events", FIRST_DAY, LAST_DAY, ["ingest_seq"], "click", **PLAN)
    return rows.select(ID, MJD, MAG, "ingest_seq")


def _pulled_twice(spark: SparkSession, d: str, lo: float, hi: float, tag: str | None) -> tuple[DataFrame, DataFrame]:
    cache = ChunkCache(spark, storage.new_folder(spark, "pulls"))
    pull = lambda: chunks.adaptive_pull(tables.raw_records(spark, d).drop("properties", "tags_arr"), "events", lo, hi, ["ingest_seq"], tag, cache, **PLAN)
    pull()
    return pull()


def cached_pull(spark: SparkSession, d: str) -> DataFrame:
    """A pull whose accepted chunks an earlier one has cached."""
    return _pulled_twice(spark, d, FIRST_DAY, LAST_DAY, "click")[0].select(ID, MJD, MAG, "ingest_seq")


def cached_pull_report(spark: SparkSession, d: str) -> DataFrame:
    """The report of such a pull over the whole month."""
    report = _pulled_twice(spark, d, FIRST_DAY, LAST_DAY, None)[1]
    edges = {c: F.round(c, 9) for c in ("mjd_min", "mjd_max")} | {"width_seconds": F.round("width_seconds", 6)}
    return report.withColumns(edges)


def typed_empty(spark: SparkSession, d: str) -> DataFrame:
    """A typed empty result takes part in a union like any other; F6."""
    found = ranges.window_scan(tables.loci(spark, d), LAST[1], LAST[2]).select(CORE)
    return empty(spark, LOCI).select(CORE).unionByName(found).withColumn("age_days", F.round(seconds_to_days(F.round((F.lit(LAST[2]) - F.col(MJD)) * 86400)), 9)).select(ID, MJD, "age_days")


def chunk_keys(spark: SparkSession, d: str) -> DataFrame:
    """F3-F5."""
    records = tables.raw_records(spark, d)
    label = F.concat(F.lit(" Night of "), F.element_at("tags_arr", 1), F.lit("! "))
    tag = F.when(F.col("ingest_seq") % 3 == 0, F.element_at("tags_arr", 1)).when(F.col("ingest_seq") % 3 == 1, F.lit("!!"))
    return records.select("ingest_seq", safe_part(label).alias("label_key"), mjd_part(F.col(MJD)).alias("start_key"), mjd_part(60320.5 - F.col(MJD)).alias("offset_key"), chunk_key(label, F.col(MJD), F.col(MJD) + 1, tag).alias("chunk_key"))


def mjd_to_dates(spark: SparkSession, d: str) -> DataFrame:
    """F9, F13."""
    events = tables.table(spark, d, "events")
    return events.select("event_id", timestamp_to_mjd(F.col("ts")).alias("mjd"), mjd_to_date(timestamp_to_mjd(F.col("ts"))).cast("string").alias("day"))


def sky_wrap(spark: SparkSession, d: str) -> DataFrame:
    """F10, P11."""
    labelled = ranges.label_ranges(tables.dirty_loci(spark, d), RANGES)
    return density.all_sky_points(labelled).select(ID, F.round("ra_rad", 9).alias("ra_rad"), F.round("dec_rad", 9).alias("dec_rad"))


def sky_density_2d(spark: SparkSession, d: str) -> DataFrame:
    """G10, G13."""
    return density.sky_density(ranges.label_ranges(tables.loci(spark, d), RANGES))


def mag_hist_by_band(spark: SparkSession, d: str) -> DataFrame:
    """G11, J6, over seeded samples: scan, window, sample, join, bins (the flagship)."""
    chosen = sample.sample_ranges(tables.loci(spark, d), RANGES, SAMPLE, SEED)
    return density.magnitude_histogram(al.alerts_for(chosen, tables.alerts(spark, d), SAMPLE * len(RANGES)))


def mag_hist_all(spark: SparkSession, d: str) -> DataFrame:
    """G11 over all alerts of both ranges."""
    return density.magnitude_histogram(_all_alerts(spark, d)[1])


def mag_hist_fallback(spark: SparkSession, d: str) -> DataFrame:
    """G12."""
    labelled, found = _all_alerts(spark, d)
    return density.magnitude_series(labelled, found.filter(F.col(ALERT_MAG) > 99.0)).drop("band")


def range_summary(spark: SparkSession, d: str) -> DataFrame:
    """G1-G4, G17."""
    labelled, found = _all_alerts(spark, d)
    return summary.range_summary(labelled, found).select("range_label", "metric", F.round("value", 9).alias("value"))


def range_config(spark: SparkSession, d: str) -> DataFrame:
    """G18, with the loci that each range holds."""
    report = ranges.range_report(ranges.ranges_frame(spark, [*RANGES, ("wide", 51000.0, 52100.0), ("invalid", 2.0, 1.0)]))
    held = ranges.label_ranges(tables.loci(spark, d), [*RANGES, ("wide", 51000.0, 52100.0)]).groupBy(F.col("range_label").alias("label")).agg(F.count("*").alias("n"))
    return report.join(held, "label", "left").withColumns({"n": F.coalesce("n", F.lit(0).cast("long")), "span_days": F.round("span_days", 9)})


def range_overlap(spark: SparkSession, d: str) -> DataFrame:
    """J2, G6, G9, U4, on the event records of two halves of the month."""
    records = tables.raw_records(spark, d)
    early, late = ranges.window_scan(records, 60310.0, 60311.0), ranges.window_scan(records, 60311.0, 60340.0)
    return summary.range_overlap(early, late).withColumn("pct", F.round("pct", 9))


def _checks(spark: SparkSession, d: str) -> DataFrame:
    labelled = ranges.label_ranges(tables.dirty_loci(spark, d), RANGES)
    found = al.alerts_for(ranges.label_ranges(tables.loci(spark, d), RANGES), tables.alerts(spark, d))
    return quality.quality_checks(labelled, found, ranges.ranges_frame(spark, RANGES), era_start=50000.0, info_tag="1-URGENT")


def dq_suite(spark: SparkSession, d: str) -> DataFrame:
    """V1-V8."""
    return _checks(spark, d).withColumn("observed", F.round("observed", 9))


def dq_verdict(spark: SparkSession, d: str) -> DataFrame:
    """V9."""
    return quality.verdict(_checks(spark, d))


def snapshot_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """A sample and its alerts, with one member empty, saved and loaded."""
    chosen = sample.sample_ranges(tables.loci(spark, d), RANGES, SAMPLE, SEED)
    folder = f"{storage.new_folder(spark, 'snapshots')}/{snapshot_key(spark, RANGES, SAMPLE, seed=SEED)}"
    found = al.alerts_for(chosen, tables.alerts(spark, d), SAMPLE * len(RANGES)).select("range_label", ID, ALERT_BAND, ALERT_MAG)
    save_snapshot(folder, {"loci": chosen.select(CORE), "alerts": found, "none": found.filter("false")})
    ddl = f"range_label string, {ID} string, {ALERT_BAND} int, {ALERT_MAG} double"
    loaded = load_snapshot(spark, folder, {"loci": "", "alerts": ddl, "none": ddl})
    return loaded["alerts"].unionByName(loaded["none"])


def chunk_cache_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Days of records cached, one of them again, then read and compared with the plan."""
    records = tables.raw_records(spark, d)
    spine = chunks.chunk_spine(spark, FIRST_DAY, LAST_DAY, 1.0)
    keyed = spine.select("chunk", F.lit("events").alias("label_key"), F.lit("all").alias("tag_key"), chunk_key(F.lit("events"), F.col("mjd_min"), F.col("mjd_max"), F.lit(None).cast("string")).alias("chunk_key"))
    day = chunks.chunk_of(F.col(MJD), FIRST_DAY, LAST_DAY, 1.0)
    rows = ranges.window_scan(records, FIRST_DAY, LAST_DAY).select(ID, MJD, "ingest_seq", day.alias("chunk")).join(F.broadcast(keyed), "chunk")
    cache = ChunkCache(spark, storage.new_folder(spark, "chunks"))
    cache.write(rows.filter("chunk < 28"))
    cache.write(rows.filter("chunk = 3"))
    missing = cache.missing(keyed).select(F.lit("").alias(ID), F.lit(-1).cast("long").alias("ingest_seq"), "chunk")
    return cache.read().select(ID, "ingest_seq", "chunk").unionByName(missing)


def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The odd records arrive as a stream."""
    store = CumulativeStore(spark, storage.new_folder(spark, "store"))
    events = tables.table(spark, d, "events")
    keep = lambda df: tables.from_events(df).drop("properties")
    store.upsert(keep(events.filter("event_id % 2 = 0")), ["ingest_seq"])
    arriving = spark.readStream.schema(events.schema).parquet(f"{d}/event[s].parquet").filter("event_id % 2 = 1")
    start_upsert(arriving, store, storage.new_folder(spark, "stream"), "events", ["ingest_seq"], keep).awaitTermination()
    return store.read().select(ID, MJD, MAG, "ingest_seq")


def ingest_checks(spark: SparkSession, d: str) -> DataFrame:
    """Checks of the records of a month made as they are written, a part of them broken."""
    records = tables.raw_records(spark, d).withColumns({"ra": (F.col("ingest_seq") % 365).cast("double"), "dec": F.lit(0.0)})
    broken = F.when(F.col("ingest_seq") % 50 == 0, F.concat(F.lit("{"), "properties")).otherwise(F.col("properties"))
    done = ingest(records.withColumn("properties", broken), "k bigint", storage.new_folder(spark, "ingest"), ("month", 60312.0, 60330.0), era_start=60311.0, info_tag="click")
    kept = done.loci().agg(F.count("*")).first()[0], done.quarantine().agg(F.count("*")).first()[0]
    return done.checks().withColumns({"n_loci": F.lit(kept[0]).cast("long"), "n_quarantined": F.lit(kept[1]).cast("long"), "observed": F.round("observed", 9)})


def stream_newest(spark: SparkSession, d: str) -> DataFrame:
    """Records arrive in files, the latest days first; what is late is dropped by state before the store."""
    folder = storage.new_folder(spark, "arrivals")
    records = tables.raw_records(spark, d).drop("properties")
    for day in (60333, 60326, 60319, 60312, 60305):
        ranges.window_scan(records, float(day), float(day + 7), include_upper=False).coalesce(1).write.mode("append").parquet(folder)
    store = CumulativeStore(spark, storage.new_folder(spark, "store"))
    arriving = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    start_newest_upsert(arriving, store, storage.new_folder(spark, "stream"), "events", ["ingest_seq"]).awaitTermination()
    return store.read().select(ID, MJD, MAG, "ingest_seq")


def sketched_distinct(spark: SparkSession, d: str) -> DataFrame:
    """G6, V6 by sketches: rows and distinct ids of ranges of nights, and whether the estimate keeps to its bound."""
    found, exact = [], []
    for name, rows in (("loci", tables.dirty_loci(spark, d)), ("events", tables.raw_records(spark, d))):
        spans = [("all", 0, 100_000), ("early", 0, 60_320), ("first", 49_718, 50_100)]
        held = ranges.ranges_frame(spark, spans).select(F.col("label").alias("range_label"), F.col("mjd_min").cast("long").alias("first_night"), F.col("mjd_max").cast("long").alias("last_night"))
        found.append(sketches.distinct_in(sketches.nightly_sketches(rows), held).withColumn("rows_of", F.lit(name)))
        night = F.floor(MJD).cast("long")
        inside = rows.select(ID, night.alias("night")).join(F.broadcast(held), F.col("night").between(F.col("first_night"), F.col("last_night")))
        exact.append(inside.groupBy("range_label").agg(F.count_distinct(ID).alias("exact")).withColumn("rows_of", F.lit(name)))
    both = union_all(*found).join(union_all(*exact), ["rows_of", "range_label"])
    close = F.abs(F.col("n_distinct") - F.col("exact")) <= F.col("exact") * sketches.BOUND + 1
    return both.select("rows_of", "range_label", "n", F.col("exact").alias("n_distinct"), close.alias("within_bound"))


def sketched_overlap(spark: SparkSession, d: str) -> DataFrame:
    """J2, U4 by sketches: ids shared by two sets of nights, within the bound of their union."""
    records = tables.raw_records(spark, d)
    guess = sketches.overlap_of(sketches.nightly_sketches(records), (60310, 60310), (60311, 60339))
    early, late = ranges.window_scan(records, 60310.0, 60311.0, include_upper=False), ranges.window_scan(records, 60311.0, 60340.0)
    exact = summary.range_overlap(early, late)
    bound = lambda c: F.col(c) * sketches.BOUND + 1
    near = lambda c, by: F.abs(F.col(f"g.{c}") - F.col(f"e.{c}")) <= by
    union = (F.col("e.n1") + F.col("e.n2") - F.col("e.n_shared")) * sketches.BOUND + bound("e.n1") + bound("e.n2")
    return guess.alias("g").join(exact.alias("e")).select(F.col("e.n1").alias("n1"), F.col("e.n2").alias("n2"), F.col("e.n_shared").alias("n_shared"), (near("n1", bound("e.n1")) & near("n2", bound("e.n2")) & near("n_shared", union)).alias("within_bound"))


def mag_hist_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """G11 over all alerts, loci and alerts kept in buckets of one kind."""
    loci = save_bucketed(tables.loci(spark, d), new_table(spark, "loci"))
    alerts = save_bucketed(tables.alerts(spark, d), new_table(spark, "alerts"))
    return density.magnitude_histogram(al.alerts_for(ranges.label_ranges(loci, RANGES), alerts))


def counted_plan(spark: SparkSession, d: str) -> DataFrame:
    """The adaptive plan from counts that were added to by batches, one of which came twice."""
    kept = CountTable(spark, storage.new_folder(spark, "counts"))
    records = tables.raw_records(spark, d)
    for batch, part in (("a", 0), ("b", 1), ("a", 0)):
        kept.add(records.filter(F.col("ingest_seq") % 2 == part), batch)
    report = chunks.counted_report(kept.read(int(FIRST_DAY), int(LAST_DAY) - 1), "events", int(FIRST_DAY), int(LAST_DAY), **{k: v for k, v in PLAN.items() if k != "initial_days"})
    edges = {c: F.round(c, 9) for c in ("mjd_min", "mjd_max")} | {"width_seconds": F.round("width_seconds", 6)}
    return report.withColumns(edges)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        window_scan_closed, window_scan_half_open, tag_filter, tag_contains, flatten_properties, malformed_rows, newest_first_topn, seeded_sample_topn, first_loci,
        two_range_label, alerts_for_sample, band_counts, dedupe_newest, dedupe_null_time, cumulative_upsert, cumulative_range_read, store_stats,
        fixed_chunks, fixed_chunk_counts, adaptive_chunk_report, chunk_status_counts, adaptive_pull, cached_pull, cached_pull_report, typed_empty, chunk_keys, mjd_to_dates, sky_wrap,
        sky_density_2d, mag_hist_by_band, mag_hist_all, mag_hist_fallback, range_summary, range_config, range_overlap, dq_suite, dq_verdict,
        snapshot_roundtrip, chunk_cache_roundtrip, stream_upsert, stream_newest, ingest_checks, sketched_distinct, sketched_overlap, mag_hist_bucketed, counted_plan,
    )
}


# --- SQL ---------------------------------------------------------------------

_D = lambda x: f"CAST({x} AS DOUBLE)"
_MJD = lambda ts: f"({_D(40587)} + epoch_us({ts}) / {_D(86400000000)})"

_LOCI = f"""loci AS (
  SELECT 'L' || o_orderkey AS {ID}, {_D("(o_orderkey * 7919) % 36000")} / {_D(100)} AS ra,
    {_D("(o_orderkey * 104729) % 18001")} / {_D(100)} - {_D(90)} AS dec,
    o_orderpriority || ', ' || o_orderstatus AS tags, [o_orderpriority, o_orderstatus] AS tags_arr,
    {_MJD("o_orderdate")} + {_D("(o_orderkey * 7919) % 86400")} / {_D(86400)} AS {MJD},
    CASE WHEN o_orderkey % 97 <> 0 THEN {_D(14)} + o_totalprice / {_D(500000)} * {_D(12)} END AS {MAG},
    CAST(o_custkey % 50 AS INTEGER) AS {OBS}, o_orderkey AS k
  FROM orders
)"""
_ALERTS = f"""alerts AS (
  SELECT 'L' || l_orderkey AS {ID}, CAST(1 + l_linenumber % 4 AS INTEGER) AS {ALERT_BAND},
    CASE WHEN l_partkey % 53 <> 0 THEN {_D(14)} + l_quantity * {_D(0.25)} END AS {ALERT_MAG}
  FROM lineitem
)"""
_RAW = f"""raw AS (
  SELECT 'U' || user_id AS {ID}, {_MJD("ts")} AS {MJD}, props, event_type AS tag, value AS {MAG}, event_id AS ingest_seq FROM events
)"""
_DIRTY = f"""dirty AS (
  SELECT l.* REPLACE (CASE WHEN k % 101 = 0 THEN {_D(360)} WHEN k % 103 = 0 THEN NULL ELSE ra END AS ra,
    CASE WHEN k % 107 = 0 THEN {_D(91)} ELSE dec END AS dec)
  FROM loci l, unnest(CASE WHEN k % 109 = 0 THEN [1, 2] ELSE [1] END) AS t(copy)
)"""
_RANGES = "ranges AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{n}', {_D(lo)}, {_D(hi)})" for i, (n, lo, hi) in enumerate(RANGES, 1)) + ") AS t(range_no, label, lo, hi))"
_LABELLED = f"labelled AS (SELECT label AS range_label, l.* FROM loci l JOIN ranges ON {MJD} BETWEEN lo AND hi)"
_LABELLED_ALERTS = f"found AS (SELECT range_label, a.* FROM labelled JOIN alerts a USING ({ID}))"
_SAMPLED = f"""ranked AS (
  SELECT *, row_number() OVER (PARTITION BY range_label ORDER BY md5('{SEED}#' || {ID}), {ID}) AS r FROM labelled
), sampled AS (SELECT * EXCLUDE (r) FROM ranked WHERE r <= {SAMPLE})"""
_SAMPLED_ALERTS = f"found AS (SELECT range_label, a.* FROM sampled JOIN alerts a USING ({ID}))"


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + "\n"


def _histogram(series: str, value: str, source: str) -> str:
    counts = f"""counts AS (
  SELECT {series}, least(CAST(floor(({value} - {_D(15)}) / ({_D(25)} - {_D(15)}) * {_D(40)}) AS INTEGER), 39) AS bin, count(*) AS n
  FROM {source} WHERE {value} BETWEEN 15 AND 25 GROUP BY ALL
)"""
    return f"""{counts}, spine AS (
  SELECT {series}, CAST(sum(n) AS BIGINT) AS n_series, unnest(range(40)) AS bin FROM counts GROUP BY {series}
)
SELECT {series}, CAST(bin AS INTEGER) AS bin, {_D(15)} + bin * ({_D(25)} - {_D(15)}) / {_D(40)} AS edge, coalesce(n, 0) AS n, n_series
FROM spine LEFT JOIN counts USING ({series}, bin)"""


_BANDED = f"banded AS (SELECT *, CASE {ALERT_BAND} WHEN 1 THEN 'g' WHEN 2 THEN 'r' WHEN 3 THEN 'i' END AS band FROM found WHERE {ALERT_BAND} IN (1, 2, 3))"
_NEWEST = f"SELECT {ID}, {MJD}, {MAG}, ingest_seq FROM raw QUALIFY row_number() OVER (PARTITION BY {ID} ORDER BY {MJD} DESC NULLS FIRST, ingest_seq DESC) = 1"

_M = 30.0 / 86400.0
_DEPTH = chunks.depth_of(1.0, _M)
_PLAN = f"""placed AS (
  SELECT least(CAST(floor(({MJD} - {_D(FIRST_DAY)}) / {_D(1)}) AS BIGINT), 29) AS i, {MJD} AS mjd FROM raw WHERE {MJD} BETWEEN {FIRST_DAY} AND {LAST_DAY}
), leaves AS (
  SELECT i, least(CAST(floor((mjd - ({_D(FIRST_DAY)} + i)) / {_D(1)} * {_D(1 << _DEPTH)}) AS BIGINT), {(1 << _DEPTH) - 1}) AS leaf, count(*) AS n FROM placed GROUP BY ALL
), nodes AS (
  SELECT i, d, CAST(floor(leaf / pow(2, {_DEPTH} - d)) AS BIGINT) AS k, CAST(sum(n) AS BIGINT) AS n FROM leaves, unnest(range({_DEPTH + 1})) AS t(d) GROUP BY ALL
), split AS (
  SELECT i, d, k FROM nodes WHERE n >= 25 AND {_D(1)} / pow(2, d) > {1.01 * _M!r}
), attempted AS (
  SELECT unnest(range(30)) AS i, 0 AS d, 0 AS k UNION ALL SELECT i, d + 1, unnest([2 * k, 2 * k + 1]) FROM split
), report AS (
  SELECT 'events' AS label, round({_D(FIRST_DAY)} + i + k * ({_D(1)} / pow(2, d)), 9) AS mjd_min, round({_D(FIRST_DAY)} + i + (k + 1) * ({_D(1)} / pow(2, d)), 9) AS mjd_max,
    round({_D(86400)} / pow(2, d), 6) AS width_seconds, least(coalesce(n, 0), 30) AS n_loci,
    CASE WHEN coalesce(n, 0) < 25 THEN 'accepted' WHEN {_D(1)} / pow(2, d) > {1.01 * _M!r} THEN 'split' ELSE 'accepted_at_minimum_saturated' END AS status,
    'live' AS source, i = 29 AND k = pow(2, d) - 1 AS include_upper, CAST(NULL AS VARCHAR) AS error
  FROM attempted LEFT JOIN nodes USING (i, d, k)
)"""

_SAFE = lambda x: f"coalesce(nullif(regexp_replace(regexp_replace({x}, '[^A-Za-z0-9_.-]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'all')"
_UNITS = lambda x: f"CAST(round({x} * {_D(100000000)}) AS BIGINT)"
_PART = lambda x: f"CAST({_UNITS(x)} // 100000000 AS VARCHAR) || 'p' || lpad(CAST({_UNITS(x)} % 100000000 AS VARCHAR), 8, '0')"

_CHECKS = f"""dirty_labelled AS (
  SELECT label AS range_label, lo, hi, d.* FROM dirty d JOIN ranges ON {MJD} BETWEEN lo AND hi
), wide AS (
  SELECT label AS range_label, r.lo, r.hi,
    count({ID}) AS n, count({MJD}) AS n_mjd, count(*) FILTER ({MJD} < r.lo - 0.02) AS below, count(*) FILTER ({MJD} > r.hi + 0.02) AS above,
    count(*) FILTER (NOT coalesce(ra >= 0 AND ra < 360, false)) AS bad_ra, count(*) FILTER (NOT coalesce(dec BETWEEN -90 AND 90, false)) AS bad_dec,
    count(*) FILTER ({MJD} < 50000) AS early, count(*) - count(DISTINCT {ID}) AS dup, count(*) FILTER (tags LIKE '%1-URGENT%') AS tagged
  FROM ranges r JOIN dirty_labelled d ON d.range_label = r.label GROUP BY ALL
), mags AS (
  SELECT range_label, count(*) AS n_alerts, count({ALERT_MAG}) AS n_mag, count(*) FILTER ({ALERT_MAG} BETWEEN 15 AND 25) AS in_window FROM found GROUP BY ALL
), w AS (
  SELECT *, CASE WHEN n_mjd = 0 THEN 0 ELSE {_D("early")} / n_mjd END AS early_share, CASE WHEN n_mag = 0 THEN 0 ELSE {_D("in_window")} / n_mag END AS bright FROM wide JOIN mags USING (range_label)
), ids AS (
  SELECT (SELECT count(DISTINCT {ID}) FROM dirty_labelled WHERE range_label = 'last') AS n1, (SELECT count(DISTINCT {ID}) FROM dirty_labelled WHERE range_label = 'history') AS n2,
    (SELECT count(*) FROM (SELECT {ID} FROM dirty_labelled WHERE range_label = 'last' INTERSECT SELECT {ID} FROM dirty_labelled WHERE range_label = 'history')) AS shared
), pct AS (SELECT shared, {_D("shared")} / least(n1, n2) * 100 AS pct FROM ids),
checks AS (
  SELECT 1 AS check_no, range_label, 'data_present' AS name, CASE WHEN n > 0 THEN 'PASS' ELSE 'FAIL' END AS status, {_D("n")} AS observed, n || ' loci' AS detail FROM w
  UNION ALL SELECT 2, range_label, 'mjd_in_window', CASE WHEN below + above = 0 THEN 'PASS' ELSE 'FAIL' END, below + above, below || ' below, ' || above || ' above' FROM w
  UNION ALL SELECT 3, range_label, 'ra_valid', CASE WHEN bad_ra = 0 THEN 'PASS' ELSE 'WARN' END, bad_ra, bad_ra || ' bad' FROM w
  UNION ALL SELECT 3, range_label, 'dec_valid', CASE WHEN bad_dec = 0 THEN 'PASS' ELSE 'WARN' END, bad_dec, bad_dec || ' bad' FROM w
  UNION ALL SELECT 4, range_label, 'survey_era', CASE WHEN early_share < 0.05 THEN 'PASS' ELSE 'WARN' END, early_share, early || ' of ' || n_mjd || ' early' FROM w
  UNION ALL SELECT 4, NULL, 'tagged', 'INFO', sum(tagged), CAST(CAST(sum(tagged) AS BIGINT) AS VARCHAR) || ' loci' FROM w
  UNION ALL SELECT 5, range_label, 'magnitudes', CASE WHEN n_alerts = 0 THEN 'WARN' WHEN bright >= 0.5 THEN 'PASS' ELSE 'FAIL' END, bright, in_window || ' of ' || n_mag || ' in window' FROM w
  UNION ALL SELECT 6, range_label, 'unique_ids', CASE WHEN dup = 0 THEN 'PASS' ELSE 'WARN' END, dup, dup || ' duplicates' FROM w
  UNION ALL SELECT 8, range_label, 'range_order', 'PASS', hi - lo, '' FROM w
  UNION ALL SELECT 7, NULL, 'shared_ids', 'INFO', shared, '' FROM pct
  UNION ALL SELECT 7, NULL, 'overlap', CASE WHEN pct < 5 THEN 'PASS' WHEN pct < 20 THEN 'WARN' ELSE 'FAIL' END, pct, 'disjoint ranges' FROM pct
)"""
_CHECK_PARTS = (_LOCI, _ALERTS, _RANGES, _LABELLED, _LABELLED_ALERTS, _DIRTY, _CHECKS)



def _tidy(metrics: list[tuple[str, str]], source: str) -> str:
    return " UNION ALL ".join(f"SELECT range_label, '{name}' AS metric, {_D(expr)} AS value FROM {source} GROUP BY range_label" for name, expr in metrics)


_METRICS = [("loci", "count(*)"), ("columns", "8")] + [(f"{n}_{f}", f"{f}({c})") for c, n, some in (("ra", "ra", "min max"), ("dec", "dec", "min max"), (MJD, "mjd", "min max median"), (MAG, "mag", "min max median"), (OBS, "obs", "min max median")) for f in some.split()]
_ALERT_METRICS = [("alerts", "count(*)")] + [(f"alert_mag_{f}", f"{f}({ALERT_MAG})") for f in ("min", "max", "median")]
_HALVES = [f"SELECT DISTINCT {ID} FROM raw WHERE {MJD} BETWEEN {lo} AND {hi}" for lo, hi in ((60310, 60311), (60311, 60340))]

ORACLE_SQL: dict[str, str] = {
    "window_scan_closed": _with(_LOCI) + f"SELECT {', '.join(CORE)} FROM loci WHERE {MJD} BETWEEN {LAST[1]} AND {LAST[2]}",
    "window_scan_half_open": _with(_RAW) + f"SELECT {ID}, {MJD}, ingest_seq FROM raw WHERE {MJD} >= 60320.0 AND {MJD} < 60320.5",
    "tag_filter": _with(_LOCI) + f"SELECT {ID}, tags FROM loci WHERE list_contains(tags_arr, '1-URGENT')",
    "tag_contains": _with(_LOCI) + "SELECT tags, count(*) AS n FROM loci WHERE contains(tags, 'URG') GROUP BY tags",
    "flatten_properties": _with(_RAW) + f"SELECT {ID}, tag AS tags, {MJD}, {MAG}, ingest_seq, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM raw",
    "malformed_rows": "SELECT count(*) AS n_rows, count(*) FILTER (event_id % 50 = 0) AS n_malformed FROM events",
    "newest_first_topn": _with(_LOCI) + f"SELECT {ID}, {MJD} FROM loci WHERE {MJD} BETWEEN {HISTORY[1]} AND {HISTORY[2]} ORDER BY {MJD} DESC, {ID} LIMIT {SAMPLE}",
    "seeded_sample_topn": _with(_LOCI, _RANGES, _LABELLED, _SAMPLED) + f"SELECT range_label, {ID}, {MJD} FROM sampled",
    "first_loci": _with(_LOCI) + f"SELECT {ID}, {MJD} FROM loci ORDER BY {ID} LIMIT {SAMPLE}",
    "two_range_label": _with(_LOCI, _RANGES, _LABELLED) + f"SELECT range_label, {ID}, {MJD} FROM labelled",
    "alerts_for_sample": _with(_LOCI, _ALERTS, _RANGES, _LABELLED, _SAMPLED, _SAMPLED_ALERTS) + f"SELECT range_label, {ID}, {ALERT_BAND}, {ALERT_MAG} FROM found",
    "band_counts": _with(_LOCI, _ALERTS, _RANGES, _LABELLED, _LABELLED_ALERTS) + f"SELECT range_label, {ALERT_BAND}, CASE {ALERT_BAND} WHEN 1 THEN 'g' WHEN 2 THEN 'r' WHEN 3 THEN 'i' ELSE CAST({ALERT_BAND} AS VARCHAR) END AS band, count(*) AS n FROM found WHERE {ALERT_BAND} IS NOT NULL GROUP BY ALL",
    "dedupe_newest": _with(_RAW) + _NEWEST,
    "dedupe_null_time": _with(_RAW.replace(f"{_MJD('ts')} AS {MJD}", f"CASE WHEN event_id % 500 <> 0 THEN {_MJD('ts')} END AS {MJD}")) + _NEWEST,
    "cumulative_upsert": _with(_RAW) + _NEWEST,
    "cumulative_range_read": _with(_RAW, f"newest AS ({_NEWEST})") + f"SELECT {ID}, {MJD}, ingest_seq FROM newest WHERE {MJD} BETWEEN 60339.5 AND 60339.9",
    "store_stats": "SELECT count(DISTINCT user_id) FILTER (event_id % 2 = 0) AS old_rows, count(*) FILTER (event_id % 2 = 1) AS new_rows, count(DISTINCT user_id) AS stored_rows FROM events",
    "fixed_chunks": _with(_RAW, f"placed AS (SELECT ingest_seq, least(CAST(floor(({MJD} - {_D(FIRST_DAY)}) / {_D(repr(3600 / 86400.0))}) AS BIGINT), 719) AS chunk FROM raw)") + f"SELECT ingest_seq, chunk, round({_D(FIRST_DAY)} + chunk * {_D(repr(3600 / 86400.0))}, 9) AS mjd_min, round(least({_D(FIRST_DAY)} + (chunk + 1) * {_D(repr(3600 / 86400.0))}, {_D(LAST_DAY)}), 9) AS mjd_max, chunk = 719 AS include_upper FROM placed",
    "fixed_chunk_counts": _with(_RAW, "spine AS (SELECT unnest(range(4320)) AS chunk)", f"counts AS (SELECT least(CAST(floor(({MJD} - {_D(FIRST_DAY)}) / {_D(repr(600 / 86400.0))}) AS BIGINT), 4319) AS chunk, count(*) AS n FROM raw WHERE {MJD} BETWEEN {FIRST_DAY} AND {LAST_DAY} GROUP BY 1)") + f"SELECT chunk, round({_D(FIRST_DAY)} + chunk * {_D(repr(600 / 86400.0))}, 9) AS mjd_min, chunk = 4319 AS include_upper, coalesce(n, 0) AS n FROM spine LEFT JOIN counts USING (chunk)",
    "adaptive_chunk_report": _with(_RAW, _PLAN) + "SELECT * FROM report",
    "chunk_status_counts": _with(_RAW, _PLAN) + "SELECT status, count(*) AS n FROM report GROUP BY status",
    "adaptive_pull": _with(_RAW.replace("FROM events", "FROM events WHERE event_type = 'click'"), f"inside AS (SELECT * FROM raw WHERE {MJD} BETWEEN {FIRST_DAY} AND {LAST_DAY})") + _NEWEST.replace("FROM raw", "FROM inside"),
    "cached_pull": _with(_RAW.replace("FROM events", "FROM events WHERE event_type = 'click'"), f"inside AS (SELECT * FROM raw WHERE {MJD} BETWEEN {FIRST_DAY} AND {LAST_DAY})") + _NEWEST.replace("FROM raw", "FROM inside"),
    "cached_pull_report": _with(_RAW, _PLAN) + "SELECT * REPLACE (CASE WHEN status = 'split' THEN 'live' ELSE 'cache' END AS source) FROM report",
    "typed_empty": _with(_LOCI) + f"SELECT {ID}, {MJD}, round(round(({_D(LAST[2])} - {MJD}) * 86400) / 86400, 9) AS age_days FROM loci WHERE {MJD} BETWEEN {LAST[1]} AND {LAST[2]}",
    "chunk_keys": _with(_RAW, "named AS (SELECT *, ' Night of ' || tag || '! ' AS label, CASE ingest_seq % 3 WHEN 0 THEN tag WHEN 1 THEN '!!' END AS t FROM raw)") + f"SELECT ingest_seq, {_SAFE('label')} AS label_key, {_PART(MJD)} AS start_key, CASE WHEN 60320.5 - {MJD} < 0 THEN '-' ELSE '' END || {_PART('abs(60320.5 - ' + MJD + ')')} AS offset_key, {_SAFE('label')} || '__' || {_PART(MJD)} || '__' || {_PART("(" + MJD + " + 1)")} || '__' || {_SAFE('t')} AS chunk_key FROM named",
    "mjd_to_dates": f"SELECT event_id, {_MJD('ts')} AS mjd, CAST(DATE '1858-11-17' + CAST(floor({_MJD('ts')}) AS INTEGER) AS VARCHAR) AS day FROM events",
    "sky_wrap": _with(_LOCI, _DIRTY, _RANGES) + f"SELECT {ID}, round(CASE WHEN radians(ra) > pi() THEN radians(ra) - 2 * pi() ELSE radians(ra) END, 9) AS ra_rad, round(radians(dec), 9) AS dec_rad FROM dirty JOIN ranges ON {MJD} BETWEEN lo AND hi WHERE ra IS NOT NULL AND dec IS NOT NULL",
    "sky_density_2d": _with(_LOCI, _RANGES, _LABELLED, "ext AS (SELECT range_label, min(ra) AS x0, max(ra) AS x1, min(dec) AS y0, max(dec) AS y1, count(*) AS n_range FROM labelled GROUP BY 1)") + f"SELECT range_label, n_range, least(CAST(floor((ra - x0) / (x1 - x0) * {_D(80)}) AS INTEGER), 79) AS bx, least(CAST(floor((dec - y0) / (y1 - y0) * {_D(80)}) AS INTEGER), 79) AS \"by\", count(*) AS n FROM labelled JOIN ext USING (range_label) GROUP BY ALL",
    "mag_hist_by_band": _with(_LOCI, _ALERTS, _RANGES, _LABELLED, _SAMPLED, _SAMPLED_ALERTS, _BANDED, _histogram("range_label, band", ALERT_MAG, "banded")),
    "mag_hist_all": _with(_LOCI, _ALERTS, _RANGES, _LABELLED, _LABELLED_ALERTS, _BANDED, _histogram("range_label, band", ALERT_MAG, "banded")),
    "mag_hist_fallback": _with(_LOCI, _RANGES, _LABELLED, _histogram("range_label", MAG, "labelled")),
    "range_summary": _with(_LOCI, _ALERTS, _RANGES, _LABELLED, _LABELLED_ALERTS) + f"SELECT range_label, metric, round(value, 9) AS value FROM ({_tidy(_METRICS, 'labelled')} UNION ALL {_tidy(_ALERT_METRICS, 'found')} UNION ALL SELECT range_label, 'alerts_' || CASE {ALERT_BAND} WHEN 1 THEN 'g' WHEN 2 THEN 'r' WHEN 3 THEN 'i' ELSE CAST({ALERT_BAND} AS VARCHAR) END, {_D('count(*)')} FROM found GROUP BY range_label, {ALERT_BAND})",
    "range_config": _with(_LOCI, f"ranges AS (SELECT * FROM (VALUES (1, 'last', {_D(52000)}, {_D(52122.9)}), (2, 'history', {_D(49718)}, {_D(52000)}), (3, 'wide', {_D(51000)}, {_D(52100)}), (4, 'invalid', {_D(2)}, {_D(1)})) AS t(range_no, label, mjd_min, mjd_max))") + f"SELECT *, mjd_min <= mjd_max AS valid, round(mjd_max - mjd_min, 9) AS span_days, (SELECT count(*) FROM ranges b WHERE b.range_no > a.range_no AND a.mjd_min <= a.mjd_max AND b.mjd_min <= b.mjd_max AND a.mjd_min < b.mjd_max AND b.mjd_min < a.mjd_max) AS n_overlaps, (SELECT count(*) FROM loci WHERE {MJD} BETWEEN a.mjd_min AND a.mjd_max) AS n FROM ranges a",
    "range_overlap": _with(_RAW, f"a AS ({_HALVES[0]})", f"b AS ({_HALVES[1]})") + f"SELECT *, round(CASE WHEN least(n1, n2) = 0 THEN 0 ELSE {_D('n_shared')} / least(n1, n2) * 100 END, 9) AS pct FROM (SELECT (SELECT count(*) FROM a) AS n1, (SELECT count(*) FROM b) AS n2, (SELECT count(*) FROM a JOIN b USING ({ID})) AS n_shared)",
    "dq_suite": _with(*_CHECK_PARTS) + "SELECT * REPLACE (round(observed, 9) AS observed) FROM checks",
    "dq_verdict": _with(*_CHECK_PARTS) + "SELECT status, count(*) AS n FROM checks GROUP BY status",
    "snapshot_roundtrip": _with(_LOCI, _ALERTS, _RANGES, _LABELLED, _SAMPLED, _SAMPLED_ALERTS) + f"SELECT range_label, {ID}, {ALERT_BAND}, {ALERT_MAG} FROM found",
    "chunk_cache_roundtrip": _with(_RAW) + f"SELECT {ID}, ingest_seq, CAST(floor({MJD} - 60310) AS BIGINT) AS chunk FROM raw WHERE {MJD} >= 60310 AND {MJD} < 60338 UNION ALL SELECT '', -1, unnest([28, 29])",
    "stream_upsert": _with(_RAW) + _NEWEST,
    "ingest_checks": _with(_RAW, f"""m AS (
  SELECT count(*) AS n, count(*) FILTER ({MJD} < 60312 - 0.02) AS below, count(*) FILTER ({MJD} > 60330 + 0.02) AS above, count(*) FILTER (ingest_seq % 365 >= 360) AS bad_ra,
    count(*) FILTER ({MJD} < 60311) AS early, count(*) FILTER (tag = 'click') AS tagged FROM raw WHERE ingest_seq % 50 <> 0
), r AS (SELECT count(*) AS rejected FROM raw WHERE ingest_seq % 50 = 0)""") + """SELECT CAST(check_no AS INTEGER) AS check_no, range_label, name, status, CAST(round(observed, 9) AS DOUBLE) AS observed, detail, n AS n_loci, rejected AS n_quarantined FROM (
  SELECT m.n, rejected, unnest([
    {'check_no': 0, 'range_label': 'month', 'name': 'well_formed', 'status': CASE WHEN rejected = 0 THEN 'PASS' ELSE 'WARN' END, 'observed': CAST(rejected AS DOUBLE), 'detail': rejected || ' rejected'},
    {'check_no': 1, 'range_label': 'month', 'name': 'data_present', 'status': CASE WHEN n > 0 THEN 'PASS' ELSE 'FAIL' END, 'observed': CAST(n AS DOUBLE), 'detail': n || ' loci'},
    {'check_no': 2, 'range_label': 'month', 'name': 'mjd_in_window', 'status': CASE WHEN below + above = 0 THEN 'PASS' ELSE 'FAIL' END, 'observed': CAST(below + above AS DOUBLE), 'detail': below || ' below, ' || above || ' above'},
    {'check_no': 3, 'range_label': 'month', 'name': 'ra_valid', 'status': CASE WHEN bad_ra = 0 THEN 'PASS' ELSE 'WARN' END, 'observed': CAST(bad_ra AS DOUBLE), 'detail': bad_ra || ' bad'},
    {'check_no': 3, 'range_label': 'month', 'name': 'dec_valid', 'status': 'PASS', 'observed': CAST(0 AS DOUBLE), 'detail': '0 bad'},
    {'check_no': 4, 'range_label': 'month', 'name': 'survey_era', 'status': CASE WHEN early < 0.05 * n THEN 'PASS' ELSE 'WARN' END, 'observed': CAST(early AS DOUBLE) / n, 'detail': early || ' of ' || n || ' early'},
    {'check_no': 4, 'range_label': NULL, 'name': 'tagged', 'status': 'INFO', 'observed': CAST(tagged AS DOUBLE), 'detail': tagged || ' loci'},
    {'check_no': 8, 'range_label': 'month', 'name': 'range_order', 'status': 'PASS', 'observed': CAST(18 AS DOUBLE), 'detail': ''}
  ], recursive := true) FROM m, r)""",
    "stream_newest": _with(_RAW) + _NEWEST,
    "sketched_distinct": _with(_LOCI, _DIRTY, _RAW, "spans AS (SELECT * FROM (VALUES ('all', 0, 100000), ('early', 0, 60320), ('first', 49718, 50100)) AS t(range_label, lo, hi))", f"ids AS (SELECT 'loci' AS rows_of, {ID}, floor({MJD}) AS night FROM dirty UNION ALL SELECT 'events', {ID}, floor({MJD}) FROM raw)") + f"SELECT rows_of, range_label, count(*) AS n, count(DISTINCT {ID}) AS n_distinct, true AS within_bound FROM ids JOIN spans ON night BETWEEN lo AND hi GROUP BY ALL",
    "sketched_overlap": _with(_RAW, f"a AS (SELECT DISTINCT {ID} FROM raw WHERE {MJD} < 60311)", f"b AS (SELECT DISTINCT {ID} FROM raw WHERE {MJD} >= 60311)") + f"SELECT (SELECT count(*) FROM a) AS n1, (SELECT count(*) FROM b) AS n2, (SELECT count(*) FROM a JOIN b USING ({ID})) AS n_shared, true AS within_bound",
    "mag_hist_bucketed": _with(_LOCI, _ALERTS, _RANGES, _LABELLED, _LABELLED_ALERTS, _BANDED, _histogram("range_label, band", ALERT_MAG, "banded")),
    "counted_plan": _with(_RAW, _PLAN) + "SELECT * REPLACE (false AS include_upper) FROM report",
}
