"""Time chunks: spines, counts and the adaptive plan.

Reading a table has no row cap, so splitting never changes which rows are
read. The plan balances work: backfill units, file sizes, a density report.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.mjd import SECONDS_PER_DAY, days_to_seconds
from ..functions.text import pull_key, safe_part
from ..schema import MJD, empty
from ..sources.chunk_cache import BOUNDS, PARTS, ChunkCache, Known
from ..sources.counts import DEPTH
from ..sources.storage import written
from .dedupe import newest_per_locus
from .ranges import window_scan


def _spine_size(lo: float, hi: float, width: float) -> int:
    if not width > 0:
        raise ValueError("a chunk's width must be positive")
    return max(1, math.ceil((hi - lo) / width))


def _edges(i: Column, lo: float, hi: float, width: float) -> tuple[Column, Column]:
    start = F.lit(lo) + i * F.lit(width)
    return start, F.least(F.lit(lo) + (i + 1) * F.lit(width), F.lit(hi))


def chunk_spine(spark: SparkSession, lo: float, hi: float, width_days: float) -> DataFrame:
    """Chunk, mjd_min, mjd_max, include_upper; half-open but for the last, which ends at ``hi`` and is closed."""
    n = _spine_size(lo, hi, width_days)
    spine = spark.range(n).withColumnRenamed("id", "chunk") if lo <= hi else spark.range(0).withColumnRenamed("id", "chunk")
    start, end = _edges(F.col("chunk"), lo, hi, width_days)
    return spine.select("chunk", start.alias("mjd_min"), F.when(F.col("chunk") == n - 1, F.lit(hi)).otherwise(end).alias("mjd_max"), (F.col("chunk") == n - 1).alias("include_upper"))


def chunk_of(mjd: Column, lo: float, hi: float, width_days: float) -> Column:
    """A point's chunk by arithmetic, which makes the interval join an equi join."""
    return F.least(F.floor((mjd - F.lit(lo)) / F.lit(width_days)), F.lit(_spine_size(lo, hi, width_days) - 1)).cast("long")


def chunk_counts(loci: DataFrame, lo: float, hi: float, width_days: float) -> DataFrame:
    """Rows in each chunk, empty ones included."""
    counted = window_scan(loci, lo, hi).groupBy(chunk_of(F.col(MJD), lo, hi, width_days).alias("chunk")).agg(F.count("*").alias("n"))
    return chunk_spine(loci.sparkSession, lo, hi, width_days).join(counted, "chunk", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def depth_of(width: float, min_days: float) -> int:
    """Levels that splitting can reach from a chunk of this width, and one to spare."""
    return max(0, math.ceil(math.log2(width / (1.01 * min_days)))) + 1 if width > 0 else 0


def _placed(loci: DataFrame, lo: float, hi: float, width: float, depth: int) -> DataFrame:
    """Rows of the range with their root chunk ``i`` and the part of it (``leaf``, of 2**depth) they lie in."""
    i = chunk_of(F.col(MJD), lo, hi, width)
    start, end = _edges(F.col("i"), lo, hi, width)
    size = end - start
    leaves = float(1 << depth)
    leaf = F.when(size > 0, F.least(F.floor((F.col(MJD) - start) / size * F.lit(leaves)), F.lit(leaves - 1))).otherwise(F.lit(0)).cast("long")
    return window_scan(loci, lo, hi).withColumn("i", i).withColumn("leaf", leaf)


def _ancestors(leaves: DataFrame, depth: int) -> DataFrame:
    """The windows (i, d, k) that each leaf lies in, with the leaf's other columns."""
    levels = leaves.withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    return levels.withColumn("k", F.floor(F.col("leaf") / F.pow(F.lit(2.0), F.lit(depth) - F.col("d"))).cast("long"))


def _windows(units: DataFrame, label: str, lo: float, hi: float, plan: Plan, tag: str | None = None) -> DataFrame:
    """The attempted windows with i, d, k and cache keys.

    ``units`` are what the rows are counted by: i, d, k, n and ``held``, true for a cached
    window, which is taken as it is, and false for a leaf of counted rows. A window around
    a cached one counts as split, as it was when that one was cached.
    """
    spark, grid = units.sparkSession, plan.grid(lo, hi)
    levels = units.withColumnsRenamed({"d": "_d", "k": "_k"}).withColumn("d", F.explode(F.sequence(F.lit(0), F.col("_d"))))
    levels = levels.withColumn("k", F.floor(F.col("_k") / F.pow(F.lit(2.0), F.col("_d") - F.col("d"))).cast("long"))
    here = F.col("_d") == F.col("d")
    nodes = levels.groupBy("i", "d", "k").agg(F.sum("n").alias("n"), F.bool_or(F.col("held") & here).alias("held"), F.bool_or(F.col("held") & ~here).alias("above"))
    start, end = grid.root(F.col("i"))
    can_split = (end - start) / F.pow(F.lit(2.0), F.col("d")) > F.lit(1.01 * grid.min_days)
    full = F.col("n") >= grid.threshold
    splits = ~F.col("held") & (F.col("above") | (full & can_split))
    split = nodes.filter(splits)
    children = split.select("i", (F.col("d") + 1).alias("d"), F.explode(F.array(F.col("k") * 2, F.col("k") * 2 + 1)).alias("k"))
    roots = spark.range(grid.n_chunks if lo <= hi else 0).select(F.col("id").alias("i"), F.lit(0).alias("d"), F.lit(0).cast("long").alias("k"))
    attempted = roots.unionByName(children).join(nodes, ["i", "d", "k"], "left")
    no = F.lit(False)
    attempted = attempted.withColumns({"n": F.coalesce("n", F.lit(0).cast("long")), "held": F.coalesce("held", no), "above": F.coalesce("above", no)})
    return grid.placed(attempted).select(
        F.lit(label).alias("label"),
        "mjd_min",
        "mjd_max",
        days_to_seconds(F.col("size")).alias("width_seconds"),
        F.least("n", F.lit(grid.max_results).cast("long")).alias("n_loci"),
        F.when(splits, "split").when(full, "accepted_at_minimum_saturated").otherwise("accepted").alias("status"),
        F.when(F.col("held"), "cache").otherwise("live").alias("source"),
        "include_upper",
        F.lit(None).cast("string").alias("error"),
        "i", "d", "k", safe_part(F.lit(label)).alias("label_key"), safe_part(F.lit(tag).cast("string")).alias("tag_key"), "chunk_key",
    )


@dataclass(frozen=True)
class Plan:
    """The settings of an adaptive plan."""

    initial_days: float = 1.0
    min_seconds: float = 30.0
    max_results: int = 10_000
    split_threshold: int = 9_500

    def grid(self, lo: float, hi: float) -> Grid:
        min_days = self.min_seconds / SECONDS_PER_DAY
        width = max(float(self.initial_days), min_days)
        threshold = min(int(self.split_threshold), int(self.max_results))
        return Grid(lo, hi, width, _spine_size(lo, hi, width), depth_of(min(width, hi - lo), min_days), min_days, threshold, int(self.max_results))


@dataclass(frozen=True)
class Grid:
    """The windows that a plan over [lo, hi] can attempt: root ``i``, depth ``d`` below it, and ``k`` of the 2**d parts there."""

    lo: float
    hi: float
    width: float
    n_chunks: int
    depth: int
    min_days: float
    threshold: int
    max_results: int

    @property
    def leaves(self) -> int:
        return 1 << self.depth

    def root(self, i: Column) -> tuple[Column, Column]:
        return _edges(i, self.lo, self.hi, self.width)

    def placed(self, windows: DataFrame) -> DataFrame:
        """Windows (i, d, k) with their size, bounds (mjd_min, mjd_max, include_upper) and ``chunk_key``."""
        start, end = self.root(F.col("i"))
        parts = F.pow(F.lit(2.0), F.col("d"))
        sized = windows.withColumns({"_start": start, "size": (end - start) / parts})
        upper = (F.col("i") == self.n_chunks - 1) & (F.col("k") == parts.cast("long") - 1)
        bounded = sized.withColumns({"mjd_min": F.col("_start") + F.col("k") * F.col("size"), "mjd_max": F.col("_start") + (F.col("k") + 1) * F.col("size"), "include_upper": upper})
        return bounded.drop("_start").withColumn("chunk_key", pull_key(F.col("mjd_min"), F.col("mjd_max"), F.col("include_upper"), self.max_results, self.threshold))


def _counted(rows: DataFrame, lo: float, hi: float, grid: Grid) -> DataFrame:
    """Units of the rows: their numbers by leaf."""
    leaves = _placed(rows, lo, hi, grid.width, grid.depth).groupBy("i", "leaf").agg(F.count("*").alias("n"))
    return leaves.select("i", F.lit(grid.depth).alias("d"), F.col("leaf").alias("k"), "n", F.lit(False).alias("held"))


REPORT = ["label", "mjd_min", "mjd_max", "width_seconds", "n_loci", "status", "source", "include_upper", "error"]


def adaptive_report(loci: DataFrame, label: str, lo: float, hi: float, initial_days: float = 1.0, min_seconds: float = 30.0, max_results: int = 10_000, split_threshold: int = 9_500) -> DataFrame:
    """One row for each window that halving attempts, with its status.

    Counts and widths shrink down a dyadic tree, so a window is attempted just
    if it is a root or its parent splits. The rows are counted once, at the
    finest level; all coarser counts are sums of that small result.
    """
    plan = Plan(initial_days, min_seconds, max_results, split_threshold)
    return _windows(_counted(loci, lo, hi, plan.grid(lo, hi)), label, lo, hi, plan).select(REPORT)


def counted_report(counts: DataFrame, label: str, first_day: int, last_day: int, min_seconds: float = 30.0, max_results: int = 10_000, split_threshold: int = 9_500) -> DataFrame:
    """C3 from kept counts (day, piece of 2**DEPTH, n): the plan of the days [first_day, last_day), in roots of one day, without a row being read.

    The last window ends before ``last_day``, as counts know no single instants, so it
    is open where ``adaptive_report`` has it closed.
    """
    plan = Plan(1.0, min_seconds, max_results, split_threshold)
    grid = plan.grid(float(first_day), float(last_day))
    if grid.depth > DEPTH:
        raise ValueError(f"counts by 1 / {1 << DEPTH} of a day know no windows of {min_seconds} s")
    inside = counts.filter((F.col("day") >= first_day) & (F.col("day") < last_day))
    leaf = F.floor(F.col("piece") / (1 << (DEPTH - grid.depth))).cast("long")
    units = inside.groupBy((F.col("day") - first_day).alias("i"), leaf.alias("k")).agg(F.sum("n").alias("n"))
    units = units.select("i", F.lit(grid.depth).alias("d"), "k", "n", F.lit(False).alias("held"))
    return _windows(units, label, grid.lo, grid.hi, plan).withColumn("include_upper", F.lit(False)).select(REPORT)


def ordered_report(report: DataFrame) -> DataFrame:
    """The report in the order of depth-first splitting."""
    return report.orderBy("mjd_min", F.desc("width_seconds"))


def status_counts(report: DataFrame) -> DataFrame:
    """G15."""
    return report.groupBy("status").agg(F.count("*").alias("n"))


def _held(known: Known | None, grid: Grid, spark: SparkSession) -> DataFrame:
    """Units of the cached windows of this plan that lie in no other cached one, with their leaves [start, stop)."""
    if known is None:
        return empty(spark, f"i long, d int, k long, n long, held boolean, start long, stop long, {', '.join(f'{c} string' for c in PARTS)}")
    notes = known.chunks.filter(F.col("mjd_min").isNotNull())
    middle = (F.col("mjd_min") + F.col("mjd_max")) / 2
    placed = notes.filter(middle.between(grid.lo, grid.hi)).withColumn("i", chunk_of(middle, grid.lo, grid.hi, grid.width))
    start, end = grid.root(F.col("i"))
    parts = F.when(F.col("mjd_max") > F.col("mjd_min"), (end - start) / (F.col("mjd_max") - F.col("mjd_min"))).otherwise(F.lit(1.0))
    placed = placed.withColumn("d", F.round(F.log2(parts)).cast("int")).filter(F.col("d").between(0, grid.depth))
    share = F.when(end > start, (middle - start) / (end - start)).otherwise(F.lit(0.0))
    placed = placed.withColumn("k", F.floor(share * F.pow(F.lit(2.0), F.col("d"))).cast("long"))
    placed = grid.placed(placed.drop(*BOUNDS).withColumnRenamed("chunk_key", "_key")).filter(F.col("chunk_key") == F.col("_key"))
    size = F.pow(F.lit(2.0), F.lit(grid.depth) - F.col("d")).cast("long")
    placed = placed.select("i", "d", "k", "n", F.lit(True).alias("held"), (F.col("k") * size).alias("start"), ((F.col("k") + 1) * size).alias("stop"), *PARTS)
    before = Window.partitionBy("i").orderBy("start", "d").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("_reach", F.coalesce(F.max("stop").over(before), F.lit(0).cast("long"))).filter("stop > _reach").drop("_reach")


#: Intervals that a source is filtered by.
MAX_GAPS = 64


def _gaps(held: DataFrame, grid: Grid, spark: SparkSession) -> list[tuple[float, float]]:
    """Intervals, at most MAX_GAPS, that hold all times that no cached window covers; none if the cache covers the range."""
    if grid.lo > grid.hi:
        return []
    before = F.lag("stop", 1, 0).over(Window.partitionBy("i").orderBy("start"))
    edges = held.withColumn("_before", before).withColumn("_gap", F.col("start") > F.col("_before"))
    ends = edges.groupBy("i").agg(F.min(F.when(F.col("_gap"), F.col("_before"))).alias("first"), F.max(F.when(F.col("_gap"), F.col("start"))).alias("last"), F.max("stop").alias("stop"))
    leaves = F.lit(grid.leaves).cast("long")
    roots = spark.range(grid.n_chunks).select(F.col("id").alias("i")).join(ends, "i", "left")
    short = F.coalesce("stop", F.lit(0)) < leaves
    open_ = roots.filter(short | F.col("first").isNotNull())
    start, end = grid.root(F.col("i"))
    at = lambda leaf: start + leaf / leaves * (end - start)
    low = at(F.coalesce("first", "stop", F.lit(0)))
    high = F.when(short, end).otherwise(at(F.col("last")))
    group = F.floor(F.col("i") * MAX_GAPS / grid.n_chunks)
    found = sorted((r.low, r.high) for r in open_.groupBy(group.alias("g")).agg(F.min(low).alias("low"), F.max(high).alias("high")).collect())
    merged: list[tuple[float, float]] = []
    for a, b in found:
        if merged and a <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(b, merged[-1][1])
        else:
            merged.append((a, b))
    return merged


def adaptive_pull(
    loci: DataFrame, label: str, lo: float, hi: float, tie: list[str], tag: str | None = None, cache: ChunkCache | None = None, use_cache: bool = True,
    initial_days: float = 1.0, min_seconds: float = 30.0, max_results: int = 10_000, split_threshold: int = 9_500,
) -> tuple[DataFrame, DataFrame]:
    """The newest row of each locus in the range, and the plan's report.

    With a ``cache``, accepted windows that it holds in full come from there, and
    the others are read and put into it (``source`` in the report tells which; a split
    window gives no rows and is shown as live). The cache is asked first: the source is
    read for the times alone that no cached window covers, so a range that is cached in
    full is planned and answered without it. ``use_cache=False`` neither reads nor writes it.
    """
    plan = Plan(initial_days, min_seconds, max_results, split_threshold)
    rows, grid = window_scan(loci, lo, hi, tag), plan.grid(lo, hi)
    if cache is None or not use_cache:
        return newest_per_locus(rows, tie), _windows(_counted(rows, lo, hi, grid), label, lo, hi, plan).select(REPORT)
    spark = loci.sparkSession
    label_key, tag_key = spark.range(1).select(safe_part(F.lit(label)), safe_part(F.lit(tag).cast("string"))).first()
    known = cache.known(label_key, tag_key)
    held = _held(known, grid, spark)
    held = held if known is None else written(held, "chunks-held")  # a row for each chunk
    gaps = _gaps(held, grid, spark)
    if known is not None and not gaps:
        return newest_per_locus(known.read(held).drop(*PARTS), tie), _windows(held.drop("start", "stop", *PARTS), label, lo, hi, plan, tag).select(REPORT)
    near = reduce(Column.__or__, [F.col(MJD).between(a - 1e-6, b + 1e-6) for a, b in gaps], F.lit(False))
    open_rows = _placed(rows.filter(near), lo, hi, grid.width, grid.depth)
    leaves = written(open_rows.groupBy("i", "leaf").agg(F.count("*").alias("n")), "chunk-leaves")
    covered = _ancestors(leaves.select("i", "leaf"), grid.depth).join(held.select("i", "d", "k"), ["i", "d", "k"], "left_semi").select("i", "leaf")
    fresh = leaves.join(covered, ["i", "leaf"], "left_anti").select("i", F.lit(grid.depth).alias("d"), F.col("leaf").alias("k"), "n", F.lit(False).alias("held"))
    windows = written(_windows(held.drop("start", "stop", *PARTS).unionByName(fresh), label, lo, hi, plan, tag), "chunk-plan")  # decided before the cache changes
    accepted = windows.filter(F.col("status") != "split")
    missed = accepted.filter(F.col("source") == "live")
    place = _ancestors(leaves.select("i", "leaf"), grid.depth).join(missed.select("i", "d", "k", *PARTS), ["i", "d", "k"]).select("i", "leaf", *PARTS)
    cache.write(open_rows.join(place, ["i", "leaf"]).drop("i", "leaf"), missed)
    pulled = cache.known(label_key, tag_key).read(accepted).drop(*PARTS)
    return newest_per_locus(pulled, tie), windows.select(REPORT)
