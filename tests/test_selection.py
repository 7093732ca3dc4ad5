"""Exact medians by selection, against sorting."""

import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from skyspark.operators import summary
from skyspark.operators.selection import bracket, exact_medians
from skyspark.schema import ALERT_BAND, ALERT_MAG, ID, MAG, MJD, OBS


def medians(spark, tmp_path, groups, **options):
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    random.Random(1).shuffle(rows)
    spark.createDataFrame(rows, "g string, value double").repartition(4).write.parquet(f"{tmp_path}/values")
    values = spark.read.parquet(f"{tmp_path}/values")
    brackets = values.groupBy("g").agg(F.count("value").alias("n"), bracket(F.col("value"), options.get("accuracy", 10_000)).alias("ends"))
    return {r.g: r.median for r in exact_medians(values, brackets, ["g"], **options).collect()}


@pytest.mark.parametrize("options", [{}, {"accuracy": 100, "ranked": 5}, {"accuracy": 20, "ranked": 0}])
def test_equals_the_sorted_middle(spark, tmp_path, options):
    rng = random.Random(7)
    groups = {
        "one": [3.5],
        "two": [1.0, 2.0],
        "odd": [rng.random() for _ in range(5001)],
        "even": [rng.gauss(0, 1e6) for _ in range(4000)],
        "equal": [7.0] * 3000,
        "halves": [1.0] * 2000 + [2.0] * 2000,
        "nearly": [1.0] * 2000 + [1.5] + [2.0] * 1999,
        "few": [rng.choice([1.0, 2.0, 3.0]) for _ in range(3000)],
        "sorted": list(range(6000)),
        "spikes": [0.0] * 2000 + [rng.random() for _ in range(900)] + [1.0] * 2000,
        "tiny": [5e-324, 1e-323],
    }
    assert medians(spark, tmp_path, groups, **options) == {g: median(map(float, v)) for g, v in groups.items()}


def test_summary_has_no_median_aggregate_and_one_pass_for_each_input(spark, capsys):
    rng = random.Random(3)
    loci = spark.createDataFrame([(rng.choice("ab"), f"l{i}", rng.random(), -rng.random(), 100 * rng.random(), rng.choice([None, rng.random()]), rng.randint(0, 9)) for i in range(900)], f"range_label string, {ID} string, ra double, dec double, {MJD} double, {MAG} double, {OBS} int")
    alerts = spark.createDataFrame([(rng.choice("ab"), f"l{i}", rng.choice([1, 2, 3, 9, None]), rng.choice([None, 20 * rng.random()])) for i in range(900)], f"range_label string, {ID} string, {ALERT_BAND} int, {ALERT_MAG} double")
    found = summary.range_summary(loci, alerts)
    got = {(r.range_label, r.metric): r.value for r in found.collect()}
    for label in "ab":
        mine = [r for r in loci.collect() if r.range_label == label]
        theirs = [r for r in alerts.collect() if r.range_label == label]
        for name, column in (("mjd", MJD), ("mag", MAG), ("obs", OBS)):
            values = [r[column] for r in mine if r[column] is not None]
            assert (got[label, f"{name}_min"], got[label, f"{name}_max"], got[label, f"{name}_median"]) == (min(values), max(values), median(values))
        values = [r[ALERT_MAG] for r in theirs if r[ALERT_MAG] is not None]
        assert got[label, "alert_mag_median"] == median(values) and got[label, "alerts"] == len(theirs) and got[label, "loci"] == len(mine)
        assert got[label, "alerts_g"] == sum(r[ALERT_BAND] == 1 for r in theirs) and got[label, "alerts_9"] == sum(r[ALERT_BAND] == 9 for r in theirs)
        assert got[label, "columns"] == 6.0
    found.explain("formatted")
    assert "median(" not in capsys.readouterr().out
    rough = {(r.range_label, r.metric): r.value for r in summary.range_summary(loci, alerts, approximate=True).collect()}
    assert rough.keys() == got.keys() and all(abs(rough[k] - got[k]) < 2 for k in got if k[1].endswith("_median"))


def test_summary_of_nothing(spark):
    loci = spark.createDataFrame([], f"range_label string, {ID} string, ra double, dec double, {MJD} double, {MAG} double, {OBS} int")
    alerts = spark.createDataFrame([], f"range_label string, {ID} string, {ALERT_BAND} int, {ALERT_MAG} double")
    assert summary.range_summary(loci, alerts).count() == 0
    one = spark.createDataFrame([("r", "x", None, None, None, None, None)], loci.schema)
    assert {(r.metric, r.value) for r in summary.range_summary(one, alerts).collect()} == {("loci", 1.0), ("columns", 6.0)}
