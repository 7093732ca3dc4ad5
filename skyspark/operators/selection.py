"""Exact medians by selection, without a group's values ever meeting in one task.

A sketch of each group gives two values with the middle between them. Counting the
values below and between them (a plain, map-side combined aggregate) tells at which place
among those between the middle lies. While too many are between, they are sketched in
turn; then the few that are left are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import written

#: 1 / ACCURACY is the largest error of a sketched rank, as a share of the rows.
ACCURACY = 10_000
#: Values of a group that are ranked in one task.
RANKED = 100_000


def bracket(value: Column, accuracy: int = ACCURACY) -> Column:
    """An aggregate: [low, high] around the middle values of a column, by a sketch whose error is within the distance taken; null without values."""
    reach = 2.0 / accuracy
    return F.percentile_approx(value.cast("double"), [0.5 - reach, 0.5 + reach], accuracy)


def exact_medians(values: DataFrame, brackets: DataFrame, keys: list[str], accuracy: int = ACCURACY, ranked: int = RANKED) -> DataFrame:
    """keys and ``median`` (the mean of the two middle values of an even number) of each group.

    ``values``: keys and ``value``, not null, in a written table, as it is read twice or
    more. ``brackets``: one row for each group with its size ``n`` and ``ends`` from
    ``bracket``; the groups are few (the caller's ranges and metrics), so it is broadcast.
    Groups without values have no row. NaN is not expected (it became NULL at the source).
    """
    # places, from 0, of the middle values among all values of the group
    sides = brackets.filter(F.col("n") > 0).select(
        *keys, F.col("ends")[0].alias("low"), F.col("ends")[1].alias("high"), F.expr("(n - 1) div 2").alias("first"), F.expr("n div 2").alias("second"), F.col("n").alias("size"), F.lit(0).cast("long").alias("passed")
    )
    inside, before = values, None
    while True:
        # how many lie below the bracket and in it; those passed over before lie below too
        placed = inside.join(F.broadcast(sides), keys)
        value, low, high = F.col("value"), F.col("low"), F.col("high")
        counts = [F.count_if(value < low).alias("below"), F.count_if(value.between(low, high)).alias("between"), F.count_if((value > low) & (value < high)).alias("within")]
        counted = placed.groupBy(*keys, "low", "high", "first", "second", "size", "passed").agg(*counts).withColumn("passed", F.col("passed") + F.col("below"))
        found = (F.col("passed") <= F.col("first")) & (F.col("second") < F.col("passed") + F.col("between"))
        sides = counted.withColumn("passed", F.when(found, F.col("passed")).otherwise(F.raise_error(F.lit("a sketch missed the middle")))).drop("below")
        sides = written(sides, "brackets")  # one row for each group
        inside = inside.join(F.broadcast(sides.select(*keys, "low", "high")), keys).filter(value.between(low, high)).drop("low", "high")
        most = sides.agg(F.max("within")).first()[0] or 0
        if most <= ranked or (before is not None and most > before // 2):  # what is left beyond that are equal values
            break
        before, sides = most, _narrower(inside, sides, keys, accuracy)
    # equal values are one row with their number, so ties at the ends take no room
    counted = inside.groupBy(*keys, "value").agg(F.count("*").alias("n")).join(F.broadcast(sides.select(*keys, "first", "second", "passed")), keys)
    order = Window.partitionBy(*keys).orderBy("value")
    ended = counted.withColumn("end", F.sum("n").over(order) + F.col("passed"))
    holds = lambda c: (F.col("end") - F.col("n") <= F.col(c)) & (F.col(c) < F.col("end"))
    middle = ended.filter(holds("first") | holds("second"))
    return middle.groupBy(*keys).agg(((F.min("value") + F.max("value")) / 2).alias("median"))


def _narrower(inside: DataFrame, sides: DataFrame, keys: list[str], accuracy: int) -> DataFrame:
    """New brackets from sketches of the values that are left, around the places wanted among them."""
    at = sides.select(*keys, "first", "second", "size", "passed", "between", F.col("low").alias("_low"), F.col("high").alias("_high"))
    # a sketch takes fixed shares, so it is asked for many and the two around the place are picked
    steps = 200
    shares = [i / steps for i in range(steps + 1)]
    sketched = inside.groupBy(*keys).agg(F.percentile_approx("value", shares, max(accuracy, 10 * steps)).alias("ends"))
    place = lambda c: (F.col(c) - F.col("passed")) / F.col("between") * steps
    lower = F.greatest(F.floor(place("first")) - 1, F.lit(0)).cast("int")
    upper = F.least(F.ceil(place("second")) + 1, F.lit(steps)).cast("int")
    joined = sketched.join(F.broadcast(at), keys)
    low = F.when(lower == 0, F.col("_low")).otherwise(F.col("ends")[lower])
    high = F.when(upper == steps, F.col("_high")).otherwise(F.col("ends")[upper])
    return joined.select(*keys, low.alias("low"), high.alias("high"), "first", "second", "size", "passed")
