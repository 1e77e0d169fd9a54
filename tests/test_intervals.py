"""Interval joins against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import intervals

WIDE = 2**40


def ranges(rng, n, reach):
    out = []
    for k in range(n):
        lo = rng.choice([rng.randint(-60, 60), rng.randint(-(10**6), 10**6), 2 ** rng.randint(0, 20)])
        out.append((k, rng.choice("ab"), lo, lo + rng.choice([0, 1, rng.randint(0, reach), 2 ** rng.randint(0, 20)])))
    return out + [(n, "a", -WIDE, WIDE), (n + 1, "b", 0, 0), (n + 2, None, 5, None), (n + 3, "a", None, 5), (n + 4, "b", 9, 3), (0, "a", 1, 1)]


MATCH = {
    "overlaps": lambda a, b: a[2] <= b[3] and b[2] <= a[3],
    "contains": lambda a, b: a[2] <= b[2] and a[3] >= b[3],
    "within": lambda a, b: b[2] <= a[2] and b[3] >= a[3],
}
MATCH["nested"] = lambda a, b: MATCH["contains"](a, b) or MATCH["within"](a, b)


@pytest.mark.parametrize("kind", sorted(MATCH))
def test_every_pair_once(spark, kind):
    rng = random.Random(kind)
    one, other = ranges(rng, 150, 300), ranges(rng, 120, 5000)
    left, right = (spark.createDataFrame(rows, "id int, k string, lo long, hi long") for rows in (one, other))
    bounds = (F.col("lo"), F.col("hi"))
    whole = [r for r in one if None not in r[2:] and r[2] <= r[3]], [r for r in other if None not in r[2:] and r[2] <= r[3]]
    want = sorted((a[0], a[2], b[0], b[2]) for a in whole[0] for b in whole[1] if MATCH[kind](a, b))
    got = intervals.interval_join(left, right, bounds, bounds, kind).select("left.id", "left.lo", F.col("right.id").alias("r"), F.col("right.lo").alias("s"))
    assert sorted(map(tuple, got.collect())) == want
    keyed = intervals.interval_join(left, right, bounds, bounds, kind, on=[(F.col("k"), F.col("k"))])
    same = sorted((a[0], b[0]) for a in whole[0] for b in whole[1] if MATCH[kind](a, b) and a[1] == b[1])
    assert sorted(map(tuple, keyed.select("left.id", F.col("right.id").alias("r")).collect())) == same


def test_equal_bins_and_no_loop_over_pairs(spark, plan_of):
    left = spark.range(1000).select("id", (F.col("id") * 10).alias("lo"), (F.col("id") * 10 + 5).alias("hi"))
    bounds = (F.col("lo"), F.col("hi"))
    plan = plan_of(intervals.interval_join(left, left.withColumn("x", F.lit(1)), bounds, bounds))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_wide_range_is_cut_and_narrow_ones_are_not_copied_for_it(spark):
    """One range over all of 100,000 narrow ones: at most nine bins for it, at most two more rows for each of them."""
    narrow = spark.range(100_000).select((F.col("id") * 100).alias("lo"), (F.col("id") * 100 + 3).alias("hi"))
    wide = spark.createDataFrame([(0, 10_000_000)], "lo long, hi long")
    placed = intervals._placed(wide, F.col("lo"), F.col("hi"))
    assert 2 <= intervals._bins(placed, F.col("_level")).count() <= 9
    bounds = (F.col("lo"), F.col("hi"))
    rows = intervals._placed(narrow, *bounds)
    assert intervals._bins(rows.withColumn("_up", F.lit(intervals._levels(placed)[0])), F.col("_up")).count() <= 2 * 100_000
    assert intervals.interval_join(narrow, wide, bounds, bounds).count() == 100_000
    assert intervals.interval_join(narrow, wide.limit(0), bounds, bounds).count() == 0
