"""Order-independent sums against exact arithmetic."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidemark.functions import sums


def totals(spark, groups, partitions=3):
    rows = [(g, x) for g, xs in groups.items() for x in xs]
    random.Random(len(rows)).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, x double").repartition(partitions)
    binned = sums.with_limbs(df, "x").groupBy("g", "bin").agg(*(F.expr(sql).alias(n) for n, sql in sums.BIN_SUMS.items()))
    parts = binned.groupBy("g").agg(F.expr(sums.COLLECTED).alias("parts"))
    return {r.g: r.total for r in parts.select("g", F.expr(sums.total_of("parts")).alias("total")).collect()}


def exact(xs):
    xs = [x for x in xs if x is not None]
    if not xs:
        return None
    if any(math.isnan(x) for x in xs) or {math.inf, -math.inf} <= set(xs):
        return math.nan
    if any(math.isinf(x) for x in xs):
        return sum(x for x in xs if math.isinf(x))
    total = sum((Fraction(x) for x in xs), Fraction(0))
    return total.numerator / total.denominator


def assert_same(found, want):
    assert found.keys() == want.keys()
    for g, x in want.items():
        assert found[g] == x or (x != x and found[g] != found[g]), (g, found[g], x)


def test_totals_are_the_nearest_double(spark):
    pick = random.Random(1)
    groups = {
        "none": [None, None], "zero": [0.0, -0.0], "one": [0.1], "three": [0.1, 0.2, 0.3], "cancel": [1e16, 1.0, -1e16],
        "gone": [5.5, -5.5], "minus": [-1.0, 2.0**-30], "tiny": [5e-324, 5e-324], "huge": [1.7e308, -1.7e308, 1e-300],
        "top": [8.9e307, 8.9e307], "nan": [1.0, math.nan], "up": [math.inf, 1.0], "down": [-math.inf, None], "both": [math.inf, -math.inf],
        "carry": [2.0**53, 1.0, 1.0, 1.0], "even": [2.0**53, 1.0], "odd": [2.0**53 + 2, 1.0], "just": [2.0**53, 1.0, 5e-324],
        "negative": [-(2.0**53), -1.0, -5e-324], "borrow": [2.0**72, -5e-324],
    }
    for n in range(60):
        size = pick.choice([3, 30, 300])
        low, high = sorted(pick.choices(range(-300, 300), k=2))
        groups[f"wide{n}"] = [pick.choice([1, -1]) * pick.random() * 10.0 ** pick.randint(low, high) for _ in range(pick.randint(1, size))]
        groups[f"money{n}"] = [round(pick.uniform(0.01, 500000), 2) for _ in range(size)]
    for x in (1.0, 3.0, 1e-5, 2.0**40 - 1):
        for e in range(-60, 60, 7):
            groups[f"power{x}{e}"] = [x * 2.0**e, math.nextafter(2.0**e, 0), -(2.0**e)]
    assert_same(totals(spark, groups), {g: exact(xs) for g, xs in groups.items()})


@pytest.mark.parametrize("partitions", [1, 2, 7])
def test_totals_do_not_depend_on_the_tasks(spark, partitions):
    pick = random.Random(2)
    groups = {str(n): [pick.uniform(-1e6, 1e6) for _ in range(500)] for n in range(5)}
    assert totals(spark, groups, partitions) == {g: exact(xs) for g, xs in groups.items()}
