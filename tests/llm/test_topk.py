"""Threshold search against scoring everything."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import rows_of
from tidemark.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, v string, asks string"


def brute(rows, every, k):
    best = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            best[i] = min(best.get(i, [math.inf]), [math.floor(256 * x) for x in v])
    out = []
    for q in best:
        if q % every == 0:
            scored = [(-sum(a * b for a, b in zip(best[q], v)), i) for i, v in best.items() if i != q and len(v) == len(best[q])]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def found(spark, rows, every=5, k=5, **options):
    frame = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in topk.top_k(frame, F.col("vec_id") % every == 0, k, **options).collect())


def vectors(seed, n, width, step=0.01):
    pick = random.Random(seed)
    return [(i, [round(pick.gauss(0, 1) / step) * step for _ in range(width)]) for i in range(n)]


def as_float(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


def test_few_dimensions_stop_early(spark):
    rows = as_float(vectors(1, 900, 2))
    assert found(spark, rows, every=50) == brute(rows, 50, 5)


def test_blocks(spark):
    rows = as_float(vectors(2, 300, 8))
    assert found(spark, rows, block_rows=40, query_rows=7) == brute(rows, 5, 5)


def test_ties_and_copies(spark):
    rows = as_float([(i, [0.5, -0.5]) for i in range(200)] + [(i, [0.0, 0.0]) for i in range(200, 260)] + [(i, [1.0, 1.0]) for i in range(260, 300)])
    assert found(spark, rows, every=20, block_rows=32) == brute(rows, 20, 5)


def test_what_takes_no_part(spark):
    inf, nan = math.inf, math.nan
    rows = as_float([(0, [1.0, 2.0]), (5, [1.0, None]), (10, None), (15, [nan, 1.0]), (20, [inf, 1.0]), (25, [-inf, 1.0]),
                     (None, [1.0, 1.0]), (30, [1.0]), (35, []), (40, []), (1, [3.0, 1.0]), (2, [0.0, 0.1]), (1, [3.0, 1.0])])
    assert found(spark, rows) == brute(rows, 5, 5)
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0])]) == []


def test_large_components_stay_exact(spark):
    rows = as_float([(i, [3e9 + 1000.0 * i, -2e9, 1e3 * i]) for i in range(30)])
    assert found(spark, rows, k=3) == brute(rows, 5, 3)


@pytest.mark.parametrize("width", [0, 1, 3, 16])
@pytest.mark.parametrize("high", [3, 10**10])
def test_walks_meet_each_candidate_once_and_stop_at_the_bound(width, high):
    pick = np.random.default_rng(width)
    v = pick.integers(-high, high, (400, width)).astype(float)
    ids, k = np.arange(400), 5
    for floor in (False, True):
        exact = [sorted((-sum(int(a) * int(b) for a, b in zip(v[i], w)), j) for j, w in enumerate(v) if j != i)[:k] for i in range(20)]
        floors = [-e[k - 1][0] for e in exact] if floor else None
        for i, found, scores, depth, met in topk.threshold_search(ids[:20], v[:20], ids, v, k, floors):
            if floor:  # the others may stop before they meet what only reaches the floor again, but lose nothing above it
                assert set(found.tolist()) >= {j for s, j in exact[i] if -s >= floors[i]}
            assert [(-int(s), int(j)) for s, j in zip(scores, found)] == exact[i]
            assert met <= 399 and met >= len(found) and depth <= 400
            if width == 1 and high > 3:
                assert met < 400 / 4


def test_a_floor_out_of_reach_ends_a_walk_before_its_first_step():
    v = np.ones((50, 4))
    (_, found, _, depth, met), = topk.threshold_search(np.array([99]), v[:1], np.arange(50), v, 5, [5])
    assert (len(found), depth, met) == (0, 0, 0)
