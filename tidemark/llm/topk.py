"""Exact top-k search by inner product: Fagin's threshold algorithm, block against block.

Vectors are dealt to blocks by a hash of their id.  A block of candidates is kept as one sorted list per
dimension.  A query walks its lists from their best end at equal depth.  What it meets first is scored in
full, once, and the sum of the values at the current depth bounds all it has not met.  It stops when that bound
is below its k-th score, or when it has met every candidate.  All queries walk a first block; the k-th score
each found there is carried into the others, where it ends walks early, before the first step if it can.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import dealt, workers_import
from tidemark.session import keep

#: Rows of a block of candidates, and of a block of queries.
BLOCK_ROWS, QUERY_ROWS = 2_048, 512
SCALE = 256
MOST_SCORE = 10**38 - 1
#: Depth of the first step; each later one goes twice as deep.
FIRST_DEPTH = 4


def whole_numbers(vector: Column) -> Column:
    """``floor(256 * x)`` of each component as a double; null for a vector that takes no part."""
    # from 2^52 on a double has no fraction, and a long would not hold it
    scaled = lambda v: v.cast("double") * SCALE
    x = F.transform(vector, lambda v: F.when(F.abs(scaled(v)) < 1 << 52, F.floor(scaled(v)).cast("double")).otherwise(scaled(v)))
    broken = F.exists(vector, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    return F.when(vector.isNotNull() & ~broken, x)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= cut)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def threshold_search(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int, floors: list | None = None):
    """``(query row, ids, scores, depth, met)`` of the best ``k`` of ``v`` for each row of ``q``, its own id left out.

    ``floors`` has a score per query that ``k`` others are known to reach, or None; what is below it is left out.
    ``depth`` is where the walk ended in its lists, ``met`` the number of candidates it scored.
    """
    n, width = v.shape
    high = int(np.abs(v).max(initial=0)) * int(np.abs(q).max(initial=0)) * max(1, width)
    if high >= 1 << 53:
        v, q = (np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (v, q))
    order = np.argsort(v.astype(float), axis=0, kind="stable")  # ascending: the worst end for positive weights
    lists = np.take_along_axis(v, order, axis=0)
    up = q > 0
    rising, falling = np.where(up, q, 0), np.where(up, 0, q)
    unmet = ids[None, :] != q_ids[:, None]
    tops = [(ids[:0], v[:0].sum(axis=1))] * len(q)
    met, left, depth = np.zeros(len(q), int), range(len(q)), 0
    while len(left):
        # what each list has at this depth, from the end its weight prefers
        bound = rising @ lists[n - max(1, depth)] + falling @ lists[max(1, depth) - 1]
        on = []
        for i in left:
            found, scores = tops[i]
            floor = floors[i] if floors else None
            if len(found) == k and (floor is None or scores[-1] > floor):
                floor = scores[-1]
            if (floor is None or bound[i] >= floor) and unmet[i].any():
                on.append(i)
                continue
            good = slice(None) if not floors or floors[i] is None else scores >= floors[i]
            yield i, found[good], scores[good], depth, met[i]
        left, step = on, min(n, max(FIRST_DEPTH, 2 * depth))
        for i in left:
            new = np.zeros(n, bool)
            new[order[n - step:n - depth, up[i]]] = True
            new[order[depth:step, ~up[i]]] = True
            # vectors of no dimension have no lists
            new = np.flatnonzero(new & unmet[i] if width else unmet[i])
            unmet[i, new] = False
            met[i] += len(new)
            found, scores = np.concatenate([tops[i][0], ids[new]]), np.concatenate([tops[i][1], v[new] @ q[i]])
            best = _best(scores, found, k)
            tops[i] = found[best], scores[best]
        depth = step


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    column = table[name].combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _search(k: int):
    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        rows: tuple[list, list, list] = ([], [], [])
        if len(candidates) and len(queries):
            ids, q_ids = candidates["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
            # a floor at the lowest score that fits may stand for a lower one
            floors = [int(s) if s is not None and s > -MOST_SCORE else None for s in queries["floor"].to_pylist()]
            for i, found, scores, *_ in threshold_search(q_ids, _matrix(queries, "v"), ids, _matrix(candidates, "v"), k, floors):
                rows[0].extend([q_ids[i]] * len(found))
                rows[1].extend(found.tolist())
                rows[2].extend(Decimal(max(-MOST_SCORE, min(MOST_SCORE, int(s)))) for s in scores)
        kinds = (pa.int64(), pa.int64(), pa.decimal128(38, 0))
        return pa.table({c: pa.array(r, k) for c, r, k in zip(("query_id", "vec_id", "score"), rows, kinds)})

    return run


def top_k(
    vectors: DataFrame, queries: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding",
    block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest integer inner products of each query row.

    ``queries`` says which rows ask; all rows but a query's own answer.  Ties go to the smaller id.  Rows with a
    null id, a null vector or one with a null or non-finite component take no part.  Vectors meet only
    vectors of their own length.  An id is one vector: of rows that repeat it the smallest vector
    counts.  Scores are exact ``decimal(38,0)``, held at the ends of 38 digits.  Other columns are not read.
    """
    workers_import(vectors.sparkSession)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), whole_numbers(F.col(vector)).alias("v"), queries.alias("asks"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"), F.max("asks").alias("asks"))
    rows = keep(rows.withColumn("width", F.size("v")), "vectors")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("asks").cast("long")), F.lit(0)).alias("asking")).first()
    blocks, parts = dealt(size["n"], block_rows), dealt(size["asking"], query_rows)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    candidates = rows.select("width", block(blocks, 1).alias("block"), every(parts).alias("part"), "vec_id", "v")
    # named anew, as both sides come from one table
    asking = rows.filter("asks").select(block(parts, 2).alias("part"), *[F.col(c).alias(c) for c in ("width", "vec_id", "v")])
    key = ("width", "block", "part")

    def search(some: DataFrame, asked: DataFrame) -> DataFrame:
        pairs = some.groupBy(*key).cogroup(asked.groupBy(*key))
        return pairs.applyInArrow(_search(k), "query_id long, vec_id long, score decimal(38,0)")

    unknown = F.lit(None).cast("decimal(38,0)").alias("floor")
    found = search(candidates.filter("block = 0"), asking.select("*", F.lit(0).alias("block"), unknown))
    if blocks > 1:
        found = keep(found, "first-block")
        floors = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
        others = F.explode(F.sequence(F.lit(1), F.lit(blocks - 1))).alias("block")
        asked = asking.join(floors, "vec_id", "left").select("*", others)
        found = found.unionByName(search(candidates.filter("block > 0"), asked))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
