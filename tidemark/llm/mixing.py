"""Mixing sources to target weights by entropy balancing.

Among all rates that take the target number of words from a source, the ones closest in entropy
to taking each document once are ``exp(dual * size)``, here at most ``most``.  The duals, one per
source, are the root of a monotone function that Newton steps find; each step sums over the distributed
histogram of sizes and moves one row per source.  Rates become whole copies by a hash and one threshold per
source, so that a document's copies follow from its own row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import uniform
from tidemark.session import keep

WORDS = r"[^\x20\x09-\x0D]+"
#: Turns that a source's documents are dealt to when rates become whole copies.
BINS = 8_192
STEPS, EXACT = 60, 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def units(documents: DataFrame) -> DataFrame:
    """``doc_id, source, size, rows``: rows with the same id, source and size are one unit."""
    sized = documents.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count(F.col("text")).alias("size"))
    return sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))


def source_targets(unit: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """``source, source_size, target, docs`` for each source.

    Sources in code point order, null last, weigh ``weights``, repeating.  They share the words of
    all sources by weight; none gets more than ``most`` times its own, and the rest is shared again.
    """
    spark = unit.sparkSession
    totals = unit.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.sum("rows").alias("docs"))
    ordered = totals.orderBy(F.col("source").asc_nulls_last())
    schema = StructType([*ordered.schema.fields, StructField("place", LongType())])
    placed = spark.createDataFrame(ordered.rdd.zipWithIndex().map(lambda x: (*x[0], x[1])), schema)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("double")
    sources = keep(placed.withColumn("weight", weight), "sources")
    cap, level = F.col("source_size") * float(most), math.inf
    while True:
        full = cap < F.lit(level) * F.col("weight") if level < math.inf else F.lit(False)
        share = sources.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(full, cap).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("free"),
        ).first()
        if not share["free"]:
            break
        raised = ((share["all"] or 0) - share["fixed"]) / share["free"]
        if raised == level:
            break
        level = raised
    target = F.least(cap, F.lit(level if level < math.inf else 0.0) * F.col("weight"))
    return keep(sources.select("source", "source_size", target.alias("target"), "docs"), "targets")


def _rate(size: Column, most: float) -> Column:
    """Copies wanted of a document: ``exp(dual * size / scale)``, at most ``most``."""
    power = F.least(F.col("dual") * size / F.col("scale"), F.lit(math.log(most) + 1.0))
    return F.when(F.col("target") >= F.col("source_size") * most, F.lit(float(most))).otherwise(F.least(F.exp(power), F.lit(float(most))))


def duals(unit: DataFrame, targets: DataFrame, most: float = 3.0) -> DataFrame:
    """``targets`` with ``dual`` and ``scale``; Newton steps, halving the bracket where a step leaves it."""
    sizes = keep(unit.filter("size > 0").groupBy("source", "size").agg(F.sum("rows").alias("rows")), "sizes")
    state = keep(
        targets.select(
            "*", F.lit(0.0).alias("dual"), (F.col("source_size") / F.col("docs")).alias("scale"),
            F.lit(-math.inf).alias("low"), F.lit(math.inf).alias("high"), F.lit(math.inf).alias("off"),
        ), "duals")
    taken = F.col("rows") * F.col("size") * _rate(F.col("size"), most)
    moves = F.when(_rate(F.col("size"), most) < most, taken * F.col("size") / F.col("scale")).otherwise(0.0)
    for _ in range(STEPS):
        sums = sizes.join(state.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).groupBy("of").agg(
            F.sum(taken).alias("taken"), F.sum(moves).alias("slope"))
        step = state.join(sums.withColumnRenamed("of", "summed"), F.col("source").eqNullSafe(F.col("summed")), "left")
        gap = F.coalesce(F.col("taken"), F.lit(0.0)) - F.col("target")
        done = (F.col("target") >= F.col("source_size") * most) | (F.abs(gap) <= F.col("target") * EXACT)
        low = F.when(gap < 0, F.col("dual")).otherwise(F.col("low"))
        high = F.when(gap >= 0, F.col("dual")).otherwise(F.col("high"))
        # on the logarithm of the words taken, which is close to a straight line in the dual
        ratio = F.log(F.col("taken") / F.col("target"))
        newton = F.when(F.col("slope") > 0, F.col("dual") - ratio * F.col("taken") / F.col("slope"))
        inside = newton.isNotNull() & (newton > low) & (newton < high)
        middle = (
            F.when(low == -math.inf, F.least(F.col("dual"), F.lit(0.0)) * 2 - 1)
            .when(high == math.inf, F.greatest(F.col("dual"), F.lit(0.0)) * 2 + 1)
            .otherwise((low + high) / 2)
        )
        state = keep(
            step.select(
                "source", "source_size", "target", "docs",
                F.when(done, F.col("dual")).when(inside, newton).otherwise(middle).alias("dual"),
                "scale", low.alias("low"), high.alias("high"), F.when(done, 0.0).otherwise(F.abs(gap)).alias("off"),
            ), "duals")
        if not state.filter("off > 0 and (isnull(high - low) or high - low > 1e-14 * (1 + abs(dual)))").limit(1).count():
            break
    return state.drop("low", "high", "off")


def _parts(size: Column, most: float) -> tuple[Column, Column, Column]:
    """Least copies of a document, most copies, and what its rate is above the least."""
    rate = F.round(_rate(size, most), 9)  # the last digits depend on the order of adding
    low, high = F.floor(rate + 1e-9), F.ceil(rate - 1e-9)
    return low, high, F.when(high > low, rate - low).otherwise(F.lit(0.0))


def _turn(doc_id: Column, size: Column, above: Column, bins: int) -> Column:
    """When a document's turn comes to be taken once more: the sooner the more its rate is above its least copies."""
    return F.floor((uniform(doc_id, size, F.lit(11)) - above + 1.0) / 2.0 * bins).cast("int")


def _copies(doc_id: Column, size: Column, most: float, bins: int) -> Column:
    """Copies of a document by what its source's row says; needs no other document."""
    low, high, above = _parts(size, most)
    more = (high > low) & (_turn(doc_id, size, above, bins) < F.col("turns"))
    return F.when(size == 0, F.lit(1)).otherwise(low + F.when(more, 1).otherwise(0)).cast("long")


def plan(unit: DataFrame, weights: tuple[int, ...], most: float, bins: int = BINS) -> DataFrame:
    """One row for each source: ``source, source_size, target, docs, dual, scale, turns``.

    Rates become whole copies by one number per source: a document is taken once more if its turn, a hash less the
    fraction of its rate, is below ``turns``, which is set so that the words taken come nearest to the target.
    """
    solved = keep(duals(unit, source_targets(unit, weights, most), most), "solved")
    rated = unit.join(solved.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    low, high, above = _parts(F.col("size"), most)
    words = F.col("size") * F.col("rows")
    turn = F.when(high > low, _turn(F.col("doc_id"), F.col("size"), above, bins)).otherwise(-bins)
    found = rated.filter("size > 0").groupBy("of", turn.alias("turn")).agg(F.sum(low * words).alias("least"), F.sum(words).alias("more"))
    # at most ``bins`` rows a source
    so_far = Window.partitionBy("of").orderBy("turn")
    steps = found.withColumns({
        "least": F.sum("least").over(Window.partitionBy("of")),
        "taken": F.sum(F.when(F.col("turn") >= 0, F.col("more")).otherwise(0)).over(so_far),
    }).join(solved.select(F.col("source").alias("__of"), "target"), F.col("of").eqNullSafe(F.col("__of")))
    off = F.abs(F.col("target") - F.col("least") - F.col("taken"))
    ahead = F.col("target") - F.col("least")  # with no turn at all
    best = steps.groupBy("of").agg(F.min(F.struct(off.alias("off"), (F.col("turn") + 1).alias("turns"))).alias("best"), F.max(F.abs(ahead)).alias("none"))
    turns = F.when(F.col("best.off") < F.col("none"), F.col("best.turns")).otherwise(0)
    chosen = best.select(F.col("of").alias("__of"), turns.alias("turns"))
    joined = solved.join(chosen, F.col("source").eqNullSafe(F.col("__of")), "left").drop("__of")
    return keep(joined.withColumn("turns", F.coalesce("turns", F.lit(0))), "plan")


def mix(documents: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0, bins: int = BINS) -> DataFrame:
    """``doc_id, source, size, rows, source_size, target, copies``: how often each unit is taken.

    ``size`` counts the words of the whole text (null: 0) and ``rows`` the documents that share id, source
    and size; they are taken alike.  An empty text costs nothing and is taken once.  No document is
    taken more than ``most`` times.  Null ids and sources are values of their own; other columns are
    not read; an empty table gives an empty one.  Runs agree: only hashes of ids and sizes choose.
    """
    unit = keep(units(documents), "units")
    solved = plan(unit, weights, most, bins).withColumnRenamed("source", "of")
    return unit.join(solved, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "size", "rows", "source_size", "target", _copies(F.col("doc_id"), F.col("size"), most, bins).alias("copies"))


def mix_report(documents: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for each row of ``documents``; see :func:`mix`."""
    mixed = mix(documents, weights, most)
    report = mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rows")
    return report.withColumn("one", F.explode(F.array_repeat(F.lit(1), F.col("rows").cast("int")))).drop("one", "rows")


def mixed_documents(documents: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0, bins: int = BINS) -> DataFrame:
    """``documents``, each row as often as the mix takes it; all columns come through unchanged.

    Texts stay where they are: each row's copies follow from its own values and its source's row of the plan.
    """
    columns = documents.columns
    solved = plan(keep(units(documents), "units"), weights, most, bins)
    taken = documents.select(F.struct(*columns).alias("row")).join(
        solved, F.col("row.source").cast("string").eqNullSafe(F.col("source")))
    taken = taken.withColumn("size", word_count(F.col("row.text")))
    copies = _copies(F.col("row.doc_id").cast("long"), F.col("size"), most, bins)
    return taken.select("row", F.explode(F.array_repeat(F.lit(1), copies.cast("int"))).alias("one")).select("row.*")
