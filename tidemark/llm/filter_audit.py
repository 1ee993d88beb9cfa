"""What a set of document filters removes, in every order and by exact Shapley values.

One pass gives each document the set of filters that it fails, as bits.  Documents are counted by part
and set, so all that follows works on at most 32 rows a part: the removals of all 32 coalitions of five
filters, the steps of all orders as differences of two coalitions, and Shapley values as the solution of
the kernel-weighted least squares problem whose values must add up to what all filters remove.  The
normal equations are solved in rationals, once for each coalition's unit vector, because they do not
depend on the counts; a part's values are then whole-number combinations of its coalitions.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import keep

BLANKS = r"[\x20\x09-\x0D]+"
#: The filters that look at one text, by letter; the last letter, E, marks repeated texts.
ONE_TEXT = "ABCD"


def text_failures(text: Column) -> dict[str, Column]:
    """Whether ``text`` fails each filter that needs no other document."""
    words = F.array_remove(F.split(text, BLANKS), "")
    return {
        "A": F.size(words) < 100,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
        "C": F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * 10,
        "D": text.rlike(r"[#$%&*|]"),
    }


def _bits(failures: Sequence[Column]) -> Column:
    bits = F.lit(0)
    for n, fails in enumerate(failures):
        bits = bits + F.when(fails, 1 << n).otherwise(0)
    return bits


def _facts(documents: DataFrame) -> DataFrame:
    """``doc_id, part, sha, mask`` of every document; the texts are not needed after this."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    failures = text_failures(F.col("text"))
    return keep(rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("sha"), _bits([failures[x] for x in ONE_TEXT]).alias("mask")), "facts")


def _labels(labels: DataFrame) -> DataFrame:
    found = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("labelled"))
    return found.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))


def failure_sets(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, docs, good, toxic``: documents by the set of filters that they fail.

    Bit n of ``mask`` stands for the n-th of A to E.  Null texts and parts count as empty.  A text is a
    repeat (E) if an equal text anywhere has a smaller ``doc_id``; null ids are neither.  A document is good or toxic if any
    label row of its id says so; ids that repeat share their labels.
    """
    facts = _facts(documents)
    first = facts.groupBy("sha").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    repeated = first.filter("last > first").select(F.col("sha").alias("of"), "first")
    marked = facts.join(repeated, F.col("sha") == F.col("of"), "left").select(
        "doc_id", "part", (F.col("mask") + F.when(F.col("doc_id") > F.col("first"), 1 << len(ONE_TEXT)).otherwise(0)).alias("mask"))
    marked = marked.groupBy("doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    known = marked.join(_labels(labels), F.col("doc_id") == F.col("labelled"), "left")
    return known.groupBy("part", "mask").agg(
        F.sum("n").alias("docs"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def coalitions(sets: DataFrame, filters: int) -> DataFrame:
    """``part, coalition, docs, good, toxic``: what each of the ``2 ** filters`` coalitions removes from a part."""
    each = sets.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << filters) - 1))))
    hit = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    return each.groupBy("part", "coalition").agg(
        *(F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(c) for c in ("docs", "good", "toxic")), F.sum("docs").alias("all"))


def shapley_weights(filters: int) -> list[list[Fraction]]:
    """For each filter, the factor of each coalition's removals in its Shapley value.

    Minimises the sum over proper coalitions S of ``w(S) (v(S) - sum of values in S)^2`` with
    ``w = (n - 1) / (C(n, s) s (n - s))``, subject to the values adding up to ``v(all)``: Gauss-Jordan
    elimination in rationals on the normal equations and the multiplier of that condition.
    """
    n, full = filters, (1 << filters) - 1
    if n == 1:
        return [[Fraction(0), Fraction(1)]]
    weight = {s: Fraction(n - 1, comb(n, s) * s * (n - s)) for s in range(1, n)}
    proper = range(1, full)
    size = [m.bit_count() for m in range(full + 1)]
    rows = []
    for i in range(n):
        normal = [sum((weight[size[m]] for m in proper if m >> i & 1 and m >> j & 1), Fraction(0)) for j in range(n)]
        right = [weight[size[m]] if m in proper and m >> i & 1 else Fraction(0) for m in range(full + 1)]
        rows.append([*normal, Fraction(1), *right])
    rows.append([*[Fraction(1)] * n, Fraction(0), *[Fraction(m == full) for m in range(full + 1)]])
    for c in range(n + 1):
        pivot = next(r for r in range(c, n + 1) if rows[r][c])
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(n + 1):
            if r != c and rows[r][c]:
                rows[r] = [x - rows[r][c] * y for x, y in zip(rows[r], rows[c])]
    return [row[n + 1:] for row in rows[:n]]


def _steps(filters: str) -> list[dict]:
    """Every step of every order, with the coalitions before and after it."""
    found = []
    for order in permutations(filters):
        before = 0
        for step, letter in enumerate(order, 1):
            own = 1 << filters.index(letter)
            found.append({"filter_order": "".join(order), "step": step, "own": own, "before": before, "after": before | own})
            before |= own
    return found


def interaction_audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part, order of the filters A to E, and step; columns as the module's contract names them.

    ``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``.
    ``shapley`` is the filter's removals added up over all orders, 120 times its Shapley value.  Edge rows as in
    :func:`failure_sets`; empty documents give no rows, empty labels no losses; other columns are not read.
    """
    filters = f"{ONE_TEXT}E"
    n, full = len(filters), (1 << len(filters)) - 1
    sets = keep(failure_sets(documents, labels), "sets")
    removed = coalitions(sets, n)
    factors = [[int(x * factorial(n)) for x in row] for row in shapley_weights(n)]
    value = [F.sum(F.element_at(F.array(*map(F.lit, row)), F.col("coalition") + 1) * F.col("docs")).alias(f"value{i}") for i, row in enumerate(factors)]
    # 32 entries a part
    table = removed.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("coalition", F.struct("docs", "good", "toxic")))).alias("of"), F.max("all").alias("all"), *value)
    steps = F.from_json(F.lit(json.dumps(_steps(filters))), "array<struct<filter_order:string,step:int,own:int,before:int,after:int>>")
    step = table.withColumn("values", F.array(*(f"value{i}" for i in range(n)))).select("part", "all", "of", "values", F.inline(steps))

    def at(mask: Column | int, count: str) -> Column:
        return F.element_at("of", F.lit(mask) if isinstance(mask, int) else mask)[count]

    after, before, own = F.col("after"), F.col("before"), F.col("own")
    gone = at(after, "docs") - at(before, "docs")
    return step.select(
        "part", "filter_order", "step", (F.col("all") - at(after, "docs")).alias("kept"), gone.alias("removed"),
        (at(own, "docs") - gone).alias("redundant"), (at(full, "docs") - at(F.lit(full) - own, "docs")).alias("unique_fails"),
        (at(after, "good") - at(before, "good")).alias("good_lost"), (at(after, "toxic") - at(before, "toxic")).alias("toxic_lost"),
        F.element_at("values", F.round(F.log2(own)).cast("int") + 1).alias("shapley"))
