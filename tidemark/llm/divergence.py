"""How far the vocabularies of sources lie apart within a language, from stripes folded in the mappers.

A task folds its documents, whole, into hash stripes: term to (documents that have it, occurrences by
source).  The stripes of a language lie column by column, one pair of hash tables for each source, so that folding a
document is two passes in C.  Full tables are spilled as rows and merged by term; a merged stripe is a run of
rows.  A pair of sources only meets in the stripes that hold both: the rest of its sum
follows from how often each rate comes up in a source, because a missing term has one and the same rate there.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import workers_import
from tidemark.session import keep

#: Letters of ASCII in lower case and all bytes of other characters; anything else parts terms.
TERM_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: A task spills its stripes when they hold this many source counts, some 150 MB.
SPILL_COUNTS = 500_000
#: A task compares this many pairs of rates at a time, and hands on its sums when it holds half as many.
PAIRS = 1_000_000
SCALE = 1_000_000_000

_STRIPES = "lang string, source string, term string, df long, n long"


def _rows(tables: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (df, counts) in tables.items():
        terms = pa.array(list(counts), pa.binary()).cast(pa.string())
        # both tables met the terms in the same order
        columns = [terms, pa.array(list(df.values()), pa.int64()), pa.array(list(counts.values()), pa.int64())]
        same = [pa.array([x], pa.string()).take(pa.array(np.zeros(len(terms), np.int32))) for x in (lang, source)]
        yield pa.RecordBatch.from_arrays([*same, *columns], ["lang", "source", "term", "df", "n"])


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables, folded = {}, 0
    for batch in batches:
        for text, lang, source in zip(batch["text"], batch["lang"].to_pylist(), batch["source"].to_pylist()):
            df, counts = tables.setdefault((lang, source), (Counter(), Counter()))
            terms = text.as_py().translate(TERM_BYTES).split()
            counts.update(terms)
            df.update(dict.fromkeys(terms).keys())
            folded += 1
            if folded % 32 == 0 and sum(len(c) for _, c in tables.values()) >= SPILL_COUNTS:
                yield from _rows(tables)
                tables.clear()
    yield from _rows(tables)


def stripes(documents: DataFrame, least_docs: int) -> DataFrame:
    """``lang, term, source, n, everywhere`` of the terms that at least ``least_docs`` documents of a language have.

    ``n`` counts the term in the source, ``everywhere`` in the language.  One shuffle, by term: a term has at
    most one row for each source once they are added up, however many tasks met it.
    """
    workers_import(documents.sparkSession)
    rows = documents.select(
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")))
    spilled = rows.mapInArrow(_fold, _STRIPES).repartition("lang", "term")
    merged = spilled.groupBy("lang", "term", "source").agg(F.sum("df").alias("df"), F.sum("n").alias("n"))
    stripe = Window.partitionBy("lang", "term")
    whole = merged.select("lang", "term", "source", "n", F.sum("df").over(stripe).alias("df"), F.sum("n").over(stripe).alias("everywhere"))
    return whole.filter(F.col("df") >= least_docs).drop("df")


def _rate(count: Column | str, words: str) -> Column:
    """``1 + floor(SCALE * (count + 1) / words)``, exactly."""
    raised = (F.col(count) if isinstance(count, str) else count).cast("decimal(20,0)") + 1
    return F.call_function("div", raised * F.lit(SCALE).cast("decimal(10,0)"), F.col(words).cast("decimal(20,0)")) + 1


def _gap(p: Column | str, q: Column | str) -> Column:
    """``floor((p - q)^2 / q)``; rates are at most ``SCALE + 1``, so the square fits a long."""
    p, q = (F.col(x) if isinstance(x, str) else x for x in (p, q))
    return F.call_function("div", (p - q) * (p - q), q)


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _runs(table: pa.Table) -> np.ndarray:
    """Where each run of the same language and term starts."""
    if not table.num_rows:
        return np.zeros(0, np.int64)
    parted = [pc.not_equal(table[c].slice(1), table[c].slice(0, table.num_rows - 1)) for c in ("lang", "term")]
    return np.concatenate([[0], np.flatnonzero(pc.or_(*parted).to_numpy()) + 1])


class _PairSums:
    """Sums for pairs of sources of a language, by number."""

    def __init__(self) -> None:
        self.place, self.codes, self.values = {}, [], []

    def add(self, stripes: pa.Table) -> None:
        """What the terms of whole stripes change for each pair of sources that has them."""
        starts = _runs(stripes)
        length = np.diff(np.append(starts, stripes.num_rows))
        partners, first = np.repeat(length, length), np.repeat(starts, length)
        p, zero = (stripes[c].to_numpy() for c in ("p", "zero"))
        pairs = zip(stripes["lang"].to_pylist(), stripes["source"].to_pylist())
        at = np.array([self.place.setdefault(x, len(self.place)) for x in pairs], np.int64)
        ends = np.cumsum(partners)
        row = 0
        while row < len(ends):
            upto = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + PAIRS, "right")))
            n = partners[row:upto]
            a = np.repeat(np.arange(row, upto), n)
            b = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[row:upto], n)
            a, b = a[a != b], b[a != b]
            self.codes.append((at[a] << 31) + at[b])
            self.values.append(_gaps(p[a], p[b]) - _gaps(p[a], zero[b]) - _gaps(zero[a], p[b]) + _gaps(zero[a], zero[b]))
            self.add_up()
            row = upto

    def add_up(self) -> None:
        code, back = np.unique(np.concatenate(self.codes), return_inverse=True)
        value = np.zeros(len(code), np.int64)
        np.add.at(value, back, np.concatenate(self.values))
        self.codes, self.values = [code], [value]

    def rows(self) -> pa.RecordBatch:
        names, code = list(self.place), self.codes[0] if self.codes else np.zeros(0, np.int64)
        value = self.values[0] if self.values else code
        text = [[names[c >> 31][0] for c in code], [names[c >> 31][1] for c in code], [names[c & (1 << 31) - 1][1] for c in code]]
        return pa.RecordBatch.from_arrays([*(pa.array(x, pa.string()) for x in text), pa.array(value)], ["lang", "source", "item", "moved"])


def _folded_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections of source pairs, added up over the stripes of a task; rows come sorted by term."""
    sums, open_stripe = _PairSums(), None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([open_stripe, table]) if open_stripe is not None else table
        starts = _runs(table)
        last = int(starts[-1]) if len(starts) else 0
        open_stripe = table.slice(last)
        if last:
            sums.add(table.slice(0, last).combine_chunks())
        if sums.codes and len(sums.codes[0]) >= PAIRS // 2:
            yield sums.rows()
            sums = _PairSums()
    if open_stripe is not None and open_stripe.num_rows:
        sums.add(open_stripe.combine_chunks())
    yield sums.rows()


def divergences(documents: DataFrame, least_docs: int = 3, ranks: int = 200) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every group of a language and source.

    Part ``pair`` ranks all other sources of the language by divergence, part ``term`` the ``ranks`` terms
    that the source uses above the language's rate.  Null text, language and source count as ''.  A group without
    kept terms gets its pairs too, of value 0 if the language keeps no term.  All arithmetic is on whole numbers.
    Rows that repeat count again; no documents give no rows; other columns are not read.
    """
    flat = keep(stripes(documents, least_docs), "stripes")
    # every sum is made in the tasks first, however many documents a group has
    groups = documents.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    own = flat.groupBy("lang", "source").agg(F.sum("n").alias("own"), F.count(F.lit(1)).alias("held"))
    size = flat.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("words"))
    totals = keep(
        groups.join(size, "lang", "left").join(own, ["lang", "source"], "left").na.fill(0).select(
            "lang", "source", "terms", "held", (F.col("own") + F.col("terms")).alias("base"), (F.col("words") + F.col("terms")).alias("lang_base")
        ).withColumn("zero", F.when(F.col("terms") > 0, _rate(F.lit(0), "base"))), "totals")
    rated = keep(
        flat.join(totals.select("lang", "source", "base", "lang_base", "zero"), ["lang", "source"]).select(
            "lang", "source", "term", "zero", _rate("n", "base").alias("p"), _rate("everywhere", "lang_base").alias("q")), "rates")

    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    terms = rated.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _gap("p", "q").alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= ranks)

    met = rated.repartition("lang", "term").sortWithinPartitions("lang", "term").select("lang", "term", "source", "p", "zero")
    moved = met.mapInArrow(_folded_pairs, "lang string, source string, item string, moved long").groupBy("lang", "source", "item").agg(
        F.sum(F.col("moved").cast("decimal(38,0)")).alias("moved"))
    # how often each rate comes up in a source: far fewer rows than terms
    often = keep(rated.groupBy("lang", "source", "p", "zero").agg(F.count(F.lit(1)).alias("n")), "often")
    item = totals.select("lang", F.col("source").alias("item"), F.col("held").alias("item_held"), F.col("zero").alias("item_zero"))
    keys, times = ["lang", "source", "item"], F.col("n").cast("decimal(20,0)")
    mine = often.join(item, "lang").filter("source <> item").groupBy(keys).agg(F.sum(times * _gap("p", "item_zero")).alias("mine"))
    theirs = often.join(item, "lang").filter("source <> item").groupBy("lang", F.col("item").alias("source"), F.col("source").alias("item")).agg(
        F.sum(times * _gap("item_zero", "p")).alias("theirs"))
    neither = (F.col("terms") - F.col("held") - F.col("item_held")).cast("decimal(20,0)") * _gap("zero", "item_zero")
    summed = totals.join(item, "lang").filter("source <> item").withColumn("neither", neither)
    for part in (mine, theirs, moved):
        summed = summed.join(part, keys, "left")
    value = sum((F.coalesce(F.col(c).cast("decimal(38,0)"), F.lit(0)) for c in ("mine", "theirs", "moved")), F.coalesce(F.col("neither").cast("decimal(38,0)"), F.lit(0))).cast("long")
    ranked = summed.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    ranked = ranked.withColumn("rank", F.row_number().over(best))
    return terms.unionByName(ranked)
