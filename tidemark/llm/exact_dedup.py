"""Exact duplicates by two passes over Bloom filters, in DataFrame operations only.

Pass one gives each text ``HASHES`` positions in a bit field and counts positions, combining in each
task; positions met twice become the filter, stored as blocks of 32768 bits.  Pass two tests every
row against the broadcast filter.  Rows with any clear bit are certainly single and go straight
through; only the others are shuffled, and compared by SHA-256.  A filter that is too small for the
table lets more rows be compared; it never changes the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import texts
from tidemark.session import keep

BLOCK = 32768
HASHES = 2
#: The filter never has more bits than this per hash: 32 MiB each, 64 MiB broadcast in all.
MAX_BITS = 1 << 28
BITS_PER_ROW = 32


def _position(n: int, bits: int, sha: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(n), sha), F.lit(bits))


def repeat_filter(digests: DataFrame, bits: int, least: int = 2) -> DataFrame:
    """``hash, block, bitmap``: the positions that at least ``least`` rows have.

    At most ``HASHES * bits / 32768`` rows of 4 KiB.  ``digests`` has a binary column ``sha``.
    """
    positions = digests.select(
        F.explode(F.array(*(F.struct(F.lit(n).alias("hash"), _position(n, bits, F.col("sha")).alias("at")) for n in range(HASHES)))).alias("p")
    )
    met = positions.groupBy("p.hash", "p.at").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    return met.groupBy("hash", F.expr(f"at div {BLOCK}").alias("block")).agg(
        F.bitmap_construct_agg(F.pmod("at", F.lit(BLOCK))).alias("bitmap")
    )


def maybe_repeated(rows: DataFrame, repeats: DataFrame, bits: int, sha: str, name: str) -> DataFrame:
    """``rows`` and a boolean column ``name``: false only where the text is certainly single."""
    hit = F.lit(True)
    for n in range(HASHES):
        at = _position(n, bits, F.col(sha))
        blocks = repeats.filter(F.col("hash") == n).select(
            F.col("block").alias(f"{name}_block{n}"), F.col("bitmap").alias(f"{name}_bitmap{n}")
        )
        rows = rows.join(F.broadcast(blocks), F.expr(f"{name}_block{n}") == F.floor(at / BLOCK), "left")
        bit = F.pmod(at, F.lit(BLOCK))
        byte = F.conv(F.hex(F.substring(f"{name}_bitmap{n}", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10)
        held = F.call_function("shiftright", byte.cast("int"), F.pmod(bit, F.lit(8)).cast("int")).bitwiseAND(1) == 1
        hit = hit & F.coalesce(held, F.lit(False))
    flagged = rows.withColumn(name, hit)
    return flagged.drop(*(f"{name}_{x}{n}" for n in range(HASHES) for x in ("block", "bitmap")))


def filter_bits(rows: int, max_bits: int = MAX_BITS) -> int:
    bits = BLOCK
    while bits < min(max_bits, BITS_PER_ROW * rows):
        bits *= 2
    return bits


def _passes(documents: DataFrame, max_bits: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Digests of all rows, the filter, the repeated texts with their sizes, and the filter's bits."""
    digests = keep(texts(documents).select("doc_id", F.unhex(F.sha2("text", 256)).alias("sha")), "digests")
    bits = filter_bits(digests.count(), max_bits)
    repeats = keep(repeat_filter(digests, bits), "repeats")
    flagged = maybe_repeated(digests, repeats, bits, "sha", "hit")
    groups = flagged.filter("hit").groupBy("sha").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    return flagged, repeats, keep(groups.filter("group_size > 1"), "groups"), bits


def duplicate_report(documents: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row.

    Texts are equal when identical; null counts as empty.  ``keep_id`` is the largest ``doc_id`` of
    the equal texts (null only if all are null) and ``kept`` says whether the row has it; rows that
    repeat both text and ``doc_id`` are each counted and each reported.  Other columns are not read.
    """
    flagged, _, groups, _ = _passes(documents, max_bits)
    groups = groups.withColumnRenamed("sha", "of")
    single = flagged.filter("not hit").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha")
    shared = flagged.filter("hit").join(groups, F.col("sha") == F.col("of"), "left").select(
        "doc_id",
        F.when(F.col("of").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        "sha",
    )
    return single.unionByName(shared).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def sha_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def without(documents: DataFrame, gone: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``documents`` without the rows whose id and SHA-256 of the text are in ``gone`` (``doc_id, sha``, distinct).

    A Bloom filter of the texts that go is broadcast; rows that it clears stay where they are, and only the others
    are compared.  All columns come through unchanged.
    """
    gone = keep(gone, "gone")
    bits = filter_bits(gone.count(), max_bits)
    names = keep(repeat_filter(gone, bits, least=1), "gone-filter")
    rows = documents.select(F.struct(*documents.columns).alias("row"))
    flagged = maybe_repeated(rows.withColumn("sha", sha_of(F.col("row.text"))), names, bits, "sha", "hit")
    out = gone.select(F.col("doc_id").alias("gone_id"), F.col("sha").alias("gone_sha"))
    same = (F.col("sha") == F.col("gone_sha")) & F.col("row.doc_id").cast("long").eqNullSafe(F.col("gone_id"))
    left = flagged.filter("hit").join(out, same, "left_anti")
    return flagged.filter("not hit").select("row.*").unionByName(left.select("row.*"))


def drop_duplicates(documents: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``documents`` with one row of equal texts, the one with the largest ``doc_id``.

    Of rows that repeat that ``doc_id`` too, the one whose columns hash lowest stays.  What goes is decided on ids and
    digests; of the texts only those that go, and the few that a filter cannot tell from them, are shuffled.
    Any other columns come through unchanged.
    """
    flagged, _, groups, _ = _passes(documents, max_bits)
    shared = flagged.filter("hit").join(groups.withColumnRenamed("sha", "of"), F.col("sha") == F.col("of"))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    left = without(documents, shared.filter(~stays).select("doc_id", "sha").distinct(), max_bits)
    # rows that repeat the kept id and its text
    again = keep(shared.filter(stays).groupBy("doc_id", "sha").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "again")
    if not again.limit(1).count():
        return left
    rows = left.select(F.struct(*documents.columns).alias("row")).withColumn("of", sha_of(F.col("row.text")))
    same = (F.col("of") == F.col("sha")) & F.col("row.doc_id").cast("long").eqNullSafe(F.col("doc_id"))
    told = rows.join(again.withColumn("again", F.lit(True)), same, "left")
    one = told.filter("again").groupBy("of").agg(F.min_by("row", F.xxhash64("row.*")).alias("row"))
    return told.filter("again is null").select("row.*").unionByName(one.select("row.*"))
