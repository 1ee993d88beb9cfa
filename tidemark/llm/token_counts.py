"""Token counts by a two-tier lookup on the map side: no pre-token is ever shuffled.

Tier one is a broadcast table of frequent pieces and their numbers of tokens.  Tier two is each
worker's bounded cache, which asks the library once for every other piece.  Whole texts are counted
either way; which piece is in which tier changes the time only.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import texts, workers_import
from tidemark.llm.encoding import Encoder, _NotApart, encoder
from tidemark.session import keep

#: Bounds of the broadcast table and of the one a task counts in: entries, and characters of one.
TABLE_ENTRIES, PIECE_CHARS = 1 << 16, 40


def _prune(words: Counter[str], entries: int) -> Counter[str]:
    return Counter(dict(sorted(words.items(), key=lambda x: (-x[1], x[0]))[:entries]))


def frequent_pieces(documents: DataFrame, tokenizer: str, entries: int = TABLE_ENTRIES) -> dict[str, int]:
    """Number of tokens of the most frequent pieces in all documents.

    A task counts in a table that it prunes to its ``entries`` most frequent pieces whenever it has four times as many;
    only these tables are shuffled.  The counts decide what is looked up in the broadcast table rather than a worker's
    cache.  The result has at most ``entries`` pieces of at most ``PIECE_CHARS`` characters, about 4 MB.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words.update([p for p in text.split(" ")[1:] if len(p) <= PIECE_CHARS])
                if len(words) > 4 * entries:
                    words = _prune(words, entries)
        words = _prune(words, entries)
        yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["piece", "n"])

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoder(tokenizer)
        for batch in batches:
            found = []
            for piece in batch.column(0).to_pylist():
                with suppress(_NotApart):
                    found.append((piece, len(library._ids(" ", piece))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in found], pa.string()), pa.array([n for _, n in found], pa.int32())],
                names=["piece", "n_tokens"],
            )

    workers_import(documents.sparkSession)
    counted = texts(documents).select("text").mapInArrow(count, "piece string, n long")
    counted = keep(counted.groupBy("piece").agg(F.sum("n").alias("n")).filter("n > 1"), "pieces")
    # the smallest count that leaves no more than ``entries`` pieces
    room, least = entries, None
    for r in counted.groupBy("n").count().orderBy(F.desc("n")).limit(entries).collect():
        room -= r["count"]
        if room < 0:
            break
        least = r["n"]
    if least is None:
        return {}
    return {r.piece: r.n_tokens for r in counted.filter(F.col("n") >= least).select("piece").mapInArrow(sizes, "piece string, n_tokens int").collect()}


def token_counts(documents: DataFrame, tokenizer: str, limit: int = 512, cache_pieces: int = 300_000) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row, as the library counts the whole text.

    No begin, end or other special tokens are added; special strings inside texts are treated as
    the library does by default.  A null text is empty: 0 bytes, 0 tokens.  Rows stay rows: a null or
    repeated ``doc_id`` gets a row each time.  Other columns are not read.  An empty table gives none.
    ``cache_pieces`` bounds what a worker remembers.
    """
    spark = documents.sparkSession
    workers_import(spark)
    table, name = spark.sparkContext.broadcast(frequent_pieces(documents, tokenizer)), uuid.uuid4().hex

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _counting(name, tokenizer, cache_pieces, table)
        for batch in batches:
            n = [library.count(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    sized = texts(documents).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    counted = sized.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


_COUNTING: dict[str, Encoder] = {}


def _counting(name: str, tokenizer: str, cache_pieces: int, table) -> Encoder:
    """This worker's counter; a worker serves one broadcast table at a time."""
    if name not in _COUNTING:
        _COUNTING.clear()
        _COUNTING[name] = Encoder(tokenizer, cache_pieces, known=table.value)
    return _COUNTING[name]
