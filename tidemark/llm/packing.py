"""Best-fit packing with certified bounds.

Pieces are dealt to partitions by a hash and packed there, longest first, each into the fullest
sequence with room.  Dual feasible functions map lengths to weights of which no sequence can hold
more than one in all, so their sums bound the number of sequences from below; sums of one function
add up over partitions and so bound the whole corpus too.  A partition whose number is above its bound
gives back its emptiest sequences and some of many small pieces; what several partitions give back meets in one and is
packed again, round after round, until the corpus bound is met or one partition has all that is open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import by_bytes, dealt, texts, workers_import
from tidemark.llm.encoding import Encoder, encoder
from tidemark.session import keep

#: Pieces a task packs at once, and partitions whose open pieces meet in one in the next round.
TASK_PIECES, MEET = 50_000, 16
#: Texts that a task encodes at once.
TASK_BYTES = 2 << 20
#: Sequences of many pieces that a partition gives back for each of its emptiest.
MIX = 32
FUNCTIONS = 24


def _pieces_of(batch: pa.RecordBatch, library: Encoder, capacity: int, end_id: int) -> pa.RecordBatch:
    """The pieces of a few texts, which are encoded together."""
    found, ends = library.encode_all(batch.column("text"))
    found = np.insert(found, ends, end_id)
    sizes = np.diff(ends + np.arange(1, len(ends) + 1), prepend=0)
    counts = -(-sizes // capacity)
    of = np.repeat(np.arange(len(sizes)), counts)
    piece = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = piece * capacity
    length = np.minimum(capacity, sizes[of] - start)
    # the pieces lie one after the other in ``found``
    at = np.concatenate([[0], 4 * np.cumsum(length)]).astype(np.int32)
    ids = pa.Array.from_buffers(pa.binary(), len(of), [None, pa.py_buffer(at), pa.py_buffer(found)])
    columns = [batch.column("doc_id").take(pa.array(of)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), ids]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids"])


def token_pieces(documents: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, cached: int = 800_000) -> DataFrame:
    """``doc_id, piece, start, length, ids``: the tokens of each whole text and ``end_id``, cut every ``capacity``.

    ``ids`` are little-endian unsigned 32-bit integers.  A null text is empty and gives the end alone.
    """
    workers_import(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoder(tokenizer, cached)
        for batch in by_bytes(batches, "text", TASK_BYTES):
            yield _pieces_of(batch, library, capacity, end_id)
            # Arrow would keep the memory of the largest cut for the worker's life
            pa.default_memory_pool().release_unused()

    return texts(documents).mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


def weights(capacity: int) -> np.ndarray:
    """Weight of each length under each dual feasible function, ``FUNCTIONS * 2`` rows by ``capacity + 1``.

    Row 0 is the length itself.  Half the others round multiples of ``1 / k`` towards the length; the
    rest count lengths over ``1 - e`` in full and lengths under ``e`` not at all.
    """
    x = np.arange(capacity + 1)
    rows = [x / capacity]
    for k in range(1, FUNCTIONS):
        whole = (k + 1) * x % capacity == 0
        rows.append(np.where(whole, x / capacity, ((k + 1) * x // capacity) / k))
    for k in range(2, FUNCTIONS + 2):
        e = capacity // k
        rows.append(np.where(x > capacity - e, 1.0, np.where(x >= e, x / capacity, 0.0)))
    return np.array(rows)


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Sequence and offset of each length, taken in order, and the room left in each sequence."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, place, offset, room = 0, [], [], []
    for length in lengths:
        fits = open_rooms >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            at = by_room[free].pop()
            if not by_room[free]:
                open_rooms &= ~(1 << free)
        else:
            at, free = len(room), capacity
            room.append(capacity)
        place.append(at)
        offset.append(capacity - free)
        left = room[at] = free - length
        if left:
            by_room[left].append(at)
            open_rooms |= 1 << left
    return place, offset, room


def _pack(capacity: int, number: int, last: bool):
    """Packs one partition; ``open`` marks pieces of the sequences it gives back."""

    def run(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("start", "ascending")])
        lengths = table["length"].to_numpy()
        place, offset, room = best_fit(lengths.tolist(), capacity)
        place, room = np.array(place, np.int64), np.array(room)
        sums = weights(capacity) @ np.bincount(lengths, minlength=capacity + 1)
        surplus = len(room) - sums.max()
        back = 0 if last or surplus < 1e-6 else min(len(room), 2 * int(np.ceil(surplus)) + 2)
        given = np.zeros(len(room), bool)
        given[np.argsort(-room, kind="stable")[:back]] = True
        given &= room > 0
        if back:
            # the emptiest hold pieces too large to go together; small ones lie in sequences of many pieces
            many = np.argsort(-np.bincount(place, minlength=len(room)), kind="stable")
            given[many[:MIX * back]] = True
        base = (number << 56) + (part << 28)
        columns = {"sequence_id": pa.array(base + place), "offset": pa.array(offset, pa.int64()), "open": pa.array(given[place])}
        for name, values in columns.items():
            table = table.append_column(name, values)
        return table

    return run


def lower_bound(pieces: DataFrame, capacity: int) -> int:
    """Fewest sequences that any packing of ``pieces`` needs, as far as the functions tell."""
    sums = np.zeros(2 * FUNCTIONS)
    for row in pieces.groupBy("length").count().toLocalIterator():  # at most ``capacity`` rows
        sums = sums + weights(capacity)[:, row["length"]] * row["count"]
    return int(np.ceil(sums.max() - 1e-6))


def pack(pieces: DataFrame, capacity: int = 2048, task_pieces: int = TASK_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: sequences are gapless from 0 and at most ``capacity`` long.

    ``pieces`` has ``doc_id``, ``piece``, ``start`` and ``length`` (1 to ``capacity``) and any columns besides
    ``part``, ``open``, ``sequence_id`` and ``offset``.  Equal rows are packed one by one.
    """
    spark = pieces.sparkSession
    workers_import(spark)
    pieces = keep(pieces, "pieces")
    parts = dealt(pieces.count(), task_pieces)
    bound = lower_bound(pieces, capacity)
    waiting = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "start", "length", F.monotonically_increasing_id()), F.lit(parts)))
    done: DataFrame | None = None
    number = used = 0
    while True:
        schema = StructType(list(waiting.schema)).add("sequence_id", "long").add("offset", "long").add("open", "boolean")
        packed = keep(waiting.groupBy("part").applyInArrow(_pack(capacity, number, parts == 1), schema), "packed")
        shut = packed.filter("not open")
        counts = packed.select("sequence_id", "open").filter("open").agg(F.countDistinct("sequence_id").alias("open")).first()
        used += shut.filter("offset = 0").count()
        if used + counts["open"] <= bound or not counts["open"]:
            shut, counts = packed, {"open": 0}
        done = shut.drop("part", "open") if done is None else done.unionByName(shut.drop("part", "open"))
        if not counts["open"]:
            return done
        parts, number = dealt(parts, MEET), number + 1
        waiting = packed.filter("open").drop("sequence_id", "offset", "open").withColumn("part", F.floor(F.col("part") / MEET))


def packed_documents(documents: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, ids: bool = True, cached: int = 800_000) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of each piece, and its ``ids``.

    Without ``ids`` only their checksum is carried through the packing.  Documents longer than ``capacity`` are cut; each
    other one is one piece.  Rows that repeat a ``doc_id`` are documents of their own.  An empty
    table gives no pieces.  Other columns are not read.  ``cached`` bounds the words whose ids a worker keeps.
    """
    pieces = token_pieces(documents, tokenizer, capacity, end_id, cached).withColumn("ids_crc32", F.crc32("ids"))
    return pack(pieces if ids else pieces.drop("ids"), capacity)


def sequence_ids(packed: DataFrame) -> DataFrame:
    """``sequence_id, length, ids``: the training sequences themselves, each at most one capacity long."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("offset")
        ids = b"".join(table["ids"].to_pylist())
        return pa.table({"sequence_id": table["sequence_id"][:1], "length": pa.array([len(ids) // 4], pa.int64()), "ids": pa.array([ids], pa.binary())})

    return packed.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInArrow(run, "sequence_id long, length long, ids binary")
