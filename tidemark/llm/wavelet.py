"""Token ids in wavelet matrices: one compressed file per shard, read without unpacking it whole.

A wavelet matrix keeps one bit plane for each bit of the largest id, highest first.  A plane holds
that bit of every token in an order in which, plane after plane, tokens with a clear bit come before those with
a set one.  Counts of set bits before each block of 512 make rank and select short walks, so one token, the number
of times an id occurs in a range and the place of its n-th occurrence take a step per plane.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import by_bytes, dealt, texts, workers_import
from tidemark.llm.encoding import encoder
from tidemark.session import scratch_dir

MAGIC, VERSION = b"WMTX", 1
HEAD = struct.Struct("<4sHHQQ")
BLOCK = 512
#: Tokens at which a shard is closed; documents are never split between shards.
SHARD_TOKENS = 1 << 20
#: Documents of one range of ids, which one task encodes.
TASK_DOCUMENTS = 10_000
#: Texts that a task encodes at once.
TASK_BYTES = 4 << 20


class WaveletMatrix:
    """Rank, select and access over a sequence of ids."""

    def __init__(self, size: int, planes: list[np.ndarray]):
        self.size, self.planes = size, planes

    @cached_property
    def before(self) -> list[np.ndarray]:
        """Set bits before each block of each plane, and in all of it."""
        found = []
        for plane in self.planes:
            padded = np.zeros(-(-self.size // BLOCK) * BLOCK // 8, np.uint8)
            padded[: len(plane)] = plane
            ones = np.bitwise_count(padded).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.int64)
            found.append(np.concatenate([[0], np.cumsum(ones)]))
        return found

    @cached_property
    def zeros(self) -> list[int]:
        return [self.size - int(b[-1]) for b in self.before]

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        size, planes = len(ids), []
        width = int(ids.max()).bit_length() if size else 0
        now = ids.astype(np.uint16 if width <= 16 else np.uint32)
        for bit in reversed(range(width)):
            ones = (now & now.dtype.type(1 << bit)) != 0
            planes.append(np.packbits(ones, bitorder="little"))
            now = np.concatenate([now.take(np.flatnonzero(~ones)), now.take(np.flatnonzero(ones))])
        return cls(size, planes)

    def _bit(self, level: int, at: int) -> int:
        return int(self.planes[level][at >> 3]) >> (at & 7) & 1

    def _ones(self, level: int, at: int) -> int:
        """Set bits before place ``at``."""
        block = at // BLOCK
        tail = self.planes[level][block * BLOCK // 8:(at + 7) // 8]
        count = int(self.before[level][block]) + int(np.bitwise_count(tail).sum())
        return count - (int(tail[-1]) >> (at & 7)).bit_count() if at & 7 else count

    def _place(self, level: int, bit: int, n: int) -> int:
        """Place of the ``n``-th (from 0) bit of this value."""
        low, high = 0, self.size
        while low < high:
            middle = (low + high) // 2
            ones = self._ones(level, middle + 1)
            if (ones if bit else middle + 1 - ones) > n:
                high = middle
            else:
                low = middle + 1
        return low

    def access(self, at: int) -> int:
        if not 0 <= at < self.size:
            raise IndexError(at)
        value = 0
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, at), self._ones(level, at)
            at = self.zeros[level] + ones if bit else at - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        width = len(self.planes)
        if token < 0 or token >> width:
            return 0, 0
        for level in range(width):
            a, b = self._ones(level, start), self._ones(level, end)
            if token >> (width - 1 - level) & 1:
                start, end = self.zeros[level] + a, self.zeros[level] + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often ``token`` occurs from place ``start`` up to ``end``."""
        first, last = self._range(token, start, self.size if end is None else end)
        return last - first

    def rank(self, token: int, at: int) -> int:
        return self.count(token, 0, at)

    def select(self, token: int, n: int) -> int:
        """Place of the ``n``-th occurrence (from 0) of ``token``."""
        first, last = self._range(token, 0, self.size)
        if not 0 <= n < last - first:
            raise IndexError(n)
        at, width = first + n, len(self.planes)
        for level in reversed(range(width)):
            bit = token >> (width - 1 - level) & 1
            at = self._place(level, bit, at - self.zeros[level] if bit else at)
        return at

    def all(self) -> np.ndarray:
        """The whole sequence, rebuilt from the last plane to the first."""
        now = np.zeros(self.size, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for up, plane in enumerate(reversed(self.planes)):
            ones = np.unpackbits(plane, count=self.size, bitorder="little").view(bool)
            zeros, above = self.size - int(np.count_nonzero(ones)), np.empty_like(now)
            above[np.flatnonzero(~ones)] = now[:zeros]
            above[np.flatnonzero(ones)] = now[zeros:] | now.dtype.type(1 << up)
            now = above
        return now.astype("<u4")


def to_file(ids: np.ndarray, ends: np.ndarray) -> bytes:
    """The bytes of one shard: a head, the ends of its documents, its planes, each compressed by itself."""
    matrix, packer = WaveletMatrix.of(ids), zstandard.ZstdCompressor(1)
    blocks = [packer.compress(np.diff(ends, prepend=0).astype("<u4").tobytes())]
    blocks += [packer.compress(plane.tobytes()) for plane in matrix.planes]
    head = HEAD.pack(MAGIC, VERSION, len(matrix.planes), len(ids), len(ends))
    return head + struct.pack(f"<{len(blocks)}Q", *map(len, blocks)) + b"".join(blocks)


def from_file(data: bytes) -> tuple[WaveletMatrix, np.ndarray]:
    """The matrix and the ends of the documents in a shard."""
    magic, version, width, size, _ = HEAD.unpack_from(data)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a wavelet matrix shard")
    sizes = struct.unpack_from(f"<{width + 1}Q", data, HEAD.size)
    at, blocks, unpacker = HEAD.size + 8 * (width + 1), [], zstandard.ZstdDecompressor()
    for n in sizes:
        blocks.append(unpacker.decompress(data[at:at + n]))
        at += n
    ends = np.cumsum(np.frombuffer(blocks[0], "<u4"), dtype=np.int64)
    return WaveletMatrix(size, [np.frombuffer(b, np.uint8) for b in blocks[1:]]), ends


def write_shards(
    documents: DataFrame, folder: str, tokenizer: str, end_id: int = 2,
    shard_tokens: int = SHARD_TOKENS, task_documents: int = TASK_DOCUMENTS,
) -> None:
    """Write the ids of all texts, each with ``end_id``, to ``folder`` in ascending ``doc_id`` order (null first).

    Each Parquet file has one row: the place of the shard, its documents' ids and its bytes.  Documents
    are dealt to ranges of ids, so no task sees more than about ``task_documents`` of them, and a task holds one
    open shard.  A null text is empty and is written as its end alone.  Repeated ids lie side by side,
    in an order that depends on their texts.
    """
    workers_import(documents.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, ids, held, n, size = encoder(tokenizer), [], [], 0, 0
        part = None

        def shard() -> pa.RecordBatch:
            nonlocal ids, held, n, size
            data = to_file(np.concatenate(ids), np.cumsum([len(x) for x in ids]))
            row = [[part], [n], [size], [held], [data]]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            ids, held, n, size = [], [], n + 1, 0
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds)], names=["part", "shard", "n_tokens", "doc_ids", "data"])

        for batch in by_bytes(batches, "text", TASK_BYTES):
            found, ends = library.encode_all(batch.column("text"))
            found = np.insert(found, ends, end_id)
            texts_ids = np.split(found, (ends + np.arange(1, len(ends) + 1))[:-1])
            for part, doc_id, own in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id")), texts_ids):
                ids.append(own)
                held.append(doc_id)
                size += len(own)
                if size >= shard_tokens:
                    yield shard()
            # Arrow would keep the memory of the largest cut for the worker's life
            pa.default_memory_pool().release_unused()
        if ids:
            yield shard()

    ranges = dealt(documents.count(), task_documents)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    ordered = texts(documents).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    ordered = ordered.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    shards = ordered.mapInArrow(run, "part int, shard int, n_tokens long, doc_ids array<long>, data binary")
    shards.write.option("maxRecordsPerFile", 1).option("compression", "uncompressed").parquet(folder)


def read_shards(spark, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in ``folder``, from the bytes of its shards."""
    workers_import(spark)
    shards = spark.read.schema("part int, shard int, n_tokens long, doc_ids array<long>, data binary").parquet(folder)
    # one row per shard: the tokens of all shards before it
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("part", "shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, doc_ids, data in zip(*(batch.column(c).to_pylist() for c in ("start", "doc_ids", "data"))):
                matrix, ends = from_file(data)
                ids, at = matrix.all().tobytes(), [0, *ends.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()), pa.array([start + a for a in at[:-1]], pa.int64()),
                        pa.array(np.diff(at), pa.int64()), pa.array([ids[4 * a:4 * b] for a, b in zip(at, at[1:])], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    whole = shards.join(starts, ["part", "shard"]).select("start", "doc_ids", "data")
    return whole.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(documents: DataFrame, tokenizer: str, end_id: int = 2, **options) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document as :func:`write_shards` wrote it."""
    spark = documents.sparkSession
    folder = scratch_dir(spark, "shards")
    write_shards(documents, folder, tokenizer, end_id, **options)
    return read_shards(spark, folder)
