"""Near duplicates by SimHash, found through deletion variants of fingerprint segments.

Up to ``bits`` differing bits over ``bits // 2 + 1`` segments leave one segment with at most one of them.
Two segments differ in at most one bit exactly when they agree after the same bit is wiped out in
both, so each distinct fingerprint is indexed under all its segments with one bit wiped: 64 keys.
Fingerprints that share a key are compared in full.  A task compares a key's members in memory and hands on
a spanning forest of the links it finds, never the pairs themselves; a key with more members than a task
should compare is cut into chunks, and pairs of chunks are dealt to tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import dealt, small, texts, workers_import
from tidemark.llm.components import components, forest
from tidemark.llm.encoding import release
from tidemark.llm.exact_dedup import without
from tidemark.session import keep

#: Index rows a task handles, and members of a key that one task compares.
TASK_ROWS, KEY_MEMBERS = 1 << 20, 20_000
SEED = 42
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str, shingle: int = 4) -> int:
    """The unsigned 64-bit SimHash of all word shingles, repeats included; 0 without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined, ends, at = b" ".join(words), [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    size = min(shingle, len(words))
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(starts, ends[size - 1:])], "<u8")
    octets = hashes.view(np.uint8).reshape(-1, 8)
    if len(hashes) < 400:
        ones = np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(octets[:, j], minlength=256) @ _BITS for j in range(8)])
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _sha() -> Column:
    return F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))


def fingerprints(documents: DataFrame, shingle: int = 4, sha: bool = False) -> DataFrame:
    """``doc_id, fp`` of every row, the fingerprint as a signed long; with ``sha`` also the SHA-256 of its text."""
    workers_import(documents.sparkSession)
    more = ["sha"] if sha else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in small(batches):
            found = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
            columns = [batch.column("doc_id"), pa.array(found.view(np.int64)), *map(batch.column, more)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp", *more])

    read = texts(documents, *(_sha().alias(c) for c in more))
    return read.mapInArrow(run, "doc_id long, fp long" + ", sha binary" * sha)


def segments(bits: int) -> list[tuple[int, int]]:
    """First bit and width of each segment; one of them has at most one of ``bits`` differing bits."""
    n = max(2, bits // 2 + 1)
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def wildcard_index(prints: DataFrame, bits: int) -> DataFrame:
    """``key, fp``: each fingerprint under every segment with one bit wiped out.

    A key is the number of the wiped bit, which tells the segment, above what is left of the segment.
    """
    keys = []
    for first, width in segments(bits):
        part = F.shiftrightunsigned("fp", first).bitwiseAND((1 << width) - 1)
        keys += [F.lit(first + bit << 32) + part.bitwiseAND(~(1 << bit)) for bit in range(width)]
    return prints.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _links(key: np.ndarray, fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between members of equal ``key``, which is sorted."""
    at, step = np.arange(len(key)), 1
    a, b, held = [], [], 0
    while len(at):
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        near = at[np.bitwise_count((fp[at] ^ fp[at + step]).view(np.uint64)) <= bits]
        a.append(fp[near])
        b.append(fp[near + step])
        held += len(near)
        if held > 1 << 21:
            x, y = forest(np.concatenate(a), np.concatenate(b))
            a, b, held = [x], [y], len(x)
        step += 1
    return forest(np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])


def _compare(bits: int, members: int, task_rows: int):
    """Links of a partition's keys; members of keys too large for one task come back as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        large, key, fp, rows = np.empty(0, np.int64), [], [], 0

        def give(a, b, keys=None):
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.nulls(len(a), pa.int64()) if keys is None else pa.array(keys, pa.int64())],
                names=["a", "b", "large"],
            )

        def set_apart():
            """Move members of large keys out; what stays is in order of its keys."""
            nonlocal large, key, fp, rows
            keys, prints = np.concatenate(key), np.concatenate(fp)
            found, n = np.unique(keys, return_counts=True)
            large = np.union1d(large, found[n > members])
            out = np.isin(keys, large)
            moved = give(prints[out], prints[out], keys[out])
            order = np.argsort(keys[~out], kind="stable")
            key, fp = [keys[~out][order]], [prints[~out][order]]
            rows = len(order)
            return moved

        for batch in batches:
            key.append(batch.column("key").to_numpy())
            fp.append(batch.column("fp").to_numpy())
            rows += batch.num_rows
            if rows > 4 * task_rows:
                yield set_apart()
        if rows:
            yield set_apart()
            yield give(*_links(key[0], fp[0], bits))

    return run


def _compare_chunks(bits: int):
    """Links between the chunks of one pair of chunks of a large key."""

    def run(table: pa.Table) -> pa.Table:
        fp, side = table["fp"].to_numpy(), table["chunk"].to_numpy()
        left, right = fp[side == side.min()], fp[side == side.max()]
        a, b = [], []
        for i in range(0, len(left), 512):
            near = np.bitwise_count((left[i:i + 512, None] ^ right[None, :]).view(np.uint64)) <= bits
            x, y = np.nonzero(near)
            x, y = forest(left[i:i + 512][x], right[y])
            a.append(x)
            b.append(y)
        a, b = forest(np.concatenate(a), np.concatenate(b))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def near_links(prints: DataFrame, bits: int = 4, members: int = KEY_MEMBERS, task_rows: int = TASK_ROWS) -> DataFrame:
    """``a, b``: links between distinct fingerprints ``fp`` that join all that differ in at most ``bits`` bits.

    Not every such pair is a row, but each is connected by rows.
    """
    workers_import(prints.sparkSession)
    n = dealt(64 * prints.count(), task_rows)
    index = wildcard_index(prints, bits).repartition(n, "key")
    found = keep(index.mapInArrow(_compare(bits, members, task_rows), "a long, b long, large long"), "compared")
    links = found.filter("large is null").select("a", "b")
    large = found.filter("large is not null").select(F.col("large").alias("key"), F.col("a").alias("fp"))
    sizes = keep(large.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / members).alias("chunks")), "large")
    if sizes.count():
        cut = large.join(sizes, "key").withColumn("chunk", F.pmod(F.xxhash64("fp", F.lit(5)), F.col("chunks")))
        pairs = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).select(
            "key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "fp")
        links = links.union(pairs.groupBy("key", "i", "j").applyInArrow(_compare_chunks(bits), "a long, b long"))
    return links


def _classes(prints: DataFrame, bits: int, of: Column) -> DataFrame:
    """``class, lowest``: each distinct fingerprint and the smallest ``of`` among the rows of its component."""
    classes = keep(prints.groupBy("fp").agg(F.min(of).alias("first")), "classes")
    found = keep(components(near_links(classes.select("fp"), bits)), "components")
    joined = classes.join(found, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    joined = keep(joined, "rooted")
    lowest = keep(joined.groupBy("root").agg(F.min("first").alias("lowest")), "lowest").withColumnRenamed("root", "of")
    return keep(joined.join(lowest, F.col("root") == F.col("of")).select(F.col("fp").alias("class"), "lowest"), "of")


def near_duplicate_report(documents: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` the smallest ``doc_id`` that links of at
    most ``bits`` differing bits reach, null ids aside (null if there is no other).  A text without
    words, null or not, has fingerprint zero and links like any other; one with fewer words than a
    shingle is one shingle.  Repeated rows each get a row.  Other columns are not read.
    """
    prints = keep(fingerprints(documents, shingle), "fingerprints")
    of = _classes(prints, bits, F.col("doc_id")).withColumnRenamed("lowest", "component_id")
    return prints.join(of, F.col("fp") == F.col("class")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(documents: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """``documents`` with one document of each component: the one with the smallest ``doc_id``.

    Null ids come after all others; of texts with the same id the one with the smallest SHA-256 stays.  Only rows
    that repeat both the kept id and its text stay too (a null text counts as empty).  All columns come
    through unchanged.
    """
    prints = keep(fingerprints(documents, shingle, sha=True), "fingerprints")
    row = F.struct(F.col("doc_id").isNull(), "doc_id", "sha")
    of = _classes(prints, bits, row)
    lost = prints.join(of, F.col("fp") == F.col("class")).filter(~row.eqNullSafe(F.col("lowest")))
    return without(documents, lost.select("doc_id", "sha").distinct())
