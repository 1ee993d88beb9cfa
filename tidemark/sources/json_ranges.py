"""Raw JSON files of any size and kind, arrays included, read in byte ranges by many tasks.

A file is read in ranges that end at a closing brace.  A first pass tells for each range how it changes the depth of
brackets, both if it begins inside a string and if not, and how many quotes it has.  Running sums over the ranges of a
file then give the true state at each beginning, and a second pass cuts an array's elements at its commas.
Elements that reach over the end of a range leave it in pieces, which are put together by file.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.session import scratch_dir
from tidemark.sources.json_files import lines, split_records

#: Escaped characters, quotes, brackets and commas, for the second pass; braces end a chunk, so the first needs no escaped ones.
_MARKS_AND_COMMAS = re.compile(rb'\\.|["\[\]{},]', re.S)
_ESCAPED = re.compile(rb"\\[^}]", re.S)
#: A comma and all of an object but its last brace, with nothing nested in it and no escapes.
_PLAIN = re.compile(rb'[ \t\r\n]*,([^"\\\[\]{},]*\{[^"\\\[\]{}]*(?:"[^"\\]*"[^"\\\[\]{}]*)*)')
_BLANK = b" \t\r\n"
_BOM = b"\xef\xbb\xbf"
#: The states of all ranges of a batch are sent to every task: some 200 bytes each.
MOST_RANGES = 200_000

_SUMMARY = "file string, start long, quotes int, outside int, inside int, first string, first_is_record boolean, several_lines boolean, last string"
_ELEMENTS = "file string, start long, place int, text string"


def _ranges(spark: SparkSession, paths: list[str]) -> DataFrame:
    texts = spark.read.option("lineSep", "}").text(paths)
    return texts.select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _runs(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[tuple[tuple, list[bytes]]]:
    """The ranges of a task with chunks of each in order, some at a time; a brace has been cut off each chunk."""
    names = ("file", "start", *more)
    for batch in batches:
        if not batch.num_rows:
            continue
        files = batch.column("file").dictionary_encode().indices.to_numpy()
        starts = batch.column("start").to_numpy()
        edges = np.flatnonzero((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])) + 1
        values = batch.column("value").to_pylist()
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
            yield tuple(batch.column(c)[a].as_py() for c in names), values[a:b]


def _ranges_of(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[tuple[tuple, Iterator[list[bytes]]]]:
    for key, found in groupby(_runs(batches, *more), lambda run: run[0]):
        yield key, (run[1] for run in found)


def _balance(data: bytes) -> int:
    return data.count(b"{") + data.count(b"[") - data.count(b"}") - data.count(b"]")


def _is_record(line: bytes) -> bool:
    try:
        return isinstance(json.loads(line), dict)
    except ValueError:
        return False


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (file, start), runs in _ranges_of(batches):
        quotes, delta, last = 0, [0, 0], b""
        first, line, several = b"", b"", None
        for chunks in runs:
            if start == 0 and several is None:
                for chunk in chunks:
                    # the beginning of the file, up to its second line; an array needs no more than its bracket
                    line = (line + chunk + b"}").lstrip(_BLANK + _BOM)
                    first = first or line[:1]
                    head, *rest = line.split(b"\n", 1)
                    if rest and rest[0].strip(_BLANK + b"}"):
                        line, several = head, True
                    elif first == b"[":
                        several = False
                    if several is not None:
                        break
            data = b"}".join(chunks) + b"}"
            if b"\\" in data:
                data = _ESCAPED.sub(b"", data)
            parts = data.split(b'"')
            delta[quotes] += _balance(b"".join(parts[0::2]))
            delta[1 - quotes] += _balance(b"".join(parts[1::2]))
            quotes ^= (len(parts) - 1) & 1
            last = chunks[-1].rstrip(_BLANK)[-1:]
        # of a short file the added brace may be too much
        whole = _is_record(line) or _is_record(line.rstrip(_BLANK)[:-1])
        row = [file, start, quotes, *delta, first.decode("utf-8", "replace"), whole, bool(several), last.decode("utf-8", "replace")]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in zip(row, (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.bool_(), pa.string()))],
            [c.split()[0] for c in _SUMMARY.split(", ")])


def range_states(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file, start, in_string, depth``: how each range begins, and ``kind, last_range`` of the file.

    ``array``  a closed array, which can be cut;
    ``whole``  a broken array, or text of a single range whose first line alone is no record;
    ``lines``  anything else.
    """
    found = _ranges(spark, paths).mapInArrow(_summarise, _SUMMARY)
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    of_file = Window.partitionBy("file")
    states = found.withColumn("in_string", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    states = states.withColumn("change", F.when(F.col("in_string") == 0, F.col("outside")).otherwise(F.col("inside")))
    states = states.withColumns({
        "depth": F.coalesce(F.sum("change").over(before), F.lit(0)),
        "last_range": F.col("start") == F.max("start").over(of_file),
        "ranges": F.count(F.lit(1)).over(of_file),
        "first": F.max(F.when(F.col("start") == 0, F.col("first"))).over(of_file),
        "alone": F.max(F.when(F.col("start") == 0, F.col("first_is_record") | ~F.col("several_lines"))).over(of_file),
        "end": F.max_by("last", "start").over(of_file),
        # the brace added to the last chunk was none
        "left": F.sum("change").over(of_file) + 1,
        "open": F.sum("quotes").over(of_file) % 2,
    })
    closed = (F.col("end") == "]") & (F.col("left") == 0) & (F.col("open") == 0)
    kind = (
        F.when((F.col("first") == "[") & closed, "array").when(F.col("first") == "[", "whole")
        .when((F.col("ranges") == 1) & ~F.col("alone"), "whole").otherwise("lines"))
    return states.select("file", "start", "in_string", "depth", kind.alias("kind"), "last_range")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements of arrays; pieces of those that reach over a range's end have a place, 0 before whole ones and 1 after."""
    rows, size = [], 0

    def batch() -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int32(), pa.binary()))]
        columns[3] = columns[3].cast(pa.string())
        return pa.RecordBatch.from_arrays(columns, ["file", "start", "place", "text"])

    for (file, start, in_string, depth, last_range), runs in _ranges_of(batches, "in_string", "depth", "last_range"):
        chunks = (chunk for run in runs for chunk in run)
        # what is read before the array's bracket is dropped; later ranges begin within an element
        held, inherited, chunk = [], start > 0, next(chunks)
        while chunk is not None:
            following = next(chunks, None)
            if depth == 1 and not in_string and not inherited and following is not None and (plain := _PLAIN.fullmatch(chunk)):
                # the comma ends what is held, the next one what this adds
                held.append(chunk[:plain.start(1) - 1])
                text = b"".join(held).strip(_BLANK)
                if text:
                    rows.append((None, None, None, text))
                    size += len(text)
                held = [plain.group(1) + b"}"]
                chunk = following
                if size >= 8 << 20:
                    yield batch()
                    rows, size = [], 0
                continue
            data = chunk if following is None and last_range else chunk + b"}"
            at = 0
            for mark in _MARKS_AND_COMMAS.finditer(data):
                sign = mark.group()
                if sign == b'"':
                    in_string ^= 1
                elif in_string or sign[:1] == b"\\":
                    continue
                elif sign in b"[{":
                    depth += 1
                    if depth == 1:
                        at = mark.end()
                elif sign != b"," or depth == 1:
                    depth -= sign != b","
                    if depth == 0 or sign == b",":
                        held.append(data[at:mark.start()])
                        text = b"".join(held).strip(_BLANK)
                        if inherited or text:
                            rows.append((file, start, 0 if inherited else None, text if not inherited else b"".join(held)))
                            size += len(text)
                        held, inherited, at = [], False, mark.end()
            if depth:
                held.append(data[at:])
            chunk = following
            if size >= 8 << 20:
                yield batch()
                rows, size = [], 0
        if held and depth:
            rows.append((file, start, 0 if inherited else 1, b"".join(held)))
            size += len(rows[-1][3])
    if rows:
        yield batch()


def array_elements(spark: SparkSession, paths: list[str], states: DataFrame, folder: str) -> DataFrame:
    """``record`` for each element of the array files, as text; elements are written to ``folder`` in between."""
    known = states.filter("kind = 'array'").select("file", "start", "in_string", "depth", "last_range")
    cut = _ranges(spark, paths).join(F.broadcast(known), ["file", "start"]).mapInArrow(_cut, _ELEMENTS)
    cut.write.parquet(folder)
    cut = spark.read.schema(_ELEMENTS).parquet(folder)
    # a piece at the end of a range begins an element, the following ones go on with it
    order = Window.partitionBy("file").orderBy("start", "place")
    pieces = cut.filter("place IS NOT NULL").withColumn("chain", F.sum("place").over(order))
    whole = pieces.groupBy("file", "chain").agg(F.array_sort(F.collect_list(F.struct("start", "place", "text"))).alias("all"))
    joined = whole.select(F.trim(F.array_join(F.col("all.text"), "")).alias("text")).filter("text <> ''")
    texts = cut.filter("place IS NULL").select("text").unionByName(joined)
    # as Spark gives the elements of an array: texts without quotes, nested arrays without blanks; an object is parsed later
    element = F.from_json(F.concat(F.lit("["), "text", F.lit("]")), "array<string>")
    other = F.when(element.isNull(), F.col("text")).otherwise(F.coalesce(F.get(element, F.lit(0)), F.lit("null")))
    return texts.select(F.when(F.startswith("text", F.lit("{")), F.col("text")).otherwise(other).alias("record"))


def read_records(spark: SparkSession, paths: list[str], folder: str | None = None) -> DataFrame:
    """``record`` for each record of JSON files, whatever each file holds: an array, one object, or a record a line.

    Arrays and lines are split among tasks.  An array that is not closed counts as one unreadable record, like any text
    that is no record; an element that cannot be read is one on its own.  Works in ``folder``, below the shared one.
    """
    folder = folder or scratch_dir(spark, "ranges")
    if not paths:
        return spark.createDataFrame([], "record string")
    range_states(spark, paths).write.parquet(f"{folder}/states")
    states = spark.read.parquet(f"{folder}/states")
    if states.count() > MOST_RANGES:
        raise ValueError(f"more than {MOST_RANGES} ranges at once: set maxFilesPerTrigger or maxBytesPerTrigger")
    by_kind = {}
    for row in states.select("file", "kind").distinct().collect():
        by_kind.setdefault(row["kind"], []).append(unquote(row["file"]))
    records = spark.createDataFrame([], "record string")
    if "array" in by_kind:
        records = records.unionByName(array_elements(spark, by_kind["array"], states, f"{folder}/elements"))
    if "lines" in by_kind:
        records = records.unionByName(lines(spark.read.text(by_kind["lines"]), "value"))
    if "whole" in by_kind:
        records = records.unionByName(split_records(spark.read.text(by_kind["whole"], wholetext=True), "value"))
    return records
