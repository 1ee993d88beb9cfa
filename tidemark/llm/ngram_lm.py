"""Trigram scores of documents from Elias-Fano tries, one for each share of the middle words.

Documents are cut into blocks that a task works on at once; blocks and shares send each other packed
messages, which Spark partitions, shuffles and sorts:

1. A block asks for its distinct words, with their counts in training documents.  A word share adds the counts
   up, numbers its words from frequent to rare and answers with numbers and counts.
2. A block turns its texts into numbers and sends each trigram to the share of its middle word.  Middle words
   that are too frequent for one share are spread by last word; what follows them is summed by Spark first.
3. A trigram share builds its trie from training trigrams, writes it to a temporary file, maps that into
   memory, looks all trigrams up, and answers with the logarithms summed by document, as whole numbers.
4. A block adds the sums up.

Every step holds one block, one message or one share at a time, and the numbers of shares follow the size of the input.
"""

from __future__ import annotations

import struct
import tempfile
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import dealt, workers_import
from tidemark.llm.elias_fano import build, mapped, places
from tidemark.session import keep

#: A block ends with the document that brings it to this many words.
BLOCK_WORDS = 1 << 19
#: Bytes of text for each share of words and of trigrams, half a million distinct words and a million trigrams.
WORD_SHARE, TRIGRAM_SHARE = 32 << 20, 5 << 20
#: A middle word with more training occurrences than this is spread over several shares.
HOT = 2 << 20
#: A trie ends with the middle word that brings it to this many trigrams; so many are looked up at a time.
TRIE = 1 << 17
DISCOUNT = 0.75
#: Sums of logarithms are counted in units of 1 / UNIT.
UNIT = 1024
#: Counts up to here are sent as they are, larger ones in steps of a logarithm.
EXACT_COUNT, COUNT_STEP = 1 << 15, 1e-3

BEGIN, END, FIRST_WORD = 0, 1, 2

_MESSAGE = "to long, kind int, sender long, mark long, a binary, x long, y long, n long, m long"
_NAMES = ["to", "kind", "sender", "mark", "a", "x", "y", "n", "m"]
_ARROW = pa.schema([(c, pa.int32() if c == "kind" else pa.binary() if c == "a" else pa.int64()) for c in _NAMES])
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


# messages

def pack(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Arrays of whole numbers in few bytes: one plane for each byte of a number, compressed."""
    head, planes = [struct.pack("<B", len(arrays))], []
    for x in arrays:
        x = np.ascontiguousarray(x)
        head.append(struct.pack("<3sq", x.dtype.str.encode(), len(x)))
        planes.append(x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes())
    return b"".join(head) + zstandard.ZstdCompressor(level).compress(b"".join(planes))


def unpack(blob: bytes) -> list[np.ndarray]:
    count, at, shapes = blob[0], 1, []
    for _ in range(count):
        kind, n = struct.unpack_from("<3sq", blob, at)
        shapes.append((np.dtype(kind.decode()), n))
        at += struct.calcsize("<3sq")
    planes, at, found = zstandard.ZstdDecompressor().decompress(blob[at:]), 0, []
    for kind, n in shapes:
        size = kind.itemsize * n
        x = np.frombuffer(planes, np.uint8, size, at).reshape(kind.itemsize, n).T
        found.append(np.ascontiguousarray(x).view(kind).ravel())
        at += size
    return found


def _message(to: int, kind: int, sender: int, a: bytes | None = None, mark: int = 0, x: int = 0, y: int = 0, n: int = 0, m: int = 0) -> tuple:
    return to, kind, sender, mark, a, x, y, n, m


def _batches(messages: Iterator[tuple], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for message in messages:
        held.append(message)
        size += 64 + len(message[4] or b"")
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), _ARROW)], schema=_ARROW)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), _ARROW)], schema=_ARROW)


def _received(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[dict]]]:
    """Receivers and their messages, which come sorted."""
    rows = (row for batch in batches for row in batch.to_pylist())
    return groupby(rows, lambda row: row["to"])


def _delivered(messages: DataFrame, receivers: int) -> DataFrame:
    return messages.repartition(max(1, receivers), "to").sortWithinPartitions("to", "kind", "sender")


def _mixed(x: np.ndarray) -> np.ndarray:
    """A hash of whole numbers that spreads neighbours."""
    x = np.asarray(x, np.int64).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(1)).astype(np.int64)


def _smallest(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int32) if not len(x) or x.max() < 1 << 31 else x


# blocks

def _words(texts: list[bytes]) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Words of each text, and all words, A to Z in lower case."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    octets = np.frombuffer(b" ".join([*texts, b""]).lower(), np.uint8)
    inner = (octets != 32) & ((octets < 9) | (octets > 13))
    turns = np.diff(inner.view(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    lengths = np.diff(np.searchsorted(starts, np.cumsum(sizes)), prepend=0)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    letters = octets[inner]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return lengths, words.dictionary_encode()


class _Block:
    """Whole documents as places in a list of their distinct words, from frequent to rare."""

    def __init__(self, number: int, ids: list, held: list, texts: list[bytes], shares: int) -> None:
        self.number, self.ids = number, ids
        self.held = np.array(held, bool)
        self.lengths, coded = _words(texts)
        found, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        order = np.argsort(-np.bincount(found, minlength=len(distinct)), kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        self.words, self.tokens = [distinct[i] for i in order.tolist()], place[found]
        share = np.fromiter(map(zlib.crc32, self.words), np.int64, len(distinct)) % shares
        #: Places of the words that each share is asked for, share by share, and where each share's begin.
        self.asked = np.argsort(share, kind="stable")
        self.cuts = np.searchsorted(share[self.asked], np.arange(shares + 1))
        self.share = _smallest(share)
        self.mark = zlib.crc32(b" ".join(self.words), zlib.crc32(self.lengths.tobytes()))


def _blocks(batches: Iterator[pa.RecordBatch], shares: int, most: int) -> Iterator[_Block]:
    number, words, ids, held, texts = None, 0, [], [], []
    for batch in batches:
        if number is None and batch.num_rows:
            number = batch["part"][0].as_py() << 32
        for doc_id, out, text in zip(batch["doc_id"].to_pylist(), batch["held_out"].to_pylist(), batch["text"]):
            ids.append(doc_id)
            held.append(out)
            texts.append(text.as_py())
            words += len(texts[-1]) // 6 + 1  # of bytes, so that blocks follow from the documents alone
            if words >= most:
                yield _Block(number, ids, held, texts, shares)
                number, words, ids, held, texts = number + 1, 0, [], [], []
    if ids:
        yield _Block(number, ids, held, texts, shares)


def _ask_words(shares: int, most: int):
    def asked(block: _Block) -> Iterator[tuple]:
        counts = np.bincount(block.tokens[np.repeat(~block.held, block.lengths)], minlength=len(block.words))
        for share in np.flatnonzero(np.diff(block.cuts)).tolist():
            own = block.asked[block.cuts[share]: block.cuts[share + 1]]
            words = b" ".join([block.words[i] for i in own.tolist()])
            yield _message(share, 0, block.number, pack(np.frombuffer(words, np.uint8), _smallest(counts[own]), level=5), block.mark)

    return lambda batches: _batches(m for block in _blocks(batches, shares, most) for m in asked(block))


def _number_words(shares: int):
    """Answers each block with the numbers and counts of the words it asked for; in between its questions wait on disk."""
    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for share, messages in _received(batches):
            total: dict[bytes, int] = {}
            with tempfile.TemporaryFile() as waiting:
                sizes = []
                for row in messages:
                    text, counts = unpack(row["a"])
                    words = text.tobytes().split(b" ")
                    for word, n in zip(words, counts.tolist()):
                        total[word] = total.get(word, 0) + n
                    waiting.write(row["a"])
                    sizes.append((len(row["a"]), row["sender"], row["mark"]))
                ordered = sorted(total, key=lambda w: (-total[w], w))
                counts = np.array([total[w] for w in ordered], np.int64)
                place = {w: i for i, w in enumerate(ordered)}
                del total, ordered
                yield _message(-1, 1, share, n=int((counts > 0).sum()), m=int(counts.sum()))
                waiting.seek(0)
                for size, sender, mark in sizes:
                    words = unpack(waiting.read(size))[0].tobytes().split(b" ")
                    at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
                    yield _message(sender, 0, share, pack(_smallest(at * shares + share + FIRST_WORD), _smallest(counts[at])), mark)

    return lambda batches: _batches(answered(batches))


def _payload(shares: int, most: int):
    """Each block, for itself: ids, held-out marks, lengths and words by place."""
    def packed(block: _Block) -> tuple:
        missing = np.array([x is None for x in block.ids], np.uint8)
        ids = np.array([x or 0 for x in block.ids], np.int64)
        blob = pack(ids, missing, block.held.astype(np.uint8), block.lengths, block.tokens, block.share)
        return _message(block.number, 1, -1, blob, block.mark)

    return lambda batches: _batches(packed(block) for block in _blocks(batches, shares, most))


class _Corpus:
    """What all blocks need to know of the training documents: a few numbers."""

    def __init__(self, docs: int, words: int, kinds: int, shares: int, hot: int) -> None:
        self.docs, self.shares, self.hot = docs, shares, hot
        self.tokens, self.kinds = words + docs, kinds + (docs > 0)
        self.outcomes = self.tokens + self.kinds + 1


def _answer_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Puts what a block's words were answered into the block."""
    def found() -> Iterator[tuple]:
        for number, messages in _received(batches):
            *answers, payload = messages
            if any(row["mark"] != payload["mark"] for row in answers):
                raise RuntimeError("the documents came in another order when they were read again")
            *rest, share = unpack(payload["a"])
            numbers, counts = np.empty(len(share), np.int64), np.empty(len(share), np.int64)
            for row in answers:
                own = np.flatnonzero(share == row["sender"])
                numbers[own], counts[own] = unpack(row["a"])
            yield _message(number, 1, -1, pack(*rest, _smallest(numbers), _smallest(counts)))

    return _batches(found())


class _Numbered:
    """A block with numbered words: arrays of one place for each token, ends included."""

    def __init__(self, row: dict, corpus: _Corpus) -> None:
        self.ids, self.missing, held, lengths, tokens, numbers, counts = unpack(row["a"])
        docs, ends = len(lengths), np.cumsum(lengths + 1) - 1
        self.held, self.lengths = held.astype(bool), lengths + 1
        self.doc = np.repeat(np.arange(docs), self.lengths)
        # two more words: the end and the beginning of a text
        end, begin = len(numbers), len(numbers) + 1
        self.number = np.concatenate([numbers.astype(np.int64), [END, BEGIN]])
        self.count = np.concatenate([counts.astype(np.int64), [corpus.docs, corpus.docs]])
        self.last = np.full(len(self.doc), end, np.int64)
        inner = np.ones(len(self.doc), bool)
        inner[ends] = False
        self.last[inner] = tokens
        starts = ends - self.lengths + 1
        self.middle = np.roll(self.last, 1)
        self.middle[starts] = begin
        self.first = np.roll(self.middle, 1)
        self.first[starts] = begin
        mixed, spread = _mixed(self.number), self.count // corpus.hot + 1
        self.to = mixed[self.middle] % corpus.shares
        self.hot = np.flatnonzero(spread[self.middle] > 1)
        middle = self.middle[self.hot]
        self.to[self.hot] = (mixed[middle] + mixed[self.last[self.hot]] % spread[middle]) % corpus.shares
        base = np.log10((self.count + 1) / corpus.outcomes)[self.last]
        self.base, self.known = np.add.reduceat(base, starts), np.add.reduceat((self.count > 0).astype(np.int64)[self.last], starts)


def _coded(count: np.ndarray) -> np.ndarray:
    steep = EXACT_COUNT + np.log(np.maximum(count, EXACT_COUNT) / EXACT_COUNT) / COUNT_STEP
    return np.where(count < EXACT_COUNT, count, np.round(steep)).astype(np.uint16)


def _decoded(code: np.ndarray) -> np.ndarray:
    code = code.astype(np.int64)
    return np.where(code < EXACT_COUNT, code, EXACT_COUNT * np.exp((code - EXACT_COUNT) * COUNT_STEP))


def _send_trigrams(corpus: _Corpus):
    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for number, messages in _received(batches):
            block = _Numbered(next(messages), corpus)
            head = pack(block.ids, block.missing, block.held.astype(np.uint8), block.lengths, block.known, block.base.view(np.int64))
            yield _message(-1 - number, 0, number, head)
            order = np.argsort(block.to * len(block.number) + block.middle, kind="stable")
            cuts = np.searchsorted(block.to[order], np.arange(corpus.shares + 1))
            numbers, code, mark = _smallest(block.number), _coded(block.count), (block.doc * 2 + block.held[block.doc]).astype(np.int32)
            for share in np.flatnonzero(np.diff(cuts)).tolist():
                own = order[cuts[share]: cuts[share + 1]]
                middle = block.middle[own]
                start = np.concatenate([[0], np.flatnonzero(np.diff(middle)) + 1])
                run = np.diff(np.append(start, len(own)))
                last = block.last[own]
                # documents rise within a middle word: steps are small
                steps = np.diff(mark[own], prepend=np.int32(0))
                steps[start] = mark[own][start]
                yield _message(share, 1, number, pack(
                    numbers[middle[start]], run.astype(np.int32), numbers[block.first[own]], numbers[last], steps, code[last]))

    return lambda batches: _batches(sent(batches))


def _hot_trigrams(corpus: _Corpus):
    """Trigrams of middle words that are spread: ``middle, first, last, to`` and how often training documents have them."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, messages in _received(batches):
            block = _Numbered(next(messages), corpus)
            own, words = block.hot, len(block.number)
            pair, of = np.unique(block.middle[own] * words + block.first[own], return_inverse=True)
            whole, at, back = np.unique(of * words + block.last[own], return_index=True, return_inverse=True)
            n = np.bincount(back, weights=~block.held[block.doc[own]], minlength=len(whole)).astype(np.int64)
            columns = [*(block.number[x[own][at]] for x in (block.middle, block.first, block.last)), block.to[own][at], n]
            for start in range(0, len(whole), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[start: start + 100_000]) for c in columns], ["x", "y", "z", "to", "n"])

    return found


def _raised(steps: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Sums of ``steps`` that start anew with each run."""
    total = np.cumsum(steps, dtype=np.int64)
    start = np.cumsum(run) - run
    return total - np.repeat(total[start] - steps[start], run)


def _units(
    first: np.ndarray, middle: np.ndarray, last: np.ndarray, training: np.ndarray, code: np.ndarray,
    spread: np.ndarray, corpus: _Corpus, discount: float,
) -> np.ndarray:
    """Minus the logarithm of each trigram's probability, in units, from a trie for each range of middle words."""
    order = np.argsort(middle, kind="stable")
    ranked, found = middle[order], np.empty(len(order), np.int64)
    start = 0
    while start < len(order):
        end = int(np.searchsorted(ranked, ranked[min(start + TRIE, len(order)) - 1], "right"))
        own = order[start:end]
        totals = spread[(spread[:, 0] >= ranked[start]) & (spread[:, 0] <= ranked[end - 1])]
        ids, (*trigrams, _, _) = places(first[own], ranked[start:end], last[own], totals[:, 0], totals[:, 1][totals[:, 1] >= 0])
        learn = training[own]
        trie = mapped(build(ids, *(x[learn] for x in trigrams), totals, discount)) if learn.any() or len(totals) else None
        for at in range(0, len(own), TRIE):
            part = slice(at, at + TRIE)
            chance = (_decoded(code[own[part]]) + 1) / corpus.outcomes
            if trie:
                chance = trie.probability(ids, *(x[part] for x in trigrams), chance)
            found[own[part]] = np.round(-np.log10(np.minimum(chance, 1.0)) * UNIT)
        start = end
    return found


def _score(corpus: _Corpus, discount: float):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for to, messages in _received(batches):
            if to < 0:
                yield from (_message(-1 - to, 0, -1, row["a"]) for row in messages)
                continue
            spread, parts, senders = [], [], []
            for row in messages:
                if row["kind"] == 0:
                    spread.append((row["x"], row["y"], row["n"], row["m"]))
                else:
                    parts.append(unpack(row["a"]))
                    senders.append(row["sender"])
            if not parts:
                continue
            ends = np.cumsum([len(p[2]) for p in parts])
            middle = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
            first, last, code = (np.concatenate([p[i] for p in parts]) for i in (2, 3, 5))
            mark = np.concatenate([_raised(p[4], p[1]) for p in parts])
            del parts
            units = _units(first, middle, last, mark % 2 == 0, code, np.array(spread, np.int64).reshape(-1, 4), corpus, discount)
            start = 0
            for sender, end in zip(senders, ends.tolist()):
                doc = mark[start:end] >> 1
                sums = np.bincount(doc, weights=units[start:end]).astype(np.int64)
                docs = np.flatnonzero(np.bincount(doc))
                steps = np.diff(docs, prepend=0)
                yield _message(sender, 1, to, pack(_smallest(steps), _smallest(sums[docs])))
                start = end

    return lambda batches: _batches(scored(batches))


def _add_up(corpus: _Corpus):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, messages in _received(batches):
            head = unpack(next(messages)["a"])
            ids, missing, held, lengths, known, base = head
            units = np.zeros(len(ids), np.int64)
            for row in messages:
                steps, sums = unpack(row["a"])
                units[np.cumsum(steps)] += sums
            train = np.full(len(ids), corpus.tokens, np.int64)
            columns = [
                pa.array(ids, mask=missing.astype(bool)), pa.array(held.astype(bool)), pa.array(lengths), pa.array(known),
                pa.array(train), pa.array(base.view(np.float64)), pa.array(0.0 - units / UNIT)]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SCORES.split(", ")])

    return found


def scores(
    documents: DataFrame, discount: float = DISCOUNT, folds: int = 7, fold: int = 2,
    block_words: int = BLOCK_WORDS, word_share: int = WORD_SHARE, trigram_share: int = TRIGRAM_SHARE, hot: int = HOT,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    Tokens are words, A to Z in lower case, and one end a document; null texts are empty.  Documents whose
    ``crc32(doc_id as text) mod folds`` is ``fold`` are held out, the others are learned from; a null id counts as ''.
    ``base_score`` adds up logarithms of add-one unigrams.  ``score`` is the logarithm to base 10 of the text's
    probability under an interpolated trigram model with absolute discounting, whose probabilities add up to 1 in any
    context but for their coding in eight bits.  Rows that repeat are scored each; without training documents every score is the
    base.  Other columns are not read.  Blocks hold whole documents, so one document should fit a task's memory.
    """
    spark = documents.sparkSession
    workers_import(spark)
    known = F.crc32(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).cast("binary")) % folds
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), (known == fold).alias("held_out"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
        F.spark_partition_id().alias("part"))
    size = rows.agg(F.sum(F.octet_length("text")), F.sum((~F.col("held_out")).cast("long")), F.count(F.lit(1))).first()
    if not size[2]:
        return spark.createDataFrame([], _SCORES)
    word_shares, shares = dealt(size[0], word_share), dealt(size[0], trigram_share)

    tasks = dealt(size[0], 4 * trigram_share)
    asked = _delivered(rows.mapInArrow(_ask_words(word_shares, block_words), _MESSAGE), word_shares)
    answers = keep(asked.mapInArrow(_number_words(word_shares), _MESSAGE), "numbers")
    kinds, occurrences = answers.filter("to < 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("m"), F.lit(0))).first()
    corpus = _Corpus(size[1], occurrences, kinds, shares, hot)
    payload = rows.mapInArrow(_payload(word_shares, block_words), _MESSAGE)
    blocks = keep(_delivered(answers.filter("to >= 0").union(payload), tasks).mapInArrow(_answer_blocks, _MESSAGE), "blocks")
    sent = blocks.mapInArrow(_send_trigrams(corpus), _MESSAGE)
    if occurrences + corpus.docs > hot:
        sent = sent.unionByName(_spread_totals(blocks, corpus))
    scored = _delivered(sent, dealt(shares, 2)).mapInArrow(_score(corpus, discount), _MESSAGE)
    return _delivered(scored, tasks).mapInArrow(_add_up(corpus), _SCORES)


def _spread_totals(blocks: DataFrame, corpus: _Corpus) -> DataFrame:
    """Messages to the shares of spread middle words: occurrences and kinds of what follows them and their pairs."""
    hot = keep(
        blocks.mapInArrow(_hot_trigrams(corpus), "x long, y long, z long, to long, n long")
        .groupBy("x", "y", "z", "to").agg(F.sum("n").alias("n")), "hot")
    trained = hot.filter("n > 0")
    pairs = trained.groupBy("x", "y").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("m"))
    pairs = hot.select("to", "x", "y").distinct().join(pairs, ["x", "y"])
    after = trained.groupBy("x", "z").agg(F.sum("n").alias("n")).groupBy("x").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("m"))
    after = hot.select("to", "x").distinct().join(after, "x").withColumn("y", F.lit(-1).cast("long"))
    empty = [F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("sender"), F.lit(0).cast("long").alias("mark"), F.lit(None).cast("binary").alias("a")]
    return pairs.unionByName(after).select("to", *empty, "x", "y", "n", "m").select(_NAMES)
