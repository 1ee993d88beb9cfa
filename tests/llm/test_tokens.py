"""Token counts, packing and wavelet shards against the library."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import ROWS, clashing, documents, empty, rows_of
from tidemark.llm import packing, token_counts, wavelet
from tidemark.llm.common import by_bytes
from tidemark.llm.encoding import Encoder

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    "", " ", "a", " a", "a ", "a  b", "a   b", "a\n b", "a \nb", "a\n \nb", "a\tb", "\xa0x \xa0 y", "x\x1cy \x85z", "don't I'll 's 'S",
    "<|endoftext|>", "a <|endoftext|> b<|endoftext|>.", "<|startoftext|>x", "x-y, (z)!! %%% ### a|b <b>", "Straße GRÖSSE ẞ İI",
    "é ́x ﬁ Å", "日本語 テスト", "12 3.5 1a a1", "THE!! TO.\nNDANSH!! a.\n\nB", "x" * 300, "​ a b",
]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_pieces_give_the_ids_of_the_whole_text(path):
    own, library = Encoder(path, limit=40), Tokenizer.from_file(path)
    assert own.direct
    for _ in range(2):  # the second time from the cache
        for text in [*ODD, *(r[1] or "" for r in ROWS)]:
            ids = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(own.encode(text), "<u4").tolist() == ids, text
            assert own.count(text) == len(ids), text


def test_real_texts(spark):
    library = Tokenizer.from_file(BYTES)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()}
    found = token_counts.token_counts(docs, BYTES)
    assert {r.doc_id: r.n_tokens for r in found.collect()} == want


def test_counts(spark):
    library = Tokenizer.from_file(BYTES)
    want = []
    for doc_id, text, *_ in ROWS:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((doc_id, len((text or "").encode()), n, n > 512))
    assert rows_of(token_counts.token_counts(clashing(spark, "n_tokens", "piece"), BYTES)) == sorted(want, key=repr)
    assert token_counts.token_counts(empty(spark), BYTES).collect() == []


def test_the_frequent_table_changes_no_count(spark, monkeypatch):
    docs = documents(spark)
    monkeypatch.setattr(token_counts, "frequent_pieces", lambda *a, **b: {})
    assert rows_of(token_counts.token_counts(docs, BYTES)) == rows_of(token_counts.token_counts(docs, BYTES, cache_pieces=2))


def unpack(rows, capacity):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return sequences


def test_packing(spark):
    library, capacity = Tokenizer.from_file(WORDS), 64
    want = []
    for doc_id, text, *_ in ROWS:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for n, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start:start + capacity], "<u4")
            want.append((doc_id, n, start, len(part), zlib.crc32(part.tobytes())))
    packed = packing.packed_documents(clashing(spark, "part", "open", "length", "sequence_id"), WORDS, capacity)
    rows = packed.collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == sorted(want, key=repr)
    sequences = unpack(rows, capacity)
    assert len(sequences) == -(-sum(w[3] for w in want) // capacity)
    whole = packing.sequence_ids(packed).collect()
    assert {r.sequence_id: r.length for r in whole} == {s: sum(n for _, n in p) for s, p in sequences.items()}
    assert packing.packed_documents(empty(spark), WORDS, capacity).collect() == []


def test_pieces_of_many_texts_at_once():
    """Texts are encoded together: a run is asked for once, and only texts that cannot be cut go through by themselves."""
    rows = [(None, "one word, one word"), (3, None), (3, ""), (5, "some words, some words. " * 40 + "end"), (4, "Ça va? <|endoftext|> don't  stop\n\nnow 12 日本語")]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows])], names=["doc_id", "text"])
    fresh, library, want = Encoder(WORDS), Tokenizer.from_file(WORDS), []
    calls, alone, run, encode = [], [], fresh._run, fresh.encode
    fresh._run = lambda piece: calls.append(piece) or run(piece)
    fresh.encode = lambda text: alone.append(text) or encode(text)
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 7]
        for n, start in enumerate(range(0, len(ids), 16)):
            part = ids[start:start + 16]
            want.append((doc_id, n, start, len(part), np.array(part, "<u4").tobytes()))
    found = packing._pieces_of(batch, fresh, 16, 7)
    assert list(zip(*(c.to_pylist() for c in found.columns))) == want
    assert set(alone) <= {"", rows[4][1]} and (not fresh.direct or calls.count(" words") == 1)
    assert packing._pieces_of(batch.slice(0, 0), fresh, 16, 7).num_rows == 0


def test_partitions_with_gaps_exchange_pieces(spark):
    random = np.random.default_rng(3)
    lengths = random.integers(1, 101, 3000).tolist()
    pieces = spark.createDataFrame([(i, 0, 0, n) for i, n in enumerate(lengths)], "doc_id long, piece int, start long, length long")
    alone = packing.best_fit(sorted(lengths, reverse=True), 100)[2]
    rows = packing.pack(pieces, 100, task_pieces=40).collect()
    assert sorted(r.length for r in rows) == sorted(lengths)
    found, bound = len(unpack(rows, 100)), packing.lower_bound(pieces, 100)
    assert bound <= len(alone) <= found <= 1.02 * len(alone) + 1


def test_weights_are_dual_feasible():
    weights, random = packing.weights(30), np.random.default_rng(1)
    for _ in range(2000):
        left, bag = 30, np.zeros(31, int)
        while left and random.random() > 0.05:
            n = random.integers(1, left + 1)
            bag[n] += 1
            left -= n
        assert (weights @ bag).max() <= 1 + 1e-9


def test_bound_beats_the_sum_where_long_pieces_cannot_share(spark):
    pieces = spark.createDataFrame([(i, 0, 0, 60) for i in range(50)], "doc_id long, piece int, start long, length long")
    assert packing.lower_bound(pieces, 100) == 50


def test_wavelet_matrix():
    ids = np.random.default_rng(1).integers(0, 90, 3000).astype("<u4")
    matrix, ends = wavelet.from_file(wavelet.to_file(ids, np.array([0, 700, 3000])))
    assert (matrix.all() == ids).all() and ends.tolist() == [0, 700, 3000]
    for at in (0, 1, 7, 8, 511, 512, 513, 2999):
        assert matrix.access(at) == ids[at]
    for token in (0, 1, 64, 89, 90, 1000):
        where = np.flatnonzero(ids == token)
        for start, end in ((0, 3000), (0, 0), (5, 512), (513, 2999)):
            assert matrix.count(token, start, end) == (ids[start:end] == token).sum()
        assert [matrix.select(token, n) for n in range(len(where))] == where.tolist()
        with pytest.raises(IndexError):
            matrix.select(token, len(where))
    with pytest.raises(IndexError):
        matrix.access(3000)
    for few in ([], [0], [70000, 0, 70000]):
        few = np.array(few, "<u4")
        again, _ = wavelet.from_file(wavelet.to_file(few, np.array([len(few)])))
        assert again.all().tolist() == few.tolist()


def test_shards_round_trip(spark):
    library = Tokenizer.from_file(BYTES)
    found = wavelet.round_trip(clashing(spark, "part", "ids", "start"), BYTES, end_id=2, shard_tokens=500, task_documents=4)
    rows = sorted((tuple(r) for r in found.collect()), key=lambda r: r[1])
    assert [r[0] for r in rows] == sorted((r[0] for r in ROWS), key=lambda i: -1 if i is None else i)
    at = 0
    for _, start, n, ids in rows:
        assert start == at and n == len(ids) // 4
        at += n
    want = [np.array([*library.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for r in ROWS]
    assert sorted((r[0], r[3]) for r in rows if r[0]) == sorted((r[0], bytearray(w)) for r, w in zip(ROWS, want) if r[0])
    assert wavelet.round_trip(empty(spark), BYTES).collect() == []


@pytest.mark.parametrize("name", [BYTES, WORDS])
def test_many_texts_at_once(name):
    """Each distinct run goes to the library's model once, wherever it occurs."""
    texts = pa.array(["skip", None, *ODD, *["some words, some words."] * 50]).slice(1)
    fresh = Encoder(name)
    calls, run = [], fresh._run
    fresh._run = lambda piece: calls.append(piece) or run(piece)
    ids, ends = fresh.encode_all(texts)
    library, at = Tokenizer.from_file(name), 0
    for text, end in zip(texts.to_pylist(), ends.tolist()):
        assert ids[at:end].tolist() == library.encode(text or "", add_special_tokens=False).ids, text
        at = end
    assert at == len(ids) and (not fresh.direct or calls.count(" words") == 1)
    assert [len(x) for x in fresh.encode_all(pa.array([], pa.string()))] == [0, 0]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_runs_at_line_breaks_are_those_of_words(path):
    """A run is encoded once, whether the piece it stands in is broken by a line or not, and in later calls as well."""
    fresh, library, calls = Encoder(path), Tokenizer.from_file(path), []
    run = fresh._run
    fresh._run = lambda piece: calls.append(piece) or run(piece)
    texts = ["see first.\nThen first. then first, first.\nThen!!\nx", None, "no first.\nThen", "see first:\nThen"]
    for some in (texts, texts[::-1]):
        ids, ends = fresh.encode_all(pa.array(some, pa.string()))
        assert [x.tolist() for x in np.split(ids, ends)[:-1]] == [library.encode(t or "", add_special_tokens=False).ids for t in some]
        assert calls.count(" first") == 1 and calls.count("Then") <= 2  # once more for the piece of three lines


def test_few_runs_are_kept():
    """A table of runs much smaller than the texts need gives the library's ids; what it keeps is bounded."""
    fresh, library, random = Encoder(BYTES, limit=40), Tokenizer.from_file(BYTES), np.random.default_rng(5)
    letters = list("abcdeéßÑ")
    for _ in range(30):
        words = ["".join(random.choice(letters, random.integers(1, 4))) + str(random.choice(["", ",", ".\nIn", "\n"])) for _ in range(60)]
        texts = [" ".join(words[:30]), *ODD, " ".join(words[30:])]
        ids, ends = fresh.encode_all(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, ends)[:-1]] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(fresh.met.names) <= fresh.met.limit + 200


def test_rows_are_cut_by_the_bytes_of_their_texts():
    batch = pa.RecordBatch.from_pydict({"n": list(range(7)), "text": ["a" * 4, None, "é" * 3, "b" * 50, "", "c" * 9, "d"]})
    found = [cut.column("n").to_pylist() for cut in by_bytes([batch.slice(0), batch.slice(0, 0)], "text", 10)]
    assert found == [[0, 1, 2], [3], [4, 5, 6]]


def test_each_shard_is_one_file(spark, tmp_path):
    wavelet.write_shards(documents(spark), str(tmp_path / "s"), BYTES, shard_tokens=500, task_documents=4)
    files = list((tmp_path / "s").glob("*.parquet"))
    assert all(spark.read.parquet(str(f)).count() <= 1 for f in files)
    assert spark.read.parquet(str(tmp_path / "s")).agg(F.sum("n_tokens")).first()[0] == wavelet.read_shards(spark, str(tmp_path / "s")).agg(F.sum("n_tokens")).first()[0]


def test_the_frequent_table_counts_all_documents(spark):
    rows = [(i, f"a pair{i // 2} word") for i in range(3000)] + [(3000, f"z once {'y' * 50} {'y' * 50}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(4)
    found = token_counts.frequent_pieces(docs, BYTES)
    library = Tokenizer.from_file(BYTES)
    assert found == {p: len(library.encode(" " + p, add_special_tokens=False).ids) for p in ("word", *(f"pair{i}" for i in range(1500)))}
    few = token_counts.frequent_pieces(docs, BYTES, entries=3)
    assert "word" in few and len(few) <= 3
    assert token_counts.frequent_pieces(empty(spark), BYTES) == {}
