"""Elias-Fano tries and trigram scores against plain Python."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import ROWS, WORD, clashing, documents, empty
from tidemark.llm import elias_fano, ngram_lm
from tidemark.llm.elias_fano import EliasFano, Level
from tidemark.session import keep


def test_packed_arrays_come_back_and_large_counts_nearly():
    arrays = [np.arange(5), np.zeros(0, np.int32), np.array([7], np.uint8), np.array([-1, 1 << 40])]
    for x, y in zip(arrays, ngram_lm.unpack(ngram_lm.pack(*arrays))):
        assert x.dtype == y.dtype and x.tolist() == y.tolist()
    counts = np.array([0, 1, 32767, 32768, 10**6, 10**12])
    assert ngram_lm._decoded(ngram_lm._coded(counts)) == pytest.approx(counts, rel=6e-4)


def test_words_are_runs_without_blanks():
    texts = [(t or "").encode() for _, t, *_ in ROWS] + [b"", b" a\x0bB\x0c\r\n", b"x\x00y \xc2\xa0Z\xc3\x89 \x1c"]
    lengths, coded = ngram_lm._words(texts)
    words = [t.lower().split() for t in texts]
    assert lengths.tolist() == [len(w) for w in words]
    assert coded.to_pylist() == [w for text in words for w in text]
    assert ngram_lm._words([])[0].tolist() == [] and ngram_lm._words([b""])[0].tolist() == [0]


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (1, 10**12), (7, 7), (3000, 3001), (5000, 10**6), (2000, 2**45)])
def test_sequences_return_values_and_find_them(n, top):
    pick = np.random.default_rng(n)
    values = np.unique(pick.integers(0, top, n)) if n else np.zeros(0, np.int64)
    coded = EliasFano.of(values)
    assert (coded.at(np.arange(len(values))) == values).all()
    place = {v: i for i, v in enumerate(values.tolist())}
    ask = np.concatenate([values, values + 1, pick.integers(0, 2 * top + 2, 500)])
    assert coded.find(ask).tolist() == [place.get(x, -1) for x in ask.tolist()]
    assert sum(x.nbytes for x in coded.arrays()) <= 200 + len(values) * (4 + math.log2(max(2, top / max(1, len(values)))) / 8)


def test_repeated_values_are_kept():
    values = np.array([0, 0, 0, 5, 5, 9, 9, 9, 9, 1000])
    assert EliasFano.of(values).at(np.arange(10)).tolist() == values.tolist()


def test_levels_search_within_a_group():
    members = {0: [3, 4, 9], 1: [], 2: [0], 3: [1, 2, 100]}
    group = np.array([g for g, m in members.items() for _ in m])
    level = Level.of(group, np.array([x for m in members.values() for x in m]), 4)
    for g in range(4):
        for x in range(-1, 110):
            at = int(level.find(np.array([g]), np.array([x]))[0])
            assert (at >= 0) == (x in members[g])
            if at >= 0:
                assert at - int(level.first(np.array([g]))[0]) == members[g].index(x)
    assert level.find(np.array([-1]), np.array([3])).tolist() == [-1]


def test_codes_are_exact_for_few_values_and_close_for_many():
    book, code = elias_fano.quantised(np.array([0.5, 0.25, 0.5, 1.0]))
    assert book[code].tolist() == [0.5, 0.25, 0.5, 1.0]
    values = np.random.default_rng(1).lognormal(-6, 2, 5000)
    book, code = elias_fano.quantised(values)
    assert len(book) == 256 and np.abs(np.log10(book[code] / values)).max() < 0.04


def tokens_of(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(text or "")] + [None]


def scores_of(rows, discount=0.75):
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` with exact probabilities."""
    docs = [(d, zlib.crc32(str("" if d is None else d).encode()) % 7 == 2, tokens_of(t)) for d, t, *_ in rows]
    c1, c2, c3, n2, n3 = Counter(), Counter(), Counter(), Counter(), Counter()
    for _, held, tokens in docs:
        if not held:
            c1.update(tokens)
            for u, v, w in zip(["<", "<", *tokens], ["<", *tokens], tokens):
                c2[v, w] += 1
                c3[u, v, w] += 1
                n2[v] += 1
                n3[u, v] += 1
    k2, k3 = Counter(v for v, _ in c2), Counter((u, v) for u, v, _ in c3)
    total, kinds = sum(c1.values()), len(c1)
    found = []
    for d, held, tokens in docs:
        base = score = 0.0
        for u, v, w in zip(["<", "<", *tokens], ["<", *tokens], tokens):
            p = (c1[w] + 1) / (total + kinds + 1)
            base += math.log10(p)
            if n2[v]:
                p = max(c2[v, w] - discount, 0) / n2[v] + discount * k2[v] / n2[v] * p
            if n3[u, v]:
                p = max(c3[u, v, w] - discount, 0) / n3[u, v] + discount * k3[u, v] / n3[u, v] * p
            score += math.log10(p)
        found.append((d, held, len(tokens), sum(c1[t] > 0 for t in tokens), total, base, score))
    return sorted(found, key=repr)


def check(found, rows, tolerance):
    found = sorted((tuple(r) for r in found.collect()), key=lambda r: (repr(r[:5]), r[5]))
    want = sorted(scores_of(rows), key=lambda r: (repr(r[:5]), r[5]))
    assert [r[:5] for r in found] == [r[:5] for r in want]
    for f, w in zip(found, want):
        assert f[5] == pytest.approx(w[5], abs=1e-6 * (1 + abs(w[5])))
        assert f[6] == pytest.approx(w[6], abs=tolerance * w[2])


def random_rows(seed, n=200):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["The", "the", "Été", "日本"]
    odds = [1 / (1 + i) for i in range(len(words))]
    rows = [(i, " ".join(pick.choices(words, odds, k=pick.randint(0, 40))), "en", "s", 0) for i in range(n)]
    return rows + [(pick.choice([None, 5, i]), rows[pick.randint(0, n - 1)][1], "en", "s", 0) for i in range(n, n + 20)]


def test_scores(spark):
    rows = random_rows(1) + ROWS
    check(ngram_lm.scores(documents(spark, rows)), rows, 0.01)


def test_scores_over_many_blocks_and_shares_with_spread_words(spark):
    rows = random_rows(2)
    docs = keep(documents(spark, rows).repartition(4))
    check(ngram_lm.scores(docs, block_words=150, word_share=2000, trigram_share=1500, hot=100), rows, 0.01)


def test_scores_of_nothing_of_clashing_columns_and_without_training(spark):
    assert ngram_lm.scores(empty(spark)).collect() == []
    check(ngram_lm.scores(clashing(spark, "held_out", "to", "kind", "a", "n")), ROWS, 0.01)
    held = [(i, "a b a", "en", "s", 0) for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2]
    for r in ngram_lm.scores(documents(spark, held)).collect():
        assert (r.n_known, r.train_tokens, r.base_score, r.score) == (0, 0, 0.0, 0.0)
