"""Source targets and mixes against plain Python."""

import math
import random

import pytest

from tests.llm.helpers import ROWS, WORD, clashing, documents, empty, rows_of
from tidemark.llm import mixing


def size_of(text):
    return len(WORD.findall(text or ""))


def targets_of(rows, most=3.0):
    sizes = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + size_of(text)
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    fixed, total = {}, sum(sizes.values())
    while len(fixed) < len(order):
        left = total - sum(fixed.values())
        free = [s for s in order if s not in fixed]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return sizes, {**fixed, **share}
        fixed.update({s: most * sizes[s] for s in over})
    return sizes, fixed


def check(spark, rows, docs=None, tolerance=None):
    sizes, targets = targets_of(rows)
    found = mixing.mix_report(docs if docs is not None else documents(spark, rows)).collect()
    assert sorted(((r.doc_id, r.size, r.source_size) for r in found), key=repr) == sorted(
        ((d, size_of(t), sizes[s]) for d, t, _, s, _ in rows), key=repr)
    taken = {}
    source_of = {(d, size_of(t)): s for d, t, _, s, _ in rows}
    for r in found:
        source = source_of[r.doc_id, r.size]
        assert r.target == pytest.approx(targets[source], abs=1e-6)
        assert 0 <= r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
        taken[source] = taken.get(source, 0) + r.taken
    for s, t in targets.items():
        if tolerance:
            assert abs(taken.get(s, 0) - t) <= tolerance * t + 12
    return found


def test_edge_rows(spark):
    rows = [r for r in ROWS if r[0] not in (None, 3)]  # one source for each id and size
    check(spark, rows)
    assert len(mixing.mix_report(clashing(spark, "size", "rate", "bucket", "target", "of")).collect()) == len(ROWS)
    assert mixing.mix_report(empty(spark)).collect() == []


def many(seed, n=900):
    pick = random.Random(seed)
    sources = [None, "a", "b", "B", "é", "z"]
    odds = [1, 1, 2, 3, 1, 8]
    return [(i, " ".join(["w"] * int(pick.lognormvariate(4, 1))), "en", pick.choices(sources, odds)[0], 0) for i in range(n)]


def test_targets_are_met(spark):
    found = check(spark, many(1), tolerance=0.02)
    again = mixing.mix_report(documents(spark, list(reversed(many(1))))).collect()
    assert sorted(found, key=repr) == sorted(again, key=repr)


def test_rates_solve_the_balance_and_tilt_with_size(spark):
    rows = many(2, 300)
    unit = mixing.units(documents(spark, rows))
    solved = mixing.duals(unit, mixing.source_targets(unit)).collect()
    for s in solved:
        sizes = [size_of(t) for _, t, _, source, _ in rows if source == s.source]
        if s.target >= 3 * s.source_size:
            continue
        taken = sum(n * min(3.0, math.exp(min(s.dual * n / s.scale, 9))) for n in sizes)
        assert taken == pytest.approx(s.target, rel=1e-6)


def test_a_hot_source_is_rounded_by_one_number(spark):
    rows = [(i, "a b c d e", "en", "hot" if i % 3 else "cold", 0) for i in range(600)]
    mixed = mixing.mix(documents(spark, rows)).collect()
    hot = [r for r in mixed if r.source == "hot"]
    assert abs(sum(r.copies * r.size for r in hot) - hot[0].target) <= 8 * 5
    assert len({r.copies for r in hot}) <= 2
    few = mixing.mix(documents(spark, rows), bins=1).collect()  # all documents of a source take their turn together
    assert {s: len({r.copies for r in few if r.source == s}) for s in ("hot", "cold")} == {"hot": 1, "cold": 1}


def test_mixed_documents(spark):
    rows = many(3, 200)
    docs = documents(spark, rows)
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    found = {}
    for r in mixing.mixed_documents(docs).collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + 1
    assert found == {d: n for d, n in copies.items() if n}
    odd = clashing(spark, "size", "copies", "__one")
    assert mixing.mixed_documents(odd).columns == odd.columns


def test_equal_rows_are_taken_alike(spark):
    rows = [(1, "a b c", "en", "s", 0)] * 4 + [(2, "a b", "en", "t", 0)]
    counts = {}
    for r in mixing.mixed_documents(documents(spark, rows)).collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    report = mixing.mix_report(documents(spark, rows)).collect()
    assert len(report) == 5 and len({r.taken for r in report if r.doc_id == 1}) == 1
    assert counts.get(1, 0) == sum(r.taken // r.size for r in report if r.doc_id == 1)
