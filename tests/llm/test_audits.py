"""Source divergences and filter interactions against plain Python."""

import random
import re
from collections import Counter
from fractions import Fraction
from itertools import permutations

import pytest

from tests.llm.helpers import ROWS, clashing, documents, empty
from tidemark.llm import divergence, filter_audit

LABELS = "doc_id long, quality int, toxic int"


# source divergence

def terms_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)


def divergences_of(rows, least=3, ranks=200):
    docs = [(lang or "", source or "", terms_of(text)) for _, text, lang, source, _ in rows]
    found = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for _, _, terms in mine for t in set(terms))
        kept = sorted(t for t, n in df.items() if n >= least)
        counts = {s: Counter(t for _, x, terms in mine if x == s for t in terms) for s in {d[1] for d in mine}}
        whole = sum(counts.values(), Counter())

        def rates(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        p = {s: rates(c) for s, c in counts.items()}
        q = rates(whole)
        for s in counts:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in counts if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, values, most in (("pair", pairs, None), ("term", terms, ranks)):
                for rank, (v, item) in enumerate(sorted(values, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    found.add((lang, s, part, item, v, rank))
    return found


def divergences(docs, **options):
    rows = divergence.divergences(docs, **options).collect()
    assert len(rows) == len({tuple(r) for r in rows})
    return {tuple(r) for r in rows}


def random_rows(seed, n=120):
    pick = random.Random(seed)
    words = ["the", "Été", "été", "a1b", "日本", "x-y", "ZEBRA", "zebra"] + [f"w{chr(97 + i)}" for i in range(26)]
    return [
        (i, " ".join(pick.choices(words, k=pick.randint(0, 12))), pick.choice(["en", "en", "fr", None]), pick.choice(["a", "a", "b", "Z", "é", None]), 0)
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_divergences(spark, seed):
    rows = random_rows(seed) + ROWS
    assert divergences(documents(spark, rows)) == divergences_of(rows)


def test_divergences_of_all_terms_and_few_ranks(spark):
    rows = random_rows(3)
    assert divergences(documents(spark, rows), least_docs=1, ranks=3) == divergences_of(rows, 1, 3)


def test_spilled_stripes_and_small_blocks_of_pairs(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "SPILL_COUNTS", 5)
    monkeypatch.setattr(divergence, "PAIRS", 4)
    rows = random_rows(4)
    batch = pa.RecordBatch.from_pydict({
        "text": [r[1].encode() for r in rows], "lang": [r[2] or "" for r in rows], "source": [r[3] or "" for r in rows]})
    df, n, spilled = Counter(), Counter(), 0
    for part in divergence._fold(iter([batch])):
        for r in part.to_pylist():
            df[r["lang"], r["term"]] += r["df"]
            n[r["lang"], r["source"], r["term"]] += r["n"]
            spilled += 1
    assert df == Counter((x[2] or "", t) for x in rows for t in set(terms_of(x[1])))
    assert n == Counter((x[2] or "", x[3] or "", t) for x in rows for t in terms_of(x[1])) and spilled > len(n)
    stripes = [("en", t, s, p, 1) for t in "uvw" for s, p in (("a", 3), ("b", 5), ("c", 9))]
    moved = Counter()
    for cut in (1, 4, 9):
        parts = [stripes[:cut], stripes[cut:]]
        names = ("lang", "term", "source", "p", "zero")
        batches = [pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*p))))) for p in parts if p]
        for part in divergence._folded_pairs(iter(batches)):
            for r in part.to_pylist():
                moved[r["source"], r["item"]] += r["moved"]
    assert moved["a", "b"] == 9 * ((3 - 5) ** 2 // 5 - (3 - 1) ** 2 // 1 - (1 - 5) ** 2 // 5) and len(moved) == 6


def test_divergences_of_nothing_and_of_clashing_columns(spark):
    assert divergences(empty(spark)) == set()
    assert divergences(clashing(spark, "term", "n", "zero", "p", "base", "item")) == divergences_of(ROWS)
    assert divergences(documents(spark, [(1, None, None, None, 0), (2, "", None, "b", 0)])) == {
        ("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)}


# filter interactions

def failures(rows):
    first = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    for doc_id, text, lang, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and first[text] < doc_id,
        }
        yield doc_id, lang or "", {x for x in fails if fails[x]}


def audit_of(rows, labels):
    good, toxic = {x[0] for x in labels if x[1] == 1}, {x[0] for x in labels if x[2] == 1}
    docs, found = list(failures(rows)), set()
    for part in {d[1] for d in docs}:
        mine, steps, total = [d for d in docs if d[1] == part], [], Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                out = [d for d in left if x in d[2]]
                before = [d for d in mine if d not in left]
                left = [d for d in left if x not in d[2]]
                removed_earlier = sum(1 for d in mine if x in d[2]) - len(out)
                assert removed_earlier >= 0 and (before or removed_earlier == 0)
                steps.append((part, "".join(order), step, len(left), len(out), removed_earlier, sum(1 for d in mine if d[2] == {x}),
                              sum(1 for d in out if d[0] in good), sum(1 for d in out if d[0] in toxic), x))
                total[x] += len(out)
        found |= {(*s[:-1], total[s[-1]]) for s in steps}
    return found


def audit(docs, labels):
    rows = filter_audit.interaction_audit(docs, labels).collect()
    assert len(rows) == len({tuple(r) for r in rows})
    return {tuple(r) for r in rows}


def filter_rows(seed, n=150):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"w{pick.randint(0, pick.choice([40, 4000]))}" for _ in range(pick.choice([0, 60, 99, 100, 130]))]
        text = " ".join(words)
        text = text.upper() if pick.random() < 0.3 else text
        text += pick.choice(["", "", " #", " é|"])
        rows.append((pick.choice([i, i, None]), rows[-1][1] if rows and pick.random() < 0.2 else text, pick.choice(["en", "de", None]), "s", 0))
    return rows


def test_filter_audit(spark):
    rows = filter_rows(5) + ROWS
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 150, 2)] + [(4, 0, 1), (4, 1, 0), (None, 1, 1), (999, 1, 1)]
    found = audit(documents(spark, rows), spark.createDataFrame(labels, LABELS))
    assert found == audit_of(rows, [x for x in labels if x[0] is not None])
    assert len(found) == 600 * len({r[2] or "" for r in rows})


def test_filter_audit_of_nothing_and_of_clashing_columns(spark):
    none = spark.createDataFrame([], LABELS)
    assert audit(empty(spark), none) == set()
    assert audit(clashing(spark, "mask", "part", "sha", "n", "first", "good"), none) == audit_of(ROWS, [])


def test_shapley_weights_solve_the_constrained_least_squares():
    for n in (1, 2, 3, 5):
        pick = random.Random(n)
        worth = [0, *(pick.randint(0, 99) for _ in range(2**n - 1))]
        found = [sum(w * v for w, v in zip(row, worth)) for row in filter_audit.shapley_weights(n)]
        orders = list(permutations(range(n)))
        for i in range(n):
            gains = sum(worth[sum(1 << j for j in o[: o.index(i) + 1])] - worth[sum(1 << j for j in o[: o.index(i)])] for o in orders)
            assert found[i] == Fraction(gains, len(orders))
