"""Exact and near duplicates and links against brute force."""

import hashlib
import random

import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import ROWS, WORD, clashing, documents, empty, rows_of
from tidemark.llm import exact_dedup, simhash
from tidemark.llm.components import components


def exact_report(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        group = groups[text or ""]
        keep = max((i for i in group if i is not None), default=None)
        out.append((doc_id, keep, len(group), doc_id == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_report(spark):
    docs = clashing(spark, "hit", "sha", "keep_id", "n", "block")
    assert rows_of(exact_dedup.duplicate_report(docs)) == exact_report(ROWS)
    assert exact_dedup.duplicate_report(empty(spark)).collect() == []


def test_a_filter_too_small_changes_nothing(spark):
    docs = spark.createDataFrame([(i, f"text {i % 700}") for i in range(1500)], "doc_id long, text string")
    want = exact_report([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(exact_dedup.duplicate_report(docs, max_bits=exact_dedup.BLOCK)) == want
    digests = docs.select("doc_id", F.unhex(F.sha2("text", 256)).alias("sha"))
    bits = exact_dedup.filter_bits(1500)
    hit = exact_dedup.maybe_repeated(digests, exact_dedup.repeat_filter(digests, bits), bits, "sha", "hit")
    assert hit.filter("hit").count() == 1500  # every text occurs at least twice


def test_most_single_texts_pass_the_filter(spark):
    digests = spark.range(4000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("sha"))
    bits = exact_dedup.filter_bits(4000)
    hit = exact_dedup.maybe_repeated(digests, exact_dedup.repeat_filter(digests, bits), bits, "sha", "hit")
    assert hit.filter("hit").count() < 40


def test_drop_duplicates(spark):
    docs = clashing(spark, "hit", "sha", "__x")
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    found = {}
    for r in kept.collect():
        assert (r.text or "") not in found
        found[r.text or ""] = r.doc_id
    assert found == {(t or ""): max((r[0] for r in ROWS if (r[1] or "") == (t or "") and r[0] is not None), default=None) for _, t, *_ in ROWS}
    assert exact_dedup.drop_duplicates(empty(spark)).collect() == []


def slow_fingerprint(text, n=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = WORD.findall(lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def near_report(prints, bits=4):
    rows = list(prints)
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= bits and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    lowest = {}
    for (doc_id, _), g in zip(rows, group):
        lowest[g] = min((i for i in (lowest.get(g), doc_id) if i is not None), default=None)
    return sorted(((d, f"{p:016x}", lowest[g]) for (d, p), g in zip(rows, group)), key=repr)


def test_near_report(spark):
    want = near_report([(r[0], slow_fingerprint(r[1] or "")) for r in ROWS])
    docs = clashing(spark, "fp", "root", "class", "key", "component_id")
    assert rows_of(simhash.near_duplicate_report(docs)) == want
    assert simhash.near_duplicate_report(empty(spark)).collect() == []


def test_spark_has_the_same_hash(spark):
    texts = ["a b c d", "é ü ß", "more than thirty-two bytes of text to hash at once"]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t")).collect()
    assert [r[0] % (1 << 64) for r in found] == [xxhash.xxh64_intdigest(t.encode(), 42) for t in texts]


def balls(seed, groups=40, members=12):
    """Fingerprints in dense groups, at distances around the limit."""
    pick = random.Random(seed)
    out = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(groups):
        center = pick.getrandbits(64)
        for _ in range(members):
            out.add(center ^ sum(1 << b for b in pick.sample(range(64), pick.randint(0, 5))))
    return sorted(out)


def test_links_join_all_that_are_near(spark):
    for bits in (1, 4, 6):
        prints = balls(bits)
        signed = [p - (1 << 64) if p >> 63 else p for p in prints]
        frame = spark.createDataFrame([(s,) for s in signed], "fp long").cache()
        want = {}
        for d, _, c in near_report(zip(signed, prints), bits):
            want.setdefault(c, set()).add(d)
        for options in ({}, {"members": 3, "task_rows": 500})[: 2 if bits == 4 else 1]:
            found = {}
            for r in components(simhash.near_links(frame, bits, **options)).collect():
                found.setdefault(r.root, set()).add(r.node)
            assert sorted(map(sorted, found.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1), (bits, options)


def test_chains_and_stars_become_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, i) for i in range(1001, 1200)]
    random.Random(1).shuffle(chain)
    found = components(spark.createDataFrame(chain + star + [(5, 5), (3, 4)], "a long, b long"))
    assert rows_of(found) == sorted([(i, 0) for i in range(61)] + [(i, 1000) for i in range(1000, 1200)], key=repr)


def test_drop_near_duplicates(spark):
    docs = clashing(spark, "fp", "__words")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    report = near_report([(r[0], slow_fingerprint(r[1] or "")) for r in ROWS])
    want = sorted((d for d, _, c in report if d == c), key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == want
    assert simhash.drop_near_duplicates(empty(spark)).collect() == []


def test_near_duplicates_go_by_row_and_not_by_id(spark):
    far = ["seven grey boats left the old harbour at dawn", "nobody reads the long report on winter wheat", "a clock without hands hung above that door"]
    fox, one = ROWS[0][1], "many small rivers feed the wide northern lake"
    rows = [(1, fox), (None, fox.upper()), (None, far[0]), (2, one), (5, one.upper()), (5, far[1]), (None, far[2]), (None, far[2].upper())]
    prints = [slow_fingerprint(t) for t in (fox, one, *far)]
    assert all((a ^ b).bit_count() > 4 for a in prints for b in prints if a != b)
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    last = min(far[2], far[2].upper(), key=lambda t: hashlib.sha256(t.encode()).digest())
    assert sorted(map(tuple, kept), key=repr) == sorted([(1, fox), (None, far[0]), (2, one), (5, far[1]), (None, last)], key=repr)
