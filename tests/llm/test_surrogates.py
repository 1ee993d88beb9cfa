"""Surrogates: nothing real is left, kinds and spellings are kept, people stay apart and one."""

import re

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import LONG, clashing, empty
from tidemark.llm import surrogates

TEXTS = {
    1: "Write to John.Smith72@Mail3.example.com or JOHN.SMITH72@MAIL3.EXAMPLE.COM!! now",
    2: "call +1 (017) 555-7713 or +1 017 555 7713. ip 169.122.221.182, 10.0.0.1.",
    3: "cards 4111-1111-1111-1111 4111111111111111 5927243074273351 end",
    4: "Mr. John Smith met Mrs Anna Schmidt; Mr Smith left. Господин Иван Петров",
    5: None,
    6: "",
    7: "clean text 12 34 here 2020, 3.14 and 100 000",
    8: 'token = "4f3a9bc1d2e3f4a5b6c7d8e9f0a1b2c3" 123-45-6789',
    9: "john.smith72@mail3.example.com%%% 10.0.0.1***",
    10: LONG + "john.smith72@mail3.example.com " + LONG,
    11: "a@b.co é.ü@müll.de x%y@z.org.",
}
REAL = ["john", "smith", "mail3", "555-7713", "555 7713", "169.122", "10.0.0.1", "4111", "5927243074273351", "anna", "schmidt", "иван", "петров", "4f3a9bc1", "123-45", "müll"]


def frame(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")


def replaced(spark, texts=TEXTS, key="k"):
    return {r.doc_id: r for r in surrogates.surrogate_report(frame(spark, texts), key).collect()}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10


def test_replacements(spark):
    found = replaced(spark)
    for i in (5, 6, 7):
        assert found[i].text == TEXTS[i] and found[i].n_entities == 0
    for i, r in found.items():
        assert not [x for x in REAL if x in (r.text or "").lower()], r
    mails = re.findall(r"\S+@[\w.]+\w", found[1].text)
    assert mails[0] == mails[0].lower() and mails[1] == mails[0].upper() and mails[0].endswith(".com")
    assert mails[0] in found[9].text and mails[0] in found[10].text and found[9].text.endswith("***")
    assert len(found[10].text) == len(TEXTS[10])
    one, two = re.search(r"\+1 \((\d{3})\) (\d{3})-(\d{4}) or \+1 (\d{3} \d{3} \d{4})", found[2].text).group(1, 4)
    assert two.startswith(one)
    ips = re.findall(r"\d+\.\d+\.\d+\.\d+", found[2].text)
    assert len(set(ips)) == 2 and all(0 < int(x) < 256 for ip in ips for x in ip.split(".")) and ips[1] in found[9].text
    cards = re.findall(r"[\d-]{16,}", found[3].text)
    assert cards[0].replace("-", "") == cards[1] != cards[2] and luhn(cards[1]) == 0
    assert luhn(cards[2]) == luhn("5927243074273351")
    man, family, woman, other, again, ru = re.search(r"Mr\. (\w+) (\w+) met Mrs (\w+) (\w+); Mr (\w+) left\. Господин (\w+ \w+)", found[4].text).groups()
    assert family == again != other and woman[-1] in "ae" and man[-1] not in "ae" and re.fullmatch("[А-Яа-я ]+", ru)
    assert re.search(r'"[0-9a-f]{32}" \d{3}-\d{2}-\d{4}$', found[8].text)
    assert found[11].text.endswith(".") and re.fullmatch(r"\S@\S\.co \S\.\S@\S+\.de \S+@\S+\.org\.", found[11].text)


def test_the_key_decides(spark):
    few = {i: TEXTS[i] for i in (1, 2)}
    assert replaced(spark, few) == replaced(spark, few)
    assert replaced(spark, few)[1].text != replaced(spark, few, "other")[1].text


def test_replacements_that_meet_are_drawn_again(spark):
    # one-letter names leave few replacements, so that many meet at first
    rows = [("email", f"{a}@{b}.co") for a in "abcdefghijklmnop" for b in "qrstuvwxyz"]
    made = surrogates.assign(spark.createDataFrame(rows, "kind string, value string"), "k").collect()
    new = [r.made for r in made]
    assert len(new) == len(set(new)) == len(rows) and not set(new) & {v for _, v in rows}


def test_edges(spark):
    docs = clashing(spark, "kind", "value", "made", "__x")
    found = surrogates.replace_entities(docs, "k")
    assert found.columns == docs.columns and found.count() == docs.count()
    assert sorted(map(repr, found.collect())) == sorted(map(repr, docs.collect()))  # nothing personal there
    assert surrogates.surrogate_report(empty(spark), "k").collect() == []


def remainder(iban):
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def test_phones_addresses_and_accounts_in_more_forms(spark):
    real = ["(743) 555-3824", "+44 20 7946 0958", "+49 30 1234567", "+33 1 42 68 53 00", "+44 (0)20 7946 0958", "2001:db8:85a3::8a2e:370:7334", "2001:0DB8:0000:0000:0000:FF00:0042:8329",
            "fe80::1ff:fe23:4567:890a", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"]
    found = replaced(spark, {i: f"see {x}: or {x}, thanks" for i, x in enumerate(real)} | {99: "at 12:30:45 std::abs 3:4 AB12 THIS IS TEXT (see 12) ::ffff:10.0.0.1"})
    for i, x in enumerate(real):
        one, two = re.fullmatch(r"see (.*): or (.*), thanks", found[i].text).groups()
        assert one == two != x and len(one) == len(x) and found[i].n_entities == 2, found[i]
        assert re.sub(r"[0-9A-Fa-f]", "0", one) == re.sub(r"[0-9A-Fa-f]", "0", x) or i > 7
    assert found[8].text[4:6] == "DE" and all(remainder(found[i].text[4:].split(":")[0].replace(" ", "")) == 1 for i in (8, 9))
    assert found[99].text.startswith("at 12:30:45 std::abs 3:4 AB12 THIS IS TEXT (see 12) ::ffff:") and found[99].n_entities == 1


def test_names_stay_hidden_without_a_title(spark):
    found = replaced(spark, {
        1: "Smith came. Mr John Paul Smith met Mrs Anna Schmidt-Berg. John Smith, SMITH's dog, john paul smith and Anna left; smithy and Johnson stay.",
        2: "John Smith and Smith are in a text of their own",
        3: "Herr Prof. Dr. J. R. van der Berg, Berg; Mr O'Neill's house, O'Neill",
    })
    a, man, mid, family, woman, other, b, c, d, e, f, g, h = re.fullmatch(
        r"(\w+) came\. Mr (\w+) (\w+) (\w+) met Mrs (\w+) (\w+)\. (\w+) (\w+), (\w+)'s dog, (\w+) (\w+) (\w+) and (\w+) left; smithy and Johnson stay\.", found[1].text).groups()
    assert a == c == family and b == man and d == family.upper() and [e, f, g] == [man.lower(), mid.lower(), family.lower()] and h == woman
    assert not {"john", "paul", "smith", "anna"} & {x.lower() for x in (a, man, mid, family, woman, other)} and found[1].n_entities == 7
    assert found[2].n_entities == 0
    one, two, three, four = re.fullmatch(r"Herr Prof\. Dr\. [A-Z]\. [A-Z]\. van der (\w+), (\w+); Mr (\w+)'s house, (\w+)", found[3].text).groups()
    assert one == two != "Berg" and three == four


@pytest.mark.parametrize("text", [
    "Mr " + "Bob " * 250_000, "x@" + "a." * 500_000 + "com", "Mr A" + "b" * 1_000_000, "Mr A" + "-b" * 500_000, "Mr " * 300_000, "1" * 1_000_000,
    "+1 " * 300_000, "A B " * 250_000, "1:" * 500_000, "GB12 " * 200_000, "a" * 1_000_000 + "@", "Mr " + "van " * 250_000, "0f" * 500_000, "(12) " * 200_000,
])
def test_long_strange_texts_end(spark, text):
    found = spark.createDataFrame([(text,)], "text string").select(F.regexp_extract_all("text", F.lit(surrogates.ENTITY), F.lit(0)).alias("e"))
    assert found.select(F.size("e")).first()[0] >= 0
