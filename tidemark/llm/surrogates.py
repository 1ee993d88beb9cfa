"""Surrogates for personal data, in DataFrame operations only.

Entities found in a text are brought to a normal form (case, blanks and separators aside).  Each distinct one
gets a keyed replacement of its kind; all its occurrences, in any spelling and any document, get the same, written the
way the occurrence is.  Replacements that meet, or that are another entity of the corpus, are drawn
again until all are distinct, so two people are never made one.  Names that follow a title are also replaced where the
same text has them without one.  Texts without entities pass unshuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import keep

#: Patterns of entities, tried in this order at each place.
LOCAL = r"\p{L}\p{N}._%+\-"
EMAIL = rf"(?<![{LOCAL}])[{LOCAL}]++@[\p{{L}}\p{{N}}\-]++(?:\.[\p{{L}}\p{{N}}\-]++){{1,126}}"
IP = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)"
CARD = r"(?<![\d])(?:\d{4}([ \-]?)\d{4}\1\d{4}\1\d{4}|3\d{3}[ \-]?\d{6}[ \-]?\d{5}|\d{13,19})(?!\d)"
HEX = "[0-9A-Fa-f]{1,4}"
IP6 = rf"(?<![\p{{L}}\p{{N}}:.])(?=[A-Fa-f:]*\d)(?:(?:{HEX}:){{7}}{HEX}|(?:{HEX}:){{1,6}}(?::{HEX}){{1,6}}|(?:{HEX}:){{2,7}}:|:(?::{HEX}){{2,7}})(?![\p{{L}}\p{{N}}]|:[0-9A-Fa-f:]|\.\d)"
IBAN = r"(?<![\p{L}\p{N}])(?=(?:[ A-Z]{0,40}\d){8})[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
PHONE = (
    r"(?<![\d])(?:\+?\d{1,3}[ .\-]?)?\(\d{2,4}\)[ .\-]?\d{3,4}[ .\-]?\d{3,4}(?!\d)|(?<![\d])(?:\+\d{1,3}[ .\-])?\d{3}[ .\-]\d{3,4}[ .\-]\d{4}(?!\d)|\+\d{9,14}(?!\d)"
    r"|\+(?=(?:[ .\-/()]{0,2}\d){8,15}(?!\d))\d{1,3}[ .\-/]?(?:\(\d{1,4}\)[ .\-/]?)?\d{1,4}(?:[ .\-/]?\d{2,4}){1,6}(?![.\-/]?\d)"
)
NATIONAL = r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])"
SECRET = r"(?<![\p{L}\p{N}])(?=[0-9A-Fa-f]*[A-Fa-f])(?=[0-9A-Fa-f]*\d)[0-9A-Fa-f]{32,128}(?![\p{L}\p{N}])"
MALE = "Mr|Sir|Herr|Señor|Monsieur|Господин"
FEMALE = "Mrs|Ms|Miss|Madam|Frau|Señora|Madame|Госпожа"
#: Titles that tell no sex; given names after them are drawn as men's.
OTHER = "Dr|Prof|Doctor|Professor|Доктор|Профессор"
TITLES = rf"(?:(?:{MALE}|{FEMALE}|{OTHER})\.? ){{1,10}}"
#: A word of a name, without a possessive s; before it, particles and initials.  Java's matcher calls itself for each
#: turn of a group, so letters are taken in one go and groups turn a bounded number of times.
JOINED = r"(?:['’\-](?!s(?!\p{L}))\p{L}++)"
WORD = rf"\p{{Lu}}(?:\p{{L}}++{JOINED}{{0,40}}|{JOINED}{{1,40}})"
UNIT = rf"(?:(?:van|von|vom|der|den|de|del|della|di|da|dos|du|la|le|zu|zur|af|bin|ibn|al|ter|ten|\p{{Lu}}\.?) ){{0,20}}{WORD}"
NAME = rf"(?<![\p{{L}}]){TITLES}{UNIT}(?: {UNIT}){{0,60}}"
ENTITY = "|".join(f"(?:{p})" for p in (EMAIL, IBAN, NATIONAL, CARD, IP, IP6, PHONE, SECRET, NAME))
#: Every entity has one of these; texts without are not searched further.
HINT = rf"[0-9@]|(?:{MALE}|{FEMALE}|{OTHER})\b"
#: Parts of made-up names, by script: openings, middles, endings of men's, women's and family names.
NAME_PARTS = {
    "latin": ("Al Ber Car Dan El Fer Gor Hal Is Jon Kar Len Mar Nor Os Per Ros Sam Tor Vin".split(), "a e i o ba di la mo re si ta vi".split(), "n r s ld rt".split(), "a ia ina elle ine".split(), "son mann ez er ley".split()),
    "cyrillic": ("Ал Бор Вик Ген Дан Ев Зах Ив Кир Лев Мак Ник Ол Пав Ром Сер Тим Фед Эд Яр".split(), "а е и о ба ди ла мо ре си та ви".split(), "н р с й л".split(), "а ия ина ова ева".split(), "ко ский ин енко юк".split()),
}
TRIES = 40


def _has(pattern: str, m: Column) -> Column:
    return m.rlike(f"^(?:{pattern})$")


def kind(m: Column) -> Column:
    """Of an entity; ``mention`` if it is a name without a title."""
    found = F.lit("mention")
    for name, pattern in (("name", NAME), ("secret", SECRET), ("phone", PHONE), ("ip6", IP6), ("ip", IP), ("card", CARD), ("national", NATIONAL), ("iban", IBAN), ("email", EMAIL)):
        found = F.when(_has(pattern, m), F.lit(name)).otherwise(found)
    return found


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, r"\D", "")


def _name(m: Column) -> Column:
    """All words of a name but its titles."""
    return F.split(F.regexp_replace(m, f"^{TITLES}", ""), " ")


def _given(m: Column) -> Column:
    return F.when(m.rlike(rf"^(?:{FEMALE})\b"), "woman").otherwise("man")


def normal_parts(m: Column) -> Column:
    """``[(kind, value)]`` of an entity: one for most, one for each full word of a name, none for a mention."""
    of, words = kind(m), F.filter(_name(m), lambda w: w.rlike(f"^{WORD}$"))
    one = lambda name, value: F.struct(name.alias("kind"), value.alias("value"))
    part = lambda w, i: one(F.when(i == F.size(words) - 1, "family").otherwise(_given(m)), F.lower(w))
    return (
        F.when(of == "name", F.transform(words, part))
        .when(of == "mention", F.array().cast("array<struct<kind:string,value:string>>"))
        .when(of.isin("email", "secret", "ip", "ip6"), F.array(one(of, F.lower(m))))
        .when(of == "iban", F.array(one(of, F.lower(F.regexp_replace(m, " ", "")))))
        .otherwise(F.array(one(of, _digits(m))))
    )


def _draw(seed: Column, at: Column | int, n: int) -> Column:
    """A number below ``n`` from the hex digest ``seed``, another for each place."""
    return F.pmod(F.xxhash64(seed, F.lit(at) if isinstance(at, int) else at), F.lit(n)).cast("int")


def _pick(seed: Column, at: int, choices: list[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, choices)), _draw(seed, at, len(choices)) + 1)


def _made_name(seed: Column, of: Column, value: Column) -> Column:
    def made(parts):
        opening, middle, man, woman, family = parts
        # longer than the collision checks need to settle quickly, whatever the size of the corpus
        middles = F.concat(*(_pick(seed, 2 + i, middle) for i in range(2)))
        body = F.lower(F.concat(_pick(seed, 1, opening), middles, _pick(seed, 6, opening), _pick(seed, 7, middle)))
        end = F.when(of == "man", _pick(seed, 5, man)).when(of == "woman", _pick(seed, 5, woman)).otherwise(_pick(seed, 5, family))
        return F.concat(body, end)

    return F.when(value.rlike(r"\p{IsCyrillic}"), made(NAME_PARTS["cyrillic"])).otherwise(made(NAME_PARTS["latin"]))


def _characters(seed: Column, value: Column, hexadecimal: bool = False) -> Column:
    """Each letter by a letter, each digit by a digit, the rest as it is."""
    letters = "abcdef" if hexadecimal else "abcdefghijklmnopqrstuvwxyz"
    other = lambda c, i: (
        F.when(c.rlike(r"^[0-9]$"), _draw(seed, i, 10).cast("string"))
        .when(c.rlike(r"^\p{IsCyrillic}$"), F.substring(F.lit("абвгдежзиклмнопрстуфхцчшэюя"), _draw(seed, i, 27) + 1, F.lit(1)))
        .when(c.rlike(r"^\p{IsGreek}$"), F.substring(F.lit("αβγδεζηθικλμνξοπρστυφχψω"), _draw(seed, i, 24) + 1, F.lit(1)))
        .when(c.rlike(r"^\p{L}$"), F.substring(F.lit(letters), _draw(seed, i, len(letters)) + 1, F.lit(1)))
        .otherwise(c)
    )
    return F.array_join(F.transform(F.split(value, ""), other), "")


def _luhn(digits: Column) -> Column:
    """Check sum of a card number modulo 10."""
    def weigh(c, i):
        twice = c.cast("int") * F.when(F.pmod(i, F.lit(2)) == 1, 2).otherwise(1)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    each = F.transform(F.split(F.reverse(digits), ""), weigh)
    return F.pmod(F.aggregate(each, F.lit(0), lambda a, b: a + b), F.lit(10))


def _iban_check(account: Column, country: Column) -> Column:
    """The two check digits of an account number, both in capitals."""
    def rest(a, c):
        n = F.ascii(c)
        return F.when(n < 58, F.pmod(a * 10 + n - 48, F.lit(97))).otherwise(F.pmod(a * 100 + n - 55, F.lit(97)))

    found = F.aggregate(F.split(F.concat(account, country, F.lit("00")), ""), F.lit(0), rest)
    return F.lpad((98 - found).cast("string"), 2, "0")


def surrogate(key: str, of: Column, value: Column, salt: Column) -> Column:
    """The replacement in normal form: same length and characters, valid for its kind.

    Emails keep their ending, phones their first digit, cards their first digit and check sum, IBANs
    their country, with check digits that fit.
    """
    seed = F.sha2(F.concat_ws("|", F.lit(key), of, value, salt.cast("string")), 256)
    octets = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: (_draw(seed, i, 254) + 1).cast("string")), ".")
    ending = F.regexp_extract(value, r"(\.[^.]+)$", 1)
    mail = F.concat(_characters(seed, F.regexp_replace(value, r"\.[^.]+$", "")), ending)
    drawn = F.concat(F.substring(value, 1, 1), _characters(seed, F.substring(value, F.lit(2), F.length(value))))
    card = F.concat(F.substring(drawn, F.lit(1), F.length(drawn) - 1), F.lit("0"))
    card = F.concat(F.substring(drawn, F.lit(1), F.length(drawn) - 1), F.pmod(_luhn(value) - _luhn(card), F.lit(10)).cast("string"))
    country, account = F.upper(F.substring(value, 1, 2)), F.upper(_characters(seed, F.substring(value, F.lit(5), F.length(value))))
    iban = F.concat(country, _iban_check(account, country), account)
    return (
        F.when(of == "email", mail).when(of == "ip", octets).when(of == "card", card).when(of == "iban", F.lower(iban))
        .when(of.isin("secret", "ip6"), _characters(seed, value, hexadecimal=True))
        .when(of.isin("man", "woman", "family"), _made_name(seed, of, value))
        .otherwise(drawn)
    )


def assign(entities: DataFrame, key: str) -> DataFrame:
    """``kind, value, made`` for distinct ``kind, value``: no two alike, none an entity of the corpus.

    Every round draws again for the entities whose replacement is taken, and leaves the others.
    """
    taken = F.col("made").isNotNull()
    state = keep(entities.select("kind", "value", F.lit(0).alias("salt"), surrogate(key, F.col("kind"), F.col("value"), F.lit(0)).alias("made")), "drawn")
    real = entities.select(F.col("kind").alias("k"), F.col("value").alias("v"))
    for salt in range(1, TRIES):
        first = state.filter(taken).groupBy("kind", "made").agg(F.min(F.struct("salt", "value")).alias("first"), F.count(F.lit(1)).alias("n"))
        again = first.filter("n > 1").select("kind", "made", F.col("first.value").alias("keeps"))
        met = state.join(again, ["kind", "made"]).filter("value <> keeps").select("kind", "value")
        shown = state.join(real, (F.col("kind") == F.col("k")) & (F.col("made") == F.col("v")), "left_semi").select("kind", "value")
        bad = keep(met.union(shown).distinct(), "redrawn")
        if not bad.limit(1).count():
            return state.select("kind", "value", "made")
        redraw = state.join(bad.withColumn("bad", F.lit(True)), ["kind", "value"], "left")
        now = F.when(F.col("bad"), F.lit(salt)).otherwise(F.col("salt"))
        fresh = surrogate(key, F.col("kind"), F.col("value"), F.lit(salt))
        state = keep(redraw.select("kind", "value", now.alias("salt"), F.when(F.col("bad"), fresh).otherwise(F.col("made")).alias("made")), "drawn")
    raise RuntimeError(f"replacements still meet after {TRIES} draws")


def _as_written(m: Column, made: Column, fill: str | None) -> Column:
    """``made`` in the spelling of ``m``: upper case if it is, or its characters in the places of those that match ``fill``."""
    if not fill:
        upper = (F.upper(m) == m) & (F.lower(m) != m)
        return F.when(upper, F.upper(made)).otherwise(made)
    characters = F.split(m, "")
    start = F.struct(F.lit("").alias("text"), F.lit(1).alias("at"))
    step = lambda s, c: F.struct(
        F.concat(s["text"], F.when(c.rlike(fill), F.substring(made, s["at"], F.lit(1))).otherwise(c)).alias("text"),
        (s["at"] + F.when(c.rlike(fill), 1).otherwise(0)).alias("at"),
    )
    return F.aggregate(characters, start, step, lambda s: s["text"])


def _replacement(m: Column, made: Column) -> Column:
    """``made`` maps ``kind|value`` to the replacement in normal form."""
    of, parts, words = kind(m), normal_parts(m), _name(m)
    look = lambda k, value: F.try_element_at(made, F.concat_ws("|", k, value))
    first = F.element_at(parts, 1)
    one = look(first["kind"], first["value"])

    def word(w, i):
        """Particles stay; an initial becomes the family name's, a mention what the titled name's word became."""
        value, last = F.lower(w), i == F.size(words) - 1
        man, woman, family = (look(F.lit(k), value) for k in ("man", "woman", "family"))
        titled = F.when(last, family).otherwise(look(_given(m), value))
        mention = F.when(last, F.coalesce(family, man, woman)).otherwise(F.coalesce(man, woman, family))
        new = F.coalesce(F.when(of == "name", titled).otherwise(mention), F.lit("x"))
        spelled = F.when(F.upper(w) == w, F.upper(new)).when(value == w, new).otherwise(F.initcap(new))
        initial = F.concat(F.upper(F.substring(look(F.lit("family"), F.lower(F.element_at(words, -1))), 1, 1)), F.substring(w, 2, 1))
        return F.when((of == "name") & (value == w), w).when((of == "name") & w.rlike(r"^\p{Lu}\.?$"), initial).otherwise(spelled)

    title = F.when(of == "name", F.regexp_extract(m, f"^{TITLES}", 0)).otherwise("")
    name = F.concat(title, F.array_join(F.transform(words, word), " "))
    return (
        F.when(of.isin("name", "mention"), name).when(of.isin("email", "secret", "ip", "ip6"), _as_written(m, one, None))
        .when(of == "iban", _as_written(m, F.upper(one), "^[A-Z0-9]$")).otherwise(_as_written(m, one, r"^\d$"))
    )


def entities_of(text: Column) -> Column:
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def entities_and(names: Column) -> Column:
    """A pattern of entities and of ``names``, one or several in a row: capitalised, or in a row in any case."""
    longest = F.array_sort(names, lambda a, b: F.length(b) - F.length(a))
    any_name = F.concat(F.lit("(?iu:"), F.array_join(longest, "|"), F.lit(")"))
    parts = (rf"{ENTITY}|(?<![\p{{L}}])(?:(?=\p{{Lu}})", r"(?: (?=\p{Lu})", ")*|", "(?: ", r")+)(?![\p{L}])")
    return F.concat(*(c for p in parts[:-1] for c in (F.lit(p), any_name)), F.lit(parts[-1]))


def replace_entities(documents: DataFrame, key: str, n_entities: str | None = None) -> DataFrame:
    """``documents`` with every entity in ``text`` replaced; all else comes through unchanged.

    A null text stays null, one without entities stays as it is, byte for byte.  Rows with equal texts, repeated
    or not, get equal texts.  ``key`` decides all replacements: the same key gives the same ones.
    ``n_entities`` names a column to add with the number of places replaced.
    """
    columns = documents.columns
    marked = documents.withColumn("__found", entities_of(F.coalesce("text", F.lit(""))))
    clean = marked.filter(F.size("__found") == 0)
    hit = marked.filter(F.size("__found") > 0).withColumn("__sha", F.unhex(F.sha2("text", 256)))
    names = F.filter("__found", lambda m: _has(NAME, m))
    hit = hit.withColumn("__names", F.array_distinct(F.flatten(F.transform(names, lambda m: F.transform(normal_parts(m), lambda p: p["value"])))))
    named = F.size("__names") > 0
    hit = hit.withColumn("__pattern", F.when(named, entities_and(F.col("__names"))))
    hit = hit.withColumn("__all", F.when(named, F.regexp_extract_all("text", "__pattern", F.lit(0))).otherwise(F.col("__found")))
    texts = hit.groupBy("__sha").agg(F.first(F.array_union("__found", "__all")).alias("found"))
    parts = keep(texts.select("__sha", F.explode(F.array_distinct(F.flatten(F.transform("found", normal_parts)))).alias("part")).select("__sha", "part.kind", "part.value"), "parts")
    made = keep(assign(keep(parts.select("kind", "value").distinct(), "entities"), key), "made")
    pairs = parts.join(made, ["kind", "value"]).select("__sha", F.struct(F.concat_ws("|", "kind", "value").alias("k"), F.col("made").alias("v")).alias("pair"))
    maps = keep(pairs.groupBy("__sha").agg(F.map_from_entries(F.collect_list("pair")).alias("__made")), "maps").withColumnRenamed("__sha", "__of")
    joined = hit.join(maps, F.col("__sha") == F.col("__of"))
    pieces = F.when(named, F.split("text", F.col("__pattern"), -1)).otherwise(F.split("text", ENTITY, -1))
    new = F.transform("__all", lambda m: _replacement(m, F.col("__made")))
    text = F.array_join(F.flatten(F.zip_with(pieces, F.concat(new, F.array(F.lit("")))  , lambda a, b: F.array(a, b))), "")
    changed = joined.withColumn("text", text)
    count = lambda found: [F.size(found).cast("int").alias(n_entities)] if n_entities else []
    return clean.select(*columns, *count("__found")).unionByName(changed.select(*columns, *count("__all")))


def surrogate_report(documents: DataFrame, key: str) -> DataFrame:
    """``doc_id, text, n_entities`` of every row after :func:`replace_entities`."""
    return replace_entities(documents.select(F.col("doc_id").cast("long"), "text"), key, "n_entities")
