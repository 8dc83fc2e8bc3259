"""Replace personal data by keyed surrogates of the same kind and form.

One regular expression marks every entity with its kind.  A surrogate depends
on a key, the kind and the lower-cased entity, so that one entity has one
surrogate everywhere, in the case of each occurrence.  Digits stay digits and
letters letters of their case; separators stay; a card number that passes the
Luhn check has a surrogate that does; an address keeps valid octets; names
follow an honorific or repeat, by themselves, one that does in the same text; a
given name keeps its gender and script, a Cyrillic surname its ending's gender.

Surrogates are checked over the whole corpus: those that two entities share, or
that are an entity of the corpus, are drawn again, until all are distinct.  A form
may have too few values for that, so every ``DRAWS`` draws make it one letter, digit
or octet longer.  Only
redrawn entities need a join; all other text is rewritten where it is read.

Everything is built-in functions.

Defined cases: a null text stays null and an empty one empty; documents without
entities are unchanged; repeated rows stay repeated; the marks used are Unicode
noncharacters, and texts that hold them keep them; other columns pass through,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.llm.common import bound, written

#: Honorifics by gender.
_MALE = ["Mr", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "Г-н", "Господин"]
_FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Sra", "Señorita", "Doña", "Г-жа", "Госпожа"]
#: Syllables and endings that names are made of, by script.
_SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe ga go ja jo ka ke ki ko la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se si so ta te ti to va ve vi za".split(),
    "cyrillic": "ба бе би бо ва ве ви во га го да де ди до за зе ка ке ки ко ла ле ли ло ма ме ми мо на не ни но па пе ра ре ри ро са се си со та те ти то".split(),
}
_ENDINGS = {
    ("latin", "m"): ["rd", "nus", "ldo", "rik", "mon", "bert", "vin", "ton"],
    ("latin", "f"): ["lia", "rina", "ssa", "nna", "dora", "lina", "tta", "mira"],
    ("latin", "s"): ["man", "ner", "sen", "ley", "witz", "dal", "berg", "field"],
    ("cyrillic", "m"): ["слав", "мир", "рий", "тин", "лад", "дор", "кар", "лон"],
    ("cyrillic", "f"): ["лия", "рина", "сса", "нна", "дора", "лина", "тта", "мира"],
    ("cyrillic", "s"): ["ский", "енко", "ич", "ук", "аль", "берг", "ман", "дзе"],
    ("cyrillic", "a"): ["ская", "цкая", "ова", "ева", "ина", "ёва", "нова", "лова"],
}
#: Draws of one form before it grows.
DRAWS = 4

_OPEN, _CLOSE, _ESCAPE = "﷐", "﷑", "﷒"
_NAME = r"\p{Lu}[\p{L}'’-]{1,30}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"


def _title(honorifics: list[str]) -> str:
    return rf"((?:{'|'.join(honorifics)})(?:\. ?| ))"


_ANY = _MALE + _FEMALE
#: Male and female given name with surname, or a surname alone; a first letter is tried before all else.
_NAMES = (
    rf"(?=[{''.join(sorted({h[0] for h in _ANY}))}])(?<![\p{{L}}\p{{N}}])"
    rf"(?:{_title(_MALE)}({_NAME})( )({_NAME})|{_title(_FEMALE)}({_NAME})( )({_NAME})|{_title(_ANY)}({_NAME}))"
)
_EMAIL = r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"
#: One letter per kind, and what marks it; the first that matches wins.
_CODES: dict[str, str] = {
    "K": r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|(?:sk|ghp|xoxb)[-_][A-Za-z0-9]{16,64})(?![A-Za-z0-9])",
    "I": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)",
    "N": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "P": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4})(?!\d)",
    "C": r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])",
}
#: What each of these patterns implies, so that texts without it need no search.
_CODED = "[0-9]|AKIA|[-_]"
#: Marks made before are passed over.
_CODE = (
    rf"(?=[{_OPEN}0-9+(Asgx])(?:({_OPEN}[^{_CLOSE}]*{_CLOSE})|"
    + "|".join(f"({p})" for p in _CODES.values())
    + ")"
)


def _mark(kind: str, group: int) -> str:
    return f"{_OPEN}{kind}${group}{_CLOSE}"


def _mentioned(kind: str):
    """Names of a kind that are marked once, marked wherever they stand by themselves, not in an address."""
    apart, entity = r"\p{L}\p{N}", f"{_OPEN}{kind}([^{_CLOSE}]*){_CLOSE}"

    def mark(text: Column) -> Column:
        named = F.array_distinct(F.regexp_extract_all(text, F.lit(entity), F.lit(1)))
        alone = F.concat(
            F.lit(f"({_OPEN}[^{_CLOSE}]*{_CLOSE})|(?<![{apart}'’@._%+-])("),
            F.array_join(named, "|"),
            F.lit(f")(?![{apart}@_%+-]|\\.[{apart}])"),
        )
        replaced = F.regexp_replace(text, alone, F.lit("$1" + _mark(kind, 2)))
        return F.when(F.size(named) > 0, F.replace(replaced, F.lit(f"{_OPEN}{kind}{_CLOSE}"), F.lit(""))).otherwise(text)

    return mark


def _with_mentions(marked: Column) -> Column:
    for kind in "MFS":
        marked = bound(marked, _mentioned(kind))
    return marked


def _marked(text: Column) -> Column:
    """Entities between marks, with the letter of their kind.

    A group that did not take part leaves an empty mark, which is removed.
    """

    def without_empty(marked: Column) -> Column:
        return F.regexp_replace(marked, f"{_OPEN}[A-Z]{_CLOSE}", "")

    escaped = text
    for n, mark in enumerate((_ESCAPE, _OPEN, _CLOSE)):
        escaped = F.replace(escaped, F.lit(mark), F.lit(f"{_ESCAPE}{n}"))
    parts = "$1" + _mark("M", 2) + "$3" + _mark("S", 4) + "$5" + _mark("F", 6) + "$7" + _mark("S", 8) + "$9" + _mark("S", 10)
    names = F.regexp_replace(escaped, _NAMES, parts)
    found = bound(without_empty(names), _with_mentions)
    names = F.when(F.contains(names, F.lit(_OPEN)), found).otherwise(escaped)

    def with_email(t: Column) -> Column:
        return F.when(F.contains(t, F.lit("@")), F.regexp_replace(t, _EMAIL, _mark("E", 1))).otherwise(t)

    codes = "$1" + "".join(_mark(kind, n) for n, kind in enumerate(_CODES, 2))

    def with_codes(t: Column) -> Column:
        found = without_empty(F.regexp_replace(t, _CODE, codes))
        return F.when(F.regexp_like(t, F.lit(_CODED)), found).otherwise(t)

    return bound(bound(names, with_email), with_codes)


def _unescaped(text: Column) -> Column:
    for n, mark in ((2, _CLOSE), (1, _OPEN), (0, _ESCAPE)):
        text = F.replace(text, F.lit(f"{_ESCAPE}{n}"), F.lit(mark))
    return text


def _hash(key: str, kind: Column, normal: Column, attempt: Column) -> Column:
    """256 hexadecimal digits."""
    seed = F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), normal)
    return F.concat(F.sha2(F.concat(seed, F.lit("|0")), 512), F.sha2(F.concat(seed, F.lit("|1")), 512))


def _byte(digits: Column, n: Column) -> Column:
    at = (n % 128) * 2 + 1
    return F.conv(digits.substr(at.cast("int"), F.lit(2)), 16, 10).cast("int")


def _same_form(value: Column, digits: Column, kept: Column) -> Column:
    """Digits for digits and letters for letters, from character ``kept`` (from 0) on."""

    def mapped(c: Column, n: Column) -> Column:
        drawn = _byte(digits, n)
        return (
            F.when(n < kept, c)
            .when(c.between("0", "9"), (drawn % 10).cast("string"))
            .when(c.between("a", "z"), F.char(F.lit(97) + drawn % 26))
            .when(c.between("A", "Z"), F.char(F.lit(65) + drawn % 26))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, "(?!^)(?!$)"), mapped), "")


def _luhn(number: Column) -> Column:
    """The Luhn sum of the digits of ``number``, modulo 10."""
    digits = F.split(F.reverse(F.regexp_replace(number, r"\D", "")), "(?!^)(?!$)")

    def part(c: Column, n: Column) -> Column:
        d = c.cast("int") * (n % 2 + 1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(digits, part), F.lit(0), lambda a, x: a + x) % 10


def _name(value: Column, kind: Column, digits: Column, attempt: Column) -> Column:
    """Two syllables or more and an ending, capital as in ``value``."""

    def made(script: str) -> Column:
        syllables = F.array(*map(F.lit, _SYLLABLES[script]))
        stem = F.array_join(
            F.transform(
                F.sequence(F.lit(0), F.lit(1) + F.floor(attempt / DRAWS).cast("int")),
                lambda n: F.get(syllables, _byte(digits, n) % len(_SYLLABLES[script])),
            ),
            "",
        )
        endings = {k: F.array(*map(F.lit, e)) for (s, k), e in _ENDINGS.items() if s == script}
        of = F.when(kind == "M", endings["m"]).when(kind == "F", endings["f"])
        if "a" in endings:
            of = of.when(F.regexp_like(F.lower(value), F.lit("[ая]$")), endings["a"])
        of = of.otherwise(endings["s"])
        return F.concat(stem, F.get(of, _byte(digits, F.lit(100)) % 8))

    name = F.when(F.regexp_like(value, F.lit(r"\p{IsCyrillic}")), made("cyrillic")).otherwise(made("latin"))
    capital = (F.upper(value) == value) & (F.length(value) > 1)
    return F.when(capital, F.upper(name)).when(F.lower(value) == value, name).otherwise(F.initcap(name))


def surrogate(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    drawn = _hash(key, kind, F.lower(value), attempt)
    more = F.floor(attempt / DRAWS).cast("int")

    def longer(filler: str) -> Column:
        return F.repeat(F.lit(filler), more)

    form = (
        F.when(kind.isin("M", "F", "S") | (more == 0), value)
        .when(kind == "E", F.concat(longer("a"), value))
        .when(kind == "I", F.concat(value, longer(".0")))
        .when(kind == "K", F.concat(value, longer("a")))
        .otherwise(F.concat(value, longer("0")))
    )
    return bound(drawn, lambda digits: bound(form, lambda f: _surrogate(kind, f, digits, attempt)))


def _surrogate(kind: Column, value: Column, digits: Column, attempt: Column) -> Column:
    start = F.lit(0)
    plain = _same_form(value, digits, start)
    address = F.array_join(
        F.transform(
            F.split(value, r"\."),
            lambda c, n: F.when(n == 0, _byte(digits, n) % 223 + 1).otherwise(_byte(digits, n)).cast("string"),
        ),
        ".",
    )
    last = F.substring_index(value, ".", -1)
    host = value.substr(F.lit(1), F.length(value) - F.length(last))
    email = F.concat(_same_form(host, digits, start), last)
    phone = _same_form(value, digits, F.length(F.regexp_extract(value, r"^\+\d{1,2}", 0)))
    token = _same_form(value, digits, F.length(F.regexp_extract(value, r"^(AKIA|sk[-_]|ghp[-_]|xoxb[-_])", 0)))
    drawn = _same_form(value, digits, F.lit(1))
    body = drawn.substr(F.lit(1), F.length(drawn) - 1)
    check = (10 - _luhn(F.concat(body, F.lit("0")))) % 10
    card = F.when(_luhn(value) == 0, F.concat(body, check.cast("string"))).otherwise(drawn)
    return (
        F.when(kind == "E", email)
        .when(kind == "I", address)
        .when(kind == "P", phone)
        .when(kind == "C", card)
        .when(kind == "K", token)
        .when(kind.isin("M", "F", "S"), _name(value, kind, digits, attempt))
        .otherwise(plain)
    )


def _family(kind: Column) -> Column:
    """Kinds whose surrogates must differ from each other."""
    return F.when(kind.isin("M", "F"), F.lit("G")).otherwise(kind)


def distinct_attempts(entities: DataFrame, key: str) -> DataFrame:
    """``entities`` (kind, normal; distinct) with the attempt whose surrogate is theirs alone."""
    table = written(entities.withColumn("attempt", F.lit(0)), "entities")
    while True:
        drawn = table.withColumn(
            "drawn", F.lower(surrogate(key, F.col("kind"), F.col("normal"), F.col("attempt")))
        ).withColumn("family", _family(F.col("kind")))
        same = Window.partitionBy("family", "drawn").orderBy("attempt", "kind", "normal")
        originals = drawn.select("family", F.col("normal").alias("drawn")).distinct()
        originals = originals.withColumn("taken", F.lit(True))
        again = (F.row_number().over(same) > 1) | F.coalesce("taken", F.lit(False))
        checked = written(
            drawn.join(originals, ["family", "drawn"], "left").withColumn("again", again)
            .select("kind", "normal", (F.col("attempt") + F.col("again").cast("int")).alias("attempt"), "again"),
            "checked",
        )
        if checked.filter("again").isEmpty():
            return checked.drop("again")
        table = checked.drop("again")


def replaced(documents: DataFrame, key: str, text: str = "text") -> tuple[DataFrame, str]:
    """``documents`` with surrogates in ``text``; and the name of an added count of entities."""
    taken = set(documents.columns)

    def free(name: str) -> str:
        return name if name not in taken else free(f"{name}_")

    row, kinds, values, pieces, count = map(free, ("row", "kinds", "values", "pieces", "n_entities"))
    marked, redrawn = free("marked"), free("redrawn")
    entity = f"{_OPEN}([A-Z])([^{_CLOSE}]*){_CLOSE}"
    found = documents.withColumn(marked, _marked(F.col(f"`{text}`")))
    has = F.coalesce(F.contains(F.col(marked), F.lit(_OPEN)), F.lit(False))
    clean = found.filter(~has).drop(marked).withColumn(count, F.lit(0).cast("long"))
    private = (
        found.filter(has)
        .withColumn(kinds, F.regexp_extract_all(F.col(marked), F.lit(entity), F.lit(1)))
        .withColumn(values, F.regexp_extract_all(F.col(marked), F.lit(entity), F.lit(2)))
        .withColumn(pieces, F.split(F.col(marked), entity, -1))
        .drop(marked, text)
        .withColumn(row, F.monotonically_increasing_id())
    )
    private = written(private, "private")
    occurrences = private.select(
        F.col(row).alias("row"), F.explode(F.arrays_zip(F.col(kinds).alias("kind"), F.col(values).alias("value"))).alias("e")
    ).select("row", "e.kind", F.lower("e.value").alias("normal"))
    attempts = distinct_attempts(occurrences.select("kind", "normal").distinct(), key)
    changed = written(attempts.filter("attempt > 0"), "redrawn")
    by_row = (
        occurrences.distinct()
        .join(changed, ["kind", "normal"])
        .groupBy("row")
        .agg(F.map_from_entries(F.collect_list(F.struct(F.concat("kind", "normal"), "attempt"))).alias(redrawn))
        .withColumnRenamed("row", row)
    )
    joined = private.join(by_row, row, "left")

    def drawn(kind: Column, value: Column) -> Column:
        known = F.try_element_at(F.col(redrawn), F.concat(kind, F.lower(value)))
        return surrogate(key, kind, value, F.coalesce(known, F.lit(0)))

    surrogates = F.zip_with(kinds, values, drawn)
    whole = F.concat(
        F.array_join(F.zip_with(F.slice(pieces, 1, F.size(kinds)), surrogates, lambda p, s: F.concat(p, s)), ""),
        F.element_at(pieces, -1),
    )
    rewritten = joined.withColumn(text, _unescaped(whole)).withColumn(count, F.size(kinds).cast("long"))
    order = [*documents.columns, count]
    columns = [F.col(f"`{c}`") for c in order]
    return rewritten.select(*columns).unionByName(clean.select(*columns)), count
