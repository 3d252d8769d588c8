"""Personal data replaced by keyed surrogates of the same type and format. DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.llm.common import Stage

KEY = "surrogates-1"
#: Attempts at surrogates that are no other entity's and occur nowhere, before all entities of a crowded format are dealt anew by a
#: permutation of that format. Names grow by a syllable with every second attempt and so find room by themselves.
ATTEMPTS = 8

_MALE, _FEMALE = "Mr|Herr|Señor|Monsieur|Господин", "Mrs|Ms|Miss|Frau|Señora|Madame|Mme|Госпожа"
#: Patterns by kind; where two begin at one place, the first counts. Each can begin only where its characters begin, so
#: long runs are read once.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])(?=[._%+-]*+[A-Za-z0-9])[A-Za-z0-9._%+-]++@(?=[.-]*+[A-Za-z0-9])[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{4}[ -]){3}[0-9]{4}(?![0-9])|(?<![0-9A-Za-z])[0-9]{13,19}(?![0-9A-Za-z])",
    "name": rf"(?<!\p{{L}})(?:{_MALE}|{_FEMALE})\.? \p{{Lu}}[\p{{Ll}}]+(?: \p{{Lu}}[\p{{Ll}}]+)?",
}
#: Kinds whose surrogates have the entity's format.
_FORMATTED = ("email", "domain", "ip", "phone", "card")
PATTERN = "|".join(f"(?:{pattern})" for pattern in PATTERNS.values())

_LOWER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Names are made of a consonant and a vowel, twice or thrice, and an ending by kind; in Latin and in Cyrillic script.
_CONSONANTS, _VOWELS = ("bdfgklmnprstv", "бвгдклмнпрстф"), ("aeiou", "аеиоу")
_ENDINGS = {
    "given_m": (("n", "s", "r", "k"), ("н", "р", "л", "м")),
    "given_f": (("na", "la", "ra", "ne"), ("на", "ла", "ра", "я")),
    "family": (("sen", "mann", "lin", "dt"), ("ов", "ин", "ев", "ко")),
}


def _chars(text: Column, function) -> Column:
    """``text`` with every character replaced by ``function(character, place)``, places from 1."""
    places = F.sequence(F.lit(1), F.length(text))
    new = F.transform(places, lambda i: function(F.substring(text, i, F.lit(1)), i))
    return F.when(F.length(text) > 0, F.array_join(new, "")).otherwise(text)


def _digest(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", *parts), 512)


def _number(digest: Column, place: Column | int) -> Column:
    """A number below 65536 of a digest, by place."""
    at = F.pmod((F.lit(place) if isinstance(place, int) else place) - 1, F.lit(31)) * 4 + 1
    return F.conv(F.substring(digest, at, F.lit(4)), 16, 10).cast("int")


def _pick(choices: str, number: Column) -> Column:
    return F.substring(F.lit(choices), number % len(choices) + 1, F.lit(1))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _moved(char: Column, first: str, size: int, number: Column) -> Column:
    """Another character of ``size`` in a row from ``first`` on. By one number for all, it is a permutation of them."""
    at = (F.ascii(char) - ord(first) + 1 + number % (size - 1)) % size
    return F.char(at + ord(first))


def _scrambled(text: Column, digest: Column) -> Column:
    """Other letters for letters, other digits for digits."""

    def one(char: Column, place: Column) -> Column:
        number = _number(digest, place)
        return (
            F.when(char.between("a", "z"), _moved(char, "a", 26, number))
            .when(char.between("0", "9"), _moved(char, "0", 10, number))
            .otherwise(char)
        )

    return _chars(text, one)


def _checksum(digits: Column) -> Column:
    """The Luhn sum, modulo 10."""

    def weigh(char: Column, place: Column) -> Column:
        digit = char.cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return F.when(place % 2 == 0, doubled).otherwise(digit)

    backwards = F.reverse(digits)
    places = F.sequence(F.lit(1), F.length(digits))
    values = F.transform(places, lambda i: weigh(F.substring(backwards, i, F.lit(1)), i))
    return F.aggregate(values, F.lit(0), lambda total, value: total + value) % 10


def _local(entity: Column, digest: Column) -> Column:
    """Another local part at the same domain; domains are entities of their own."""
    return F.concat(_scrambled(F.substring_index(entity, "@", 1), digest), F.lit("@"), F.substring_index(entity, "@", -1))


def _domain(entity: Column, digest: Column) -> Column:
    """The last label stays."""
    top = F.substring_index(entity, ".", -1)
    return F.concat(_scrambled(F.substring(entity, F.lit(1), F.length(entity) - F.length(top)), digest), top)


def _octet_range(old: Column, place: Column, entity: Column) -> Column:
    """(low, size, hole) of the values that an octet is dealt from: as many digits, private ranges by themselves."""

    def values(low, size, hole=-1) -> Column:
        return F.struct(*[(F.lit(x) if isinstance(x, int) else x).alias(n) for n, x in (("low", low), ("size", size), ("hole", hole))])

    value, first = old.cast("int"), place == 0
    private = (first & old.isin("10", "192")) | ((place == 1) & entity.startswith("192.168."))
    return (
        F.when(private, values(value, 1))
        .when(F.length(old) == 1, values(0, 10))
        .when(old.startswith("0"), F.when(F.length(old) == 2, values(0, 10)).otherwise(values(0, 100)))
        .when(F.length(old) == 2, F.when(first, values(11, 89)).otherwise(values(10, 90)))
        .when(value >= 256, values(256, 744))
        .when(first, F.when(value < 224, values(100, 124, 192)).otherwise(values(224, 32)))
        .when((place == 1) & entity.startswith("192."), values(100, 156, 168))
        .otherwise(values(100, 156))
    )


def _ip(entity: Column, digest: Column) -> Column:
    """Octets of as many digits; private ranges stay private, and no other address becomes private."""

    def octet(old: Column, place: Column) -> Column:
        held = _octet_range(old, place, entity)
        low, hole = held["low"], held["hole"]
        size = held["size"] - F.when(hole >= 0, 1).otherwise(0)
        value = old.cast("int")
        at = value - low - F.when((hole >= 0) & (value > hole), 1).otherwise(0)
        moved = low + (at + 1 + _number(digest, place + 1) % F.greatest(size - 1, F.lit(1))) % size
        new = moved + F.when((hole >= 0) & (moved >= hole), 1).otherwise(0)
        return F.when(held["size"] == 1, old).otherwise(F.lpad(new.cast("string"), F.length(old), F.lit("0")))

    return F.array_join(F.transform(F.split(entity, r"\."), octet), ".")


def _phone(entity: Column, digest: Column) -> Column:
    """The country code stays, the ten digits after it change; the first of them is 0 or 1 only if it was."""
    code = F.length(entity) - 10

    def one(char: Column, place: Column) -> Column:
        number = _number(digest, place)
        first = F.when(char < "2", _moved(char, "0", 2, F.lit(0))).otherwise(_moved(char, "2", 8, number))
        return F.when(place <= code, char).when(place == code + 1, first).otherwise(_moved(char, "0", 10, number))

    return _chars(entity, one)


def _card(entity: Column, digest: Column) -> Column:
    """The first digit stays and so does the checksum: valid numbers stay valid."""
    size = F.length(entity)
    body = _chars(
        F.substring(entity, F.lit(1), size - 1), lambda c, i: F.when(i == 1, c).otherwise(_moved(c, "0", 10, _number(digest, i)))
    )
    last = F.pmod(_checksum(entity) - _checksum(F.concat(body, F.lit("0"))), F.lit(10))
    return F.concat(body, last.cast("string"))


def format_class(kind: Column, entity: Column) -> Column:
    """What a surrogate has in common with its entity: those of one class are dealt from one space, of others from others."""

    def shape(text: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(text, "[a-z]", "a"), "[0-9]", "0")

    def octet(old: Column, place: Column) -> Column:
        held = _octet_range(old, place, entity)
        return F.concat_ws(":", F.length(old).cast("string"), held["low"].cast("string"), held["size"].cast("string"))

    top = F.substring_index(entity, ".", -1)
    area = F.substring(entity, F.lit(1), F.length(entity) - 10)
    return (
        F.when(kind == "email", F.concat(shape(F.substring_index(entity, "@", 1)), F.lit("@"), F.substring_index(entity, "@", -1)))
        .when(kind == "domain", F.concat(shape(F.substring(entity, F.lit(1), F.length(entity) - F.length(top))), top))
        .when(kind == "ip", F.array_join(F.transform(F.split(entity, r"\."), octet), "."))
        .when(kind == "phone", F.concat(area, F.when(F.substring(entity, F.length(entity) - 9, F.lit(1)) < "2", ":0").otherwise(":2")))
        .when(kind == "card", F.concat_ws(":", F.length(entity).cast("string"), F.substring(entity, 1, 1), _checksum(entity).cast("string")))
    )


def _name(entity: Column, kind: Column, digest: Column, attempt: Column) -> Column:
    """A name of the kind, in the script of the entity. Cyrillic family names keep the female ending."""
    count = 2 + _number(digest, 9) % 2 + F.floor(attempt / 2).cast("int")

    def made(script: int) -> Column:
        syllables = F.transform(
            F.sequence(F.lit(1), count),
            lambda i: F.concat(_pick(_CONSONANTS[script], _number(digest, 9 + 2 * i)), _pick(_VOWELS[script], _number(digest, 10 + 2 * i))),
        )
        endings = reduce(
            lambda chain, item: chain.when(kind == item[0], F.element_at(F.array(*map(F.lit, item[1][script])), _number(digest, 10) % 4 + 1)),
            list(_ENDINGS.items())[1:],
            F.when(
                kind == "given_m",
                F.element_at(F.array(*map(F.lit, _ENDINGS["given_m"][script])), _number(digest, 10) % 4 + 1),
            ),
        )
        return F.concat(F.array_join(syllables, ""), endings)

    cyrillic = F.concat(made(1), F.when((kind == "family") & entity.endswith("а"), "а").otherwise(""))
    return F.when(entity.rlike(r"\p{IsCyrillic}"), cyrillic).otherwise(made(0))


def _formatted(kind: Column, entity: Column, digest: Column) -> Column:
    """The surrogate of an entity with a format. By one digest for a whole class, it is a permutation without fixed points."""
    return (
        F.when(kind == "email", _local(entity, digest))
        .when(kind == "domain", _domain(entity, digest))
        .when(kind == "ip", _ip(entity, digest))
        .when(kind == "phone", _phone(entity, digest))
        .when(kind == "card", _card(entity, digest))
    )


def surrogate(kind: Column, entity: Column, attempt: Column, key: str = KEY) -> Column:
    """An attempt at the surrogate of a canonical entity. That of an address keeps its domain, which is an entity of its own."""
    digest = _digest(F.lit(key), kind, entity, attempt.cast("string"))
    return F.coalesce(_formatted(kind, entity, digest), _name(entity, kind, digest, attempt))


def kind_of(raw: Column) -> Column:
    kinds = list(PATTERNS.items())
    return reduce(lambda chain, item: chain.when(raw.rlike(f"^(?:{item[1]})$"), item[0]), kinds[1:], F.when(raw.rlike(f"^(?:{kinds[0][1]})$"), kinds[0][0]))


def entities_in(raw: Column) -> Column:
    """The (kind, entity) parts of a match in canonical form: digits of numbers, lower case of addresses and names."""
    kind = kind_of(raw)
    words = F.split(raw, " ")
    gender = F.when(raw.rlike(rf"^(?:{_FEMALE})\.? "), "given_f").otherwise("given_m")
    family = F.struct(F.lit("family").alias("kind"), F.lower(F.element_at(words, -1)).alias("entity"))
    given = F.struct(gender.alias("kind"), F.lower(F.element_at(words, 2)).alias("entity"))
    entity = F.when(kind.isin("phone", "card"), _digits(raw)).otherwise(F.lower(raw))
    return F.when(
        kind == "name", F.when(F.size(words) > 2, F.array(given, family)).otherwise(F.array(family))
    ).otherwise(F.array(F.struct(kind.alias("kind"), entity.alias("entity"))))


def rendered(raw: Column, kind: Column, found: Column) -> Column:
    """The surrogates ``found`` of a match's parts, in the match's own format."""
    only = found[0]

    def digit(char: Column, place: Column) -> Column:
        before = F.length(_digits(F.substring(raw, F.lit(1), place)))
        return F.when(char.between("0", "9"), F.substring(only, before, F.lit(1))).otherwise(char)

    cased = _chars(only, lambda c, i: F.when(F.substring(raw, i, F.lit(1)).between("A", "Z"), F.upper(c)).otherwise(c))
    name = F.concat_ws(" ", F.split(raw, " ")[0], F.array_join(F.transform(found, F.initcap), " "))
    return (
        F.when(kind == "email", cased)
        .when(kind == "ip", only)
        .when(kind == "name", name)
        .otherwise(_chars(raw, digit))
    )


def _judged(made: DataFrame, entities: DataFrame) -> DataFrame:
    """``made`` with ``clash``: its surrogate is a smaller entity's, too, or occurs as an entity."""
    owners = made.groupBy("kind", "surrogate").agg(F.min("entity").alias("owner"))
    real = entities.select("kind", F.col("entity").alias("surrogate"), F.lit(True).alias("real"))
    judged = made.join(owners, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
    return judged.withColumn("clash", (F.col("owner") != F.col("entity")) | F.coalesce("real", F.lit(False))).drop("owner", "real")


def assign(entities: DataFrame, stage: Stage, key: str = KEY) -> DataFrame:
    """(kind, entity, surrogate) of distinct (kind, entity) rows; no two entities of a kind share a surrogate.

    Of those that clash with each other, all but the smallest try again, and so do those whose surrogate occurs as an
    entity. Attempts depend on the whole set, so entities that clash may change when others come. A format whose
    entities fill so much of its space that attempts do not end is dealt anew as a whole, by a keyed permutation of the format: always
    distinct and never the entity itself, though it may be another one. Only a domain without any letter or digit before its last label
    stays as it is.
    """
    classed = F.concat_ws("\x1f", "kind", format_class(F.col("kind"), F.col("entity")))
    tried = entities.select("kind", "entity", classed.alias("class"), F.lit(0).alias("attempt"))
    done, attempts = None, 0
    while True:
        made = tried.withColumn("surrogate", surrogate(F.col("kind"), F.col("entity"), F.col("attempt"), key))
        judged = stage(_judged(stage(made), entities))
        clashes = judged.filter("clash")
        attempts += 1
        if clashes.isEmpty():
            break
        if attempts == ATTEMPTS:
            full = stage(clashes.filter(F.col("kind").isin(*_FORMATTED)).select("class").distinct())
            dealt = _formatted(F.col("kind"), F.col("entity"), _digest(F.lit(key), F.lit("class"), F.col("class")))
            done = stage(judged.join(full, "class", "left_semi").withColumn("surrogate", dealt))
            judged = stage(judged.join(full, "class", "left_anti"))
        tried = judged.select("kind", "entity", "class", (F.col("attempt") + F.col("clash").cast("int")).alias("attempt"))
    found = judged if done is None else judged.unionByName(done)
    return found.select("kind", "entity", "surrogate")


def _whole_addresses(names: DataFrame) -> DataFrame:
    """The surrogates of addresses with those of their domains."""
    domains = names.filter("kind = 'domain'").select(F.col("entity").alias("domain"), F.col("surrogate").alias("new_domain"))
    mails = names.filter("kind = 'email'").withColumn("domain", F.substring_index("entity", "@", -1)).join(domains, "domain")
    new = F.concat(F.substring_index("surrogate", "@", 1), F.lit("@"), F.col("new_domain"))
    return names.filter("kind not in ('email', 'domain')").unionByName(mails.select("kind", "entity", new.alias("surrogate")))


def _times_in(kinds: Column, kind: str) -> Column:
    return F.size(F.filter(kinds, lambda k: k == kind))


def replace(docs: DataFrame, stage: Stage | None = None, key: str = KEY) -> DataFrame:
    """``docs`` (text among its columns) with surrogates in ``text`` and the number of matches of each kind in ``found``.

    One entity has one surrogate in all documents, whatever its format; different entities have different ones. Texts without
    matches, null and empty texts stay as they are and are not shuffled. Repeated rows get the same text. An empty table gives no
    row. A column named ``found`` is replaced; all others pass through. A text's work grows with its length and its
    matches, of which each is a row of its own until they are put in their places.
    """
    stage = stage or Stage(docs.sparkSession)
    text = F.col("text")
    hit = F.coalesce(text.rlike(PATTERN), F.lit(False))
    blob = F.unhex(F.sha2(text, 256))
    with_data = docs.filter(hit)
    matches = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    listed = stage(with_data.select(blob.alias("blob"), matches.alias("matches")).dropDuplicates(["blob"]))
    found = listed.select("blob", F.posexplode("matches").alias("place", "raw"))
    raws = stage(found.select("raw").distinct().withColumn("parts", entities_in(F.col("raw"))))
    entities = raws.select(F.explode("parts").alias("part")).select("part.*").distinct()
    domains = entities.filter("kind = 'email'").select(F.lit("domain").alias("kind"), F.substring_index("entity", "@", -1).alias("entity"))
    entities = stage(entities.unionByName(domains.distinct()))
    names = stage(_whole_addresses(assign(entities, stage, key)))
    parts = raws.select("raw", F.posexplode("parts").alias("place", "part")).select("raw", "place", "part.*")
    new = stage(
        parts.join(names, ["kind", "entity"])
        .groupBy("raw")
        .agg(F.sort_array(F.collect_list(F.struct("place", "surrogate"))).alias("found"))
        .withColumn("kind", kind_of(F.col("raw")))
        .select("raw", "kind", rendered(F.col("raw"), F.col("kind"), F.col("found.surrogate")).alias("new"))
    )
    # A text's matches in order: as many as it has.
    lists = stage(
        found.join(new, "raw").groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("place", "new", "kind"))).alias("news"))
    )
    between = F.split(text, PATTERN, -1)
    woven = F.zip_with(between, F.concat("news.new", F.array(F.lit(""))), lambda a, b: F.concat(a, b))
    counts = F.map_from_arrays(F.array(*map(F.lit, PATTERNS)), F.array(*[_times_in(F.col("news.kind"), kind) for kind in PATTERNS]))
    others = [c for c in docs.columns if c != "found"]
    changed = with_data.select(F.struct(*[docs[f"`{c}`"] for c in others]).alias("row"), blob.alias("blob")).join(lists, "blob")
    changed = changed.withColumn("text", F.col("row.text"))
    changed = changed.select(
        *[F.array_join(woven, "").alias("text") if c == "text" else F.col(f"row.`{c}`") for c in others], counts.alias("found")
    )
    none = F.map_from_arrays(F.array(*map(F.lit, PATTERNS)), F.array(*[F.lit(0)] * len(PATTERNS)))
    return changed.unionByName(docs.filter(~hit).select(*[docs[f"`{c}`"] for c in others], none.alias("found")))
