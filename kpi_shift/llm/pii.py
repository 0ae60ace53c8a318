"""Personal data replaced by surrogates, in DataFrame functions only.

Mail addresses, phone numbers, IP addresses, card and account numbers, keys, secrets and names are found by patterns.
Each entity has a canonical form (digits of a number, lower case of an address), from which a keyed hash draws the core
of its surrogate: the same entity gets the same surrogate everywhere. The core is poured into the format of the mention:
separators, lengths, upper and lower case, script, a valid check digit, and the gender of given names are kept.

Two entities must not share a surrogate, and no surrogate may be a real entity of the corpus. Colliding draws are found
by grouping all distinct cores; all but the first entity draw again until none collide. Those further draws are the only
state; they reach the documents by a join, and usually there are none. What is drawn is what is written: a phone number's country
code is kept and no part of the draw, so numbers that differ in what is drawn differ in the text too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpi_shift.functions.lookup import lookup_join
from kpi_shift.functions.stage import stage
from kpi_shift.llm.text import packed, unpacked

ROUNDS = 30
#: Digits up to which a phone number's surrogate is its image under a permutation: so few values would soon all be taken.
SHORT = 6
# Country calling codes of one and two digits; the others have three.
CALLING_CODE = r"^\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{1,3})"
# Marks of names, and given names by gender and script.
MALE_TITLES = ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Don", "Sir", "Господин")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Doña", "Госпожа")
TITLES = ("Dr", "Prof")
MALE = ("James", "John", "Robert", "Michael", "David", "Thomas", "Daniel", "Paul", "Peter", "Hans", "Karl", "Stefan", "Pierre", "Jean", "Louis", "Carlos", "José", "Juan", "Luis", "Miguel")
FEMALE = ("Mary", "Anna", "Susan", "Linda", "Sarah", "Emma", "Laura", "Julia", "Helga", "Ursula", "Petra", "Claire", "Marie", "Sophie", "Carmen", "Elena", "Lucía", "María", "Isabel", "Rosa")
MALE_CYRILLIC = ("Иван", "Пётр", "Сергей", "Алексей", "Дмитрий", "Николай")
FEMALE_CYRILLIC = ("Анна", "Мария", "Елена", "Ольга", "Татьяна", "Наталья")
SYLLABLES = ("ba", "bel", "cor", "dan", "del", "fen", "gar", "hal", "jen", "kel", "lan", "lor", "mar", "nel", "nor", "pel", "quin", "ren", "sal", "tor", "ul", "ven", "wil", "zan")
CYRILLIC_SYLLABLES = ("ба", "вер", "гор", "дан", "жел", "зар", "кор", "лан", "мир", "нов", "пет", "рад", "сол", "тар", "ус", "чер")

_NAME = r"\p{Lu}[\p{L}'’-]+"
_GIVEN = "|".join(MALE + FEMALE + MALE_CYRILLIC + FEMALE_CYRILLIC)
_ALL_TITLES = "|".join(MALE_TITLES + FEMALE_TITLES + TITLES)
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_GAP = r"[^\p{L}\p{N}\n]{0,8}"
_LABELS = r"(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)"
#: Kind and pattern, in the order in which they are tried at one place.
PATTERNS = (
    ("email", r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}"),
    ("key", r"(?<![\p{L}\p{N}])(?:AKIA|ASIA)[A-Z0-9]{16}(?![\p{L}\p{N}])"),
    ("secret", rf"(?<=\b{_LABELS}\s{{0,3}}[=:]\s{{0,3}}[\"']?)[^\s\"'=:,;<>]{{6,}}+"),
    ("iban", r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"),
    ("ip", rf"(?<![\p{{N}}.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\p{{N}})"),
    ("ssn", r"(?<![\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{N}-])"),
    ("secret", r"(?<![\p{L}\p{N}])(?=[A-F]*\d|[a-f]*\d)(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![\p{L}\p{N}])"),
    ("phone", rf"(?<![\p{{L}}\p{{N}}])(?:\+\d{{1,3}}{_GAP})?\(\d{{2,4}}\){_GAP}\d{{3,4}}[ .-]\d{{3,4}}(?!\p{{N}})"),
    ("phone", r"(?<![\p{L}\p{N}+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\p{N})"),
    ("phone", r"(?<![\p{L}\p{N}.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\p{N}-])"),
    ("phone", r"(?<![\p{L}\p{N}.-])\d{3}-\d{4}(?![\p{N}-])"),
    ("account", r"(?<![\p{L}\p{N}.-])\d(?:[ -]?\d){12,18}(?![\p{L}\p{N}])"),
    ("name", rf"(?<!\p{{L}})(?=\p{{Lu}})(?:(?:{_ALL_TITLES})\.? {_NAME}(?: {_NAME})?|(?:{_GIVEN}) {_NAME})"),
)
#: Nothing begins inside a word: most places fail at the first test.
PATTERN = r"(?<![\p{L}\p{N}])(?:" + "|".join(f"(?:{p})" for _, p in PATTERNS) + ")"
#: A capitalised word between mentions, which may be a surname found elsewhere in the text.
BARE = r"(?<![\p{L}\p{N}])\p{Lu}(?:['’]\p{Lu})?\p{L}+(?:-\p{Lu}\p{L}+)*(?![\p{L}\p{N}])"
#: Cheap test that every entity passes.
SIGNS = rf"[0-9@]|(?<!\p{{L}})(?=\p{{Lu}})(?:{_ALL_TITLES}|{_GIVEN})\.? \p{{Lu}}|{_LABELS}\s{{0,3}}[=:]"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def _calling_code(mention: Column) -> Column:
    """Digits of the country's code, which surrogates keep; empty without one."""
    return F.regexp_extract(mention, CALLING_CODE, 1)


def kind(mention: Column) -> Column:
    """Kind of a whole mention. A secret may look like anything: it is what no other pattern covers."""
    found = F.lit("secret")
    for name, pattern in reversed(PATTERNS):
        if name != "secret":
            found = F.when(mention.rlike(f"^(?:{pattern})$"), name).otherwise(found)
    return found


def canonical(what: Column, mention: Column) -> Column:
    """The form that all mentions of one entity share. A name's is its last word: titles and given names may be left out;
    so may a phone number's country code."""
    return (
        F.when(what == "email", F.lower(mention))
        .when(what == "phone", F.substr(_digits(mention), F.length(_calling_code(mention)) + 1, F.length(mention)))
        .when(what.isin("account", "ssn"), _digits(mention))
        .when(what == "iban", F.replace(mention, F.lit(" "), F.lit("")))
        .when(what == "name", F.lower(F.element_at(F.split(mention, " "), -1)))
        .otherwise(mention)
    )


def _stream(key: str, what: Column, value: Column, attempt: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), what, value, attempt.cast("string")), 512)


def _number(stream: Column, place: Column) -> Column:
    """A number below 4096 for each of 126 places."""
    return F.conv(F.substring(stream, (place % F.lit(126)) + 1, F.lit(3)), 16, 10).cast("int")


def _far_number(stream: Column, place: Column) -> Column:
    """A number below 4096 for each place: 126 from the stream, as many from each further block hashed from it."""
    block = F.floor(place / 126).cast("string")
    return _number(F.when(place < 126, stream).otherwise(F.sha2(F.concat_ws("\x1f", stream, block), 512)), place)


def _letters(alphabet: str, at: Column) -> Column:
    return F.substring(F.lit(alphabet), (at % F.lit(len(alphabet))) + 1, F.lit(1))


def _scrambled(stream: Column, value: Column, hexadecimal: Column) -> Column:
    """Each digit and letter replaced by one of its kind; hexadecimal text stays so."""

    def one(c: Column, n: Column) -> Column:
        return (
            F.when(hexadecimal & c.rlike("[a-f]"), _letters("abcdef", n))
            .when(hexadecimal & c.rlike("[A-F]"), _letters("ABCDEF", n))
            .when(c.rlike("[0-9]"), _letters("0123456789", n))
            .when(c.rlike("[A-Z]"), _letters("ABCDEFGHIJKLMNOPQRSTUVWXYZ", n))
            .when(c.rlike("[a-z]"), _letters("abcdefghijklmnopqrstuvwxyz", n))
            .when(c.rlike(r"\p{IsCyrillic}"), _letters("абвгдежзиклмнопрстуфхцчшэюя", n))
            .when(c.rlike(r"\p{IsGreek}"), _letters("αβγδεζηθικλμνξοπρστυφχψω", n))
            .when(c.rlike(r"\p{L}"), _letters("abcdefghijklmnopqrstuvwxyz", n))
            .otherwise(c)
        )

    places = F.split(value, "")
    return F.array_join(F.zip_with(places, F.transform(places, lambda c, i: _far_number(stream, i)), one), "")


def _luhn(digits: Column) -> Column:
    """Sum of the check over digits whose last one is the check digit."""
    turned = F.split(F.reverse(digits), "")
    each = F.transform(turned, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int") + 1)))
    return F.aggregate(each, F.lit(0), lambda a, v: a + v)


def _mod97(text: Column) -> Column:
    """Remainder of the number that digits and letters (A is 10) spell, by which account numbers are checked."""

    def step(a: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), a * 10 + c.cast("int")).when(c.rlike("[A-Z]"), a * 100 + F.ascii(c) - 55).otherwise(a) % 97

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _iban(value: Column, scrambled: Column, stream: Column) -> Column:
    """Country kept, account scrambled, check digits right if they were, wrong if not."""
    country, account = F.substring(value, 1, 2), F.substr(scrambled, F.lit(5), F.length(value))
    right = 98 - _mod97(F.concat(account, country, F.lit("00")))
    wrong = F.pmod(right - 1 + _number(stream, F.lit(120)) % 96, F.lit(97)) + 2
    valid = _mod97(F.concat(F.substr(value, F.lit(5), F.length(value)), F.substring(value, 1, 4))) == 1
    return F.concat(country, F.lpad(F.when(valid, right).otherwise(wrong).cast("string"), 2, "0"), account)


def _permuted(key: str, value: Column) -> Column:
    """Image of up to ``SHORT`` digits under a keyed permutation of all numbers of that length, which leaves none in its place."""
    # odd, no multiple of 5: one to one; the sum of an even product and an odd number is no multiple of the size: no fixed point
    factor, shift = (F.crc32(F.lit(f"{key}\x1f{what}").cast("binary")) % 100_000 * 10 + end for what, end in (("factor", 3), ("shift", 7)))
    size = F.pow(F.lit(10), F.length(value)).cast("long")
    return F.lpad(((factor * value.cast("long") + shift) % size).cast("string"), F.length(value), F.lit("0"))


def _core(key: str, what: Column, value: Column, attempt: Column, stream: Column) -> Column:
    """What tells a surrogate from all others of its kind, drawn from the canonical form."""
    plain = F.lit(False)
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    host = F.regexp_replace(domain, r"\.?[^.]+\.[^.]+$", "")
    new_host = F.when(host == "", F.substring(F.translate(F.sha2(F.concat(stream, F.lit("h")), 256), "0123456789", "ghijklmnop"), 1, 6)).otherwise(
        _scrambled(F.sha2(F.concat(stream, F.lit("h")), 512), host, plain)
    )
    digits = _scrambled(stream, value, plain)
    body = F.concat(F.substring(value, 1, 1), F.substr(digits, F.lit(2), F.length(value) - 2))
    check = F.pmod(10 - _luhn(F.concat(body, F.lit("0"))), F.lit(10))
    account = F.concat(body, F.when(_luhn(value) % 10 == 0, check).otherwise(F.pmod(check + 1 + _number(stream, F.lit(120)) % 9, F.lit(10))).cast("string"))
    octets = F.concat_ws(
        ".",
        (_number(stream, F.lit(1)) % 223 + 1).cast("string"),
        *[(_number(stream, F.lit(i)) % 256).cast("string") for i in (11, 21)],
        (_number(stream, F.lit(31)) % 254 + 1).cast("string"),
    )
    cyrillic = value.rlike(r"\p{IsCyrillic}")

    def syllables(pool: tuple[str, ...]) -> Column:
        entries = F.array(*[F.lit(s) for s in pool])
        parts = [F.element_at(entries, (_number(stream, F.lit(i)) % len(pool)) + 1) for i in (0, 10, 20, 30, 40)]
        return F.concat(*parts[:3], F.when(attempt >= 1, parts[3]).otherwise(F.lit("")), F.when(attempt >= 2, parts[4]).otherwise(F.lit("")))

    return (
        F.when(what == "email", F.concat(_scrambled(stream, local, plain), F.lit("@"), new_host, F.lit(".example.net")))
        .when(what == "key", F.concat(F.substring(value, 1, 4), F.substring(_scrambled(stream, value, plain), 5, 16)))
        .when(what == "iban", _iban(value, _scrambled(stream, value, plain), stream))
        .when(what == "ip", octets)
        .when(what == "account", account)
        .when((what == "phone") & (F.length(value) <= SHORT), _permuted(key, F.when(F.length(value) <= SHORT, value)))
        .when(what.isin("phone", "ssn"), digits)
        .when(what.isin("given_f", "given_m"), _given_core(key, what, value, attempt, stream))
        .when(what == "name", F.when(cyrillic, syllables(CYRILLIC_SYLLABLES)).otherwise(syllables(SYLLABLES)))
        .otherwise(_scrambled(stream, value, value.rlike("^[0-9a-f]{8,}$|^[0-9A-F]{8,}$")))
    )


def _poured(digits: Column, mention: Column) -> Column:
    """The digits in the places of the mention's digits."""
    pieces = F.split(mention, "")
    counted = F.aggregate(
        pieces,
        F.struct(F.lit("").alias("text"), F.lit(0).alias("n")),
        lambda a, c: F.struct(
            F.concat(a["text"], F.when(c.rlike("[0-9]"), F.substr(digits, a["n"] + 1, F.lit(1))).otherwise(c)).alias("text"),
            (a["n"] + F.when(c.rlike("[0-9]"), 1).otherwise(0)).alias("n"),
        ),
        lambda a: a["text"],
    )
    return counted


def _cased(text: Column, like: Column) -> Column:
    """Upper case, or a capital first, as ``like`` is."""
    upper = (F.upper(like) == like) & (F.length(like) > 1) & (F.lower(like) != like)
    capital = F.concat(F.upper(F.substring(text, 1, 1)), F.substr(text, F.lit(2), F.length(text)))
    return F.when(upper, F.upper(text)).when(F.substring(like, 1, 1).rlike(r"\p{Lu}"), capital).otherwise(text)


def given_name(mention: Column) -> tuple[Column, Column]:
    """Given name of a name's mention, null if it has none, and the kind that tells its gender."""
    words = F.split(mention, " ")
    first = F.regexp_replace(F.element_at(words, 1), r"\.$", "")
    titled = first.isin(*MALE_TITLES, *FEMALE_TITLES, *TITLES)
    given = F.when(titled & (F.size(words) == 3), F.element_at(words, 2)).when(~titled, F.element_at(words, 1))
    female = first.isin(*FEMALE_TITLES) | (~first.isin(*MALE_TITLES) & given.isin(*FEMALE, *FEMALE_CYRILLIC))
    return given, F.when(female, "given_f").otherwise("given_m")


def _given_core(key: str, what: Column, value: Column, attempt: Column, stream: Column) -> Column:
    """A known name moves along the list of its gender and script; another is made up, with an ending of its gender."""
    shift = F.crc32(F.lit(key).cast("binary"))

    def moved(pool: tuple[str, ...]) -> Column:
        names = F.array(*[F.lit(n.lower()) for n in pool])
        place = F.array_position(names, value)
        return F.when(place > 0, F.element_at(names, ((place - 1 + 1 + shift % (len(pool) - 1)) % len(pool) + 1).cast("int")))

    def made(pool: tuple[str, ...], female: str, male: str) -> Column:
        entries = F.array(*[F.lit(s) for s in pool])
        parts = [F.element_at(entries, (_number(stream, F.lit(i)) % len(pool)) + 1) for i in (0, 10, 20, 30)]
        longer = F.when(attempt >= 1, F.concat(*parts[2:])).otherwise(F.lit(""))
        return F.concat(*parts[:2], longer, F.when(what == "given_f", female).otherwise(male))

    known = F.coalesce(
        F.when(what == "given_f", F.coalesce(moved(FEMALE), moved(FEMALE_CYRILLIC))).otherwise(F.coalesce(moved(MALE), moved(MALE_CYRILLIC)))
    )
    new = F.when(value.rlike(r"\p{IsCyrillic}"), made(CYRILLIC_SYLLABLES, "а", "ий")).otherwise(made(SYLLABLES, "a", "o"))
    return F.coalesce(known, new)


def rendered(what: Column, mention: Column, drawn: Column, given: Column) -> Column:
    """A surrogate in the format of its mention; ``given`` is the surrogate of a name's given name."""
    words = F.split(mention, " ")
    old, _ = given_name(mention)
    titled = F.regexp_replace(F.element_at(words, 1), r"\.$", "").isin(*MALE_TITLES, *FEMALE_TITLES, *TITLES)
    surname = _cased(drawn, F.element_at(words, -1))
    # concat_ws leaves nulls out
    name = F.concat_ws(" ", F.when(titled, F.element_at(words, 1)), F.when(old.isNotNull(), _cased(given, old)), surname)
    phone = F.concat(_calling_code(mention), drawn)
    spaced = F.aggregate(
        F.split(mention, ""),
        F.struct(F.lit("").alias("text"), F.lit(0).alias("n")),
        lambda a, c: F.struct(
            F.concat(a["text"], F.when(c == " ", c).otherwise(F.substr(drawn, a["n"] + 1, F.lit(1)))).alias("text"),
            (a["n"] + F.when(c == " ", 0).otherwise(1)).alias("n"),
        ),
        lambda a: a["text"],
    )
    return (
        F.when(what == "phone", _poured(phone, mention))
        .when(what.isin("account", "ssn"), _poured(drawn, mention))
        .when(what == "iban", spaced)
        .when(what == "name", name)
        .when((what == "email") & (F.upper(mention) == mention), F.upper(drawn))
        .otherwise(drawn)
    )


def mentions(text: Column) -> Column:
    """All mentions in text order; a text without the signs of any is not searched."""
    return F.when(text.rlike(SIGNS), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _told(found: Column) -> Column:
    """Mentions with their kind, canonical value, and a name's given name with the kind that tells its gender."""
    kinds = F.transform(found, lambda m: F.struct(m.alias("mention"), kind(m).alias("kind")))

    def tell(row: Column) -> Column:
        given, gender = given_name(row["mention"])
        named = row["kind"] == "name"
        return F.struct(
            row["mention"].alias("mention"),
            row["kind"].alias("kind"),
            canonical(row["kind"], row["mention"]).alias("value"),
            F.when(named, gender).alias("gender"),
            F.when(named, F.lower(given)).alias("given"),
        )

    return F.transform(kinds, tell)


def _bare(pieces: Column, names: Column) -> Column:
    """Structs of a piece with bare mentions of ``names`` (structs of value and core) replaced, and their number.

    A name's possessive ending is not part of it, and parts of a hyphenated word are looked up too.
    """
    keys = F.transform(names, lambda r: r["value"])
    keys = F.concat(keys, F.transform(keys, lambda k: F.regexp_replace(k, "['’]s$", "")))
    cores = F.transform(F.concat(names, names), lambda r: r["core"])

    def swapped(word: Column) -> Column:
        place = F.array_position(keys, F.lower(word))
        return F.when(place > 0, _cased(F.element_at(cores, F.greatest(place, F.lit(1)).cast("int")), word)).otherwise(word)

    def whole(word: Column) -> Column:
        known = F.array_contains(keys, F.lower(word)) | ~word.contains("-")
        return F.when(known, swapped(word)).otherwise(F.array_join(F.transform(F.split(word, "-"), swapped), "-"))

    def one(piece: Column) -> Column:
        words = F.regexp_extract_all(piece, F.lit(BARE), F.lit(0))
        new = F.transform(words, whole)
        text = F.array_join(F.zip_with(F.split(piece, BARE, -1), F.concat(new, F.array(F.lit(""))), lambda g, w: F.concat(g, w)), "")
        n = F.size(F.filter(F.zip_with(words, new, lambda w, v: w != v), lambda changed: changed))
        return F.struct(text.alias("text"), n.alias("n"))

    return F.transform(pieces, one)


def _entities_of(told: Column) -> Column:
    pairs = F.transform(told, lambda r: F.struct(r["kind"].alias("kind"), r["value"].alias("value")))
    given = F.transform(told, lambda r: F.struct(r["gender"].alias("kind"), r["given"].alias("value")))
    return F.array_distinct(F.concat(pairs, F.filter(given, lambda r: r["value"].isNotNull())))


def entities(documents: DataFrame) -> DataFrame:
    """Each entity (``kind``, ``value``) of the corpus once; a name's given name is an entity of its own."""
    found = documents.select(F.explode(_entities_of(_told(mentions(F.col("text"))))).alias("entity"))
    return found.select("entity.kind", "entity.value").distinct()


def _drawn(key: str, rows: Column) -> Column:
    """Structs of kind, value and attempt as structs of row, stream and core."""

    def stream(r: Column) -> Column:
        return F.struct(r.alias("row"), _stream(key, r["kind"], r["value"], r["attempt"]).alias("stream"))

    def draw(s: Column) -> Column:
        r = s["row"]
        return F.struct(r.alias("row"), _core(key, r["kind"], r["value"], r["attempt"], s["stream"]).alias("core"))

    return F.transform(F.transform(rows, stream), draw)


def further_draws(found: DataFrame, key: str) -> DataFrame | None:
    """Entities whose first draw collides, with the ``attempt`` that does not; None if there are none.

    ``found`` is written once. In each round the entity that sorts first keeps a core that several drew, unless the core is
    taken or a real entity; the others draw again.
    """
    found = stage(found, "entities")
    pending, taken, settled = found, None, None
    for attempt in range(ROUNDS):
        one = F.array(F.struct("kind", "value", F.lit(attempt).alias("attempt")))
        drawn = pending.withColumn("core", F.element_at(_drawn(key, one), 1)["core"])
        first = drawn.groupBy("kind", "core").agg(F.min("value").alias("first"), F.count("*").alias("n"))
        # given names are shared by many people: another real one is no disclosure; of short numbers most may be real
        real = found.where(f"kind not like 'given%' and not (kind = 'phone' and length(value) <= {SHORT})").select("kind", F.col("value").alias("core"), F.lit(True).alias("is_real"))
        blocked = first.join(real, ["kind", "core"], "left")
        if taken is not None:
            blocked = blocked.join(taken.withColumn("is_taken", F.lit(True)), ["kind", "core"], "left")
        else:
            blocked = blocked.withColumn("is_taken", F.lit(None).cast("boolean"))
        blocked = blocked.where("n > 1 or is_real or is_taken").withColumn("none", F.coalesce(F.col("is_real"), F.col("is_taken"), F.lit(False)))
        lost = drawn.join(blocked.select("kind", "core", "first", "none"), ["kind", "core"]).where("none or value <> first")
        lost = stage(lost.select("kind", "value"), "collisions")
        if lost.isEmpty():
            return settled if attempt == 0 else (settled.unionByName(_attempts(pending, attempt)) if settled is not None else _attempts(pending, attempt))
        kept = drawn.join(lost, ["kind", "value"], "left_anti")
        if attempt:
            settled = _attempts(kept, attempt) if settled is None else settled.unionByName(_attempts(kept, attempt))
        cores = kept.select("kind", "core")
        taken = stage(cores if taken is None else taken.unionByName(cores), "taken")
        pending = lost
    raise RuntimeError(f"Surrogates still collide after {ROUNDS} draws; give the kinds concerned a larger space.")


def _attempts(rows: DataFrame, attempt: int) -> DataFrame:
    return rows.select("kind", "value", F.lit(attempt).alias("attempt"))


def replace_personal_data(documents: DataFrame, key: str) -> DataFrame:
    """All columns of ``documents`` with mentions in ``text`` replaced, and ``n_mentions`` and ``kinds`` (sorted, each once).

    A surname found in a text is replaced, and counted, also where it stands there alone as a capitalised word.

    A null text stays null and has no mentions, an empty one stays empty. Repeated rows get equal results; an empty table
    gives an empty one. Other columns are kept as they are; any named n_mentions or kinds gives way to the new ones.
    """
    again = further_draws(entities(documents), key)
    rows = packed(documents).withColumn("told", _told(mentions(F.col("text"))))
    if again is None:
        attempts = F.lit(None).cast("map<string,int>")
    else:
        told = rows.where(F.size("told") > 0).select(F.sha2("text", 256).alias("hash"), F.explode(_entities_of(F.col("told"))).alias("entity"))
        entry = F.struct(F.concat_ws("\x1f", "kind", "value").alias("key"), F.col("attempt").alias("value"))
        # by the text's hash: repeated ids cannot mix, and few texts are concerned
        one = told.select("hash", "entity.kind", "entity.value").join(again, ["kind", "value"])
        one = one.groupBy("hash").agg(F.map_from_entries(F.collect_set(entry)).alias("attempts"))
        # texts without mentions are spread by a hash of their own that meets none
        none = F.concat(F.lit("-"), F.xxhash64("text").cast("string"))
        rows = rows.withColumn("hash", F.when(F.size("told") > 0, F.sha2("text", 256)).otherwise(none))
        rows = lookup_join(rows, one, ["hash"], "left", summarised=True)
        attempts = F.col("attempts")

    def row(what: Column, value: Column) -> Column:
        attempt = F.coalesce(F.element_at(attempts, F.concat_ws("\x1f", what, value)), F.lit(0))
        return F.struct(what.alias("kind"), value.alias("value"), attempt.alias("attempt"))

    told = F.col("told")
    cores = _drawn(key, F.transform(told, lambda r: row(r["kind"], r["value"])))
    given = _drawn(key, F.transform(told, lambda r: row(r["gender"], r["given"])))
    drawn = F.zip_with(cores, given, lambda c, g: F.struct(c["core"].alias("core"), g["core"].alias("given")))
    # columns of their own, so that each is made once
    rows = rows.withColumn("drawn", drawn).withColumn("pieces", F.split(F.col("text"), PATTERN, -1))
    drawn = F.col("drawn")
    surrogates = F.zip_with(told, drawn, lambda r, d: rendered(r["kind"], r["mention"], d["core"], d["given"]))
    named = F.zip_with(told, drawn, lambda r, d: F.struct(r["kind"].alias("kind"), r["value"].alias("value"), d["core"].alias("core")))
    names = F.array_distinct(F.filter(named, lambda r: r["kind"] == "name"))
    unchanged = F.transform("pieces", lambda p: F.struct(p.alias("text"), F.lit(0).alias("n")))
    rows = rows.withColumn("names", names)
    rows = rows.withColumn("between", F.when(F.size("names") > 0, _bare(F.col("pieces"), F.col("names"))).otherwise(unchanged))
    replaced = F.array_join(F.zip_with("between", F.concat(surrogates, F.array(F.lit(""))), lambda p, s: F.concat(p["text"], s)), "")
    n_bare = F.when(F.size("told") > 0, F.aggregate("between", F.lit(0), lambda n, p: n + p["n"])).otherwise(0)
    kinds = F.array_sort(F.array_distinct(F.transform(told, lambda r: r["kind"])))
    new_text = F.when(F.size("told") > 0, replaced).otherwise(F.col("text"))
    values = zip(documents.columns, unpacked(documents.columns, text=new_text), strict=True)
    return rows.select(
        *[v for c, v in values if c not in ("n_mentions", "kinds")],
        (F.greatest(F.size("told"), F.lit(0)) + n_bare).cast("long").alias("n_mentions"),
        F.coalesce(kinds, F.array().cast("array<string>")).alias("kinds"),
    )
