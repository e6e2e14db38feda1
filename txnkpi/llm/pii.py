"""Surrogates for personal data: keyed replacements of the same type and format.

Entities found by pattern are taken apart into units (a phone number, the part before the @
of an address, a domain, a first name, a surname ...). Equal units get equal surrogates
everywhere, so who was the same person or account stays so; first, middle and last names of a
name found in a text are also replaced where they stand alone in that text. A surrogate is drawn from a keyed
hash of the unit and keeps its form: digits stay digits, letters letters, card numbers and
IBANs keep valid check digits, first names keep gender and script. Surrogates are checked
before use: no two units of a kind share one, and none equals a real unit of that kind; the
later unit draws again, at last a longer one.

The key is a secret of the caller. What is written on the way, real values beside their
surrogates, is encrypted with it, and without it nobody can draw the same surrogates again.

Native: DataFrame functions only. Units are distinct before anything is drawn, and texts
without entities never move; the others move only if the table of replacements is too large
to be sent to all executors.

Defined cases: NULL and empty texts stay as they are. Repeated rows get the same replacements.
An empty table gives an empty result. Further columns are ignored (``pseudonymised``) or
kept (``replace_pii``). Texts may be of any length; a text's replacements travel as one map.
"""

from __future__ import annotations

import hashlib
import secrets
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnkpi.llm.common import row_key, small, written

# First names by gender and script, titles by gender.
FIRST_NAMES = {
    ("m", "latin"): "James John Robert Michael William David Richard Thomas Charles Daniel Matthew Anthony Mark "
    "Hans Peter Klaus Wolfgang Juergen Pierre Jacques François Philippe Carlos José Miguel Antonio".split(),
    ("f", "latin"): "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Margaret Laura "
    "Ursula Monika Petra Sabine Heike Marie Nathalie Françoise Isabelle Carmen Dolores Lucía Pilar".split(),
    ("m", "cyrillic"): "Иван Сергей Дмитрий Алексей Николай Владимир Михаил Андрей Павел Юрий".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Людмила".split(),
    ("m", "greek"): "Γιώργος Δημήτρης Κώστας Νίκος Γιάννης Παναγιώτης Βασίλης Χρήστος".split(),
    ("f", "greek"): "Μαρία Ελένη Κατερίνα Βασιλική Σοφία Αγγελική Γεωργία Δήμητρα".split(),
}
TITLES = {
    "m": "Mr|Mister|Sir|Herr|Monsieur|Señor|Sr|господин|г-н",
    "f": "Mrs|Ms|Miss|Madam|Frau|Madame|Mademoiselle|Mme|Mlle|Señora|Señorita|Sra|госпожа|г-жа",
    "n": "Dr|Prof",
}
# Syllables of drawn surnames by script.
SYLLABLES = {
    "latin": "bar den fal gor hol kes lan mer nor pel ros sal tor ver win zan bri cal dor mal".split(),
    "cyrillic": "бор вен гор дан зай кол лев мир нов пет рос сав тар фед чер шум".split(),
    "greek": "βαρ γαν δελ ζαν κορ λαν μαρ νικ παν ραλ σταθ ταν φιλ χαρ".split(),
}
VOWELS = {"latin": "aeiou", "cyrillic": "аеиоу", "greek": "αειου"}
# Endings of surnames that go with a gender, longer ones first, and small letters by block.
ENDINGS = "ская|ский|ова|ева|ёва|ина|ая|ов|ев|ёв|ин|όπουλος|οπούλου|ίδης|ίδου|άκης|άκη"
ALPHABETS = {("\u0370", "\u03ff"): "αβγδεζηθικλμνξοπρστυφχψω", ("\u0400", "\u04ff"): "абвгдежзиклмнопрстуфхцчшэюя"}

_NAMES = [n for names in FIRST_NAMES.values() for n in names]
_GIVEN = "|".join(_NAMES)
_UPPER_GIVEN = "|".join(n.upper() for n in _NAMES)
TITLES = {gender: f"{titles}|{titles.upper()}" for gender, titles in TITLES.items()}
_TITLE = "|".join(TITLES.values())
# Capitalised words that do not go on with a name.
_STOP = (
    "the|this|that|these|those|and|or|but|if|in|on|at|of|to|for|from|with|by|as|is|was|are|were|has|had|have|he|she|it|its|they|we|you|"
    "his|her|their|my|our|your|who|when|where|what|why|how|not|no|yes|after|before|then|there|here|will|would|can|could|said|says|"
    "monday|tuesday|wednesday|thursday|friday|saturday|sunday|january|february|march|april|june|july|august|september|october|november|december|"
    "der|die|das|und|ist|war|ein|eine|les|est|et|el|los|las|es|y"
)
# A capitalised word, without the s of a genitive, a title or a suffix of generations.
_CAP = rf"(?!(?:{_TITLE}|Jr|JR|Sr|II|III|IV|PhD|MD)(?!\p{{L}}))\p{{Lu}}(?:\p{{L}}|['’-](?![sS](?!\p{{L}}))(?=\p{{L}}))++"
_NEXT = rf"(?!(?i:{_STOP})(?!\p{{L}})){_CAP}"
_UPPER_NEXT = rf"(?!(?i:{_STOP})(?!\p{{L}}))(?!(?:{_TITLE}|JR|SR|II|III|IV|MD)(?!\p{{L}}))\p{{Lu}}(?:\p{{Lu}}|['’-](?!S(?!\p{{L}}))(?=\p{{Lu}}))++(?!\p{{L}})"
_INITIAL = r"(?:(?:\p{Lu}\.){1,4}|\p{Lu}(?= ))"
_PARTICLE = r"(?:van|von|der|den|de|del|della|di|da|dos|la|le|du|zu|bin|ibn|al)(?= )"
# Possessive repetition: Java's regular expressions repeat other groups by recursion.
# Letters beyond ASCII as ranges, which are quicker to test than properties; punctuation lies between them.
_WIDE = r"\u00C0-\u1FFF\u2C00-\u2DFF\u3041-\uD7FF"
_DOMAIN = rf"[A-Za-z0-9{_WIDE}-]++(?:\.[A-Za-z0-9{_WIDE}-]++)++"

_HEX = "[0-9A-Fa-f]{1,4}"
# A secret's keyword with what may stand around it, up to the value.
_SECRET_LABEL = r"(?i:[A-Za-z0-9_-]{0,60}(?:token|secret|key|password|passwd|passphrase|pwd)[A-Za-z0-9_-]{0,60}+)\\?[\"']?[ \t]*+[=:][ \t]*+\\?[\"']?"
# Words of prose that hold a keyword.
_NO_SECRET = "monkeys?|donkeys?|turkeys?|hockey|jockeys?|whiske?ys?|lackeys?|keyboards?|keynotes?|keywords?|keystones?|secretar(?:y|ies|iat)|secretly|tokyo"

#: Kind and pattern, in order of preference at a place.
PATTERNS = [
    ("email", rf"(?<![A-Za-z0-9._%+{_WIDE}-])[A-Za-z0-9._%+{_WIDE}-]++@{_DOMAIN}"),
    ("secret", rf"(?<![A-Za-z0-9_-])(?!(?i:{_NO_SECRET})(?![A-Za-z0-9_-])){_SECRET_LABEL}[A-Za-z0-9+/_-]{{8,}}+(?:\.[A-Za-z0-9+/_-]++)*+"),
    ("secret", r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|ghp_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}|[0-9a-f]{32,})(?![A-Za-z0-9])"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    ("ip", r"(?<![0-9A-Za-z.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9A-Za-z]|\.[0-9])"),
    ("ip", rf"(?<![0-9A-Za-z.])(?<![0-9A-Fa-f:]:)(?=[A-Fa-f:]*[0-9])(?!::1(?![0-9A-Fa-f:]))(?!(?:[0-9A-Fa-f]*+:){{8}})(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}(?::{_HEX}){{0,6}})?::(?:{_HEX}(?::{_HEX}){{0,6}})?)(?![0-9A-Za-z]|:[0-9A-Fa-f:]|\.[0-9])"),
    ("ssn", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"),
    ("card", r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"),
    ("phone", r"(?<![0-9A-Za-z])\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{1,4}\)?){2,5}(?![0-9A-Za-z])"),
    ("phone", r"(?<![0-9A-Za-z])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"),
    ("name", rf"(?<!\p{{L}})(?:(?:{_TITLE})\.? (?:(?:(?:{_INITIAL}|{_PARTICLE}) ){{1,4}}{_CAP}(?: {_NEXT})?|{_CAP}(?:(?: (?:{_INITIAL}|{_PARTICLE}|{_NEXT})){{0,3}} {_NEXT})?)"
     rf"|(?=\p{{Lu}})(?:(?:{_GIVEN})(?:-\p{{Lu}}\p{{L}}+)? (?:(?:{_INITIAL}|{_PARTICLE}|{_NEXT}) ){{0,3}}{_NEXT}"
     rf"|(?:{_UPPER_GIVEN})(?:-\p{{Lu}}+)? (?:(?:{_INITIAL}|{_UPPER_NEXT}) ){{0,3}}{_UPPER_NEXT}))"),
]
ENTITY = "|".join(f"(?:{p})" for _, p in PATTERNS)
#: Texts without this have no entity; it is cheap to look for.
HINT = rf"[0-9@]|(?<![\p{{L}}])(?:{_TITLE}|{_GIVEN}|{_UPPER_GIVEN})(?!\p{{L}})|(?i:token|secret|key|passw|passphrase|pwd)"

#: Letters that a name has at least to be replaced alone in other capitalisation than it was found in.
LEAST_ALONE = 4

_HASHES = 4
_DRAWS = 32 * _HASHES
#: From this attempt on surrogates grow, so that there is always a free one.
_LONGER_FROM = 4
MOST_ROUNDS = 64


def _found(text: Column) -> Column:
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)))


def _kind(surface: Column) -> Column:
    whole = [(k, surface.rlike(f"^(?:{p})$")) for k, p in PATTERNS]
    return reduce(lambda rest, x: F.when(x[1], x[0]).otherwise(rest), reversed(whole), F.lit("secret"))


def _name_words(s: Column) -> Column:
    """(word, part, norm) of a name's words after its title; initials and particles are no units."""
    title = F.regexp_extract(s, rf"^({_TITLE})\.? ", 1)
    words = F.split(F.regexp_replace(s, rf"^(?:{_TITLE})\.? ", ""), " ")
    given = F.substring_index(F.when(F.size(words) > 1, F.get(words, F.lit(0))), "-", 1)
    gender = F.lit("n")
    for (g, _), names in FIRST_NAMES.items():
        gender = F.when(F.lower(F.coalesce(given, F.lit(""))).isin([n.lower() for n in names]), g).otherwise(gender)
    for g, titles in TITLES.items():
        if g != "n":
            gender = F.when(title.isin(titles.split("|")), g).otherwise(gender)

    def one(w: Column, i: Column) -> Column:
        script = F.when(w.rlike(r"\p{IsCyrillic}"), "cyrillic").when(w.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
        last = i == F.size(words) - 1
        part = F.when(last, "surname").when(w.rlike(r"^(?:(?:\p{Lu}\.)+|\p{Lu})$"), "initial").when(w.rlike(r"^\p{Ll}"), "particle").otherwise("given")
        norm = F.when(last, F.concat_ws(":", script, F.lower(w))).otherwise(F.concat_ws(":", gender, script, F.lower(w)))
        return F.struct(w.alias("word"), part.alias("part"), norm.alias("norm"))

    return F.transform(words, one)


def _ipv6(s: Column) -> tuple[Column, Column, Column]:
    """Groups before and after ``::``, and all 32 digits."""
    halves = F.split(F.lower(s), "::")
    left, right = (F.filter(F.split(F.coalesce(F.get(halves, F.lit(i)), F.lit("")), ":"), lambda x: x != "") for i in (0, 1))
    zeros = F.array_repeat(F.lit("0"), 8 - F.size(left) - F.size(right))
    return left, right, F.array_join(F.transform(F.concat(left, zeros, right), lambda x: F.lpad(x, 4, "0")), "")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _units(surfaces: DataFrame) -> DataFrame:
    """(surface, kind, part, norm) for every part of every distinct surface."""
    s = F.col("surface")
    value = F.regexp_extract(s, rf"^(?:{_SECRET_LABEL})?(.*)$", 1)

    def unit(part: str, norm: Column) -> Column:
        return F.struct(F.lit(part).alias("part"), norm.alias("norm"))

    kind = F.col("kind")
    units = (
        F.when(kind == "email", F.array(unit("email", F.lower(s)), unit("domain", F.lower(F.substring_index(s, "@", -1)))))
        .when(kind == "secret", F.array(unit("secret", value)))
        .when(kind == "iban", F.array(unit("iban", F.regexp_replace(s, " ", ""))))
        .when((kind == "ip") & s.contains(":"), F.array(unit("ipv6", _ipv6(s)[2])))
        .when(kind == "ip", F.array(unit("ip", s)))
        .when(kind == "phone", F.array(unit("phone", F.concat(F.regexp_extract(s, r"^(\+?)", 1), _digits(s)))))
        .when(kind == "name", F.array_distinct(F.transform(
            F.filter(_name_words(s), lambda w: w["part"].isin("surname", "given")),
            lambda w: F.struct(w["part"].alias("part"), w["norm"].alias("norm")),
        )))
        .otherwise(F.array(F.struct(kind.alias("part"), _digits(s).alias("norm"))))
    )
    return surfaces.select("surface", "kind", F.explode(units).alias("u")).select(
        "surface", "kind", "u.part", "u.norm"
    )


def _number(stream: Column, i: Column) -> Column:
    """The i-th drawn number, 0 to 255; the stream starts over after _DRAWS numbers."""
    return F.conv(F.substring(stream, (i % _DRAWS) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(choices: Column, number: Column) -> Column:
    return F.substring(choices, number % F.length(choices) + 1, F.lit(1))


def _same_form(text: Column, stream: Column, letters: Column) -> Column:
    """The text with drawn digits for digits and letters for letters; a leading digit is not 0."""

    def change(c: Column, i: Column) -> Column:
        choices = F.when(c.rlike("[0-9]"), F.when(i == 0, "123456789").otherwise("0123456789")).when(c.rlike("[a-z]"), letters)
        choices = choices.when(c.rlike("[A-Z]"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
        for (first, last), alphabet in ALPHABETS.items():
            choices = choices.when(c.between(first, last), alphabet)
        return F.coalesce(_pick(choices.when(c > "\x7f", letters), _number(stream, i)), c)

    return F.array_join(F.transform(F.split(text, ""), change), "")


def _same_ipv6(digits: Column, stream: Column) -> Column:
    """Drawn hexadecimal digits for all but the leading zeros of each group of four."""

    def change(c: Column, i: Column) -> Column:
        n, before = _number(stream, i), F.substring(digits, i - i % 4 + 1, i % 4)
        zeros = F.regexp_replace(before, "0", "") == ""
        choices = F.when(zeros, F.when(c != "0", "123456789abcdef")).otherwise("0123456789abcdef")
        return F.coalesce(_pick(choices, n), c)

    return F.array_join(F.transform(F.split(digits, ""), change), "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn's sum of a number without its check digit."""
    terms = F.transform(
        F.reverse(F.split(digits, "")),
        lambda d, i: F.when(i % 2 == 0, (d.cast("int") * 2) % 10 + F.floor(d.cast("int") * 2 / 10).cast("int")).otherwise(d.cast("int")),
    )
    return F.aggregate(terms, F.lit(0), lambda a, b: a + b)


def _luhn_digit(digits: Column) -> Column:
    return ((10 - _luhn_sum(digits) % 10) % 10).cast("string")


def _iban_check(country: Column, rest: Column) -> Column:
    """Check digits of an IBAN: 98 less the number modulo 97."""
    moved = F.split(F.concat(rest, country, F.lit("00")), "")
    value = F.aggregate(
        moved, F.lit(0),
        lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97),
    )
    return F.lpad((98 - value).cast("string"), 2, "0")


def _pool() -> Column:
    """What a name's surrogate is drawn from: first names of its gender and script, or syllables of its script."""
    part, norm = F.col("part"), F.col("norm")
    words = F.when(part == "surname", " ".join(SYLLABLES["latin"]))
    for script in ("cyrillic", "greek"):
        words = F.when((part == "surname") & norm.startswith(f"{script}:"), " ".join(SYLLABLES[script])).otherwise(words)
    for script in SYLLABLES:
        for gender in ("m", "f", "n"):
            names = [n.lower() for (g, s), pool in FIRST_NAMES.items() if s == script and gender in (g, "n") for n in pool]
            words = F.when((part == "given") & norm.startswith(f"{gender}:{script}:"), " ".join(names)).otherwise(words)
    return F.split(words, " ")


def _surrogates(units: DataFrame, key: str) -> DataFrame:
    """Adds ``drawn``, each unit's surrogate at its ``attempt``.

    What several kinds need is a column of its own, written out once: each further copy of
    its expression costs the driver memory in every plan it makes of this.
    """
    part, norm, attempt = F.col("part"), F.col("norm"), F.col("attempt")
    seed = F.concat_ws("|", F.lit(key), "part", "norm", attempt.cast("string"))
    d = units.withColumn("_stream", F.concat(*(F.sha2(F.concat_ws("|", seed, F.lit(str(i))), 256) for i in range(_HASHES))))
    stream, extra = F.col("_stream"), F.greatest(attempt - _LONGER_FROM + 1, F.lit(0))
    d = d.withColumn("_tail", F.substring(F.regexp_replace(F.conv(F.substring(stream, 1, 12), 16, 10), "^0", "1"), F.lit(1), extra))
    tail_digits = F.col("_tail")
    tail_letters = F.translate(tail_digits, "0123456789", "bdfgklmprs")
    number = F.concat(norm, tail_digits)

    # The characters of most kinds are changed one by one.
    hexadecimal = (part == "secret") & norm.rlike("^[0-9a-f]+$")
    text = (
        F.when(part == "email", F.concat(F.substring_index(norm, "@", 1), tail_letters))
        .when(part == "domain", F.concat(F.regexp_extract(norm, r"^(.*)(\.[^.]+)$", 1), tail_letters))
        .when(part == "card", F.substring(number, F.lit(1), F.length(number) - 1))
        .when(part == "iban", F.concat(F.substring(norm, 5, 64), tail_digits))
        .when(part == "phone", F.expr("substring(norm, length(regexp_extract(norm, r'^(\\+(?:[17]|[0-9]{2}))', 1)) + 1)"))
        .when(hexadecimal, number)
        .when(part == "secret", F.concat(norm, tail_letters))
        .when(~part.isin("ip", "ipv6", "surname", "given"), number)
    )
    letters = F.when(hexadecimal, "abcdef").otherwise("abcdefghijklmnopqrstuvwxyz")
    d = d.withColumns({"_text": text, "_letters": letters, "_pool": _pool()})
    d = d.withColumn("_formed", _same_form(F.col("_text"), stream, F.col("_letters")))
    formed, pool = F.col("_formed"), F.col("_pool")

    domain = F.concat(formed, F.regexp_extract(norm, r"^(.*)(\.[^.]+)$", 2))
    card_body = F.concat(F.substring(norm, 1, 1), F.substring(formed, 2, 64))
    valid = _luhn_digit(F.substring(norm, F.lit(1), F.length(norm) - 1)) == F.substring(norm, -1, 1)
    card = F.concat(card_body, F.when(valid, _luhn_digit(card_body)).otherwise(_pick(F.lit("0123456789"), _number(stream, F.lit(_DRAWS - 1)))))
    country = F.substring(norm, 1, 2)
    iban = F.concat(country, _iban_check(country, formed), formed)
    octets = [(_number(stream, F.lit(i)) % 254 + 1).cast("string") for i in range(4)]
    ip = F.concat_ws(":", F.concat_ws(".", *octets), F.when(extra > 0, tail_digits))
    ipv6 = _same_ipv6(F.when(extra > 0, F.lit("f" * 32)).otherwise(norm), stream)
    phone = F.concat(F.regexp_extract(norm, r"^(\+(?:[17]|[0-9]{2}))", 1), formed, tail_digits)

    def drawn_from_pool(last: Column, real: Column) -> Column:
        """Words of the pool by numbers 0 to ``last``; the next word for one that is real."""

        def word(i: Column) -> Column:
            n = _number(stream, i)
            return F.get(pool, (n + F.when(F.get(pool, n % F.size(pool)) == real, 1).otherwise(0)) % F.size(pool))

        return F.transform(F.sequence(F.lit(0), last), word)

    vowels = F.translate(tail_digits, "0123456789", 2 * VOWELS["latin"])
    for script in ("cyrillic", "greek"):
        vowels = F.when(norm.startswith(f"{script}:"), F.translate(tail_digits, "0123456789", 2 * VOWELS[script])).otherwise(vowels)
    surname = F.concat_ws(
        "", drawn_from_pool(F.when(attempt > 1, 3).otherwise(2), F.lit("")),
        F.when(extra > 0, vowels), F.regexp_extract(norm, f"({ENDINGS})$", 1),
    )
    given = F.array_join(drawn_from_pool(F.least(attempt, F.lit(7)), F.substring_index(norm, ":", -1)), "-")
    given = F.concat_ws("", given, F.when(attempt > 7, tail_letters))
    drawn = (
        F.when(part == "domain", domain).when(part == "card", card)
        .when(part == "iban", iban).when(part == "ip", ip).when(part == "ipv6", ipv6).when(part == "phone", phone)
        .when(part == "surname", surname).when(part == "given", given)
        .otherwise(formed)
    )
    return d.select(*units.columns, drawn.alias("drawn"))


def session_key(spark: SparkSession) -> str:
    """The key set as ``spark.txnkpi.surrogates.key``, which makes runs agree; else a random one."""
    return spark.conf.get("spark.txnkpi.surrogates.key", None) or secrets.token_hex(32)


def _sealed(df: DataFrame, name: str, key: str) -> DataFrame:
    """The frame, written encrypted and read again: no real value stays readable on disk."""
    secret = F.unhex(F.lit(hashlib.sha256(f"seal|{key}".encode()).hexdigest()))
    row = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    stored = written(df.select(F.aes_encrypt(row, secret, F.lit("GCM")).alias("row")), name)
    row = F.from_json(F.aes_decrypt("row", secret, F.lit("GCM")).cast("string"), df.schema)
    return stored.select(row.alias("r")).select("r.*")


def assign(units: DataFrame, key: str) -> DataFrame:
    """Distinct (part, norm) with surrogates ``drawn`` that no other unit of the kind has.

    Each round draws for the units left over, keeps the first unit (by norm) of equal draws,
    and sends the others on. A round is written before the next one reads it, and its draws
    before they are compared: the optimizer would copy them into every filter it adds.
    """
    real = units.select(
        "part",
        F.when(F.col("part") == "email", F.substring_index("norm", "@", 1))
        .when(F.col("part").isin("surname", "given"), F.substring_index("norm", ":", -1))
        .otherwise(F.col("norm")).alias("drawn"),
    ).distinct()
    taken, left, done = real, units.withColumn("attempt", F.lit(0)), []
    for _ in range(MOST_ROUNDS):
        drawn = _sealed(_surrogates(left, key), "draws", key).join(taken.withColumn("used", F.lit(True)), ["part", "drawn"], "left")
        first = drawn.filter("used is null").groupBy("part", "drawn").agg(F.min("norm").alias("first"))
        settled = drawn.join(first, ["part", "drawn"], "left").withColumn("ok", F.coalesce(F.col("norm") == F.col("first"), F.lit(False)))
        settled = _sealed(settled.select("part", "norm", "drawn", "attempt", "ok"), "surrogates", key)
        won = settled.filter("ok")
        done.append(won.select("part", "norm", "drawn"))
        taken = taken.union(won.select("part", "drawn"))
        left = settled.filter("not ok").select("part", "norm", (F.col("attempt") + 1).alias("attempt"))
        if left.isEmpty():
            return reduce(DataFrame.union, done)
    raise RuntimeError(f"no free surrogates after {MOST_ROUNDS} rounds")


def _fill(surface: Column, chars: Column, slot: str) -> Column:
    """The surface with ``chars`` in place of its characters in ``slot``, one after another."""
    filled = F.transform(
        F.split(surface, ""),
        lambda c, i: F.when(
            c.rlike(slot),
            F.substring(chars, F.length(F.regexp_replace(F.substring(surface, F.lit(1), i), slot.replace("[", "[^"), "")) + 1, F.lit(1)),
        ).otherwise(c),
    )
    more = F.substring(chars, F.length(F.regexp_replace(surface, slot.replace("[", "[^"), "")) + 1, F.lit(64))
    return F.concat(F.array_join(filled, ""), more)


def _initials(key: str) -> tuple[str, str]:
    """Capital letters and for each another one of its alphabet: the next in an order by key."""
    alphabets = [[chr(c) for c in range(a, b) if chr(c).isupper()] for a, b in ((0, 128), (128, 0x250), (0x370, 0x400), (0x400, 0x530))]
    orders = [sorted(x, key=lambda c: hashlib.sha256(f"{key}|initial|{c}".encode()).digest()) for x in alphabets]
    return "".join(c for o in orders for c in o), "".join(c for o in orders for c in o[1:] + o[:1])


def _capital(word: Column) -> Column:
    return F.regexp_replace(F.initcap(F.regexp_replace(word, "-", " ")), " ", "-")


def _rendered(parts: DataFrame, drawn: DataFrame, key: str) -> DataFrame:
    """(surface, kind, new, alone): every surface as its surrogate, in its own format and
    case, and pairs of the names in it and their surrogates. What is used more than once
    is a column of its own, as in ``_surrogates``."""
    s, kind = F.col("surface"), F.col("kind")
    which = F.when(kind == "name", F.concat_ws(":", "part", "norm")).otherwise(F.col("part")).alias("part")
    wide = (
        parts.join(drawn, ["part", "norm"])
        .groupBy("surface", "kind")
        .agg(F.map_from_entries(F.collect_set(F.struct(which, "drawn"))).alias("by"))  # as many as a surface has words
    )
    by = lambda part: F.col("by")[part]
    title = F.regexp_extract(s, rf"^((?:{_TITLE})\.? )", 1)

    def renamed(w: Column) -> Column:
        new = _capital(F.col("by")[F.concat_ws(":", w["part"], w["norm"])])
        new = F.when(w["word"] == F.upper(w["word"]), F.upper(new)).otherwise(new)
        new = F.when(w["part"] == "initial", F.translate(w["word"], *_initials(key))).when(w["part"] == "particle", w["word"]).otherwise(new)
        return F.struct(w["word"].alias("real"), new.alias("new"), w["part"].alias("part"))

    wide = wide.withColumn("_words", F.when(kind == "name", F.transform(_name_words(s), renamed)))
    words, is_ipv6 = F.col("_words"), (kind == "ip") & s.contains(":")
    left, right, _ = _ipv6(s)
    group = lambda i: F.substring(by("ipv6"), i * 4 + 1, F.lit(4))
    cut = lambda i, g: F.substring(group(i), 5 - F.length(g), F.lit(4))
    ipv6 = F.concat(
        F.array_join(F.transform(left, lambda g, i: cut(i, g)), ":"),
        F.when(s.contains("::"), "::").otherwise(""),
        F.array_join(F.transform(right, lambda g, i: cut(8 - F.size(right) + i, g)), ":"),
    )
    wide = wide.withColumn("_short", F.when(is_ipv6, ipv6))
    short, full = F.col("_short"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), group), ":")
    ipv6 = F.when(_ipv6(short)[2] == by("ipv6"), short).otherwise(full)
    digits = F.when(kind == "phone", F.regexp_replace(by("phone"), r"\+", "")).when(kind == "card", by("card")).otherwise(by("ssn"))
    prefix = F.regexp_extract(s, rf"^({_SECRET_LABEL})?(.*)$", 1)
    new = (
        F.when(kind == "email", F.concat(by("email"), F.lit("@"), by("domain")))
        .when(kind == "secret", F.concat(prefix, by("secret")))
        .when(kind == "iban", _fill(s, by("iban"), "[A-Z0-9]"))
        .when(is_ipv6, ipv6)
        .when(kind == "ip", by("ip"))
        .when(kind == "name", F.concat(title, F.array_join(F.transform(words, lambda w: w["new"]), " ")))
        .otherwise(_fill(s, digits, "[0-9]"))
    )
    wide, new = wide.withColumn("_new", new), F.col("_new")
    capitals = ((kind == "email") & (s == F.upper(s))) | (is_ipv6 & (s != F.lower(s)))
    new = F.when(capitals, F.upper(new)).otherwise(new)
    found = F.filter(words, lambda w: w["part"].isin("surname", "given"))

    def cases(w: Column) -> Column:
        pair = lambda case: F.struct(case(w["real"]).alias("real"), case(w["new"]).alias("new"))
        # Shorter ones may be common words or abbreviations.
        return F.when(F.length(w["real"]) >= LEAST_ALONE, F.array(*map(pair, (lambda c: c, F.upper, _capital)))).otherwise(F.array(pair(lambda c: c)))

    alone = F.flatten(F.transform(found, cases))
    return wide.select("surface", "kind", new.alias("new"), alone.alias("alone"))


def replacements(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row (by key) with entities, written: a map from what stands there to what
    shall stand there, the kinds, and a map of names to look for on their own."""
    found = docs.select(*row_key(id_col, text_col), F.explode(_found(F.col(text_col))).alias("surface")).distinct()
    found = _sealed(found, "entities", key)
    surfaces = found.select("surface").distinct().withColumn("kind", _kind(F.col("surface")))
    parts = _sealed(_units(surfaces), "units", key)
    drawn = assign(parts.select("part", "norm").distinct(), key)
    rendered = _sealed(_rendered(parts, drawn, key), "rendered", key)
    by_row = (
        found.join(small(rendered), "surface")
        .groupBy("_id", "_h")
        .agg(
            F.map_from_entries(F.collect_list(F.struct("surface", "new"))).alias("by"),
            F.array_sort(F.collect_set("kind")).alias("kinds"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("alone")))).alias("alone"),
        )
    )
    first = F.filter("alone", lambda a, i: (i == 0) | (F.get("alone", i - 1)["real"] != a["real"]))
    by_row = by_row.withColumn("alone", F.map_from_entries(first))
    return _sealed(by_row, "replacements", key)


def _rewritten(text: Column, by: Column, alone: Column) -> Column:
    """The text with its entities replaced: pieces between them, and their replacements."""

    def replaced(pattern: Column) -> Column:
        pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
        return F.array_join(F.zip_with(pieces, found, lambda p, e: F.concat(F.coalesce(p, F.lit("")), F.coalesce(by[e], alone[e], e, F.lit("")))), "")

    # Longer names before those they begin with.
    names = F.array_join(F.sort_array(F.map_keys(alone), asc=False), "|")
    with_names = F.concat(F.lit(ENTITY + r"|(?<!\p{L})(?:"), names, F.lit(r")(?!\p{L})"))
    return F.when(by.isNull(), text).when(F.size(alone) == 0, replaced(F.lit(ENTITY))).otherwise(replaced(with_names))


def _joined(docs: DataFrame, key: str, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    by_row = small(replacements(docs, key, id_col, text_col))
    same = docs[id_col].eqNullSafe(by_row["_id"]) & (F.xxhash64(docs[text_col]) == by_row["_h"])
    return docs.join(by_row, same, "left"), by_row


def pseudonymised(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its text with surrogates, its entities' number and kinds."""
    joined, by_row = _joined(docs, key, id_col, text_col)
    return joined.select(
        docs[id_col].alias("doc_id"),
        _rewritten(docs[text_col], by_row["by"], by_row["alone"]).alias("text"),
        F.coalesce(F.size(by_row["by"]).cast("bigint"), F.lit(0).cast("bigint")).alias("n_entities"),
        F.coalesce(F.concat_ws(",", by_row["kinds"]), F.lit("")).alias("kinds"),
    )


def replace_pii(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with surrogates in their texts, all other columns unchanged."""
    joined, by_row = _joined(docs, key, id_col, text_col)
    return joined.select(
        *(_rewritten(docs[c], by_row["by"], by_row["alone"]).alias(c) if c == text_col else docs[c] for c in docs.columns)
    )
