"""Personal data replaced by keyed surrogates; DataFrame functions only.

Emails, phone numbers, IP addresses, payment card and account (IBAN) numbers, social security
numbers, hexadecimal secrets of 32 digits or more, access keys by their prefixes, and titled names of up to five words are found by one
pattern; phone numbers with a country or in local formats (3-3-4 digits, or a leading 0). A
surrogate follows from a keyed hash of the entity: the same entity gets the same
surrogate everywhere (coreference), digits stay digits, letters keep case and script,
separators stay, an address stays an address. Names are replaced word by word, in any case: `Mr. John Smith` and `MR. SMITH`
share a surname afterwards; the title stays, and given names (and surnames in Cyrillic, which have a gender) fit its gender.
A card number with a valid check digit gets one with a valid check digit; account numbers always have valid ones.

Collision checks: over the distinct entities (words, of names) of all documents, a surrogate must
not belong to two entities and must not be an entity of the corpus itself. Entities
that fail get the next attempt of the hash, until none fails; only their attempts
are joined back to the documents that hold them. So that this always ends, surrogates of
names, emails and numbers grow with the attempt (which few entities reach). IPv4 addresses
can't grow: there are 254^4 surrogates, enough while the texts hold less than about half of all addresses; beyond, an error ends the job.
A local number keeps its leading 0, a card the six digits of its issuer.

Bounds: a domain has 127 labels at most, a name eight initials before a word; what goes on behind them stays.

Defined cases: a null text stays null and has no entities; texts without entities
are returned unchanged; repeated rows are rewritten alike; other columns pass through, but for an n_entities, which is replaced.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm import common

KEY = "surrogates-1"
GROW_NAMES, GROW_EMAILS, GROW_NUMBERS = 3, 6, 24  # attempts after which a surrogate gets one more syllable, letter or digit
MOST_ATTEMPTS = 200
# A repeated group takes a stack frame of the regular expression's engine for each turn: groups are bounded, single characters needn't be.
# What a lookahead asks for lies inside the match, so that an entity has its kind without its neighbourhood; what has none all the same is OTHER.
OTHER = "other"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
# without a country: (555) 123-4567, 555.123.4567, 1-555-123-4567; 030 1234567, 0171/123 45 67, 06 12 34 56 78 (nine digits at least)
_GROUPS = (
    "[0-9]{2}#[0-9]{6,8}|[0-9]{3,4}#[0-9]{5,8}|[0-9]{2,4}#[0-9]{2,4}(?:[ -][0-9]{2,4}){2,3}"
    "|[0-9]{2}#(?:[0-9]{2}[ -][0-9]{4}|[0-9]{3}[ -][0-9]{3,4}|[0-9]{4}[ -][0-9]{2,4})|[0-9]{3}#(?:[0-9]{2}[ -][0-9]{3,4}|[0-9]{3,4}[ -][0-9]{2,4})|[0-9]{4}#[0-9]{2,4}[ -][0-9]{2,4}"
).replace("#", r"(?:\) ?|[ /-])")
_LOCAL = (
    r"(?<![0-9+(.-])(?:1[ .-])?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9]|[.-][0-9])"
    rf"|(?<![0-9+(.,/-])\(?0(?:{_GROUPS}|[1-9](?:[ .-][0-9]{{2}}){{4}})(?![0-9]|[.,/-][0-9])"
)
# words of a name: initials and degrees, particles, inner capitals, apostrophes and hyphens (a genitive 's is not part of it)
_INITIALS = r"(?:(?:\p{Lu}|Dr|DR|Prof|PROF|St|ST)\.[ -]?){0,8}"
_PARTICLES = r"(?:(?:van|von|vom|de|del|della|di|da|do|dos|das|du|ter|bin|ibn|al|el)(?: (?:der|den|dem|la|las|los|le))? )?"
_PART = _INITIALS + _PARTICLES + r"(?:[dl]['’])?\p{Lu}[\p{L}\p{M}]*+(?:['’-](?![sS](?!\p{L}))\p{L}[\p{L}\p{M}]*+)*+"
_TITLES = {
    "woman": ("Mrs.", "Ms.", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra.", "Госпожа"), "man": ("Mr.", "Herr", "Monsieur", "Señor", "Sr.", "Господин"),
    "person": ("Dr.", "Prof.", "Доктор", "Профессор"),
}


def _either(titles: tuple[str, ...]) -> str:
    return "|".join(x.replace(".", r"\.") for t in titles for x in (t, t.upper()))


def _titled(gender: str) -> str:
    """A title and up to five words of a name; in capitals, where names don't stand out, rather a word too many."""
    other = _either(_TITLES["woman"] + _TITLES["man"])
    return rf"(?<!\p{{L}})(?=\p{{Lu}})(?:{_either(_TITLES[gender])}) {_PART}(?: (?!(?:{other}) ){_PART}){{0,4}}(?!\p{{L}})"


_HEX = "[0-9A-Fa-f]{1,4}"
KINDS = {
    "secret": r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,}(?![0-9A-Za-z])",
    "key": r"(?<![0-9A-Za-z_-])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}|(?:sk|pk|rk)[-_](?:live_|test_)?[0-9A-Za-z]{20,}|xox[abprs]-[0-9A-Za-z-]{10,}|AIza[0-9A-Za-z_-]{35})(?![0-9A-Za-z_-])",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+){0,125}\.\p{L}\p{L}+",  # a domain has 127 labels at most
    "ip": rf"(?<![0-9.]){_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}(?!\.?[0-9])",
    "ip6": rf"(?<![\p{{L}}\p{{N}}:.])(?=[0-9A-Fa-f:]*[0-9])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}}|::{_HEX}(?::{_HEX}){{0,6}})(?![\p{{L}}\p{{N}}:]|\.[0-9])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?=(?:[ A-Z]{0,6}[0-9]){7})(?:(?: [0-9A-Z]{4}){2,7}(?: [0-9A-Z]{1,3})?|[0-9A-Z]{11,30})(?![0-9A-Za-z])",
    "phone": r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{3,4}(?![0-9])|\+[0-9](?:[() .-]{0,2}[0-9]){8,26}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "local": _LOCAL,
    "woman": _titled("woman"),
    "man": _titled("man"),
    "person": _titled("person"),
}
NAMES = tuple(_TITLES)
#: No entity begins inside a word, but for numbers: most places are passed over without a look at the kinds.
_BEGIN = r"(?:(?<![\p{L}\p{N}])|(?=[0-9+(]))"
PATTERN = _BEGIN + "(?:" + "|".join(f"(?:{p})" for p in KINDS.values()).replace(r"([ -]?)", r"(?<gap>[ -]?)").replace(r"\1", r"\k<gap>") + ")"
#: Letters that a letter of the same kind is replaced by, and digits.
ALPHABETS = {
    "[0-9]": "0123456789", "[a-z]": "abcdefghijklmnopqrstuvwxyz", "[A-Z]": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", r"\p{IsCyrillic}": "абвгдежзиклмнопрстуфхцчшэюя",
    r"\p{IsGreek}": "αβγδεζηθικλμνξοπρστυφχψω", r"\p{L}": "àâäçéèêëîïñôöùûü",
}
#: Beginnings and middles of names, in Cyrillic and in Latin script.
NAME_PARTS = {
    True: ("Ал Бе Ви Га Да Ел Жа Зи Ин Ка Ла Ми Не Ол Па Ри Са Та", "бор вел гор дан жир лен мир нат рос сем тим фед"),
    False: ("Al Be Cor Da El Fa Gi Hel Is Jo Ka Lo Ma No Or Pe Ro Sa Ta Vi", "bel dor fin gan lor mir nal rin san tel vin zar"),
}
#: Ends of names by gender; "person": surnames in Latin script, and names of unknown gender.
NAME_ENDS = {True: {"person": " о ук ер", "woman": "а ия ина элла", "man": " ей ин ад"}, False: {"person": " er son el", "woman": "a ia ina ella", "man": " o en ard"}}


def kind_of(entity: Column) -> Column:
    """The first kind whose pattern the whole entity matches."""
    out = F.lit(OTHER)
    for name, pattern in reversed(KINDS.items()):
        out = F.when(entity.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(out)
    return out


def canonical(part: Column, kind: Column) -> Column:
    """A secret or a name in capitals is the same one."""
    return F.when(kind.isin("secret", "ip6", *NAME_KINDS), F.lower(part)).otherwise(part)


#: Kinds of a name's words: gender of a given name or of a surname in Cyrillic, or none.
NAME_KINDS = tuple(f"name {g}" for g in _TITLES)


def parts_of(entity: Column) -> Column:
    """What is replaced by itself: (kind, value) of the words of a name, or of the entity."""
    return F.transform(F.array(kind_of(entity)), lambda kind: _parts(entity, kind))[0]  # the kind is found once


def _parts(entity: Column, kind: Column) -> Column:
    words = F.split(F.substring(entity, F.length(F.regexp_extract(entity, r"^\S+ ", 0)) + 1, F.length(entity)), " ")
    count = F.size(words)

    def word(w: Column, i: Column) -> Column:
        gendered = (i < count - 1) | w.rlike(r"\p{IsCyrillic}$")
        return F.struct(F.when(gendered, F.concat(F.lit("name "), kind)).otherwise(F.lit("name person")).alias("kind"), w.alias("value"))

    return F.when(kind.isin(*NAMES), F.transform(words, word)).otherwise(F.array(F.struct(kind.alias("kind"), entity.alias("value"))))


def _number(digest: Column, i: Column) -> Column:
    """Two hexadecimal digits of the digest, from position i on, as a number."""
    return F.conv(F.substring(F.concat(digest, digest), (i * 2) % 64 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(words: Column, n: Column) -> Column:
    """One of the words between spaces."""
    return F.element_at(F.split(words, " "), n % F.size(F.split(words, " ")) + 1)


def _letter(c: Column, n: Column) -> Column:
    letters = F.lit(None).cast("string")
    for kind, own in reversed(ALPHABETS.items()):
        letters = F.when(c.rlike(kind), F.lit(own)).otherwise(letters)
    return F.coalesce(F.substring(letters, n % F.length(letters) + 1, F.lit(1)), c)


def _like(text: Column, digest: Column) -> Column:
    """The text with keyed digits and letters of the same kinds."""
    number = lambda i: _number(F.sha2(F.concat(digest, F.lit(":"), F.floor(i / 32).cast("string")), 256), i % 32)
    return F.array_join(F.transform(F.split(text, ""), lambda c, i: _letter(c, number(i))), "")


def _hexadecimal(entity: Column, digest: Column) -> Column:
    """Keyed digits of as many blocks as it takes; colons stay, and capitals where there are no others (or where they are)."""
    block = lambda i: F.sha2(F.concat(digest, F.floor(i / 64).cast("string")), 256)
    digit = lambda c, i: F.when(c == ":", c).otherwise(F.substring(block(i), (i % 64 + 1).cast("int"), F.lit(1)))
    once = F.struct(entity.rlike("[a-f]").alias("lower"), entity.rlike("[A-F]").alias("upper"))  # of the whole entity, not for each of its digits
    is_upper = lambda c, of: F.when(of["lower"], c.rlike("[A-F]")).otherwise(of["upper"])
    made = lambda of: F.transform(F.split(entity, ""), lambda c, i: F.when(is_upper(c, of), F.upper(digit(c, i))).otherwise(digit(c, i)))
    return F.array_join(F.transform(F.array(once), made)[0], "")


def _word(part: Column, kind: Column, digest: Column, attempt: Column) -> Column:
    """A name, with one more syllable every few attempts."""
    cyrillic = part.rlike(r"\p{IsCyrillic}$")
    of = lambda words: F.when(cyrillic, F.lit(words(True))).otherwise(F.lit(words(False)))
    ends = of(lambda c: NAME_ENDS[c]["person"])
    for gender in ("woman", "man"):
        ends = F.when(kind == f"name {gender}", of(lambda c: NAME_ENDS[c][gender])).otherwise(ends)  # noqa: B023  used at once
    middles = F.sequence(F.lit(1), F.lit(2) + F.floor(attempt / GROW_NAMES).cast("int"))
    middle = F.array_join(F.transform(middles, lambda k: _pick(of(lambda c: NAME_PARTS[c][1]), _number(digest, F.when(k < 3, k).otherwise(k + 1)))), "")
    return F.concat(_pick(of(lambda c: NAME_PARTS[c][0]), _number(digest, F.lit(0))), middle, _pick(ends, _number(digest, F.lit(3))))


def surrogate(entity: Column, kind: Column, attempt: Column, key: str) -> Column:
    """Of an entity, or of a word of a name."""
    digest = F.sha2(F.concat(F.lit(key + "|"), kind, F.lit("|"), attempt.cast("string"), F.lit("|"), canonical(entity, kind)), 256)
    # each is computed once
    once = F.struct(entity.alias("entity"), digest.alias("digest"), kind.alias("kind"), attempt.cast("int").alias("attempt"))
    return F.transform(F.array(once), lambda x: _surrogate(x["entity"], x["kind"], x["digest"], x["attempt"]))[0]


def _luhn(digits: Column) -> Column:
    """Checksum of the digits of a number (an array), the last one with weight 1."""
    n = F.size(digits)
    weighted = F.transform(digits, lambda d, i: F.when((n - i) % 2 == 0, d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)).otherwise(d.cast("int")))
    return F.aggregate(weighted, F.lit(0), lambda s, x: s + x) % 10


def _digits(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("[0-9]"), F.lit(0))


def _card(entity: Column, made: Column) -> Column:
    """`made` with a valid check digit where the entity has one."""
    body = F.substring(made, F.lit(1), F.length(made) - 1)
    check = (10 - _luhn(_digits(F.concat(body, F.lit("0"))))) % 10
    return F.when(_luhn(_digits(entity)) == 0, F.concat(body, check.cast("string"))).otherwise(made)


def _iban(made: Column, entity: Column) -> Column:
    """Country of the entity, two check digits, and the rest of `made`."""
    country, rest = F.substring(entity, 1, 2), F.substring(made, F.lit(5), F.length(made))
    letters = F.split(F.concat(F.replace(rest, F.lit(" "), F.lit("")), country, F.lit("00")), "")
    number = lambda c: F.when(c.rlike("^[0-9]$"), c.try_cast("int")).otherwise(F.ascii(c) - 55)
    rest_of = F.aggregate(letters, F.lit(0), lambda s, c: (s * F.when(c.rlike("^[0-9]$"), 10).otherwise(100) + number(c)) % 97)
    return F.concat(country, F.lpad((98 - rest_of).cast("string"), 2, "0"), rest)


def _surrogate(entity: Column, kind: Column, digest: Column, attempt: Column) -> Column:
    """What stays in front, keyed letters and digits in the place of others (one more every few attempts), what stays behind."""
    n = lambda i: _number(digest, F.lit(i))
    none, rest = F.lit(""), lambda front: F.substring(entity, F.length(front) + 1, F.length(entity))
    front = (
        F.when(kind == "phone", F.regexp_extract(entity, r"^\+[0-9]{1,3}(?=[ .(-])", 0))
        .when(kind == "local", F.regexp_extract(entity, r"^\(?0", 0)).when(kind == "card", F.regexp_extract(entity, r"^(?:[0-9][ -]?){5}[0-9]", 0))
        .when(kind == "key", F.regexp_extract(entity, r"^(?:AKIA|ASIA|gh[pousr]_|(?:sk|pk|rk)[-_](?:live_|test_)?|xox[abprs]-|AIza)", 0)).otherwise(none)
    )
    more = lambda letter, each: F.repeat(F.lit(letter), F.floor(attempt / each).cast("int"))
    email = F.regexp_replace(F.regexp_replace(entity, r"\.[^.]*$", ""), "@", F.concat(more("x", GROW_EMAILS), F.lit("@")))
    body = F.when(kind == "email", email).when(kind.isin("iban", "key"), rest(front)).otherwise(F.concat(rest(front), more("0", GROW_NUMBERS)))
    back = F.when(kind == "email", F.regexp_extract(entity, r"\.[^.]*$", 0)).otherwise(none)
    like = F.transform(F.array(F.concat(front, _like(body, digest), back)), lambda x: F.when(kind == "iban", _iban(x, entity)).when(kind == "card", _card(entity, x)).otherwise(x))[0]
    ip = F.concat_ws(".", *[(n(i) % 254 + 1).cast("string") for i in range(4)])
    longer = F.when((kind == "ip6") & (attempt >= GROW_NUMBERS) & entity.contains("::"), F.concat(F.lit(":"), F.substring(digest, 60, 4))).otherwise(none)
    return (
        F.when(kind.isin("secret", "ip6"), F.concat(_hexadecimal(entity, digest), longer)).when(kind == "ip", ip)
        .when(kind.isin(*NAME_KINDS), _word(entity, kind, digest, attempt)).otherwise(like)
    )


def entities_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def _part_key(part: Column) -> Column:
    return F.concat(part["kind"], F.lit("|"), canonical(part["value"], part["kind"]))


def rewritten(entity: Column, attempts: Column, key: str) -> Column:
    """An entity's surrogate; attempts: by part, those above 0."""

    def made(kind: Column) -> Column:
        new = F.transform(_parts(entity, kind), lambda x: surrogate(x["value"], x["kind"], F.coalesce(F.try_element_at(attempts, _part_key(x)), F.lit(0)), key))
        name = F.array_join(new, " ")
        title = F.regexp_extract(entity, r"^\S+ ", 0)
        return F.when(kind.isin(*NAMES), F.concat(title, F.when(entity.rlike(r"\p{Ll}"), name).otherwise(F.upper(name)))).otherwise(new[0])

    return F.transform(F.array(kind_of(entity)), made)[0]  # the kind is found once


def attempts_needed(docs: DataFrame, key: str) -> DataFrame | None:
    """(part, attempt) of the entities and words whose first surrogates collide; None if there are none.

    An error where `MOST_ATTEMPTS` don't part them (more than half of all IPv4 addresses occur).
    """
    found = docs.select(F.explode(F.array_distinct(entities_of(F.col("text")))).alias("entity")).distinct()
    parts = found.select(F.explode(parts_of(F.col("entity"))).alias("x")).select(
        _part_key(F.col("x")).alias("part"), F.col("x.kind").alias("kind"), canonical(F.col("x.value"), F.col("x.kind")).alias("value")).distinct()
    held = common.checkpoint(parts.withColumn("attempt", F.lit(0)))
    moved = None
    for attempt in range(1, MOST_ATTEMPTS + 1):
        drawn = held.withColumn("made", surrogate(F.col("value"), F.col("kind"), F.col("attempt"), key))
        drawn = common.checkpoint(drawn.select("part", "attempt", canonical(F.col("made"), F.col("kind")).alias("made")))
        first = drawn.groupBy("made").agg(F.min_by("part", F.struct("attempt", "part")).alias("owner"), F.count("*").alias("owners"))
        twice = drawn.join(first.filter("owners > 1"), "made").filter("part <> owner").select("part")
        real = drawn.join(held.select(F.col("value").alias("made")), "made", "left_semi").select("part")
        failed = common.checkpoint(twice.union(real).distinct())
        if failed.isEmpty():
            return moved
        held = common.checkpoint(
            held.join(failed.withColumn("failed", F.lit(True)), "part", "left")
            .select("part", "kind", "value", F.when(F.col("failed"), F.lit(attempt)).otherwise(F.col("attempt")).alias("attempt"))
        )
        moved = held.filter("attempt > 0").select("part", "attempt")
    raise ValueError(f"surrogates still collide after {MOST_ATTEMPTS} attempts")


def replace_entities(docs: DataFrame, key: str = KEY) -> DataFrame:
    """`docs` with surrogates in `text`, and n_entities."""
    columns = [c for c in docs.columns if c != "n_entities"]
    own = lambda name, tag=uuid.uuid4().hex: f"{name}_{tag}"  # noqa: E731  no input has such a column
    found = entities_of(F.col("text"))
    moved = attempts_needed(docs, key)
    if moved is None:
        met = docs.withColumn(own("attempts"), F.lit(None).cast("map<string,int>"))
    else:
        # documents that hold a moved part, by id and text: rows that share both are the same case
        held = docs.select(F.col("doc_id").alias("id"), F.sha2("text", 256).alias("sha"), F.explode(F.array_distinct(found)).alias("entity"))
        parts = held.select("id", "sha", F.explode(parts_of(F.col("entity"))).alias("x")).select("id", "sha", _part_key(F.col("x")).alias("part"))
        attempts = parts.join(moved, "part").groupBy("id", "sha").agg(F.map_from_entries(F.collect_set(F.struct("part", "attempt"))).alias(own("attempts")))
        attempts = attempts.withColumnsRenamed({"id": own("id"), "sha": own("sha")})
        met = docs.join(attempts, F.col("doc_id").eqNullSafe(F.col(own("id"))) & (F.sha2("text", 256) == F.col(own("sha"))), "left")
    met = met.withColumn(own("found"), found)
    gaps = F.split(F.col("text"), PATTERN, -1)
    new = F.transform(own("found"), lambda e: rewritten(e, F.col(own("attempts")), key))
    text = F.when(F.size(own("found")) > 0, F.concat_ws("", F.flatten(F.zip_with(gaps, new, lambda g, s: F.array(g, F.coalesce(s, F.lit("")))))))
    return met.select(
        *[F.coalesce(text, F.col("text")).alias("text") if c == "text" else F.col(c) for c in columns], F.coalesce(F.size(own("found")), F.lit(0)).cast("long").alias("n_entities"))
