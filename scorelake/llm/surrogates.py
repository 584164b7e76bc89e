"""Surrogates for personal data: keyed replacements of the same type, format, script and gender.

Entities are found by one pattern, checked by their type (octets, Luhn digit) and
replaced by values drawn from a keyed digest (HMAC) of type and canonical value.
Names are replaced word by word, given names by gender and surnames without, so
`Mr. John Smith`, `Mr. Smith` and `Mrs. Smith` keep the surname that they share. A
word of a name that the same text has elsewhere, without a title, is replaced there
too. An initial becomes that of the surrogate of the given name that the text has
for it, or else a letter drawn by initial and surname.
All different entities of the corpus are drawn once; where two draw the same
surrogate, or one draws a value that occurs as an original, they draw again until
all are distinct. Later draws come from ever larger ranges, so that any number of
entities finds its surrogates.
Surrogates cannot belong to anyone where a reserved range exists and has room:
example domains, 9xx identity numbers, 240/4 addresses.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, checkpointed

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Titles that tell a person's gender, by script.
TITLES = {
    ("m", "latin"): ("Mr", "Sir", "Herr", "Monsieur", "Señor"),
    ("f", "latin"): ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Señora"),
    ("m", "cyrillic"): ("Господин",),
    ("f", "cyrillic"): ("Госпожа",),
}
#: Given names of surrogates.
GIVEN = {
    ("m", "latin"): ("Adam", "Bruno", "Daniel", "Emil", "Felix", "Hugo", "Ivo", "Karl", "Leon", "Martin", "Nils", "Oscar", "Paul", "Robert", "Simon", "Viktor"),
    ("f", "latin"): ("Anna", "Berta", "Clara", "Diana", "Emma", "Flora", "Greta", "Helena", "Irene", "Julia", "Laura", "Maria", "Nora", "Olga", "Rosa", "Vera"),
    ("m", "cyrillic"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Иван", "Максим", "Олег"),
    ("f", "cyrillic"): ("Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Мария", "Ольга"),
}
#: Endings of later given names.
ENDINGS = {("m", "latin"): "in", ("f", "latin"): "a", ("m", "cyrillic"): "ан", ("f", "cyrillic"): "а"}
#: Syllables of surrogate surnames, and of later given names.
SYLLABLES = {
    "latin": ("ba", "ber", "dal", "den", "far", "gen", "hol", "kar", "lan", "mer", "nor", "pel", "ran", "sol", "tam", "ver"),
    "cyrillic": ("ба", "вел", "гор", "дал", "жен", "зор", "кар", "лан", "мир", "нов", "пол", "рас", "сол", "тар", "фил", "чер"),
}
_PREFIX = r"\p{L}+(?:\.\h?|\h)(?:(?:Dr|Prof|Rev|Hon|Dipl|Ing|Mag)\.\h?|(?:Doktor|Doctor|Docteur|Professor|Professeur)\h)*+"
#: Small words within a name; they stay as they are.
PARTICLES = ("von", "vom", "van", "de", "del", "della", "di", "da", "du", "des", "do", "dos", "das", "bin", "ibn", "ten", "ter", "af", "av", "y")
AFTER_PARTICLES = ("der", "den", "dem", "la", "le", "las", "los", "het", "und", "zu")
_CORE = r"(?:Ste?\.\h?)?(?:(?:\p{Ll}{1,4}['’ʼ]|(?:al|el)[-‐‑]))?\p{Lu}[\p{L}\p{M}]*+(?:(?:['’ʼ](?!s(?!\p{L}))|[-‐‑])\p{L}[\p{L}\p{M}]*+)*+"
_WORD = rf"(?:\p{{Lu}}\.(?:-?\p{{Lu}}\.)*+(?:-?{_CORE})?|{_CORE})"
_SMALL = rf"(?:(?:{'|'.join(PARTICLES)})\h(?:(?:{'|'.join(AFTER_PARTICLES)})\h){{0,2}})"
#: A title and all capitalised words, initials, compounds and particles behind it; a possessive s is left out.
_NAME = rf"(?<!\p{{L}})(?:{'|'.join(t for ts in TITLES.values() for t in ts)})(?=[.\h]){_PREFIX.removeprefix(r'\p{L}+')}{_SMALL}{{0,2}}{_WORD}(?:\h{_SMALL}{{0,2}}{_WORD})*+"
#: Country codes of the telephone network; all others have three digits.
_COUNTRY = r"(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
_SEP = r"[ \u00a0./-]"
#: A further digit of a number in groups; a separator is none before an address.
_MORE = rf"(?:{_SEP}(?!{_OCTET}(?:\.{_OCTET}){{3}}(?!\d)))?\d"
#: A day that looks like the beginning of a national number.
_DAY = rf"\d\d{_SEP}\d\d{_SEP}(?:(?:19|20)\d\d(?!\d)|\d\d(?!{_SEP}?\d))"
#: North American numbers, numbers with a country code and up to 15 digits, and national numbers (ten digits as 3-3-4, or a leading 0).
_PHONE = r"(?=[+(\d])(?<![\p{L}\d+])(?:" + "|".join([
    rf"(?:\+1{_SEP}?|\+\d{{1,3}}[ .-]?(?=[(]|\d{{3}}[.-]))?(?:\(\d{{3}}\){_SEP}?|\d{{3}}[.-])\d{{3}}[ .-]\d{{4}}(?!\d)",
    rf"(?:\+1{_SEP}?)?[2-9]\d\d{_SEP}[2-9]\d\d{_SEP}\d{{4}}(?!\d)",
    r"\+\d{10,15}(?!\d)",
    rf"(?:\+|00(?=[1-9]\d{{0,2}}{_SEP})){_COUNTRY}{_SEP}?\(\d{{1,5}}\)(?:{_SEP}?\d)(?:{_MORE}){{3,11}}(?!\d)",
    rf"(?:\+|00(?=[1-9]\d{{0,2}}{_SEP}))\d(?:{_MORE}){{6,14}}(?!\d)",
    rf"(?<!\d[.,:/-])(?!{_DAY})(?=(?:\D{{0,2}}\d){{9}})(?:\(0[1-9]\d{{0,4}}\){_SEP}?|0[1-9]\d{{0,4}}{_SEP})\d(?:{_MORE}){{3,9}}(?!\d)",
]) + ")"
#: Kinds in the order in which a match is tried against them.
KINDS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": _PHONE,
    "card": r"(?<![\p{L}\d])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![\p{L}\d])",
    "name": _NAME,
}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
#: What a text without titles, or without an @ and four digits close together, can't lack if it mentions anybody.
_TITLED, _NUMBERED = rf"(?:{'|'.join(t for ts in TITLES.values() for t in ts)})[.\h]", r"@|\d(?:\D{0,3}\d){3}"
#: Kinds of the words of names.
WORDS = ("given m", "given f", "surname")
ALPHABET = {"latin": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "cyrillic": "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЩЭЮЯ"}
#: Parts of what is known of a text's entities: a look-up passes these, and then the entities of one part.
BUCKETS = 512
#: Draws of the usual size; every later one of an e-mail address, a telephone number or a name is longer by a character, digit or syllable.
USUAL = 3
#: Draws from the reserved range of addresses and identity numbers; later ones leave the range or get a further digit each.
RESERVED = 12


def digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def luhn_sum(number: Column) -> Column:
    """Sum of a string of digits by the Luhn rule, from the right."""
    each = F.transform(F.split(F.reverse(number), ""), lambda c, i: F.when(i % 2 == 0, c.try_cast("int")).when(c.try_cast("int") > 4, c.try_cast("int") * 2 - 9).otherwise(c.try_cast("int") * 2))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))


def kind_of(match: Column) -> Column:
    """The kind of a match, or null if its check fails."""
    whole = {k: match.rlike(f"^(?:{p})$") for k, p in KINDS.items()}
    checked = whole | {"card": whole["card"] & (luhn_sum(digits(match)) % 10 == 0) & ~digits(match).rlike(r"^(\d)\1+$")}
    return reduce(lambda chain, k: chain.when(checked[k], F.lit(k)), list(KINDS)[1:], F.when(checked["email"], F.lit("email")))


def gender(match: Column) -> Column:
    male = "|".join(t for (g, _), ts in TITLES.items() if g == "m" for t in ts)
    return F.when(match.rlike(rf"^(?:{male})\b"), F.lit("m")).otherwise(F.lit("f"))


def canonical(kind: Column, match: Column) -> Column:
    """What makes two mentions the same entity."""
    phone = digits(F.regexp_replace(match, rf"^00|(?<=\d{_SEP}?)\(0\)", ""))  # 0049 is +49, and the 0 of +44 (0)20 isn't dialled
    return F.when(kind == "phone", phone).when(kind.isin("card", "ssn"), digits(match)).otherwise(F.lower(match))


def pieces(match: Column) -> Column:
    """A mention of a person as an array of (word, kind): null for what stays, `initial` for single letters, else one of WORDS.

    Titles, particles and signs between the words stay. The words behind the last
    blank are the surname.
    """
    size = F.length(F.regexp_extract(match, f"^{_PREFIX}", 0))
    run = F.substring(match, size + 1, F.length(match))
    before = F.length(F.regexp_extract(run, r"^(?:.*\h)?", 0))
    given = F.concat(F.lit("given "), gender(match))
    stays = f"^(?:{'|'.join((*PARTICLES, *AFTER_PARTICLES, 'al', 'el'))}|[dls]|St|Ste|[^\\p{{L}}\\p{{M}}]+)$"

    def words(part: Column, kind: Column) -> Column:
        each = F.regexp_extract_all(part, F.lit(r"[\p{L}\p{M}]+|[^\p{L}\p{M}]+"), F.lit(0))
        return F.transform(each, lambda w: F.struct(w.alias("word"), F.when(w.rlike(stays), F.lit(None)).when(F.length(w) == 1, "initial").otherwise(kind).alias("kind")))

    title = F.array(F.struct(F.substring(match, F.lit(1), size).alias("word"), F.lit(None).cast("string").alias("kind")))
    return F.concat(title, words(F.substring(run, F.lit(1), before), given), words(F.substring(run, before + 1, F.length(run)), F.lit("surname")))


def _digest(key: str, kind: Column, value: Column, attempt: Column, part: int) -> Column:
    """HMAC-SHA256 of a message, in hexadecimal digits."""
    block = (hashlib.sha256(key.encode()).digest() if len(key.encode()) > 64 else key.encode()).ljust(64, b"\0")
    inner, outer = (F.lit(bytearray(c ^ pad for c in block)) for pad in (0x36, 0x5C))
    message = F.concat_ws("\u0001", F.lit(str(part)), kind, value, attempt.cast("string")).cast("binary")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message), 256))), 256)


def _fill(pattern: Column, letters: Column, numbers: Column) -> Column:
    """The pattern with its digits and its letters replaced one by one; case, script and all other characters stay."""

    def one(c: Column, i: Column) -> Column:
        pick = F.conv(F.substring(letters, (i * 2 % 60 + 1).cast("int"), F.lit(2)), 16, 10).cast("int") % 26
        latin = F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), (pick + 1).cast("int"), F.lit(1))
        cyrillic = F.substring(F.lit("абвгдежзиклмнопрстуфхцчшщэюя"), (pick + 1).cast("int"), F.lit(1))
        low = F.when(c.rlike(r"\p{IsCyrillic}"), cyrillic).otherwise(latin)
        return F.when(c.rlike(r"\p{N}"), F.substring(numbers, (i % 60 + 1).cast("int"), F.lit(1))).when(c.rlike(r"\p{Lu}"), F.upper(low)).when(c.rlike(r"\p{L}"), low).otherwise(c)

    return F.array_join(F.transform(F.split(pattern, ""), one), "")


def surrogate(key: str, kind: Column, match: Column, attempt: Column) -> Column:
    """The replacement of a match, or of a word of a name."""
    value = canonical(kind, match)
    hexes = F.concat(_digest(key, kind, value, attempt, 0), _digest(key, kind, value, attempt, 1))
    numbers = F.translate(hexes, "abcdef", "012345")
    byte = lambda i: F.conv(F.substring(hexes, 2 * i + 1, 2), 16, 10).cast("int")
    beyond = lambda draws: F.greatest(attempt - (draws - 1), F.lit(0))
    email = F.concat(_fill(F.regexp_extract(match, "^([^@]*)@", 1), hexes, numbers), F.lit("@"), F.substring(hexes, F.lit(101), beyond(USUAL) + 6), F.lit(".example.org"))
    ip = F.concat_ws(".", F.when(attempt < RESERVED, byte(0) % 15 + 240).otherwise(byte(0) % 255 + 1).cast("string"), *[byte(i).cast("string") for i in (1, 2, 3)])
    ssn = F.concat(F.lit("9"), F.substring(numbers, 1, 2), F.lit("-"), F.substring(numbers, 3, 2), F.lit("-"), F.substring(numbers, F.lit(5), beyond(RESERVED) + 4))
    country = F.regexp_extract(match, rf"^(?:(?:\+|00){_COUNTRY}(?:{_SEP}?\(0\))?|\(?0)?", 0)
    phone = F.concat(country, _digits_by_order(F.substring(match, F.length(country) + 1, F.length(match)), numbers), F.substring(numbers, F.lit(61), beyond(USUAL)))
    body = F.concat(F.substring(digits(match), 1, 1), F.substring(numbers, F.lit(1), F.length(digits(match)) - 2))
    check = ((10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10).cast("string")
    card = _digits_by_order(match, F.concat(body, check))
    word = lambda k: F.transform(F.array(hexes), lambda h: _word(h, k, value, match, attempt))[0]
    words = {k: word(k) for k in WORDS}
    made = {"ip": ip, "ssn": ssn, "phone": phone, "card": card} | words
    return reduce(lambda chain, k: chain.when(kind == k, made[k]), made, F.when(kind == "email", email))


def _word(hexes: Column, kind: str, value: Column, match: Column, attempt: Column) -> Column:
    """A given name or a surname in the script and letter case of match; later draws have more syllables."""
    cyrillic = value.rlike(r"\p{IsCyrillic}")
    number = lambda at: F.conv(F.substring(hexes, at * 2 - 1, F.lit(2)), 16, 10).cast("int")
    pick = lambda names, n: F.element_at(F.array(*map(F.lit, names)), (n % len(names) + 1).cast("int"))
    of = lambda make: F.when(cyrillic, make("cyrillic")).otherwise(make("latin"))
    spoken = lambda n: of(lambda script: F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: pick(SYLLABLES[script], number(i))), ""))
    if kind == "surname":
        made = spoken(F.greatest(attempt - (USUAL - 1), F.lit(0)) + 4)
    else:
        made = F.when(attempt == 0, of(lambda script: pick(GIVEN[kind[-1], script], number(F.lit(1))))).otherwise(F.concat(spoken(attempt + 1), of(lambda script: F.lit(ENDINGS[kind[-1], script]))))
    return F.when((match == F.upper(match)) & (F.length(match) > 1), F.upper(made)).otherwise(F.initcap(made))


def _initial(key: str, letter: Column, surname: Column) -> Column:
    """Another letter of the same alphabet, drawn by the key for an initial and a surname; letters of no alphabet stay."""
    drawn = F.conv(F.substring(_digest(key, F.lit("initial"), F.concat_ws(":", F.lower(letter), surname), F.lit(0), 0), 1, 6), 16, 10).cast("int")
    out = letter
    for alphabet in ALPHABET.values():
        place = F.instr(F.lit(alphabet), F.upper(letter))
        other = F.substring(F.lit(alphabet), (place + drawn % (len(alphabet) - 1)) % len(alphabet) + 1, F.lit(1))
        out = F.when(place > 0, F.when(letter == F.upper(letter), other).otherwise(F.lower(other))).otherwise(out)
    return out


def _told(draws: Column, kind: Column, value: Column) -> Column:
    """What is known of a value in this text: the draw of an entity, or the letter of an initial; null if it doesn't occur."""
    return F.try_element_at(F.try_element_at(draws, F.pmod(F.xxhash64(value), F.lit(BUCKETS))), F.concat_ws(":", kind, value))


def _person(key: str, match: Column, draws: Column) -> Column:
    """A mention of a person with every word replaced."""

    def whole(parts: Column) -> Column:
        surname = F.lower(F.coalesce(F.try_element_at(F.filter(parts, lambda p: p["kind"] == "surname"), F.lit(-1))["word"], F.lit("")))

        def one(p: Column) -> Column:
            value = canonical(p["kind"], p["word"])
            letter = F.coalesce(_told(draws, F.lit("initial"), F.lower(p["word"])), _initial(key, p["word"], surname))
            drawn = F.coalesce(_told(draws, p["kind"], value).cast("int"), F.lit(0))
            return F.when(p["kind"].isNull(), p["word"]).when(p["kind"] == "initial", letter).otherwise(surrogate(key, p["kind"], p["word"], drawn))

        return F.array_join(F.transform(parts, one), "")

    return F.transform(F.array(pieces(match)), whole)[0]


def _again(key: str, gap: Column, draws: Column) -> Column:
    """Text between mentions, with the capitalised words replaced that belong to a name elsewhere in it."""

    def one(word: Column) -> Column:
        value = F.lower(word)
        drawn = F.coalesce(*[F.when(_told(draws, F.lit(k), value).isNotNull(), F.struct(F.lit(k).alias("kind"), _told(draws, F.lit(k), value).cast("int").alias("attempt"))) for k in reversed(WORDS)])
        made = F.transform(F.array(drawn), lambda d: F.when(d.isNotNull(), surrogate(key, d["kind"], word, d["attempt"])))[0]
        return F.when((F.length(word) > 1) & word.rlike(r"^\p{Lu}"), F.coalesce(made, word)).otherwise(word)

    return F.array_join(F.transform(F.regexp_extract_all(gap, F.lit(r"[\p{L}\p{M}]+|[^\p{L}\p{M}]+"), F.lit(0)), one), "")


def _digits_by_order(pattern: Column, numbers: Column) -> Column:
    """The pattern with its n-th digit replaced by the n-th of numbers."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("next"))

    def step(done: Column, c: Column) -> Column:
        digit = c.rlike(r"\d")
        return F.struct(F.concat(done["out"], F.when(digit, F.substring(numbers, done["next"], F.lit(1))).otherwise(c)).alias("out"), (done["next"] + digit.cast("int")).alias("next"))

    return F.aggregate(F.split(pattern, ""), start, step, lambda done: done["out"])


def _by_shape(text: Column, take: Callable[[str], Column], nothing: Column) -> Column:
    """take, with the pattern that suffices for a text: none, names alone, or all kinds."""
    return F.when(text.rlike(_NUMBERED), take(PATTERN)).when(text.rlike(_TITLED), take(KINDS["name"])).otherwise(nothing)


def mentions(text: Column) -> Column:
    """Array of the matches in a text."""
    return _by_shape(text, lambda p: F.regexp_extract_all(text, F.lit(p), F.lit(0)), F.array().cast("array<string>"))


def entities_of(match: Column) -> Column:
    """Array of (kind, value, match) of a match: one, or one for each word of a name; none if its check fails."""
    entity = lambda kind, m: F.struct(kind.alias("kind"), canonical(kind, m).alias("value"), m.alias("match"))

    def of(kind: Column) -> Column:
        words = F.transform(F.filter(pieces(match), lambda p: p["kind"] != "initial"), lambda p: entity(p["kind"], p["word"]))
        return F.when(kind == "name", words).when(kind.isNotNull(), F.array(entity(kind, match))).otherwise(F.array().cast("array<struct<kind:string,value:string,match:string>>"))

    return F.transform(F.array(kind_of(match)), of)[0]


def _redrawn(entities: DataFrame, key: str) -> DataFrame | None:
    """Entities (kind, value, match) that need a later draw, with its number; None if all first draws are distinct.

    An entity draws again while its surrogate is an original, or while another
    entity that comes before it (fewer draws, then the lesser value) has the same.
    """
    now = checkpointed(entities.withColumn("attempt", F.lit(0)).withColumn("made", surrogate(key, F.col("kind"), F.col("match"), F.lit(0))))
    while True:
        drawn = now.withColumn("made_value", canonical(F.col("kind"), F.col("made")))
        first = drawn.groupBy("kind", "made_value").agg(F.min(F.struct("attempt", "value")).alias("first"), F.count("*").alias("n")).filter("n > 1").select("kind", "made_value", "first")
        again = drawn.join(first, ["kind", "made_value"]).filter("value <> first.value").select("kind", "value")
        taken = drawn.join(entities.select("kind", F.col("value").alias("made_value")), ["kind", "made_value"], "left_semi").select("kind", "value")  # also by its own original
        again = checkpointed(again.union(taken).distinct())
        if not again.count():
            break
        now = now.join(again.withColumn("again", F.lit(1)), ["kind", "value"], "left").withColumn("attempt", F.col("attempt") + F.coalesce("again", F.lit(0))).drop("again")
        now = checkpointed(now.withColumn("made", surrogate(key, F.col("kind"), F.col("match"), F.col("attempt"))))
    later = now.filter("attempt > 0").select("kind", "value", "attempt")
    return later if later.count() else None


def _known(texts: DataFrame, later: DataFrame | None, key: str) -> DataFrame:
    """For each text (key, found) with names or redrawn entities: at, its key, and draws, from part and entity to what _told returns."""
    named = texts.select("key", F.explode(F.transform("found", lambda m: m["match"])).alias("match")).distinct()
    named = checkpointed(named.select("key", F.explode(entities_of(F.col("match"))).alias("e")).select("key", "e.kind", "e.value").distinct())
    named = named.withColumn("attempt", F.lit(0)) if later is None else named.join(later, ["kind", "value"], "left").fillna(0, ["attempt"])
    part = lambda value: F.pmod(F.xxhash64(value), F.lit(BUCKETS)).alias("part")
    words = named.filter(F.col("kind").isin(*WORDS) | (F.col("attempt") > 0)).select("key", part(F.col("value")), F.concat_ws(":", "kind", "value").alias("entity"), F.col("attempt").cast("string").alias("told"))
    given = named.filter(F.col("kind").isin(*WORDS[:2])).groupBy("key", F.left("value", F.lit(1)).alias("letter")).agg(F.min(F.struct("value", "kind", "attempt")).alias("e"))
    letter = F.left(surrogate(key, F.col("e.kind"), F.initcap("e.value"), F.col("e.attempt")), F.lit(1))
    initials = given.select("key", part(F.col("letter")), F.concat_ws(":", F.lit("initial"), "letter").alias("entity"), F.upper(letter).alias("told"))
    parts = words.unionByName(initials).groupBy("key", "part").agg(F.map_from_entries(F.collect_list(F.struct("entity", "told"))).alias("draws"))
    return parts.groupBy(F.col("key").alias("at")).agg(F.map_from_entries(F.collect_list(F.struct("part", "draws"))).alias("draws"))


def replace(docs: DataFrame, *, key: str) -> DataFrame:
    """docs with every entity in text replaced, and n_email, n_ip, n_ssn, n_phone, n_card, n_name (counts of mentions; names behind a title).

    The same key gives the same surrogates; equal entities get equal ones and
    different entities different ones. An empty key raises ValueError. Null and
    empty texts stay as they are, with counts of 0; texts without entities are not
    touched; repeated rows get equal results; an empty table gives an empty result.
    Columns of docs named like the counts are replaced; all others are passed on,
    whatever their names. The plan of the result holds what the key is turned into,
    so plans are as secret as the key. Only texts with a title are joined with what
    is known of their names, by two checksums and the length; time follows the
    number of words, also of one name.
    """
    if not key:
        raise ValueError("surrogates need a key")
    counts = [f"n_{k}" for k in KINDS]
    docs = docs.drop(*counts)
    columns = docs.columns
    found = docs.select(F.explode(mentions(F.col("text"))).alias("match")).groupBy("match").agg(F.lit(1))
    entities = checkpointed(found.select(F.explode(entities_of(F.col("match"))).alias("e")).groupBy("e.kind", "e.value").agg(F.min("e.match").alias("match")))
    later = _redrawn(entities, key)

    titled = F.coalesce(F.col("text").rlike(_TITLED), F.lit(False))
    if later is not None and not later.filter(~F.col("kind").isin(*WORDS)).isEmpty():
        titled = titled | F.coalesce(F.col("text").rlike(_NUMBERED), F.lit(False))
    others = F.struct(*[F.col(f"`{c}`") for c in columns if c != "text"], F.lit(0).alias("_none"))
    rows = docs.select(others.alias("row"), "text", F.transform(mentions(F.col("text")), lambda m: F.struct(m.alias("match"), kind_of(m).alias("kind"))).alias("found"))
    keyed = F.struct(F.xxhash64("text").alias("x"), F.crc32(F.col("text").cast("binary")).alias("c"), F.length("text").alias("n"))
    joined = rows.filter(titled).withColumn("key", keyed)
    known = checkpointed(_known(joined.filter(F.size("found") > 0), later, key))
    size = known.agg(F.count("*"), F.sum(F.aggregate(F.map_values("draws"), F.lit(0), lambda n, m: n + F.size(m)))).first()
    few = (size[0] + (size[1] or 0)) * 160 <= BROADCAST_BYTES

    def replaced(part: DataFrame, names: bool) -> DataFrame:
        draws = F.col("draws") if names else F.lit(None).cast("map<bigint,map<string,string>>")

        def one(m: Column) -> Column:
            drawn = F.coalesce(_told(draws, m["kind"], canonical(m["kind"], m["match"])).cast("int"), F.lit(0)) if names else F.lit(0)
            out = F.when(m["kind"].isNull(), m["match"])
            out = out.when(m["kind"] == "name", _person(key, m["match"], draws)) if names else out
            return out.otherwise(surrogate(key, m["kind"], m["match"], drawn))

        gaps = _by_shape(F.col("text"), lambda p: F.split(F.col("text"), p, -1), F.array(F.col("text")))
        if names:
            gaps = F.when(draws.isNotNull(), F.transform(gaps, lambda g: _again(key, g, draws))).otherwise(gaps)
        text = F.array_join(F.zip_with(gaps, F.transform("found", one), lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "")
        some = F.exists("found", lambda m: m["kind"].isNotNull())
        number = lambda k: F.coalesce(F.size(F.filter("found", lambda m: m["kind"] == k)).cast("long"), F.lit(0).cast("long")).alias(f"n_{k}")
        clean = F.when(some, text).otherwise(F.col("text"))
        return part.select(*[clean.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in columns], *map(number, KINDS))

    if few:  # one pass, and no shuffle
        return replaced(rows.withColumn("key", F.when(titled, keyed)).join(F.broadcast(known), F.col("key") == F.col("at"), "left"), True)
    return replaced(joined.join(known, F.col("key") == F.col("at"), "left"), True).unionByName(replaced(rows.filter(~titled), False))
