"""PII surrogates (5): keyed, type-consistent replacements for detected entities.

Detected are e-mail addresses, IPv4 addresses, phone numbers (with a country code, in brackets, in threes and fours, or from a
0 on), payment card numbers (16 digits in fours; of 13 to 19 digits those with a right check digit), social security numbers
(3-2-4) and names after a form of address: up to three words with initials and small words like `de`, which end before another form
of address or a word that opens a sentence.  Names without a form of address, other numbers and addresses are not.  Each distinct entity of the corpus gets one surrogate, made from a keyed hash of its type and value, so equal
entities stay equal everywhere (coreference); numbers are equal if their digits are, however they are written, and e-mail
addresses whatever their case.
Surrogates keep the format: letters stay letters of the same case and script, digits digits, punctuation stays; card numbers
keep their first digit and a right check digit, phones their country code, names the gender of their form of address.  Two
entities with one surrogate, or a surrogate that is itself an entity of the corpus, get a new attempt until all are distinct;
names and addresses grow with the attempts, so that they don't run out.  Only DataFrame functions are used.

Every pattern takes time in proportion to a text's length, however long its runs of letters or digits are.  Texts without
entities, null and empty ones come back as they are.  Equal rows are treated alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exchange import salted, settled

# Nothing starts inside a run, and what repeats is bounded or gives nothing back: no text can make a pattern slow or deep.
EMAIL = r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}][\p{L}\p{N}._%+\-]{0,63}+@(?:[\p{L}\p{N}\-]{1,63}+\.){1,10}[A-Za-z]{2,63}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IP = rf"(?<![\p{{L}}\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)"
_ABROAD = r"(?<![\p{L}\p{N}+])\+(?=(?:[ .\-()/]{0,2}\d){8,15}(?!\d))\d{1,3}(?:[ .\-/]?\(?\d{1,4}\)?){2,6}(?!\d)"
_BRACKETS = r"(?<![\p{L}\p{N}])\(\d{2,5}\)[ ]?\d{2,4}(?:[ .\-]\d{2,4}){1,3}(?!\d)"
_THREES = r"(?<![\p{L}\p{N}.\-/])\d{3}(?:[.]\d{3}[.]|-\d{3}-|[ ]\d{3}[ ])\d{4}(?![\p{L}\d]|[.\-]\d)"
_FROM_ZERO = r"(?<![\p{L}\p{N}.\-/])0(?=(?:[ ./\-]?\d){8,11}(?!\d))\d{1,4}(?:[ ./\-]\d{2,8}){1,5}(?!\d)"
_SOCIAL = r"(?<![\p{L}\p{N}.\-/])\d{3}-\d{2}-\d{4}(?![\p{L}\d]|[.\-]\d)"
PHONE = "|".join((_ABROAD, _BRACKETS, _THREES, _FROM_ZERO, _SOCIAL))
_FOURS = r"\d{4}[ \-]?\d{4}[ \-]?\d{4}[ \-]?\d{4}"
CARD = rf"(?<!\d)(?:{_FOURS}|3[47]\d{{2}}[ \-]?\d{{6}}[ \-]?\d{{5}}|[3-6]\d{{12,18}})(?!\d)"
#: Forms of address of men, of women, and of neither.
MALE, FEMALE, NEUTRAL = "Mr|Herr|Monsieur|Señor|Sr|Don|Господин", "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Doña|Госпожа", "Dr|Prof"
#: Small words within names, and words in capitals after a name that begin something else.
PARTICLES = "de|du|des|di|da|del|della|dos|das|la|le|van|von|vom|der|den|ter|ten|zu|zum|bin|al|el|y"
OPENERS = "Please|Thank|Thanks|Dear|Best|Kind|Regards|The|This|That|These|And|But|Or|If|In|On|At|To|For|From|With|We|You|He|She|It|They|His|Her|Our|Your|Is|Was|Has|Have|Will|Can|Could|Would|Should|Not|Yes|No|As|By|Bitte|Danke|Und|Der|Die|Das|Wir|Sie|Er|Merci|Et|Le|La|Les|Il|Elle|Nous|Vous|Gracias|El|Los|Las|Ella|Por"
_PART = rf"(?:(?:{PARTICLES}) ){{0,3}}(?!(?:{MALE}|{FEMALE}|{NEUTRAL}|{OPENERS})(?![\p{{L}}'\-]))\p{{Lu}}[\p{{L}}'\-]{{1,63}}+"
NAME = rf"(?<![\p{{L}}])(?:{MALE}|{FEMALE}|{NEUTRAL})\.? (?:\p{{Lu}}\. ){{0,3}}{_PART}(?: (?:\p{{Lu}}\. ){{0,3}}{_PART}){{0,2}}"
# Within a word only a card number can begin, so the other patterns aren't tried there.
ENTITY = rf"(?<!\p{{L}})(?=[\p{{L}}\p{{N}}+(])(?:{'|'.join((EMAIL, IP, PHONE, CARD, NAME))})|{CARD}"
ROUNDS = 50


def type_of(value: Column) -> Column:
    return (
        F.when(value.contains("@"), "email")
        .when(value.rlike(r"^(?:\d{1,3}\.){3}\d{1,3}$"), "ip")
        .when(value.rlike(rf"^(?:{_SOCIAL})$"), "social")
        .when(value.startswith("+"), "phone")
        .when(value.rlike(rf"^(?:{CARD})$"), "card")
        .when(value.rlike(r"^[\d(]"), "phone")
        .when(value.rlike(rf"^(?:{FEMALE})\.? "), "woman")
        .when(value.rlike(rf"^(?:{MALE})\.? "), "man")
        .otherwise("person")
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def canonical(value: Column) -> Column:
    """What equal entities have in common: the digits of numbers (with the + of a country code), addresses without regard to case, else
    the value itself."""
    kind = type_of(value)
    return F.when(kind.isin("card", "social"), _digits(value)).when(kind == "email", F.lower(value)).when(kind == "phone", F.concat(F.when(value.startswith("+"), "+").otherwise("0:"), _digits(value))).otherwise(value)


def _stream(key: str, *parts: Column) -> Column:
    """64 bytes as hexadecimal digits, different for each of the parts."""
    return F.sha2(F.concat_ws("\x1f", F.lit(key), *parts), 512)


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substring(stream, (F.pmod(i, F.lit(64)) * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _letter(c: Column, n: Column) -> Column:
    """A letter of c's script and case chosen by n."""
    of = lambda letters: F.substring(F.lit(letters), (F.pmod(n, F.lit(len(letters))) + 1).cast("int"), F.lit(1))
    return (
        F.when(c.rlike("[0-9]"), of("0123456789"))
        .when(c.rlike("[a-z]"), of("abcdefghijklmnopqrstuvwxyz"))
        .when(c.rlike("[A-Z]"), of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        .when(c.rlike(r"\p{IsCyrillic}") & c.rlike(r"\p{Ll}"), of("абвгдежзиклмнопрстуфхцчшэюя"))
        .when(c.rlike(r"\p{IsCyrillic}"), of("АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"))
        .when(c.rlike(r"\p{IsGreek}") & c.rlike(r"\p{Ll}"), of("αβγδεζηθικλμνξοπρστυφχψω"))
        .when(c.rlike(r"\p{IsGreek}"), of("ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"))
        .when(c.rlike(r"\p{IsHan}"), of("安北成大恩方光海吉金林明平青山水天文新永"))
        .when(c.rlike(r"\p{IsLatin}") & c.rlike(r"\p{Ll}"), of("àâçéèêëîïôöùûüñ"))
        .when(c.rlike(r"\p{IsLatin}"), of("ÀÂÇÉÈÊËÎÏÔÖÙÛÜÑ"))
        .when(c.rlike(r"\p{N}"), of("0123456789"))
        .when(c.rlike(r"\p{L}"), of("abcdefghijklmnopqrstuvwxyz"))
        .otherwise(c)
    )


def _same_shape(value: Column, stream: Column) -> Column:
    chars = F.filter(F.split(value, ""), lambda c: c != "")
    return F.array_join(F.transform(chars, lambda c, i: _letter(c, _byte(stream, i))), "")


def _check(digits: Column) -> Column:
    """The check digit that belongs after the given digits: every other one is doubled, from the last on."""
    chars = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    one = lambda c, i: F.when(i % 2 == 0, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int"))
    total = F.aggregate(F.transform(chars, one), F.lit(0), lambda s, x: s + x)
    return F.pmod(F.lit(10) - F.pmod(total, F.lit(10)), F.lit(10))


def _is_right(digits: Column) -> Column:
    return F.substring(digits, -1, 1).cast("int") == _check(F.substring(digits, F.lit(1), F.length(digits) - 1))


def is_entity(value: Column) -> Column:
    """False for long numbers that look like a card number only by their length."""
    return (type_of(value) != "card") | value.rlike(rf"^{_FOURS}$") | F.coalesce(_is_right(_digits(value)), F.lit(False))


def _laid_out(value: Column, digits: Column) -> Column:
    """value with its digits replaced, one after the other."""
    place = lambda i: F.length(_digits(F.substring(value, F.lit(1), i))) + 1
    chars = F.filter(F.split(value, ""), lambda c: c != "")
    return F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike("[0-9]"), F.substring(digits, place(i), F.lit(1))).otherwise(c)), "")


#: Syllables of given and family names, and endings by gender.
_FIRST, _SECOND = ("Al", "Ber", "Car", "Dan", "El", "Fer", "Gus", "Hen", "Il", "Jor", "Kas", "Lor", "Mar", "Nor", "Ol", "Per", "Ro", "San", "Tor", "Vin"), ("ba", "ce", "di", "fo", "gu", "la", "me", "ni", "ro", "tu", "va", "se")
_ENDS = {"man": ("n", "rd", "s", "to"), "woman": ("a", "ette", "ia", "na"), "person": ("el", "is", "or", "y")}


def _name(word: Column, kind: Column, stream: Column, last: Column, attempt: Column) -> Column:
    """A name word; family names end like those of no gender.  Words of other scripts keep their shape instead.  After every
    third attempt there is a syllable more."""
    pick = lambda words, i: F.element_at(F.array(*map(F.lit, words)), F.pmod(_byte(stream, i), F.lit(len(words))) + 1)
    ending = F.when(last, pick(_ENDS["person"], F.lit(5))).when(kind == "man", pick(_ENDS["man"], F.lit(5))).when(kind == "woman", pick(_ENDS["woman"], F.lit(5))).otherwise(pick(_ENDS["person"], F.lit(5)))
    more = F.array_join(F.transform(F.sequence(F.lit(0), F.floor(attempt / 3).cast("int")), lambda i: F.when(i > 0, pick(_SECOND, i + 7)).otherwise("")), "")
    made = F.concat(pick(_FIRST, F.lit(0)), pick(_SECOND, F.lit(1)), pick(_SECOND, F.lit(2)), F.when(_byte(stream, F.lit(3)) % 2 == 0, pick(_SECOND, F.lit(4))).otherwise(F.lit("")), more, ending)
    return F.when(word.rlike(r"^[\p{IsLatin}'\-]+$"), made).otherwise(F.concat(_same_shape(word, stream), F.when(attempt >= 9, _same_shape(word, F.reverse(stream))).otherwise("")))


def surrogate(value: Column, kind: Column, attempt: Column, key: str) -> Column:
    """The surrogate of an entity in its canonical form at an attempt; pure in its arguments."""
    stream = _stream(key, kind, value, attempt.cast("string"))
    domain = F.substring_index(value, "@", -1)
    tld = F.substring_index(domain, ".", -1)
    local = F.substring_index(value, "@", 1)
    # one domain keeps one surrogate in all addresses; after every third attempt the name before it has a letter more
    longer = F.concat(local, F.expr("repeat('a', cast(floor(attempt / 3) AS int))"))
    mail = F.concat(_same_shape(longer, stream), F.lit("@"), _same_shape(F.substring_index(domain, ".", 1), _stream(key, F.lit("domain"), F.lower(domain))), F.lit(".example."), tld)
    octets = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.when(i == 0, 1 + F.pmod(_byte(stream, i), F.lit(223))).otherwise(_byte(stream, i)).cast("string"))
    code = F.regexp_extract(value, r"^(?:\+\d{1,2}|0:0?)", 0)
    phone = F.concat(code, _same_shape(F.substring(value, F.length(code) + 1, F.length(value)), stream))
    plain = F.concat(F.substring(value, 1, 1), _same_shape(F.substring(value, F.lit(2), F.length(value) - 2), stream))
    right, wrong = _check(plain), F.pmod(_check(plain) + 1 + F.pmod(_byte(stream, F.lit(40)), F.lit(9)), F.lit(10))
    card = F.concat(plain, F.when(_is_right(value), right).otherwise(wrong).cast("string"))
    parts = F.split(value, " ")
    family = F.element_at(parts, -1)
    # a family name alone and with other names before it stays the same name; small words stay, initials get another letter
    def before(word):
        made = _name(word, kind, _stream(key, F.lit("given"), kind, word, attempt.cast("string")), F.lit(False), attempt)
        initial = F.concat(_letter(F.substring(word, 1, 1), _byte(_stream(key, F.lit("initial"), word), F.lit(0))), F.lit("."))
        return F.when(word.rlike(f"^(?:{PARTICLES})$"), word).when(word.rlike(r"^\p{Lu}\.$"), initial).otherwise(made)

    middle = F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0))), before)
    given = F.when(F.size(parts) > 2, F.concat(F.array_join(middle, " "), F.lit(" "))).otherwise("")
    name = F.concat(F.element_at(parts, 1), F.lit(" "), given, _name(family, kind, _stream(key, F.lit("family"), family, attempt.cast("string")), F.lit(True), attempt))
    social = F.concat(F.lit("9"), _same_shape(F.substring(value, 2, 20), stream))
    return F.when(kind == "email", mail).when(kind == "ip", F.array_join(octets, ".")).when(kind == "social", social).when(kind == "phone", phone).when(kind == "card", card).otherwise(name)


def in_format(value: Column, made: Column) -> Column:
    """The surrogate of a canonical form, written as the value is."""
    chars = F.filter(F.split(made, ""), lambda c: c != "")
    cased = F.array_join(F.transform(chars, lambda c, i: F.when((i < F.length(F.substring_index(value, "@", 1))) & F.substring(value, i + 1, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)), "")
    return F.when(type_of(value).isin("phone", "card", "social"), _laid_out(value, _digits(F.regexp_replace(made, "^0:", "")))).when(type_of(value) == "email", cased).otherwise(made)


def assign(entities: DataFrame, key: str) -> DataFrame:
    """value, kind, surrogate, attempt from distinct canonical values with their kind: all surrogates distinct and none of them a
    value."""
    made = lambda df: df.withColumn("surrogate", surrogate(F.col("value"), F.col("kind"), F.col("attempt"), key))
    rows = settled(made(entities.select("value", "kind", F.lit(0).alias("attempt"))))
    for _ in range(ROUNDS):
        keeper = rows.groupBy("surrogate").agg(F.min(F.struct("attempt", "value")).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
        taken = rows.join(keeper, "surrogate").where(F.col("value") != F.col("least.value")).select("value")
        real = rows.select(F.col("surrogate").alias("value")).join(rows.select("value"), "value", "left_semi").select(F.col("value").alias("surrogate")).distinct()
        clash = settled(taken.union(rows.join(real, "surrogate", "left_semi").select("value")).distinct())
        if clash.isEmpty():
            return rows
        again = rows.join(clash, "value", "left_semi").withColumn("attempt", F.col("attempt") + 1).drop("surrogate")
        rows = settled(rows.join(clash, "value", "left_anti").unionByName(made(again)))
    raise ValueError("surrogates still collide; the formats leave too few values")


def entities_of(text: Column) -> Column:
    """Everything that the patterns match, in order; is_entity tells which of it counts."""
    return F.regexp_extract_all(text, F.lit(ENTITY), 0)


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text with every entity replaced, n_entities (occurrences), for every row."""
    found = docs.select("doc_id", F.xxhash64("text").alias("row"), "text", F.coalesce(entities_of(F.col("text")), F.array().cast("array<string>")).alias("found"))
    mentions = found.where(F.size("found") > 0).select("doc_id", "row", F.explode(F.array_distinct("found")).alias("value")).distinct()
    mentions = settled(mentions.where(is_entity(F.col("value"))))
    values = settled(mentions.select("value").distinct().select("value", canonical(F.col("value")).alias("canon"), type_of(F.col("value")).alias("kind")))
    made = assign(values.select(F.col("canon").alias("value"), "kind").distinct(), key).select(F.col("value").alias("canon"), "kind", "surrogate")
    table = values.join(made, ["canon", "kind"]).select("value", in_format(F.col("value"), F.col("surrogate")).alias("surrogate"))
    told, table = salted(mentions, table, "value", F.xxhash64("doc_id", "row"))
    maps = told.join(table, ["value", "salt"]).groupBy(F.col("doc_id").alias("m_id"), F.col("row").alias("m_row")).agg(F.map_from_entries(F.collect_list(F.struct("value", "surrogate"))).alias("map"))
    joined = docs.select("doc_id", "text").withColumn("row", F.xxhash64("text")).join(maps, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("row") == F.col("m_row")), "left")
    joined = joined.select("doc_id", "text", "map", F.when(F.col("map").isNotNull(), entities_of(F.col("text"))).alias("found"))
    gaps = F.split("text", ENTITY, -1)
    replaced = F.transform("found", lambda v: F.coalesce(F.try_element_at(F.col("map"), v), v))
    pieces = F.zip_with(gaps, replaced, lambda g, s: F.concat(g, F.coalesce(s, F.lit(""))))
    return joined.select(
        "doc_id",
        F.when(F.col("map").isNull(), F.col("text")).otherwise(F.array_join(pieces, "")).alias("text"),
        F.coalesce(F.size(F.filter("found", lambda v: F.map_contains_key(F.col("map"), v))), F.lit(0)).cast("long").alias("n_entities"),
    )
