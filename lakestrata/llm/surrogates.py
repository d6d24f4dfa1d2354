"""PII surrogates: detected entities get keyed, type-consistent replacements, in DataFrame functions only.

One pattern finds all entities of a text, left to right: e-mail addresses, IP addresses of both versions, payment card
numbers, bank account numbers, social security numbers, phone numbers (international, also in groups; national with a
leading zero), and names that follow a title. An entity has one or more parts with a canonical form (digits of a number,
lower-cased local part and host of an address, each word of a name), so the same number in two formats, a surname under two
given names, or a host under many addresses is one part: coreference holds across the whole table. The pattern runs over
each text twice: once to find the entities, which are stored, and once, in texts that have some, to cut the text at them.

A part's surrogate is made from SHA-256 of (key, kind, canonical form, attempt) and keeps the type: cards keep their first
digit and whether their check digit holds, account numbers their country with check digits recomputed,
phone numbers their country code or leading zero (and the fictional exchange 555), private addresses stay private, addresses of
version 6 go to the range for documentation, e-mail addresses keep the shape of each character and their top-level domain, and names
keep script (Latin, Cyrillic), gender by the title, and capitals. The text keeps its format: separators stay, digits are replaced in place.

Distinctness is checked on the whole table, in rounds: a surrogate that is an original of its kind, was given out
already, or is claimed by several parts (all but the smallest) goes into the next round with the next attempt.
Rounds are grouped aggregates and equi-joins over the different parts only. So that small spaces cannot run out, from attempt
6 on names, local parts and hosts grow longer and addresses of a private range go to 10.0.0.0/8, which has room for all of
192.168.0.0/16 and 172.16.0.0/12; from attempt 12 on private addresses go to 240.0.0.0/4, which nobody is assigned, and social
security numbers may start with any digit. Local parts need to differ within their host only. What is left cannot run out before
half of a kind's whole space is in use (for instance 4 million different numbers of 7 digits under one country code); the job then ends with an error.

Defined results: null texts stay null, empty texts stay empty; texts without entities are returned unchanged; repeated
rows each get the same result; a null doc_id is kept as null; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm._common import ABSENT_ID, stored

MAX_ROUNDS = 64
LONGER_FROM = 6

# Patterns of the entities, titles with the gender they tell, and syllables of surrogate names.
_B, _E = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]++\.)+\p{L}{2,}"
IP = r"(?<![\p{L}\p{N}.])" + _OCTET + r"(?:\." + _OCTET + r"){3}(?![\p{L}\p{N}]|\.[0-9])"
CARD = _B + r"(?:[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|3[47][0-9]{2}[ -][0-9]{6}[ -][0-9]{5})" + _E
IBAN = _B + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?" + _E
SSN = _B + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _E
PHONE = (r"(?<![\p{L}\p{N}+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}"
         r"|\+[0-9]{1,3}[ .-]?[0-9]{1,3}(?:[ .-]?[0-9]{2,3}){2,4}"
         r"|0[0-9](?:[ .-][0-9]{2}){4}|0[0-9]{2,4}[ /-][0-9]{5,8}"
         r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})" + _E)
# global, private and link-local addresses, whole or shortened by ::
_HEX = "[0-9A-Fa-f]"
IP6 = (r"(?<![\p{L}\p{N}:.])(?:[23]" + _HEX + "{3}|[Ff][C-Ec-e]" + _HEX + "{2}):(?:(?:" + _HEX + "{1,4}:){6}" + _HEX + "{1,4}|(?:"
       + _HEX + "{1,4}:){0,5}(?::" + _HEX + r"{1,4}){1,6})(?![\p{L}\p{N}:])")
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "г-н")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа")
OTHER_TITLES = ("Dr", "Prof")
NAME = (r"(?<![\p{L}])(?:" + "|".join(MALE_TITLES + FEMALE_TITLES + OTHER_TITLES) + r")\.? \p{Lu}[\p{Ll}]+(?: \p{Lu}[\p{Ll}]+){0,2}" + _E)
LATIN = ("ba", "be", "do", "fa", "ga", "ka", "la", "le", "ma", "mi", "na", "no", "pa", "ra", "ro", "sa", "ta", "to", "ve", "za")
CYRILLIC = ("ба", "бе", "до", "фа", "га", "ка", "ла", "ле", "ма", "ми", "на", "но", "па", "ра", "ро", "са", "та", "то", "ве", "за")

KINDS = (("email", EMAIL), ("ip", IP), ("ip6", IP6), ("card", CARD), ("iban", IBAN), ("ssn", SSN), ("phone", PHONE), ("name", NAME))
# One group around everything but the card's separator, which keeps its number 1 by standing first. No kind begins after a
# letter: said once in front, it spares all alternatives inside words.
PATTERN = r"(?<!\p{L})(?:" + "|".join([CARD, *(p for k, p in KINDS if k != "card")]) + ")"
DIGIT_KINDS = ("card", "ssn", "phone")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def entities(text: Column) -> Column:
    """All entities of a text, in order."""
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def kind_of(value: Column) -> Column:
    out = None
    for kind, pattern in KINDS:
        whole = value.rlike("^(?:" + pattern + ")$")
        out = F.when(whole, F.lit(kind)) if out is None else out.when(whole, F.lit(kind))
    return out.otherwise(F.lit("name"))


def _title(value: Column) -> Column:
    return F.regexp_extract(value, r"^(\S+?)\.? ", 1)


def parts_of(kind: Column, value: Column) -> Column:
    """The parts of an entity: (kind of part, canonical form)."""
    gender = F.when(_title(value).isin(*FEMALE_TITLES), F.lit("f")).when(_title(value).isin(*OTHER_TITLES), F.lit("x")).otherwise(F.lit("m"))
    words = F.slice(F.split(value, " "), F.lit(2), F.size(F.split(value, " ")) - 1)
    name = F.transform(words, lambda w, i: F.struct(
        F.when(i == F.size(words) - 1, F.lit("surname")).otherwise(F.concat(F.lit("given_"), gender)).alias("part_kind"),
        F.lower(w).alias("canon")))
    canon = (F.when(kind.isin(*DIGIT_KINDS), _digits(value)).when(kind == "iban", F.regexp_replace(value, " ", ""))
             .when(kind == "ip6", F.lower(value)).otherwise(value))
    # a phone number's country code, or the zero of a national one, is part of its kind: surrogates keep it
    code = F.regexp_extract(value, r"^\+([0-9]{1,3})[ .(-]", 1)
    code = F.when(value.startswith("0"), F.lit("0")).otherwise(code)
    # local parts are told apart within their host
    local, host = F.lower(F.substring_index(value, "@", 1)), F.lower(F.substring_index(value, "@", -1))
    address = F.array(F.struct(F.concat(F.lit("email@"), host).alias("part_kind"), local.alias("canon")),
                      F.struct(F.lit("host").alias("part_kind"), host.alias("canon")))
    single = F.array(F.struct(F.when((kind == "phone") & (code != ""), F.concat(F.lit("phone+"), code)).otherwise(kind)
                              .alias("part_kind"), canon.alias("canon")))
    return F.when(kind == "name", name).when(kind == "email", address).otherwise(single)


def _check_digit(digits: Column) -> Column:
    """The digit that makes a card number valid, from the digits before it."""
    reverse = F.reverse(F.filter(F.split(digits, ""), lambda c: c != ""))
    terms = F.transform(reverse, lambda c, i: F.when(i % 2 == 0, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9)
                                                     .otherwise(c.cast("int") * 2)).otherwise(c.cast("int")))
    return F.pmod(-F.aggregate(terms, F.lit(0), lambda a, t: a + t), F.lit(10)).cast("string")


def _mod97(chars: Column) -> Column:
    """Remainder modulo 97 of an account number written in digits and letters (A = 10)."""
    def step(rest, c):
        value = F.ascii(c)
        return F.when(value < 58, (rest * 10 + value - 48) % 97).otherwise((rest * 100 + value - 55) % 97)

    return F.aggregate(F.filter(F.split(chars, ""), lambda c: c != ""), F.lit(0), step)


def _stream(key: str, kind: Column, canon: Column, attempt: int) -> Column:
    """Hexadecimal characters keyed by (key, kind, canonical form, attempt); as many as the form could need."""
    def block(i):
        return F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, F.lit(str(attempt)), i.cast("string")), 256)

    return F.array_join(F.transform(F.sequence(F.lit(0), F.floor(F.length(canon) / 32).cast("int")), block), "")


def surrogate(key: str, kind: Column, canon: Column, attempt: int) -> Column:
    """The surrogate of a part, in canonical form."""
    stream = _stream(key, kind, canon, attempt)
    longer = max(0, attempt - LONGER_FROM + 1)
    numbers = F.translate(stream, "abcdef", "012345")
    n = F.length(canon)

    body = F.concat(F.substring(canon, 1, 1), F.substr(numbers, F.lit(1), n - 2))
    check = _check_digit(body)
    holds = _check_digit(F.substr(canon, F.lit(1), n - 1)) == F.substr(canon, n, F.lit(1))
    wrong = F.pmod(check.cast("int") + 1 + F.pmod(F.conv(F.substring(stream, 60, 4), 16, 10).cast("int"), F.lit(9)), F.lit(10))
    card = F.concat(body, F.when(holds, check).otherwise(wrong.cast("string")))

    country = F.substring(canon, 1, 2)
    account = F.array_join(F.transform(F.split(F.substr(canon, F.lit(5), n - 4), ""), lambda c, i: F.when(
        c.rlike("[0-9]"), F.substr(numbers, i + 1, F.lit(1))).when(c.rlike("[A-Z]"), F.upper(F.translate(
            F.substr(stream, i + 1, F.lit(1)), "0123456789", "ghjkmnpqrs"))).otherwise(c)), "")
    iban = F.concat(country, F.lpad((98 - _mod97(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0"), account)

    code = F.regexp_extract(kind, r"\+([0-9]+)$", 1)
    rest = n - F.length(code)
    phone = F.concat(code, (F.conv(F.substring(stream, 50, 2), 16, 10).cast("int") % 8 + 2).cast("string"),
                     F.substr(numbers, F.lit(1), rest - 1))
    if not longer:  # exchange 555 holds no real subscribers; a number in it stays there while there is room
        phone = F.when((rest == 10) & (F.substr(canon, F.length(code) + 4, F.lit(3)) == "555"), F.concat(
            F.substr(phone, F.lit(1), F.length(code) + 3), F.lit("555"), F.substr(phone, n - 3, F.lit(4)))).otherwise(phone)
    wider = longer > 6
    ssn = F.concat(F.substring(numbers, 20, 1) if wider else F.lit("9"), F.substring(numbers, 1, 8))  # from 900 on none are issued

    def octet(i):
        return (F.conv(F.substring(stream, 2 * i + 1, 2), 16, 10).cast("int") % 254 + 1).cast("string")

    small = canon.rlike(r"^(?:192\.168|172\.(?:1[6-9]|2[0-9]|3[01]))\.")
    if wider:  # 240 to 254
        first = F.when(small | canon.startswith("10."), (F.pmod(octet(0).cast("int"), F.lit(15)) + 240).cast("string")).otherwise(octet(0))
        second = octet(1)
    elif longer:
        first, second = F.when(small | canon.startswith("10."), F.lit("10")).otherwise(octet(0)), octet(1)
    else:
        first = F.when(small | canon.startswith("10."), F.substring_index(canon, ".", 1)).otherwise(octet(0))
        second = F.when(canon.startswith("192.168."), F.lit("168")).when(
            small, (F.pmod(octet(1).cast("int"), F.lit(16)) + 16).cast("string")).otherwise(octet(1))
    ip = F.concat_ws(".", first, second, octet(2), octet(3))
    ip6 = F.concat_ws(":", F.lit("2001:db8"), *(F.substring(stream, 4 * i + 1, 4) for i in range(6)))

    def shaped(c, i):
        at = F.substr(stream, i + 1, F.lit(1))
        letter = F.translate(at, "0123456789abcdef", "bcdfghklmnprstvz")
        cyrillic = F.translate(at, "0123456789abcdef", "бвгдзклмнпрстфхц")
        return (F.when(c.rlike("[0-9]"), F.translate(at, "abcdef", "012345")).when(c.rlike(r"\p{IsCyrillic}"), cyrillic)
                .when(c.rlike(r"\p{L}"), letter).otherwise(c))

    shape = lambda s: F.array_join(F.transform(F.filter(F.split(s, ""), lambda c: c != ""), shaped), "")
    extra = F.substring(numbers, 30, longer) if longer else F.lit("")
    top = F.regexp_extract(canon, r"(\.[^.]+)$", 1)
    host = F.concat(shape(F.substr(canon, F.lit(1), n - F.length(top))), extra, top)
    local = F.concat(shape(canon), extra)

    def syllables(of):
        picks = [F.element_at(F.array(*(F.lit(s) for s in of)),
                              F.conv(F.substring(stream, 3 * i + 1, 3), 16, 10).cast("int") % len(of) + 1)
                 for i in range(3 + longer)]
        ending = F.when(kind == "given_f", F.lit("na" if of is LATIN else "на")).when(
            kind == "given_m", F.lit("n" if of is LATIN else "н")).when(
            kind == "given_x", F.lit("l" if of is LATIN else "л")).otherwise(F.lit("r" if of is LATIN else "р"))
        return F.concat(*picks, ending)

    name = F.when(canon.rlike(r"\p{IsCyrillic}"), syllables(CYRILLIC)).otherwise(syllables(LATIN))
    return (F.when(kind.startswith("email@"), local).when(kind == "host", host).when(kind == "ip", ip).when(kind == "ip6", ip6).when(kind == "card", card).when(kind == "iban", iban)
            .when(kind == "ssn", ssn).when(kind.startswith("phone"), phone).otherwise(name))


def assign(parts: DataFrame, key: str) -> DataFrame:
    """``parts`` (part_kind, canon), distinct: adds ``surrogate``, different for different parts of a kind and
    never an original of its kind."""
    originals = parts.select("part_kind", F.col("canon").alias("new"))
    given, pending = None, parts
    for attempt in range(MAX_ROUNDS):
        tried = pending.withColumn("new", surrogate(key, F.col("part_kind"), F.col("canon"), attempt))
        free = tried.join(originals, ["part_kind", "new"], "left_anti")
        if given is not None:
            free = free.join(given.select("part_kind", "new"), ["part_kind", "new"], "left_anti")
        won = stored(free.groupBy("part_kind", "new").agg(F.min("canon").alias("canon"))
                     .select("part_kind", "canon", "new"), "surrogates")
        given = won if given is None else given.union(won)
        pending = stored(pending.join(won, ["part_kind", "canon"], "left_anti"), "surrogates-pending")
        if pending.isEmpty():
            return given.withColumnRenamed("new", "surrogate")
    raise RuntimeError("surrogates still collide")


def _format(kind: Column, value: Column, news: Column) -> Column:
    """The surrogate parts in the format of the original."""
    new = F.element_at(news, 1)
    chars = F.filter(F.split(value, ""), lambda c: c != "")
    joined = F.transform(chars, lambda c, i: F.struct(
        c.alias("c"), F.size(F.filter(F.slice(chars, F.lit(1), i), lambda x: x.rlike("[0-9A-Z]"))).alias("k")))
    in_place = F.array_join(F.transform(joined, lambda x: F.when(x["c"].rlike("[0-9A-Z]"), F.substr(new, x["k"] + 1, F.lit(1)))
                                        .otherwise(x["c"])), "")
    words = F.split(value, " ")
    name = F.concat_ws(" ", F.element_at(words, 1), F.transform(news, lambda w: F.initcap(w)))
    address = F.concat_ws("@", new, F.element_at(news, F.size(news)))
    upper = (F.upper(value) == value) & (F.lower(value) != value)
    return (F.when(kind == "name", name).when(kind == "email", F.when(upper, F.upper(address)).otherwise(address))
            .when(kind == "ip", new).when(kind == "ip6", F.when(upper, F.upper(new)).otherwise(new)).otherwise(in_place))


def replace_entities(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, with surrogates in ``text_col``."""
    names, text = docs.columns, F.col(text_col).cast("string")
    row_id, row_hash = F.coalesce(F.col(id_col).cast("long"), F.lit(ABSENT_ID)), F.xxhash64(text)
    found = docs.select(row_id.alias("id"), row_hash.alias("th"), entities(text).alias("values")).where(F.size("values") > 0)
    found = stored(found.dropDuplicates(["id", "th"]).select("id", "th", F.posexplode("values").alias("at", "value")), "entities")
    values = found.select("value").distinct().withColumn("kind", kind_of(F.col("value")))
    split = values.select("kind", "value", F.posexplode(parts_of(F.col("kind"), F.col("value"))).alias("i", "part")).select(
        "kind", "value", "i", "part.part_kind", "part.canon")
    split = stored(split, "entity-parts")
    given = assign(stored(split.select("part_kind", "canon").distinct(), "parts"), key)
    ready = split.join(given, ["part_kind", "canon"]).groupBy("kind", "value").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "surrogate"))), lambda s: s["surrogate"]).alias("news"))
    ready = stored(ready.select("value", _format(F.col("kind"), F.col("value"), F.col("news")).alias("new")), "replacements")
    of_doc = found.join(ready, "value").groupBy("id", "th").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "new"))), lambda x: x["new"]).alias("news"))

    rows = docs.select(F.struct(*names).alias("row"), row_id.alias("id"), row_hash.alias("th"))
    old = F.col(f"row.`{text_col}`")
    between = F.transform(F.split(old.cast("string"), PATTERN, -1), lambda b, i: F.concat(b, F.coalesce(F.get(F.col("news"), i), F.lit(""))))
    clean = F.when(F.col("news").isNull(), old).otherwise(F.array_join(between, ""))
    return rows.join(of_doc, ["id", "th"], "left").select(
        *((clean if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in names))
