"""Format-preserving pseudonyms for personal numbers, dates and addresses, in Spark expressions only.

A match of one pattern is first validated (check digits, ranges, calendar); only valid values change. Their
digits run through a keyed Feistel network over the value's own format, a bijection, so equal values have equal
pseudonyms in every document and different values different ones. What carries a check digit gets a right one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rounds of the network. Eight suffice for values of a few digits.
ROUNDS = 8
#: Turns of a cycle walk; three in five dates are after the 12th, so not one walk in 10**25 is longer.
LONGEST_WALK = 64
_EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*\.[A-Za-z]{2,24}(?![A-Za-z0-9])"
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
_SECRET = r"(?<![A-Za-z0-9])[0-9a-f]{32,64}(?![A-Za-z0-9])"
_IP = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
_ISO = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])"
_DMY = r"(?<![0-9./])[0-9]{2}[./][0-9]{2}[./][0-9]{4}(?![0-9]|[./][0-9])"
_SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_CARD = r"(?<![A-Za-z0-9.+-])[0-9](?:[ -]?[0-9]){12,18}(?![A-Za-z0-9])"
_PHONE = r"(?<![A-Za-z0-9])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])|(?<![A-Za-z0-9])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])|(?<![A-Za-z0-9.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9.-])"
#: Earlier ones are tried first where several start at one place.
PATTERN = "|".join([_EMAIL, _IBAN, _SECRET, _IP, _ISO, _DMY, _SSN, _CARD, _PHONE])
#: A text without these characters has no match.
_HINT = r"[0-9@]"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _round_value(key: str, tag: Column | str, i: Column, half: Column) -> Column:
    """48 keyed bits of one half."""
    tag = F.lit(tag) if isinstance(tag, str) else tag
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), tag, i.cast("string"), half.cast("string")), 256), 1, 12), 16, 10).cast("long")


def _feistel(left: Column, right: Column, m: Column, n: Column, key: str, tag: Column | str) -> Column:
    """A struct (l, r): the pair in [0, m) x [0, n) after alternate keyed additions, a bijection."""
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def step(a: Column, i: Column) -> Column:
        even = i % 2 == 0
        other = F.when(even, a["r"]).otherwise(a["l"])
        f = _round_value(key, tag, i, other)
        return F.struct(F.when(even, (a["l"] + f) % m).otherwise(a["l"]).alias("l"), F.when(even, a["r"]).otherwise((a["r"] + f) % n).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def permute_digits(d: Column, key: str, tag: str) -> Column:
    """A string of 2 to 36 digits to one of as many digits."""
    size = F.char_length(d)
    half = F.floor(size / 2).cast("int")
    left, right = F.substr(d, F.lit(1), half), F.substr(d, half + 1)
    p = lambda n: F.pow(F.lit(10.0), n).cast("long")
    out = _feistel(left, right, p(half), p(size - half), key, F.concat_ws(":", F.lit(tag), size.cast("string")))
    return F.transform(F.array(out), lambda x: F.concat(F.lpad(x["l"].cast("string"), half, "0"), F.lpad(x["r"].cast("string"), size - half, "0")))[0]


def _refill(shape: Column, digits: Column) -> Column:
    """The shape with its digits, in order, replaced; other characters stay."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(a: Column, c: Column) -> Column:
        is_digit = c.rlike("^[0-9]$")
        return F.struct(F.concat(a["out"], F.when(is_digit, F.substr(digits, a["at"], F.lit(1))).otherwise(c)).alias("out"), (a["at"] + is_digit.cast("int")).alias("at"))

    return F.aggregate(F.split(shape, ""), start, step, lambda a: a["out"])


def _luhn(d: Column) -> Column:
    """The Luhn sum, modulo 10, of a digit string that ends in its check digit."""
    parts = F.transform(F.split(F.reverse(d), ""), lambda c, i: F.when(c == "", 0).when(i % 2 == 0, c.try_cast("int")).otherwise(F.get(F.array(*(F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), c.try_cast("int"))))
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x) % 10


def _mod97(s: Column) -> Column:
    """Of letters (A is 10) and digits read as one number."""
    letters = F.filter(F.split(s, ""), lambda c: c != "")
    return F.aggregate(letters, F.lit(0), lambda a, c: F.when(c.rlike("^[0-9]$"), (a * 10 + c.try_cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


def _card(m: Column, key: str) -> Column:
    d = _digits(m)
    body = permute_digits(F.substr(d, F.lit(1), F.char_length(d) - 1), key, "card")
    whole = F.transform(F.array(body), lambda b: F.concat(b, F.pmod(10 - _luhn(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))[0]
    return F.when((_luhn(d) == 0) & (F.regexp_replace(d, "0", "") != ""), _refill(m, whole)).otherwise(m)


def _iban(m: Column, key: str) -> Column:
    s = F.regexp_replace(m, " ", "")
    body, country = F.substr(s, F.lit(5)), F.substring(s, 1, 2)
    digits = _digits(body)
    fresh = _refill(body, permute_digits(digits, key, "iban"))
    checked = F.transform(F.array(fresh), lambda b: F.concat(F.lpad((98 - _mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0"), b))[0]
    valid = (_mod97(F.concat(body, F.substring(s, 1, 4))) == 1) & (F.char_length(digits) >= 2)
    # two check digits, then the body, refilled into the match's own spacing
    spaced = F.aggregate(F.split(m, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), lambda a, c: F.struct(F.concat(a["out"], F.when(c == " ", c).otherwise(F.substr(F.concat(country, checked), a["at"], F.lit(1)))).alias("out"), (a["at"] + (c != " ").cast("int")).alias("at")), lambda a: a["out"])
    return F.when(valid, spaced).otherwise(m)


def _ip(m: Column, key: str) -> Column:
    o = F.transform(F.split(m, r"\."), lambda c: c.try_cast("int"))
    out = _feistel(F.get(o, F.lit(0)) * 256 + F.get(o, F.lit(1)), F.get(o, F.lit(2)) * 256 + F.get(o, F.lit(3)), F.lit(65536), F.lit(65536), key, "ip")
    text = F.transform(F.array(out), lambda x: F.concat_ws(".", *(F.floor(v).cast("string") for v in (x["l"] / 256, x["l"] % 256, x["r"] / 256, x["r"] % 256))))[0]
    return F.when(F.forall(o, lambda x: x <= 255), text).otherwise(m)


def _turned_day(at: Column, key: str) -> Column:
    """Days of a 400-year calendar cycle (146097 = 189 x 773 of them, 1800 to 2199) permuted among themselves."""
    out = _feistel(F.floor(at / 773), at % 773, F.lit(189), F.lit(773), key, "date")
    return F.transform(F.array(out), lambda x: x["l"] * 773 + x["r"])[0]


def _day(at: Column) -> Column:
    return F.date_add(F.lit("1800-01-01").cast("date"), at.cast("int"))


def _date(m: Column, key: str, java_format: str, late: bool = False) -> Column:
    """The date's pseudonym in its own format. ``late``: dates after the 12th of a month stay such, by turning again until one is (a
    cycle walk, still a bijection), so that a text read month first never becomes one that is read day first."""
    day = F.to_date(F.try_to_timestamp(m, F.lit(java_format)))
    at = F.datediff(day, F.lit("1800-01-01").cast("date")).cast("long")
    fresh = _turned_day(at, key)
    if late:
        fresh = F.aggregate(F.sequence(F.lit(1), F.lit(LONGEST_WALK)), fresh, lambda x, _: F.when(F.dayofmonth(_day(x)) > 12, x).otherwise(_turned_day(x, key)))
    return F.when(day.isNotNull() & at.between(0, 146096), F.date_format(_day(fresh), java_format)).otherwise(m)


def _chained(m: Column, key: str, tag: str) -> Column:
    """Eight hexadecimal digits after the other, each under a key of all that came out before: invertible from the front."""
    n = F.char_length(m)
    parts = F.transform(F.sequence(F.lit(1), F.floor((n + 7) / 8).cast("int")), lambda i: F.substr(m, (i - 1) * 8 + 1, F.lit(8)))

    def turn(before: Column, part: Column) -> Column:
        size = F.char_length(part)
        half = F.floor(size / 2).cast("int")
        p = lambda k: F.pow(F.lit(16.0), k).cast("long")
        num = lambda s: F.coalesce(F.conv(s, 16, 10).cast("long"), F.lit(0))
        out = _feistel(num(F.substr(part, F.lit(1), half)), num(F.substr(part, half + 1)), p(half), p(size - half), key, F.concat_ws(":", F.lit(tag), n.cast("string"), before))
        return F.transform(F.array(out), lambda x: F.concat(before, F.lpad(F.lower(F.hex(x["l"])), half, "0"), F.lpad(F.lower(F.hex(x["r"])), size - half, "0")))[0]

    return F.aggregate(parts, F.lit(""), turn)


def _secret(m: Column, key: str) -> Column:
    """Chained from the front and then from the end, so that every digit depends on every other: a bijection of the whole."""
    front = _chained(m, key, "hex")
    whole = F.transform(F.array(front), lambda x: F.reverse(_chained(F.reverse(x), key, "xeh")))[0]
    return F.when(m.rlike("[0-9]") & m.rlike("[a-f]"), whole).otherwise(m)


def _phone(m: Column, key: str) -> Column:
    """The country's prefix stays, the rest is permuted."""
    prefix = F.regexp_extract(m, r"^\+[0-9]{1,3}(?=[ .(-])", 0)
    rest = F.substr(m, F.char_length(prefix) + 1)
    d = _digits(rest)
    return F.when(F.char_length(_digits(m)).between(7, 15) & (F.char_length(d) >= 4), F.concat(prefix, _refill(rest, permute_digits(d, key, "phone")))).otherwise(m)


def _ssn(m: Column, key: str) -> Column:
    """Valid numbers have an area of 001 to 899 but 666, a group from 01 and a serial number from 0001; they are permuted among themselves."""
    area, group, serial = (F.substr(m, F.lit(i), F.lit(n)).try_cast("long") for i, n in ((1, 3), (5, 2), (8, 4)))
    at = area - 1 - (area > 666).cast("long")
    out = _feistel(at * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key, "ssn")

    def text(x: Column) -> Column:
        a = F.floor(x["l"] / 99) + 1
        pad = lambda v, n: F.lpad(v.cast("string"), n, "0")
        return F.concat_ws("-", pad(a + (a >= 666).cast("long"), 3), pad(x["l"] % 99 + 1, 2), pad(x["r"] + 1, 4))

    return F.when(~m.rlike("^(000|666|9..)|-00-|-0000$"), F.transform(F.array(out), text)[0]).otherwise(m)


def _email(m: Column, key: str) -> Column:
    """The name becomes a keyed digest of the whole address; the host stays."""
    return F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m)), 256), 1, 20), F.regexp_extract(m, "@.*$", 0))


def pseudonym(m: Column, key: str) -> Column:
    """Of one match of :data:`PATTERN`; the match itself if it is not valid."""
    whole = lambda p: m.rlike(f"^(?:{p})$")
    return (
        F.when(F.contains(m, F.lit("@")), _email(m, key))
        .when(m.rlike("^[A-Z]{2}"), _iban(m, key))
        .when(whole("[0-9a-f]{32,64}"), _secret(m, key))
        .when(whole(r"[0-9]{1,3}(\.[0-9]{1,3}){3}"), _ip(m, key))
        .when(whole("[0-9]{4}-[0-9]{2}-[0-9]{2}"), _date(m, key, "yyyy-MM-dd"))
        .when(whole(r"[0-9]{2}\.[0-9]{2}\.[0-9]{4}"), _date(m, key, "dd.MM.yyyy"))
        .when(whole("[0-9]{2}/[0-9]{2}/[0-9]{4}"), F.when(F.try_to_timestamp(m, F.lit("dd/MM/yyyy")).isNotNull(), _date(m, key, "dd/MM/yyyy")).otherwise(_date(m, key, "MM/dd/yyyy", late=True)))
        .when(whole("[0-9]{3}-[0-9]{2}-[0-9]{4}"), _ssn(m, key))
        .when(m.rlike(r"^[0-9]") & F.char_length(_digits(m)).between(13, 19), _card(m, key))
        .otherwise(_phone(m, key))
    )


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, text with pseudonyms, n_replaced.

    Validated: payment cards (Luhn), IBANs (mod 97), IPv4 addresses, social security numbers, telephone numbers of 7 to 15
    digits, calendar dates of 1800 to 2199 (yyyy-MM-dd, dd.MM.yyyy, dd/MM/yyyy, else MM/dd/yyyy), hexadecimal secrets of 32 to 64
    digits, e-mail addresses. What fails validation stays as it is.

    Null text stays null, with 0 replaced; a null doc_id stays null. Repeated rows come back as often as they came. Other columns are not read.
    """
    text = F.col("text").cast("string")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    hit = F.col("text").rlike(_HINT)
    base = base.withColumn("found", F.when(hit, F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))))
    base = base.withColumn("fresh", F.when(F.size("found") > 0, F.transform("found", lambda m: pseudonym(m, key))))
    gaps = F.split("text", PATTERN, -1)
    whole = F.array_join(F.zip_with(gaps, "fresh", lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "")
    changed = F.size(F.filter(F.arrays_zip("found", "fresh"), lambda x: x["found"] != x["fresh"]))
    return base.select(
        "doc_id", F.when(F.col("fresh").isNull(), F.col("text")).otherwise(whole).alias("text"), F.when(F.col("fresh").isNull(), 0).otherwise(changed).cast("long").alias("n_replaced")
    )
