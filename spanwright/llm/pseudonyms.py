"""Personal data: format-preserving pseudonyms by a keyed Feistel network.

Validated numbers and dates are permuted within their own format, so equal
values get equal pseudonyms in every document, different ones different
pseudonyms, and a pseudonym passes the validation that its original passed:

========  ==============================================  =====================
kind      validated by                                    permuted
========  ==============================================  =====================
card      13 to 19 digits with a right check digit        all but the check digit
phone     see below                                       the national digits
ip        four numbers of 0 to 255                        all 32 bits
ssn       area, group and serial in use                   the numbers in use
date      a real day of 1900-01-01 to 2100-02-01          the day within these
email     its form                                        see below
========  ==============================================  =====================

A Feistel network adds a keyed hash of one half to the other, in turns, modulo
the sizes of the halves.  Each half's domain has exactly the size needed, so
the network is a permutation of the valid values without any search.

A date is read day first if that is a real day, else month first.  Days that
can only be read month first are permuted among themselves, so that no two
dates of different texts meet; the day of one that is also written another way
isn't linked to it.  A field of one digit stays without a leading zero.  A time
may follow (``2024-02-29T10:00``).

A phone is one of three forms.  Ten national digits with separators: numbers
that the North American plan can assign are permuted among these, others among
the others.  Ten or eleven bare digits, only if that plan can assign them.  A
plus sign, an assigned country code and 8 to 15 digits in all: the code and
leading zeros stay, the other digits are permuted.

Addresses with leading zeros keep the width of their parts.  Four numbers of one
or two digits after a word for a version are no address, nor is any part of a
longer row of numbers.

Left out, and so left in clear: IPv6 addresses, two-digit years, months in
words, cards in other groups than 4-4-4-1..7 and 4-6-4 or 5, phones of other
plans without a plus sign.

An e-mail address is neither number nor date: its local part is replaced by a
keyed 12-digit number and its domain by a reserved one.  This keeps links, but
two addresses may meet by chance, about once in 10**12 pairs.

The text is split at the matches of one pattern and joined again with the
pseudonyms, all by built-in functions.  The pattern repeats no group but a
possessive one, so its time and stack don't grow with the length of a match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
KINDS = ("email", "date", "ip", "card", "phone", "ssn")
EMAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
ISO_DATE = r"\d{4}-\d{2}-\d{2}"
YEAR_DATE = r"\d{4}/\d{1,2}/\d{1,2}"
DAY_DATE = r"\d{1,2}[./]\d{1,2}[./]\d{4}"
DATE = f"{ISO_DATE}|{YEAR_DATE}|{DAY_DATE}"
IP = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
CARD = r"\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{4,5}|\d{13,19}"
#: Ten national digits with separators, and what may stand before them.
LOCAL = r"\d{3}[ .-]\d{3}[ .-]\d{4}"
PHONE = r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}"
BARE = r"1?[2-9]\d{2}[2-9]\d{6}"
ABROAD = r"\+[1-9]\d{0,2}(?:[ .-]?\(0\))?(?:[ .-]?\(?\d{2,4}\)?){2,5}"
SSN = r"\d{3}-\d{2}-\d{4}"
#: The country codes of ITU-T E.164.
COUNTRIES = (
    r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|21[12368]|2[2-6]\d|29[01789]|35\d|37\d|38[0-35-79]|42[013]"
    r"|50\d|59\d|67[02-9]|68[0-35-9]|69[0-2]|80[08]|85[02356]|87\d|88[0-36]|96[0-8]|97[0-79]|99[2-68]"
)
#: Ten digits that the North American plan can assign: no area or exchange starts with 0 or 1, or is N11.
ASSIGNABLE = r"^[2-9](?!11)\d{2}[2-9](?!11)\d{6}$"
_START, _END = r"(?<![\p{L}\d])", r"(?![\p{L}\d])"
#: Not after a word for a version, unless some number has three digits.
_VERSION = r"(?:(?<!\b(?i:version|release|firmware|build|v)[ .:=#]{1,2})|(?=(?:\d{1,2}\.){0,3}\d{3}))"
#: Leftmost match, first alternative; never within a longer number or word.
#: A plus sign may precede a phone number only as its own.
PATTERN = (
    rf"(?<![A-Za-z0-9._%+-]){EMAIL}"
    rf"|{_START}(?=\d)(?:(?:{DATE})(?:{_END}|(?=[Tt]\d\d:?\d\d))|(?=\d{{1,3}}\.)(?<!\d\.){_VERSION}{IP}(?!\.\d){_END}|(?:{CARD}|{SSN}|{LOCAL}|{BARE}){_END})"
    rf"|{_START}(?=[+(])(?:{PHONE}|{ABROAD}){_END}"
)
FIRST_DAY, DAYS_A, DAYS_B = "1900-01-01", 261, 280
#: Of the 2401 months of these days, the days from the 13th on.
LATE_A, LATE_B, EARLY = 204, 217, 12
#: Of the three-digit codes, those that can be assigned, and the others.
CODES, NO_CODES = 792, 208


def _draw(key: str, kind: str, turn: Column, half: Column, size: Column) -> Column:
    """A keyed number below ``size``, from 60 bits of SHA-256."""
    text = F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), size.cast("string"), half.cast("string"))
    return F.pmod(F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long"), size)


def feistel(a: Column, b: Column, size_a: Column, size_b: Column, key: str, kind: str, rounds: int = ROUNDS) -> Column:
    """struct(a, b): a keyed permutation of the pairs with a < size_a, b < size_b."""

    def turn(pair: Column, i: Column) -> Column:
        odd = i % 2 == 1
        new_a = F.pmod(pair["a"] + _draw(key, kind, i, pair["b"], size_a), size_a)
        new_b = F.pmod(pair["b"] + _draw(key, kind, i, pair["a"], size_b), size_b)
        return F.struct(F.when(odd, new_a).otherwise(pair["a"]).alias("a"), F.when(odd, pair["b"]).otherwise(new_b).alias("b"))

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, turn)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """A keyed permutation of the strings of as many digits (2 to 36)."""
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")
    pair = feistel(
        F.substring(digits, F.lit(1), left).cast("long"),
        F.substring(digits, left + 1, n).cast("long"),
        _power(left),
        _power(n - left),
        key,
        kind,
    )
    return F.transform(F.array(pair), lambda p: F.concat(F.lpad(p["a"].cast("string"), left, "0"), F.lpad(p["b"].cast("string"), n - left, "0")))[0]


def _filled(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced by ``digits``, in order."""

    def place(i: Column) -> Column:
        here = F.substring(form, i, F.lit(1))
        number = F.length(_digits(F.substring(form, F.lit(1), i)))
        return F.when(here.rlike("[0-9]"), F.substring(digits, number, F.lit(1))).otherwise(here)

    return F.concat_ws("", F.transform(F.sequence(F.lit(1), F.length(form)), place))


def _card(value: Column, key: str) -> Column:
    digits = _digits(value)
    payload = permuted_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
    checked = F.transform(
        F.array(payload),
        lambda p: F.element_at(F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda c: F.concat(p, c.cast("string"))), lambda s: F.call_function("luhn_check", s)), 1),
    )[0]
    return _filled(value, checked)


def _place(code: Column) -> Column:
    """The number of an assignable code (200 to 999 but N11) among these."""
    above = code - 200
    return above - F.floor(above / 100) - F.when(above % 100 > 11, 1).otherwise(0)


def _code(place: Column) -> Column:
    rest = place % 99
    return 200 + F.floor(place / 99) * 100 + rest + F.when(rest >= 11, 1).otherwise(0)


def _other_place(code: Column) -> Column:
    """The number of a code that can't be assigned (0 to 199 and N11) among these."""
    return F.when(code < 200, code).otherwise(198 + F.floor(code / 100))


def _other_code(place: Column) -> Column:
    return F.when(place < 200, place).otherwise((place - 198) * 100 + 11)


def _national(digits: Column, key: str) -> Column:
    """Ten digits: assignable ones permuted among these, others among the others."""
    area, exchange, line = (F.substring(digits, *at).cast("long") for at in ((1, 3), (4, 3), (7, 4)))
    lines = F.lit(10_000).cast("long")
    three = lambda code: F.lpad(code.cast("long").cast("string"), 3, "0")
    four = lambda pair: F.lpad(pair["b"].cast("string"), 4, "0")
    good = feistel(_place(area) * CODES + _place(exchange), line, F.lit(CODES * CODES).cast("long"), lines, key, "phone")
    good = F.transform(F.array(good), lambda p: F.concat(three(_code(F.floor(p["a"] / CODES))), three(_code(p["a"] % CODES)), four(p)))[0]
    # First the numbers of other areas, then those of other exchanges.
    areas = NO_CODES * 1000
    number = F.when(area.between(200, 999) & (area % 100 != 11), areas + _place(area) * NO_CODES + _other_place(exchange)).otherwise(_other_place(area) * 1000 + exchange)
    rest = feistel(number, line, F.lit(areas + CODES * NO_CODES).cast("long"), lines, key, "other phone")
    rest = F.transform(
        F.array(rest),
        lambda p: F.when(p["a"] < areas, F.concat(three(_other_code(F.floor(p["a"] / 1000))), three(p["a"] % 1000), four(p))).otherwise(
            F.concat(three(_code(F.floor((p["a"] - areas) / NO_CODES))), three(_other_code((p["a"] - areas) % NO_CODES)), four(p))
        ),
    )[0]
    return F.when(digits.rlike(ASSIGNABLE), good).otherwise(rest)


def _abroad(digits: Column, key: str) -> Column:
    """Digits from the country code on; the code and zeros after it stay."""
    kept = F.regexp_extract(digits, rf"^(?:{COUNTRIES})0*", 0)
    rest = F.substring(digits, F.length(kept) + 1, F.length(digits))
    n = F.length(rest)
    left = F.floor(n / 2).cast("int")
    least = F.when(left > 0, _power(left - 1)).otherwise(F.lit(0).cast("long"))
    pair = feistel(F.substring(rest, F.lit(1), left).cast("long") - least, F.substring(rest, left + 1, n).cast("long"), 9 * least, _power(n - left), key, "phone abroad")
    return F.transform(F.array(pair), lambda p: F.concat(kept, (p["a"] + least).cast("string"), F.lpad(p["b"].cast("string"), n - left, "0")))[0]


def _phone(value: Column, key: str) -> Column:
    digits = _digits(value)
    prefix = F.substring(digits, F.lit(1), F.length(digits) - 10)
    local = F.concat(prefix, _national(F.right(digits, F.lit(10)), key))
    return _filled(value, F.when(_is_local(value), local).otherwise(_abroad(digits, key)))


def _is_local(value: Column) -> Column:
    """Whether a phone is read by its last ten digits."""
    return value.rlike(rf"^(?:{PHONE}|{BARE})$") | (value.startswith("+1") & (F.length(_digits(value)) == 11))


def _is_phone(value: Column) -> Column:
    digits = _digits(value)
    own = F.right(digits, F.lit(10)).rlike(ASSIGNABLE)
    known = digits.rlike(rf"^(?:{COUNTRIES})0{{0,2}}[1-9]\d{{3,}}$") & F.length(digits).between(8, 15)
    return F.when(value.rlike(f"^(?:{PHONE})$"), F.lit(True)).when(_is_local(value), own).otherwise(value.startswith("+") & ~value.startswith("+1") & known)


def _ip(value: Column, key: str) -> Column:
    part = F.split(value, r"\.")
    pair = feistel(
        part[0].cast("long") * 256 + part[1].cast("long"),
        part[2].cast("long") * 256 + part[3].cast("long"),
        F.lit(65536).cast("long"),
        F.lit(65536).cast("long"),
        key,
        "ip",
    )
    filled = value.rlike(r"(?:^|\.)0\d")

    def text(p: Column) -> Column:
        numbers = [c.cast("string") for c in (F.shiftright(p["a"], 8), p["a"] % 256, F.shiftright(p["b"], 8), p["b"] % 256)]
        return F.concat_ws(".", *(F.when(filled, F.lpad(n, F.greatest(F.length(n), F.length(part[i])), "0")).otherwise(n) for i, n in enumerate(numbers)))

    return F.transform(F.array(pair), text)[0]


def _ssn(value: Column, key: str) -> Column:
    part = F.split(value, "-")
    area, group, serial = (part[i].cast("long") for i in range(3))
    # Areas 1 to 899 but 666 are numbered 0 to 897; group 1 to 99; serial 1 to 9999.
    pair = feistel(
        area - F.when(area > 666, 2).otherwise(1),
        (group - 1) * 9999 + serial - 1,
        F.lit(898).cast("long"),
        F.lit(99 * 9999).cast("long"),
        key,
        "ssn",
    )

    def text(p: Column) -> Column:
        area = p["a"] + F.when(p["a"] >= 665, 2).otherwise(1)
        return F.concat_ws("-", F.lpad(area.cast("string"), 3, "0"), F.lpad((F.floor(p["b"] / 9999) + 1).cast("string"), 2, "0"), F.lpad((p["b"] % 9999 + 1).cast("string"), 4, "0"))

    return F.transform(F.array(pair), text)[0]


def _days(year: Column, month: Column, day: Column) -> Column:
    """Days since FIRST_DAY; null if it is no day of the calendar."""
    iso = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return F.datediff(iso.try_cast("date"), F.lit(FIRST_DAY).cast("date"))


def _ordinal(value: Column) -> Column:
    """Days since FIRST_DAY of a date, year or day first; null if it is no day."""
    part = F.split(value, "[./-]")
    return F.when(F.length(part[0]) == 4, _days(part[0], part[1], part[2])).otherwise(_days(part[2], part[1], part[0]))


def _late(value: Column) -> Column:
    """The number of a day, written month first, among the days from the 13th on."""
    part = F.split(value, "[./-]")
    months = (part[2].cast("int") - 1900) * 12 + part[0].cast("int")
    return F.when(F.length(part[0]) < 4, _days(part[2], part[0], part[1]) - EARLY * months)


def _date(value: Column, key: str) -> Column:
    day, late = _ordinal(value), _late(value)
    whole = feistel(F.floor(day / DAYS_B), day % DAYS_B, F.lit(DAYS_A).cast("long"), F.lit(DAYS_B).cast("long"), key, "date")
    part = feistel(F.floor(late / LATE_B), late % LATE_B, F.lit(LATE_A).cast("long"), F.lit(LATE_B).cast("long"), key, "late date")
    first = F.lit(FIRST_DAY).cast("date")

    def late_day(n: Column) -> Column:
        """The n-th day from the 13th on: the last month that starts by then."""
        before = lambda m: F.datediff(F.add_months(first, m), first) - EARLY * m
        about = F.floor(n * 2401 / (LATE_A * LATE_B)).cast("int")
        month = F.array_max(F.filter(F.sequence(F.greatest(about - 2, F.lit(0)), about + 2), lambda m: before(m) <= n))
        return F.transform(F.array(month), lambda m: F.date_add(F.add_months(first, m), (n - before(m) + EARLY).cast("int")))[0]

    def text(new: Column, *order: str) -> Column:
        old = F.split(value, "[./-]")
        mark = F.array(F.substring(value, F.length(old[0]) + 1, F.lit(1)), F.substring(value, F.length(old[0]) + F.length(old[1]) + 2, F.lit(1)), F.lit(""))
        number = {"y": F.year(new), "m": F.month(new), "d": F.day(new)}
        # As wide as the field was, or as the number is.
        field = lambda i, n: F.lpad(n, F.greatest(F.length(n), F.length(old[i])), "0")
        return F.concat(*(x for i, o in enumerate(order) for x in (field(i, number[o].cast("string")), mark[i])))

    days = F.transform(F.array(whole), lambda p: F.date_add(first, (p["a"] * DAYS_B + p["b"]).cast("int")))
    lates = F.transform(F.array(part), lambda p: late_day(p["a"] * LATE_B + p["b"]))
    return (
        F.when(day.isNull(), F.transform(lates, lambda n: text(n, "m", "d", "y"))[0])
        .when(F.length(F.split(value, "[./-]")[0]) == 4, F.transform(days, lambda n: text(n, "y", "m", "d"))[0])
        .otherwise(F.transform(days, lambda n: text(n, "d", "m", "y"))[0])
    )


def _email(value: Column, key: str) -> Column:
    number = _draw(key, "email", F.lit(0), F.lower(value), F.lit(10**12).cast("long"))
    return F.concat(F.lit("user"), F.lpad(number.cast("string"), 12, "0"), F.lit("@example.invalid"))


def kind_of(value: Column) -> Column:
    """The kind of a match that is validated; else null."""
    digits = _digits(value)
    part = F.split(value, r"\.")
    octets = F.forall(part, lambda p: p.cast("int") <= 255)
    area = F.substring(value, 1, 3)
    used = ~area.isin("000", "666") & (area < "900") & (F.substring(value, 5, 2) != "00") & (F.substring(value, 8, 4) != "0000")
    day, late = _ordinal(value), _late(value)
    real = ((day >= 0) & (day < DAYS_A * DAYS_B)) | (day.isNull() & (late >= 0) & (late < LATE_A * LATE_B))
    whole = lambda pattern: value.rlike(rf"^(?:{pattern})$")
    return (
        F.when(value.contains("@"), F.when(value.rlike(r"@[A-Za-z0-9.-]*\.[A-Za-z]{2}"), F.lit("email")))
        .when(whole(DATE), F.when(real, F.lit("date")))
        .when(whole(IP), F.when(octets, F.lit("ip")))
        .when(whole(SSN), F.when(used, F.lit("ssn")))
        .when(whole(CARD), F.when(F.call_function("luhn_check", digits), F.lit("card")))
        .when(_is_phone(value), "phone")
    )


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of a match; a match that isn't validated stays."""
    kind = kind_of(value)
    return (
        F.when(kind == "email", _email(value, key))
        .when(kind == "date", _date(value, key))
        .when(kind == "ip", _ip(value, key))
        .when(kind == "ssn", _ssn(value, key))
        .when(kind == "card", _card(value, key))
        .when(kind == "phone", _phone(value, key))
        .otherwise(value)
    )


def pseudonymised(documents: DataFrame, key: str, text: str = "text", counts: bool = False) -> DataFrame:
    """The documents with personal data in ``text`` replaced; all columns stay.

    With ``counts``, columns ``n_<kind>`` follow for the values replaced (a
    column of that name in the input is replaced); no other name can clash.  A
    null text stays null with counts 0; an empty one, and one without personal
    data, stays as it is, to the byte.  Whole texts are read, whatever their
    length.  Equal values get equal pseudonyms under one ``key`` in any row, so
    ties and repeated rows need no rule; an empty table gives none.
    """
    names = documents.columns
    added = [f"n_{kind}" for kind in KINDS] if counts else []
    inner = [f"c{i}" for i in range(len(names))]
    stay = [i for i, c in enumerate(names) if c not in added]
    at = names.index(text)
    body = F.col(inner[at])
    found = documents.toDF(*inner).withColumn("found", F.regexp_extract_all(body, F.lit(PATTERN), F.lit(0)))
    between = F.split(body, PATTERN, -1)
    joined = F.concat_ws("", F.transform(F.arrays_zip(between.alias("p"), F.col("new").alias("q")), lambda x: F.concat(x["p"], F.coalesce(x["q"], F.lit("")))))
    result = found.withColumn("new", F.transform("found", lambda m: pseudonym(m, key))).withColumn(inner[at], F.when(F.size("found") > 0, joined).otherwise(body))
    if counts:
        result = result.withColumn("kinds", F.transform("found", kind_of))
    number = lambda kind: F.greatest(F.size(F.filter("kinds", lambda k: F.coalesce(k == F.lit(kind), F.lit(False)))), F.lit(0)).cast("long")
    return result.select(*(inner[i] for i in stay), *(number(name[2:]).alias(name) for name in added)).toDF(*(names[i] for i in stay), *added)
