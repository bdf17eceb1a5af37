"""Format-preserving pseudonyms for personal numbers, dates and addresses in texts.

A keyed Feistel network permutes every validated value within its own format, so that equal values
get equal pseudonyms in all documents and nobody without the key can tell the original. All of it is
SQL expressions; only texts with a candidate pay for them.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

DEMO_KEY = "demonstration key: give your own"
ROUNDS = 10

FIRST_DAY = "1900-01-01"
DAYS = (250, 292)
_CHUNK = 18
_WALKS = 64
_SHORT_WALKS = 160

_WORD = "A-Za-z0-9"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
# The patterns start at a boundary and do not give back what they have taken, so that scanning a
# text takes time in proportion to its length. A repeated group without a small bound is possessive (++):
# others are matched by recursion, which a long text would take too deep.
EMAIL = rf"(?<![{_WORD}._%+-])[{_WORD}._%+-]++@[{_WORD}-]++(?:\.[{_WORD}-]++)++"
# Account numbers by length: printed in groups of four, only the country tells where one ends.
_IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def _in_groups(length: int, countries: str) -> str:
    rest = rf" [A-Z0-9]{{{length % 4}}}" if length % 4 else ""
    return rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: [A-Z0-9]{{4}}){{{length // 4 - 1}}}{rest}"


_IBAN_GROUPS = "|".join(_in_groups(length, countries) for length, countries in _IBAN_COUNTRIES.items())
IBAN = rf"(?<![{_WORD}])(?:[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}+|{_IBAN_GROUPS})(?![{_WORD}])"
PHONE = (
    rf"(?<![{_WORD}+(.-])(?:\+[0-9]{{1,3}}[ .-]?)?"
    r"(?:\([0-9]{3}\) ?[0-9]{3}[-. ][0-9]{4}|[0-9]{3}[-.][0-9]{3}[-.][0-9]{4})(?![0-9]|[-.][0-9])"
)
# With spaces only, or a plus sign and 8 to 15 digits in any groups.
PHONE_SPACED = rf"(?<![{_WORD}+(.-])(?<![0-9] )[0-9]{{3}} [0-9]{{3}} [0-9]{{4}}(?![{_WORD}]|[-.][0-9]| [0-9])"
PHONE_PLUS = rf"(?<![{_WORD}+(.-])\+[1-9](?:[ .-]?(?:[0-9]|\([0-9]{{1,4}}\))){{7,14}}+(?![{_WORD}]|[-.][0-9])"
SSN = rf"(?<![{_WORD}-])(?!000|666|9)[0-9]{{3}}-(?!00)[0-9]{{2}}-(?!0000)[0-9]{{4}}(?![{_WORD}]|-[0-9])"
DATE = (
    rf"(?<![{_WORD}./-])(?:[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{2}}\.[0-9]{{2}}\.[0-9]{{4}}|[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}})"
    rf"(?![{_WORD}]|[./-][0-9])"
)
_TIME = "T[0-9]{2}:?[0-9]{2}"
DATE_OF_TIME = rf"(?<![{_WORD}./-])[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}(?={_TIME})"
SHORT_DATE = (
    rf"(?<![{_WORD}./-])(?:[1-9]/[0-9]{{1,2}}/[0-9]{{4}}|[0-9]{{2}}/[1-9]/[0-9]{{4}}|[1-9]\.[0-9]{{1,2}}\.[0-9]{{4}}|[0-9]{{2}}\.[1-9]\.[0-9]{{4}})"
    rf"(?![{_WORD}]|[./-][0-9])"
)
IP = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
CARD = rf"(?<![{_WORD}])(?:[0-9]{{13,19}}|[0-9]{{4}}(?:[ -][0-9]{{4}}){{3}}|[0-9]{{4}}[ -][0-9]{{6}}[ -][0-9]{{5}})(?![{_WORD}])"
NUMBERS = "|".join((EMAIL, IBAN, SSN, PHONE, DATE, DATE_OF_TIME, SHORT_DATE, IP, CARD, PHONE_SPACED, PHONE_PLUS))
_NAMES = "(?i:token|secret|password|api[_ -]?key)"
_SET = rf"{_NAMES}[ ]{{0,3}}[=:][ ]{{0,3}}"
# Between quotes, or bare with a digit, so that prose after the word is none.
SECRET = (
    rf"(?<=[\"'])(?<={_NAMES}[\"']?[ ]{{0,3}}[=:][ ]{{0,3}}[\"'])[{_WORD}_+/=-]{{6,}}+(?=[\"'])"
    rf"|(?<=[=: ])(?<={_SET})(?=[{_WORD}_+/-]*[0-9])[{_WORD}_+/-][{_WORD}_+/=-]{{5,}}+"
)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _keyed(key: str, tweak: Column, step: Column, value: Column) -> Column:
    """A pseudo-random long from the key and what it is asked for: a hash inside a hash, each with its own key."""
    message = F.concat_ws(":", tweak, step.cast("string"), value.cast("string"))
    inner = F.sha2(F.concat(F.lit(_digest(f"inner {key}")), message), 256)
    outer = F.sha2(F.concat(F.lit(_digest(f"outer {key}")), inner), 256)
    return F.conv(F.substring(outer, 1, 15), 16, 10).cast("bigint")


def permuted(key: str, tweak: Column, left: Column, right: Column, n_left: Column, n_right: Column, back: bool = False) -> Column:
    """Struct (left, right): a keyed permutation of the pairs with left < n_left and right < n_right.

    An alternating Feistel network: each round shifts one side by a keyed hash of the other. ``back``
    runs it backwards.
    """

    def turn(state: Column, step: Column) -> Column:
        shift = F.when(step % 2 == 0, _keyed(key, tweak, step, state["right"]) % n_left).otherwise(
            _keyed(key, tweak, step, state["left"]) % n_right
        )
        shift = -shift if back else shift
        return F.struct(
            F.when(step % 2 == 0, F.pmod(state["left"] + shift, n_left)).otherwise(state["left"]).alias("left"),
            F.when(step % 2 == 1, F.pmod(state["right"] + shift, n_right)).otherwise(state["right"]).alias("right"),
        )

    first, last = (ROUNDS - 1, 0) if back else (0, ROUNDS - 1)
    start = F.struct(left.cast("bigint").alias("left"), right.cast("bigint").alias("right"))
    return F.aggregate(F.sequence(F.lit(first), F.lit(last)), start, turn)


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _radix(c: Column, hexadecimal: bool) -> Column:
    if hexadecimal:
        return F.lit(16).cast("bigint")
    return (
        F.when(c.between("0", "9"), 10).when(c.between("a", "z") | c.between("A", "Z"), 26).otherwise(1).cast("bigint")
    )


def _rank(c: Column, hexadecimal: bool) -> Column:
    if hexadecimal:
        return F.instr(F.lit("0123456789abcdef"), F.lower(c)).cast("bigint") - 1
    base = F.when(c.between("0", "9"), 48).when(c.between("a", "z"), 97).when(c.between("A", "Z"), 65).otherwise(F.ascii(c))
    return (F.ascii(c) - base).cast("bigint")


def _letter(c: Column, rank: Column, hexadecimal: bool) -> Column:
    if hexadecimal:
        return F.substring(F.lit("0123456789abcdef"), rank.cast("int") + 1, F.lit(1))
    base = F.when(c.between("0", "9"), 48).when(c.between("a", "z"), 97).otherwise(65)
    return F.when(_radix(c, False) == 1, c).otherwise(F.char(base + rank))


def _number(chars: Column, hexadecimal: bool) -> Column:
    return F.aggregate(
        chars, F.lit(0).cast("bigint"), lambda n, c: n * _radix(c, hexadecimal) + _rank(c, hexadecimal)
    )


def _size(chars: Column, hexadecimal: bool) -> Column:
    return F.aggregate(chars, F.lit(1).cast("bigint"), lambda n, c: n * _radix(c, hexadecimal))


def _spelled(chars: Column, number: Column, hexadecimal: bool) -> Column:
    """The number written in the character classes of ``chars``."""

    def add(state: Column, c: Column) -> Column:
        radix = _radix(c, hexadecimal)
        rank = state["rest"] % radix
        return F.struct(
            ((state["rest"] - rank) / radix).cast("bigint").alias("rest"),
            F.concat(_letter(c, rank, hexadecimal), state["text"]).alias("text"),
        )

    return F.aggregate(F.reverse(chars), F.struct(number.alias("rest"), F.lit("").alias("text")), add)["text"]


def permuted_text(key: str, kind: str, text: Column, hexadecimal: bool = False, back: bool = False) -> Column:
    """The text with digits, small and capital letters permuted, each within its class; the rest stays.

    Texts are permuted in runs of 18 characters, whose halves are numbers below 2^43.
    """

    def run(start: Column) -> Column:
        chunk = F.substring(text, start, F.lit(_CHUNK))
        half = F.ceil(F.length(chunk) / 2).cast("int")
        left, right = _characters(F.substring(chunk, F.lit(1), half)), _characters(F.substring(chunk, half + 1, F.lit(_CHUNK)))
        tweak = F.concat_ws("/", F.lit(kind), F.length(text).cast("string"), start.cast("string"))
        moved = permuted(
            key, tweak, _number(left, hexadecimal), _number(right, hexadecimal), _size(left, hexadecimal), _size(right, hexadecimal), back
        )
        # One evaluation of the network for both halves.
        spelled = F.transform(
            F.array(moved), lambda m: F.concat(_spelled(left, m["left"], hexadecimal), _spelled(right, m["right"], hexadecimal))
        )
        return spelled[0]

    starts = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(_CHUNK))
    return F.array_join(F.transform(starts, run), "")


def _merged(layout: Column, chars: Column) -> Column:
    """``layout`` with its digits replaced by those of ``chars`` in turn."""
    return F.aggregate(
        _characters(layout),
        F.struct(F.lit("").alias("text"), F.lit(1).alias("at")),
        lambda s, c: F.when(
            c.between("0", "9"),
            F.struct(F.concat(s["text"], F.substring(chars, s["at"], F.lit(1))).alias("text"), (s["at"] + 1).alias("at")),
        ).otherwise(F.struct(F.concat(s["text"], c).alias("text"), s["at"].alias("at"))),
    )["text"]


def _luhn_sum(digits: Column) -> Column:
    """The Luhn sum of digits that still lack their check digit."""
    return F.aggregate(
        F.reverse(_characters(digits)),
        F.struct(F.lit(0).alias("sum"), F.lit(2).alias("times")),
        lambda s, c: F.struct(
            (s["sum"] + c.cast("int") * s["times"] - F.when(c.cast("int") * s["times"] > 9, 9).otherwise(0)).alias("sum"),
            (3 - s["times"]).alias("times"),
        ),
    )["sum"]


def _check_digit(digits: Column) -> Column:
    return (F.pmod(-_luhn_sum(digits), F.lit(10))).cast("string")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _card(key: str, value: Column, back: bool) -> Column:
    digits = _digits(value)
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    moved = permuted_text(key, "card", body, back=back)
    spelled = F.transform(F.array(moved), lambda m: _merged(value, F.concat(m, _check_digit(m))))[0]
    return F.when(_check_digit(body) == F.right(digits, F.lit(1)), spelled)


def _mod97(text: Column) -> Column:
    """The rest by 97 of a text of digits and capital letters, A counting as 10."""
    return F.aggregate(
        _characters(text),
        F.lit(0),
        lambda n, c: F.when(c.between("0", "9"), (n * 10 + F.ascii(c) - 48) % 97).otherwise((n * 100 + F.ascii(c) - 55) % 97),
    )


def _iban(key: str, value: Column, back: bool) -> Column:
    plain = F.replace(value, F.lit(" "), F.lit(""))
    country, account = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.lit(30))
    moved = permuted_text(key, "iban", account, back=back)
    spelled = F.transform(
        F.array(moved),
        lambda m: F.concat(country, F.lpad((98 - _mod97(F.concat(m, country, F.lit("00")))).cast("string"), 2, "0"), m),
    )[0]
    spelled = F.when(value.contains(" "), F.regexp_replace(spelled, "(.{4})(?!$)", "$1 ")).otherwise(spelled)
    return F.when(_mod97(F.concat(account, F.substring(plain, 1, 4))) == 1, spelled)


def _phone(key: str, value: Column, back: bool) -> Column:
    """The last ten digits permuted; a country code stays."""
    digits = F.right(_digits(value), F.lit(10))
    tail = F.regexp_extract(value, r"\(?[0-9]{3}[).-].*$", 0)
    head = F.substring(value, F.lit(1), F.length(value) - F.length(tail))
    return F.concat(head, _merged(tail, permuted_text(key, "phone", digits, back=back)))


def _other_phone(key: str, value: Column, back: bool) -> Column:
    """At most the last ten digits permuted; one digit after a plus sign stays for +1 and +7, else two."""
    digits = _digits(value)
    code = F.when(~value.startswith("+"), 0).when(value.rlike("^[+][17]"), 1).otherwise(2)
    n = F.least(F.lit(10), F.length(digits) - code)
    moved = permuted_text(key, "phone", F.right(digits, n), back=back)
    return _merged(value, F.concat(F.substring(digits, F.lit(1), F.length(digits) - n), moved))


def _ssn(key: str, value: Column, back: bool) -> Column:
    area, group, serial = (F.substring(value, a, n).cast("bigint") for a, n in ((1, 3), (5, 2), (8, 4)))
    area = area - 1 - F.when(area > 666, 1).otherwise(0)
    moved = permuted(key, F.lit("ssn"), area * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), back)

    def spelled(m: Column) -> Column:
        left = m["left"]
        new_area = ((left - left % 99) / 99).cast("bigint") + 1
        new_area = new_area + F.when(new_area >= 666, 1).otherwise(0)
        return F.format_string("%03d-%02d-%04d", new_area, left % 99 + 1, m["right"] + 1)

    return F.transform(F.array(moved), spelled)[0]


def _ip(key: str, value: Column, back: bool) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("bigint"))
    moved = permuted(key, F.lit("ip"), parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], F.lit(65536), F.lit(65536), back)

    def spelled(m: Column) -> Column:
        return F.concat_ws(
            ".",
            *[
                part.cast("string")
                for side in ("left", "right")
                for part in (F.shiftright(m[side], 8), m[side] % 256)
            ],
        )

    return F.transform(F.array(moved), spelled)[0]


def _permuted_day(key: str, tweak: str, day: Column, back: bool) -> Column:
    """A day since ``FIRST_DAY`` permuted within the domain of 73,000 days."""
    n_left, n_right = DAYS
    left = F.floor(day / n_right)
    moved = permuted(key, F.lit(tweak), left, day % n_right, F.lit(n_left), F.lit(n_right), back)
    return F.transform(F.array(moved), lambda m: m["left"] * n_right + m["right"])[0]


def _date(key: str, value: Column, back: bool) -> Column:
    """Dates from 1900 to 2099-11-12; 12/25/1999 is a month first, 12/11/1999 a day first."""
    iso = value.substr(5, 1) == "-"
    year = F.when(iso, value.substr(1, 4)).otherwise(value.substr(7, 4)).cast("int")
    second = F.when(iso, value.substr(6, 2)).otherwise(value.substr(4, 2)).cast("int")
    third = F.when(iso, value.substr(9, 2)).otherwise(value.substr(1, 2)).cast("int")
    slashed = value.substr(3, 1) == "/"
    month_first = slashed & (second > 12) & (third <= 12)
    month = F.when(month_first, third).otherwise(second)
    day = F.when(month_first, second).otherwise(third)
    possible = month.between(1, 12) & (day >= 1) & year.between(1900, 2099)
    month_start = F.when(possible, F.make_date(year, month, F.lit(1)))
    number = F.when(day <= F.dayofmonth(F.last_day(month_start)), F.date_diff(month_start, F.lit(FIRST_DAY).cast("date")) + day - 1)
    number = F.when(number < DAYS[0] * DAYS[1], number.cast("bigint"))

    def as_date(n: Column) -> Column:
        return F.date_add(F.lit(FIRST_DAY).cast("date"), n.cast("int"))

    def walk(n: Column) -> Column:
        # Days above 12 permuted among themselves: on from day to day until one is above 12.
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(_WALKS)),
            _permuted_day(key, "month first", n, back),
            lambda at, _: F.when(F.dayofmonth(as_date(at)) > 12, at).otherwise(_permuted_day(key, "month first", at, back)),
        )

    def spelled(n: Column) -> Column:
        return (
            F.when(iso, F.date_format(as_date(_permuted_day(key, "date", n, back)), "yyyy-MM-dd"))
            .when(month_first, F.date_format(as_date(walk(n)), "MM/dd/yyyy"))
            .when(slashed, F.date_format(as_date(_permuted_day(key, "date", n, back)), "dd/MM/yyyy"))
            .otherwise(F.date_format(as_date(_permuted_day(key, "date", n, back)), "dd.MM.yyyy"))
        )

    return F.when(number.isNotNull(), F.transform(F.array(number), spelled)[0])


def _short_date(key: str, value: Column, back: bool) -> Column:
    """A date with a one-digit day or month, permuted among the dates that have as many digits in the same places."""
    parts = F.split(value, "[./]")
    a, b, year = (parts[i].cast("int") for i in range(3))
    month_first = value.contains("/") & (b > 12) & (a <= 12)
    month, day = F.when(month_first, a).otherwise(b), F.when(month_first, b).otherwise(a)
    possible = month.between(1, 12) & (day >= 1) & year.between(1900, 2099)
    month_start = F.when(possible, F.make_date(year, month, F.lit(1)))
    number = F.when(day <= F.dayofmonth(F.last_day(month_start)), F.date_diff(month_start, F.lit(FIRST_DAY).cast("date")) + day - 1)
    number = F.when(number < DAYS[0] * DAYS[1], number.cast("bigint"))
    layout = F.concat_ws(" ", F.lit("short date"), F.length(parts[0]), F.length(parts[1]), month_first.cast("string"))
    given = F.struct(
        number.alias("number"),
        layout.alias("layout"),
        F.length(parts[0]).alias("first"),
        F.length(parts[1]).alias("second"),
        month_first.alias("month_first"),
        F.when(value.contains("/"), "/").otherwise(".").alias("sign"),
    )

    def as_date(n: Column) -> Column:
        return F.date_add(F.lit(FIRST_DAY).cast("date"), n.cast("int"))

    def walk(g: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            day, month = F.dayofmonth(as_date(at)), F.month(as_date(at))
            fits = F.when(g["month_first"], ((g["first"] == 2) | (month < 10)) & (day > 12)).otherwise(
                ((g["first"] == 2) | (day < 10)) & ((g["second"] == 2) | (month < 10))
            )
            return F.when(fits, at).otherwise(_permuted_day(key, g["layout"], at, back))

        start = _permuted_day(key, g["layout"], g["number"], back)
        return F.struct(g.alias("given"), F.aggregate(F.sequence(F.lit(1), F.lit(_SHORT_WALKS)), start, step).alias("moved"))

    def spelled(w: Column) -> Column:
        g, date = w["given"], as_date(w["moved"])
        day, month = F.dayofmonth(date).cast("string"), F.month(date).cast("string")
        first, second = F.when(g["month_first"], month).otherwise(day), F.when(g["month_first"], day).otherwise(month)
        text = F.concat(F.lpad(first, g["first"], "0"), g["sign"], F.lpad(second, g["second"], "0"), g["sign"], F.year(date).cast("string"))
        # lpad would cut what did not fit.
        return F.when((F.length(first) <= g["first"]) & (F.length(second) <= g["second"]), text)

    return F.when(number.isNotNull(), F.transform(F.transform(F.array(given), walk), spelled)[0])


def _email(key: str, value: Column, back: bool) -> Column:
    """The part before the sign permuted; the domain stays."""
    return F.concat(permuted_text(key, "email", F.substring_index(value, "@", 1), back=back), F.lit("@"), F.substring_index(value, "@", -1))


def _secret(key: str, value: Column, back: bool) -> Column:
    lower = permuted_text(key, "secret", value, hexadecimal=True, back=back)
    return (
        F.when(value.rlike("^[0-9a-f]+$"), lower)
        .when(value.rlike("^[0-9A-F]+$"), F.upper(lower))
        .otherwise(permuted_text(key, "secret", value, back=back))
    )


def _numbers(key: str, value: Column, back: bool) -> Column:
    """Struct (kind, text) of a match; text is null where the value is not valid."""
    kinds = (
        ("email", value.contains("@"), _email),
        ("iban", value.rlike("^[A-Z]"), _iban),
        ("ssn", value.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), _ssn),
        ("date", value.rlike("^([0-9]{4}-[0-9]{2}-|[0-9]{2}[./])[0-9]{2}([./][0-9]{4})?$"), _date),
        ("date", value.rlike("^[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}$"), _short_date),
        ("ip", value.rlike(r"^[0-9]+(\.[0-9]+){3}$"), _ip),
        ("card", value.rlike("^[0-9]{13}|^[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|^[0-9]{4}[ -][0-9]{6}[ -]"), _card),
        ("phone", value.rlike(rf"^{PHONE}$"), _phone),
        ("phone", F.lit(True), _other_phone),
    )
    kind = text = None
    for name, condition, replace in kinds:
        new = replace(key, value, back)
        kind = F.when(condition, name) if kind is None else kind.when(condition, name)
        text = F.when(condition, new) if text is None else text.when(condition, new)
    return F.struct(kind.alias("kind"), text.alias("text"))


def _replaced(docs: DataFrame, candidate: str, pattern: str, replace) -> DataFrame:
    """``docs`` (text, found, ...) with every match replaced and the kinds of the valid ones added to ``found``."""
    is_candidate = F.col("text").rlike(candidate)
    matches = F.when(is_candidate, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    new = docs.withColumn("__matches", matches).withColumn(
        "__new", F.when(F.size("__matches") > 0, F.transform("__matches", replace))
    )
    parts = F.zip_with(
        F.split("text", pattern, -1),
        F.zip_with("__matches", "__new", lambda old, n: F.coalesce(n["text"], old)),
        lambda gap, value: F.concat(gap, F.coalesce(value, F.lit(""))),
    )
    kinds = F.transform(F.filter("__new", lambda n: n["text"].isNotNull()), lambda n: n["kind"])
    return new.withColumns(
        {
            "text": F.when(F.col("__new").isNotNull(), F.array_join(parts, "")).otherwise(F.col("text")),
            "found": F.concat("found", F.coalesce(kinds, F.array().cast("array<string>"))),
        }
    ).drop("__matches", "__new")


def _run(docs: DataFrame, key: str, back: bool) -> DataFrame:
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index("text")
    plain = docs.toDF(*["text" if i == at else name for i, name in enumerate(names)])
    plain = plain.withColumn("found", F.array().cast("array<string>"))
    plain = _replaced(
        plain, _NAMES, SECRET, lambda v: F.struct(F.lit("secret").alias("kind"), _secret(key, v, back).alias("text"))
    )
    plain = _replaced(plain, "[0-9@]", NUMBERS, lambda v: _numbers(key, v, back))
    return plain.select(*["text" if i == at else name for i, name in enumerate(names)], "found").toDF(*docs.columns, "pii_kinds")


def pseudonymise(docs: DataFrame, key: str = DEMO_KEY) -> DataFrame:
    """``docs`` with its column ``text`` pseudonymised, and ``pii_kinds``: the kind of each value replaced.

    Replaced are e-mail addresses (the part before the sign), phone numbers (ten digits after a
    country code, also with spaces only, and 8 to 15 digits after a plus sign), social security
    numbers in valid ranges, IPv4 addresses, dates from 1900 to 2099-11-12 in three layouts (also
    before a time or with a one-digit day or month), payment card numbers (also in groups of 4, 6 and
    5) that pass the Luhn test, account numbers (IBAN, also in groups of four) that pass theirs, and
    tokens and passwords of six or more characters, quoted or, with a digit, bare. Pseudonyms have the length (addresses:
    the format), separators and check digits of their kind; values that are not valid stay. Equal
    values get equal pseudonyms, different values different ones. All other columns are kept, whatever
    their names; null texts stay null and have no kinds. ``key`` is secret: who has it can restore.
    """
    return _run(docs, key, False)


def restore(docs: DataFrame, key: str = DEMO_KEY) -> DataFrame:
    """The inverse of ``pseudonymise`` under the same key, for rows (text, ...)."""
    return _run(docs, key, True).drop("pii_kinds")
