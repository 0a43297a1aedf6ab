"""Format-preserving Feistel pseudonyms for personal data, as column expressions only.

Numbers and dates that stand in a text are found by pattern, validated, and permuted within their
format by a keyed Feistel network, so equal values get equal pseudonyms in every document and
different values different ones. Kinds, in the order they are tried:

- ``email``: letters and digits of the local part; the domain stays.
- ``iban``: check digits must hold; the account part is permuted and the check digits follow.
- ``date``: a day from 1800 to 2199 as ``yyyy-mm-dd``, or day, month and year with dots or slashes
  (month first where only that is a day); permuted among these 146,097 days.
- ``ip``: four numbers up to 255; permuted among all addresses.
- ``phone``: 8 to 15 digits after ``+``, or the North American form; a leading ``+1`` stays.
- ``ssn``: three, two and four digits with hyphens, none of them all zero; digits permuted.
- ``card``: 13 to 19 digits, plain or in fours, with a right Luhn digit; the others are permuted and
  the Luhn digit follows.

Separators, letter case and length stay as they are. A match that fails its validation is left as
it is. Null texts stay null with no replacements; empty and very long texts are handled alike, whole.
Equal rows get equal results, and an input column named like an output column is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .common import add_fields

ROUNDS = 8
# Patterns of the kinds, in the order they are tried.
_START, _END = r"(?<![\w.+@-])", r"(?![\w@-])"
PATTERNS = {
    "email": r"(?<![\w.%+-])[\w.%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": _START + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _END,
    "date": _START
    + r"(?:(?:18|19|20|21)\d\d-\d\d-\d\d|\d{1,2}([./])\d{1,2}\1(?:18|19|20|21)\d\d)(?![\w-])",
    "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\w)",
    "phone": r"(?<![\w+.-])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}" + _END
    + r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,4}" + _END,
    "ssn": _START + r"\d{3}-\d{2}-\d{4}" + _END,
    "card": _START
    + r"(?:\d{4}(?: \d{4}){2} \d{1,7}|\d{4}(?:-\d{4}){2}-\d{1,7}|\d{13,19})" + _END,
}
# Days of the Gregorian cycle from 1800 to 2199, as a product for the two sides of the network.
FIRST_DAY, DAY_SIDES = "1800-01-01", (189, 773)


def _combined() -> str:
    """All patterns as one; the only back reference is that of the date's separator."""
    parts = [p.replace(r"([./])", r"(?<sep>[./])").replace(r"\1", r"\k<sep>") for p in PATTERNS.values()]
    return "|".join(f"(?:{p})" for p in parts)


def _hash(key: str, kind: str, *parts: Column) -> Column:
    """Keyed number of 60 bits."""
    text = F.concat_ws("|", F.lit(key), F.lit(kind), *[p.cast("string") for p in parts])
    inner = F.concat(F.lit(key), F.sha2(text, 256))
    return F.conv(F.substring(F.sha2(inner, 256), 1, 15), 16, 10).cast("long")


def _chars(text: Column) -> Column:
    """Characters of a text that is not empty."""
    return F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(text, i, 1))


def _shifted(side: Column, amount: Callable[[Column], Column]) -> Column:
    """Each character moved on within digits, small or capital letters."""

    def moved(c, i):
        code = F.ascii(c)
        first, n = (
            F.when(c.rlike("[0-9]"), a).when(c.rlike("[a-z]"), b).otherwise(d)
            for a, b, d in ((48, 97, 65), (10, 26, 26))
        )
        return F.when(
            c.rlike("[0-9A-Za-z]"), F.char(first + F.pmod(code - first + amount(i), n))
        ).otherwise(c)

    return F.array_join(F.transform(_chars(side), moved), "")


def permuted(text: Column, key: str, kind: str) -> Column:
    """Feistel network over the two halves of a text of ASCII letters and digits.

    A single character has no halves: it moves on by a keyed step that is never zero.
    """
    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(
        F.substring(text, F.lit(1), half).alias("a"),
        F.substring(text, half + 1, F.length(text)).alias("b"),
    )

    def step(state, r):
        other = state["b"]
        turned = _shifted(state["a"], lambda i: _hash(key, kind, r, other, i))
        return F.struct(other.alias("a"), turned.alias("b"))

    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    found = F.aggregate(rounds, start, step, lambda s: F.concat(s["a"], s["b"]))
    return F.when(F.length(text) < 2, _single(text, key, kind)).otherwise(found)


def _single(text: Column, key: str, kind: str) -> Column:
    """One letter or digit moved on by 1 to 9 or 1 to 25 places."""
    steps = F.when(text.rlike("[0-9]"), 9).otherwise(25)
    return F.when(text == "", text).otherwise(
        _shifted(text, lambda _: F.pmod(_hash(key, kind, F.lit("single")), steps) + 1)
    )


def _permuted_pair(x: Column, y: Column, sides: tuple[int, int], key: str, kind: str) -> Column:
    """Feistel network over two numbers below the ends of their sides."""
    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))

    def step(s, r):
        left = F.pmod(s["x"] + _hash(key, kind, r, s["y"]), F.lit(sides[0]))
        right = F.pmod(s["y"] + _hash(key, kind, r, s["x"]), F.lit(sides[1]))
        odd = r % 2 == 1
        return F.struct(
            F.when(odd, left).otherwise(s["x"]).alias("x"),
            F.when(odd, s["y"]).otherwise(right).alias("y"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def _plain(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9A-Za-z]", "")


def _refilled(match: Column, values: Column) -> Column:
    """The match with its letters and digits replaced by those of ``values``, in order."""

    def filled(c, i):
        place = F.length(_plain(F.substring(match, F.lit(1), i + 1)))
        return F.when(c.rlike("[0-9A-Za-z]"), F.substring(values, place, 1)).otherwise(c)

    return F.array_join(F.transform(_chars(match), filled), "")


def _luhn_sum(payload: Column) -> Column:
    """Luhn sum of the digits before the check digit."""

    def term(c, i):
        doubled = c.cast("int") * 2
        return F.when(i % 2 == 0, doubled - F.when(doubled > 9, 9).otherwise(0)).otherwise(
            c.cast("int")
        )

    return F.aggregate(
        F.transform(_chars(F.reverse(payload)), term), F.lit(0), lambda a, x: a + x
    )


def _luhn_digit(payload: Column) -> Column:
    return F.pmod(-_luhn_sum(payload), F.lit(10)).cast("string")


def _rest_97(text: Column) -> Column:
    """Remainder by 97 of a text read as a number, letters counting from 10."""

    def digits(rest, c):
        value = F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return (rest * F.when(value < 10, 10).otherwise(100) + value) % 97

    return F.aggregate(_chars(text), F.lit(0), digits)


def _email(m: Column, key: str) -> Column:
    local = F.substring_index(m, "@", 1)
    values = _plain(local)
    domain = F.substring(m, F.length(local) + 1, F.length(m))
    return F.when(
        F.length(values) > 0, F.concat(_refilled(local, permuted(values, key, "email")), domain)
    )


def _iban(m: Column, key: str) -> Column:
    plain = _plain(m)
    head = F.substring(plain, 1, 2)
    account = F.substring(plain, F.lit(5), F.length(plain))
    turned = permuted(account, key, "iban")
    check = F.lpad((98 - _rest_97(F.concat(turned, head, F.lit("00")))).cast("string"), 2, "0")
    valid = _rest_97(F.concat(account, F.substring(plain, 1, 4))) == 1
    return F.when(valid, _refilled(m, F.concat(head, check, turned)))


def _date(m: Column, key: str) -> Column:
    parts = F.split(m, "[./-]")
    iso = m.rlike("^[0-9]{4}-")
    first, second, third = (F.element_at(parts, i) for i in (1, 2, 3))

    def day(y, month, d):
        return F.try_to_date(
            F.concat_ws("-", y, F.lpad(month, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd"
        )

    day_first = day(third, second, first)
    month_first = day(third, first, second)
    swapped = day_first.isNull()
    found = F.when(iso, day(first, second, third)).otherwise(F.coalesce(day_first, month_first))
    number = F.datediff(found, F.lit(FIRST_DAY).cast("date"))
    low, high = DAY_SIDES
    turned = _permuted_pair(number % low, F.floor(number / low), DAY_SIDES, key, "date")
    after = F.date_add(F.lit(FIRST_DAY).cast("date"), (turned["y"] * low + turned["x"]).cast("int"))
    separator = F.regexp_extract(m, "[./-]", 0)
    padded = m.rlike("^[0-9]{2}[./][0-9]{2}[./]")

    def part(form):
        value = F.date_format(after, form)
        return F.when(padded, F.lpad(value, 2, "0")).otherwise(value)

    d, month = part("d"), part("M")
    named = F.concat_ws(
        separator_text := "\u0000",
        F.when(swapped, month).otherwise(d),
        F.when(swapped, d).otherwise(month),
        F.date_format(after, "yyyy"),
    )
    named = F.replace(named, F.lit(separator_text), separator)
    return F.when(
        found.isNotNull(), F.when(iso, F.date_format(after, "yyyy-MM-dd")).otherwise(named)
    )


def _ip(m: Column, key: str) -> Column:
    parts = F.transform(F.split(m, "\\."), lambda x: x.cast("int"))
    valid = F.forall(parts, lambda x: x <= 255)
    high, low = (F.element_at(parts, i) * 256 + F.element_at(parts, i + 1) for i in (1, 3))
    turned = _permuted_pair(high, low, (65536, 65536), key, "ip")

    def numbers(s):
        octets = [v for n in ("x", "y") for v in (F.floor(s[n] / 256), s[n] % 256)]
        return F.concat_ws(".", *[o.cast("string") for o in octets])

    # The pair is bound once, not once for each of the four numbers.
    return F.when(valid, F.element_at(F.transform(F.array(turned), numbers), 1))


def _phone(m: Column, key: str) -> Column:
    plain = _plain(m)
    kept = F.when(m.rlike("^\\+1[^0-9]|^\\+1[0-9]{10}$"), 1).otherwise(0)
    body = F.substring(plain, kept + 1, F.length(plain))
    values = F.concat(F.substring(plain, F.lit(1), kept), permuted(body, key, "phone"))
    return F.when(F.length(plain).between(8, 15), _refilled(m, values))


def _ssn(m: Column, key: str) -> Column:
    valid = ~m.rlike("^000|-00-|0000$")
    return F.when(valid, _refilled(m, permuted(_plain(m), key, "ssn")))


def _card(m: Column, key: str) -> Column:
    plain = _plain(m)
    payload = F.substring(plain, F.lit(1), F.length(plain) - 1)
    valid = F.length(plain).between(13, 19) & (
        _luhn_digit(payload) == F.substring(plain, -1, 1)
    )
    turned = permuted(payload, key, "card")
    return F.when(valid, _refilled(m, F.concat(turned, _luhn_digit(turned))))


_PSEUDONYMS = {
    "email": _email,
    "iban": _iban,
    "date": _date,
    "ip": _ip,
    "phone": _phone,
    "ssn": _ssn,
    "card": _card,
}


def _whole(kind: str) -> str:
    """Pattern of a text that is one match; what stands around it has been checked."""
    return f"^(?:{PATTERNS[kind]})$"


def pseudonym(match: Column, key: str) -> Column:
    """Pseudonym of a match by the first kind it has; null when it fails the validation."""
    found = F.lit(None).cast("string")
    for kind in reversed(PATTERNS):
        found = F.when(match.rlike(_whole(kind)), _PSEUDONYMS[kind](match, key)).otherwise(found)
    return found


def pseudonymise(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Replace ``text`` and add ``n_replaced``, the number of values that got a pseudonym."""
    source = F.col(text).cast("string")
    # Every pattern needs a digit or an at sign, so other texts are not searched.
    possible = source.rlike("[0-9@]")
    matches = F.regexp_extract_all(source, F.lit(_combined()), F.lit(0))
    replaced = F.transform(
        matches, lambda m: F.struct(m.alias("match"), pseudonym(m, key).alias("pseudonym"))
    )
    found = F.struct(
        F.when(possible, F.split(source, _combined(), -1))
        .when(source.isNotNull(), F.array(source))
        .alias("gaps"),
        F.when(possible, replaced)
        .when(source.isNotNull(), F.array().cast("array<struct<match:string,pseudonym:string>>"))
        .alias("found"),
    )
    parts = df.withColumn("__pii", found)
    joined = F.array_join(
        F.zip_with(
            "__pii.gaps",
            "__pii.found",
            lambda gap, m: F.concat(gap, F.coalesce(m["pseudonym"], m["match"], F.lit(""))),
        ),
        "",
    )
    replaced = F.filter("__pii.found", lambda m: m["pseudonym"].isNotNull())
    result = F.struct(
        joined.alias(text),
        F.coalesce(F.size(replaced), F.lit(0)).cast("long").alias("n_replaced"),
    )
    return add_fields(parts, result, [text, "n_replaced"]).drop("__pii")
