"""Format-preserving pseudonyms for personal data, with SQL functions only.

Found and checked: e-mail addresses, payment card numbers (Luhn), US social security numbers
(assigned ranges), telephone numbers (US ones with separators, and any of E.164: a plus and 8 to
15 digits in any groups), IPv4 addresses (octets up to 255) and calendar dates (1700 to 2099, also
before a time, days and months of one digit too). What fails its check stays as it is.

Each value is replaced by a keyed Feistel permutation of its own format: cards stay Luhn-valid
with their length, first digit and separators, dates stay dates, and so on. A permutation is
one-to-one, so equal values get equal pseudonyms in every document, different ones never
collide, and no table of names is kept. Digits alone enter it, so one card or telephone number
written with other separators stays linked too, and a date in another notation.

``key`` is a secret. It stands in the query plan as a literal; set
``spark.redaction.string.regex`` where plans are logged.

Defined cases: a null text stays null, an empty one empty; repeated rows are treated alike; an
empty table gives no rows; every other column passes through, whatever its name. One map over
the table, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedloom.functions.columns import with_computed

ROUNDS = 10
KINDS = ("email", "date", "ssn", "ip", "card", "phone")

_FREE = r"(?<![A-Za-z0-9])"
_END = r"(?![A-Za-z0-9])"
_GROUPED = r"\+[2-9]\d{0,2}(?:[ .-]\d{2,4}){2,5}"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}" + _END,
    "date": (
        rf"{_FREE}(?:\d{{4}}-\d{{1,2}}-\d{{1,2}}|\d{{1,2}}/\d{{1,2}}/\d{{4}}|\d{{1,2}}\.\d{{1,2}}\.\d{{4}})"
        rf"(?:{_END}|(?=[Tt]\d{{2}}))"
    ),
    "ssn": rf"{_FREE}\d{{3}}-\d{{2}}-\d{{4}}{_END}",
    "ip": rf"(?<![A-Za-z0-9.])(?:\d{{1,3}}\.){{3}}\d{{1,3}}(?![A-Za-z0-9]|\.\d)",
    "card": rf"{_FREE}(?:\d{{13,19}}|\d{{4}}([ -])\d{{4}}\1\d{{4}}\1\d{{1,7}}|\d{{4}}([ -])\d{{6}}\2\d{{5}}){_END}",
    "phone": (
        rf"(?<![A-Za-z0-9+])(?:\+1[ .-]?)?(?:\(\d{{3}}\)[ .-]?|\d{{3}}[ .-])\d{{3}}[ .-]\d{{4}}{_END}"
        rf"|(?<![A-Za-z0-9+])(?:{_GROUPED}(?![ .-]?\d)|\+[1-9](?:[ .-]?[()]?[ .-]?\d){{7,14}}|{_GROUPED}){_END}"
    ),
}
#: Country codes of E.164; no code begins with another.
_COUNTRY = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
#: Days from 1700-01-01 to 2099-12-31: 400 years always have 189 * 773 days.
_FIRST_DAY, _DAYS = "1700-01-01", (189, 773)


def _hash(key: str, *parts: Column) -> Column:
    """60 pseudo-random bits of the parts under the key."""
    digest = F.sha2(F.concat_ws(":", F.lit(key), *[part.cast("string") for part in parts]), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel_numbers(left: Column, right: Column, sizes: tuple[Column, Column], key: str, context: Column) -> Column:
    """Permute pairs ``left < sizes[0]``, ``right < sizes[1]``; returns a struct of both."""
    start = F.struct(left.cast("long").alias("left"), right.cast("long").alias("right"))

    def step(s: Column, i: Column) -> Column:
        changed_left = (s["left"] + F.pmod(_hash(key, context, i, s["right"]), sizes[0])) % sizes[0]
        changed_right = (s["right"] + F.pmod(_hash(key, context, i, s["left"]), sizes[1])) % sizes[1]
        even = i % 2 == 0
        return F.struct(
            F.when(even, changed_left).otherwise(s["left"]).alias("left"),
            F.when(even, s["right"]).otherwise(changed_right).alias("right"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def feistel_digits(digits: Column, key: str, context: str) -> Column:
    """Permute strings of 2 to 30 digits of the same length."""
    n = F.length(digits)
    half = (n / 2).cast("int")
    powers = tuple(F.rpad(F.lit("1"), 1 + width, "0").cast("long") for width in (half, n - half))
    named = F.concat_ws(":", F.lit(context), n)
    mixed = feistel_numbers(
        F.substring(digits, F.lit(1), half).cast("long"), F.substring(digits, half + 1, n).cast("long"), powers, key, named
    )
    # One struct, used for both halves: a one-element array keeps it from being computed twice.
    joined = F.transform(
        F.array(mixed),
        lambda m: F.concat(F.lpad(m["left"].cast("string"), half, "0"), F.lpad(m["right"].cast("string"), n - half, "0")),
    )
    return F.get(joined, F.lit(0))


def feistel_text(value: Column, key: str, context: str) -> Column:
    """Permute strings within the classes of their characters: digits, small and capital letters."""
    half = (F.length(value) / 2).cast("int")
    start = F.struct(
        F.substring(value, F.lit(1), half).alias("left"), F.substring(value, half + 1, F.length(value)).alias("right")
    )

    def shifted(part: Column, other: Column, i: Column) -> Column:
        def shift(c: Column, j: Column) -> Column:
            out = c
            for letters in _CLASSES:
                at = F.instr(F.lit(letters), c) - 1 + F.pmod(_hash(key, F.lit(context), i, j, other), F.lit(len(letters)))
                moved = F.substring(F.lit(letters), (at % len(letters) + 1).cast("int"), F.lit(1))
                out = F.when(c.rlike(f"^[{letters[0]}-{letters[-1]}]$"), moved).otherwise(out)
            return out

        return F.array_join(F.transform(F.split(part, ""), shift), "")

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(
            F.when(even, shifted(s["left"], s["right"], i)).otherwise(s["left"]).alias("left"),
            F.when(even, s["right"]).otherwise(shifted(s["right"], s["left"], i)).alias("right"),
        )

    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat(s["left"], s["right"])
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced in order."""

    def put(c: Column, i: Column) -> Column:
        place = F.length(_digits(F.substring(shape, F.lit(1), i + 1)))
        return F.when(c.rlike("^[0-9]$"), F.substring(digits, place, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(shape, ""), put), "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum, the last digit counting once."""

    def weigh(c: Column, i: Column) -> Column:
        digit = c.cast("int")
        doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return F.when((F.length(digits) - i) % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(F.transform(F.split(digits, ""), weigh), F.lit(0), lambda total, x: total + x)


def _one(value: Column, change) -> Column:
    """``change`` applied to a value that it uses several times, computed once."""
    return F.get(F.transform(F.array(value), change), F.lit(0))


def _card(value: Column, key: str) -> Column:
    def change(digits: Column) -> Column:
        n = F.length(digits)
        middle = feistel_digits(F.substring(digits, F.lit(2), n - 2), key, "card")
        body = F.concat(F.substring(digits, 1, 1), middle)
        closed = _one(body, lambda b: F.concat(b, ((10 - luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))
        return F.when(luhn_sum(digits) % 10 == 0, _one(closed, lambda c: _refill(value, c)))

    return _one(_digits(value), change)


def _ssn(value: Column, key: str) -> Column:
    area, group, serial = (F.split_part(value, F.lit("-"), F.lit(i)).cast("long") for i in (1, 2, 3))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    # 898 areas by 99 groups, and 9999 serial numbers.
    left = (area - 1 - (area > 666).cast("int")) * 99 + group - 1
    mixed = feistel_numbers(left, serial - 1, (F.lit(898 * 99), F.lit(9999)), key, F.lit("ssn"))

    def shown(m: Column) -> Column:
        place = F.floor(m["left"] / 99) + 1
        parts = [(place + (place > 665).cast("int"), 3), (m["left"] % 99 + 1, 2), (m["right"] + 1, 4)]
        return F.concat_ws("-", *[F.lpad(number.cast("long").cast("string"), width, "0") for number, width in parts])

    return F.when(valid, _one(mixed, shown))


def _ip(value: Column, key: str) -> Column:
    octets = [F.split_part(value, F.lit("."), F.lit(i)).cast("long") for i in (1, 2, 3, 4)]
    size = F.lit(65536)
    mixed = feistel_numbers(octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], (size, size), key, F.lit("ip"))

    def shown(m: Column) -> Column:
        halves = [m["left"], m["right"]]
        return F.concat_ws(".", *[part.cast("long").cast("string") for h in halves for part in (F.floor(h / 256), h % 256)])

    plain = ~value.rlike(r"(^|\.)0\d")  # an octet with leading zeros would not be one-to-one
    return F.when(plain & (F.greatest(*octets) < 256), _one(mixed, shown))


def _date(value: Column, key: str) -> Column:
    def change(separator: str, order: str) -> Column:
        part = {name: F.split_part(value, F.lit(separator), F.lit(i)) for i, name in enumerate(order, 1)}
        plain = F.concat_ws("-", part["y"], F.lpad(part["m"], 2, "0"), F.lpad(part["d"], 2, "0"))
        day = F.datediff(F.try_to_date(plain, "yyyy-MM-dd"), F.lit(_FIRST_DAY).cast("date"))
        sizes = tuple(map(F.lit, _DAYS))
        mixed = feistel_numbers(F.floor(day / _DAYS[1]), day % _DAYS[1], sizes, key, F.lit("date"))
        moved = _one(
            mixed,
            lambda m: F.date_add(F.lit(_FIRST_DAY).cast("date"), (m["left"] * _DAYS[1] + m["right"]).cast("int")),
        )

        def shown(date: Column) -> Column:
            new = {"y": F.year(date), "m": F.month(date), "d": F.dayofmonth(date)}
            texts = {name: number.cast("string") for name, number in new.items()}
            # A part of one digit had no zero before it, and gets none.
            return F.concat_ws(
                separator, *[F.lpad(texts[n], F.greatest(F.length(part[n]), F.length(texts[n])), "0") for n in order]
            )

        return F.when(day.between(0, _DAYS[0] * _DAYS[1] - 1), _one(moved, shown))

    return (
        F.when(value.contains("-"), change("-", "ymd"))
        .when(value.contains("/"), change("/", "mdy"))
        .otherwise(change(".", "dmy"))
    )


def _phone(value: Column, key: str) -> Column:
    country = F.regexp_extract(value, _COUNTRY, 0)
    rest = F.substring(value, F.length(country) + 1, F.length(value))
    return F.concat(country, _refill(rest, feistel_digits(_digits(rest), key, "phone")))


def _email(value: Column, key: str) -> Column:
    local = F.split_part(value, F.lit("@"), F.lit(1))
    return F.concat(feistel_text(local, key, "email"), F.lit("@"), F.split_part(value, F.lit("@"), F.lit(2)))


_CHANGE = {"email": _email, "date": _date, "ssn": _ssn, "ip": _ip, "card": _card, "phone": _phone}


def _pattern() -> str:
    """All kinds in one pattern; references to groups are moved to their places in it."""
    card = PATTERNS["card"].replace(r"\1", r"\k<s>").replace(r"\2", r"\k<t>").replace("([ -])", "(?<s>[ -])", 1)
    card = card.replace("([ -])", "(?<t>[ -])", 1)
    return "|".join(f"(?:{card if kind == 'card' else PATTERNS[kind]})" for kind in KINDS)


def _pseudonym(value: Column, key: str) -> Column:
    """Kind and replacement of one match; the kind is empty where the check fails."""
    whole = {kind: value.rlike(f"^(?:{PATTERNS[kind]})$") for kind in KINDS}
    changed, kind = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name in reversed(KINDS):
        changed = F.when(whole[name], _CHANGE[name](value, key)).otherwise(changed)
        kind = F.when(whole[name], F.lit(name)).otherwise(kind)
    return _one(
        changed,
        lambda c: F.struct(F.when(c.isNotNull(), kind).alias("kind"), F.coalesce(c, value).alias("text")),
    )


def pseudonymize(docs: DataFrame, key: str, text_col: str = "text", found_col: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col``; ``found_col``, if named, gets the kinds found, in order."""
    pattern, text = _pattern(), F.col(text_col).cast("string")
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    changed = F.when(text.rlike(pattern), F.transform(matches, lambda m: _pseudonym(m, key)))
    names = {"gaps", "changed"}
    prefix = "_"
    while any(f"{prefix}{name}" in docs.columns for name in names):
        prefix += "_"
    gaps, new = f"{prefix}gaps", f"{prefix}changed"
    rows = with_computed(docs, {new: changed, gaps: F.when(text.rlike(pattern), F.split(text, pattern, -1))})
    pieces = F.arrays_zip(F.col(gaps).alias("gap"), F.col(f"{new}.text").alias("text"))
    rebuilt = F.array_join(F.transform(pieces, lambda p: F.concat(p["gap"], F.coalesce(p["text"], F.lit("")))), "")
    columns = [
        F.when(F.col(new).isNull(), text).otherwise(rebuilt).alias(name) if name == text_col else F.col(f"`{name}`")
        for name in docs.columns
    ]
    if found_col:
        kinds = F.filter(F.col(f"{new}.kind"), lambda k: k.isNotNull())
        columns.append(F.coalesce(kinds, F.array().cast("array<string>")).alias(found_col))
    return rows.select(*columns)
