"""Surrogate values as pure column expressions of (rule, value, salt).

Nothing is remembered between rows, columns, tables or runs: the same value
under the same rule and salt always gets the same surrogate, wherever it
occurs, without a join.  All expressions stay in the JVM and also work on a
streaming DataFrame.  A null value gives a null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word parts; a name is one head and one tail, which gives 1,024 different names.
FIRST_HEADS = (
    "Al An Ar Bel Ben Bri Cal Car Cor Da De El Em Fa Fin Ga Ha Is Jo Ka Ke La Le Mar Mi Na Or Pa Ro Sa Ta Vi"
).split()
FIRST_TAILS = (
    "bert dan den dra fred gan gie ina ira jan ka la lan len lia lin lo mar mon na nie ra ric ris ron ry sa sey ta tin vin ya"
).split()
LAST_HEADS = (
    "Ash Black Bow Brook Cart Clay Cold Dun East Fair Field Gold Green Hart Hay Hill Holl Kirk Lang Long Mill Nor Oak Pem Red Rock Stan Thorn Wal West White Wood"
).split()
LAST_TAILS = (
    "ard berg bridge burn bury by den don er ett field ford gate ham house ing land ley low man mere more ner over rick sey son stead ton ward well worth"
).split()
STREETS = (
    "Acorn Alder Aspen Beech Birch Cedar Chapel Cherry Church Elm Forge Garden Grove Harbor Hazel Juniper Lake Laurel Maple Market Meadow Mill Orchard Park Pine Poplar Quarry River School Spring Station Willow"
).split()
STREET_KINDS = "Avenue Court Drive Lane Place Road Street Way".split()
CITY_HEADS = (
    "Amber Bay Bright Cedar Clear Copper Crest Deer Eagle Elm Fern Fox Glen Grand Green Iron Lake Maple North Oak Pine Port River Rose Sand Silver South Spring Stone Sun West Winter"
).split()
CITY_TAILS = "borough bridge brook bury dale field ford gate haven hurst mouth port side ton view ville".split()
EMAIL_DOMAIN = "mail.example.org"


def python_text(value: Column, data_type: str | None = None) -> Column:
    """Text form hashed by the rules; booleans are spelt True and False."""
    if data_type == "boolean":
        return F.when(value, F.lit("True")).when(~value, F.lit("False"))
    return value.cast("string")


def salted_hash(value: Column, salt: str, algorithm: str = "sha256", data_type: str | None = None) -> Column:
    """First 16 hex digits of SHA-256 (or SHA-512) of the value followed by the salt."""
    bits = 512 if algorithm == "sha512" else 256
    return F.substring(F.sha2(F.concat(python_text(value, data_type), F.lit(salt)), bits), 1, 16)


def digest(rule: str, value: Column, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(f"{rule}:"), value.cast("string"), F.lit(f":{salt}")), 256)


def _number(key: Column, part: int) -> Column:
    """One of eight independent 32-bit numbers of a digest."""
    return F.conv(F.substring(key, 1 + 8 * part, 8), 16, 10).cast("bigint")


def _pick(words: Sequence[str], number: Column) -> Column:
    # the split of a constant is worked out once, when the query is planned
    return F.get(F.split(F.lit(" ".join(words)), " "), (number % len(words)).cast("int"))


def _digits(number: Column, width: int) -> Column:
    return F.lpad((number % 10**width).cast("string"), width, "0")


def _first(key: Column, part: int) -> Column:
    return F.concat(_pick(FIRST_HEADS, _number(key, part)), _pick(FIRST_TAILS, _number(key, part + 1)))


def _last(key: Column, part: int) -> Column:
    return F.concat(_pick(LAST_HEADS, _number(key, part)), _pick(LAST_TAILS, _number(key, part + 1)))


def email(key: Column) -> Column:
    return F.concat(F.lit("u"), F.substring(key, 1, 12), F.lit(f"@{EMAIL_DOMAIN}"))


def first_name(key: Column) -> Column:
    return _first(key, 0)


def last_name(key: Column) -> Column:
    return _last(key, 0)


def full_name(key: Column) -> Column:
    return F.concat(_first(key, 0), F.lit(" "), _last(key, 2))


def phone_number(key: Column) -> Column:
    area = (_number(key, 0) % 800 + 200).cast("string")
    return F.concat(area, F.lit("-"), _digits(_number(key, 1), 3), F.lit("-"), _digits(_number(key, 2), 4))


def street_address(key: Column) -> Column:
    house = (_number(key, 0) % 9999 + 1).cast("string")
    return F.concat_ws(" ", house, _pick(STREETS, _number(key, 1)), _pick(STREET_KINDS, _number(key, 2)))


def city(key: Column) -> Column:
    return F.concat(_pick(CITY_HEADS, _number(key, 0)), _pick(CITY_TAILS, _number(key, 1)))


def zipcode(key: Column) -> Column:
    return _digits(_number(key, 0), 5)


def date_of_birth(key: Column, as_of: str, minimum_age: int = 5, maximum_age: int = 85) -> Column:
    """A date on which the person is between the two ages, both included, on ``as_of``."""
    today = F.to_date(F.lit(as_of))
    latest = F.add_months(today, -12 * minimum_age)
    earliest = F.add_months(today, -12 * (maximum_age + 1))
    return F.date_sub(latest, (_number(key, 0) % F.datediff(latest, earliest)).cast("int"))


def user_name(key: Column) -> Column:
    return F.concat(F.lower(_first(key, 0)), F.substring(key, 33, 8))


def ipv4(key: Column) -> Column:
    parts = [(_number(key, i) % 256).cast("string") for i in range(4)]
    return F.when(key.isNotNull(), F.concat_ws(".", *parts))


def url(key: Column) -> Column:
    return F.concat(F.lit("https://"), F.substring(key, 1, 12), F.lit(".example.org/"))


_BY_KIND = {
    "email": email,
    "first_name": first_name,
    "last_name": last_name,
    "name": full_name,
    "phone_number": phone_number,
    "street_address": lambda key: F.when(key.isNotNull(), street_address(key)),
    "city": city,
    "zipcode": zipcode,
    "user_name": user_name,
    "ipv4": ipv4,
    "url": url,
}


def surrogate(kind: str, rule: str, value: Column, salt: str, as_of: str | None = None, **options) -> Column:
    """Realistic stand-in of the given kind; an unknown kind gives the constant FAKE_<KIND>."""
    key = digest(rule, value, salt)
    if kind == "date_of_birth":
        if as_of is None:
            raise ValueError("date_of_birth needs as_of")
        return date_of_birth(key, as_of, **options)
    if kind in _BY_KIND:
        return _BY_KIND[kind](key)
    return F.when(value.isNotNull(), F.lit(f"FAKE_{kind.upper()}"))


def format_preserving(rule: str, value: Column, salt: str) -> Column:
    """Replace digits by digits and ASCII letters by letters of the same case, keep the rest.

    The key text has two hex digits for each character, from one digest for
    every 32 characters, so values of any length are covered.
    """
    text = value.cast("string")
    blocks = F.sequence(F.lit(0), F.floor((F.length(text) - 1) / 32).cast("int"))
    digests = F.transform(
        blocks,
        lambda b: F.sha2(F.concat(F.lit(f"{rule}:"), text, F.lit(f":{salt}:"), b.cast("string")), 256),
    )

    def swap(char: Column, hex_digits: Column) -> Column:
        number = F.conv(hex_digits, 16, 10).cast("int")
        return (
            F.when(char.between("0", "9"), (number % 10).cast("string"))
            .when(char.between("a", "z"), F.char(number % 26 + 97))
            .when(char.between("A", "Z"), F.char(number % 26 + 65))
            .otherwise(char)
        )

    def rewrite(key: Column) -> Column:
        characters = F.transform(
            F.sequence(F.lit(1), F.length(text)),
            lambda i: swap(F.substring(text, i, F.lit(1)), F.substring(key, i * 2 - 1, F.lit(2))),
        )
        return F.array_join(characters, "")

    # the one-element array makes Spark work out the key once, not once per character
    whole = F.transform(F.array(F.array_join(digests, "")), rewrite)[0]
    return F.when(F.length(text) == 0, text).otherwise(whole)


def domain_preserving_email(rule: str, value: Column, salt: str) -> Column:
    """Surrogate local part with the original domain; text without @ gets the surrogate domain."""
    local = F.concat(F.lit("u"), F.substring(digest(rule, value, salt), 1, 12))
    domain = F.when(value.contains("@"), F.substring_index(value, "@", -1)).otherwise(F.lit(EMAIL_DOMAIN))
    return F.concat(local, F.lit("@"), domain)


def implausible_to_null(value: Column, empty=0, highest=100) -> Column:
    """A value equal to ``empty`` or above ``highest`` becomes null; others stay."""
    return F.when(value.isNull() | (value == empty) | (value > highest), None).otherwise(value)
