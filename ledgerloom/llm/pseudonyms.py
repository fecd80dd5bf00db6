"""PII: format-preserving pseudonyms by keyed Feistel networks.

Values are found by pattern and validated (check digits, calendar, number ranges). A value becomes a number below the
count of values of its format, a Feistel network with keyed rounds permutes those numbers, and the result is
written in the same format with valid check digits. Results outside the format's valid values are permuted again
(cycle walking), which keeps the mapping one to one. It depends on the key, the kind and the value alone, so equal
values stay linked across documents, and whoever holds the key can undo it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from datetime import date
from hashlib import blake2b
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import ship_code

ROUNDS = 8
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
HEX = DIGITS + "abcdef"

# The IBAN lengths of the registry.
_IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
# Month names; a name of several lists belongs to the first.
_MONTHS = [
    x.split()
    for x in (
        "January February March April May June July August September October November December",
        "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec",
        "Januar Februar März April Mai Juni Juli August September Oktober November Dezember",
        "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
        "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    )
]
_MONTH = "(?P<month>" + "|".join(sorted({x for names in _MONTHS for x in names}, key=lambda x: (-len(x), x))) + ")"

_FIRST_DAY, _LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()


def _round(key: bytes, tweak: bytes, i: int, half: int) -> int:
    digest = blake2b(tweak + bytes([i]) + half.to_bytes((half.bit_length() + 7) // 8 or 1, "big"), key=key, digest_size=32)
    return int.from_bytes(digest.digest(), "big")


def permute(x: int, n: int, key: bytes, tweak: bytes, back: bool = False) -> int:
    """A keyed permutation of 0 .. n - 1, or its inverse: a Feistel network on two nearly equal halves."""
    if n < 2:
        return x
    a = isqrt(n - 1) + 1
    b = -(-n // a)
    while True:
        left, right = divmod(x, b)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if i % 2:
                right = (right + sign * _round(key, tweak, i, left)) % b
            else:
                left = (left + sign * _round(key, tweak, i, right)) % a
        x = left * b + right
        if x < n:
            return x


def walk(x: int, n: int, valid: Callable[[int], bool], key: bytes, tweak: bytes, back: bool = False) -> int:
    """``permute`` repeated until the result is valid; a permutation of the valid numbers."""
    while True:
        x = permute(x, n, key, tweak, back)
        if valid(x):
            return x


def luhn(digits: str) -> int:
    """The check digit that completes ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced one after the other."""
    rest = iter(digits)
    return "".join(next(rest) if c in DIGITS else c for c in shape)


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def _characters(text: str, tweak: bytes, key: bytes, back: bool) -> str:
    """Each letter and digit permuted within its class, all of them together as one number."""
    classes = [next((a for a in (DIGITS, LOWER, UPPER) if c in a), None) for c in text]
    value, n = 0, 1
    for c, a in zip(text, classes):
        if a:
            value, n = value * len(a) + a.index(c), n * len(a)
    shape = "".join("." if a is None else "9aA"[(DIGITS, LOWER, UPPER).index(a)] for a in classes)
    value = permute(value, n, key, tweak + shape.encode(), back)
    out = []
    for c, a in zip(reversed(text), reversed(classes)):
        if a:
            value, at = divmod(value, len(a))
            c = a[at]
        out.append(c)
    return "".join(reversed(out))


def _alphabet(text: str, alphabet: str, tweak: bytes, key: bytes, back: bool) -> str:
    value = 0
    for c in text:
        value = value * len(alphabet) + alphabet.index(c)
    value = permute(value, len(alphabet) ** len(text), key, tweak + bytes([len(text) % 256]), back)
    out = []
    for _ in text:
        value, at = divmod(value, len(alphabet))
        out.append(alphabet[at])
    return "".join(reversed(out))


def card(match: re.Match, key: bytes, back: bool) -> str | None:
    """13 to 19 digits with a right Luhn digit; the first digit, which names the network, stays."""
    digits = _only_digits(match[0])
    if not 13 <= len(digits) <= 19 or luhn(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
        return None
    n = 10 ** (len(digits) - 2)
    inner = permute(int(digits[1:-1]), n, key, f"card{len(digits)}{digits[0]}".encode(), back)
    front = digits[0] + str(inner).zfill(len(digits) - 2)
    return _refill(match[0], front + str(luhn(front)))


def iban(match: re.Match, key: bytes, back: bool) -> str | None:
    """Country, two check digits modulo 97 and the account, whose letters and digits keep their classes.

    The words that follow may look like more groups of it: it ends at its country's length, and without a known
    length at the longest ending that is valid. Returns only what it replaces.
    """
    text = match[0]
    cuts = [i for i in range(len(text), 0, -1) if i == len(text) or text[i] == " "]
    plain = [text[:i].replace(" ", "") for i in cuts]
    fits = [_IBAN_LENGTHS.get(text[:2], len(x)) == len(x) for x in plain]
    at = next((i for i, x in enumerate(plain) if fits[i] and _valid_iban(x)), None)
    if at is None:
        return None
    country, account = plain[at][:2], plain[at][4:]
    while True:  # until no longer ending is valid, so that the way back ends at the same place
        account = _characters(account, b"iban" + country.encode(), key, back)
        whole = country + str(98 - _mod97(account + country + "00")).zfill(2) + account
        if not any(fits[i] and _valid_iban(whole + plain[i][len(whole) :]) for i in range(at)):
            break
    rest = iter(whole)
    return "".join(c if c == " " else next(rest) for c in text[: cuts[at]])


def _valid_iban(plain: str) -> bool:
    return 15 <= len(plain) <= 34 and _mod97(plain[4:] + plain[:4]) == 1


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def social(match: re.Match, key: bytes, back: bool) -> str | None:
    """Nine digits 3-2-4 in the issued ranges."""

    def valid(x: int) -> bool:
        area, group, serial = x // 10**6, x // 10**4 % 100, x % 10**4
        return area not in (0, 666) and area < 900 and group > 0 and serial > 0

    value = int(_only_digits(match[0]))
    if not valid(value):
        return None
    return _refill(match[0], str(walk(value, 9 * 10**8, valid, key, b"social", back)).zfill(9))


def phone(match: re.Match, key: bytes, back: bool) -> str | None:
    """Ten digits with area and exchange codes from 200 on; a country code in front stays."""
    digits = _only_digits(match["national"])

    def valid(x: int) -> bool:
        return x // 10**9 >= 2 and x // 10**4 % 1000 >= 200

    if len(digits) != 10 or not valid(int(digits)):
        return None
    new = str(walk(int(digits), 10**10, valid, key, b"phone", back)).zfill(10)
    return match[0][: match.start("national") - match.start()] + _refill(match["national"], new)


def foreign_phone(match: re.Match, key: bytes, back: bool) -> str | None:
    """International numbers other than +1: the digits after the country code, 6 to 12 of the groups that follow."""
    rest = match["rest"]
    ends = [m.end() for m in re.finditer(r"\d+\)?", rest) if len(_only_digits(rest[: m.end()])) <= 12]
    digits = _only_digits(rest[: ends[-1]]) if ends else ""
    if len(digits) < 6:
        return None
    new = str(permute(int(digits), 10 ** len(digits), key, f"phone{match['code']}{len(digits)}".encode(), back)).zfill(len(digits))
    return match[0][: match.start("rest") - match.start()] + _refill(rest[: ends[-1]], new) + rest[ends[-1] :]


def address(match: re.Match, key: bytes, back: bool) -> str | None:
    """Public unicast IPv4 addresses, among each other; loopback, private and reserved ones are no one's."""

    def valid(x: int) -> bool:
        first, second = x >> 24, x >> 16 & 255
        return 0 < first < 224 and first not in (10, 127) and (first, second) not in ((192, 168), (169, 254)) and not (
            first == 172 and 16 <= second < 32
        )

    octets = [int(x) for x in match[0].split(".")]
    value = int.from_bytes(bytes(octets), "big") if max(octets) < 256 else 0
    if not valid(value):
        return None
    new = walk(value, 1 << 32, valid, key, b"address", back)
    return ".".join(map(str, new.to_bytes(4, "big")))


def mail(match: re.Match, key: bytes, back: bool) -> str | None:
    """The part before the @, letters and digits in their classes; case and domain stay."""
    return _characters(match["local"], b"mail" + match["domain"].lower().encode(), key, back) + "@" + match["domain"]


def _day(year: int, month: int, day: int) -> int | None:
    try:
        value = date(year, month, day).toordinal()
    except ValueError:
        return None
    return value if _FIRST_DAY <= value <= _LAST_DAY else None


def _written(day: date, parts: tuple[str, str]) -> bool:
    """Whether day and month have as many digits as in the text; two digits each may be any."""
    return "" not in (p[1:] for p in parts) or [len(str(int(p))) for p in parts] == [len(str(x)) for x in (day.day, day.month)]


def _moved(value: int, parts: tuple[str, str], tweak: bytes, key: bytes, back: bool, valid: Callable[[date], bool] = lambda x: True) -> date:
    """Another day that is written in the same form."""
    fits = lambda x: _written(new := date.fromordinal(x + _FIRST_DAY), parts) and valid(new)
    return date.fromordinal(walk(value - _FIRST_DAY, _LAST_DAY - _FIRST_DAY + 1, fits, key, tweak, back) + _FIRST_DAY)


def iso_date(match: re.Match, key: bytes, back: bool) -> str | None:
    """Year, month, day of the calendar, 1900 to 2099."""
    value = _day(int(match["y"]), int(match["m"]), int(match["d"]))
    if value is None:
        return None
    new, s = _moved(value, (match["d"], match["m"]), b"date", key, back), match["s"]
    return f"{new.year:04}{s}{str(new.month).zfill(len(match['m']))}{s}{str(new.day).zfill(len(match['d']))}"


def day_first(match: re.Match, key: bytes, back: bool) -> str | None:
    """Day, month, year; where only month, day, year exists, in that order, and then the new date has a day past 12, too."""
    a, b, year, s = match["a"], match["b"], int(match["y"]), match["s"]
    value = _day(year, int(b), int(a))
    if value is not None:
        new = _moved(value, (a, b), b"date", key, back)
        return f"{str(new.day).zfill(len(a))}{s}{str(new.month).zfill(len(b))}{s}{new.year:04}"
    value = _day(year, int(a), int(b))
    if value is None:
        return None
    new = _moved(value, (b, a), b"month first", key, back, lambda x: x.day > 12)
    return f"{str(new.month).zfill(len(a))}{s}{str(new.day).zfill(len(b))}{s}{new.year:04}"


def _suffix(day: int) -> str:
    return "th" if 10 < day < 14 else {1: "st", 2: "nd", 3: "rd"}.get(day % 10, "th")


def named_month(match: re.Match, key: bytes, back: bool) -> str | None:
    """Day, month by name and year in either order; the new name is of the same list and form."""
    name, d = match["month"], match["d"]
    names = next(x for x in _MONTHS if name in x)
    value = _day(int(match["y"]), names.index(name) + 1, int(d))
    if value is None or match["suffix"] and match["suffix"] != _suffix(int(d)):
        return None
    same = lambda x: (x.day < 10) == (int(d) < 10) and next(y for y in _MONTHS if names[x.month - 1] in y) is names
    new = _moved(value, ("00", "00"), b"named" + names[0].encode(), key, back, same)
    parts = {"month": names[new.month - 1], "d": str(new.day).zfill(len(d)), "y": f"{new.year:04}"}
    if match["suffix"]:
        parts["suffix"] = _suffix(new.day)
    out, at = [], match.start()
    for part in sorted(parts, key=match.start):
        out += [match.string[at : match.start(part)], parts[part]]
        at = match.end(part)
    return "".join([*out, match.string[at : match.end()]])


def access_key(match: re.Match, key: bytes, back: bool) -> str | None:
    """Cloud access key ids: a four-letter prefix and 16 capitals or digits."""
    return match[0][:4] + _alphabet(match[0][4:], UPPER + DIGITS, b"access" + match[0][:4].encode(), key, back)


def secret(match: re.Match, key: bytes, back: bool) -> str | None:
    """The value after password, token, secret or api key: hexadecimal stays so, others keep character classes."""
    value = match["value"]
    if re.fullmatch(r"[0-9a-f]+", value):
        new = _alphabet(value, HEX, b"hex", key, back)
    else:
        new = _characters(value, b"secret", key, back)
    return match[0][: match.start("value") - match.start()] + new + match[0][match.end("value") - match.start() :]


# The formats, in the order in which they are tried at a place.
FORMATS: list[tuple[str, str, Callable]] = [
    ("secret", r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?)(?P<value>[A-Za-z0-9_\-+/]{8,})", secret),
    ("access_key", r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b", access_key),
    ("mail", r"(?<![\w.+-])(?P<local>[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9])?)@(?P<domain>[A-Za-z0-9](?:[A-Za-z0-9-]*\.)+[A-Za-z]{2,})", mail),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", iban),
    ("address", r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d)", address),
    ("iso_date", r"(?<![\d-])(?P<y>\d{4})(?P<s>[-/])(?P<m>\d{1,2})(?P=s)(?P<d>\d{1,2})(?![\d-])", iso_date),
    ("day_first", r"(?<![\d./-])(?P<a>\d{1,2})(?P<s>[./-])(?P<b>\d{1,2})(?P=s)(?P<y>\d{4})(?![\d-])", day_first),
    ("day_month", r"(?<![\d./-])(?P<d>\d{1,2})(?P<suffix>st|nd|rd|th)?\.? (?:of |de )?" + _MONTH + r"\.?,? (?:de )?(?P<y>\d{4})(?![\d-])", named_month),
    ("month_day", r"\b" + _MONTH + r"\.? (?P<d>\d{1,2})(?P<suffix>st|nd|rd|th)?,? (?P<y>\d{4})(?![\d-])", named_month),
    ("social", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", social),
    ("card", r"(?<![\d-])(?:\d{13,19}|\d{4}(?P<g>[ -])\d{4}(?P=g)\d{4}(?P=g)\d{1,7}|\d{4}(?P<h>[ -])\d{6}(?P=h)\d{5})(?![\d-])", card),
    ("phone", r"(?:(?<![\w+])\+?1[ .-]?)?(?<![\d-])(?P<national>\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4}|(?<=1[ .-])\d{3} \d{3} \d{4})(?![\d-])", phone),
    ("foreign_phone", r"(?<![\w+])\+(?P<code>[2-9]\d?)(?P<rest>(?:[ .-]?\(?\d+\)?){2,6})(?!\d)", foreign_phone),
]
_COMPILED = [(kind, re.compile(pattern), change) for kind, pattern, change in FORMATS]
_DIGIT = re.compile(r"[0-9]")
_NAMES = ("passw", "pwd", "secret", "token", "api_key", "api-key", "apikey")


def _possible(text: str) -> list[int]:
    """Formats that can occur in a text at all, by the characters or words they cannot do without."""
    lowered = text.lower()
    wanted = {"secret"} if any(name in lowered for name in _NAMES) else set()
    if "@" in text:
        wanted.add("mail")
    if "AKIA" in text or "ASIA" in text:
        wanted.add("access_key")
    if _DIGIT.search(text):
        wanted |= {kind for kind, _, _ in FORMATS} - {"secret", "mail", "access_key"}
    return [rank for rank, (kind, _, _) in enumerate(FORMATS) if kind in wanted]


def _matches(text: str) -> list[tuple[int, int, int, re.Match]]:
    return [(m.start(), rank, m.end(), m) for rank in _possible(text) for m in _found(rank, text)]


def _found(rank: int, text: str) -> Iterator[re.Match]:
    """Matches of a format; an IBAN may begin within what looked like an earlier one."""
    kind, pattern, _ = _COMPILED[rank]
    if kind != "iban":
        yield from pattern.finditer(text)
        return
    match = pattern.search(text)
    while match:
        yield match
        match = pattern.search(text, match.start() + 1)


def replace(text: str, key: bytes, back: bool = False) -> tuple[str, list[str]]:
    """``text`` with all validated values permuted, and their kinds in order."""
    out, kinds, at = [], [], 0
    for start, rank, end, match in sorted(_matches(text), key=lambda x: x[:2]):
        if start < at:
            continue
        kind, _, change = _COMPILED[rank]
        new = change(match, key, back)
        if new is not None:
            out += [text[at:start], new]
            kinds.append(kind)
            at = start + len(new) if kind == "iban" else end
    return "".join([*out, text[at:]]), kinds


def _run(key: bytes, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = [], []
            for text in batch.column("text"):
                text = text.as_py()
                text, kinds = (None, []) if text is None else replace(text, key)
                texts.append(text)
                found.append(kinds)
            at = batch.schema.get_field_index("text")
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.list_(pa.string()))], names=[*batch.schema.names, name])

    return run


def pseudonymised(docs: DataFrame, key: bytes = b"replace this key", kinds: str = "private_kinds") -> DataFrame:
    """``docs`` with private values in ``text`` replaced, and the column ``kinds``, the kinds of them in order.

    All other columns and rows stay as they are; a column named like ``kinds`` is replaced. NULL text stays NULL with
    no kinds, and a text without private values stays the same. Values that fail validation are not touched.
    """
    ship_code(docs.sparkSession)
    plain = docs.drop(kinds).withColumn("text", F.col("text").cast("string"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return plain.mapInArrow(_run(key, kinds), f"{fields}, `{kinds}` array<string>")
