"""Format-preserving pseudonyms of personal numbers and dates.

A value that passes its kind's check is mapped to another valid value of its format by a keyed
Feistel network, so equal values get equal pseudonyms in all documents, different ones different
ones, and whoever has the key can go back. The map is a function of key, kind and value alone:
nothing is looked up or gathered, and a task that runs again writes the same text.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutela.llm.words import chunks

ROUNDS = 10
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


def permute(value: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of 0 .. size - 1: a Feistel network on pairs (value div b, value mod b),
    walked on while the result lies outside."""
    if size < 2:
        return value
    b = isqrt(size - 1) + 1
    a = -(-size // b)
    rounds = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    while True:
        left, right = divmod(value, b)
        for i in rounds:
            half = right if i % 2 == 0 else left
            mask = int.from_bytes(hashlib.blake2b(
                f"{tweak}|{size}|{i}|{half}".encode(), key=key, digest_size=32).digest(), "big")
            mask = -mask if back else mask
            if i % 2 == 0:
                left = (left + mask) % a
            else:
                right = (right + mask) % b
        value = left * b + right
        if value < size:
            return value


def _mixed(text: str, key: bytes, tweak: str, back: bool) -> str:
    """Permutes the digits and letters of a text, each within its class; others stay."""
    classes = [next((c for c in ("0123456789", "abcdefghijklmnopqrstuvwxyz",
                                 "ABCDEFGHIJKLMNOPQRSTUVWXYZ") if ch in c), "") for ch in text]
    value, size = 0, 1
    for ch, c in zip(text, classes):
        if c:
            value, size = value * len(c) + c.index(ch), size * len(c)
    shape = "".join(c[:1] or ch for ch, c in zip(text, classes))
    value, out = permute(value, size, key, f"{tweak}|{shape}", back), []
    for ch, c in zip(reversed(text), reversed(classes)):
        if c:
            value, digit = divmod(value, len(c))
            ch = c[digit]
        out.append(ch)
    return "".join(reversed(out))


def _reform(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    left = iter(digits)
    return "".join(next(left) if ch.isdigit() else ch for ch in shape)


def luhn_digit(payload: str) -> str:
    total = 0
    for i, ch in enumerate(reversed(payload)):
        d = int(ch) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _digits(digits: str, key: bytes, tweak: str, back: bool) -> str:
    n = len(digits)
    return str(permute(int(digits), 10 ** n, key, f"{tweak}|{n}", back)).zfill(n)


def card(text: str, key: bytes, back: bool = False) -> str | None:
    """13 to 19 digits with a right Luhn digit; the first digit stays, the last one follows."""
    digits = re.sub(r"\D", "", text)
    if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    payload = digits[0] + _digits(digits[1:-1], key, "card", back)
    return _reform(text, payload + luhn_digit(payload))


#: Country calling codes of one and two digits; all others have three (ITU E.164).
SHORT_CODES = ("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 "
               "61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98").split()
#: Three digits that can begin an area or exchange of the North American plan.
PLAN = [n for n in range(200, 1000) if n % 100 != 11]


def calling_code(digits: str) -> str:
    return next((c for c in (digits[:1], digits[:2]) if c in SHORT_CODES), digits[:3])


def _planned(digits: str) -> bool:
    """Is it ten digits of the North American plan: area and exchange begin with 2 to 9 and do not
    end with 11?"""
    return len(digits) == 10 and int(digits[:3]) in PLAN and int(digits[3:6]) in PLAN


def _plan_number(digits: str, key: bytes, back: bool) -> str:
    n = len(PLAN)
    value = (PLAN.index(int(digits[:3])) * n + PLAN.index(int(digits[3:6]))) * 10_000 \
        + int(digits[6:])
    value, last = divmod(permute(value, n * n * 10_000, key, "national", back), 10_000)
    return f"{PLAN[value // n]}{PLAN[value % n]}{last:04}"


def phone(text: str, key: bytes, back: bool = False) -> str | None:
    """An international number of 8 to 15 digits. The country's calling code stays; the rest depends on
    its digits alone, so all spellings of a number have one pseudonym, and a number of the North
    American plan the same with and without +1."""
    digits = re.sub(r"\D", "", text)
    if not 8 <= len(digits) <= 15:
        return None
    code = calling_code(digits)
    rest = digits[len(code):]
    if code == "1" and _planned(rest):
        return _reform(text, code + _plan_number(rest, key, back))
    while True:  # numbers outside the plan stay outside it, or two could meet
        rest = _digits(rest, key, f"phone{code}", back)
        if code != "1" or not _planned(rest):
            return _reform(text, code + rest)


def national(text: str, key: bytes, back: bool = False) -> str | None:
    """A number of the North American plan without a plus."""
    digits = re.sub(r"\D", "", text)
    if not _planned(digits[-10:]):
        return None
    return _reform(text, digits[:-10] + _plan_number(digits[-10:], key, back))


def address(text: str, key: bytes, back: bool = False) -> str | None:
    """Four numbers up to 255 without leading zeros: an IPv4 address."""
    parts = text.split(".")
    if any(int(p) > 255 or str(int(p)) != p for p in parts):
        return None
    value = int.from_bytes(bytes(map(int, parts)), "big")
    return ".".join(map(str, permute(value, 1 << 32, key, "ip", back).to_bytes(4, "big")))


def social(text: str, key: bytes, back: bool = False) -> str | None:
    """A US social security number of an area, group and serial that are given out."""
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    areas = [a for a in range(1, 900) if a != 666]
    value = (areas.index(area) * 99 + group - 1) * 9999 + serial - 1
    value, serial = divmod(permute(value, len(areas) * 99 * 9999, key, "ssn", back), 9999)
    area, group = divmod(value, 99)
    return f"{areas[area]:03}-{group + 1:02}-{serial + 1:04}"


def _iban_check(country: str, account: str) -> int:
    return 98 - int("".join(str(int(ch, 36)) for ch in account + country + "00")) % 97


#: Lengths of the countries' account numbers (ISO 13616).
IBAN_LENGTHS = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 "
    "EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IS26 IT27 JO30 KW30 "
    "KZ20 LB28 LC32 LI21 LT20 LU20 LV21 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 "
    "PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
).split()}


def own_length(text: str) -> str:
    """The part of a text that has the length of its country's account numbers, if it ends a word
    there; a capital word may follow it."""
    ends = [i + 1 for i, ch in enumerate(text) if ch != " "]
    n = IBAN_LENGTHS.get(text[:2], len(ends))
    if n >= len(ends) or text[ends[n - 1]] != " ":
        return text
    return text[:ends[n - 1]]


def iban(text: str, key: bytes, back: bool = False) -> str | None:
    """Country and account with right check digits, which follow the pseudonym."""
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or int("".join(
            str(int(ch, 36)) for ch in plain[4:] + plain[:4])) % 97 != 1:
        return None
    account = _mixed(plain[4:], key, f"iban{plain[:2]}", back)
    fresh = iter(f"{plain[:2]}{_iban_check(plain[:2], account):02}{account}")
    return "".join(" " if ch == " " else next(fresh) for ch in text)


def _widths(day: datetime.date) -> tuple[bool, bool, bool]:
    return day.month < 10, day.day < 10, day.day > 12


def day(text: str, key: bytes, back: bool = False) -> str | None:
    """A day of 1900 to 2099 as year-month-day, day.month.year, month/day/year or, where that is
    none, day/month/year, with or without leading zeros. One day has one pseudonym in all
    spellings; the widths of month and day, and a day above 12, are kept, so each can be undone."""
    parts = re.split(r"\D", text)
    mark = re.search(r"\D", text).group()
    for order in {"-": ((0, 1, 2),), ".": ((2, 1, 0),), "/": ((2, 0, 1), (2, 1, 0))}[mark]:
        try:
            old = datetime.date(*(int(parts[i]) for i in order))
            break
        except ValueError:
            continue
    else:
        return None
    value = old.toordinal()
    if not FIRST_DAY <= value <= LAST_DAY:
        return None
    while True:  # walked on while the day is not of the same widths
        value = FIRST_DAY + permute(value - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, key, "day", back)
        new = datetime.date.fromordinal(value)
        if _widths(new) == _widths(old):
            break
    fresh = {i: f"{v:0{len(parts[i])}}" for i, v in zip(order, (new.year, new.month, new.day))}
    return mark.join(fresh[i] for i in range(3))


def mail(text: str, key: bytes, back: bool = False) -> str | None:
    """Letters and digits of the name before the @; the domain stays."""
    name, _, domain = text.rpartition("@")
    return f"{_mixed(name, key, 'mail' + domain.lower(), back)}@{domain}"


def secret(text: str, key: bytes, back: bool = False) -> str | None:
    """A hexadecimal number of 32 to 64 digits that is assigned to a token, key or password."""
    value, n = int(text, 16), len(text)
    if text != text.lower() and text != text.upper():
        return None
    new = f"{permute(value, 16 ** n, key, f'hex{n}', back):x}".zfill(n)
    return new.upper() if text != text.lower() else new


KINDS: dict[str, tuple[str, Callable]] = {
    "mail": (r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", mail),
    "secret": (r"(?<=[=:])(?P<lead>\s*[\"']?)[0-9A-Fa-f]{32,64}(?![0-9A-Za-z])", secret),
    "iban": (r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)", iban),
    "address": (r"(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])(?![A-Za-z_])", address),
    "day": (r"(?<![\w./-])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}"
            r"|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})(?:(?=T[0-9]{2}:?[0-9]{2})|(?![\w/-])(?!\.[0-9]))", day),
    "social": (r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])", social),
    "national": (r"(?<![\w+(.-])(?:1[ .-])?(?:\([2-9][0-9]{2}\) ?[2-9][0-9]{2}[ .-]|[2-9][0-9]{2}([ .-])"
                 r"[2-9][0-9]{2}\1)[0-9]{4}(?![\w-])(?!\.[0-9])", national),
    "phone": (r"(?<!\w)\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,5}"
              r"(?![0-9])", phone),
    "card": (r"(?<![0-9.-])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}"
             r"|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9]|[.-][0-9])", card),
}


KEY_SETTING = "spark.tutela.pseudonym.key"
DEMONSTRATION_KEY = "for tests and supplied tables only"


def session_key(spark: SparkSession, default: str | None = None) -> bytes:
    """64 bytes made of the key in the session's settings. Without one, or with an empty one, there
    are no pseudonyms; only the supplied tables may be given ``DEMONSTRATION_KEY`` as default, which
    hides nothing."""
    text = spark.conf.get(KEY_SETTING, None) or default
    if not text:
        raise ValueError(f"set {KEY_SETTING} to a secret key")
    return hashlib.blake2b(text.encode(), digest_size=64).digest()


def _pattern() -> re.Pattern:
    parts, groups = [], 0
    for name, (pattern, _) in KINDS.items():
        own = re.compile(pattern).groups
        shifted = re.sub(r"\\([12])", lambda m: f"\\{int(m[1]) + groups + 1}", pattern)
        parts.append(f"(?P<{name}>{shifted})")
        groups += own + 1
    return re.compile("|".join(parts), re.ASCII)


_ALL = _pattern()


def pseudonymise(text: str, key: bytes, back: bool = False) -> tuple[str, list[str]]:
    """The text with pseudonyms, and the kind of each value replaced, in order."""
    kinds: list[str] = []
    out: list[str] = []
    at = 0
    while found := _ALL.search(text, at):
        kind = found.lastgroup if found.lastgroup != "lead" else "secret"
        begin = found.start() + (len(found["lead"] or "") if kind == "secret" else 0)
        value, new = text[begin:found.end()], None
        if kind == "iban":  # what follows the country's own length is searched again
            own = own_length(value)
            new = iban(own, key, back)
            value = own if new is not None else value
        new = KINDS[kind][1](value, key, back) if new is None else new
        out += [text[at:begin], value if new is None else new]
        if new is not None:
            kinds.append(kind)
        at = begin + len(value)
    return "".join([*out, text[at:]]), kinds


_HINT = re.compile(r"[0-9@]")


def _run(others: list[str], key: bytes, back: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                texts, kinds = [], []
                for text in part.column("text").to_pylist():
                    found: list[str] = []
                    if text and _HINT.search(text):
                        text, found = pseudonymise(text, key, back)
                    texts.append(text)
                    kinds.append(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts, pa.string()) if c == "text" else part.column(c)
                     for c in others] + [pa.array(kinds, pa.list_(pa.string()))],
                    names=[*others, "kinds"])
    return run


def pseudonyms(docs: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """The rows of (text, ...) with pseudonyms in ``text`` and ``kinds`` (array of the kinds
    replaced). ``back`` undoes it under the same key. A null text stays null, an empty one empty; a
    value that fails its kind's check stays; rows that repeat are changed alike and all come back,
    an empty table gives none; other columns come back, a column ``kinds`` is replaced."""
    others = [c for c in docs.columns if c != "kinds"]
    docs = docs.select(*others).withColumn("text", F.col("text").cast("string"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema),
                        "kinds array<string>"])
    return docs.mapInArrow(_run(others, key, back), schema)
