"""Format-preserving pseudonyms for personal data.

Numbers, dates and secrets are found by their format, validated (Luhn, IBAN
check digits, calendar, number plans), and replaced through a keyed Feistel
permutation of the valid values of that format: equal values get equal
pseudonyms in every document, different values different ones, and the key
holder can invert them.  Digits move within the written form, so separators,
lengths and check digits stay right.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import bound_batches
from .textarrays import text_blocks

ROUNDS = 8


class Feistel:
    """Keyed permutation of 0..size-1 for any size, by Feistel rounds and cycle walking."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, name: str, number: int, half: int, bits: int) -> int:
        message = f"{name}|{number}|{half:x}".encode()
        return int.from_bytes(hashlib.blake2b(message, key=self.key, digest_size=32).digest(), "big") & ((1 << bits) - 1)

    def _once(self, name: str, value: int, bits: int, back: bool) -> int:
        mask = (1 << bits) - 1
        left, right = value >> bits, value & mask
        for number in range(ROUNDS):
            if back:
                left, right = right ^ self._round(name, ROUNDS - 1 - number, left, bits), left
            else:
                left, right = right, left ^ self._round(name, number, right, bits)
        return left << bits | right

    def permute(self, name: str, value: int, size: int, valid: Callable[[int], bool] | None = None, back: bool = False) -> int:
        """Image of a value; with `valid`, a permutation of the valid values only."""
        bits = max(1, ((size - 1).bit_length() + 1) // 2)
        while True:
            value = self._once(name, value, bits, back)
            if value < size and (valid is None or valid(value)):
                return value


def luhn_digit(digits: str) -> int:
    """Check digit that follows the digits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 == 0 else 1)
        total += x - 9 if x > 9 else x
    return -total % 10


def _fill(form: str, characters: str) -> str:
    """The written form with its letters and digits replaced one by one."""
    new = iter(characters)
    return "".join(next(new) if c.isalnum() else c for c in form)


def _card(f: Feistel, form: str, back: bool) -> str | None:
    digits = re.sub(r"\D", "", form)
    if not 13 <= len(digits) <= 19 or digits[0] == "0" or len(set(digits)) == 1 or luhn_digit(digits[:-1]) != int(digits[-1]):
        return None
    inner = len(digits) - 2
    body = digits[0] + str(f.permute(f"card{inner}{digits[0]}", int(digits[1:-1]), 10**inner, back=back)).zfill(inner)
    return _fill(form, body + str(luhn_digit(body)))


#: Country calling codes of one and two digits (fixed values of the numbering plan); all others have three.
ONE_DIGIT_CODES = ("1", "7")
TWO_DIGIT_CODES = (
    "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58",
    "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98",
)


def country_code(digits: str) -> str:
    """Calling code at the beginning of an international number."""
    return digits[:1] if digits[:1] in ONE_DIGIT_CODES else digits[:2] if digits[:2] in TWO_DIGIT_CODES else digits[:3]


def _phone(f: Feistel, form: str, back: bool) -> str | None:
    digits = re.sub(r"\D", "", form)
    if not 8 <= len(digits) <= 15:
        return None
    if len(digits) == 11 and digits[0] == "1" or len(digits) == 10 and form[0] != "+":  # the North American plan
        head, tail = digits[:-10], digits[-10:]
        in_plan = lambda x: x // 10**9 >= 2 and x // 10**6 % 10 >= 2
        # Numbers outside the plan are permuted among themselves, so that both maps can be inverted.
        name, valid = ("nanp", in_plan) if in_plan(int(tail)) else ("nanp-other", lambda x: not in_plan(x))
        return _fill(form, head + str(f.permute(name, int(tail), 10**10, valid, back)).zfill(10))
    if form[0] != "+":
        return None
    head = country_code(digits)
    tail = digits[len(head) :]
    return _fill(form, head + str(f.permute(f"phone{head}-{len(tail)}", int(tail), 10 ** len(tail), back=back)).zfill(len(tail)))


def _ssn_valid(x: int) -> bool:
    area, group, serial = x // 10**6, x // 10**4 % 100, x % 10**4
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def _ssn(f: Feistel, form: str, back: bool) -> str | None:
    value = int(form.replace("-", ""))
    return _fill(form, str(f.permute("ssn", value, 10**9, _ssn_valid, back)).zfill(9)) if _ssn_valid(value) else None


def _ip(f: Feistel, form: str, back: bool) -> str | None:
    parts = [int(x) for x in form.split(".")]
    if max(parts) > 255 or parts[0] == 0 or any(len(x) > 1 and x[0] == "0" for x in form.split(".")):
        return None
    value = f.permute(f"ip{parts[0]}", parts[1] << 16 | parts[2] << 8 | parts[3], 1 << 24, back=back)
    return f"{parts[0]}.{value >> 16}.{value >> 8 & 255}.{value & 255}"


def _iban_rest(country: str, body: str) -> int:
    return int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def _iban(f: Feistel, form: str, back: bool) -> str | None:
    plain = form.replace(" ", "")
    country, check, body = plain[:2], plain[2:4], plain[4:]
    if not 15 <= len(plain) <= 34 or 98 - _iban_rest(country, body) != int(check):
        return None
    sizes = [10 if c.isdigit() else 26 for c in body]
    body = _mixed(f, "iban" + country, body, sizes, back)
    return _fill(form, country + str(98 - _iban_rest(country, body)).zfill(2) + body)


def _mixed(f: Feistel, name: str, text: str, sizes: list[int], back: bool) -> str:
    """Permute a run of letters and digits among those with the same pattern of cases."""
    size, value = 1, 0
    for c, n in zip(text, sizes, strict=True):
        size *= n
        value = value * n + (int(c) if n == 10 else ord(c.lower()) - 97)
    value = f.permute(name + "".join("d" if n == 10 else "a" for n in sizes), value, size, back=back)
    out = []
    for c, n in zip(reversed(text), reversed(sizes), strict=True):
        value, x = divmod(value, n)
        out.append(str(x) if n == 10 else chr(97 + x).upper() if c.isupper() else chr(97 + x))
    return "".join(reversed(out))


def _email(f: Feistel, form: str, back: bool) -> str | None:
    local, _, domain = form.rpartition("@")
    inner = "".join(c for c in local if c.isascii() and c.isalnum())
    if not inner or ".." in form:
        return None
    return _fill(local, _mixed(f, "email", inner, [10 if c.isdigit() else 26 for c in inner], back)) + "@" + domain


#: Years whose dates are permuted among themselves, and so are those of all other years.
_USUAL, _YEARS = range(1900, 2100), range(1, 10_000)
#: Months and days that a pseudonym stays within: with a digit or two, and days above 12, which tell the order of a form.
_MONTHS = (range(1, 10), range(10, 13))
_DAYS = (range(1, 10), range(10, 13), range(13, 32))


def _exists(year: int, month: int, day: int) -> bool:
    try:
        dt.date(year, month, day)
    except ValueError:
        return False
    return True


def _date(f: Feistel, form: str, back: bool) -> str | None:
    """One date has one pseudonym, in whatever form it is written, and is read back from each.

    Every form can write every date of a class: months below 10 or from 10,
    days below 10, to 12, or above, which are permuted among themselves.  A form
    with two numbers up to 12 has the day first.
    """
    separator = next(c for c in form if not c.isdigit())
    parts = form.split(separator)
    order = (0, 1, 2) if len(parts[0]) == 4 else (2, 0, 1) if int(parts[1]) > 12 else (2, 1, 0)  # where year, month and day stand
    year, month, day = (int(parts[i]) for i in order)
    if not _exists(year, month, day):
        return None
    usual = year in _USUAL
    years = _USUAL if usual else _YEARS
    months, days = (next(r for r in ranges if n in r) for ranges, n in ((_MONTHS, month), (_DAYS, day)))

    def read(x: int) -> tuple[int, int, int]:
        x, d = divmod(x, len(days))
        y, m = divmod(x, len(months))
        return years[y], months[m], days[d]

    def valid(x: int) -> bool:
        return _exists(*(found := read(x))) and (found[0] in _USUAL) == usual

    value = ((year - years[0]) * len(months) + month - months[0]) * len(days) + day - days[0]
    new = read(f.permute(f"date{usual}{months[0]}{days[0]}", value, len(years) * len(months) * len(days), valid, back))
    for i, n, old in zip(order, new, [parts[i] for i in order], strict=True):
        parts[i] = f"{n:0{len(old)}d}"
    return separator.join(parts)


def _secret(f: Feistel, form: str, back: bool) -> str | None:
    """The last run of letters and digits: an access key id by base 36, else hexadecimal digits of the case they have."""
    at = len(form) - len(re.search(r"[A-Za-z0-9]+$", form)[0])
    body = form[at:]
    keep, digits = ("AKIA", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ") if body.startswith("AKIA") else ("", "0123456789ABCDEF" if body.isupper() else "0123456789abcdef")
    inner, base = body[len(keep) :], len(digits)
    value = f.permute(f"secret{keep}{len(inner)}", int(inner, base), base ** len(inner), back=back)
    out = []
    for _ in inner:
        value, x = divmod(value, base)
        out.append(digits[x])
    return form[:at] + keep + "".join(reversed(out))


_AFTER_COUNTRY = r"(?:(?<=\+[0-9])|(?<=\+[0-9]{2})|(?<=\+[0-9]{3}))"
_IN_PHONE = (
    r"[ -](?=[0-9]{2})|\.(?=[0-9]{2,4}(?![0-9]))"  # after a point short groups only: not the decimals of a signed number
    rf"|{_AFTER_COUNTRY}(?:[ -]|[ .-]?\((?=[0-9]{{1,4}}\)))"
    r"|(?:(?<=\([0-9])|(?<=\([0-9]{2})|(?<=\([0-9]{3})|(?<=\([0-9]{4}))\)[ .-]?"
)
#: Digits alone after a plus; +1 with ten digits; a plus and 8 to 15 digits in groups; three, three and four digits.
_PHONE = "|".join(
    (
        r"(?<![\w+])\+(?:[0-9]{10,15}|[0-9]{8,9}(?![ .-][0-9]))(?!\w)",
        r"(?<![\w+])\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?!\w)",
        rf"(?<![\w+])\+[0-9](?:(?:{_IN_PHONE})?[0-9]){{7,14}}(?!\w)",
        r"(?<![\w+])\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}(?![\w-])",
        r"(?<![\w.-])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![\w-])",
    )
)


#: In this order, the first that fits at a place is tried; a form that isn't valid stays as it is.
KINDS: tuple[tuple[str, str, Callable[[Feistel, str, bool], str | None]], ...] = (
    ("secret", r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])|(?<![A-Za-z])(?:[Tt]oken|[Ss]ecret|[Pp]assword|[Pp]asswd|[Aa]pi[_-]?[Kk]ey)\s{0,3}[=:]\s{0,3}[\"']?(?:[0-9a-f]{16,64}|[0-9A-F]{16,64})(?![0-9A-Za-z])", _secret),
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])", _email),
    ("iban", r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)", _iban),
    ("ip", r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9])", _ip),
    ("date", r"(?<![\w/.-])(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})(?:(?![\w/-]|\.[0-9])|(?=T[0-9]{2}:[0-9]{2}))", _date),
    ("ssn", r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])", _ssn),
    ("phone", _PHONE, _phone),
    ("card", r"(?<![\w-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-])", _card),
)


def _pattern(names: tuple[str, ...]) -> re.Pattern:
    parts, groups = [], 0
    for name, pattern, _ in KINDS:
        if name in names:
            inner = re.compile(pattern).groups
            for i in range(inner, 0, -1):
                pattern = pattern.replace(f"\\{i}", f"\\{groups + 1 + i}")
            parts.append(f"(?P<{name}>{pattern})")
            groups += 1 + inner
    return re.compile("|".join(parts))


_KEYWORD = re.compile(rb"(?:[Tt]oken|[Ss]ecret|[Pp]assword|[Pp]asswd|[Aa]pi[_-]?[Kk]ey)\s{0,3}$")
_WORD, _LOCAL, _UPPER, _DIGIT = (np.zeros(256, dtype=bool) for _ in range(4))
_DIGIT[48:58] = _UPPER[65:91] = True
_WORD[np.frombuffer(b"_0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", np.uint8)] = True
_LOCAL[:] = _WORD
_LOCAL[np.frombuffer(b".%+-", np.uint8)] = True


def possible_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, code point in its text), ascending, of all places at which a pattern of KINDS can begin.

    Numbers begin at a digit after no word character, or at a plus or a bracket
    before a digit; account numbers at two capitals before two digits; mail
    addresses at the beginning of a run of their characters before an at sign;
    secrets at AKIA, or at a keyword before a sign of assignment.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    padded = np.concatenate((data, np.zeros(4, np.uint8)))
    digit, upper = _DIGIT[padded], _UPPER[padded]
    start = digit[:n].copy()
    start[1:] &= ~_WORD[data[:-1]]
    start |= ((data == 43) | (data == 40)) & digit[1 : n + 1]
    start |= upper[:n] & upper[1 : n + 1] & digit[2 : n + 2] & digit[3 : n + 3]
    start |= (data == 65) & (padded[1 : n + 1] == 75) & (padded[2 : n + 2] == 73) & (padded[3 : n + 3] == 65)
    begins = offsets[(offsets > 0) & (offsets < n)]
    start[begins] |= digit[:n][begins]
    at = np.flatnonzero(data == 64)
    if len(at):
        outside = np.flatnonzero(~_LOCAL[data])
        bounds = np.union1d(np.concatenate(([0], outside + 1)), begins)
        start[bounds[np.searchsorted(bounds, at, side="right") - 1]] = True
    start = np.flatnonzero(start)
    assigned = []
    for sign in np.flatnonzero((data == 61) | (data == 58)).tolist():
        before = data[max(0, sign - 16) : sign].tobytes()
        # White space beyond ASCII takes more bytes, so any keyword near the sign will do.
        if found := _KEYWORD.search(before) or (before.isascii() is False and re.search(_KEYWORD.pattern[: -len(rb"\s{0,3}$")], before)):
            assigned.append(sign - len(before) + found.start())
    start = np.union1d(start, np.array(assigned, dtype=np.int64))
    row = np.searchsorted(offsets, start, side="right") - 1
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))  # code points before each byte
    return row, points[start] - points[offsets[row]]


class Pseudonymizer:
    """Replace (or, with `back`, restore) the personal data of single texts."""

    def __init__(self, key: bytes, kinds: tuple[str, ...] = tuple(k for k, _, _ in KINDS)):
        self.feistel = Feistel(key)
        self.pattern = _pattern(kinds)
        self.makers = {name: maker for name, _, maker in KINDS if name in kinds}

    def __call__(self, text: str, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
        """New text, and (kind, start, end) in it of each replaced value."""
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        return self.replace(text, possible_starts(data, np.array([0, len(data)]))[1].tolist(), back)

    def replace(self, text: str, starts: list[int], back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
        """The same, with the places at which a value can begin given."""
        parts, spans, at, size, free = [], [], 0, 0, 0
        for start in starts:
            if start < free or (match := self.pattern.match(text, start)) is None:
                continue
            free = match.end()
            kind = next(k for k in self.makers if match[k] is not None)
            new = self.makers[kind](self.feistel, match[0], back)
            if new is not None:
                parts += [text[at:start], new]
                size += start - at
                spans.append((kind, size, size + len(new)))
                size += len(new)
                at = free
        return ("".join(parts) + text[at:], spans) if spans else (text, spans)


_SPAN = "array<struct<kind: string, start: int, end: int>>"


def pseudonymize(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, spans) of each row; spans of code points in the new text.

    Null texts stay null and empty ones empty, without spans.  Null ids and
    repeated rows are kept.  Other columns of `docs` are ignored.
    """

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pseudonymizer = Pseudonymizer(key)
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            texts = batch.column("text")
            spans: list[list] = [[] for _ in range(len(texts))]
            new: dict[int, str] = {}
            for first, _, data, offsets in text_blocks(texts):
                row, start = possible_starts(data, offsets)
                cuts = np.append(np.flatnonzero(np.diff(row, prepend=-1)), len(row))
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    at = first + int(row[a])
                    text, found = pseudonymizer.replace(texts[at].as_py(), start[a:b].tolist())
                    if found:
                        new[at] = text
                        spans[at] = [{"kind": k, "start": x, "end": y} for k, x, y in found]
            if new:
                values = texts.to_pylist()
                for row, text in new.items():
                    values[row] = text
                texts = pa.array(values, texts.type)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts, pa.array(spans, span)], names=["doc_id", "text", "spans"])

    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(replace, f"doc_id long, text string, spans {_SPAN}")
