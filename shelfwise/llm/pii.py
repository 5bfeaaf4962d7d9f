"""Personal data replaced by format-preserving pseudonyms: keyed Feistel permutations within each format."""

from __future__ import annotations

import datetime as dt
import hashlib
import ipaddress
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Memo

ROUNDS = 8
KINDS = ("email", "card", "iban", "ssn", "phone", "ip", "date", "secret")

_FIRST_DAY = dt.date(1900, 1, 1).toordinal()
_DAYS = dt.date(2100, 1, 1).toordinal() - _FIRST_DAY
_MONTHS = "January February March April May June July August September October November December".split()
_MONTH = "|".join(_MONTHS)
_DIGITS = "0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()

#: what may be personal data; each find is validated before it is replaced
_FINDER = re.compile(
    rf"""
    (?P<email>[A-Za-z0-9._%+-]{{1,64}}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,}})
    |(?P<aws>\b(?:AKIA|ASIA)[A-Z0-9]{{16}}\b)
    |(?P<named>(?i:\b(?:password|passwd|pwd|secret|token|api_?key)\b["']?[ \t]*[=:][ \t]*["']?)(?P<value>[A-Za-z0-9_\-/+]{{8,}}))
    |(?P<hex>\b(?:[0-9a-f]{{64}}|[0-9a-f]{{40}}|[0-9a-f]{{32}})\b)
    |(?P<iban>\b[A-Z]{{2}}[0-9]{{2}}(?:[ ]?[A-Z0-9]{{4}}){{2,7}}(?:[ ]?[A-Z0-9]{{1,3}})?\b)
    |(?P<iso>(?<![\d.-])(?:19|20)\d\d(?P<sep>[-/.])(?:0[1-9]|1[0-2])(?P=sep)(?:0[1-9]|[12]\d|3[01])(?![\d-]))
    |(?P<dmy>(?<![\d.-])(?P<one>[0-3]?\d)(?P<dsep>[/.-])(?P<two>[0-3]?\d)(?P=dsep)(?:19|20)\d\d(?![\d-]))
    |(?P<named_day>\b(?:{_MONTH})\ [0-3]?\d,\ (?:19|20)\d\d\b|\b[0-3]?\d\ (?:{_MONTH})\ (?:19|20)\d\d\b)
    |(?P<ip>(?<![\d.])(?:\d{{1,3}}\.){{3}}\d{{1,3}}(?![\d]|\.\d))
    |(?P<ssn>(?<![\d-])\d{{3}}-\d{{2}}-\d{{4}}(?![\d-]))
    |(?P<card>(?<!\d)(?:\d{{13,19}}|\d{{4}}(?P<csep>[ -])(?:\d{{4}}(?P=csep)\d{{4}}(?P=csep)\d{{1,7}}|\d{{6}}(?P=csep)\d{{4,5}}))(?!\d))
    |(?P<phone>(?<![\w+])(?:\+\d{{1,3}}[ .-]?(?:\(\d{{2,4}}\)[ .-]?|\d{{2,4}}[ .-])\d{{3,4}}[ .-]\d{{3,4}}
        |\(\d{{3}}\)[ .-]?\d{{3}}[ .-]\d{{4}}|\d{{3}}(?P<psep>[.-])\d{{3}}(?P=psep)\d{{4}})(?![\d]|-\d))
    |(?P<intl>(?<![\w+])\+\d{{1,3}}(?:[ .-]?\d){{7,12}}(?!\d))
    """,
    re.VERBOSE,
)
#: each find has one of these and lies within a line
_HINT = re.compile(r"[0-9@]")
#: length of an IBAN by country; of others any end of a group is tried
_IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24,
    "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29,
    "VG": 24, "XK": 20,
}
#: country calling codes of one and of two digits; all others have three
_SHORT_CODES = {"1", "7"}
_TWO_DIGIT_CODES = set(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
    "81 82 84 86 90 91 92 93 94 95 98".split()
)
_HEX = re.compile(r"[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32}")
#: longer strings are permuted in parts of this length
_PART = 64


class Feistel:
    """Keyed permutations of {0, ..., n - 1}.

    An alternating Feistel network over two halves of about equal size, with a keyed hash
    as its round function; values that leave the range walk on along the cycle until they are
    in it again, so the permutation is exact for any n. The format is part of the tweak.
    """

    def __init__(self, key: bytes) -> None:
        self.key = key[:64]

    def _round(self, tweak: bytes, number: int, half: int, size: int) -> int:
        data = tweak + bytes([number]) + half.to_bytes((half.bit_length() + 8) // 8, "big")
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=64).digest(), "big") % size

    def _network(self, value: int, a: int, b: int, tweak: bytes, back: bool) -> int:
        left, right = divmod(value, b)
        for number in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if number % 2:
                right = (right + sign * self._round(tweak, number, left, b)) % b
            else:
                left = (left + sign * self._round(tweak, number, right, a)) % a
        return left * b + right

    def permute(self, value: int, n: int, tweak: str, back: bool = False) -> int:
        if n < 2:
            return value
        a = max(2, int(n**0.5) if n < 1 << 50 else 1 << (n.bit_length() // 2))
        b = -(-n // a)
        mark = f"{tweak}|{n}".encode()
        while True:
            value = self._network(value, a, b, mark, back)
            if value < n:
                return value

    def among(self, value: int, n: int, tweak: str, valid: Callable[[int], bool], back: bool = False) -> int:
        """A permutation of the valid values: walks on until one is reached."""
        while True:
            value = self.permute(value, n, tweak, back)
            if valid(value):
                return value


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _check_digit(body: str) -> str:
    return next(d for d in _DIGITS if luhn(body + d))


def _iban_number(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4]))


def _ssn_valid(n: int) -> bool:
    area, group, serial = n // 1_000_000, n // 10_000 % 100, n % 10_000
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def _refill(shape: str, digits: str, kind: str = _DIGITS) -> str:
    """shape with its characters of a kind replaced in turn; separators stay."""
    given = iter(digits)
    return "".join(next(given) if c in kind else c for c in shape)


class Pseudonyms:
    """Replaces finds of one text after the other; equal values become equal values everywhere."""

    def __init__(self, key: bytes, back: bool = False) -> None:
        self.feistel, self.back = Feistel(key), back
        self.memo = Memo(self._made, 200_000)

    def _digits(self, shape: str, tweak: str) -> str:
        digits = "".join(c for c in shape if c in _DIGITS)
        moved = self.feistel.permute(int(digits), 10 ** len(digits), f"{tweak}{len(digits)}", self.back)
        return _refill(shape, str(moved).zfill(len(digits)))

    def _letters(self, shape: str, tweak: str, hexadecimal: bool = False) -> str:
        """Each digit, small and capital letter becomes one of its kind."""
        if len(shape) > _PART:
            head, rest = shape[:_PART], shape[_PART:]
            return self._letters(head, tweak, hexadecimal) + self._letters(rest, tweak + "+", hexadecimal)
        kinds = [_DIGITS + "abcdef"] if hexadecimal else [_DIGITS, _LOWER, _UPPER]
        own = [next((k for k in kinds if c in k), None) for c in shape]
        n, value = 1, 0
        for c, kind in zip(shape, own, strict=True):
            if kind:
                value, n = value * len(kind) + kind.index(c), n * len(kind)
        # the pattern of kinds is part of the format
        pattern = "".join("-" if k is None else str(kinds.index(k)) for k in own)
        moved = self.feistel.permute(value, n, f"{tweak}{pattern}", self.back)
        out = []
        for c, kind in zip(reversed(shape), reversed(own), strict=True):
            if kind:
                moved, at = divmod(moved, len(kind))
                c = kind[at]
            out.append(c)
        return "".join(reversed(out))

    def _day(self, day: dt.date) -> dt.date:
        """Days above 12 and others are permuted apart, as notations that tell day and month by that stay readable."""
        late = day.day > 12
        at = self.feistel.among(
            day.toordinal() - _FIRST_DAY,
            _DAYS,
            "late" if late else "early",
            lambda n: (dt.date.fromordinal(n + _FIRST_DAY).day > 12) == late,
            self.back,
        )
        return dt.date.fromordinal(at + _FIRST_DAY)

    def _made(self, find: tuple[str, str]) -> str | None:
        """The pseudonym of a find, or None if it is no valid value of its kind."""
        kind, text = find
        return getattr(self, f"_{kind}")(text)

    def _email(self, text: str) -> str:
        local, _, domain = text.rpartition("@")
        return self._letters(local, "email") + "@" + domain

    def _aws(self, text: str) -> str:
        return text[:4] + self._letters(text[4:], "key")

    def _value(self, text: str) -> str | None:
        """A named secret; words are none."""
        if not any(c in _DIGITS for c in text):
            return None
        return self._letters(text, "value", hexadecimal=bool(_HEX.fullmatch(text)))

    def _hex(self, text: str) -> str | None:
        if text.isdigit() or text.isalpha():
            return None
        return self._letters(text, "value", hexadecimal=True)

    def _iban(self, text: str) -> str | None:
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or _iban_number(plain) % 97 != 1:
            return None
        body = self._letters(plain[4:], plain[:2])
        check = 98 - _iban_number(plain[:2] + "00" + body) % 97
        made = iter(f"{plain[:2]}{check:02d}{body}")
        return "".join(c if c == " " else next(made) for c in text)

    def _iso(self, text: str) -> str | None:
        year, month, day = (int(p) for p in re.split(r"\D", text))
        try:
            moved = self._day(dt.date(year, month, day))
        except ValueError:
            return None
        return f"{moved.year}{text[4]}{moved.month:02d}{text[4]}{moved.day:02d}"

    def _dmy(self, text: str) -> str | None:
        """With a point the day comes first; otherwise the month, unless it is above 12."""
        sep = re.search(r"\D", text)[0]
        one, two, year = (int(p) for p in text.split(sep))
        day_first = sep == "." or one > 12
        try:
            moved = self._day(dt.date(year, two, one) if day_first else dt.date(year, one, two))
        except ValueError:
            return None
        parts = (moved.day, moved.month) if day_first else (moved.month, moved.day)
        return f"{parts[0]:02d}{sep}{parts[1]:02d}{sep}{moved.year}"

    def _named_day(self, text: str) -> str | None:
        words = text.replace(",", "").split(" ")
        first = words[0] in _MONTHS
        name, number, year = (words[0], words[1], words[2]) if first else (words[1], words[0], words[2])
        try:
            moved = self._day(dt.date(int(year), _MONTHS.index(name) + 1, int(number)))
        except ValueError:
            return None
        name = _MONTHS[moved.month - 1]
        return f"{name} {moved.day}, {moved.year}" if first else f"{moved.day} {name} {moved.year}"

    def _ip(self, text: str) -> str | None:
        try:
            value = int(ipaddress.IPv4Address(text))
        except ValueError:
            return None
        return str(ipaddress.IPv4Address(self.feistel.permute(value, 1 << 32, "ip", self.back)))

    def _ssn(self, text: str) -> str | None:
        value = int(text.replace("-", ""))
        if not _ssn_valid(value):
            return None
        moved = f"{self.feistel.among(value, 10**9, 'ssn', _ssn_valid, self.back):09d}"
        return f"{moved[:3]}-{moved[3:5]}-{moved[5:]}"

    def _card(self, text: str) -> str | None:
        digits = "".join(c for c in text if c in _DIGITS)
        if not luhn(digits) or len(set(digits)) == 1:
            return None
        body = self._digits(digits[:-1], "card")
        return _refill(text, body + _check_digit(body))

    def _phone(self, text: str) -> str | None:
        """A country's code stays; the other digits are permuted alike in every notation."""
        digits = "".join(c for c in text if c in _DIGITS)
        if not 7 <= len(digits) <= 15:
            return None
        if text[0] != "+":
            return self._digits(text, "")
        code = 1 if digits[0] in _SHORT_CODES else 2 if digits[:2] in _TWO_DIGIT_CODES else 3
        return _refill(text, digits[:code] + self._digits(digits[code:], f"+{digits[:code]}/"))

    _intl = _phone

    def _prefixes(self, kind: str, found: str) -> list[str]:
        """The find and, of an IBAN, what is left of it at its other group ends: its country's length first."""
        if kind != "iban":
            return [found]
        ends = [found, *(found[:at] for at in range(len(found) - 1, 0, -1) if found[at] == " ")]
        length = _IBAN_LENGTHS.get(found[:2])
        return sorted(ends, key=lambda e: len(e.replace(" ", "")) != length)

    #: the count that each find adds to
    NAMES = {
        "aws": "secret", "value": "secret", "hex": "secret", "iso": "date", "dmy": "date", "named_day": "date",
        "intl": "phone",
    }

    def text(self, text: str | None) -> tuple[str | None, list[int]]:
        """The text with pseudonyms, and the number of replaced finds of each of KINDS."""
        counts = [0] * len(KINDS)
        if not text or not _HINT.search(text):
            return text, counts

        def replaced(match: re.Match) -> tuple[str, int] | None:
            """The pseudonym of a find and where what it replaces ends; None if nothing of it is valid."""
            found, kind = match[0], next(k for k in _GROUPS if match[k] is not None)
            if kind == "named":
                kind, value = "value", match["value"]
                made = self.memo[kind, value]
                whole, end = made and found[: len(found) - len(value)] + made, match.end()
            else:
                for prefix in self._prefixes(kind, found):
                    whole, end = self.memo[kind, prefix], match.start() + len(prefix)
                    if whole is not None:
                        break
            if whole is None:
                return None
            counts[KINDS.index(self.NAMES.get(kind, kind))] += 1
            return whole, end

        def line_of(line: str) -> str:
            out, done, at = [], 0, 0
            while match := _FINDER.search(line, at):
                if (new := replaced(match)) is None:
                    # an IBAN's groups may hide the beginning of another find
                    at = match.start() + 1 if match["iban"] else match.end()
                    continue
                out += [line[done : match.start()], new[0]]
                done = at = new[1]
            return "".join(out) + line[done:]

        lines = text.split("\n")
        for i, line in enumerate(lines):
            if _HINT.search(line):
                lines[i] = line_of(line)
        return "\n".join(lines), counts


_GROUPS = ("email", "aws", "named", "hex", "iban", "iso", "dmy", "named_day", "ip", "ssn", "card", "phone", "intl")


def pseudonymised(docs: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """doc_id, text with pseudonyms, and the number of replaced values of each kind.

    key: the secret of the job; whoever has it can turn pseudonyms back.

    Cards, IBANs and social security numbers must pass their checks, dates be days of a
    calendar, addresses be in range. A value becomes another one of the same format: length, separators, kinds
    of letters, country and check digits hold. Equal values become equal ones
    in all documents, also a date or an international number in another notation, and with ``back``
    and the same key the first ones again. Not linked are an e-mail name in capitals and in small letters, and a
    number with and without its country's code, as their formats differ. Text around them is
    not changed; null and empty texts stay, null ids pass through. No row meets another, so repeated rows get
    equal results. Where finds overlap, the one that begins first counts, of those that begin
    together the first kind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key, back)
        for batch in batches:
            found = [names.text(text.as_py()) for text in batch.column(1)]
            counts = np.array([f[1] for f in found], dtype=np.int64).reshape(-1, len(KINDS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string())]
                + [pa.array(counts[:, i]) for i in range(len(KINDS))],
                names=["doc_id", "text", *(f"n_{k}" for k in KINDS)],
            )

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    fields = ", ".join(f"n_{k} long" for k in KINDS)
    return given.mapInArrow(run, f"doc_id long, text string, {fields}")
