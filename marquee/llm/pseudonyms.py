"""PII: validated numbers, dates and addresses become keyed pseudonyms of the same format."""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from functools import lru_cache

from pyspark.sql import DataFrame

from marquee.llm.common import with_columns

ROUNDS = 10
DIGITS, LOWER, UPPER, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"
LATIN_LOWER = "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
LATIN_UPPER = "".join(chr(c) for c in range(0xC0, 0xDF) if c != 0xD7)
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


class Feistel:
    """A keyed permutation of the numbers below ``a * b``: two halves, added to in turn."""

    def __init__(self, key: bytes):
        self.key = key

    def _add(self, kind: str, step: int, half: int, modulus: int) -> int:
        """A number below ``modulus`` out of at least 128 bits more than it has, so no part of a half stays as it was."""
        need, text = 16 + (modulus.bit_length() + 7) // 8, f"{kind}|{step}|{half}|{modulus}"
        if need <= 64:
            return int.from_bytes(hashlib.blake2b(text.encode(), key=self.key, digest_size=need).digest(), "big") % modulus
        blocks = (hashlib.blake2b(f"{text}|{n}".encode(), key=self.key, digest_size=64).digest() for n in range(-(-need // 64)))
        return int.from_bytes(b"".join(blocks), "big") % modulus

    def permute(self, kind: str, value: int, a: int, b: int, back: bool = False) -> int:
        left, right = divmod(value, b)
        for step in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if step % 2:
                right = (right + sign * self._add(kind, step, left, b)) % b
            else:
                left = (left + sign * self._add(kind, step, right, a)) % a
        return left * b + right

    def below(self, kind: str, value: int, size: int, back: bool = False) -> int:
        """A permutation of range(size): walk the cycle of a slightly larger one until it is inside."""
        a = int(size ** 0.5) or 1
        b = -(-size // a)
        while True:
            value = self.permute(kind, value, a, b, back)
            if value < size:
                return value

    def letters(self, kind: str, text: str, alphabets: tuple[str, ...], back: bool = False) -> str:
        """Permute the letters of the alphabets among the texts of the same shape; other characters stay."""
        at = [(i, next((x for x in alphabets if c in x), "")) for i, c in enumerate(text)]
        at = [(i, x) for i, x in at if x]
        if not at:
            return text
        middle = (len(at) + 1) // 2
        halves = []
        for part in (at[:middle], at[middle:]):
            value, size = 0, 1
            for i, x in part:
                value, size = value * len(x) + x.index(text[i]), size * len(x)
            halves.append((value, size))
        (left, a), (right, b) = halves
        shape = kind + "|" + "".join(chr(97 + alphabets.index(x)) for _, x in at)
        left, right = divmod(self.permute(shape, left * b + right, a, b, back), b)
        out = list(text)
        for part, value in ((at[:middle], left), (at[middle:], right)):
            for i, x in reversed(part):
                value, k = divmod(value, len(x))
                out[i] = x[k]
        return "".join(out)


# --- formats --------------------------------------------------------------------


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        v = int(c) * (2 if i % 2 == 0 else 1)
        total += v - 9 if v > 9 else v
    return str(-total % 10)


def _put_digits(shape: str, digits: str) -> str:
    """The digits in the places of the shape's digits."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def _card(f: Feistel, m: re.Match, back: bool) -> str | None:
    digits = "".join(c for c in m[0] if c in DIGITS)
    if not 13 <= len(digits) <= 19:
        return None
    # the last digit is a check digit plus an offset that stays: 0 for valid card numbers
    offset = (int(digits[-1]) - int(luhn_digit(digits[:-1]))) % 10
    body = f.letters("card", digits[:-1], (DIGITS,), back)
    return _put_digits(m[0], body + str((int(luhn_digit(body)) + offset) % 10))


def _iban(f: Feistel, m: re.Match, back: bool) -> str | None:
    plain = m[0].replace(" ", "")
    if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 != 1:
        return None
    body = f.letters("iban" + plain[:2], plain[4:], (DIGITS, UPPER), back)
    check = 98 - int("".join(str(int(c, 36)) for c in body + plain[:2] + "00")) % 97
    it = iter(f"{plain[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(it) for c in m[0])


def _ssn(f: Feistel, m: re.Match, back: bool) -> str | None:
    area, group, serial = int(m[1]), int(m[2]), int(m[3])
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    areas = 898  # 001-899 but 666
    value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    value = f.below("ssn", value, areas * 99 * 9999, back)
    value, serial = divmod(value, 9999)
    area, group = divmod(value, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _phone(f: Feistel, m: re.Match, back: bool) -> str | None:
    digits = "".join(c for c in m[0] if c in DIGITS)
    keep = len(m[1] or "")  # the country code after the plus
    if not 7 <= len(digits) - keep <= 14:
        return None
    return _put_digits(m[0], digits[:keep] + f.letters("phone" + digits[:keep], digits[keep:], (DIGITS,), back))


def _ip(f: Feistel, m: re.Match, back: bool) -> str | None:
    parts = [int(x) for x in m[0].split(".")]
    if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in m[0].split(".")):
        return None
    value = f.permute("ip", int.from_bytes(bytes(parts), "big"), 1 << 16, 1 << 16, back)
    return ".".join(map(str, value.to_bytes(4, "big")))


def _email(f: Feistel, m: re.Match, back: bool) -> str | None:
    head, dot, top = m[0].rpartition(".")
    return f.letters("email", head, (DIGITS, LOWER, UPPER, LATIN_LOWER, LATIN_UPPER), back) + dot + top


def _date(f: Feistel, m: re.Match, back: bool) -> str | None:
    g = {k: v for k, v in m.groupdict().items() if v is not None}
    names = {k[0]: int(v) for k, v in g.items() if k[0] in "ymd"}
    try:
        day = dt.date(names["y"], names["m"], names["d"]).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= day <= LAST_DAY:
        return None
    new = dt.date.fromordinal(FIRST_DAY + f.below("date", day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, back))
    out, base = list(m[0]), m.start()
    for k in sorted((k for k in g if k[0] in "ymd"), key=m.start, reverse=True):
        part = {"y": new.year, "m": new.month, "d": new.day}[k[0]]
        out[m.start(k) - base:m.end(k) - base] = f"{part:04d}" if k[0] == "y" else f"{part:02d}"
    return "".join(out)


def _secret(f: Feistel, m: re.Match, back: bool) -> str | None:
    return m[0][:m.start(1) - m.start()] + f.letters("hex", m[1], (HEX,) if m[1] == m[1].lower() else (DIGITS, "ABCDEF", "abcdef"), back)


# Lengths of account numbers by country.
IBAN_LENGTHS = {"AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27,
                "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27,
                "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24, "TR": 26}
_IBAN = "|".join(f"{c}\\d{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for c, n in IBAN_LENGTHS.items())

# Order matters: an earlier format takes its spans from later ones.
FORMATS = [
    ("email", re.compile(r"[^\s@<>\"'(),;:|=\[\]{}]{1,64}@(?:[A-Za-z0-9À-ÿ-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])"), _email),
    ("secret", re.compile(r"(?i:token|secret|key|password|passwd|pwd)[\"']?\s{0,3}[=:]\s{0,3}[\"']?([0-9a-fA-F]{24,128})(?![0-9a-zA-Z])"), _secret),
    ("iban", re.compile(rf"(?<![A-Za-z0-9])(?:{_IBAN})(?![A-Za-z0-9])"), _iban),
    ("ip", re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)"), _ip),
    ("date", re.compile(r"(?<![\d./-])(?:(?P<y1>\d{4})-(?P<m1>\d{2})-(?P<d1>\d{2})|(?P<y2>\d{4})/(?P<m2>\d{2})/(?P<d2>\d{2})|(?P<d3>\d{2})\.(?P<m3>\d{2})\.(?P<y3>\d{4})"
                        r"|(?P<m4>\d{2})/(?P<d4>\d{2})/(?P<y4>\d{4}))(?![\d/-])"), _date),
    ("ssn", re.compile(r"(?<![\d-])(\d{3})-(\d{2})-(\d{4})(?![\d-])"), _ssn),
    ("phone", re.compile(r"\+(\d{1,3})[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)"), _phone),
    ("phone", re.compile(r"(?<![\d+(])()\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d+-])()\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"), _phone),
    ("card", re.compile(r"(?<![\d.])\d(?:[ -]?\d){12,18}(?![\d])"), _card),
]
_HINT = re.compile(r"@|[0-9]")
KINDS = sorted({k for k, _, _ in FORMATS})


@lru_cache(maxsize=4)
def feistel(key: bytes) -> Feistel:
    return Feistel(key)


def find(text: str, key: bytes, back: bool = False) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of every accepted value, by start, without overlaps.

    A match that overlaps an accepted value is passed over, and so is one that fails its format's check.
    """
    if not _HINT.search(text):
        return []
    f, taken, found = feistel(key), [], []
    for kind, pattern, make in FORMATS:
        for m in pattern.finditer(text):
            if any(a < m.end() and m.start() < b for a, b in taken) if len(taken) < 8 else _overlaps(taken, m.start(), m.end()):
                continue
            if (new := make(f, m, back)) is not None:
                found.append((m.start(), m.end(), kind, new))
        taken = sorted((a, b) for a, b, _, _ in found)
    return sorted(found)


def _overlaps(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether a span of the sorted, disjoint ``taken`` meets [start, end)."""
    from bisect import bisect_left

    i = bisect_left(taken, (end, -1))
    return i > 0 and taken[i - 1][1] > start


def replace(text: str, found: list[tuple[int, int, str, str]]) -> str:
    out, at = [], 0
    for start, end, _, new in found:
        out += [text[at:start], new]
        at = end
    return "".join(out) + text[at:]


def pseudonyms(docs: DataFrame, key: bytes, text: str = "text", back: bool = False) -> DataFrame:
    """Every row with its text pseudonymised, ``n_replaced`` and ``kinds`` (comma-joined, sorted).

    Card and account numbers keep their check digit right, IBANs theirs, dates stay dates of 1900
    to 2099, SSNs stay valid; emails keep their shape and top domain. A value is permuted within
    its format by the key alone, so equal values stay equal in all documents and different ones
    different; ``back`` inverts the permutations. Without the key nothing can be linked back, so
    none is built in. Null text stays null, empty stays empty; all else in a text is unchanged.
    Repeated rows come out alike; an empty table gives no rows; clashing columns are replaced.
    """
    if not key:
        raise ValueError("a key is needed")

    def run(batch):
        out = {text: [], "n_replaced": [], "kinds": []}
        for t in batch.column(text).to_pylist():
            found = find(t, key, back) if t else []
            out[text].append(replace(t, found) if found else t)
            out["n_replaced"].append(len(found))
            out["kinds"].append(",".join(sorted({k for _, _, k, _ in found})))
        return out

    return with_columns(docs, {text: "string", "n_replaced": "bigint", "kinds": "string"}, run)
