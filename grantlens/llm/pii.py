"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

Values are found, validated and replaced by other values of the same format: card numbers keep
their length, separators and a valid check digit, dates stay dates, addresses keep their shape. A
pseudonym depends on the key and the value only, so equal values stay equal across documents, and
whoever holds the key can map them back.

A permutation of 0 to N - 1 is a Feistel network on two halves a * b >= N, walked until it lands below
N (and on a valid value, where a format has rules). Digits of numbers that no format validates stay.

Null texts stay null, empty ones empty; texts are read whole, in time linear in their length. Repeated
rows are treated alike. An empty table gives an empty result; only the text column is changed.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = b"corpus pseudonyms"
ROUNDS = 8
BLOCK = 128  # characters permuted as one number

_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _FIRST_DAY


class Permutation:
    """A keyed permutation of 0 to n - 1 for every n and every kind of value."""

    def __init__(self, key: bytes = KEY):
        self.key = key

    def _round(self, kind: str, n: int, turn: int, half: int) -> int:
        text = f"{kind}|{n}|{turn}|{half}".encode()
        digests = [hashlib.blake2b(text, key=self.key, digest_size=32).digest()]
        for k in range(256, self._halves(n)[0].bit_length() - 1, 256):  # wider halves take as many more
            digests.append(hashlib.blake2b(text + f"|{k}".encode(), key=self.key, digest_size=32).digest())
        return int.from_bytes(b"".join(digests), "big")

    def _halves(self, n: int) -> tuple[int, int]:
        a = 1 << ((n - 1).bit_length() + 1) // 2
        return a, -(-n // a)

    def _once(self, kind: str, n: int, x: int, back: bool) -> int:
        a, b = self._halves(n)
        left, right = x % a, x // a
        for turn in (reversed(range(ROUNDS)) if back else range(ROUNDS)):
            sign = -1 if back else 1
            if turn % 2 == 0:
                left = (left + sign * self._round(kind, n, turn, right)) % a
            else:
                right = (right + sign * self._round(kind, n, turn, left)) % b
        return left + a * right

    def walk(self, kind: str, n: int, x: int, valid: Callable[[int], bool] | None = None, back: bool = False) -> int:
        """The image of x (its original, if ``back``) among the valid values below n."""
        if n < 2:
            return x
        while True:
            x = self._once(kind, n, x, back)
            if x < n and (valid is None or valid(x)):
                return x


def _spread(digits: str, shape: str) -> str:
    """``shape`` with its digits replaced one after the other."""
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in shape)


def _only_digits(value: str) -> str:
    return re.sub(r"\D", "", value)


def luhn_sum(digits: str) -> int:
    return sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits)))


def _card(p: Permutation, value: str, back: bool) -> str | None:
    digits = _only_digits(value)
    if not 13 <= len(digits) <= 19 or luhn_sum(digits) % 10:
        return None
    body = f"{p.walk('card', 10 ** (len(digits) - 1), int(digits[:-1]), back=back):0{len(digits) - 1}d}"
    return _spread(body + str(-luhn_sum(body + "0") % 10), value)


def _phone(p: Permutation, value: str, back: bool) -> str | None:
    """The last ten digits; a country code stays."""
    digits = _only_digits(value)
    if len(digits) < 10:
        return None
    national = f"{p.walk('phone', 10**10, int(digits[-10:]), back=back):010d}"
    return _spread(digits[:-10] + national, value)


def _phone_abroad(p: Permutation, value: str, back: bool) -> str | None:
    """All digits after the country code."""
    code = len(re.match(r"\+(\d+)", value).group(1))
    digits = _only_digits(value)
    n = len(digits) - code
    if not 7 <= n <= 15 - code:
        return None
    return _spread(f"{digits[:code]}{p.walk('phone', 10**n, int(digits[code:]), back=back):0{n}d}", value)


def _address(p: Permutation, value: str, back: bool) -> str | None:
    parts = [int(x) for x in value.split(".")]
    if max(parts) > 255:
        return None
    n = p.walk("address", 1 << 32, int.from_bytes(bytes(parts), "big"), back=back)
    return ".".join(map(str, n.to_bytes(4, "big")))


def _valid_security(n: int) -> bool:
    area, group, serial = n // 1_000_000, n // 10_000 % 100, n % 10_000
    return area not in (0, 666) and area < 900 and group > 0 and serial > 0


def _security(p: Permutation, value: str, back: bool) -> str | None:
    n = int(_only_digits(value))
    if not _valid_security(n):
        return None
    return _spread(f"{p.walk('security', 10**9, n, _valid_security, back):09d}", value)


def _day(numbers: list[int], order: tuple[int, int, int]) -> int | None:
    """The day's number, if year, month and day lie at these places; years 1900 to 2099."""
    try:
        n = datetime.date(*(numbers[k] for k in order)).toordinal() - _FIRST_DAY
    except ValueError:
        return None
    return n if 0 <= n < _DAYS else None


def _date(p: Permutation, value: str, back: bool) -> str | None:
    """Year first; or day first; or month first, where day first is no date. Parts of one digit stay so."""
    parts = re.split(r"\D", value)
    numbers = [int(x) for x in parts]
    orders = [(0, 1, 2)] if numbers[0] > 31 else [(2, 1, 0), (2, 0, 1)]
    order = next((o for o in orders if _day(numbers, o) is not None), None)
    if order is None:
        return None

    def shown(n: int) -> list[int]:
        day = datetime.date.fromordinal(_FIRST_DAY + n)
        out = [0, 0, 0]
        for k, x in zip(order, (day.year, day.month, day.day), strict=True):
            out[k] = x
        return out

    def same_form(n: int) -> bool:
        new = shown(n)
        fits = all(len(str(x)) <= len(part) for x, part in zip(new, parts, strict=True))
        return fits and (order != (2, 0, 1) or _day(new, (2, 1, 0)) is None)

    new = shown(p.walk("date", _DAYS, _day(numbers, order), same_form, back))
    return _spread("".join(f"{x:0{len(part)}d}" for x, part in zip(new, parts, strict=True)), value)


def _iban_rest(value: str) -> int:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97


def _iban(p: Permutation, value: str, back: bool) -> str | None:
    """The digits of the account; its letters and blanks stay, the check digits follow."""
    packed = value.replace(" ", "")
    if not 15 <= len(packed) <= 34 or _iban_rest(packed) != 1:
        return None
    body = _characters(p, "iban", packed[4:], back)
    check = 98 - _iban_rest(f"{packed[:2]}00{body}")
    left = iter(f"{packed[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(left) for c in value)


def _spaced_accounts(text: str) -> list[tuple[int, int]]:
    """Account numbers printed in groups of four; groups that follow and do not belong to one are left out."""
    out = []
    for m in _SPACED_IBAN.finditer(text):
        value = m.group()
        while len(value) > 14 and _iban(_PLAIN, value, False) is None:
            value = value.rpartition(" ")[0]
        if len(value) > 14:
            out.append((m.start(), m.start() + len(value)))
    return out


# The alphabets whose letters are exchanged among themselves.
_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_HEX = ("0123456789abcdef",)


def _characters(p: Permutation, kind: str, value: str, back: bool, alphabets=_ALPHABETS) -> str:
    """Every character of an alphabet becomes one of the same; up to BLOCK of them are permuted as one number.

    Of a longer value each block is permuted in a way of its own, which all the blocks before decide (without regard to case).
    """
    out, plain = [], ""
    for at in range(0, max(1, len(value)), BLOCK):
        block = value[at:at + BLOCK]
        if at:
            plain = hashlib.blake2b(plain.lower().encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
        new = _block(p, f"{kind}|{plain}" if at else kind, block, back, alphabets)
        plain += new if back else block
        out.append(new)
    return "".join(out)


def _block(p: Permutation, kind: str, value: str, back: bool, alphabets) -> str:
    sets = [next((a for a in alphabets if c in a), None) for c in value]
    n, x = 1, 0
    for c, a in zip(value, sets, strict=True):
        if a:
            x, n = x * len(a) + a.index(c), n * len(a)
    x = p.walk(kind, n, x, back=back)
    out = list(value)
    for k in range(len(value) - 1, -1, -1):
        if a := sets[k]:
            x, digit = divmod(x, len(a))
            out[k] = a[digit]
    return "".join(out)


def _mail(p: Permutation, value: str, back: bool) -> str:
    """The name and all labels of the host but the last two."""
    name, host = value.split("@")
    labels = host.split(".")
    inner = ".".join(labels[:-2])
    changed = _characters(p, "mail", f"{name}@{inner}", back)
    return changed + "." * bool(inner) + ".".join(labels[-2:])


def _hexadecimal(value: str) -> bool:
    return bool(re.fullmatch("[0-9]*[a-f][0-9a-f]*", value))


def _secret(p: Permutation, value: str, back: bool) -> str:
    """Hexadecimal values stay so; a copy in capitals becomes the capitals of what the value becomes."""
    if _hexadecimal(value.lower()) and value == value.upper():
        return _secret(p, value.lower(), back).upper()
    kind = _hexadecimal(value)
    while True:  # walks, until the value is of the same kind again
        value = _characters(p, "secret", value, back, _HEX if kind else _ALPHABETS)
        if _hexadecimal(value.lower() if value == value.upper() else value) == kind:
            return value


# Forms of numbers, tried in this order where a run of digits and separators begins.
_NUMBERS: tuple[tuple[str, re.Pattern, Callable], ...] = tuple((kind, re.compile(form), rule) for kind, form, rule in (
    ("date", r"(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})", _date),
    ("security", r"\d{3}-\d{2}-\d{4}", _security),
    ("address", r"\d{1,3}(?:\.\d{1,3}){3}", _address),
    ("card", r"(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5})", _card),
    ("phone", r"\+\d{1,3}[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}", _phone),
    ("phone", r"\+\d{1,3}[ .-]\(?\d{1,4}\)?(?:[ .-]\d{2}){3,4}", _phone_abroad),
    ("phone", r"\+\d{1,3}(?:[ .-]\(?\d{1,5}\)?){1,3}[ .-]\d{3,4}", _phone_abroad),
    ("phone", r"\(\d{3}\)[ ]?\d{3}[ .-]\d{4}", _phone),
    ("phone", r"\d{3}[.-]\d{3}[.-]\d{4}", _phone),
))
_START = re.compile(r"[+(]?\d")
_NAME = re.compile(r"[\w.%+-]{1,64}$")
_HOST = re.compile(r"[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+")
_IBAN = re.compile(r"\b[A-Z]{2}\d{2}[A-Z0-9]{11,30}\b")
_SPACED_IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?\b")
_SECRETS = re.compile(r"\bAKIA[0-9A-Z]{16}\b|(?:passw(?:or)?d|secret|token|api[_-]?key)\"?\s{0,9}[=:]\s{0,9}[\"']?([0-9A-Za-z_/+-]{8,})", re.IGNORECASE)
_SECRET_HINTS = ("akia", "passw", "secret", "token", "api")


def found(text: str) -> list[tuple[int, int, str, Callable]]:
    """Start, end, kind and rule of every candidate, in the order of the text, without overlaps."""
    spans: list[tuple[int, int, str, Callable]] = []
    at = text.find("@")
    while at >= 0:
        name = _NAME.search(text, max(0, at - 64), at)
        host = _HOST.match(text, at + 1)
        if name and host and not host.group().split(".")[-1].isdigit():
            spans.append((name.start(), host.end(), "mail", _mail))
        at = text.find("@", at + 1)
    lowered = text.lower()
    if any(hint in lowered for hint in _SECRET_HINTS):
        for m in _SECRETS.finditer(text):
            start, end = m.span(1) if m.group(1) else (m.start() + 4, m.end())
            spans.append((start, end, "secret", _secret))
    start = _START.search(text)
    if start:
        spans.extend((*m.span(), "iban", _iban) for m in _IBAN.finditer(text))
        spans.extend((*span, "iban", _iban) for span in _spaced_accounts(text))
    while start:
        at, stop = start.start(), start.end()
        if at and (text[at - 1].isalnum() or text[at - 1] == "_"):  # inside a word: past its digits
            stop = re.compile(r"\d+").match(text, stop - 1).end()
        else:
            for kind, form, rule in _NUMBERS:
                m = form.match(text, at)
                if m and not text[m.end():m.end() + 1].isalnum() and rule(_PLAIN, m.group(), False) is not None:
                    spans.append((at, m.end(), kind, rule))
                    stop = m.end()
                    break
            else:
                stop = re.compile(r"\d+").match(text, stop - 1).end()
        start = _START.search(text, stop)
    spans.sort(key=lambda s: (s[0], -s[1]))
    kept, end = [], 0
    for span in spans:
        if span[0] >= end:
            kept.append(span)
            end = span[1]
    return kept


class _Unchanged(Permutation):
    def walk(self, kind, n, x, valid=None, back=False):
        return x


_PLAIN = _Unchanged()


@lru_cache(maxsize=50_000)
def _replacement(key: bytes, kind: str, rule: Callable, value: str, back: bool) -> str | None:
    return rule(Permutation(key), value, back)


def pseudonymized(text: str | None, key: bytes = KEY, back: bool = False) -> tuple[str | None, int]:
    """The text with its private values replaced, and how many were."""
    if not text:
        return text, 0
    out, end, n = [], 0, 0
    for start, stop, kind, rule in found(text):
        new = _replacement(key, kind, rule, text[start:stop], back)
        if new is not None:
            out += [text[end:start], new]
            end, n = stop, n + 1
    return ("".join([*out, text[end:]]), n) if n else (text, 0)


def with_pseudonyms(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """``docs`` with its texts pseudonymized; other columns as they are."""

    @F.pandas_udf("string")
    def replace(text: pd.Series) -> pd.Series:
        return text.map(lambda t: pseudonymized(t if isinstance(t, str) else None, key)[0])

    return docs.withColumn("text", replace("text"))


def pseudonym_report(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """doc_id, text (pseudonymized), n_private (values replaced)."""

    @F.pandas_udf("text string, n_private int")
    def replace(text: pd.Series) -> pd.DataFrame:
        done = [pseudonymized(t if isinstance(t, str) else None, key) for t in text]
        return pd.DataFrame(done, columns=["text", "n_private"])

    return docs.select("doc_id", replace("text").alias("found")).select("doc_id", "found.*")
