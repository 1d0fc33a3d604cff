"""Format-preserving pseudonyms for personal data.

Finds payment and account numbers, phone numbers, social security numbers, IBANs,
IPv4 addresses, calendar dates, the local part of e-mail addresses and long hex
secrets in whole texts, validates them (Luhn, ISO 7064 mod 97, SSN and octet
ranges, the calendar) and replaces each by a keyed permutation of itself within
its format: a Feistel network over exactly the values of the format, with cycle
walking to those that pass the same validation. Separators, lengths and letter
case stay; check digits are made anew; a date stays a date and keeps its notation.
Equal values of a kind get equal pseudonyms in all documents (dates also across
notations), different values different ones; ``unseal`` inverts with the key.

Digit runs of 13 to 19 digits that fail Luhn are account numbers: they are
permuted among those that fail it. Decimal digits of every script count: a value is
sealed by its ASCII spelling and spelled again in its own digits (in dates and IPv4
addresses, whose parts may change their length, in those of each part's first digit),
so equal values link across scripts. Phone numbers with ``+`` keep their country code,
split off by the public numbering plan, with separators or without. Social security
and phone numbers written without any separator and without ``+`` cannot be told from
other numbers and stay. The key is a parameter; keep it secret.

Rows: null text stays null with zero counts; ids may be null or repeat; other
columns are ignored.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as tk
from .shared import prepare

ROUNDS = 8
KEY = b"replace this key in production"
KINDS = ("card", "number", "phone", "ssn", "iban", "ip", "date", "email", "secret")
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
FOUND = re.compile(rf"""(?<![\w.+])(?:
  (?P<ip>{_OCTET}(?:\.{_OCTET}){{3}})(?!\w|\.\d)
 |(?P<ymd>\d{{4}}(?P<s1>[-/.])\d{{1,2}}(?P=s1)\d{{1,2}})(?!\w)
 |(?P<dmy>\d{{1,2}}(?P<s2>[-/.])\d{{1,2}}(?P=s2)\d{{4}})(?!\w)
 |(?P<ssn>\d{{3}}-\d{{2}}-\d{{4}})(?!\w)
 |(?P<number>\d{{13,19}}|\d{{4}}(?P<s3>[ -])\d{{4}}(?P=s3)\d{{4}}(?P=s3)\d{{1,7}}|\d{{4}}(?P<s4>[ -])\d{{6}}(?P=s4)\d{{5}})(?!\w)
 |(?P<phone>\+?\d{{1,3}}[ .-]?\(\d{{2,4}}\)[ .-]?\d{{3,4}}[ .-]?\d{{3,4}}|\+\d{{1,3}}(?:[ .-]?\d{{2,4}}){{2,4}}
   |\(\d{{3}}\)[ ]?\d{{3}}[ .-]\d{{4}}|\d{{3}}(?P<s5>[ .-])\d{{3}}(?P=s5)\d{{4}})(?!\w)
 |(?P<secret>(?=[a-fA-F]{{0,63}}\d)(?:[0-9a-f]{{32,128}}|[0-9A-F]{{32,128}}))(?!\w)
 |(?P<iban>[A-Z]{{2}}\d{{2}}[A-Z0-9]{{11,30}})(?!\w)
)|(?P<plus>(?<!\w)\+\d{{1,3}}[ .-]?(?:\(\d{{2,4}}\)[ .-]?)?\d{{2,4}}[ .-]?\d{{3,4}}(?:[ .-]?\d{{3,4}})?(?!\w))""", re.X)
DIGIT = re.compile(r"[0-9]")
FOREIGN = re.compile(r"(?![0-9])\d")
#: starts where a run of its characters starts, so a long run is read once
EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[._%+-]*+([A-Za-z0-9][A-Za-z0-9._%+-]*+)@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: country codes of one and two digits of the international numbering plan; all others have three (fixed values)
ONE_DIGIT = ("1", "7")
TWO_DIGITS = ("20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49",
              "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84",
              "86", "90", "91", "92", "93", "94", "95", "98")

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Permutation:
    """Keyed permutation of range(n) that keeps ``allowed`` values among themselves.

    The Feistel network orders all values in one keyed cycle; a value's pseudonym
    is the next allowed value on it, so none is its own pseudonym (unless it is
    the only allowed one)."""

    def __init__(self, key: bytes, kind: str, n: int, allowed=lambda x: True):
        self.a = math.isqrt(n - 1) + 1 if n > 1 else 1
        self.b = -(-n // self.a)
        self.n, self.allowed = n, allowed
        self.size = (n.bit_length() + 7) // 8 + 8
        self.key, self.kind = key, kind.encode()[:16]

    def _f(self, i: int, x: int) -> int:
        raw, count = b"", 0
        while len(raw) < self.size:
            said = b"%d.%d.%d.%d" % (self.n, i, count, x)
            raw += hashlib.blake2b(said, key=self.key[:64], person=self.kind).digest()
            count += 1
        return int.from_bytes(raw[:self.size], "big")

    def _walk(self, x: int, step) -> int:
        while True:
            x = step(x)
            if x < self.n and self.allowed(x):
                return x

    def _forth(self, x: int) -> int:
        r, left = divmod(x, self.a)
        for i in range(ROUNDS):
            left, r = r, (left + self._f(i, r)) % (self.b if i % 2 else self.a)
        return r * self.a + left

    def _back(self, x: int) -> int:
        r, left = divmod(x, self.a)
        for i in reversed(range(ROUNDS)):
            left, r = (r - self._f(i, left)) % (self.b if i % 2 else self.a), left
        return r * self.a + left

    def seal(self, x: int) -> int:
        return self._walk(x, lambda v: self._back((self._forth(v) + 1) % (self.a * self.b)))

    def unseal(self, x: int) -> int:
        return self._walk(x, lambda v: self._back((self._forth(v) - 1) % (self.a * self.b)))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(text: str) -> bool:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _alphabet(c: str) -> str:
    return next((a for a in (DIGITS, LOWER, UPPER) if c in a), "")


def _value(text: str, alphabets: list[str]) -> int:
    x = 0
    for c, a in zip(text, alphabets):
        if a:
            x = x * len(a) + a.index(c)
    return x


def _spelled(x: int, text: str, alphabets: list[str]) -> str:
    out = []
    for c, a in zip(reversed(text), reversed(alphabets)):
        if a:
            x, i = divmod(x, len(a))
            c = a[i]
        out.append(c)
    return "".join(reversed(out))


class Pseudonyms:
    """Seals or unseals one value of a kind."""

    def __init__(self, key: bytes, back: bool = False):
        self.key, self.way = key, "unseal" if back else "seal"
        self.of = lru_cache(100_000)(self._of)

    def _permute(self, kind: str, n: int, x: int, allowed=lambda x: True) -> int:
        return getattr(Permutation(self.key, kind, n, allowed), self.way)(x)

    def _mixed(self, kind: str, text: str, alphabets: list[str], allowed=None) -> str:
        n = math.prod(len(a) for a in alphabets if a)
        fits = (lambda x: allowed(_spelled(x, text, alphabets))) if allowed else (lambda x: True)
        return _spelled(self._permute(kind, n, _value(text, alphabets), fits), text, alphabets)

    def _digits(self, kind: str, text: str, keep: int = 0, allowed=None) -> str:
        at = [i for i, c in enumerate(text) if c in DIGITS]
        held = "".join(text[i] for i in at[keep:])
        new = self._mixed(kind, held, [DIGITS] * len(held), allowed)
        out = list(text)
        for i, c in zip(at[keep:], new):
            out[i] = c
        return "".join(out)

    def _of(self, kind: str, text: str) -> str:
        if kind == "card":
            at = [i for i, c in enumerate(text) if c in DIGITS]
            body = "".join(text[i] for i in at[:-1])
            body = self._mixed(kind, body, [DIGITS] * len(body))
            check = next(c for c in DIGITS if luhn(body + c))
            out = list(text)
            for i, c in zip(at, body + check):
                out[i] = c
            return "".join(out)
        if kind == "number":
            return self._digits(kind, text, allowed=lambda d: not luhn(d))
        if kind == "ssn":
            return self._digits(kind, text, allowed=valid_ssn)
        if kind == "phone":
            if text[0] == "+":
                return self._digits(kind, text, keep=country_length(re.sub(r"\D", "", text)))
            country = re.match(r"(\d{1,3})(?=[ .(-])", text) if "(" in text[1:] else None
            return self._digits(kind, text, keep=len(country[1]) if country else 0)
        if kind == "ip":
            a = [int(p) for p in text.split(".")]
            x = self._permute(kind, 1 << 32, a[0] << 24 | a[1] << 16 | a[2] << 8 | a[3])
            return ".".join(str(x >> s & 255) for s in (24, 16, 8, 0))
        if kind == "iban":
            body = text[4:]
            body = self._mixed(kind + text[:2], body, [_alphabet(c) for c in body])
            rest = int("".join(str(int(c, 36)) for c in body + text[:2] + "00")) % 97
            return f"{text[:2]}{98 - rest:02d}{body}"
        if kind == "secret":
            a = DIGITS + (LOWER if re.search("[a-f]", text) else UPPER)[:6]
            return self._mixed(kind, text, [a] * len(text))
        if kind == "email":
            return self._mixed(kind, text, [_alphabet(c) for c in text])
        return self._date(text)

    def _date(self, text: str) -> str:
        parts = re.split(r"([-/.])", text)
        sep, numbers = parts[1], parts[::2]
        year, month, day, order = date_parts(numbers)
        n = LAST_DAY - FIRST_DAY + 1
        x = self._permute("date", n, datetime.date(year, month, day).toordinal() - FIRST_DAY)
        new = datetime.date.fromordinal(x + FIRST_DAY)
        padded = all(len(p) != 1 for p in numbers)
        out = [f"{getattr(new, what):02d}" if padded else str(getattr(new, what)) for what in order]
        return sep.join(out)


def country_length(digits: str) -> int:
    """Digits of the country code that a full international number starts with."""
    return 1 if digits.startswith(ONE_DIGIT) else 2 if digits.startswith(TWO_DIGITS) else 3


def respelled(new: str, was: str, kind: str) -> str:
    """``new`` with its digits in the scripts of the digits of ``was``."""
    def spell(c, model):
        return chr(ord(model) - unicodedata.decimal(model) + int(c)) if c in DIGITS and model.isdecimal() else c

    if kind not in ("ip", "date"):
        return "".join(spell(c, m) for c, m in zip(new, was))
    parts = zip(re.split(r"([-/.])", new), re.split(r"([-/.])", was))
    return "".join("".join(spell(c, m[0]) for c in p) for p, m in parts)


def valid_ssn(d: str) -> bool:
    return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"


def date_parts(numbers: list[str]):
    """(year, month, day, order of the notation), or None if no valid date of 1900 to 2099."""
    if len(numbers[0]) == 4:
        tries = [("year", "month", "day")]
    else:
        tries = [("day", "month", "year"), ("month", "day", "year")]
    for order in tries:
        v = dict(zip(order, map(int, numbers)))
        try:
            if 1900 <= datetime.date(**v).year <= 2099:
                return v["year"], v["month"], v["day"], order
        except ValueError:
            pass
    return None


def classify(m: re.Match) -> str | None:
    """The kind of a match after validation, None if it fails."""
    kind, text = m.lastgroup, m.group()
    if m["ip"]:
        return "ip"
    if m["ymd"] or m["dmy"]:
        return "date" if date_parts(re.split(r"[-/.]", text)) else None
    if m["ssn"]:
        return "ssn" if valid_ssn(text.replace("-", "")) else None
    if m["number"]:
        d = re.sub(r"\D", "", text)
        return ("card" if luhn(d) else "number") if 13 <= len(d) <= 19 else None
    if m["iban"]:
        return "iban" if mod97(text) else None
    if m["secret"]:
        return "secret"
    return "phone" if kind and 7 <= len(re.sub(r"\D", "", text)) <= 15 else None


def _found(text: str):
    """(start, end, kind) of all values in a text whose digits are ASCII, in order."""
    def numbers(lo, hi):
        """Lines between lo and hi that hold a digit: no kind spans lines."""
        while m := DIGIT.search(text, lo, hi):
            start, end = text.rfind("\n", lo, m.start()) + 1, text.find("\n", m.end(), hi)
            start, end = max(start, lo), hi if end < 0 else end
            line = text[start:end]
            for f in FOUND.finditer(line):
                if kind := classify(f):
                    yield start + f.start(), start + f.end(), kind
            lo = end

    at = 0
    if "@" in text:
        for m in EMAIL.finditer(text):  # an address is not searched for numbers
            yield from numbers(at, m.start())
            yield m.start(1), m.end(1), "email"
            at = m.end()
    yield from numbers(at, len(text))


def pseudonymise(text: str, names: Pseudonyms) -> tuple[str, dict[str, int]]:
    counts = dict.fromkeys(KINDS, 0)
    plain = text
    if not text.isascii() and FOREIGN.search(text):
        plain = FOREIGN.sub(lambda m: str(unicodedata.decimal(m[0])), text)  # of the same length
    out, at = [], 0
    for start, end, kind in _found(plain):
        counts[kind] += 1
        new = names.of(kind, plain[start:end])
        if plain is not text:
            new = respelled(new, text[start:end], kind)
        out += [text[at:start], new]
        at = end
    return "".join([*out, text[at:]]), counts


def _apply(key: bytes):
    def run(batches):
        names = Pseudonyms(key)
        for batch in batches:
            texts, counts = [], {k: [] for k in KINDS}
            for t in batch.column(1).to_pylist():
                new, n = (None, dict.fromkeys(KINDS, 0)) if t is None else pseudonymise(t, names)
                texts.append(new)
                for k in KINDS:
                    counts[k].append(n[k])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), *(pa.array(counts[k], pa.int64()) for k in KINDS)],
                names=["doc_id", "text", *(f"n_{k}" for k in KINDS)])
    return run


def hide_personal_data(docs: DataFrame, key: bytes = KEY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text with pseudonyms, n_<kind> ...) for every row."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(tk.tidy(_apply(key)), f"doc_id {kind}, text string, " + ", ".join(f"n_{k} long" for k in KINDS))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hide_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
