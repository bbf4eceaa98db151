"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Found values are validated (checksum, calendar; phones and addresses by their format
and octets only, as personal data needn't be in a range that is handed out) and mapped by a
keyed permutation of their own format: a Feistel network over the number the
value stands for, walked on until it lands on a valid value again.  Equal values
get equal pseudonyms in every document, different values different ones, and the
holder of the key can go back.  What fails validation is left alone.  A card or IBAN
run that fails is tried without its last groups, longest first, and searched on from its
second character; a pseudonym that would make a longer run valid is walked past there,
so in such a place a value may differ from its usual pseudonym.

Kinds: card (Luhn), ssn, phone (country code kept), ipv4, iban (country kept,
mod 97), date (yyyy-mm-dd, or day and month first, 1900 to 2099) and the local part of an
e-mail address (letters to letters, digits to digits).  Cards are 13 to 19 digits without a
separator or in the groupings cards are printed in (``CARD_GROUPS``); other rows of
numbers stay.  An international phone number's country code is told by the table of
calling codes, so one number gets one pseudonym however it is spaced.

Defined results: null text stays null, empty stays empty; a null doc_id is
carried through; repeated rows get the same text; only doc_id and text are read.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KINDS = ["email", "iban", "date", "ipv4", "ssn", "phone", "card"]

# One pass; the first alternative that fits wins.
FOUND = re.compile(r"""
    (?P<email>(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}(?![\w-]))
  | (?P<iban>\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b)
  | (?P<date>(?<![\w.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}([./])[0-9]{1,2}\4[0-9]{4})(?![\w-]|\.[0-9]))
  | (?P<ipv4>(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9]))
  | (?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))
  | (?P<phone>(?<![\w+])\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?(?:[\x20.-]?[0-9]{2,4}){1,4}(?![\w-])|(?<![\w(])\([0-9]{3}\)\x20?[0-9]{3}-[0-9]{4}(?![\w-])|(?<![\w.+-])(?:1-)?[0-9]{3}-[0-9]{3}-[0-9]{4}(?![\w-]))
  | (?P<card>(?<![\w.-])(?:[0-9]{13,19}|[0-9]{4}([\x20-])(?:[0-9]{4}\9[0-9]{4}\9[0-9]{4}(?:\9[0-9]{3})?|[0-9]{6}\9[0-9]{4,5}))(?![\w-]|\.[0-9]))
""", re.X | re.A)


class Permutation:
    """Keyed permutations of 0..n-1, one for each (n, tweak)."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, tweak: bytes, r: int, half: int, bits: int) -> int:
        size = (bits + 7) // 8
        out, block = b"", 0
        while len(out) < size:
            out += hashlib.blake2b(half.to_bytes((half.bit_length() + 7) // 8 + 1, "big"), key=self.key[:64],
                                   salt=bytes([r, block & 255]), person=hashlib.blake2b(tweak, digest_size=16).digest()).digest()
            block += 1
        return int.from_bytes(out[:size], "big") & ((1 << bits) - 1)

    def __call__(self, x: int, n: int, tweak: bytes, valid: Callable[[int], bool] = lambda x: True, back: bool = False) -> int:
        if n < 2:
            return x
        bits = max(1, ((n - 1).bit_length() + 1) // 2)
        mask = (1 << bits) - 1
        while True:
            a, b = x >> bits, x & mask
            if back:
                for r in reversed(range(ROUNDS)):
                    a, b = b ^ self._round(tweak, r, a, bits), a
            else:
                for r in range(ROUNDS):
                    a, b = b, a ^ self._round(tweak, r, b, bits)
            x = a << bits | b
            if x < n and valid(x):
                return x


# The country calling codes of one and of two digits; all others have three.
CALLING_CODES = {1: frozenset("1 7".split()),
                 2: frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
                              "81 82 84 86 90 91 92 93 94 95 98".split())}
# Groupings that cards are written in, all with one separator; and the numbers that issuers hand out.
CARD_GROUPS = [[4, 4, 4, 4], [4, 4, 4, 4, 3], [4, 6, 5], [4, 6, 4]]
_ISSUED = re.compile("[3-6]|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)")


def country_code(digits: str) -> str:
    """The calling code that an international number begins with."""
    return next((digits[:n] for n, codes in CALLING_CODES.items() if digits[:n] in codes), digits[:3])


def luhn(digits: str) -> int:
    """The check digit that completes ``digits``."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (2 if k % 2 == 0 else 1)
        total += v - 9 if v > 9 else v
    return -total % 10


def is_card(v: str) -> bool:
    d = re.sub(r"\D", "", v)
    return 13 <= len(d) <= 19 and luhn(d[:-1]) == int(d[-1]) and len(set(d)) > 1


def _letters_as_number(t: str) -> int:
    return int("".join(str(int(c, 36)) for c in t))


def is_iban(v: str) -> bool:
    s = v.replace(" ", "")
    return 15 <= len(s) <= 34 and _letters_as_number(s[4:] + s[:4]) % 97 == 1


def _runs(v: str, kind: str) -> list[tuple[int, int]]:
    """What ``v`` may be a value up to, longest first: its end or an earlier border of its groups, for a card one that leaves a card's grouping."""
    ends = [len(v)] + [m.start() for m in reversed(list(re.finditer("[ -]", v)))]
    return [(0, b) for b in ends if kind != "card" or "-" not in v[:b].replace(" ", "-") or [len(g) for g in re.split("[ -]", v[:b])] in CARD_GROUPS]


def _refill(value: str, digits: str) -> str:
    """``value`` with its digits replaced, in order."""
    it = iter(digits)
    return "".join(next(it) if c in "0123456789" else c for c in value)


_FIRST = dt.date(1900, 1, 1)
_DAYS = (dt.date(2100, 1, 1) - _FIRST).days


class Pseudonyms:
    """Maps values and texts under one key; ``back`` goes the other way."""

    def __init__(self, key: bytes, back: bool = False):
        self.perm, self.back = Permutation(key), back

    def _digits(self, digits: str, kind: str, valid: Callable[[str], bool] = lambda d: True) -> str:
        n = len(digits)
        return str(self.perm(int(digits), 10 ** n, f"{kind}:{n}".encode(), lambda x: valid(str(x).zfill(n)), self.back)).zfill(n)

    def card(self, v: str, fits: Callable[[str], bool] = lambda v: True) -> str | None:
        if not is_card(v):
            return None
        filled = lambda body: _refill(v, body + str(luhn(body)))
        return filled(self._digits(re.sub(r"\D", "", v)[:-1], "card", lambda x: len(set(x)) > 1 and fits(filled(x))))

    def ssn(self, v: str) -> str | None:
        valid = lambda d: d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
        d = re.sub(r"\D", "", v)
        return _refill(v, self._digits(d, "ssn", valid)) if valid(d) else None

    def phone(self, v: str) -> str | None:
        d = re.sub(r"\D", "", v)
        code = country_code(d) if v[0] == "+" else "1" if v.startswith("1-") else ""
        if not 6 <= len(d) - len(code) <= 13:
            return None
        return _refill(v, code + self._digits(d[len(code):], "phone+" + (code or "1")))

    def ipv4(self, v: str) -> str | None:
        parts = [int(x) for x in v.split(".")]
        if max(parts) > 255:
            return None
        x = int.from_bytes(bytes(parts), "big")
        return ".".join(map(str, self.perm(x, 1 << 32, b"ipv4", back=self.back).to_bytes(4, "big")))

    def iban(self, v: str, fits: Callable[[str], bool] = lambda v: True) -> str | None:
        s = v.replace(" ", "")
        old = "".join(c for c in s[4:] if c.isdigit())
        if not old or not is_iban(v):
            return None

        def filled(digits: str) -> str:
            body = _refill(s[4:], digits)
            new = iter(s[:2] + f"{98 - _letters_as_number(body + s[:2] + '00') % 97:02d}" + body)
            return "".join(c if c == " " else next(new) for c in v)

        return filled(self._digits(old, "iban" + s[:2], lambda x: fits(filled(x))))

    def date(self, v: str) -> str | None:
        parts = re.split(r"[./-]", v)
        order = "ymd" if "-" in v else "dmy"
        try:
            day = dt.date(**{{"y": "year", "m": "month", "d": "day"}[k]: int(x) for k, x in zip(order, parts)})
        except ValueError:
            if order == "ymd":
                return None
            order = "mdy"
            try:
                day = dt.date(int(parts[2]), int(parts[0]), int(parts[1]))
            except ValueError:
                return None
        if not 0 <= (day - _FIRST).days < _DAYS:
            return None
        # A day that fits in as many figures stays in them; day-first and month-first stay told apart.
        widths = {k: len(x) for k, x in zip(order, parts)}
        at = lambda x: _FIRST + dt.timedelta(days=x)

        def fits(x: int) -> bool:
            d = at(x)
            same = (widths["d"] == 2 or d.day < 10) and (widths["m"] == 2 or d.month < 10)
            return same and (order != "mdy" or d.day > 12)

        new = at(self.perm((day - _FIRST).days, _DAYS, b"date", fits, self.back))
        text = {"y": f"{new.year:04d}", "m": f"{new.month:0{widths['m']}d}", "d": f"{new.day:0{widths['d']}d}"}
        seps = re.findall(r"[./-]", v)
        return text[order[0]] + seps[0] + text[order[1]] + seps[1] + text[order[2]]

    def email(self, v: str) -> str | None:
        local, _, domain = v.partition("@")
        out = []
        for k, run in enumerate(re.findall(r"[a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+", local)):
            first, base = ("a", 26) if run[0].islower() else ("A", 26) if run[0].isupper() else ("0", 10)
            if not run[0].isalnum():
                out.append(run)
                continue
            x = 0
            for c in run:
                x = x * base + ord(c) - ord(first)
            x = self.perm(x, base ** len(run), f"email:{k}:{first}{len(run)}:{domain.lower()}".encode(), back=self.back)
            chars = []
            for _ in run:
                x, r = divmod(x, base)
                chars.append(chr(ord(first) + r))
            out.append("".join(reversed(chars)))
        return "".join(out) + "@" + domain

    def text(self, text: str) -> tuple[str, dict[str, int]]:
        """The text with its values replaced, and how many of each kind."""
        counts = dict.fromkeys(KINDS, 0)

        out, done, m = [], 0, FOUND.search(text)
        while m:
            kind = m.lastgroup if m.lastgroup in counts else next(k for k in KINDS if m.group(k))
            b, new = self._inside(m, kind) if kind in ("card", "iban") else (len(m.group()), getattr(self, kind)(m.group()))
            if new is None:
                m = FOUND.search(text, m.start() + 1)
                continue
            counts[kind] += 1
            out += [text[done:m.start()], new]
            done = m.start() + b
            m = FOUND.search(text, done)
        return "".join(out) + text[done:], counts

    def _inside(self, m: re.Match, kind: str) -> tuple[int, str | None]:
        """(end, pseudonym) of the longest value that the match begins with.

        The longer runs fail their checksum and still do with the pseudonym in place, so the way back finds the same run.
        A card in groups beside further numbers in the same writing may be a piece of a table of
        numbers: there it must also begin as issuers' numbers do, and its pseudonym does.
        """
        v, text = m.group(), m.string
        runs = _runs(v, kind)
        for k, (_, b) in enumerate(runs):
            sep = v[4:5]
            end = m.start() + b
            table = kind == "card" and sep in (" ", "-") and (_beside(text, end, sep) or _beside(text, m.start() - 1, sep, -1))

            def valid(run: str) -> bool:
                return is_iban(run) if kind == "iban" else is_card(run) and (not table or bool(_ISSUED.match(run)))

            if valid(v[:b]):
                longer = runs[:k]
                fits = lambda new: valid(new) and not any((is_card if kind == "card" else is_iban)((new + v[b:])[:y]) for _, y in longer)  # noqa: E731, B023
                new = getattr(self, kind)(v[:b], fits)
                if new is not None:
                    return b, new
        return len(v), None


def _beside(text: str, at: int, sep: str, step: int = 1) -> bool:
    """A digit follows (or with -1 precedes) the separator at a place of the text."""
    return 0 <= at < len(text) and text[at] == sep and 0 <= at + step < len(text) and text[at + step] in "0123456789"


def pseudonymise(docs: DataFrame, key: str, back: bool = False) -> DataFrame:
    """doc_id, the text with pseudonyms, and n_<kind> replaced values of each kind."""
    fields = ", ".join(f"n_{k} long" for k in KINDS)

    @F.pandas_udf(f"text string, {fields}")
    def mapped(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = Pseudonyms(key.encode(), back)
        for batch in texts:
            rows = [(t, dict.fromkeys(KINDS, 0)) if not t or not (_DIGIT.search(t) or "@" in t) else names.text(t) for t in batch]
            yield pd.DataFrame({"text": pd.Series([t for t, _ in rows], dtype=object)}
                               | {f"n_{k}": pd.Series([c[k] for _, c in rows], dtype="int64") for k in KINDS})

    return docs.select("doc_id", mapped("text").alias("m")).select("doc_id", "m.*")


_DIGIT = re.compile("[0-9]")
